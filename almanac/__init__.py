"""Almanac: batch and streaming operators for dated entity series on Spark."""
