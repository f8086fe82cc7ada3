"""Operators for language-model training data, each a function from DataFrames to DataFrames."""
