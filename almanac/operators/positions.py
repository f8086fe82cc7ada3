"""Dated weights and price panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def turnover(df: DataFrame, key: str, date: str, item: str, weight: str) -> DataFrame:
    """(key, date, turnover): half the absolute weight changes against the date before; the first date has none."""
    dates = df.select(key, date).distinct().withColumn("_next", F.lead(date).over(Window.partitionBy(key).orderBy(date)))
    first = dates.groupBy(key).agg(F.min(date).alias("_first"))
    before = df.join(dates, [key, date]).where("_next IS NOT NULL").select(key, F.col("_next").alias(date), item, F.col(weight).alias("_b"))
    both = df.join(before, [key, date, item], "full_outer").join(first, key).where(F.col(date) > F.col("_first"))
    gap = F.abs(F.coalesce(weight, F.lit(0.0)) - F.coalesce("_b", F.lit(0.0)))
    return both.groupBy(key, date).agg((F.sum(gap) / 2).alias("turnover"))


def capped_weights(df: DataFrame, by: list[str], weight: str, risky: str, cap: float) -> DataFrame:
    """df with weight: renormalised over what is there, the risky part held to the cap, the rest taking up the difference."""
    group = Window.partitionBy(*by)
    df = df.withColumn("_x", F.col(weight) / F.sum(weight).over(group))
    risk, rest = (F.coalesce(F.sum(F.when(ok, F.col("_x"))).over(group), F.lit(0.0)) for ok in (F.col(risky), ~F.col(risky)))
    df = df.withColumn("_r", risk).withColumn("_f", rest)
    fits = (F.col("_r") <= cap) | (F.col("_f") == 0)
    return df.withColumn("weight", F.when(fits, F.col("_x")).when(F.col(risky), F.col("_x") * cap / F.nullif(F.col("_r"), F.lit(0.0))).otherwise(F.col("_x") * (1 - cap) / F.nullif(F.col("_f"), F.lit(0.0)))).drop("_x", "_r", "_f")


def panel_flags(df: DataFrame, key: str, date: str, most_gap: int, dry: Column, most_dry: int) -> DataFrame:
    """(key, bad_close, gaps, dry): non-positive closes, gaps over ``most_gap`` sessions, rows in dry runs over ``most_dry``.

    Sessions are the table's own dates, numbered; there are few of them.
    """
    sessions = df.select(date).distinct().withColumn("_s", F.row_number().over(Window.orderBy(date)))
    order = Window.partitionBy(key).orderBy(date)
    df = df.join(sessions, date).withColumn("_dry", dry)
    df = df.withColumn("_g", F.col("_s") - F.lag("_s").over(order)).withColumn("_i", F.row_number().over(order) - F.row_number().over(Window.partitionBy(key, "_dry").orderBy(date)))
    df = df.withColumn("_run", F.count("*").over(Window.partitionBy(key, "_dry", "_i")))
    return df.groupBy(key).agg(F.count_if(F.col("close") <= 0).alias("bad_close"), F.count_if(F.col("_g") > most_gap).alias("gaps"), F.count_if(F.col("_dry") & (F.col("_run") > most_dry)).alias("dry"))
