"""Cohort ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.operators.selection import quantiles


def midrank_percentile(df: DataFrame, label: str, value: str, out: str, least: int = 10) -> DataFrame:
    """df with out: share of the label's other members below, ties counting half, in percent at two decimals.

    Members without a value don't count as peers but do count for the cohort's size; a cohort of less than ``least`` gives
    50, a missing value null. One window per label, no self-join.
    """
    group = Window.partitionBy(label)
    n, valid = F.count(F.lit(1)).over(group), F.count(value).over(group)
    below, ties = F.rank().over(group.orderBy(F.asc_nulls_last(value))) - 1, F.count(value).over(Window.partitionBy(label, value))
    share = 100 * (below + 0.5 * (ties - 1)) / F.nullif(valid - 1, F.lit(0))
    return df.withColumn(out, F.when(n < least, 50.0).when(F.col(value).isNotNull(), F.round(share, 2)))


def quartile(percentile: Column, cohort: Column | None = None, least: int = 10) -> Column:
    """1 for the best quarter; a small cohort is 2, a null percentile 4."""
    rank = F.when(percentile >= 75, 1).when(percentile >= 50, 2).when(percentile >= 25, 3).otherwise(4)
    return rank if cohort is None else F.when(cohort < least, 2).otherwise(rank)


def bands(df: DataFrame, label: str, value: str) -> DataFrame:
    """(label, p25, p50, p75), linear and exact; a label's members are never gathered, however many."""
    return quantiles(df, [label], value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}).drop("n")


def average_rank_share(df: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """df with out in [-1/2, 1/2]: average rank among the non-null values over their number, less one half."""
    group = Window.partitionBy(*by)
    average = F.rank().over(group.orderBy(F.asc_nulls_last(value))) + (F.count(value).over(Window.partitionBy(*by, value)) - 1) / 2
    return df.withColumn(out, F.when(F.col(value).isNotNull(), average / F.count(value).over(group) - 0.5))


def rank_shares(df: DataFrame, by: list[str], cols: list[str], buckets: int = 256) -> DataFrame:
    """df with every one of cols replaced as by ``average_rank_share``; other columns together name a row, by among them.

    All columns go in one melt. Ranks come from counts of the values that differ, which are made before they are shuffled:
    a running sum within each bucket of values and one over the buckets, so that a group of any size, or one that shares a
    value, is no single task's. Rows meet their shares by value and come together again: as many shuffles for one column as
    for many. Values that are null stay null; groups (by) are never null.
    """
    rest = [c for c in df.columns if c not in cols]
    melted = df.select(*rest, F.posexplode(F.array(*(F.col(c).cast("double") for c in cols))).alias("_c", "_v"))
    counts = melted.where("_v IS NOT NULL").groupBy(*by, "_c", "_v").agg(F.count("*").alias("_n"))
    cuts = counts.groupBy("_c").agg(F.array_distinct(F.percentile_approx("_v", F.array(*(F.lit(k / buckets) for k in range(1, buckets))), 20 * buckets)).alias("_cuts"))
    # One row for each of cols.
    counts = counts.join(F.broadcast(cuts), "_c").withColumn("_bucket", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
    own, whole = Window.partitionBy(*by, "_c", "_bucket"), Window.partitionBy(*by, "_c")
    upto = lambda w, order: w.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = counts.groupBy(*by, "_c", "_bucket").agg(F.sum("_n").alias("_k"))
    totals = totals.select(*by, "_c", "_bucket", (F.sum("_k").over(upto(whole, "_bucket")) - F.col("_k")).alias("_before"), F.sum("_k").over(whole).alias("_all"))
    placed = counts.withColumn("_below", F.sum("_n").over(upto(own, "_v")) - F.col("_n")).join(totals, [*by, "_c", "_bucket"])
    share = (F.col("_before") + F.col("_below") + 1 + (F.col("_n") - 1) / 2) / F.col("_all") - 0.5
    joined = melted.join(placed.select(*by, "_c", "_v", share.alias("_share")), [*by, "_c", "_v"], "left")
    out = joined.groupBy(*rest).agg(*(F.max(F.when(F.col("_c") == k, F.col("_share"))).alias(c) for k, c in enumerate(cols)))
    return out.select(*df.columns)


def resolved_labels(df: DataFrame, key: str, manual: str, date: str, tie: str) -> DataFrame:
    """One row per key: a manual one before others, then the newest, then the largest tie-break."""
    order = Window.partitionBy(key).orderBy(F.desc(manual), F.desc_nulls_last(date), F.desc(tie))
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
