"""Point-in-time reads of revised data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["series_id", "observation_period"]


def as_of(vintages: DataFrame, cut: str, key: list[str] = KEY, tie: tuple[str, ...] = ("revision_number",)) -> DataFrame:
    """The newest vintage of each key that was available at the cut."""
    order = Window.partitionBy(*key).orderBy(F.desc("available_at"), *(F.desc(t) for t in tie))
    return vintages.where(F.col("available_at") <= F.lit(cut).cast("timestamp")).withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def validity(vintages: DataFrame, mode: str = "latest", key: list[str] = KEY, tie: tuple[str, ...] = ("revision_number",)) -> DataFrame:
    """vintages with valid_from and valid_to (exclusive, null for ever): when a row is the one an as-of read returns.

    One window over the store answers every cut; first_release keeps only the first row of a key.
    """
    order = Window.partitionBy(*key).orderBy("available_at", *tie)
    if mode == "first_release":
        return vintages.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n").select("*", F.col("available_at").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    rows = vintages.select("*", F.col("available_at").alias("valid_from"), F.lead("available_at").over(order).alias("valid_to"))
    return rows.where("valid_to IS NULL OR valid_from < valid_to")


def panel(vintages: DataFrame, calendar: DataFrame, cut: str, mode: str = "latest") -> DataFrame:
    """A row per calendar date and key that had a vintage by then, the one valid at the date.

    The interval's months are exploded, so the range join is an equi-join on the month. An open interval ends with the calendar.
    """
    last = calendar.agg(F.max(cut).alias("_last"), F.min(cut).alias("_first"))
    rows = validity(vintages, mode).crossJoin(F.broadcast(last)).where(F.col("valid_from").cast("date") <= F.col("_last"))
    upto, since = F.least(F.coalesce(F.col("valid_to").cast("date"), F.col("_last")), F.col("_last")), F.greatest(F.col("valid_from").cast("date"), F.col("_first"))
    rows = rows.where(since <= upto).withColumn("_m", F.explode(F.sequence(F.trunc(since, "month"), F.trunc(upto, "month"), F.expr("INTERVAL 1 MONTH"))))
    joined = rows.join(calendar.withColumn("_m", F.trunc(cut, "month")), "_m")
    at = F.col(cut).cast("timestamp")
    return joined.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))).drop("_m", "_last", "_first")


def leak_probe(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows and order-free digests of two reads as of one cut, and whether they are the same."""
    digest = lambda df, p: df.agg(F.count("*").alias(f"{p}_rows"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias(f"{p}_hash"))
    both = digest(before, "before").crossJoin(digest(after, "after"))
    return both.select("before_rows", "after_rows", ((F.col("before_rows") == F.col("after_rows")) & F.col("before_hash").eqNullSafe(F.col("after_hash"))).alias("same"))


def store_checks(vintages: DataFrame, key: list[str] = KEY) -> DataFrame:
    """One row: rows, rows beyond the first of their key and vintage date, and rows available before their vintage date."""
    early = F.col("available_at").cast("date") < F.col("vintage_date")
    each = vintages.groupBy(*key, "vintage_date").agg(F.count("*").alias("n"), F.count_if(early).alias("early"))
    return each.agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicate_keys"), F.sum("early").alias("available_early"))


def coverage(vintages: DataFrame, cut: str) -> DataFrame:
    """(series_id, rows, spans of observation and vintage dates, selected_later): per series of a store, and how many
    observations later than the cut's day a read as of the cut selects, which a sound store has none of."""
    spans = vintages.groupBy("series_id").agg(F.count("*").alias("rows"), *(f(c).alias(f"{n}_{end}") for n, c in (("observation", "observation_period"), ("vintage", "vintage_date")) for end, f in (("min", F.min), ("max", F.max))))
    later = as_of(vintages, cut).groupBy("series_id").agg(F.count_if(F.col("observation_period") > F.lit(cut).cast("date")).alias("_later"))
    return spans.join(later, "series_id", "left").withColumn("selected_later", F.coalesce("_later", F.lit(0))).drop("_later")


def merged(batches: list[DataFrame], key: list[str]) -> DataFrame:
    """Union of vintage batches; the last batch wins per key."""
    every = None
    for k, batch in enumerate(batches):
        batch = batch.withColumn("_batch", F.lit(k))
        every = batch if every is None else every.unionByName(batch)
    order = Window.partitionBy(*key).orderBy(F.desc("_batch"))
    return every.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_batch")


def revisions(vintages: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Rows whose value differs from the key's value before, with the change."""
    order = Window.partitionBy(*key).orderBy("vintage_date")
    return vintages.withColumn("delta", F.col("value") - F.lag("value").over(order)).where("delta <> 0")
