"""Slices of time, so that what runs along time within a key is no single task's work, whatever the key's share of rows.

Time is cut at quantiles of all rows. A key's rows of one slice are worked on alone; what a slice needs from those before it
comes along in a small table of carries, of a row per key and slice at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices that time is cut into.
SLICES = 256


def with_slices(df: DataFrame, time: str, n: int = SLICES, out: str = "_slice") -> DataFrame:
    """df with the number of the slice of each row, rising with time; rows without a time are in the first.

    The cuts are quantiles by a sketch: one row, which an aggregation with partial results makes and which every task gets.
    Equal times share a slice. A cut's place follows the rows, but no result does: any cuts give the same.
    """
    cuts = df.agg(F.percentile_approx(time, F.array(*(F.lit(k / n) for k in range(1, n))), 20 * n).alias("_cuts"))
    cuts = cuts.select(F.array_distinct(F.coalesce("_cuts", F.array().cast(df.select(F.array(time)).schema[0].dataType))).alias("_cuts"))
    below = F.size(F.filter("_cuts", lambda c: c < F.col(time)))
    return df.crossJoin(F.broadcast(cuts)).withColumn(out, F.coalesce(below, F.lit(0))).drop("_cuts")


def carried(df: DataFrame, keys: list[str], values: dict[str, Column], forward: bool = False, slice_col: str = "_slice") -> DataFrame:
    """(keys, slice, values): what comes into each slice that a key has rows in from the slices before (after it, if forward).

    values: aggregates that give a slice's own contribution, null where it has none; the nearest that isn't null is carried.
    """
    own = df.groupBy(*keys, slice_col).agg(*(c.alias(name) for name, c in values.items()))
    order = Window.partitionBy(*keys).orderBy(F.desc(slice_col) if forward else F.asc(slice_col)).rowsBetween(Window.unboundedPreceding, -1)
    return own.select(*keys, slice_col, *(F.last(name, ignorenulls=True).over(order).alias(name) for name in values))


def filled(df: DataFrame, keys: list[str], time: str, signals: dict[str, Column], n: int = SLICES) -> DataFrame:
    """df with each signal's newest value that isn't null so far, by name; a key's rows are dealt over slices of time.

    Times of a key should differ. The slice's own newest comes first, else what is carried into it."""
    names = list(signals)
    df = with_slices(df.withColumns({f"_own_{k}": c for k, c in enumerate(signals.values())}), time, n)
    heads = carried(df, keys, {f"_head_{k}": F.max_by(f"_own_{k}", F.when(F.col(f"_own_{k}").isNotNull(), F.struct(time))) for k in range(len(names))})
    heads = heads.withColumnsRenamed({c: f"_by_{k}" for k, c in enumerate(keys)}).withColumnRenamed("_slice", "_at")
    same = F.col("_slice") == F.col("_at")
    for k, c in enumerate(keys):
        same &= F.col(c).eqNullSafe(F.col(f"_by_{k}"))
    w = Window.partitionBy(*keys, "_slice").orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    df = df.join(heads, same, "left").withColumns({name: F.coalesce(F.last(f"_own_{k}", ignorenulls=True).over(w), F.col(f"_head_{k}")) for k, name in enumerate(names)})
    return df.drop("_slice", "_at", *(f"_own_{k}" for k in range(len(names))), *(f"_head_{k}" for k in range(len(names))), *(f"_by_{k}" for k in range(len(keys))))
