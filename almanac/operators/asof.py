"""As-of and interval joins, without range conditions over whole keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.operators.slices import SLICES, carried, filled, with_slices


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, values: list[str], tie: list[str] | None = None, forward: bool = False, slices: int = 0) -> DataFrame:
    """left with the values of the right row of its key that is newest at or before its time (first at or after it, if forward).

    Both sides are unioned and filled along the time order: one shuffle on the key and no range join. The whole right row
    is carried, so a null in it stays null and no older row is looked for. Of right rows of one time the last by ``tie``
    (the first, if forward). Times that are null come before all others. Without keys in ``on`` all rows are of one.

    With ``slices`` a key's rows are dealt over so many slices of time, for keys that may hold very many rows: each slice is
    filled on its own, and the last right row of the slices before it stands at its head. Both ways give the same rows.
    """
    row = F.struct(*(F.col(c).alias(f"v{k}") for k, c in enumerate(values)))
    order_tie = F.struct(*(tie or [F.lit(0).alias("_0")]))
    a = left.select(*(F.col(c).alias(f"k{k}") for k, c in enumerate(on)), F.col(left_time).alias("t"), F.lit(0 if forward else 1).alias("side"), F.struct(*left.columns).alias("l"))
    b = right.select(*(F.col(c).alias(f"k{k}") for k, c in enumerate(on)), F.col(right_time).alias("t"), F.lit(1 if forward else 0).alias("side"), row.alias("r"), order_tie.alias("tie"))
    both = a.unionByName(b, allowMissingColumns=True)
    keys = [f"k{k}" for k in range(len(on))]
    order = [F.asc("t"), F.asc("side"), F.asc("tie")] if not forward else [F.desc("t"), F.desc("side"), F.desc("tie")]
    if slices:
        both = with_slices(both, "t", slices)
        last = (F.min_by if forward else F.max_by)("r", F.when(F.col("r").isNotNull(), F.struct("t", "tie")))
        heads = carried(both, keys, {"r": last}, forward).where("r IS NOT NULL").withColumn("head", F.lit(True))
        both = both.unionByName(heads, allowMissingColumns=True)
        keys, order = [*keys, "_slice"], [F.asc_nulls_last("head"), *order]
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("r", F.last("r", ignorenulls=True).over(window)).where("l IS NOT NULL")
    return filled.select("l.*", *(F.col(f"r.v{k}").alias(c) for k, c in enumerate(values)))


def fill_onto_spine(spine: DataFrame, series: DataFrame, date: str, values: list[str], by: list[str] | None = None, slices: int = SLICES) -> DataFrame:
    """Spine dates with each value carried forward from its last known date; null before the first.

    Unlike an as-of join each value is filled on its own. Dates of the series that the spine lacks count for it. A spine is
    often one series of all dates, so it is filled in ``slices`` of time (0: in one piece per key of ``by``), each value's
    last known one of the slices before coming along.
    """
    by = by or []
    both = spine.select(*by, date, F.lit(1).alias("_s")).unionByName(series.select(*by, date, *values), allowMissingColumns=True)
    daily = both.groupBy(*by, date).agg(F.max("_s").alias("_s"), *(F.max(v).alias(v) for v in values))
    if slices:
        own = {v: f"_v{k}" for k, v in enumerate(values)}
        return filled(daily.withColumnsRenamed(own), by, date, {v: F.col(o) for v, o in own.items()}, slices).where("_s = 1").select(*by, date, *values)
    w = Window.partitionBy(*by).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(*by, date, "_s", *(F.last(v, ignorenulls=True).over(w).alias(v) for v in values)).where("_s = 1").drop("_s")


def interval_slices(targets: DataFrame, series: DataFrame, key: str, as_of: str, date: str, months: int) -> DataFrame:
    """Rows of series with lo < date <= as_of for each target, lo = as_of less ``months``.

    Both sides carry the calendar month, a target once for each month it reaches, so the join is an equi-join on key and month.
    """
    lo = F.add_months(F.col(as_of), -months)
    t = targets.select(key, as_of, F.explode(F.sequence(F.trunc(lo, "month"), F.trunc(as_of, "month"), F.expr("INTERVAL 1 MONTH"))).alias("_m"))
    s = series.withColumn("_m", F.trunc(date, "month"))
    return t.join(s, [key, "_m"]).where((F.col(date) > lo) & (F.col(date) <= F.col(as_of))).drop("_m")


def first_match(left: DataFrame, lookups: list[tuple[Column, DataFrame, str, str]], out: str) -> DataFrame:
    """left with the first non-null value over lookups tried in order, each (left expression, table, key, value)."""
    found = []
    for k, (expr, table, key, value) in enumerate(lookups):
        small = table.groupBy(F.col(key).alias(f"_k{k}")).agg(F.min(value).alias(f"_v{k}"))
        left = left.withColumn(f"_x{k}", expr)
        left = left.join(small, F.col(f"_x{k}") == F.col(f"_k{k}"), "left")
        found.append(f"_v{k}")
    extra = [c for k in range(len(lookups)) for c in (f"_x{k}", f"_k{k}", f"_v{k}")]
    return left.withColumn(out, F.coalesce(*found)).drop(*extra)
