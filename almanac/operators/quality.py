"""Cleaning, contracts and comparison of tables."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOW, DEAD_SHARE, STEP = 0.2, 0.5, 5.0
#: Rows that a task repairs at once.
CELLS = 200_000


def _suspects(x: np.ndarray, low: float) -> np.ndarray:
    """Places whose level is low against the median of the positive ones within two rows, all looked at together."""
    wide = np.concatenate([np.full(2, np.nan), np.where(x > 0, x, np.nan), np.full(2, np.nan)])
    around = np.sort(np.stack([wide[k : k + len(x)] for k in (0, 1, 3, 4)]), axis=0)
    n, every = (~np.isnan(around)).sum(axis=0), np.arange(len(x))
    lower, upper = around[np.maximum(n - 1, 0) // 2, every], around[n // 2, every]
    return np.flatnonzero((x > 0) & (n > 0) & (x < np.where(n % 2 == 1, upper, (lower + upper) / 2) * low))


def _repair(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: float = LOW) -> np.ndarray:
    """Levels of entities one after another, each from a start to an end, with transient dips replaced, each from levels
    already repaired before it; NaN is no level.

    A dip can only be where the levels as they came make one, or within two rows after a repair: no other row is walked.
    After each entity stand two NaN at least.
    """
    todo = _suspects(x, low).tolist()  # in order, so a heap
    if not todo:
        return x
    out, last = x.tolist(), -1
    while todo:
        i = heapq.heappop(todo)
        if i == last:
            continue
        last, v = i, out[i]
        around = sorted(out[k] for k in (i - 2, i - 1, i + 1, i + 2) if k >= 0 and out[k] > 0)
        n = len(around)
        if not v > 0 or not n or v >= (ref := (around[(n - 1) // 2] + around[n // 2]) / 2 if n % 2 == 0 else around[n // 2]) * low:
            continue
        at = np.searchsorted(starts, i, "right") - 1
        sides = [next((out[k] for k in ks if out[k] >= ref * low), None) for ks in (range(i - 1, starts[at] - 1, -1), range(i + 1, ends[at]))]
        good = [g for g in sides if g is not None]
        out[i] = math.exp(sum(map(math.log, good)) / len(good)) if good else ref
        for k in range(i + 1, min(i + 3, ends[at])):
            heapq.heappush(todo, k)
    return np.array(out)


def _left_alone(p: np.ndarray) -> bool:
    """Whether ``series_flags`` calls a series of these positive levels dead or stepped; NaN is the largest, as in Spark."""
    n, top = len(p), p.max(initial=0.0)
    if not n:
        return False
    if (~np.isnan(p) if np.isnan(top) else p < top * LOW).sum() >= DEAD_SHARE * n:
        return True
    if n < 6:
        return False
    third = n // 3
    middle = lambda v: v[(third - 1) // 2] * 0.5 + v[third // 2] * 0.5
    with np.errstate(all="ignore"):
        head, tail = middle(np.sort(p[:third])), middle(np.sort(p[n - third :]))
        return not (head / tail < STEP and tail / head < STEP)


def repaired(df: DataFrame, key: str, date: str, level: str) -> DataFrame:
    """df (key, date, level) with the level repaired and repaired flagged; dead and stepped series are left as they are.

    A repair uses repaired neighbours, so an entity is walked in order, but only where a dip may be. A task streams its
    entities in the order of their keys, and looks at those of some CELLS rows at once.
    """
    names = [key, date, level, "repaired"]

    def fixed(rows: pa.Table) -> pa.RecordBatch:
        keys, dates, levels = (c.combine_chunks() for c in rows.columns)
        n, raw = len(keys), levels.to_numpy(zero_copy_only=False).astype(float)
        first = np.flatnonzero(np.concatenate([[True], pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)]))
        last, order = np.append(first[1:], n), np.arange(len(first)) * 2
        place = np.arange(n) + np.repeat(order, last - first)
        x = np.full(n + 2 * len(first), np.nan)
        x[place] = raw
        given, undated = levels.is_valid().to_numpy(zero_copy_only=False), dates.is_null().to_numpy(zero_copy_only=False)
        stays = np.zeros(len(x), dtype=bool)
        for a, b, k in zip(first, last, order, strict=True):
            part = np.arange(a, b)
            if undated[b - 1]:  # as series_flags orders them
                part = np.concatenate([part[undated[a:b]], part[~undated[a:b]]])
            own = raw[part][given[part]]
            stays[a + k : b + k] = _left_alone(own[(own > 0) | np.isnan(own)])
        new = _repair(np.where(stays, np.nan, x), first + order, last + order)
        new = np.where(stays, x, new)[place]
        return pa.RecordBatch.from_arrays([keys, dates, pa.array(new, pa.float64(), from_pandas=True), pa.array((new != raw) & ~np.isnan(raw))], names)

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < CELLS or not batch.num_rows:
                continue
            whole = pa.Table.from_batches(held)
            own = whole.column(0).combine_chunks()
            ends = np.flatnonzero(pc.not_equal(own[1:], own[:-1]).to_numpy(zero_copy_only=False))
            if len(ends):
                yield fixed(whole.slice(0, ends[-1] + 1))
                held = whole.slice(ends[-1] + 1).to_batches()
                size = sum(b.num_rows for b in held)
        if size:
            yield fixed(pa.Table.from_batches(held))

    kinds = dict(df.dtypes)
    rows = df.where(F.col(key).isNotNull()).select(key, date, F.col(level).cast("double").alias(level)).repartition(key).sortWithinPartitions(key, F.asc_nulls_last(date))
    return rows.mapInArrow(run, f"{key} {kinds[key]}, {date} {kinds[date]}, {level} double, repaired boolean")


def series_flags(df: DataFrame, key: str, date: str, level: str, dead_share: float = DEAD_SHARE, step: float = STEP) -> DataFrame:
    """(key, dead, step): half of the positive levels near zero against the peak; medians of the first and last thirds apart."""
    positive = F.when(F.col(level) > 0, F.col(level))
    w = Window.partitionBy(key)
    rows = df.withColumn("_p", positive).withColumn("_top", F.max("_p").over(w)).withColumn("_n", F.count("_p").over(w))
    rows = rows.withColumn("_k", F.when(F.col("_p").isNotNull(), F.row_number().over(Window.partitionBy(key, F.col("_p").isNull()).orderBy(date))))
    third = F.floor(F.col("_n") / 3)
    head, tail = F.median(F.when(F.col("_k") <= third, F.col("_p"))), F.median(F.when(F.col("_k") > F.col("_n") - third, F.col("_p")))
    ratio = F.greatest(head / F.nullif(tail, F.lit(0.0)), tail / F.nullif(head, F.lit(0.0)))
    dead = F.count_if(F.col("_p") < F.col("_top") * LOW) >= dead_share * F.count("_p")
    return rows.groupBy(key).agg(F.coalesce(dead & (F.count("_p") > 0), F.lit(False)).alias("dead"), F.coalesce((F.count("_p") >= 6) & (ratio >= step), F.lit(False)).alias("step"))


def impossible_moves(df: DataFrame, key: str, date: str, level: str) -> DataFrame:
    """(key, moves): log moves beyond one between neighbouring positive levels."""
    r = F.ln(F.col(level) / F.lag(level).over(Window.partitionBy(key).orderBy(date)))
    return df.where(F.col(level) > 0).withColumn("_r", r).groupBy(key).agg(F.count_if(F.abs("_r") > 1).alias("moves"))


@dataclass(frozen=True)
class TableSpec:
    """What a table must hold: its key, its columns by kind, and the date no row may lie beyond."""

    key: tuple[str, ...]
    numbers: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    booleans: tuple[str, ...] = ()
    as_of: str | None = None
    required: tuple[str, ...] = field(default=())


def normalise(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Strings to typed columns; what can't be read is null."""
    yes, no = ("true", "t", "1", "yes"), ("false", "f", "0", "no")
    cols = {c: F.expr(f"try_cast(replace(cast(`{c}` AS string), ',', '') AS double)") for c in spec.numbers}
    cols |= {c: F.expr(f"try_cast(cast(`{c}` AS string) AS date)") for c in spec.dates}
    cols |= {c: F.when(F.lower(F.col(c).cast("string")).isin(*yes), True).when(F.lower(F.col(c).cast("string")).isin(*no), False) for c in spec.booleans}
    return df.withColumns(cols)


def violations(df: DataFrame, spec: TableSpec, as_of: str) -> DataFrame:
    """(key columns, problem) of a raw table: null keys, unreadable values, rows after the date, repeated keys."""
    missing = [c for c in (*spec.key, *spec.required) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    typed = normalise(df.withColumns({f"_raw_{c}": F.col(c) for c in (*spec.numbers, *spec.dates, *spec.booleans)}), spec)
    found = [F.when(F.col(c).isNull(), f"null_key:{c}") for c in spec.key]
    found += [F.when(F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull(), f"bad_value:{c}") for c in (*spec.numbers, *spec.dates, *spec.booleans)]
    if spec.as_of:
        found.append(F.when(F.col(spec.as_of) > F.lit(as_of).cast("date"), "after_as_of"))
    keys = [F.col(c).cast("string").alias(c) for c in spec.key]
    rows = typed.select(*keys, F.explode(F.array_compact(F.array(*found))).alias("problem"))
    twice = df.select(*keys).groupBy(*spec.key).count().where("count > 1").select(*spec.key, F.lit("duplicate_key").alias("problem"))
    return rows.unionByName(twice)


def table_hash(df: DataFrame, digits: int = 9) -> DataFrame:
    """One row: rows and a digest that no order changes. Doubles are rounded, NaN counts as null, infinities as words."""
    clean = [F.when(F.isnan(c) | F.col(c).isNull(), None).when(F.abs(c) == float("inf"), F.col(c).cast("string")).otherwise(F.round(c, digits).cast("string")) if t == "double" else F.col(c).cast("string") for c, t in sorted(df.dtypes)]
    row = F.sha2(F.to_json(F.struct(*(c.alias(f"c{k}") for k, c in enumerate(clean)))), 256)
    part = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.sum(part).alias("digest"))


def differences(left: DataFrame, right: DataFrame, key: list[str], value: str, tolerance: float = 0.0) -> DataFrame:
    """(key, kind, gap): missing, unexpected and mismatched rows of right against left, and repeated keys of either."""
    one = lambda df, n: df.groupBy(*key).agg(F.max(value).alias(n), F.count("*").alias(f"{n}_n"))
    both = one(left, "_l").join(one(right, "_r"), key, "full_outer")
    gap = F.abs(F.col("_l") - F.col("_r"))
    kind = F.when(F.col("_r_n").isNull(), "missing").when(F.col("_l_n").isNull(), "unexpected").when((F.col("_l_n") > 1) | (F.col("_r_n") > 1), "duplicate").when(~F.col("_l").eqNullSafe(F.col("_r")) & (gap.isNull() | (gap > tolerance)), "mismatch")
    return both.withColumn("kind", kind).where("kind IS NOT NULL").select(*key, "kind", gap.alias("gap"))


def equal_both_ways(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, n): rows of either table that the other lacks, with multiplicity."""
    right = right.select(left.columns)
    one = lambda df, s: df.agg(F.lit(s).alias("side"), F.count("*").alias("n"))
    return one(left.exceptAll(right), "left").unionByName(one(right.exceptAll(left), "right"))
