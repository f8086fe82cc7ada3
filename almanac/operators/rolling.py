"""Order statistics over sliding windows, in one pass along each entity.

The values in the window are counts over the ranks of the values that the pass will meet, in a tree of partial sums. A value
enters and leaves, and a place of the order is found, in as many steps as the number of ranks has binary digits, whatever
the window's length.

An entity of very many rows is cut into slices of time. The rows of the window's length before a slice come along, so each
slice is worked on alone; how many rows stand before it is known from counts, without ordering the entity.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.operators.slices import SLICES, with_slices

#: An entity of more rows is cut; slices aim at so many rows, and at four windows at least.
WHOLE, SLICE_ROWS = 100_000, 25_000


class Ranks:
    """Counts over the ranks of sorted values that all differ."""

    def __init__(self, values: np.ndarray) -> None:
        self.values, self.n = values, 0
        self.tree, self.top = [0] * (len(values) + 1), 1 << len(values).bit_length() >> 1

    def change(self, rank: int, by: int) -> None:
        self.n += by
        at, tree = rank + 1, self.tree
        while at < len(tree):
            tree[at] += by
            at += at & -at

    def up_to(self, rank: int) -> int:
        """How many stand at this rank or below."""
        at, n, tree = rank + 1, 0, self.tree
        while at:
            n += tree[at]
            at &= at - 1
        return n

    def at(self, place: int) -> float:
        """The value at a place of the order, from 0."""
        rank, step, tree = 0, self.top, self.tree
        while step:
            if rank + step < len(tree) and tree[rank + step] <= place:
                rank += step
                place -= tree[rank]
            step >>= 1
        return float(self.values[rank])

    def median(self) -> float:
        return (self.at((self.n - 1) // 2) + self.at(self.n // 2)) / 2

    def deviation(self, place: int, centre: float, below: int) -> float:
        """The distance from the centre at a place of their order; ``below`` values lie under the centre.

        Distances rise on either side of it, so how many of the nearest lie below is found by halving."""
        left, right = max(0, place + 1 - (self.n - below)), min(below, place + 1)
        while left < right:
            k = (left + right) // 2  # k from below, the others from above: too few from below?
            other = place - k
            if other >= 0 and below + other < self.n and centre - self.at(below - 1 - k) < self.at(below + other) - centre:
                left = k + 1
            else:
                right = k
        found = [centre - self.at(below - left)] if left else []
        if place + 1 - left:
            found.append(self.at(below + place - left) - centre)
        return max(found)

    def mad(self) -> float:
        """Median absolute deviation from the median, unscaled."""
        centre = self.median()
        below = self.up_to(int(np.searchsorted(self.values, centre, side="left")) - 1) if self.n else 0
        return (self.deviation((self.n - 1) // 2, centre, below) + self.deviation(self.n // 2, centre, below)) / 2


def bands(shares: tuple[float, ...]) -> Callable:
    """Of the window before each row: how many values, those at the floor of each share of n - 1, and how many are not above
    the row's own. Nulls are no values; a row without one has none that aren't above."""

    def pass_over(values: np.ndarray, window: int, first: int):
        known = ~np.isnan(values)
        kinds = np.unique(values[known])
        rank = np.searchsorted(kinds, np.where(known, values, kinds[0] if len(kinds) else 0))
        held, out = Ranks(kinds), [[], *([] for _ in shares), []]
        for k in range(len(values)):
            if k > window and known[k - window - 1]:
                held.change(int(rank[k - window - 1]), -1)
            if k and known[k - 1]:
                held.change(int(rank[k - 1]), 1)
            if k >= first:
                out[0].append(held.n)
                for j, q in enumerate(shares):
                    out[j + 1].append(held.at(int(q * (held.n - 1))) if held.n else None)
                out[-1].append(held.up_to(int(rank[k])) if known[k] else 0)
        return [pa.array(out[0], pa.int64()), *(pa.array(o, pa.float64()) for o in out[1:-1]), pa.array(out[-1], pa.int64())]

    return pass_over


def distinct_spread(values: np.ndarray, window: int, first: int):
    """Of the window up to each row: how many different values, their median and their median deviation from it."""
    known = ~np.isnan(values)
    kinds = np.unique(values[known])
    rank = np.searchsorted(kinds, np.where(known, values, kinds[0] if len(kinds) else 0))
    held, times, out = Ranks(kinds), [0] * len(kinds), [[], [], []]
    for k in range(len(values)):
        for at, by in ((k, 1), (k - window, -1)):
            if at >= 0 and known[at]:
                r = int(rank[at])
                times[r] += by
                if times[r] == (by > 0):
                    held.change(r, by)
        if k >= first:
            out[0].append(held.n)
            out[1].append(held.median() if held.n else None)
            out[2].append(held.mad() if held.n else None)
    return [pa.array(out[0], pa.int64()), *(pa.array(o, pa.float64()) for o in out[1:])]


def _sliced(df: DataFrame, by: list[str], date: str, window: int) -> DataFrame:
    """df with _slice and _head: entities of many rows in slices, with the rows before a slice that its windows reach."""
    sizes = df.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") > max(WHOLE, 8 * window))
    most = sizes.agg(F.max("_n")).first()[0]
    if most is None:
        return df.withColumns({"_slice": F.lit(0), "_head": F.lit(False)})
    n = int(min(SLICES, max(2, most // max(SLICE_ROWS, 4 * window))))
    hot = sizes.select(*(F.col(c).alias(f"_{c}") for c in by), F.lit(True).alias("_hot"))
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    # Hot entities are no more than the rows over WHOLE; beyond some number they are left to Spark's own size estimate.
    hot = F.broadcast(hot) if hot.count() <= WHOLE else hot
    df = with_slices(df.join(hot, same, "left").drop(*(f"_{c}" for c in by)), date, n).withColumn("_slice", F.when(F.col("_hot"), F.col("_slice")).otherwise(0))
    last = F.row_number().over(Window.partitionBy(*by, "_slice").orderBy(F.desc(date)))
    tails = df.where("_hot").withColumn("_last", last).where(F.col("_last") <= window)
    own = df.where("_hot").groupBy(*by, "_slice").agg(F.count("*").alias("_k"))
    end = F.sum("_k").over(Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0))
    starts = own.withColumn("_end", end).groupBy(*by).agg(F.collect_list(F.struct("_slice", "_k", "_end")).alias("_starts")).withColumnsRenamed({c: f"_{c}" for c in by})
    tails = tails.join(starts, same)
    place = F.get(F.filter("_starts", lambda s: s["_slice"] == F.col("_slice")), F.lit(0))["_end"] - F.col("_last")
    later = F.filter("_starts", lambda s: (s["_slice"] > F.col("_slice")) & (s["_end"] - s["_k"] <= F.col("_place") + window))
    heads = tails.withColumn("_place", place).withColumn("_slice", F.explode(F.transform(later, lambda s: s["_slice"])))
    columns = [c for c in df.columns if c not in ("_slice", "_hot")]
    return df.select(*columns, "_slice", F.lit(False).alias("_head")).unionByName(heads.select(*columns, "_slice", F.lit(True).alias("_head")))


def rolled(df: DataFrame, by: list[str], date: str, value: str, window: int, pass_over: Callable, schema: str) -> DataFrame:
    """df with the columns of ``schema`` that pass_over(values, window, first) makes for the rows from ``first`` on.

    values: an entity's in the order of dates, nulls as NaN. A task holds one entity, or one slice of it and a window's rows
    before. Dates of an entity should differ; rows of one date stand in any order. No rows give none.
    """
    inner = [c for c in df.columns]
    rows = _sliced(df.withColumn("_v", F.col(value).cast("double")), by, date, window)
    rows = rows.repartition(*by, "_slice") if by else rows.repartition("_slice")
    rows = rows.withColumn("_key", F.to_json(F.struct(*by, "_slice"), {"ignoreNullFields": "false"}))
    rows = rows.sortWithinPartitions("_key", F.desc("_head"), date).select(*inner, "_v", "_head", "_key")

    def run(batches):
        held, key = [], None

        def done():
            table = pa.Table.from_batches(held)
            first = int(np.count_nonzero(table.column("_head").to_numpy()))
            made = pass_over(table.column("_v").to_numpy(), window, first)
            kept = table.select(inner).slice(first).combine_chunks()
            for name, column in zip(names, made, strict=True):
                kept = kept.append_column(name, column)
            return kept.to_batches(max_chunksize=10_000)

        for batch in batches:
            keys = batch.column("_key").to_pylist()
            cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if keys[a] != key and held:
                    yield from done()
                    held = []
                key = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from done()

    names = [c.split()[0] for c in schema.split(", ")]
    full = df.sparkSession.createDataFrame([], schema).schema.fields
    return rows.mapInArrow(run, df.schema.__class__([*df.schema.fields, *full]))
