"""Exact top-k inner products by block-at-a-time pruning.

Components are terms, each with a sign. Vectors are dealt into parts, ranges of documents; within a part they stand in the
order of their ids, and each BLOCK of them keeps the largest and the least value of every component, as the part does as a
whole. The sum over a query's components of the better of the two products bounds every score in the block, or in the part.
Blocks are scored in the order of these bounds, through their own rows, until the next bound falls below the query's k-th
score.

The k-th score is shared: a query first meets the part of the highest bound, and what is then its k-th score goes along to
the other parts whose bound reaches it, and to no others; there only rows that reach it count. A part's best then meet the
other parts' in one ranked window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import checkpointed

#: Rows a part aims at, rows of a block, and numbers of the parts' bounds that are sent to the tasks at once.
PART, BLOCK, SENT = 16384, 64, 8_000_000
SCALE = 64
#: A k-th score that every score reaches.
NONE = -(1 << 62)


def quantise(vec, scale: int = SCALE):
    """floor(scale * x) of each component, as integers."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def usable(vec):
    """Not null, and with only finite components; an empty vector has no other."""
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0), np.int64)
    # Products of doubles are exact below 2**53, and much faster.
    return out.astype(np.float64) if out.size and float(np.abs(flat).max()) ** 2 * out.shape[1] < 2**52 else out


class Part:
    """Rows of one length, in blocks."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.copies, self.rows = ids[order], copies[order], rows[order]
        self.starts = np.arange(0, len(rows), BLOCK)
        self.high, self.low = (f.reduceat(self.rows, self.starts) for f in (np.maximum, np.minimum))
        self.met = self.scored = 0

    def best(self, own: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
        """Yield (ids, scores) of each query: its k best rows of those that reach its floor, ties to the smaller id; one
        row of its own id and vector is left out."""
        rows, starts = self.rows, self.starts
        if rows.dtype != queries.dtype:
            rows, queries = rows.astype(np.int64), queries.astype(np.int64)
        bounds = np.maximum(queries, 0) @ self.high.astype(rows.dtype).T + np.minimum(queries, 0) @ self.low.astype(rows.dtype).T
        by_bound = np.argsort(-bounds, axis=1, kind="stable")
        for q, query in enumerate(queries):
            got_ids, got, floor = np.empty(0, np.int64), np.empty(0, np.int64), int(floors[q])
            line, at, step = bounds[q, by_bound[q]], 0, 1
            while at < len(starts) and line[at] >= floor:
                spans = [slice(starts[b], starts[b] + BLOCK) for b in by_bound[q, at : at + step]]
                scores, ids = np.concatenate([rows[s] @ query for s in spans]), np.concatenate([self.ids[s] for s in spans])
                keep = np.flatnonzero(scores >= floor)
                own_rows = np.flatnonzero(ids[keep] == own[q])
                if len(own_rows):
                    keep = np.delete(keep, own_rows[self._is_own(spans, keep[own_rows], query)])
                got_ids, got = np.concatenate([got_ids, ids[keep]]), np.concatenate([got, scores[keep].astype(np.int64)])
                top = np.lexsort((got_ids, -got))[:k]
                got_ids, got = got_ids[top], got[top]
                if len(got) == k:
                    floor = max(floor, int(got[-1]))
                at, step = at + step, min(64, 2 * step)
            self.met, self.scored = self.met + len(starts), self.scored + min(at, len(starts))
            yield got_ids, got

    def _is_own(self, spans: list[slice], at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Of rows of the query's id, by their place in some blocks put together: the first copy of the query's own."""
        every = np.concatenate([np.arange(s.start, min(s.stop, len(self.ids))) for s in spans])[at]
        return (self.copies[every] == 1) & (self.rows[every] == query).all(axis=1)


def _meet(k: int):
    """Rows of a part, then the queries that meet it: what a task does with its parts, one after another."""

    def run(batches):
        held, key, part = [], None, None
        for batch in batches:
            group = list(zip(batch.column("part").to_pylist(), batch.column("dim").to_pylist(), batch.column("asks").to_pylist(), strict=True))
            cuts = [0, *(n for n in range(1, len(group)) if group[n] != group[n - 1]), len(group)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                own = batch.slice(a, b - a)
                if group[a][:2] != key:
                    key, held, part = group[a][:2], [], None
                if not group[a][2]:
                    held.append(own)
                    continue
                if not held and part is None:
                    continue  # no rows of this length in the part
                if part is None:
                    ids, copies = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("id", "copy"))
                    part, held = Part(ids, copies, _matrix(pa.concat_arrays([x.column("v") for x in held]))), []
                for at in range(0, own.num_rows, 256):
                    some = own.slice(at, 256)
                    found = list(part.best(some.column("id").to_numpy(), _matrix(some.column("v")), some.column("floor").to_numpy(), k))
                    n = [len(x[1]) for x in found]
                    back = [np.repeat(some.column(c).to_numpy(), n) for c in ("id", "copy", "h")]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*back, np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))], ["query_id", "copy", "h", "vec_id", "score"])

    return run


FOUND = "query_id bigint, copy bigint, h bigint, vec_id bigint, score bigint"
BOXES = "part int, dim int, high array<bigint>, low array<bigint>"


def _boxes(batches):
    """Largest and least value of every component, of a task's rows of each part and length."""
    found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        parts, sizes = batch.column("part").to_numpy(), batch.column("dim").to_numpy()
        for part, dim in np.unique(np.stack([parts, sizes]), axis=1).T.tolist():
            own = batch.column("v").take(pa.array(np.flatnonzero((parts == part) & (sizes == dim)))).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if dim else np.zeros((1, 0), np.int64)
            high, low = own.max(axis=0), own.min(axis=0)
            if (part, dim) in found:
                high, low = np.maximum(high, found[part, dim][0]), np.minimum(low, found[part, dim][1])
            found[part, dim] = high, low
    if found:
        keys = list(found)
        yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in keys], pa.int32()) for j in (0, 1)] + [pa.array([found[k][j].tolist() for k in keys], pa.list_(pa.int64())) for j in (0, 1)], ["part", "dim", "high", "low"])


class Boxes:
    """Bounds of parts, by the length of their vectors."""

    def __init__(self, rows) -> None:
        self.by: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for dim in {r.dim for r in rows}:
            own = [r for r in rows if r.dim == dim]
            high, low = (np.array([r[c] for r in own], np.float64).reshape(len(own), dim) for c in ("high", "low"))
            self.by[dim] = np.array([r.part for r in own], np.int32), high, low

    def bounds(self, dim: int, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts, and for each query what no score in them is above; rounding is on the safe side."""
        parts, high, low = self.by.get(dim, (np.empty(0, np.int32), np.empty((0, dim)), np.empty((0, dim))))
        q = queries.astype(np.float64)
        bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        return parts, bound + 1 + 1e-9 * (np.abs(q) @ np.maximum(np.abs(high), np.abs(low)).T)


def _reached(asked: DataFrame, boxes: list, first: bool) -> DataFrame:
    """asked with the part to go to: that of the highest bound (``first``; the bound is then its floor), or each other one
    whose bound reaches the floor."""
    shared = asked.sparkSession.sparkContext.broadcast(Boxes(boxes))

    def run(batches):
        for batch in batches:
            sizes, floors = batch.column("dim").to_numpy(), batch.column("floor").to_numpy()
            own = batch.column("own").to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                for at in range(0, len(rows), 512):
                    some = rows[at : at + 512]
                    parts, bound = shared.value.bounds(dim, _matrix(batch.column("v").take(pa.array(some))))
                    if not len(parts):
                        continue
                    if first:
                        which, where = np.arange(len(some)), parts[bound.argmax(axis=1)]
                    else:
                        which, column = np.nonzero((bound >= floors[some][:, None]) & (parts[None, :] != own[some][:, None]))
                        where = parts[column]
                    if len(which):
                        out = batch.take(pa.array(some[which]))
                        if first:
                            best = np.clip(bound.max(axis=1), -9e18, 9e18).astype(np.int64)
                            out = out.set_column(out.schema.get_field_index("floor"), "floor", pa.array(best))
                        yield out.set_column(out.schema.get_field_index("part"), "part", pa.array(where, pa.int32()))

    return asked.mapInArrow(run, asked.schema)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of vectors for each row of queries, scores as quantise() makes them.

    Rows whose id or vector is null, and vectors that hold null or non-finite components, take no part. Only vectors of a
    query's own length are candidates for it, empty ones for an empty one. A query leaves out one row of its own id and
    vector, if there is one; other rows of its id are candidates like any. Each row of queries has its ranks, also one that
    repeats; of equal rows no more than k + 1 copies are compared, which is all that can be returned. No queries, or no
    candidates, give no rows. Other columns are not read.

    Rows are shuffled into their parts, and with them once more when queries first meet them and when the rest do: a task
    holds one part and streams the queries that can reach it. Which these are tells a table of a bound per part, sent to the
    tasks in pieces of SENT numbers.
    """

    def clean(df, most):
        rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
        rows = rows.select("id", quantise(F.col("v")).alias("v")).groupBy("id", "v").agg(F.count("*").alias("n"))
        n = F.least("n", F.lit(most)) if most else F.col("n")
        return rows.select("id", "v", F.xxhash64("v").alias("h"), F.size("v").alias("dim"), F.explode(F.sequence(F.lit(1).cast("bigint"), n)).alias("copy"))

    rows, asked = clean(vectors, k + 1), checkpointed(clean(queries, None))
    parts = max(1, -(-rows.count() // PART))
    cols = ["part", "dim", "asks", "id", "copy", "h", "v", "floor"]
    # Which part a row is in depends on the run, so it is kept with it.
    rows = checkpointed(rows.repartitionByRange(parts, "id", "h", "copy").withColumn("part", F.spark_partition_id()))
    rows = rows.withColumns({"asks": F.lit(False), "floor": F.lit(NONE)}).select(cols)
    asked = asked.withColumns({"part": F.lit(-1), "own": F.lit(-1), "asks": F.lit(True), "floor": F.lit(NONE)})

    def met(asks: DataFrame) -> DataFrame:
        both = rows.unionByName(asks.select(cols)).repartition("part", "dim").sortWithinPartitions("part", "dim", "asks")
        return both.mapInArrow(_meet(k), FOUND)

    boxes = checkpointed(rows.mapInArrow(_boxes, BOXES))
    width = boxes.agg(F.max("dim")).first()[0] or 1
    pieces = max(1, -(-2 * width * boxes.count() // SENT))
    piece = lambda j: boxes.where(F.pmod(F.col("part"), F.lit(pieces)) == j).collect()
    homes = _reached(asked, piece(0), True)
    for j in range(1, pieces):
        homes = homes.unionByName(_reached(asked, piece(j), True))
    best = F.row_number().over(Window.partitionBy("id", "copy", "h").orderBy(F.desc("floor"), "part"))
    homes = homes.withColumn("_n", best).where("_n = 1").drop("_n") if pieces > 1 else homes
    asked = checkpointed(homes.withColumns({"own": F.col("part"), "floor": F.lit(NONE)}))
    found = checkpointed(met(asked))
    full = found.groupBy(F.col("query_id").alias("id"), "copy", "h").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    asked = asked.drop("floor").join(full, ["id", "copy", "h"], "left").withColumn("floor", F.when(F.col("n") >= k, F.col("least")).otherwise(NONE))
    asked = asked.select("id", "v", "h", "dim", "copy", "part", "own", "asks", "floor")
    for j in range(pieces):
        found = found.unionByName(met(_reached(asked, piece(j), False)))
    place = F.row_number().over(Window.partitionBy("query_id", "copy", "h").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
