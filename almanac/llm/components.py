"""Connected components of a distributed edge table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import checkpointed, spread_join

#: Tasks over which the edges of one node are dealt at most.
SALTS = 256


class Forest:
    """Union-find whose root is the least member."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up, top = self.up, x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            x, up[x] = up.get(x, x), top
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def contract(batches):
    """Stars that connect what a partition's edges connect; at most one edge a node remains."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
    nodes = list(forest.up)
    for at in range(0, len(nodes), 65536):
        part = nodes[at : at + 65536]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([forest.root(x) for x in part], pa.int64())], ["u", "v"])


def components(edges: DataFrame, contracted: bool = False) -> DataFrame:
    """(node, component) for every node of the edges (u, v), both bigint; a component is named by its least node.

    Each partition first contracts its own edges (contracted: this has been done), then stars are rewired (large star,
    small star: every node hooks its larger, then its smaller neighbours to the least one it sees) until nothing moves. A
    round is two aggregations with partial sums and two joins, in which the edges of a node with very many neighbours are
    dealt by a hash of the neighbour as well, so that a hub is no single task's load. A round moves edges alone, at most
    one a node and partition. Edges of a node to itself and repeated edges don't matter; no edges give no rows.
    """
    edges = edges.select("u", "v").where("u <> v")
    edges = checkpointed((edges if contracted else edges.mapInArrow(contract, "u bigint, v bigint")).distinct())
    salt, seen = F.pmod(F.xxhash64("v"), F.lit(SALTS)), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == (state.n, state.h):
            break
        seen = (state.n, state.h)
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = spread_join(both.where("v > u"), "u", salt, least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = spread_join(large, "u", salt, least).select("v", "m").where("v <> m").toDF("u", "v")
        edges = checkpointed(hooked.union(least.toDF("u", "v")).distinct())
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").union(edges.select("v", "v").distinct())
