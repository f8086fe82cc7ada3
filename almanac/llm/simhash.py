"""SimHash near-duplicates, linked exactly in the shards of four trees, one of which is a vantage-point tree with reach.

A fingerprint is 64 majority bits over the XXH64 hashes of a text's word shingles. Of two fingerprints that differ in at
most four bits, either the first of the four 16-bit words differs in at most one bit or another word is equal: else the
words would differ in 2 + 1 + 1 + 1 bits. So each word position has its own vantage-point tree over the 65,536 word values,
with reach one for the first word and none for the others, which makes theirs buckets of equal words: a node splits at a Hamming radius around its vantage point, and
a value that the triangle bound cannot assign to one side, within half the reach of the radius, goes to both. Any two
values within reach share a leaf. A leaf of a tree is a shard of the fingerprints, where whole fingerprints are compared
exactly. The trees depend on no data; only their depth follows the count of fingerprints.

Trees over whole fingerprints would prune nothing: unlike texts differ in 32 bits or so, give or take four, and four bits
on either side of any radius there hold most fingerprints. Words keep the copies few: between 5 and 17 of a fingerprint.

Shards give spanning forests of their links, never all pairs; a distributed component search joins the forests.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import checkpointed, release, sliced, spread_join
from almanac.llm.components import components, contract

SEED, SHINGLE, RADIUS = 42, 4, 4
#: Bits that a word may differ in, by position; one more for each word than RADIUS in all, so that one always holds.
REACH = (1, 0, 0, 0)
WORDS, VALUES = len(REACH), 1 << 16
#: Mean fingerprints a shard aims at, and the most that one task compares at once.
SHARD, CHUNK = 256, 8192
#: Tasks over which the fingerprints of one component are dealt at most, and ids up to which they are broadcast (8 bytes each).
SALTS, FEW = 256, 2_000_000


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of a whole text, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    data, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < width:
        return np.array([digest(data, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    return np.array([digest(data[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The majority bits, as a signed 64-bit integer."""
    hashes = shingle_hashes(text, width)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(id, fp) per row of docs; a null text counts as empty."""

    def run(batches):
        release()
        for batch in sliced(batches):
            fps = [fingerprint(x, width) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t")).mapInArrow(run, "id bigint, fp bigint")


@lru_cache(maxsize=4)
def tree(depth: int, reach: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Where each 16-bit value goes: leaves[start[v]:start[v + 1]]. At most ``depth`` splits on a path; values that differ in
    reach (none or one) bits share a leaf."""
    rng = np.random.default_rng(7)
    level = [np.arange(VALUES, dtype=np.uint16)]
    for _ in range(depth):
        below = []
        for values in level:
            best = None
            for vantage in rng.choice(values, min(4, len(values)), replace=False):
                far = np.bitwise_count(values ^ vantage)
                for radius in {int(np.median(far)), max(0, int(np.median(far)) - 1)}:
                    inner, outer = values[far <= radius], values[far > radius - reach]  # a shell goes to both, if there is a reach
                    cost = len(inner) ** 2 + len(outer) ** 2
                    if best is None or cost < best[0]:
                        best = cost, inner, outer
            below += [values] if best[0] >= len(values) ** 2 else [best[1], best[2]]
        level = below
    leaf = np.repeat(np.arange(len(level), dtype=np.int32), [len(x) for x in level])
    value = np.concatenate(level)
    order = np.lexsort((leaf, value))
    return np.searchsorted(value[order], np.arange(VALUES + 1)), leaf[order]


def _shards(fps: np.ndarray, trees: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and shard numbers: each fingerprint in each shard that it belongs to or borders."""
    rows, keys = [], []
    for k, (starts, leaves) in enumerate(trees):
        word = ((fps >> np.uint64(16 * k)) & np.uint64(VALUES - 1)).astype(np.int64)
        n = starts[word + 1] - starts[word]
        row = np.repeat(np.arange(len(fps)), n)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        rows.append(row)
        keys.append(leaves[np.repeat(starts[word], n) + inside].astype(np.int64) * WORDS + k)
    return np.concatenate(rows), np.concatenate(keys)


def forest(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among distinct fingerprints, as two arrays of ends."""
    linked = np.zeros(len(fps), bool)
    for at in range(0, len(fps), 256):
        near = np.bitwise_count(fps[at : at + 256, None] ^ fps[None, :]) <= radius
        linked[at : at + 256] = near.sum(axis=1) > 1
    left, a, b = fps[linked], [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                queue.extend(found)
                a.append(np.full(len(found), x, np.uint64))
                b.append(found)
    none = np.empty(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def links(reps: DataFrame, n: int) -> DataFrame:
    """Edges (u, v) that connect just the fingerprints in column fp within reach of each other; n of them, all distinct.

    The edges of a task are contracted to stars there."""
    depth = int(np.clip(np.ceil(np.log2(max(n, 1) / SHARD)), 1, 16))
    # At most 17 numbers for each of 65,536 values, whatever the input.
    trees = reps.sparkSession.sparkContext.broadcast([tree(depth, reach) for reach in REACH])

    def keyed(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                fps = batch.column(0).slice(at, 20_000).to_numpy(zero_copy_only=False)
                rows, keys = _shards(fps.view(np.uint64), trees.value)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(fps[rows])], ["shard", "fp"])

    keys = reps.select("fp").mapInArrow(keyed, "shard bigint, fp bigint")
    # One number a shard, of 4 x 65,536 shards at most: the few shards too large for one comparison.
    large = {r.shard: -(-r.n // CHUNK) for r in keys.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK).collect()}

    def dealt(batches):
        """Chunks of a large shard meet pair by pair, so its links stay whole while a task holds two chunks."""
        for batch in keyed(batches):
            shard, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            hot = np.isin(shard, list(large)) if large else np.zeros(len(shard), bool)
            out = [(shard[~hot] << 32, fp[~hot])]
            for s in set(shard[hot].tolist()):
                own, c = fp[shard == s], large[s]
                mixed = own.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                chunk = ((mixed >> np.uint64(33)) % np.uint64(c)).astype(np.int64)
                for other in range(c):
                    pair = np.minimum(chunk, other) * c + np.maximum(chunk, other) + 1
                    out.append(((s << 32) + pair, own))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[0] for x in out])), pa.array(np.concatenate([x[1] for x in out]))], ["shard", "fp"])

    def compare(batches):
        return contract(found(batches))

    def found(batches):
        held, key = [], None

        def ends():
            a, b = forest(np.unique(np.concatenate(held)).view(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"])

        for batch in batches:
            shard, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for s, own in zip(shard[np.r_[0, cuts]] if len(shard) else (), np.split(fp, cuts), strict=False):
                if s != key and held:
                    yield ends()
                    held = []
                key = s
                held.append(own)
        if held:
            yield ends()

    dealt_rows = reps.select("fp").mapInArrow(dealt, "shard bigint, fp bigint")
    return dealt_rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(compare, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(id, fp, component_id) per row of docs.

    component_id is the smallest id among the rows reachable over links of at most four differing bits. Null and empty
    texts have fingerprint zero and link like any other. Rows without an id get the component of the others they link
    to; a component in which no row has an id has a null component_id. Repeated rows stay repeated. No rows give none.
    Other columns of docs are not read. Very long texts are hashed whole, by parts of 32,768 shingles.
    """
    fps = checkpointed(fingerprints(docs, id_col, text_col, width))
    reps = checkpointed(fps.groupBy("fp").agg(F.min("id").alias("rep")))
    found = components(links(reps, reps.count()), contracted=True)
    named = checkpointed(found.withColumnRenamed("node", "fp").join(reps, "fp").select("fp", "component", "rep"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    joined = checkpointed(spread_join(named, "component", F.pmod(F.xxhash64("fp"), F.lit(SALTS)), least).select("fp", "component_id"))
    whole = reps.join(joined, "fp", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id"))
    # Exact copies and empty texts share a fingerprint; their ids deal them.
    return spread_join(fps, "fp", F.pmod(F.xxhash64("id"), F.lit(SALTS)), whole).select("id", "fp", "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """docs with one row of each component, that of its smallest id; all columns.

    Of repeated rows of that id the one least by its text stays. Rows without an id, which no component can be named by,
    stay as they are. Very long texts pass whole.

    What is looked for are the ids that go and those that repeat. Up to FEW of them are broadcast, so no text is shuffled;
    beyond that rows meet them in a join by id. Only rows of repeated ids are compared by their texts.
    """
    known = docs.where(F.col(id_col).isNotNull())
    by_id = near_duplicates(known, id_col, text_col, width).groupBy("id").agg(F.count("*").alias("n"), F.bool_or(F.col("id") == F.col("component_id")).alias("again"))
    odd = checkpointed(by_id.where("NOT again OR n > 1").select("id", "again"))
    few = odd.count() <= FEW
    meet = lambda table: F.broadcast(table) if few else table
    own = [F.col(f"_own.{c}") for c in docs.columns]
    rows = known.select(F.struct(*docs.columns).alias("_own"), F.col(id_col).cast("bigint").alias("_id"))
    single = rows.join(meet(odd.select(F.col("id").alias("_id"))), "_id", "left_anti").select(own)
    single = single.unionByName(docs.where(F.col(id_col).isNull()))
    again = odd.where("again").select(F.col("id").alias("_id"))
    if again.isEmpty():
        return single
    first = F.row_number().over(Window.partitionBy("_id").orderBy(F.asc_nulls_last(f"_own.{text_col}")))
    return single.unionByName(rows.join(meet(again), "_id", "left_semi").withColumn("_nth", first).where("_nth = 1").select(own))


def fingerprint_text(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
