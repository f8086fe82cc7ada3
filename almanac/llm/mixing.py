"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a word budget. Whole epochs over the source come first; the rest of the budget is filled by documents in
the order of exponential keys -ln(u) / w, u drawn by hashing the id and w the document's quality weight, which is the
order of weighted sampling without replacement. Weights are the scores of the quality trees. Keys are cut into ranges, and
running sums are made over a source's ranges and within each range, so no task orders a whole source.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import BLANKS, checkpointed, sliced, spread_join, written
from almanac.llm.quality import Trees, scores

#: Weights of the sources in order, repeating; the share of all sizes to take; the most epochs of a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Ranges of keys a source at least, and the documents that one aims at.
RANGES, RANGE_ROWS = 512, 100_000
SPREAD = (0.05, 0.1, 0.2, 0.4, 0.7, 1.0)
#: The least quality weight, so that every document has a chance; and the sources up to which their table is broadcast.
LEAST, FEW = 0.05, 100_000
#: Tasks over which the rows of a source are dealt at most, beyond that.
SALTS = 256


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("bigint")


def sampling_key(doc_id: Column, weight: Column) -> Column:
    drawn = F.conv(F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":mix")).cast("binary")), 1, 13), 16, 10).cast("bigint")
    return -F.ln((drawn + 0.5) / float(1 << 52)) / weight


def spread(key: Column) -> Column:
    """Keys to 0 to 1, in their order: the share of keys below, were weights dealt evenly over SPREAD."""
    return 1 - sum((F.exp(-w * key) for w in SPREAD), F.lit(0.0)) / len(SPREAD)


def with_weights(docs: DataFrame, trees: Trees, text_col: str = "text", out: str = "weight") -> DataFrame:
    """docs with the quality score of each text, LEAST at least, in a last column."""
    model, at = docs.sparkSession.sparkContext.broadcast(trees), docs.columns.index(text_col)

    def run(batches):
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores(batch.column(at).to_pylist(), model.value), pa.float64())], [*batch.schema.names, out])

    schema = docs.select("*", F.lit(0.0).alias(out)).schema
    return docs.mapInArrow(run, schema).withColumn(out, F.greatest(F.col(out), F.lit(LEAST)))


def measured(docs: DataFrame, trees: Trees | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, source, size, key) per row of docs; without trees all weigh the same. Very long texts are counted whole."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    rows = with_weights(rows, trees) if trees else rows.withColumn("weight", F.lit(1.0))
    return rows.select("id", "source", size_of(F.col("text")).alias("size"), sampling_key(F.col("id"), F.col("weight")).alias("key"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) per source of rows (source, size): budgets by weight, none above ``most`` sizes.

    Sources go by code point, null last. What a budget would have beyond its limit is shared among the others by weight. In
    the order of limit per weight the limited sources come first, so running sums tell where the others begin. The table
    has a row per source; only that is ordered, in one task, as the order of sources asks.
    """
    own = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    own = own.withColumn("w", F.get(F.lit(list(weights)), place)).withColumn("limit", most * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("w"), F.asc_nulls_last("source"))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("w").over(after)
    own = own.withColumn("level", level).withColumn("free", F.col("level") * F.col("w") <= F.col("limit"))
    final = F.min(F.when(F.col("free"), F.struct(F.col("limit") / F.col("w"), F.col("source").isNull(), "source", "level"))).over(Window.partitionBy())["level"]
    return own.withColumn("final", final).select("source", "source_size", F.when(F.col("final").isNull(), F.col("limit").cast("double")).otherwise(F.least(F.col("limit").cast("double"), F.col("final") * F.col("w"))).alias("target"))


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(id, source, size, key, source_size, target, epochs, part, taken) per row of ``measured``.

    taken counts words, those of whole epochs and a part: the documents that fit the rest of the budget whole, and as much
    of the next as still fits. Null texts have no words; documents of one id, or without one, share one draw: they stand in
    the order of their weight and size, and beyond that of a hash. Repeated rows are documents of their own; no rows give
    none. The result depends on the rows alone.

    A range is a slice of the keys of a source; their number follows that of the rows. Rows of one range that agree in key,
    id and size are one row with a count until their sums are made.
    """
    goal = checkpointed(targets(rows, weights, share, most))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    alike = rows.groupBy("source", "key", "id", "size").agg(F.count("*").alias("copies"))
    alike = checkpointed(alike.withColumn("range", F.floor(max(RANGES, rows.count() // RANGE_ROWS) * spread(F.col("key"))).cast("int")))
    words = F.col("size") * F.col("copies")
    inside = F.sum(words).over(Window.partitionBy("source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - words
    sums = alike.groupBy("source", "range").agg(F.sum(words).alias("n"))
    offset = F.sum("n").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    sums = sums.select(F.col("source").alias("s"), F.col("range").alias("r"), offset.alias("offset"))
    placed = alike.withColumn("inside", inside).join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))).drop("s", "r")
    goal = goal.withColumn("epochs", epochs).withColumn("rest", F.floor(F.col("target") + 0.5).cast("bigint") - F.col("epochs") * F.col("source_size"))
    rows = by_source(placed, "source", goal, ["id", "key", "size"])
    rows = rows.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))).withColumn("inside", F.col("inside") + F.col("nth") * F.col("size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("offset") - F.col("inside")))
    rows = rows.withColumn("part", part)
    return rows.select("id", "source", "size", "key", "source_size", "target", "epochs", "part", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


def by_source(rows: DataFrame, source_col: str, table: DataFrame, own: list[str]) -> DataFrame:
    """rows joined to a checkpointed table of a row per source: broadcast up to FEW sources, beyond that dealt by a hash of
    the row's ``own`` columns."""
    table = table.select(F.struct(F.col("source").isNull(), F.coalesce("source", F.lit(""))).alias("_s"), *(c for c in table.columns if c != "source"))
    rows = rows.withColumn("_s", F.struct(F.col(source_col).isNull(), F.coalesce(F.col(source_col), F.lit(""))))
    joined = rows.join(F.broadcast(table), "_s") if table.count() <= FEW else spread_join(rows, "_s", F.pmod(F.xxhash64(*own), F.lit(SALTS)), table)
    return joined.drop("_s")


def mixed_documents(docs: DataFrame, trees: Trees | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The rows of docs, each as often as the mix takes it; all columns.

    A document of which the budget takes a part counts if that is half of its words or more. Which these are follows from
    one key per source, so the texts are not shuffled for it, and only written once with their keys. Documents without words
    come once per epoch. Rows without an id share one draw; no rows give none.
    """
    own = {c: f"_own_{k}" for k, c in enumerate(docs.columns)}
    rows = docs.withColumnsRenamed(own)
    rows = with_weights(rows, trees, own[text_col], "_weight") if trees else rows.withColumn("_weight", F.lit(1.0))
    key = sampling_key(F.col(own[id_col]).cast("bigint"), F.col("_weight"))
    rows = written(rows.select(*own.values(), size_of(F.col(own[text_col])).alias("_size"), key.alias("_key")))
    taken = mix(rows.select(F.col(own[id_col]).cast("bigint").alias("id"), F.col(own[source_col]).alias("source"), F.col("_size").alias("size"), F.col("_key").alias("key")), weights, share, most)
    last = taken.groupBy("source").agg(F.first("epochs").alias("_epochs"), F.max(F.when((F.col("part") > 0) & (2 * F.col("part") >= F.col("size")), F.col("key"))).alias("_last"))
    rows = by_source(rows, own[source_col], checkpointed(last), [own[id_col], "_key", "_size"])
    times = F.col("_epochs") + F.when((F.col("_size") > 0) & (F.col("_key") <= F.col("_last")), 1).otherwise(0)
    rows = rows.withColumn("_n", times).where("_n > 0").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    return rows.select(*(F.col(new).alias(c) for c, new in own.items()))
