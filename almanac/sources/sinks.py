"""Writes over Parquet tables partitioned by a column, and read models.

A merge into a table reads and rewrites the partitions that its batch has rows in, and no others. Of rows that share a key
within a batch the conflict rule decides as for rows one after another: an insert keeps the first, an update the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Partitions of a batch that are named in the filter of a read, and keys up to which they are broadcast; beyond that, joins.
NAMED, FEW = 1000, 500_000


def one_a_key(new: DataFrame, key: list[str], order: list[str] | None = None, last: bool = False) -> DataFrame:
    """The first row of each key by ``order`` (the last one, if so asked); without an order the least by its other columns."""
    rest = [c for c in new.columns if c not in key]
    if not rest:
        return new.distinct()
    pick = F.max if last else F.min
    if len(rest) == 1 and not order:
        # Of a bare number the aggregate needs no sort, as that of a struct does; a null is the least.
        one = pick(rest[0]) if last else F.when(~F.bool_or(F.col(rest[0]).isNull()), pick(rest[0]))
        return new.groupBy(*key).agg(one.alias(rest[0])).select(*new.columns)
    row = F.struct(*(order or []), F.struct(*rest).alias("_row"))
    return new.groupBy(*key).agg(pick(row).alias("_one")).select(*key, "_one._row.*").select(*new.columns)


def upserted(old: DataFrame, new: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """old with new rows taking the place of those of the same key, of each key's new rows the last. Running it again changes
    nothing."""
    new = one_a_key(new, key, order, last=True)
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def inserted(old: DataFrame, new: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """The new rows whose key old lacks, of each key's the first; to be appended."""
    return one_a_key(new, key, order).join(old.select(key), key, "left_anti")


def _exists(spark, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def touched(table: DataFrame, new: DataFrame, by: str) -> DataFrame:
    """The rows of a table partitioned by ``by`` in the partitions that new has rows in: what names them prunes the read."""
    values = [r[0] for r in new.select(by).distinct().limit(NAMED + 1).collect()]
    if len(values) > NAMED:
        return table.join(new.select(by).distinct(), table[by].eqNullSafe(new[by]), "left_semi")
    named = F.col(by).isin([v for v in values if v is not None])
    return table.where(named | F.col(by).isNull() if None in values else named)


def merge_into(path: str, new: DataFrame, key: list[str], by: str, update: bool, order: list[str] | None = None) -> None:
    """Merge a batch into the Parquet table at path, partitioned by ``by``, which is one of the key's columns.

    An insert (``update`` false) reads no more than the key columns of the partitions the batch touches, keeps of these the
    keys that the batch has, and appends the rest of the batch. An update reads those partitions and writes them anew. Other
    partitions are neither read nor written. A batch that is merged again changes nothing; an empty one does nothing. Keys
    hold no nulls, but for the partition of an update.
    """
    if by not in key:
        raise ValueError("a key must fix its partition")
    spark, one = new.sparkSession, one_a_key(new, key, order, last=update)
    if _exists(spark, path):
        old = touched(spark.read.schema(new.schema).parquet(path), new, by)
        if update:
            keys = one.select(key)
            one = old.select(*new.columns).join(keys, key, "left_anti").unionByName(one)
        else:
            keys = one.select(key)
            keys = F.broadcast(keys) if keys.count() <= FEW else keys
            one = one.join(old.select(key).join(keys, key, "left_semi"), key, "left_anti")
    # Few files a partition; one of very many rows is split.
    one = one.hint("rebalance", by)
    if update:
        replace_partitions(one, path, by)
    else:
        one.write.mode("append").partitionBy(by).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Overwrite the partitions that df brings, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def pruned(df: DataFrame, parents: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose parent exists."""
    return df.join(parents.select(key), key, "left_semi")


def owned_update(old: DataFrame, new: DataFrame, key: list[str], owned: list[str]) -> DataFrame:
    """old with a writer's own columns updated where it has values; it touches no others."""
    new = new.select(*key, *(F.col(c).alias(f"_new_{c}") for c in owned))
    cols = [F.coalesce(f"_new_{c}", c).alias(c) if c in owned else F.col(c) for c in old.columns]
    return old.join(new, key, "left").select(cols)


def seeded_parents(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents, and a bare row for each child without one."""
    return parents.unionByName(children.select(key).distinct().join(parents.select(key), key, "left_anti"), allowMissingColumns=True)


def latest_rows(df: DataFrame, key: str, date: str) -> DataFrame:
    """The newest row per key; of several of one date that which comes first by a hash of all columns."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date), F.xxhash64(*df.columns)))).where("_n = 1").drop("_n")
