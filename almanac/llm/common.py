"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters between words, as a regular expression class body.
BLANKS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it. Only one machine can do without one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return where or tempfile.mkdtemp(prefix="spark-")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage into the shared folder that the session names; a folder that the context has already stays."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared(df.sparkSession))
    return df.checkpoint()


#: Work tables of this driver that cleared() has not dropped yet.
_tables: list[str] = []


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: as checkpointed(), for rows with whole texts. cleared() drops it."""
    path = f"{shared(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _tables.append(path)
    return df.sparkSession.read.parquet(path)


def cleared(spark: SparkSession) -> None:
    """Drop the tables of written(), once what was made from them has been written elsewhere."""
    while _tables:
        dropped(spark, _tables.pop())


def spread_join(rows: DataFrame, key: str, salt, table: DataFrame) -> DataFrame:
    """rows joined to table, which has one row per key, so that a key of very many rows is no single task's load.

    salt: a column of few values that deals the rows of a key, made from a row's own values alone. Rows are read twice, and
    a salt that depends on where a row happens to be (its partition, a random number) may differ between the two, which
    would lose rows. First the distinct pairs of key and salt, few a key and combined before they are shuffled, meet the
    table; then rows meet these pairs by both.
    """
    rows = rows.withColumn("_salt", salt)
    pairs = rows.select(key, "_salt").distinct().join(table, key)
    return rows.join(pairs, [key, "_salt"]).drop("_salt")


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a work table."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


#: What a worker keeps from task to task, and whose it is: one operator's at a time, since workers outlive stages.
_kept: dict[str, object] = {}


def kept(name: str, key: object, make):
    """make(), remembered in this worker until another name or key comes."""
    if _kept.get("of") != (name, key):
        release()
        _kept.update(of=(name, key), value=make())
    return _kept["value"]


def release() -> None:
    """Give back what other operators' tasks left in this worker."""
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def sliced(batches, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in slices, so that a worker holds few texts as Python strings at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fold(doc_id, n: int):
    """crc32 of the id's decimal text, modulo n."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n


def words_of(text):
    """Array of the words of a text column; null counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), lambda w: w != "")
