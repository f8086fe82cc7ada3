"""Places and cuts for work that takes more than one pass."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def shared(spark) -> str:
    """The folder that driver and executors share, as the session names it; only one machine can do without one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return where or tempfile.mkdtemp(prefix="spark-")


def scratch(spark, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage into the shared folder; a checkpoint folder that the context has already stays."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared(df.sparkSession))
    return df.checkpoint()
