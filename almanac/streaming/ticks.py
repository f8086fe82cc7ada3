"""Trade ticks as Structured Streaming queries; every function also takes a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.sources.sinks import merge_into, one_a_key


#: A time with its offset from UTC; T or one blank may stand between day and time.
STAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)$"
NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"


def _number(cell: Column) -> Column:
    """A cell that is a JSON number as a double; text that reads like one is none, true and false are one and zero."""
    return F.when(cell["kind"] == "BOOLEAN", (cell["text"] == "true").cast("double")).when(cell["kind"].rlike(NUMBER), cell["text"].try_cast("double"))


def parsed(frames: DataFrame, payload: str = "value") -> DataFrame:
    """(symbol, ts, price, size) of trade frames {messageType: 'A', data: [...]}; ts to the second.

    A full trade array is [T, time, nanoseconds, symbol, ...] with the last price tenth and its size eleventh; a slim one is
    [time, symbol, price], its symbol a text, and has size 0, as has a trade without a readable one. Values keep their JSON
    kind: a price is a number, one that is sent as text goes. A time that can't be read, or names no offset from UTC, is the
    time of arrival. Quotes, heartbeats, unreadable frames and trades without a price or symbol go.
    """
    # Kind and text of each value are made once; all else is said of these.
    cell = lambda v: F.struct(F.schema_of_variant(v).alias("kind"), F.try_variant_get(v, "$", "string").alias("text"))
    doc = frames.select(F.try_parse_json(F.col(payload).cast("string")).alias("doc")).where(F.try_variant_get("doc", "$.messageType", "string") == "A")
    f = doc.select(F.transform(F.try_variant_get("doc", "$.data", "array<variant>"), cell).alias("data"))
    at = lambda k: F.get("data", F.lit(k))
    slim = (F.size("data") == 3) & (at(1)["kind"] == "STRING")
    full = (F.size("data") >= 11) & (at(0)["text"] == "T")
    trade = lambda *places: F.struct(*(at(k).alias(name) if k is not None else F.lit(None).cast("struct<kind:string,text:string>").alias(name) for k, name in zip(places, ("time", "symbol", "price", "size"), strict=True)))
    f = f.select(F.when(slim, trade(0, 1, 2, None)).when(full, trade(1, 3, 9, 10)).alias("t")).where("t IS NOT NULL")
    stamp = F.col("t.time.text")
    offset = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.replace(stamp, F.lit(","), F.lit(".")), r"^(.{16})(?=Z|[+-])", "$1:00"), r"([+-]\d{2})$", "$1:00"), r"([+-]\d{2})(\d{2})$", "$1:$2")
    read = F.when(stamp.rlike(STAMP), offset.try_cast("timestamp"))
    size = F.coalesce(_number(F.col("t.size")), F.col("t.size.text").try_cast("bigint").cast("double"), F.lit(0.0))
    symbol = F.when(_number(F.col("t.symbol")) == 0, "").otherwise(F.upper(F.col("t.symbol.text")))
    rows = f.select(symbol.alias("symbol"), F.date_trunc("second", F.coalesce(read, F.current_timestamp())).alias("ts"), _number(F.col("t.price")).alias("price"), size.cast("bigint").alias("size"))
    return rows.where("symbol <> '' AND price IS NOT NULL")


def routed(ticks: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """A row per subscribed session of each tick: stream and static table joined on the symbol."""
    return ticks.join(subscriptions, "symbol")


def last_prices(ticks: DataFrame) -> DataFrame:
    """The newest price per symbol, the highest of one time; for the update output mode."""
    return ticks.groupBy("symbol").agg(F.max("ts").alias("ts"), F.max_by("price", F.struct("ts", "price")).alias("price"))


def bars(ticks: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(symbol, start, open, high, low, close, n) per window; a tick that comes later than the watermark is left out.

    Of ticks of one time the lowest opens and the highest closes."""
    w = ticks.withWatermark("ts", late).groupBy("symbol", F.window("ts", width).alias("w"))
    b = w.agg(F.min_by("price", F.struct("ts", "price")).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", F.struct("ts", "price")).alias("close"), F.count("*").alias("n"))
    return b.select("symbol", F.col("w.start").alias("start"), "open", "high", "low", "close", "n")


def append_new(stream: DataFrame, path: str, key: list[str], checkpoint: str, by: str | None = None):
    """Start a query that appends each batch's rows whose key the table at path lacks; a repeated batch adds nothing.

    Of rows of one key in a batch the least by its other columns stays. Of the table only the key columns are read; with
    ``by``, a column of the key that partitions the table, only those of the partitions that the batch touches.
    """

    def write(batch: DataFrame, _: int) -> None:
        if by:
            merge_into(path, batch, key, by, update=False)
            return
        spark, fresh = batch.sparkSession, one_a_key(batch, key)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
            fresh = fresh.join(spark.read.schema(fresh.schema).parquet(path).select(key), key, "left_anti")
        fresh.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
