"""Parsers of raw payloads (a string column) and files. What can't be read is null or dropped, as each says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fields of a daily bar and the columns they become.
BAR_COLUMNS = {
    "open": "open", "high": "high", "low": "low", "close": "close", "volume": "volume", "adjOpen": "adj_open", "adjHigh": "adj_high", "adjLow": "adj_low",
    "adjClose": "adj_close", "adjVolume": "adj_volume", "divCash": "div_cash", "splitFactor": "split_factor",
}
BAR = "date string, " + ", ".join(f"{c} double" for c in BAR_COLUMNS)


def daily_prices(df: DataFrame, payload: str, *keys: str) -> DataFrame:
    """(keys, date, price) of an array of bars; adjusted close before close, a missing price kept as null."""
    bars = df.select(*keys, F.explode(F.from_json(payload, f"array<struct<{_fields(BAR)}>>")).alias("b"))
    return bars.select(*keys, F.expr("try_cast(substring(b.date, 1, 10) AS date)").alias("date"), F.coalesce("b.adjClose", "b.close").alias("price"))


def full_bars(df: DataFrame, payload: str, *keys: str) -> DataFrame:
    """Bars with a day and all twelve of BAR_COLUMNS; a bar that lacks one is dropped."""
    bars = df.select(*keys, F.explode(F.from_json(payload, f"array<struct<{_fields(BAR)}>>")).alias("b"))
    bars = bars.select(*keys, F.expr("try_cast(substring(b.date, 1, 10) AS date)").alias("date"), *(F.col(f"b.{c}").alias(name) for c, name in BAR_COLUMNS.items()))
    return bars.dropna(how="any", subset=["date", *BAR_COLUMNS.values()])


def _fields(ddl: str) -> str:
    return ", ".join(":".join(x.split()) for x in ddl.split(","))


def chart_prices(df: DataFrame, payload: str, *keys: str) -> DataFrame:
    """Parallel arrays {timestamp: [...], close: [...]} to rows; rows without a price are dropped."""
    p = df.withColumn("_p", F.from_json(payload, "timestamp array<bigint>, close array<double>"))
    z = p.select(*keys, F.explode(F.arrays_zip(F.col("_p.timestamp").alias("t"), F.col("_p.close").alias("c"))).alias("z"))
    return z.select(*keys, F.to_date(F.timestamp_seconds("z.t")).alias("date"), F.col("z.c").alias("price")).where("price IS NOT NULL")


def observations(df: DataFrame, payload: str, *keys: str) -> DataFrame:
    """{observations: [{date, value}]} with '.' for missing; unreadable and non-finite values are dropped."""
    o = df.select(*keys, F.explode(F.from_json(payload, "observations array<struct<date:string,value:string>>")["observations"]).alias("o"))
    return o.select(*keys, F.expr("try_cast(o.date AS date)").alias("obs_date"), F.expr("try_cast(trim(o.value) AS double)").alias("value")).where("obs_date IS NOT NULL AND abs(value) < double('Infinity')")


def wide_vintages(df: DataFrame, payload: str, series: str) -> DataFrame:
    """Columns <ID>_YYYYMMDD to (series, observation_period, vintage_date, value, revision_number).

    A vintage is kept only where it differs from the one kept before; revisions are numbered from 0.
    """
    o = df.select(series, F.explode(F.from_json(payload, "observations array<map<string,string>>")["observations"]).alias("m"))
    o = o.select(series, F.expr("try_cast(m['date'] AS date)").alias("observation_period"), F.explode("m").alias("k", "v"))
    o = o.withColumn("vintage_date", F.expr(r"try_to_timestamp(regexp_extract(k, '_(\\d{8})$', 1), 'yyyyMMdd')").cast("date")).withColumn("value", F.expr("try_cast(v AS double)")).where("vintage_date IS NOT NULL AND value IS NOT NULL AND observation_period IS NOT NULL")
    order = Window.partitionBy(series, "observation_period").orderBy("vintage_date")
    kept = o.withColumn("_b", F.lag("value").over(order)).where("_b IS NULL OR _b <> value")
    return kept.select(series, "observation_period", "vintage_date", "value", (F.row_number().over(order) - 1).alias("revision_number"))


def identifier(prefix: str, name: Column, most: int = 80) -> Column:
    """Series ids: upper case, runs of other characters as one underscore, cut."""
    return F.substring(F.concat(F.lit(prefix), F.regexp_replace(F.upper(name), "[^A-Z0-9]+", "_")), 1, most)


def unpivoted_records(df: DataFrame, name: str, date: str, values: dict[str, str]) -> DataFrame:
    """(series_id, obs_date, value): one row per value column, numeric strings with commas; unreadable rows dropped."""
    each = F.explode(F.array(*(F.struct(identifier(prefix, F.col(name)).alias("series_id"), F.expr(f"try_cast(replace(`{c}`, ',', '') AS double)").alias("value")) for c, prefix in values.items()))).alias("r")
    return df.select(F.expr(f"try_cast(`{date}` AS date)").alias("obs_date"), each).select("r.series_id", "obs_date", "r.value").where("value IS NOT NULL AND obs_date IS NOT NULL")


def xml_holdings(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an information table: issuer, cusip, value in single currency units, shares. Rows without a cusip go."""
    raw = spark.read.format("xml").option("rowTag", "infoTable").schema("nameOfIssuer string, cusip string, value string, shrsOrPrnAmt struct<sshPrnamt:string>").load(path)
    return raw.where(F.length(F.trim("cusip")) > 0).select(F.col("nameOfIssuer").alias("issuer"), F.upper(F.trim("cusip")).alias("cusip"), (F.expr("try_cast(value AS decimal(38,2))") * 1000).alias("value_usd"), F.expr("try_cast(shrsOrPrnAmt.sshPrnamt AS decimal(38,4))").alias("shares"))


def tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("sep", "\t").csv(path)


def insider_transactions(submission: DataFrame, owner: DataFrame, transaction: DataFrame) -> DataFrame:
    """Transactions with their submission and its first owner; value is the price times the shares. Sides: buy, sell, other."""
    first = owner.withColumn("_n", F.row_number().over(Window.partitionBy("ACCESSION_NUMBER").orderBy("RPTOWNERCIK"))).where("_n = 1").select("ACCESSION_NUMBER", "RPTOWNERCIK")
    df = transaction.join(submission, "ACCESSION_NUMBER", "left").join(first, "ACCESSION_NUMBER", "left")
    number = lambda c: F.expr(f"try_cast({c} AS decimal(38,4))")
    shares, price = number("TRANSACTION_SHARES"), number("TRANSACTION_PRICEPERSHARE")
    return df.select("ACCESSION_NUMBER", "TRANS_SK", "ISSUERCIK", "RPTOWNERCIK", F.expr("try_to_timestamp(TRANSACTION_DATE, 'dd-MMM-yyyy')").cast("date").alias("transaction_date"), "TRANSACTION_CODE", shares.alias("shares"), (shares * price).cast("decimal(38,4)").alias("value_usd"), side(F.col("TRANSACTION_CODE"), F.col("SIDE")).alias("buy_sell"))


def side(code: Column, flag: Column) -> Column:
    """Purchases and sales by code; other codes by the acquired or disposed flag stay 'other'."""
    return F.when((code == "P") & (F.coalesce(flag, F.lit("A")) == "A"), "buy").when((code == "S") & (F.coalesce(flag, F.lit("D")) == "D"), "sell").otherwise("other")


def reported_flows(submission: DataFrame, info: DataFrame) -> DataFrame:
    """Fund reports: day-month-year dates and thousands separators; only rows found in both files."""
    day = lambda c: F.expr(f"try_to_timestamp({c}, 'dd-MMM-yyyy')").cast("date")
    money = lambda c: F.expr(f"try_cast(replace({c}, ',', '') AS decimal(20,2))").alias(c.lower())
    cols = [c for c in info.columns if c not in ("ACCESSION_NUMBER", "SERIES_ID")]
    return submission.join(info, "ACCESSION_NUMBER").select("ACCESSION_NUMBER", "SERIES_ID", day("REPORT_DATE").alias("report_date"), day("FILING_DATE").alias("filing_date"), *(money(c) for c in cols))


def columnar_rows(df: DataFrame, payload: str) -> DataFrame:
    """{fields: [...], data: [[...]]} by field name: class_id, series_id, ticker, cik without leading zeros.

    Blank rows go; of one class id (else series and ticker) the first stays.
    """
    p = df.select(F.from_json(payload, "fields array<string>, data array<array<string>>").alias("p")).select("p.fields", F.posexplode("p.data").alias("pos", "row"))
    at = lambda name: F.get("row", F.array_position("fields", F.lit(name)).cast("int") - 1)
    rows = p.select("pos", at("classId").alias("class_id"), at("seriesId").alias("series_id"), at("symbol").alias("ticker"), F.ltrim(at("cik"), F.lit("0")).alias("cik")).where("coalesce(class_id, series_id, '') <> ''")
    key = F.coalesce(F.nullif("class_id", F.lit("")), F.concat_ws(":", "series_id", "ticker"))
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).where("_n = 1").drop("_n", "pos")


def json_snapshot(spark: SparkSession, path: str, schema: str, as_of_col: str, as_of: str, key: list[str]) -> DataFrame:
    """A JSON table up to a date, by key."""
    return spark.read.schema(schema).option("multiLine", True).json(path).where(F.col(as_of_col) <= F.lit(as_of).cast("date")).orderBy(*key)


def provenance(df: DataFrame, name: str, date: str) -> DataFrame:
    return df.agg(F.lit(name).alias("table"), F.count("*").alias("n"), F.min(date).alias("first"), F.max(date).alias("last"))


def newest_filings(df: DataFrame, payload: str, forms: list[str], as_of: str, n: int, *keys: str) -> DataFrame:
    """Parallel arrays {form, accessionNumber, filingDate, reportDate} to the first n filings of the forms at or before a date.

    A filing's period is its report date, or else its filing date; one without a filing date is left out. The index lists
    the newest filings first, and its order is kept.
    """
    p = df.withColumn("_p", F.from_json(payload, "form array<string>, accessionNumber array<string>, filingDate array<string>, reportDate array<string>"))
    cells = F.arrays_zip(F.col("_p.form").alias("form"), F.col("_p.accessionNumber").alias("accession"), F.col("_p.filingDate").alias("filed"), F.col("_p.reportDate").alias("reported"))
    z = p.select(*keys, F.posexplode(cells).alias("_at", "z")).select(*keys, "_at", "z.form", "z.accession", F.expr("try_cast(z.filed AS date)").alias("filing_date"), F.expr("try_cast(z.reported AS date)").alias("report_date"))
    z = z.withColumn("report_date", F.coalesce("report_date", "filing_date"))
    z = z.where(F.col("form").isin(forms) & F.col("filing_date").isNotNull() & (F.col("report_date") <= F.lit(as_of).cast("date")))
    return z.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("_at"))).where(F.col("rank") <= n).drop("_at")
