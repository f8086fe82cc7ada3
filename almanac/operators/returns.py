"""Returns, paths and rolling statistics of entity series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(key: str, date: str):
    return Window.partitionBy(key).orderBy(date)


def simple_returns(df: DataFrame, key: str = "instrument_id", date: str = "nav_date", level: str = "nav", reject: float | None = 0.5) -> DataFrame:
    """df with r, the level over the one before less one, and rn, rows counted from the newest.

    With ``reject``, rows whose move is beyond it are removed before counting; the first row has none and goes too.
    """
    df = df.withColumn("r", F.col(level) / F.nullif(F.lag(level).over(_order(key, date)), F.lit(0.0)) - 1)
    if reject is not None:
        df = df.where(F.abs("r") <= reject)
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date))))


def log_returns(df: DataFrame, key: str, date: str, level: str, digits: int = 8) -> DataFrame:
    """df of positive levels with r = ln(x / previous)."""
    return df.where(F.col(level) > 0).withColumn("r", F.round(F.ln(F.col(level) / F.lag(level).over(_order(key, date))), digits))


def drawdown(df: DataFrame, n: int, key: str = "instrument_id", date: str = "nav_date") -> DataFrame:
    """(key, drawdown) of the compounded path of the last n returns; keys with fewer are left out."""
    path = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    df = df.where(F.col("rn") <= n).withColumn("path", F.sum(F.log1p("r")).over(path)).withColumn("top", F.max("path").over(path))
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min(F.exp(F.col("path") - F.col("top")) - 1).alias("drawdown")).where(F.col("n") >= n).drop("n")


def path_stability(df: DataFrame, n: int = 63, least: int = 20, key: str = "instrument_id", level: str = "nav") -> DataFrame:
    """(key, score): how close the log path of the last n levels keeps to the line between its ends, 0..100.

    From sums of y, y², i·y over the numbered rows: the residual to the chord needs no second pass.
    """
    df = df.where(F.col("rn") <= n)
    s = df.groupBy(key).agg(
        F.count("*").alias("n"), F.max_by(F.ln(level), F.col("rn")).alias("y0"), F.min_by(F.ln(level), F.col("rn")).alias("y1"),
        F.sum(F.ln(level)).alias("sy"), F.sum(F.pow(F.ln(level), 2)).alias("syy"), F.sum(F.ln(level) * F.col("rn")).alias("sry"), F.stddev_samp(F.ln(level)).alias("sd"), F.min(level).alias("low"),
    )
    m, last, slope = F.col("n"), F.col("y1") - F.col("y0"), (F.col("y1") - F.col("y0")) / (F.col("n") - 1)
    # With i = n - rn, x_i = slope * i and y_i = ln level - y0.
    yy = F.col("syy") - 2 * F.col("y0") * F.col("sy") + m * F.pow("y0", 2)
    iy = m * F.col("sy") - F.col("sry") - F.col("y0") * m * (m - 1) / 2
    residual = F.sqrt(F.greatest(F.lit(0.0), (yy - 2 * slope * iy + slope * slope * (m - 1) * m * (2 * m - 1) / 6) / m))
    amplitude = F.greatest(F.col("sd"), F.abs(last), F.lit(1e-6))
    return s.where((m >= least) & (F.col("low") > 0)).select(key, (100 * (1 - F.least(residual / amplitude, F.lit(1.0)))).alias("score"))


def external_flows(df: DataFrame, key: str = "instrument_id", date: str = "nav_date", bound: float = 0.25) -> DataFrame:
    """df with flow: assets beyond what the level's move explains, over the assets before, within the bound."""
    w = _order(key, date)
    df = df.where((F.col("nav") > 0) & (F.col("aum") > 0))
    before = F.lag("aum").over(w)
    flow = (F.col("aum") - before * F.col("nav") / F.lag("nav").over(w)) / before
    return df.withColumn("flow", F.when(flow.isNotNull(), F.greatest(F.lit(-bound), F.least(F.lit(bound), flow)))).where("flow IS NOT NULL")


def tail_cumulative(df: DataFrame, n: int, value: str, key: str, date: str) -> DataFrame:
    """(key, i, cum): running sum of the last n values, i from 0."""
    df = df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date)))).where(F.col("rn") <= n)
    w = _order(key, date).rowsBetween(Window.unboundedPreceding, 0)
    return df.select(key, (F.row_number().over(_order(key, date)) - 1).alias("i"), F.sum(value).over(w).alias("cum"))


def level_before(level: Column, date: Column, bound: Column, strict: bool = False) -> Column:
    """The level at the newest date at (or strictly) before a bound; an aggregate."""
    ok = date < bound if strict else date <= bound
    return F.max_by(F.when(ok, level), F.when(ok, date))


def calendar_returns(df: DataFrame, key: str, date: str, level: str, months: dict[str, int], days: dict[str, int]) -> DataFrame:
    """(key, one column per offset, ytd, mtd): newest level over that at the same day months or days before, or at the
    last day before the year or month. Null where the history starts later."""
    newest = df.groupBy(key).agg(F.max(date).alias("_as_of"))
    df = df.join(newest, key)
    d, x, as_of = F.col(date), F.col(level), F.col("_as_of")
    last = F.max_by(x, d)
    bounds = {k: F.add_months(as_of, -m) for k, m in months.items()} | {k: F.date_sub(as_of, n) for k, n in days.items()}
    out = [(last / level_before(x, d, b) - 1).alias(k) for k, b in bounds.items()]
    out += [(last / level_before(x, d, F.trunc(as_of, unit), strict=True) - 1).alias(k) for k, unit in (("ytd", "year"), ("mtd", "month"))]
    return df.groupBy(key).agg(*out)


def month_end(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """(key, month_end, value): last value of each calendar month."""
    return df.groupBy(key, F.last_day(date).alias("month_end")).agg(F.max_by(value, date).alias(value))


def compound_months(df: DataFrame, key: list[str], date: str, r: str) -> DataFrame:
    return df.groupBy(*key, F.trunc(date, "month").alias("month")).agg((F.exp(F.sum(F.log1p(r))) - 1).alias("monthly_return"))


def momentum_12_1(points: DataFrame, key: str, date: str, value: str, least: int = 12) -> DataFrame:
    """(key, momentum) over month-end points: second newest over the thirteenth newest (or the oldest), less one."""
    p = points.withColumn("k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date)))).withColumn("n", F.count("*").over(Window.partitionBy(key)))
    return p.where(F.col("n") >= least).groupBy(key).agg((F.max(F.when(F.col("k") == 2, F.col(value))) / F.max(F.when(F.col("k") == F.least(F.lit(13), F.col("n")), F.col(value))) - 1).alias("momentum"))


def gap_guarded_change(df: DataFrame, key: str, date: str, value: str, most_days: int = 7, scale: float = 0.01) -> DataFrame:
    """df with change: difference to the observation before, times scale, null across a longer gap."""
    w = _order(key, date)
    return df.withColumn("change", F.when(F.datediff(date, F.lag(date).over(w)) <= most_days, (F.col(value) - F.lag(value).over(w)) * scale))


def history_percentile(df: DataFrame, key: str, date: str, value: str, least: int = 60, inverted: bool = False) -> DataFrame:
    """(key, percentile): share of a key's history at or below its newest value, 50 with less than ``least`` rows."""
    current = df.groupBy(key).agg(F.max_by(value, date).alias("_now"))
    share = 100 * F.avg((F.col(value) <= F.col("_now")).cast("double"))
    return df.join(current, key).groupBy(key).agg(F.when(F.count("*") < least, 50.0).otherwise(100 - share if inverted else share).alias("percentile"))


def window_metrics(df: DataFrame, by: list[str], date: str, x: str, k: int = 5) -> DataFrame:
    """Per window of rows: yearly volatility of log returns, return, drawdown from the window's own peak, worst return over k
    rows (over the window, if it has no more than k). A step from or to a value of zero or less counts as no move; fewer
    than three values have no volatility, one has no return."""
    w = Window.partitionBy(*by).orderBy(date)
    v, before, back = F.col(x), F.lag(x).over(w), F.lag(x, k).over(w)
    df = df.withColumn("_log", F.when((before > 0) & (v > 0), F.ln(v / before)).when(before.isNotNull(), 0.0))
    peak = F.max(x).over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("_down", F.when(peak > 0, (peak - v) / peak).otherwise(0.0)).withColumn("_back", F.when(back > 0, v / back - 1))
    first, last = F.min_by(x, date), F.max_by(x, date)
    whole = F.when((F.count("*") >= 2) & (first > 0), last / first - 1).otherwise(0.0)
    return df.groupBy(*by).agg(
        F.when(F.count("_log") >= 2, F.stddev_samp("_log") * F.sqrt(F.lit(252.0))).otherwise(0.0).alias("log_vol"), whole.alias("window_return"), F.max("_down").alias("window_drawdown"),
        F.when(F.count("*") > k, F.coalesce(F.min("_back"), F.lit(0.0))).otherwise(whole).alias(f"worst_{k}"),
    )
