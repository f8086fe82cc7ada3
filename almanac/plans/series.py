"""Queries over entity series: returns, risk, momentum, screens."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from almanac.functions import metrics as M
from almanac.lens import oracle, view
from almanac.operators import returns as R
from almanac.registry import query

RF = 0.04
HORIZONS = {"21d": 21, "63d": 63, "126d": 126, "252d": 252}


def _r6(df, *skip):
    """Doubles at six digits, so that sums in any order compare equal."""
    return df.select(*(F.round(c, 6).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes))


def _ret(spark, sf_dir):
    return R.simple_returns(view(spark, sf_dir, "nav"))


@query("src01_series_scan", oracle("SELECT instrument_id, nav_date, nav FROM nav WHERE nav_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND nav IS NOT NULL", "nav"))
def series_scan(spark, sf_dir):
    nav = view(spark, sf_dir, "nav")
    return nav.where("nav_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND nav IS NOT NULL").select("instrument_id", "nav_date", "nav")


@query("wn01_simple_return", oracle("SELECT ticker, date, round(close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1, 6) AS r FROM prices", "prices"))
def simple_return(spark, sf_dir):
    df = R.simple_returns(view(spark, sf_dir, "prices"), "ticker", "date", "close", reject=None)
    return df.select("ticker", "date", F.round("r", 6).alias("r"))


@query("wn02_log_return", oracle("SELECT instrument_id, nav_date, round(ln(nav / lag(nav) OVER (PARTITION BY instrument_id ORDER BY nav_date)), 6) AS r FROM nav WHERE nav > 0", "nav"))
def log_return(spark, sf_dir):
    return R.log_returns(view(spark, sf_dir, "nav"), "instrument_id", "nav_date", "nav", 6).select("instrument_id", "nav_date", "r")


@query("wn03_rejected_returns", oracle("""WITH t AS (SELECT ticker, date, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS r FROM prices)
    SELECT ticker, count(*) AS n, round(avg(r), 6) AS mean, max(date) AS newest FROM t WHERE abs(r) <= 0.5 GROUP BY ticker""", "prices"))  # fmt: skip
def rejected_returns(spark, sf_dir):
    df = R.simple_returns(view(spark, sf_dir, "prices"), "ticker", "date", "close")
    return _r6(df.groupBy("ticker").agg(F.count("*").alias("n"), F.avg("r").alias("mean"), F.max("date").alias("newest")))


@query("wn04_trailing_return", oracle("""SELECT instrument_id,
    round(max(nav) FILTER (rn = 1) / max(nav) FILTER (rn = 22) - 1, 6) AS r21, round(max(nav) FILTER (rn = 1) / max(nav) FILTER (rn = 253) - 1, 6) AS r252,
    round(max(nav) FILTER (rn = 1) / max(nav) FILTER (rn = 253) - 1, 6) AS a1, round((max(nav) FILTER (rn = 1) / max(nav) FILTER (rn = 505)) ** 0.5 - 1, 6) AS a2
    FROM ret GROUP BY instrument_id""", "ret"))  # fmt: skip
def trailing_return(spark, sf_dir):
    return _r6(_ret(spark, sf_dir).groupBy("instrument_id").agg(M.trailing_return(21).alias("r21"), M.trailing_return(252).alias("r252"), M.annual_return(1).alias("a1"), M.annual_return(2).alias("a2")))


_CAL = "max_by(nav, nav_date) FILTER (nav_date <= CAST(as_of - INTERVAL {} AS DATE))"


@query("wn05_wn06_calendar_returns", oracle(f"""WITH a AS (SELECT *, max(nav_date) OVER (PARTITION BY instrument_id) AS as_of FROM nav)
    SELECT instrument_id, round(max_by(nav, nav_date) / {_CAL.format('7 DAY')} - 1, 6) AS w1, round(max_by(nav, nav_date) / {_CAL.format('1 MONTH')} - 1, 6) AS m1, round(max_by(nav, nav_date) / {_CAL.format('3 MONTH')} - 1, 6) AS m3, round(max_by(nav, nav_date) / {_CAL.format('12 MONTH')} - 1, 6) AS y1,
        round(max_by(nav, nav_date) / max_by(nav, nav_date) FILTER (nav_date < date_trunc('year', as_of)) - 1, 6) AS ytd, round(max_by(nav, nav_date) / max_by(nav, nav_date) FILTER (nav_date < date_trunc('month', as_of)) - 1, 6) AS mtd
    FROM a GROUP BY instrument_id""", "nav"))  # fmt: skip
def calendar_returns(spark, sf_dir):
    return _r6(R.calendar_returns(view(spark, sf_dir, "nav"), "instrument_id", "nav_date", "nav", {"m1": 1, "m3": 3, "y1": 12}, {"w1": 7}))


@query("wn07_volatility", oracle("SELECT instrument_id, " + ", ".join(f"round(CASE WHEN count(*) FILTER (rn <= {n}) >= {n} THEN stddev_samp(r) FILTER (rn <= {n}) * sqrt(252) END, 6) AS vol_{k}" for k, n in HORIZONS.items()) + " FROM ret GROUP BY instrument_id", "ret"))
def volatility(spark, sf_dir):
    return _r6(_ret(spark, sf_dir).groupBy("instrument_id").agg(*(M.volatility(n).alias(f"vol_{k}") for k, n in HORIZONS.items())))


_DD = """dd AS (SELECT instrument_id, count(*) AS n, min(exp(p - top) - 1) AS drawdown FROM (SELECT *, max(p) OVER (PARTITION BY instrument_id ORDER BY nav_date) AS top
    FROM (SELECT *, sum(ln(1 + r)) OVER (PARTITION BY instrument_id ORDER BY nav_date) AS p FROM ret WHERE rn <= 252)) GROUP BY instrument_id)"""


@query("wn08_drawdown", oracle(f"WITH {_DD} SELECT instrument_id, round(drawdown, 6) AS drawdown FROM dd WHERE n >= 252", "ret"))
def drawdown(spark, sf_dir):
    return _r6(R.drawdown(_ret(spark, sf_dir), 252))


@query("wn09_wn10_sharpe_sortino", oracle(f"""WITH m AS (SELECT instrument_id, count(*) AS n, avg(r) - {RF}/252.0 AS e, stddev_samp(r) AS v, sqrt(avg(least(r - {RF}/252.0, 0) ** 2)) AS s FROM ret WHERE rn <= 252 GROUP BY instrument_id)
    SELECT instrument_id, round(CASE WHEN n >= 252 AND v * sqrt(252) >= 0.01 THEN e / v * sqrt(252) END, 6) AS sharpe, round(CASE WHEN n >= 252 AND s * sqrt(252) >= 0.01 THEN e / s * sqrt(252) END, 6) AS sortino FROM m""", "ret"))  # fmt: skip
def sharpe_sortino(spark, sf_dir):
    return _r6(_ret(spark, sf_dir).groupBy("instrument_id").agg(M.sharpe(252, RF).alias("sharpe"), M.sortino(252, RF).alias("sortino")))


_TAIL = " JOIN ".join(
    f"""(SELECT instrument_id, round(-v, 6) AS var_{k}, round(-(v + list_sum(list_transform(l, lambda x: greatest(x - v, 0))) / (0.05 * {n})), 6) AS cvar_{k}
        FROM (SELECT instrument_id, list_sort(list(-r)) AS l, list_sort(list(-r))[ceil(0.95 * {n - 1})::INTEGER + 1] AS v FROM ret WHERE rn <= {n} GROUP BY instrument_id HAVING count(*) >= {n})) t{n}""" + (" USING (instrument_id)" if i else "")
    for i, (k, n) in enumerate(HORIZONS.items())
)


@query("wn11_tail_losses", oracle(f"SELECT * FROM {_TAIL}", "ret"))
def tail_losses(spark, sf_dir):
    df = _ret(spark, sf_dir).groupBy("instrument_id").agg(*(M.tail_losses(n).alias(k) for k, n in HORIZONS.items()))
    return _r6(df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in HORIZONS)).select("instrument_id", *(F.col(f"`{k}`.{x}").alias(f"{x}_{k}") for k in HORIZONS for x in ("var", "cvar"))))


@query("wn12_calmar", oracle(f"""WITH {_DD}, a AS (SELECT instrument_id, max(nav) FILTER (rn = 1) / max(nav) FILTER (rn = 253) - 1 AS y FROM ret GROUP BY instrument_id)
    SELECT instrument_id, round(CASE WHEN drawdown <> 0 THEN y / abs(drawdown) END, 6) AS calmar FROM dd JOIN a USING (instrument_id) WHERE n >= 252""", "ret"))  # fmt: skip
def calmar(spark, sf_dir):
    ret = _ret(spark, sf_dir)
    yearly = ret.groupBy("instrument_id").agg(M.annual_return(1).alias("y"))
    return _r6(R.drawdown(ret, 252).join(yearly, "instrument_id").select("instrument_id", F.when(F.col("drawdown") != 0, F.col("y") / F.abs("drawdown")).alias("calmar")))


@query("wn13_adjusted_sharpe", oracle(f"""WITH w AS (SELECT * FROM ret WHERE rn <= 756), m AS (SELECT instrument_id, count(*) AS n, avg(r) AS m, stddev_samp(r) AS sd FROM w GROUP BY instrument_id),
    s AS (SELECT instrument_id, any_value(n) AS n, any_value((m.m - {RF}/252.0) / sd) AS sr, avg(((r - m.m) / sd) ** 3) AS sk, avg(((r - m.m) / sd) ** 4) - 3 AS ku FROM w JOIN m USING (instrument_id) GROUP BY instrument_id),
    v AS (SELECT *, sr * (1 + sk / 6 * sr - ku / 24 * sr * sr) * sqrt(252) AS v, sqrt((1 + 0.5 * sr * sr - sk * sr + ku / 4 * sr * sr) / n) * sqrt(252) AS e FROM s)
    SELECT instrument_id, round(sk, 6) AS skew, round(ku, 6) AS kurt, round(v, 6) AS value, round(v - 1.96 * e, 6) AS low, round(v + 1.96 * e, 6) AS high FROM v WHERE n >= 30""", "ret"))  # fmt: skip
def adjusted_sharpe(spark, sf_dir):
    df = _ret(spark, sf_dir).groupBy("instrument_id").agg(*M.moments(756)).select("instrument_id", M.adjusted_sharpe(RF).alias("s"))
    return _r6(df.where("s IS NOT NULL").select("instrument_id", "s.*"))


@query("wn14_weighted_volatility", oracle("""WITH n AS (SELECT instrument_id, count(*) AS n, var_pop(r) AS v FROM ret GROUP BY instrument_id)
    SELECT instrument_id, round(CASE WHEN any_value(n) >= 20 THEN sqrt(any_value(0.94 ** n * v) + sum(0.06 * 0.94 ** (rn - 1) * r * r)) * sqrt(252) END, 6) AS vol FROM ret JOIN n USING (instrument_id) GROUP BY instrument_id""", "ret"))  # fmt: skip
def weighted_volatility(spark, sf_dir):
    return _r6(_ret(spark, sf_dir).groupBy("instrument_id").agg(M.weighted_volatility().alias("vol")))


@query("wn15_wn16_wn18_momentum", oracle("""WITH d AS (SELECT *, nav - lag(nav) OVER (PARTITION BY instrument_id ORDER BY nav_date) AS d, row_number() OVER (PARTITION BY instrument_id ORDER BY nav_date DESC) AS rn FROM nav),
    m AS (SELECT instrument_id, avg(greatest(d, 0)) FILTER (rn <= 14) AS g, avg(greatest(-d, 0)) FILTER (rn <= 14) AS l, count(d) FILTER (rn <= 14) AS n, avg(nav) FILTER (rn <= 20) AS mean, stddev_samp(nav) FILTER (rn <= 20) AS sd, count(*) FILTER (rn <= 20) AS k, max(nav) FILTER (rn = 1) AS last FROM d GROUP BY instrument_id),
    v AS (SELECT instrument_id, CASE WHEN n >= 14 THEN CASE WHEN l = 0 THEN CASE WHEN g > 0 THEN 100.0 ELSE 50.0 END ELSE 100 - 100 / (1 + g / l) END END AS rsi, CASE WHEN k >= 20 THEN CASE WHEN sd = 0 THEN 0.5 ELSE (last - mean + 2 * sd) / (4 * sd) END END AS band FROM m)
    SELECT instrument_id, round(rsi, 6) AS rsi, round(band, 6) AS band, round(CASE WHEN rsi IS NOT NULL AND band IS NOT NULL THEN 0.5 * rsi + 50 * band ELSE coalesce(rsi, 100 * band) END, 6) AS signal FROM v""", "nav"))  # fmt: skip
def momentum(spark, sf_dir):
    w = Window.partitionBy("instrument_id")
    df = view(spark, sf_dir, "nav").withColumn("d", F.col("nav") - F.lag("nav").over(w.orderBy("nav_date"))).withColumn("rn", F.row_number().over(w.orderBy(F.desc("nav_date"))))
    df = df.groupBy("instrument_id").agg(M.rsi().alias("rsi"), M.band_position().alias("band"))
    both = F.col("rsi").isNotNull() & F.col("band").isNotNull()
    return _r6(df.withColumn("signal", F.when(both, 0.5 * F.col("rsi") + 50 * F.col("band")).otherwise(F.coalesce("rsi", 100 * F.col("band")))))


@query("wn17_path_stability", oracle("""WITH t AS (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY nav_date DESC) AS rn FROM nav), f AS (SELECT *, count(*) OVER (PARTITION BY instrument_id) AS n, row_number() OVER (PARTITION BY instrument_id ORDER BY nav_date) - 1 AS i FROM t WHERE rn <= 63),
    y AS (SELECT *, ln(nav / first_value(nav) OVER (PARTITION BY instrument_id ORDER BY nav_date)) AS y FROM f), e AS (SELECT *, last_value(y) OVER (PARTITION BY instrument_id ORDER BY nav_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last FROM y)
    SELECT instrument_id, round(100 * (1 - least(sqrt(avg((y - last * i / (n - 1)) ** 2)) / greatest(stddev_samp(y), abs(any_value(last)), 1e-6), 1)), 4) AS score FROM e WHERE n >= 20 GROUP BY instrument_id""", "nav"))  # fmt: skip
def path_stability(spark, sf_dir):
    nav = view(spark, sf_dir, "nav").withColumn("rn", F.row_number().over(Window.partitionBy("instrument_id").orderBy(F.desc("nav_date"))))
    return R.path_stability(nav).select("instrument_id", F.round("score", 4).alias("score"))


_FLOW = """fl AS (SELECT instrument_id, nav_date, CASE WHEN lag(aum) OVER w IS NOT NULL THEN greatest(-0.25, least(0.25, (aum - lag(aum) OVER w * nav / lag(nav) OVER w) / lag(aum) OVER w)) END AS flow FROM nav WHERE nav > 0 AND aum > 0 WINDOW w AS (PARTITION BY instrument_id ORDER BY nav_date))"""


@query("wn19_external_flows", oracle(f"WITH {_FLOW} SELECT instrument_id, nav_date, round(flow, 6) AS flow FROM fl WHERE flow IS NOT NULL", "nav"))
def external_flows(spark, sf_dir):
    return R.external_flows(view(spark, sf_dir, "nav")).select("instrument_id", "nav_date", F.round("flow", 6).alias("flow"))


@query("wn20_flow_slope", oracle(f"""WITH {_FLOW}, t AS (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY nav_date DESC) AS rn FROM fl WHERE flow IS NOT NULL),
    c AS (SELECT instrument_id, row_number() OVER (PARTITION BY instrument_id ORDER BY nav_date) - 1 AS i, sum(flow) OVER (PARTITION BY instrument_id ORDER BY nav_date) AS cum FROM t WHERE rn <= 63)
    SELECT instrument_id, round(CASE WHEN count(*) >= 10 THEN greatest(0, least(100, 50 + 50 * tanh(regr_slope(cum, i) / 0.0025))) END, 4) AS score FROM c GROUP BY instrument_id""", "nav"))  # fmt: skip
def flow_slope(spark, sf_dir):
    cum = R.tail_cumulative(R.external_flows(view(spark, sf_dir, "nav")), 63, "flow", "instrument_id", "nav_date")
    return cum.groupBy("instrument_id").agg(F.round(M.slope_score(F.col("cum"), F.col("i"), 0.0025, 10), 4).alias("score"))


@query("wn21_wn22_moving_levels", oracle("""WITH t AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn, max(date) OVER (PARTITION BY ticker) AS as_of FROM prices)
    SELECT ticker, round(max(close) FILTER (rn = 1) / avg(close) FILTER (rn <= 20) - 1, 6) AS sma20, round(CASE WHEN count(*) >= 50 THEN max(close) FILTER (rn = 1) / avg(close) FILTER (rn <= 50) - 1 END, 6) AS sma50, round(avg(volume) FILTER (date > CAST(as_of - INTERVAL 1 MONTH AS DATE)), 6) AS mean_volume
    FROM t GROUP BY ticker HAVING count(*) >= 20""", "prices"))  # fmt: skip
def moving_levels(spark, sf_dir):
    w = Window.partitionBy("ticker")
    df = view(spark, sf_dir, "prices").withColumn("rn", F.row_number().over(w.orderBy(F.desc("date")))).withColumn("as_of", F.max("date").over(w))
    last, n = F.max(F.when(F.col("rn") == 1, F.col("close"))), F.count("*")
    sma = lambda k: F.when(n >= k, last / F.avg(F.when(F.col("rn") <= k, F.col("close"))) - 1)
    df = df.groupBy("ticker").agg(n.alias("n"), sma(20).alias("sma20"), sma(50).alias("sma50"), F.avg(F.when(F.col("date") > F.add_months("as_of", -1), F.col("volume"))).alias("mean_volume"))
    return _r6(df.where("n >= 20").drop("n"))


_ME = "me AS (SELECT instrument_id, last_day(nav_date) AS month_end, max_by(nav, nav_date) AS nav FROM nav GROUP BY ALL)"


@query("agg09_month_end", oracle(f"WITH {_ME} SELECT * FROM me", "nav"))
def month_end(spark, sf_dir):
    return R.month_end(view(spark, sf_dir, "nav"), "instrument_id", "nav_date", "nav")


@query("wn23_momentum_12_1", oracle(f"""WITH {_ME}, k AS (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY month_end DESC) AS k, count(*) OVER (PARTITION BY instrument_id) AS n FROM me)
    SELECT instrument_id, round(max(nav) FILTER (k = 2) / max(nav) FILTER (k = least(13, n)) - 1, 6) AS momentum FROM k WHERE n >= 12 GROUP BY instrument_id""", "nav"))  # fmt: skip
def momentum_12_1(spark, sf_dir):
    return _r6(R.momentum_12_1(R.month_end(view(spark, sf_dir, "nav"), "instrument_id", "nav_date", "nav"), "instrument_id", "month_end", "nav"))


@query("wn24_macro_change", oracle("""SELECT series_id, obs_date, round(CASE WHEN obs_date - lag(obs_date) OVER w <= 7 THEN (value - lag(value) OVER w) * 0.01 END, 6) AS change FROM macro WINDOW w AS (PARTITION BY series_id ORDER BY obs_date)""", "macro"))
def macro_change(spark, sf_dir):
    return R.gap_guarded_change(view(spark, sf_dir, "macro"), "series_id", "obs_date", "value").select("series_id", "obs_date", F.round("change", 6).alias("change"))


@query("wn25_derived_series", oracle("""SELECT 'spread' AS series_id, a.obs_date, round(a.value - b.value, 6) AS value FROM macro a JOIN macro b USING (obs_date) WHERE a.series_id = '1-URGENT' AND b.series_id = '5-LOW'
    UNION ALL SELECT a.series_id || '_YOY', a.obs_date, round(100 * (a.value / b.value - 1), 6) FROM monthly a JOIN monthly b ON a.series_id = b.series_id AND b.obs_date = CAST(a.obs_date - INTERVAL 12 MONTH AS DATE) WHERE b.value <> 0""", "macro", "monthly"))  # fmt: skip
def derived_series(spark, sf_dir):
    macro, monthly = view(spark, sf_dir, "macro"), view(spark, sf_dir, "monthly")
    one = lambda s, c: macro.where(F.col("series_id") == s).select("obs_date", F.col("value").alias(c))
    spread = one("1-URGENT", "a").join(one("5-LOW", "b"), "obs_date").select(F.lit("spread").alias("series_id"), "obs_date", F.round(F.col("a") - F.col("b"), 6).alias("value"))
    before = monthly.select("series_id", F.add_months("obs_date", 12).alias("obs_date"), F.col("value").alias("before")).where("before <> 0")
    yoy = monthly.join(before, ["series_id", "obs_date"]).select(F.concat("series_id", F.lit("_YOY")).alias("series_id"), "obs_date", F.round(100 * (F.col("value") / F.col("before") - 1), 6).alias("value"))
    return spread.unionByName(yoy)


@query("wn26_history_percentile", oracle("""WITH l AS (SELECT series_id, max_by(value, obs_date) AS now FROM macro GROUP BY series_id)
    SELECT series_id, round(CASE WHEN count(*) < 60 THEN 50.0 ELSE 100 * avg((value <= now)::INTEGER) END, 6) AS percentile FROM macro JOIN l USING (series_id) GROUP BY series_id""", "macro"))  # fmt: skip
def history_percentile(spark, sf_dir):
    return _r6(R.history_percentile(view(spark, sf_dir, "macro"), "series_id", "obs_date", "value"))


@query("wn27_wn28_window_returns", oracle("""WITH t AS (SELECT instrument_id, nav_date, nav / lag(nav, 21) OVER (PARTITION BY instrument_id ORDER BY nav_date) - 1 AS r21 FROM nav)
    SELECT instrument_id, round(min(r21), 6) AS worst, round(avg(r21), 6) AS mean, count(r21) AS n FROM t GROUP BY instrument_id""", "nav"))  # fmt: skip
def window_returns(spark, sf_dir):
    w = Window.partitionBy("instrument_id").orderBy("nav_date")
    df = view(spark, sf_dir, "nav").withColumn("r21", F.col("nav") / F.lag("nav", 21).over(w) - 1)
    return _r6(df.groupBy("instrument_id").agg(F.min("r21").alias("worst"), F.avg("r21").alias("mean"), F.count("r21").alias("n")))


@query("wn28_window_metrics", oracle("""WITH s AS (SELECT instrument_id, nav_date, nav, lag(nav) OVER w AS before, lag(nav, 5) OVER w AS back, max(nav) OVER (PARTITION BY instrument_id ORDER BY nav_date ROWS UNBOUNDED PRECEDING) AS peak FROM nav WINDOW w AS (PARTITION BY instrument_id ORDER BY nav_date))
    SELECT instrument_id, CASE WHEN count(*) < 3 THEN 0 ELSE round(stddev_samp(CASE WHEN before > 0 AND nav > 0 THEN ln(nav / before) WHEN before IS NOT NULL THEN 0 END) * sqrt(252), 6) END AS log_vol, round(max_by(nav, nav_date) / min_by(nav, nav_date) - 1, 6) AS window_return, round(max((peak - nav) / peak), 6) AS window_drawdown,
        round(CASE WHEN count(*) > 5 THEN min(nav / back - 1) ELSE max_by(nav, nav_date) / min_by(nav, nav_date) - 1 END, 6) AS worst_5 FROM s GROUP BY instrument_id""", "nav"))  # fmt: skip
def window_metrics(spark, sf_dir):
    return _r6(R.window_metrics(view(spark, sf_dir, "nav"), ["instrument_id"], "nav_date", "nav"))


@query("wn29_trailing_sums", oracle("""WITH t AS (SELECT instrument_id, count(*) OVER w AS k, sum(abs(r)) OVER w AS s FROM ret WINDOW w AS (PARTITION BY instrument_id ORDER BY nav_date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)), m AS (SELECT instrument_id, round(max(s) FILTER (k = 252), 6) AS top FROM t GROUP BY instrument_id),
    a AS (SELECT instrument_id, round(sum(abs(r)) / count(*) * 252, 6) AS yearly FROM ret GROUP BY instrument_id) SELECT * FROM m JOIN a USING (instrument_id)""", "ret"))  # fmt: skip
def trailing_sums(spark, sf_dir):
    w = Window.partitionBy("instrument_id").orderBy("nav_date").rowsBetween(-251, 0)
    df = _ret(spark, sf_dir).withColumn("k", F.count("*").over(w)).withColumn("s", F.sum(F.abs("r")).over(w))
    return _r6(df.groupBy("instrument_id").agg(F.max(F.when(F.col("k") == 252, F.col("s"))).alias("top"), (F.sum(F.abs("r")) / F.count("*") * 252).alias("yearly")))


@query("agg08_monthly_return", oracle("SELECT instrument_id, CAST(date_trunc('month', nav_date) AS DATE) AS month, round(max_by(nav, nav_date) / min_by(nav, nav_date) - 1, 6) AS r FROM nav GROUP BY ALL", "nav"))
def monthly_return(spark, sf_dir):
    df = view(spark, sf_dir, "nav").groupBy("instrument_id", F.trunc("nav_date", "month").alias("month"))
    return _r6(df.agg((F.max_by("nav", "nav_date") / F.min_by("nav", "nav_date") - 1).alias("r")))


@query("agg10_compound_months", oracle("SELECT instrument_id, CAST(date_trunc('month', nav_date) AS DATE) AS month, round(exp(sum(ln(1 + r))) - 1, 6) AS monthly_return FROM ret GROUP BY ALL", "ret"))
def compound_months(spark, sf_dir):
    return _r6(R.compound_months(_ret(spark, sf_dir), ["instrument_id"], "nav_date", "r"))


@query("prj01_prj04_guards", oracle("""SELECT o_orderkey, round(greatest(-9999.999999, least(9999.999999, o_totalprice)), 6) AS clipped, CASE WHEN abs(o_totalprice) <= 100000 THEN o_totalprice END AS guarded,
    round(CASE WHEN c_acctbal > 0 THEN o_totalprice / c_acctbal END, 6) AS ratio, CASE WHEN c_acctbal IS NOT NULL AND c_acctbal <> 0 THEN c_acctbal ELSE o_totalprice END AS fallback
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""))  # fmt: skip
def guards(spark, sf_dir):
    o, c = view(spark, sf_dir, "orders"), view(spark, sf_dir, "customer")
    price, balance = F.col("o_totalprice"), F.col("c_acctbal")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select("o_orderkey", M.clip(price).alias("clipped"), M.within(price, 100000).alias("guarded"), F.round(M.ratio(price, balance), 6).alias("ratio"), M.or_else(balance, price).alias("fallback"))


@query("entity_scorecard", oracle(f"""WITH m AS (SELECT instrument_id, max(nav) FILTER (rn = 1) / max(nav) FILTER (rn = 253) - 1 AS ret_1y, stddev_samp(r) FILTER (rn <= 252) * sqrt(252) AS vol_1y, (avg(r) FILTER (rn <= 252) - {RF}/252.0) / stddev_samp(r) FILTER (rn <= 252) * sqrt(252) AS sharpe_1y FROM ret GROUP BY instrument_id HAVING count(*) > 252),
    l AS (SELECT *, rank() OVER (PARTITION BY asset_class ORDER BY round(sharpe_1y, 9)) - 1 AS below, count(*) OVER (PARTITION BY asset_class, round(sharpe_1y, 9)) AS ties, count(*) OVER (PARTITION BY asset_class) AS n FROM m JOIN cohort USING (instrument_id))
    SELECT instrument_id, asset_class, round(ret_1y, 6) AS ret_1y, round(vol_1y, 6) AS vol_1y, round(sharpe_1y, 6) AS sharpe_1y, CASE WHEN n < 10 THEN 50.0 ELSE round(100.0 * (below + 0.5 * (ties - 1)) / (n - 1), 2) END AS percentile FROM l""", "ret", "cohort"))  # fmt: skip
def entity_scorecard(spark, sf_dir):
    """Flagship: scan, returns, one aggregation, cohort percentiles."""
    from almanac.operators.peers import midrank_percentile

    m = _ret(spark, sf_dir).groupBy("instrument_id").agg(F.count("*").alias("k"), M.annual_return(1).alias("ret_1y"), M.volatility(252).alias("vol_1y"), F.round(M.sharpe(252, RF), 9).alias("sharpe_1y"))
    df = m.where("k > 252").join(view(spark, sf_dir, "cohort"), "instrument_id")
    return _r6(midrank_percentile(df, "asset_class", "sharpe_1y", "percentile").select("instrument_id", "asset_class", "ret_1y", "vol_1y", "sharpe_1y", "percentile"))
