"""Queries over regimes, macro transforms and replay statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from almanac.functions.metrics import normal_cdf
from almanac.lens import oracle, view
from almanac.operators import asof, pit, replays, regimes as S
from almanac.plans.series import _r6
from almanac.registry import query

_SC = "sc AS (SELECT series_id AS axis, obs_date AS d, (value - 3) / 1.7319e0 AS score, day(obs_date) % 4 > 0 AS sure FROM macro)"


def _scores(spark, sf_dir):
    return view(spark, sf_dir, "macro").select(F.col("series_id").alias("axis"), F.col("obs_date").alias("d"), ((F.col("value") - 3) / 1.7319).alias("score"), (F.dayofmonth("obs_date") % 4 > 0).alias("sure"))


_BAND = """w AS (SELECT series_id, obs_date, value, list_sort(list(value) OVER (PARTITION BY series_id ORDER BY obs_date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)) AS l FROM macro),
    p AS (SELECT *, len(l) >= 60 AS ready, CASE WHEN len(l) >= 60 THEN l[floor(0.2 * (len(l) - 1))::INTEGER + 1] END AS p_entry, CASE WHEN len(l) >= 60 THEN l[floor(0.25 * (len(l) - 1))::INTEGER + 1] END AS p_exit FROM w),
    s AS (SELECT *, CASE WHEN ready IS NOT TRUE OR value >= p_exit THEN 'on' WHEN value < p_entry THEN 'off' END AS sig FROM p)"""


@query("st01_st02_band_regime", oracle(f"""WITH {_BAND} SELECT series_id, obs_date, round(p_entry, 6) AS p_entry, round(p_exit, 6) AS p_exit, coalesce(last_value(sig IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY obs_date), 'on') AS state,
    round(CASE WHEN ready THEN 100 * least(1, greatest(0, (0.5 - len(list_filter(l, lambda v: v <= value)) / len(l)) / 0.45)) END, 6) AS stress FROM s""", "macro"))  # fmt: skip
def band_regime(spark, sf_dir):
    df = S.band_regime(view(spark, sf_dir, "macro"), ["series_id"], "obs_date", "value", 252, 60, 0.2, 0.25)
    return _r6(df.select("series_id", "obs_date", "p_entry", "p_exit", "state", "stress"))


@query("st03_fixed_band", oracle(f"WITH {_SC} SELECT axis, d, coalesce(last_value(CASE WHEN score > 0 THEN true WHEN score < -0.05 THEN false END IGNORE NULLS) OVER (PARTITION BY axis ORDER BY d), false) AS active FROM sc", "macro"))
def fixed_band(spark, sf_dir):
    return _scores(spark, sf_dir).select("axis", "d", S.fixed_band(F.col("score"), 0.0, -0.05, Window.partitionBy("axis").orderBy("d")).alias("active"))


_TREND = """me AS (SELECT CAST(date_trunc('month', nav_date) AS DATE) AS m, max_by(nav, nav_date) AS c FROM bench GROUP BY ALL), tr AS (SELECT m, count(*) OVER w AS n, lag(c) OVER (ORDER BY m) AS last, avg(c) OVER w AS sma FROM me WINDOW w AS (ORDER BY m ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
    tv AS (SELECT m, n >= 10 AND round(last - sma, 6) < 0 AS trend FROM tr)"""


def _trend(spark, sf_dir):
    me = view(spark, sf_dir, "bench").groupBy(F.trunc("nav_date", "month").alias("m")).agg(F.max_by("nav", "nav_date").alias("c")).withColumn("k", F.lit(1))
    order = Window.partitionBy("k").orderBy("m")
    prior = order.rowsBetween(-10, -1)
    return me.select("m", ((F.count("*").over(prior) >= 10) & F.coalesce(F.round(F.lag("c").over(order) - F.avg("c").over(prior), 6) < 0, F.lit(False))).alias("trend"))


@query("st04_trend_vote", oracle(f"WITH {_TREND} SELECT m, coalesce(trend, false) AS trend FROM tv", "bench"))
def trend_vote(spark, sf_dir):
    return _trend(spark, sf_dir)


@query("st05_vote_composite", oracle(f"""WITH {_TREND}, {_SC}, a AS (SELECT d, score < -0.5 AS x FROM sc WHERE axis = '1-URGENT'), b AS (SELECT d, coalesce(last_value(CASE WHEN score > 0 THEN true WHEN score < -0.05 THEN false END IGNORE NULLS) OVER (ORDER BY d), false) AS y FROM sc WHERE axis = '2-HIGH'),
    v AS (SELECT a.d, x::INTEGER + coalesce(y, false)::INTEGER + coalesce(trend, false)::INTEGER AS votes FROM a ASOF LEFT JOIN b ON a.d >= b.d LEFT JOIN tv ON m = CAST(date_trunc('month', a.d) AS DATE))
    SELECT d, votes, CASE WHEN votes >= 2 THEN 'off' ELSE 'on' END AS state, (votes >= 2) <> coalesce(lag(votes >= 2) OVER (ORDER BY d), false) AS flip FROM v""", "macro", "bench"))  # fmt: skip
def vote_composite(spark, sf_dir):
    sc = _scores(spark, sf_dir).withColumn("k", F.lit(1))
    a = sc.where("axis = '1-URGENT'").select("k", "d", (F.col("score") < -0.5).alias("x"))
    b = sc.where("axis = '2-HIGH'").select("k", F.col("d").alias("bd"), S.fixed_band(F.col("score"), 0.0, -0.05, Window.partitionBy("axis").orderBy("d")).alias("y"))
    df = asof.asof_join(a, b, ["k"], "d", "bd", ["y"]).withColumn("m", F.trunc("d", "month")).join(_trend(spark, sf_dir), "m", "left")
    one = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    df = df.withColumn("votes", one(F.col("x")) + one(F.col("y")) + one(F.col("trend")))
    off = F.col("votes") >= 2
    return df.select("d", "votes", F.when(off, "off").otherwise("on").alias("state"), (off != F.coalesce(F.lag(off).over(Window.partitionBy("k").orderBy("d")), F.lit(False))).alias("flip"))


@query("st06_st07_debounced_gate", oracle("""WITH t AS (SELECT instrument_id, nav_date, nav, avg(nav) OVER (PARTITION BY instrument_id ORDER BY nav_date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS sma, count(*) OVER (PARTITION BY instrument_id ORDER BY nav_date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS k,
        nav / max(nav) OVER (PARTITION BY instrument_id ORDER BY nav_date ROWS BETWEEN 63 PRECEDING AND CURRENT ROW) - 1 AS dd FROM nav),
    v AS (SELECT instrument_id, nav_date, coalesce(k >= 60 AND round(nav - sma, 6) < 0, false) OR round(dd, 6) <= -0.05 AS raw FROM t),
    g AS (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY nav_date) - row_number() OVER (PARTITION BY instrument_id, raw ORDER BY nav_date) AS g FROM v), s AS (SELECT *, row_number() OVER (PARTITION BY instrument_id, raw, g ORDER BY nav_date) AS streak FROM g),
    st AS (SELECT instrument_id, nav_date, raw, coalesce(last_value(CASE WHEN streak >= 21 THEN raw END IGNORE NULLS) OVER (PARTITION BY instrument_id ORDER BY nav_date), false) AS state FROM s),
    f AS (SELECT *, state <> coalesce(lag(state) OVER (PARTITION BY instrument_id ORDER BY nav_date), false) AS flip FROM st), i AS (SELECT *, sum(flip::INTEGER) OVER (PARTITION BY instrument_id ORDER BY nav_date) AS isl FROM f)
    SELECT instrument_id, nav_date, raw, state, flip, row_number() OVER (PARTITION BY instrument_id, isl ORDER BY nav_date) AS dwell FROM i""", "nav"))  # fmt: skip
def debounced_gate(spark, sf_dir):
    w = Window.partitionBy("instrument_id").orderBy("nav_date")
    prior, seen = w.rowsBetween(-60, -1), w.rowsBetween(-63, 0)
    below = (F.count("*").over(prior) >= 60) & (F.round(F.col("nav") - F.avg("nav").over(prior), 6) < 0)
    deep = F.round(F.col("nav") / F.max("nav").over(seen) - 1, 6) <= -0.05
    df = view(spark, sf_dir, "nav").withColumn("raw", F.coalesce(below, F.lit(False)) | deep)
    return S.debounce(df, ["instrument_id"], "nav_date", "raw", 21).select("instrument_id", "nav_date", "raw", "state", "flip", "dwell")


@query("st08_quadrant", oracle("""WITH r AS (SELECT instrument_id, nav_date, nav / lag(nav, 126) OVER w - 1 AS g, aum / lag(aum, 63) OVER w - 1 AS i FROM nav WINDOW w AS (PARTITION BY instrument_id ORDER BY nav_date))
    SELECT instrument_id, nav_date, CASE WHEN g IS NULL OR i IS NULL THEN NULL WHEN g > 0 AND i > 0 THEN 'overheat' WHEN g > 0 THEN 'goldilocks' WHEN i > 0 THEN 'stagflation' ELSE 'deflation' END AS quadrant FROM r""", "nav"))  # fmt: skip
def quadrant(spark, sf_dir):
    w = Window.partitionBy("instrument_id").orderBy("nav_date")
    df = view(spark, sf_dir, "nav").withColumn("g", F.col("nav") / F.lag("nav", 126).over(w) - 1).withColumn("i", F.col("aum") / F.lag("aum", 63).over(w) - 1)
    known = F.col("g").isNotNull() & F.col("i").isNotNull()
    return df.select("instrument_id", "nav_date", F.when(~known, None).when((F.col("g") > 0) & (F.col("i") > 0), "overheat").when(F.col("g") > 0, "goldilocks").when(F.col("i") > 0, "stagflation").otherwise("deflation").alias("quadrant"))


_LATCH = "SELECT *, last_value(CASE WHEN abs(score) >= 1 {0} THEN sign(score)::INTEGER END IGNORE NULLS) OVER (PARTITION BY axis ORDER BY d) AS internal FROM {1}"


@query("st09_latched_replay", oracle(f"WITH {_SC}, l AS ({_LATCH.format('', 'sc')}) SELECT axis, d, internal, CASE WHEN internal * score >= 0.25 THEN internal END AS effective FROM l", "macro"))
def latched_replay(spark, sf_dir):
    return S.latched_sign(_scores(spark, sf_dir), ["axis"], "d", "score", 1.0, 0.25).select("axis", "d", "internal", "effective")


@query("st09_latched_live", oracle(f"""WITH {_SC}, b AS (SELECT *, max((abs(score) >= 1 AND sure)::INTEGER) OVER (PARTITION BY axis ORDER BY d) = 1 AS begun FROM sc), l AS ({_LATCH.format('AND begun', 'b')}), p AS (SELECT *, lag(internal) OVER (PARTITION BY axis ORDER BY d) AS prev FROM l)
    SELECT axis, d, internal, CASE WHEN internal * score >= 0.25 AND sure THEN internal END AS effective,
        CASE WHEN internal IS NULL THEN CASE WHEN abs(score) >= 1 THEN 'init_low_confidence' ELSE 'init_below_enter' END WHEN prev IS NULL THEN 'init' WHEN prev <> internal THEN CASE WHEN sure THEN 'switch' ELSE 'switch_low_confidence' END WHEN internal * score >= 0.25 THEN CASE WHEN sure THEN 'hold' ELSE 'hold_low_confidence' END ELSE 'deadband' END AS reason FROM p""", "macro"))  # fmt: skip
def latched_live(spark, sf_dir):
    return S.latched_sign(_scores(spark, sf_dir), ["axis"], "d", "score", 1.0, 0.25, "sure").select("axis", "d", "internal", "effective", "reason")


_Z = "z AS (SELECT obs_date AS d, series_id, CASE WHEN value < 6 THEN (value - 3) / 1.7319e0 END AS z, CASE series_id WHEN '1-URGENT' THEN 0.4 WHEN '2-HIGH' THEN 0.3 WHEN '3-MEDIUM' THEN -0.2 ELSE 0.1 END AS w FROM macro)"


def _z(spark, sf_dir):
    """Source registry as data: a small table of weights joined to the series."""
    registry = spark.createDataFrame([("1-URGENT", 0.4), ("2-HIGH", 0.3), ("3-MEDIUM", -0.2)], "series_id string, w double")
    m = view(spark, sf_dir, "macro").join(F.broadcast(registry), "series_id", "left")
    return m.select(F.col("obs_date").alias("d"), "series_id", F.when(F.col("value") < 6, (F.col("value") - 3) / 1.7319).alias("z"), F.coalesce("w", F.lit(0.1)).alias("w"))


@query("st10_st14_st19_axis_score", oracle(f"WITH {_Z} SELECT d, round(sum(w * z) / sum(abs(w)) FILTER (z IS NOT NULL), 6) AS score, count(z) AS n FROM z GROUP BY d", "macro"))
def axis_score(spark, sf_dir):
    return _r6(S.axis_scores(_z(spark, sf_dir), ["d"]))


@query("st21_contributions", oracle(f"WITH {_Z} SELECT d, series_id, round(w * z / sum(abs(w)) FILTER (z IS NOT NULL) OVER (PARTITION BY d), 6) AS contribution FROM z QUALIFY z IS NOT NULL", "macro"))
def contributions(spark, sf_dir):
    return _r6(S.contributions(_z(spark, sf_dir), ["d"]).select("d", "series_id", "contribution"))


@query("st11_confidence", oracle(f"""WITH {_SC}, l AS (SELECT *, list_distinct(list(score) OVER (PARTITION BY axis ORDER BY d ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)) AS l FROM sc), m AS (SELECT *, list_median(l) AS m FROM l),
    u AS (SELECT axis, d, score, CASE WHEN len(l) >= 24 THEN greatest(1.4826 * list_median(list_transform(l, lambda x: abs(x - m))), 0.25) END AS u FROM m),
    t AS (SELECT *, abs(score) / u AS z, 1 / (1 + 0.2316419 * abs(score) / u) AS t FROM u)
    SELECT axis, d, round(u, 6) AS u, round(1 - exp(-z * z / 2) / 2.5066282746310002 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))), 6) AS confidence FROM t""", "macro"))  # fmt: skip
def confidence(spark, sf_dir):
    df = S.rolling_uncertainty(_scores(spark, sf_dir), ["axis"], "d", "score", 36, 24, 0.25, "u")
    return _r6(df.select("axis", "d", "u", normal_cdf(F.abs("score") / F.col("u")).alias("confidence")))


@query("st12_status", oracle("""SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'invalid' WHEN o_totalprice < 20000 THEN 'unavailable' WHEN o_orderstatus = 'P' THEN 'stale' WHEN o_custkey % 10 / 10.0 < 0.3 THEN 'low_confidence' WHEN o_totalprice / 300000 < 0.2 THEN 'low_confidence' WHEN o_orderpriority = '5-LOW' THEN 'low_confidence' ELSE 'valid' END AS status FROM orders"""))
def status(spark, sf_dir):
    o = view(spark, sf_dir, "orders")
    s = S.status(F.col("o_orderkey") % 50 == 0, F.when(F.col("o_totalprice") < 20000, 0.5).otherwise(1.0), F.col("o_orderstatus") == "P", F.when(F.col("o_custkey") % 10 < 3, 0.5).otherwise(1.0), F.when(F.col("o_totalprice") / 300000 < 0.2, 0.5).otherwise(1.0), F.col("o_orderpriority") == "5-LOW")
    return o.select("o_orderkey", s.alias("status"))


@query("st13_stale_after", oracle("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) SELECT d, CAST(least(d + CASE dayofweek(d) WHEN 4 THEN 4 WHEN 5 THEN 4 WHEN 6 THEN 3 ELSE 2 END, d + 3) AS DATE) AS stale_after, sha256(CAST(d AS VARCHAR) || '|v1') AS id FROM d"""))
def stale_after(spark, sf_dir):
    d = view(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    days = F.filter(F.sequence(F.date_add("d", 1), F.date_add("d", 6)), lambda x: F.weekday(x) < 5)
    return d.select("d", F.least(F.get(days, F.lit(1)), F.date_add("d", 3)).alias("stale_after"), F.sha2(F.concat(F.col("d").cast("string"), F.lit("|v1")), 256).alias("id"))


@query("st15_soft_threshold", oracle("""WITH e AS (SELECT series_id, abs(value - lag(value) OVER (PARTITION BY series_id, observation_period ORDER BY vintage_date)) AS a, vintage_date, value FROM vintages), q AS (SELECT series_id, quantile_cont(a, 0.9) AS t FROM e WHERE a > 0 GROUP BY series_id)
    SELECT series_id, vintage_date, round(sum(CASE WHEN a > t THEN sign(a) * (a - t) ELSE 0 END), 4) AS beyond, count(*) AS n FROM e JOIN q USING (series_id) GROUP BY ALL""", "vintages"))  # fmt: skip
def soft_threshold(spark, sf_dir):
    w = Window.partitionBy("series_id", "observation_period").orderBy("vintage_date")
    e = view(spark, sf_dir, "vintages").withColumn("a", F.abs(F.col("value") - F.lag("value").over(w)))
    q = e.where("a > 0").groupBy("series_id").agg(F.percentile("a", F.lit(0.9)).alias("t"))
    return e.join(q, "series_id").groupBy("series_id", "vintage_date").agg(F.round(F.sum(F.when(F.col("a") > F.col("t"), F.col("a") - F.col("t")).otherwise(0.0)), 4).alias("beyond"), F.count("*").alias("n"))


@query("st16_smoothing", oracle(f"""WITH RECURSIVE {_SC}, g AS (SELECT *, CAST(date_trunc('month', d) AS DATE) AS m FROM sc), p AS (SELECT axis, m, CASE WHEN month(m) NOT IN (1, 7) THEN min_by(score, d) END AS x, row_number() OVER (PARTITION BY axis ORDER BY m) AS k FROM g GROUP BY axis, m),
    e AS (SELECT axis, k, m, x AS ema FROM p WHERE k = 1 UNION ALL SELECT p.axis, p.k, p.m, CASE WHEN e.ema IS NULL OR p.x IS NULL THEN p.x ELSE sqrt(0.5) * e.ema + (1 - sqrt(0.5)) * p.x END FROM e JOIN p ON p.axis = e.axis AND p.k = e.k + 1)
    SELECT g.axis, d, round(ema, 6) AS ema FROM g JOIN e ON g.axis = e.axis AND g.m = e.m""", "macro").replace("WITH macro", "WITH RECURSIVE macro", 1).replace(", RECURSIVE", ",", 1))  # fmt: skip
def smoothing(spark, sf_dir):
    """Scores are missing in two months of the year: the average is, too, and starts anew."""
    df = _scores(spark, sf_dir).withColumn("m", F.trunc("d", "month")).withColumn("score", F.when(~F.month("d").isin(1, 7), F.col("score")))
    return _r6(S.smoothed(df, ["axis"], "d", "score", "m").select("axis", "d", "ema"))


@query("st17_carry_unchanged", oracle("""WITH h AS (SELECT series_id, obs_date, round(value, 0) AS v FROM macro), c AS (SELECT *, v IS DISTINCT FROM lag(v) OVER (PARTITION BY series_id ORDER BY obs_date) AS changed FROM h)
    SELECT series_id, obs_date, changed, last_value(CASE WHEN changed THEN obs_date END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY obs_date) AS computed FROM c""", "macro"))  # fmt: skip
def carry_unchanged(spark, sf_dir):
    w = Window.partitionBy("series_id").orderBy("obs_date")
    h = F.xxhash64(F.round("value", 0))
    df = view(spark, sf_dir, "macro").withColumn("changed", ~F.lag(h).over(w).eqNullSafe(h))
    return df.select("series_id", "obs_date", "changed", S.held(F.when(F.col("changed"), F.col("obs_date")), w).alias("computed"))


@query("st18_reason_lists", oracle("""SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_totalprice > 200000 THEN 'large' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END, CASE WHEN isodow(o_orderdate) > 5 THEN 'closed' END], lambda x: x IS NOT NULL), ';') AS reasons FROM orders"""))
def reason_lists(spark, sf_dir):
    reasons = F.array_compact(F.array(F.when(F.col("o_totalprice") > 200000, "large"), F.when(F.col("o_orderstatus") == "P", "pending"), F.when(F.weekday("o_orderdate") >= 5, "closed")))
    return view(spark, sf_dir, "orders").select("o_orderkey", F.array_join(reasons, ";").alias("reasons"))


@query("st20_monthly_decisions", oracle("""WITH cal AS (SELECT last_day(CAST(d AS DATE)) AS cut FROM range(TIMESTAMP '1996-01-31', TIMESTAMP '2000-01-15', INTERVAL 1 MONTH) t(d)), r AS (SELECT cut, v.*, row_number() OVER (PARTITION BY cut, series_id, observation_period ORDER BY available_at DESC, revision_number DESC) AS n FROM cal JOIN vintages v ON available_at <= CAST(cut AS TIMESTAMP)),
    s AS (SELECT cut, series_id, round(max_by(value, observation_period) / avg(value) - 1, 9) AS z FROM r WHERE n = 1 GROUP BY ALL), a AS (SELECT cut, sum(z * CASE series_id WHEN '1-URGENT' THEN 0.6 ELSE 0.4 END) / sum(CASE series_id WHEN '1-URGENT' THEN 0.6 ELSE 0.4 END) AS score FROM s GROUP BY cut),
    l AS (SELECT *, last_value(CASE WHEN abs(round(score, 9)) >= 0.5 THEN sign(score)::INTEGER END IGNORE NULLS) OVER (ORDER BY cut) AS internal FROM a)
    SELECT cut, round(score, 6) AS score, internal, CASE WHEN internal * round(score, 9) >= 0.25 THEN internal END AS effective FROM l""", "vintages"))  # fmt: skip
def monthly_decisions(spark, sf_dir):
    cal = spark.sql("SELECT last_day(d) AS cut FROM (SELECT explode(sequence(DATE '1996-01-31', DATE '1999-12-31', INTERVAL 1 MONTH)) AS d)")
    p = pit.panel(view(spark, sf_dir, "vintages"), cal, "cut").groupBy("cut", "series_id").agg(F.round(F.max_by("value", "observation_period") / F.avg("value") - 1, 9).alias("z"))
    s = S.axis_scores(p.withColumn("w", F.when(F.col("series_id") == "1-URGENT", 0.6).otherwise(0.4)), ["cut"]).withColumn("score", F.round("score", 9)).withColumn("k", F.lit(1))
    return _r6(S.latched_sign(s, ["k"], "cut", "score", 0.5, 0.25).select("cut", "score", "internal", "effective"))


@query("st22_resume_chain", oracle(f"""WITH {_SC}, l AS ({_LATCH.format('', 'sc')}), old AS (SELECT axis, max_by(internal, d) AS seed FROM l WHERE d < DATE '1998-01-01' GROUP BY axis), new AS (SELECT axis, d, score, last_value(CASE WHEN abs(score) >= 1 THEN sign(score)::INTEGER END IGNORE NULLS) OVER (PARTITION BY axis ORDER BY d) AS own FROM sc WHERE d >= DATE '1998-01-01')
    SELECT axis, d, coalesce(own, seed) AS internal FROM new LEFT JOIN old USING (axis)""", "macro"))  # fmt: skip
def resume_chain(spark, sf_dir):
    """A rerun from a date reproduces the chain: the newest state strictly before it is the seed."""
    sc = _scores(spark, sf_dir)
    seed = S.latched_sign(sc.where("d < DATE '1998-01-01'"), ["axis"], "d", "score", 1.0, 0.25).groupBy("axis").agg(F.max_by("internal", "d").alias("seed"))
    new = S.latched_sign(sc.where("d >= DATE '1998-01-01'"), ["axis"], "d", "score", 1.0, 0.25)
    return new.join(seed, "axis", "left").select("axis", "d", F.coalesce("internal", "seed").alias("internal"))


@query("wn32_transforms", oracle("""WITH t AS (SELECT series_id, obs_date, value, avg(value) OVER (PARTITION BY series_id ORDER BY obs_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS a, avg(value) OVER (PARTITION BY series_id ORDER BY obs_date ROWS BETWEEN 5 PRECEDING AND 3 PRECEDING) AS b, row_number() OVER (PARTITION BY series_id ORDER BY obs_date) AS k FROM monthly)
    SELECT t.series_id, t.obs_date, round(CASE WHEN k >= 6 THEN 4 * (ln(a) - ln(b)) END, 6) AS log_3m3m, round(CASE WHEN k >= 3 THEN a - 3 END, 6) AS mean3_gap, round(t.value - m3.value, 6) AS delta_3m, round(4 * (ln(t.value) - ln(m3.value)), 6) AS log_qoq, round(4 * (ln(t.value) - ln(m3.value)) - (ln(t.value) - ln(m12.value)), 6) AS ann3m_minus_yoy
    FROM t LEFT JOIN monthly m3 ON m3.series_id = t.series_id AND m3.obs_date = CAST(t.obs_date - INTERVAL 3 MONTH AS DATE) LEFT JOIN monthly m12 ON m12.series_id = t.series_id AND m12.obs_date = CAST(t.obs_date - INTERVAL 12 MONTH AS DATE)""", "monthly"))  # fmt: skip
def transforms(spark, sf_dir):
    from almanac.operators.macro import economic_transforms

    return _r6(economic_transforms(view(spark, sf_dir, "monthly"), "series_id", "obs_date", "value", 3.0).drop("value", "delta_3m_yoy"))


@query("wn33_wn34_robust_z", oracle("""WITH l AS (SELECT series_id, obs_date, value, list_distinct(list(value) OVER (PARTITION BY series_id ORDER BY obs_date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)) AS l FROM monthly), m AS (SELECT *, list_median(l) AS m FROM l), s AS (SELECT *, 1.4826 * list_median(list_transform(l, lambda x: abs(x - m))) AS s FROM m)
    SELECT series_id, obs_date, round(CASE WHEN len(l) >= 2 AND s > 0 THEN greatest(-4, least(4, (value - m) / s)) END, 6) AS z FROM s""", "monthly"))  # fmt: skip
def robust_z(spark, sf_dir):
    from almanac.operators.macro import robust_z as z

    return _r6(z(view(spark, sf_dir, "monthly"), "series_id", "obs_date", "value", 60).select("series_id", "obs_date", "z"))


@query("wn35_component_score", oracle("""WITH t AS (SELECT series_id, obs_date, value - lag(value, 3) OVER w AS c3, value - lag(value, 6) OVER w AS c6, value - lag(value, 12) OVER w AS c12 FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY obs_date))
    SELECT series_id, obs_date, round((coalesce(0.5 * c3, 0) + coalesce(0.3 * c6, 0) + coalesce(0.2 * c12, 0)) / (0.5 + CASE WHEN c6 IS NULL THEN 0 ELSE 0.3 END + CASE WHEN c12 IS NULL THEN 0 ELSE 0.2 END), 6) AS score FROM t WHERE c3 IS NOT NULL""", "monthly"))  # fmt: skip
def component_score(spark, sf_dir):
    from almanac.operators.macro import weighted_components

    w = Window.partitionBy("series_id").orderBy("obs_date")
    df = view(spark, sf_dir, "monthly").withColumns({f"c{k}": F.col("value") - F.lag("value", k).over(w) for k in (3, 6, 12)})
    return _r6(df.where("c3 IS NOT NULL").select("series_id", "obs_date", weighted_components({"c3": 0.5, "c6": 0.3, "c12": 0.2}).alias("score")))


_STATE = f"{_SC}, st AS (SELECT axis, d, CASE WHEN score > 0.5 THEN 'up' WHEN score < -0.5 THEN 'down' END AS state FROM sc)"


def _states(spark, sf_dir):
    return _scores(spark, sf_dir).select("axis", "d", F.when(F.col("score") > 0.5, "up").when(F.col("score") < -0.5, "down").alias("state"))


@query("rp01_replay_metrics", oracle(f"""WITH {_STATE}, f AS (SELECT *, last_value(state IGNORE NULLS) OVER (PARTITION BY axis ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM st)
    SELECT axis, count(*) AS n, count(state) AS valid, count(*) FILTER (state <> prev) AS flips, round(count(*) FILTER (state <> prev) / (date_diff('day', min(d), max(d)) / 365.25), 6) AS flips_per_year, round(count(*) FILTER (state = 'up') / count(state), 6) AS up_share FROM f GROUP BY axis""", "macro"))  # fmt: skip
def replay_metrics(spark, sf_dir):
    df = _states(spark, sf_dir)
    before = F.last("state", ignorenulls=True).over(Window.partitionBy("axis").orderBy("d").rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("flip", F.coalesce(F.col("state") != before, F.lit(False)))
    flips = F.count_if("flip")
    return _r6(df.groupBy("axis").agg(F.count("*").alias("n"), F.count("state").alias("valid"), flips.alias("flips"), (flips / (F.datediff(F.max("d"), F.min("d")) / 365.25)).alias("flips_per_year"), (F.count_if(F.col("state") == "up") / F.count("state")).alias("up_share")))


@query("rp02_runs", oracle(f"""WITH {_STATE}, g AS (SELECT *, row_number() OVER (PARTITION BY axis ORDER BY d) - row_number() OVER (PARTITION BY axis, state ORDER BY d) AS g FROM st) SELECT axis, state, min(d) AS first, max(d) AS last, count(*) AS n FROM g GROUP BY axis, state, g""", "macro"))
def state_runs(spark, sf_dir):
    return S.runs(_states(spark, sf_dir), ["axis"], "d", "state")


_TRANS = "tr AS (SELECT * FROM (SELECT *, lag(state) OVER (PARTITION BY axis ORDER BY d) AS before FROM st WHERE state IS NOT NULL) WHERE state <> before)"


@query("rp03_nearest_lags", oracle(f"""WITH {_STATE}, {_TRANS}, c AS (SELECT a.d, b.d - a.d AS lag FROM tr a, tr b WHERE a.axis = '1-URGENT' AND b.axis = '2-HIGH') SELECT d, arg_min(lag, (abs(lag), lag)) AS lag FROM c GROUP BY d""", "macro"))
def nearest_lags(spark, sf_dir):
    t = S.transitions(_states(spark, sf_dir), ["axis"], "d", "state").withColumn("k", F.lit(1))
    return S.nearest_lags(t.where("axis = '1-URGENT'"), t.where("axis = '2-HIGH'"), ["k"], "d").select("d", "lag")


# Business days from a Monday on: five a week, and up to five of the last. The walk takes the left dates in order.
_WEEKDAYS = "((({0} - DATE '1990-01-01') // 7) * 5 + least(({0} - DATE '1990-01-01') % 7 + 1, 5))"


@query("rp03_monotonic_matches", oracle(f"""WITH RECURSIVE {_STATE}, {_TRANS}, l AS (SELECT d, row_number() OVER (ORDER BY d) AS k FROM tr WHERE axis = '1-URGENT'), r AS (SELECT d, row_number() OVER (ORDER BY d) AS i FROM tr WHERE axis = '2-HIGH'),
    p AS (SELECT k, i, l.d AS a_date, r.d AS b_date, CASE WHEN r.d = l.d THEN 0 WHEN r.d > l.d THEN {_WEEKDAYS.format("r.d")} - {_WEEKDAYS.format("(l.d - 1)")} - 1 ELSE 1 - {_WEEKDAYS.format("l.d")} + {_WEEKDAYS.format("(r.d - 1)")} END AS lag FROM l JOIN r ON abs(l.d - r.d) < 200),
    q AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY abs(lag), lag, i) AS near FROM p WHERE abs(lag) <= 126),
    walk AS (SELECT 0::BIGINT AS k, 0::BIGINT AS at, 0::BIGINT AS chosen UNION ALL SELECT w.k + 1, coalesce((SELECT arg_min(i, near) FROM q WHERE q.k = w.k + 1 AND q.i > w.at), w.at), coalesce((SELECT arg_min(i, near) FROM q WHERE q.k = w.k + 1 AND q.i > w.at), 0) FROM walk w WHERE w.k < (SELECT max(k) FROM l))
    SELECT 1 AS k, a_date, b_date, lag::INTEGER AS lag FROM walk w JOIN q ON q.k = w.k AND q.i = w.chosen""", "macro").replace("WITH macro", "WITH RECURSIVE macro", 1).replace(", RECURSIVE", ",", 1))  # fmt: skip
def monotonic_matches(spark, sf_dir):
    # One sequence, as a match may cross any date; both sides are as short as the calendar.
    t = S.transitions(_states(spark, sf_dir), ["axis"], "d", "state").withColumn("k", F.lit(1))
    return S.monotonic_matches(t.where("axis = '1-URGENT'"), t.where("axis = '2-HIGH'"), "k", "d", 126)


@query("rp04_operational", oracle(f"""WITH {_STATE}, i AS (SELECT *, row_number() OVER (PARTITION BY axis ORDER BY d) AS i FROM st), a AS (SELECT *, i - last_value(CASE WHEN state IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY axis ORDER BY d) AS age FROM i)
    SELECT axis, max(age) AS oldest, round(avg(age), 6) AS mean_age, min(d) FILTER (state IS NOT NULL) AS first_ready, count(*) FILTER (age <= 3) AS consumable FROM a GROUP BY axis""", "macro"))  # fmt: skip
def operational(spark, sf_dir):
    w = Window.partitionBy("axis").orderBy("d")
    df = _states(spark, sf_dir).withColumn("i", F.row_number().over(w))
    df = df.withColumn("age", F.col("i") - S.held(F.when(F.col("state").isNotNull(), F.col("i")), w))
    return _r6(df.groupBy("axis").agg(F.max("age").alias("oldest"), F.avg("age").alias("mean_age"), F.min(F.when(F.col("state").isNotNull(), F.col("d"))).alias("first_ready"), F.count_if(F.col("age") <= 3).alias("consumable")))


_TWO = "a AS (SELECT d, score AS x FROM sc WHERE axis = '1-URGENT'), b AS (SELECT d, score AS y FROM sc WHERE axis = '2-HIGH')"


@query("rp05_rp11_parity", oracle(f"""WITH {_SC}, {_TWO} SELECT coalesce(a.d, b.d) AS d, CASE WHEN x IS NULL THEN 'missing_left' WHEN y IS NULL THEN 'missing_right' WHEN sign(x) <> sign(y) THEN 'sign' ELSE 'value' END AS kind, round(abs(x - y), 6) AS gap FROM a FULL JOIN b ON a.d = b.d WHERE x IS NULL OR y IS NULL OR abs(x - y) > 0.5""", "macro"))
def parity(spark, sf_dir):
    sc = _scores(spark, sf_dir)
    a, b = sc.where("axis = '1-URGENT'").select("d", F.col("score").alias("x")), sc.where("axis = '2-HIGH'").select("d", F.col("score").alias("y"))
    df = a.join(b, "d", "full_outer").withColumn("gap", F.abs(F.col("x") - F.col("y"))).where("x IS NULL OR y IS NULL OR gap > 0.5")
    kind = F.when(F.col("x").isNull(), "missing_left").when(F.col("y").isNull(), "missing_right").when(F.signum("x") != F.signum("y"), "sign").otherwise("value")
    return _r6(df.select("d", kind.alias("kind"), "gap"))


_HALVES = "span AS (SELECT min(d) AS a, max(d) AS b, min(d) + CAST(floor((max(d) - min(d)) / 2) AS INTEGER) AS m FROM st), folds AS (SELECT 'full' AS fold, a AS lo, b AS hi FROM span UNION ALL SELECT 'early', a, m FROM span UNION ALL SELECT 'late', m + 1, b FROM span)"


@query("rp06_fold_metrics", oracle(f"WITH {_STATE}, {_HALVES} SELECT fold, axis, count(*) AS n, round(count(state) / count(*), 6) AS valid_rate FROM st JOIN folds ON d BETWEEN lo AND hi GROUP BY ALL", "macro"))
def fold_metrics(spark, sf_dir):
    """The whole period of the states and its halves."""
    st = _states(spark, sf_dir)
    df = st.crossJoin(F.broadcast(replays.halves(st, "d"))).where("d BETWEEN lo AND hi")
    return _r6(df.groupBy("fold", "axis").agg(F.count("*").alias("n"), (F.count("state") / F.count("*")).alias("valid_rate")))


_GRID = "cfg AS (SELECT e / 4.0 AS enter, x / 8.0 AS leave, abs(e / 4.0 - 1) + abs(x / 8.0 - 0.25) AS distance FROM range(2, 7) a(e), range(1, 5) b(x) WHERE x / 8.0 < e / 4.0)"
_EVAL = f"""{_GRID}, l AS (SELECT enter, leave, distance, axis, d, score, last_value(CASE WHEN abs(score) >= enter THEN sign(score)::INTEGER END IGNORE NULLS) OVER (PARTITION BY enter, leave, axis ORDER BY d) AS internal FROM sc, cfg),
    m AS (SELECT enter, leave, any_value(distance) AS distance, count(*) FILTER (internal * score >= leave) AS valid, count(*) AS n FROM l GROUP BY enter, leave)"""


def _configs(spark):
    a, b = spark.range(2, 7).select((F.col("id") / 4).alias("enter")), spark.range(1, 5).select((F.col("id") / 8).alias("leave"))
    return a.crossJoin(b).where("leave < enter").withColumn("distance", F.abs(F.col("enter") - 1) + F.abs(F.col("leave") - 0.25))


def _evaluated(spark, sf_dir):
    df = _scores(spark, sf_dir).crossJoin(F.broadcast(_configs(spark)))
    internal = S.held(F.when(F.abs("score") >= F.col("enter"), F.signum("score").cast("int")), Window.partitionBy("enter", "leave", "axis").orderBy("d"))
    df = df.withColumn("internal", internal)
    return df.groupBy("enter", "leave").agg(F.first("distance").alias("distance"), F.count_if(F.col("internal") * F.col("score") >= F.col("leave")).alias("valid"), F.count("*").alias("n"))


@query("rp07_rp09_rp10_rp13_config_grid", oracle(f"WITH {_SC}, {_EVAL} SELECT enter, leave, distance, valid, round(valid / n, 6) AS rate FROM m ORDER BY valid DESC, distance, enter, leave LIMIT 5", "macro"))
def config_grid(spark, sf_dir):
    return _evaluated(spark, sf_dir).orderBy(F.desc("valid"), "distance", "enter", "leave").limit(5).select("enter", "leave", "distance", "valid", F.round(F.col("valid") / F.col("n"), 6).alias("rate"))


@query("rp08_rp12_control_delta", oracle(f"""WITH {_SC}, {_EVAL}, c AS (SELECT valid AS base FROM m WHERE distance = 0) SELECT enter, leave, valid - base AS delta, CASE WHEN valid >= base THEN 'pass' WHEN valid >= 0.9 * base THEN 'conditional' ELSE 'fail' END AS gate FROM m, c""", "macro"))
def control_delta(spark, sf_dir):
    m = _evaluated(spark, sf_dir)
    base = m.where("distance = 0").select(F.col("valid").alias("base"))
    gate = F.when(F.col("valid") >= F.col("base"), "pass").when(F.col("valid") >= 0.9 * F.col("base"), "conditional").otherwise("fail")
    return m.crossJoin(F.broadcast(base)).select("enter", "leave", (F.col("valid") - F.col("base")).alias("delta"), gate.alias("gate"))


@query("cal01_calendars", oracle("""WITH r AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders), d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d FROM r) SELECT d, d = last_day(d) AS month_end, CAST(d AS TIMESTAMP) + INTERVAL 86399 SECOND AS cut FROM d WHERE isodow(d) <= 5"""))
def calendars(spark, sf_dir):
    r = view(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    d = r.select(F.explode(F.sequence("lo", "hi")).alias("d")).where(F.weekday("d") < 5)
    return d.select("d", (F.col("d") == F.last_day("d")).alias("month_end"), F.expr("cast(d AS timestamp_ntz) + INTERVAL 86399 SECOND").alias("cut"))


@query("pos01_pos02_fold_stability", oracle("""WITH s AS (SELECT CAST(date_trunc('month', min(nav_date)) AS DATE) AS a, max(nav_date) AS b FROM ret), f AS (SELECT k, CAST(a + to_months((12 * k + 36)::INTEGER) AS DATE) AS lo, CAST(a + to_months((12 * k + 48)::INTEGER) AS DATE) AS hi FROM s, range(0, 100) x(k) WHERE CAST(a + to_months((12 * k + 48)::INTEGER) AS DATE) <= b),
    m AS (SELECT instrument_id, k, round(avg(r), 9) AS mean FROM ret JOIN f ON nav_date >= lo AND nav_date < hi GROUP BY ALL), d AS (SELECT instrument_id, median(mean) AS med FROM m GROUP BY instrument_id)
    SELECT instrument_id, count(*) AS folds, round(max(abs(mean - med)), 6) AS stability FROM m JOIN d USING (instrument_id) GROUP BY instrument_id""", "ret"))  # fmt: skip
def fold_stability(spark, sf_dir):
    """Mean returns of the test years of all folds between the first and the last date."""
    from almanac.plans.series import _ret

    r = _ret(spark, sf_dir)
    first, last = r.agg(F.trunc(F.min("nav_date"), "month"), F.max("nav_date")).first()
    folds = F.broadcast(replays.fold_bounds(spark, first, last, 36, 12, 12))
    m = r.join(folds, (F.col("nav_date") >= F.col("test_from")) & (F.col("nav_date") < F.col("test_to"))).groupBy("instrument_id", "k").agg(F.round(F.avg("r"), 9).alias("mean"))
    med = m.groupBy("instrument_id").agg(F.median("mean").alias("med"))
    return _r6(m.join(med, "instrument_id").groupBy("instrument_id").agg(F.count("*").alias("folds"), F.max(F.abs(F.col("mean") - F.col("med"))).alias("stability")))


@query("pos03_pos04_scheduling", oracle("""WITH dec AS (SELECT last_day(obs_date) AS decided, max_by(value, obs_date) AS v FROM macro WHERE series_id = '1-URGENT' AND month(obs_date) % 3 = 0 GROUP BY ALL), s AS (SELECT decided, v, nav_date AS traded FROM dec ASOF JOIN bench ON decided <= nav_date)
    SELECT b.nav_date, v IS NOT NULL AS covered, CASE WHEN s.traded IS NULL THEN 'absent' WHEN s.traded = b.nav_date THEN 'fresh' ELSE 'carried' END AS kind FROM bench b ASOF LEFT JOIN (SELECT traded, max_by(v, decided) AS v FROM s GROUP BY traded) s ON b.nav_date >= s.traded""", "macro", "bench"))  # fmt: skip
def scheduling(spark, sf_dir):
    dec = view(spark, sf_dir, "macro").where("series_id = '1-URGENT' AND month(obs_date) % 3 = 0").groupBy(F.last_day("obs_date").alias("decided")).agg(F.max_by("value", "obs_date").alias("v"))
    days = view(spark, sf_dir, "bench").select("nav_date", F.col("nav_date").alias("traded"))
    s = asof.asof_join(dec, days, [], "decided", "nav_date", ["traded"], forward=True, slices=asof.SLICES).where("traded IS NOT NULL").groupBy("traded").agg(F.max_by("v", "decided").alias("v")).withColumn("since", F.col("traded"))
    df = asof.asof_join(days.select("nav_date"), s, [], "nav_date", "traded", ["v", "since"], slices=asof.SLICES)
    return df.select("nav_date", F.col("v").isNotNull().alias("covered"), F.when(F.col("since").isNull(), "absent").when(F.col("since") == F.col("nav_date"), "fresh").otherwise("carried").alias("kind"))


@query("pos05_dominant_state", oracle(f"WITH {_STATE}, c AS (SELECT axis, CAST(date_trunc('year', d) AS DATE) AS y, coalesce(state, 'none') AS state, count(*) AS n FROM st GROUP BY ALL) SELECT axis, y, state, n FROM c QUALIFY row_number() OVER (PARTITION BY axis, y ORDER BY n DESC, state) = 1", "macro"))
def dominant_state(spark, sf_dir):
    c = _states(spark, sf_dir).groupBy("axis", F.trunc("d", "year").alias("y"), F.coalesce("state", F.lit("none")).alias("state")).agg(F.count("*").alias("n"))
    return c.withColumn("k", F.row_number().over(Window.partitionBy("axis", "y").orderBy(F.desc("n"), "state"))).where("k = 1").drop("k")


_WT = "wt AS (SELECT series_id, report_date, sector, sum(pct) / 100 AS w FROM holdings GROUP BY ALL)"


def _weights(spark, sf_dir):
    return view(spark, sf_dir, "holdings").groupBy("series_id", "report_date", "sector").agg((F.sum("pct") / 100).alias("w"))


@query("pos06_turnover", oracle(f"""WITH {_WT}, dt AS (SELECT series_id, report_date, lead(report_date) OVER (PARTITION BY series_id ORDER BY report_date) AS nxt FROM (SELECT DISTINCT series_id, report_date FROM wt)), p AS (SELECT w.series_id, nxt AS report_date, sector, w FROM wt w JOIN dt USING (series_id, report_date) WHERE nxt IS NOT NULL),
    c AS (SELECT w.series_id, w.report_date, sector, w FROM wt w WHERE report_date > (SELECT min(report_date) FROM wt x WHERE x.series_id = w.series_id))
    SELECT series_id, report_date, round(sum(abs(coalesce(c.w, 0) - coalesce(p.w, 0))) / 2, 6) AS turnover FROM c FULL JOIN p USING (series_id, report_date, sector) GROUP BY series_id, report_date""", "holdings"))  # fmt: skip
def turnover(spark, sf_dir):
    from almanac.operators.positions import turnover as t

    return _r6(t(_weights(spark, sf_dir), "series_id", "report_date", "sector", "w"))


@query("pos07_weight_constraints", oracle(f"""WITH {_WT}, c AS (SELECT *, CASE WHEN sector IN ('Brand#11', 'Brand#12', 'Brand#13') THEN 1 ELSE 0 END AS risky FROM wt WHERE w > 0.002), n AS (SELECT *, w / sum(w) OVER (PARTITION BY series_id, report_date) AS x FROM c),
    s AS (SELECT *, coalesce(sum(x) FILTER (risky = 1) OVER (PARTITION BY series_id, report_date), 0) AS r, coalesce(sum(x) FILTER (risky = 0) OVER (PARTITION BY series_id, report_date), 0) AS f FROM n)
    SELECT series_id, report_date, sector, round(CASE WHEN r <= 0.1 OR f = 0 THEN x WHEN risky = 1 THEN x * 0.1 / r ELSE x * 0.9 / f END, 6) AS weight FROM s""", "holdings"))  # fmt: skip
def weight_constraints(spark, sf_dir):
    from almanac.operators.positions import capped_weights

    w = _weights(spark, sf_dir).where("w > 0.002").withColumn("risky", F.col("sector").isin("Brand#11", "Brand#12", "Brand#13"))
    return _r6(capped_weights(w, ["series_id", "report_date"], "w", "risky", 0.1).select("series_id", "report_date", "sector", "weight"))


@query("pos08_panel_flags", oracle("""WITH ses AS (SELECT date, row_number() OVER (ORDER BY date) AS s FROM (SELECT DISTINCT date FROM prices)), p AS (SELECT ticker, date, close, volume, s, s - lag(s) OVER (PARTITION BY ticker ORDER BY date) AS gap, row_number() OVER (PARTITION BY ticker ORDER BY date) - row_number() OVER (PARTITION BY ticker, volume > 25 ORDER BY date) AS g FROM prices JOIN ses USING (date)),
    q AS (SELECT *, count(*) OVER (PARTITION BY ticker, volume > 25, g) AS run FROM p) SELECT ticker, count(*) FILTER (close <= 0) AS bad_close, count(*) FILTER (gap > 60) AS gaps, count(*) FILTER (volume <= 25 AND run > 3) AS dry FROM q GROUP BY ticker""", "prices"))  # fmt: skip
def panel_flags(spark, sf_dir):
    from almanac.operators.positions import panel_flags as f

    return f(view(spark, sf_dir, "prices"), "ticker", "date", most_gap=60, dry=F.col("volume") <= 25, most_dry=3)


@query("pos09_gates", oracle(f"WITH {_STATE}, m AS (SELECT axis, count(state) / count(*) AS rate, count(*) AS n FROM st GROUP BY axis) SELECT axis, round(rate, 6) AS rate, CASE WHEN rate >= 0.6 AND n >= 100 THEN 'go' ELSE 'no-go' END AS gate FROM m", "macro"))
def gates(spark, sf_dir):
    m = _states(spark, sf_dir).groupBy("axis").agg((F.count("state") / F.count("*")).alias("rate"), F.count("*").alias("n"))
    return m.select("axis", F.round("rate", 6).alias("rate"), F.when((F.col("rate") >= 0.6) & (F.col("n") >= 100), "go").otherwise("no-go").alias("gate"))


@query("prj15_prj17_indicator_scores", oracle("""SELECT series_id, obs_date, round(greatest(0, least(100, 50 + 10 * (v - 3))), 6) AS linear, round(CASE WHEN v <= 2 THEN 20.0 WHEN v <= 4 THEN 20 + 30 * (v - 2) ELSE 80.0 END, 6) AS piecewise, round(greatest(0, 100 * (1 - abs(v - 3) / 4)), 6) AS peaked FROM (SELECT *, value / 1.7319e0 AS v FROM macro)""", "macro"))
def indicator_scores(spark, sf_dir):
    from almanac.functions.metrics import peaked

    v = F.col("value") / 1.7319
    linear = F.greatest(F.lit(0.0), F.least(F.lit(100.0), 50 + 10 * (v - 3)))
    return _r6(view(spark, sf_dir, "macro").select("series_id", "obs_date", linear.alias("linear"), F.when(v <= 2, 20.0).when(v <= 4, 20 + 30 * (v - 2)).otherwise(80.0).alias("piecewise"), peaked(v, 3.0, 4.0).alias("peaked")))
