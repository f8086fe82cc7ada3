"""Queries over joins, point-in-time reads, cohorts and regressions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from almanac.functions import metrics as M
from almanac.lens import oracle, view
from almanac.operators import asof, peers, pit, regress
from almanac.operators import returns as R
from almanac.plans.series import RF, _r6, _ret
from almanac.operators.selection import quantiles
from almanac.registry import query
from almanac.work import checkpointed


def _bret(spark, sf_dir):
    b = view(spark, sf_dir, "bench").withColumn("k", F.lit(1))
    return R.simple_returns(b, "k", "nav_date", "nav").select("nav_date", F.col("r").alias("b"))


@query("jn01_common_dates", oracle("SELECT instrument_id, count(*) AS n, round(sum(r * b), 6) AS cross FROM ret JOIN bret USING (nav_date) GROUP BY instrument_id", "ret", "bret"))
def common_dates(spark, sf_dir):
    return _r6(regress.paired(_ret(spark, sf_dir), _bret(spark, sf_dir)).groupBy("instrument_id").agg(F.count("*").alias("n"), F.sum(F.col("r") * F.col("b")).alias("cross")))


@query("jn02_lookup", oracle("SELECT instrument_id, label, count(*) AS n FROM nav LEFT JOIN cohort USING (instrument_id) GROUP BY ALL", "nav", "cohort"))
def lookup(spark, sf_dir):
    return view(spark, sf_dir, "nav").join(view(spark, sf_dir, "cohort"), "instrument_id", "left").groupBy("instrument_id", "label").agg(F.count("*").alias("n"))


_PIVOT = "piv AS (SELECT cik, period_end, max(val) FILTER (concept = '1-URGENT') AS a, max(val) FILTER (concept = '5-LOW') AS b FROM facts GROUP BY cik, period_end)"


def _pivot(spark, sf_dir):
    return view(spark, sf_dir, "facts").groupBy("cik", "period_end").pivot("concept", ["1-URGENT", "5-LOW"]).agg(F.max("val")).withColumnsRenamed({"1-URGENT": "a", "5-LOW": "b"})


@query("agg01_facts_pivot", oracle(f"WITH {_PIVOT} SELECT * FROM piv", "facts"))
def facts_pivot(spark, sf_dir):
    return _pivot(spark, sf_dir)


@query("jn03_asof_join", oracle(f"""WITH {_PIVOT}, h AS (SELECT series_id, report_date, CAST(series_id AS BIGINT) AS cik FROM holdings GROUP BY series_id, report_date)
    SELECT h.series_id, h.report_date, a, b FROM h ASOF LEFT JOIN piv ON h.cik = piv.cik AND h.report_date >= piv.period_end""", "facts", "holdings"))  # fmt: skip
def asof_join(spark, sf_dir):
    h = view(spark, sf_dir, "holdings").select("series_id", "report_date", F.col("series_id").cast("bigint").alias("cik")).distinct()
    return asof.asof_join(h, _pivot(spark, sf_dir), ["cik"], "report_date", "period_end", ["a", "b"]).select("series_id", "report_date", "a", "b")


@query("jn04_asof_year_before", oracle(f"""WITH {_PIVOT} SELECT l.cik, l.period_end, l.a, r.a AS year_before FROM piv l ASOF LEFT JOIN (SELECT cik, CAST(period_end + INTERVAL 12 MONTH AS DATE) AS due, a FROM (SELECT * FROM piv)) r
    ON l.cik = r.cik AND l.period_end >= r.due""", "facts"))  # fmt: skip
def asof_year_before(spark, sf_dir):
    p = _pivot(spark, sf_dir)
    before = p.select("cik", F.expr("period_end + INTERVAL 12 MONTH").cast("date").alias("due"), F.col("a").alias("year_before"))
    return asof.asof_join(p, before, ["cik"], "period_end", "due", ["year_before"]).select("cik", "period_end", "a", "year_before")


@query("jn05_asof_annual", oracle(f"""WITH {_PIVOT}, y AS (SELECT cik, period_end AS y_end, max(val) AS annual FROM facts WHERE fp = 'F' GROUP BY cik, period_end)
    SELECT piv.cik, piv.period_end, annual FROM piv ASOF LEFT JOIN y ON piv.cik = y.cik AND piv.period_end >= y.y_end""", "facts"))  # fmt: skip
def asof_annual(spark, sf_dir):
    annual = view(spark, sf_dir, "facts").where("fp = 'F'").groupBy("cik", F.col("period_end").alias("y_end")).agg(F.max("val").alias("annual"))
    return asof.asof_join(_pivot(spark, sf_dir), annual, ["cik"], "period_end", "y_end", ["annual"]).select("cik", "period_end", "annual")


@query("jn06_asof_scalar", oracle("""WITH d AS (SELECT DISTINCT nav_date FROM bench), s AS (SELECT obs_date, value FROM monthly WHERE series_id = '1-URGENT' AND obs_date >= DATE '1996-01-01')
    SELECT nav_date, coalesce(value / 100, 0.04) AS rf FROM d ASOF LEFT JOIN s ON nav_date >= obs_date""", "bench", "monthly"))  # fmt: skip
def asof_scalar(spark, sf_dir):
    s = view(spark, sf_dir, "monthly").where("series_id = '1-URGENT' AND obs_date >= DATE '1996-01-01'")
    d = view(spark, sf_dir, "bench").select("nav_date")
    return asof.asof_join(d, s, [], "nav_date", "obs_date", ["value"], slices=asof.SLICES).select("nav_date", F.coalesce(F.col("value") / 100, F.lit(0.04)).alias("rf"))


@query("jn07_jn08_spine_fill", oracle("""SELECT b.nav_date, a.value AS urgent, l.value AS low FROM bench b ASOF LEFT JOIN (SELECT * FROM monthly WHERE series_id = '1-URGENT') a ON b.nav_date >= a.obs_date ASOF LEFT JOIN (SELECT * FROM monthly WHERE series_id = '5-LOW') l ON b.nav_date >= l.obs_date""", "bench", "monthly"))
def spine_fill(spark, sf_dir):
    wide = view(spark, sf_dir, "monthly").groupBy(F.col("obs_date").alias("nav_date")).pivot("series_id", ["1-URGENT", "5-LOW"]).agg(F.max("value")).withColumnsRenamed({"1-URGENT": "urgent", "5-LOW": "low"})
    return asof.fill_onto_spine(view(spark, sf_dir, "bench"), wide, "nav_date", ["urgent", "low"])


@query("jn09_pick_one", oracle("SELECT c_nationkey, min(c_custkey) AS least, max_by(c_name, (c_acctbal, c_custkey)) AS largest FROM customer GROUP BY c_nationkey"))
def pick_one(spark, sf_dir):
    return view(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.min("c_custkey").alias("least"), F.max_by("c_name", F.struct("c_acctbal", "c_custkey")).alias("largest"))


@query("jn10_semi_anti", oracle("""SELECT 'semi' AS kind, count(*) AS n FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) UNION ALL SELECT 'anti', count(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"""))
def semi_anti(spark, sf_dir):
    c, o = view(spark, sf_dir, "customer"), view(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_semi").agg(F.lit("semi").alias("kind"), F.count("*").alias("n")).unionByName(c.join(o, "c_custkey", "left_anti").agg(F.lit("anti").alias("kind"), F.count("*").alias("n")))


@query("jn11_hld05_latest_report", oracle("SELECT series_id, report_date, count(*) AS n, round(sum(market_value), 2) AS value FROM latest_holdings GROUP BY ALL", "latest_holdings"))
def latest_report(spark, sf_dir):
    h = view(spark, sf_dir, "holdings")
    last = h.where("report_date <= DATE '1998-06-30'").groupBy("series_id").agg(F.max("report_date").alias("report_date"))
    return h.join(last, ["series_id", "report_date"]).groupBy("series_id", "report_date").agg(F.count("*").alias("n"), F.round(F.sum("market_value"), 2).alias("value"))


@query("jn14_scalar_cross", oracle("SELECT c_custkey, c_acctbal, m AS top FROM customer CROSS JOIN (SELECT max(c_acctbal) AS m FROM customer)"))
def scalar_cross(spark, sf_dir):
    c = view(spark, sf_dir, "customer")
    return c.crossJoin(F.broadcast(c.agg(F.max("c_acctbal").alias("top")))).select("c_custkey", "c_acctbal", "top")


@query("jn15_jn16_first_match", oracle("""SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, coalesce(a.n_name, b.c_name, 'part-' || p.p_partkey) AS matched FROM lineitem
    LEFT JOIN (SELECT n_nationkey AS k, min(n_name) AS n_name FROM nation GROUP BY ALL) a ON l_partkey = a.k LEFT JOIN (SELECT c_custkey AS k, min(c_name) AS c_name FROM customer WHERE c_acctbal > 0 GROUP BY ALL) b ON l_suppkey = b.k LEFT JOIN part p ON l_partkey = p.p_partkey"""))  # fmt: skip
def first_match(spark, sf_dir):
    p = view(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("name"))
    tables = [(F.col("l_partkey"), view(spark, sf_dir, "nation").withColumn("k", F.col("n_nationkey").cast("bigint")), "k", "n_name"), (F.col("l_suppkey"), view(spark, sf_dir, "customer").where("c_acctbal > 0"), "c_custkey", "c_name"), (F.col("l_partkey"), p, "p_partkey", "name")]
    return asof.first_match(view(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber"), tables, "matched")


@query("jn17_first_by_order", oracle("SELECT p_brand, arg_min(p_type, (p_size, p_partkey)) AS first_type FROM part WHERE p_type IS NOT NULL GROUP BY p_brand"))
def first_by_order(spark, sf_dir):
    return view(spark, sf_dir, "part").where("p_type IS NOT NULL").groupBy("p_brand").agg(F.min_by("p_type", F.struct("p_size", "p_partkey")).alias("first_type"))


@query("jn18_interval_slices", oracle("""WITH t AS (SELECT DISTINCT instrument_id, last_day(nav_date) AS as_of FROM nav)
    SELECT t.instrument_id, as_of, count(*) AS n, round(avg(nav), 6) AS mean FROM t JOIN nav ON t.instrument_id = nav.instrument_id AND nav_date > CAST(as_of - INTERVAL 12 MONTH AS DATE) AND nav_date <= as_of GROUP BY ALL""", "nav"))  # fmt: skip
def interval_slices(spark, sf_dir):
    nav = view(spark, sf_dir, "nav")
    t = nav.select("instrument_id", F.last_day("nav_date").alias("as_of")).distinct()
    return _r6(asof.interval_slices(t, nav, "instrument_id", "as_of", "nav_date", 12).groupBy("instrument_id", "as_of").agg(F.count("*").alias("n"), F.avg("nav").alias("mean")))


@query("jn19_fan_out", oracle("SELECT c.instrument_id, m.obs_date, m.value FROM cohort c JOIN macro m ON m.series_id = CASE c.asset_class WHEN 'ASIA' THEN '1-URGENT' WHEN 'EUROPE' THEN '2-HIGH' ELSE '3-MEDIUM' END", "cohort", "macro"))
def fan_out(spark, sf_dir):
    named = spark.createDataFrame([("ASIA", "1-URGENT"), ("EUROPE", "2-HIGH")], "asset_class string, series_id string")
    c = view(spark, sf_dir, "cohort").join(F.broadcast(named), "asset_class", "left").withColumn("series_id", F.coalesce("series_id", F.lit("3-MEDIUM")))
    return c.join(view(spark, sf_dir, "macro"), "series_id").select("instrument_id", "obs_date", "value")


CUT = "1998-06-30"


@query("pit01_asof_read", oracle(f"SELECT series_id, observation_period, vintage_date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id, observation_period ORDER BY available_at DESC, revision_number DESC) AS n FROM vintages WHERE available_at <= TIMESTAMP '{CUT}') WHERE n = 1", "vintages"))
def asof_read(spark, sf_dir):
    return pit.as_of(view(spark, sf_dir, "vintages"), CUT).select("series_id", "observation_period", "vintage_date", "value")


def _calendar(vintages):
    """Month ends from the first vintage to the last."""
    months = F.sequence(F.trunc(F.min("vintage_date"), "month"), F.trunc(F.max("vintage_date"), "month"), F.expr("INTERVAL 1 MONTH"))
    return vintages.agg(months.alias("m")).select(F.explode("m").alias("d")).select(F.last_day("d").alias("cut"))


_CAL = "cal AS (SELECT last_day(CAST(d AS DATE)) AS cut FROM (SELECT unnest(generate_series(CAST(date_trunc('month', min(vintage_date)) AS TIMESTAMP), CAST(max(vintage_date) AS TIMESTAMP), INTERVAL 1 MONTH)) AS d FROM vintages))"
_PANEL = "SELECT cut, series_id, observation_period, value FROM (SELECT cut, v.*, row_number() OVER (PARTITION BY cut, series_id, observation_period ORDER BY available_at {0}, revision_number {0}) AS n FROM cal JOIN vintages v ON available_at <= CAST(cut AS TIMESTAMP)) WHERE n = 1"


@query("pit02_panel_latest", oracle(f"WITH {_CAL} {_PANEL.format('DESC')}", "vintages"))
def panel_latest(spark, sf_dir):
    v = view(spark, sf_dir, "vintages")
    return pit.panel(v, _calendar(v), "cut").select("cut", "series_id", "observation_period", "value")


@query("pit02_panel_first_release", oracle(f"WITH {_CAL} {_PANEL.format('ASC')}", "vintages"))
def panel_first(spark, sf_dir):
    v = view(spark, sf_dir, "vintages")
    return pit.panel(v, _calendar(v), "cut", "first_release").select("cut", "series_id", "observation_period", "value")


# Every eleventh vintage of the store stands twice, and every seventh says it was available a day before its date.
_STORE = "store AS (SELECT series_id, observation_period, vintage_date, CASE WHEN day(observation_period) + month(vintage_date) * 5 + year(vintage_date) = 2003 THEN available_at - INTERVAL 1 DAY ELSE available_at END AS available_at, value, revision_number FROM vintages UNION ALL SELECT series_id, observation_period, vintage_date, available_at, value, revision_number FROM vintages WHERE revision_number % 11 = 5)"


@query("pit03_leak_probe", oracle(f"""WITH {_STORE}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id, observation_period ORDER BY available_at DESC, revision_number DESC) AS n FROM vintages WHERE available_at <= TIMESTAMP '{CUT}'), k AS (SELECT count(*) AS selected_rows, sum(CAST(round(value * 100000) AS HUGEINT))::DOUBLE AS selected_sum FROM r WHERE n = 1),
    c AS (SELECT series_id, observation_period, vintage_date, count(*) AS n, count(*) FILTER (CAST(available_at AS DATE) < vintage_date) AS early FROM store GROUP BY ALL)
    SELECT any_value(selected_rows) AS before_rows, any_value(selected_rows) AS after_rows, any_value(selected_sum) AS before_sum, any_value(selected_sum) AS after_sum, sum(n)::BIGINT AS rows, sum(n - 1)::BIGINT AS duplicate_keys, sum(early)::BIGINT AS available_early FROM c, k""", "vintages"))  # fmt: skip
def leak_probe(spark, sf_dir):
    """What a read selects as of a cut, before and after later revisions come in, and the checks of a store with faults."""
    v = view(spark, sf_dir, "vintages")
    later = v.withColumn("available_at", F.lit("2030-01-01").cast("timestamp")).withColumn("value", F.col("value") + 1).withColumn("revision_number", F.col("revision_number") + 1000)
    summed = lambda df, p: pit.as_of(df, CUT).agg(F.count("*").alias(f"{p}_rows"), F.sum(F.round(F.col("value") * 100000).cast("decimal(38,0)")).cast("double").alias(f"{p}_sum"))
    early = F.dayofmonth("observation_period") + F.month("vintage_date") * 5 + F.year("vintage_date") == 2003
    store = v.withColumn("available_at", F.when(early, F.col("available_at") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("available_at"))).unionByName(v.where("revision_number % 11 = 5"))
    return summed(v, "before").crossJoin(summed(v.unionByName(later), "after")).crossJoin(pit.store_checks(store))


_EARLY = "early AS (SELECT series_id, observation_period, vintage_date, CASE WHEN revision_number = 0 AND month(observation_period) % 5 = 0 THEN available_at - INTERVAL 70 DAY ELSE available_at END AS available_at, value, revision_number FROM vintages)"


@query("pit03_coverage", oracle(f"""WITH {_EARLY}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id, observation_period ORDER BY available_at DESC, revision_number DESC) AS n FROM early WHERE available_at <= TIMESTAMP '{CUT}'), f AS (SELECT series_id, count(*) FILTER (observation_period > DATE '{CUT}') AS selected_later FROM r WHERE n = 1 GROUP BY series_id)
    SELECT series_id, count(*) AS rows, min(observation_period) AS observation_min, max(observation_period) AS observation_max, min(vintage_date) AS vintage_min, max(vintage_date) AS vintage_max, coalesce(any_value(selected_later), 0) AS selected_later FROM early LEFT JOIN f USING (series_id) GROUP BY series_id""", "vintages"))  # fmt: skip
def coverage(spark, sf_dir):
    """A store in which some first releases come before their period begins."""
    first = (F.col("revision_number") == 0) & (F.month("observation_period") % 5 == 0)
    early = view(spark, sf_dir, "vintages").withColumn("available_at", F.when(first, F.col("available_at") - F.expr("INTERVAL 70 DAY")).otherwise(F.col("available_at")))
    return pit.coverage(early, CUT)


@query("pit04_freshness", oracle("""SELECT series_id, observation_period, round(CASE WHEN age <= 45 THEN 1.0 WHEN age >= 90 THEN 0.0 ELSE (90 - age) / 45.0 END, 6) AS freshness, round(exp(-ln(2) * age / 60), 6) AS decay, round(least(1, revision_number / 6.0), 6) AS maturity
    FROM (SELECT *, DATE '1998-06-30' - observation_period AS age FROM (SELECT *, row_number() OVER (PARTITION BY series_id, observation_period ORDER BY available_at DESC, revision_number DESC) AS n FROM vintages WHERE available_at <= TIMESTAMP '1998-06-30') WHERE n = 1)""", "vintages"))  # fmt: skip
def freshness(spark, sf_dir):
    df = pit.as_of(view(spark, sf_dir, "vintages"), CUT).withColumn("age", F.datediff(F.lit(CUT).cast("date"), "observation_period"))
    fresh = F.when(F.col("age") <= 45, 1.0).when(F.col("age") >= 90, 0.0).otherwise((90 - F.col("age")) / 45.0)
    return _r6(df.select("series_id", "observation_period", fresh.alias("freshness"), F.exp(-F.ln(F.lit(2.0)) * F.col("age") / 60).alias("decay"), F.least(F.lit(1.0), F.col("revision_number") / 6.0).alias("maturity")))


@query("pit05_pit06_revisions", oracle("""WITH d AS (SELECT *, value - lag(value) OVER (PARTITION BY series_id, observation_period ORDER BY vintage_date) AS delta FROM vintages), e AS (SELECT * FROM d WHERE delta <> 0)
    SELECT series_id, vintage_date, round(avg(abs(delta)), 4) AS mean_abs, round(quantile_cont(abs(delta), 0.9), 4) AS p90, count(*) AS n FROM e GROUP BY ALL""", "vintages"))  # fmt: skip
def revision_events(spark, sf_dir):
    e = pit.revisions(view(spark, sf_dir, "vintages"))
    # Rounded as doubles, from the lower value on: halves are common, as values have five digits, and other orders tip them.
    fine = lambda x: F.floor(x * 10000 + 0.5) / 10000
    at = 0.9 * (F.count("*") - 1)
    value = lambda k: F.get(F.sort_array(F.collect_list(F.abs("delta"))), k.cast("int"))
    p90 = value(F.floor(at)) + (value(F.ceil(at)) - value(F.floor(at))) * (at - F.floor(at))
    return e.groupBy("series_id", "vintage_date").agg(fine(F.avg(F.abs("delta"))).alias("mean_abs"), fine(p90).alias("p90"), F.count("*").alias("n"))


@query("pit07_series_audit", oracle("""SELECT series_id, count(DISTINCT observation_period) AS periods, round(avg(vintage_date - observation_period) FILTER (revision_number = 0), 4) AS mean_lag, quantile_cont(vintage_date - observation_period, 0.5) FILTER (revision_number = 0) AS median_lag,
    round(count(DISTINCT observation_period) FILTER (revision_number > 0) / count(DISTINCT observation_period), 6) AS ever_revised, min(vintage_date) AS first_eligible FROM vintages GROUP BY series_id""", "vintages"))  # fmt: skip
def series_audit(spark, sf_dir):
    v = view(spark, sf_dir, "vintages")
    lag, first = F.datediff("vintage_date", "observation_period"), F.col("revision_number") == 0
    return _r6(v.groupBy("series_id").agg(F.count_distinct("observation_period").alias("periods"), F.round(F.avg(F.when(first, lag)), 4).alias("mean_lag"), F.percentile(F.when(first, lag), F.lit(0.5)).alias("median_lag"), (F.count_distinct(F.when(~first, F.col("observation_period"))) / F.count_distinct("observation_period")).alias("ever_revised"), F.min("vintage_date").alias("first_eligible")))


@query("pit08_merged_batches", oracle("""WITH a AS (SELECT series_id, observation_period, vintage_date, value, 0 AS k FROM vintages), b AS (SELECT series_id, observation_period, vintage_date, value + 1, 1 FROM vintages WHERE observation_period >= DATE '1998-01-01')
    SELECT series_id, observation_period, vintage_date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id, observation_period, vintage_date ORDER BY k DESC) AS n FROM (FROM a UNION ALL FROM b)) WHERE n = 1""", "vintages"))  # fmt: skip
def merged_batches(spark, sf_dir):
    v = view(spark, sf_dir, "vintages").select("series_id", "observation_period", "vintage_date", "value")
    return pit.merged([v, v.where("observation_period >= DATE '1998-01-01'").withColumn("value", F.col("value") + 1)], ["series_id", "observation_period", "vintage_date"])


_PEER = "p AS (SELECT c_custkey, c_mktsegment AS label, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS v FROM customer)"


@query("jn12_peers_below", oracle("""SELECT a.instrument_id, a.label, count(b.instrument_id) FILTER (b.size < a.size) AS below, count(b.instrument_id) FILTER (b.size = a.size) AS ties, count(b.instrument_id) AS peers
    FROM cohort a LEFT JOIN cohort b ON a.label = b.label AND a.instrument_id <> b.instrument_id GROUP BY a.instrument_id, a.label, a.size""", "cohort"))  # fmt: skip
def peers_below(spark, sf_dir):
    """Peers below and level with each entity, itself excluded: window counts in place of the theta self-join."""
    label, value = Window.partitionBy("label"), Window.partitionBy("label", "size")
    below = F.rank().over(label.orderBy("size")) - 1
    return view(spark, sf_dir, "cohort").select("instrument_id", "label", below.cast("bigint").alias("below"), (F.count("*").over(value) - 1).alias("ties"), (F.count("*").over(label) - 1).alias("peers"))


@query("peer01_peer02_percentile", oracle(f"""WITH {_PEER}, r AS (SELECT *, rank() OVER (PARTITION BY label ORDER BY v NULLS LAST) - 1 AS below, count(v) OVER (PARTITION BY label, v) AS ties, count(v) OVER (PARTITION BY label) AS m, count(*) OVER (PARTITION BY label) AS n FROM p),
    q AS (SELECT c_custkey, label, CASE WHEN n < 10 THEN 50.0 WHEN v IS NOT NULL THEN round(100.0 * (below + 0.5 * (ties - 1)) / (m - 1), 2) END AS percentile, n FROM r)
    SELECT c_custkey, label, percentile, CASE WHEN n < 10 THEN 2 WHEN percentile >= 75 THEN 1 WHEN percentile >= 50 THEN 2 WHEN percentile >= 25 THEN 3 ELSE 4 END AS quartile FROM q"""))  # fmt: skip
def peer_percentile(spark, sf_dir):
    df = view(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("label"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("v"))
    df = peers.midrank_percentile(df, "label", "v", "percentile").withColumn("n", F.count("*").over(Window.partitionBy("label")))
    return df.select("c_custkey", "label", "percentile", peers.quartile(F.col("percentile"), F.col("n")).alias("quartile"))


@query("agg05_percentile_bands", oracle("SELECT c_mktsegment, round(quantile_cont(c_acctbal, 0.25), 6) AS p25, round(quantile_cont(c_acctbal, 0.5), 6) AS p50, round(quantile_cont(c_acctbal, 0.75), 6) AS p75 FROM customer GROUP BY ALL"))
def percentile_bands(spark, sf_dir):
    return _r6(peers.bands(view(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal"))


@query("peer03_label_resolution", oracle("SELECT o_custkey, o_orderpriority AS label FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'P') DESC, o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1"))
def label_resolution(spark, sf_dir):
    o = view(spark, sf_dir, "orders").withColumn("manual", F.col("o_orderstatus") == "P")
    return peers.resolved_labels(o, "o_custkey", "manual", "o_orderdate", "o_orderkey").select("o_custkey", F.col("o_orderpriority").alias("label"))


_SCORE = "CASE WHEN {0} IS NOT NULL THEN greatest(0, least(100, ({0} - {1}) / ({2} - {3}) * 100)) END"


@query("agg06_peer04_composite", oracle(f"""WITH m AS (SELECT instrument_id, round(max(nav) FILTER (rn = 1) / max(nav) FILTER (rn = 253) - 1, 9) AS a, CASE WHEN CAST(instrument_id AS INTEGER) % 7 > 0 THEN round(stddev_samp(r) FILTER (rn <= 252) * sqrt(252), 9) END AS b FROM ret GROUP BY instrument_id),
    s AS (SELECT instrument_id, asset_class, {_SCORE.format('a', '(-0.2)', '0.4', '(-0.2)')} AS sa, {_SCORE.format('b', '0.0', '0.3', '0.0')} AS sb FROM m JOIN cohort USING (instrument_id)), p AS (SELECT asset_class, median(sb) AS pb FROM s GROUP BY asset_class)
    SELECT instrument_id, round(0.6 * sa + 0.4 * coalesce(sb, CASE WHEN pb IS NOT NULL THEN greatest(0, least(100, pb - 5)) END, 45), 4) AS composite, sb IS NULL AS degraded FROM s JOIN p USING (asset_class)""", "ret", "cohort"))  # fmt: skip
def composite(spark, sf_dir):
    m = _ret(spark, sf_dir).groupBy("instrument_id").agg(F.round(M.trailing_return(252), 9).alias("a"), F.round(M.volatility(252), 9).alias("b"))
    m = m.withColumn("b", F.when(F.col("instrument_id").cast("int") % 7 > 0, F.col("b"))).join(view(spark, sf_dir, "cohort"), "instrument_id")
    # A row per instrument, kept: the medians take more than one pass over it.
    m = checkpointed(m.select("instrument_id", "asset_class", "a", "b"))
    scored = m.select("asset_class", F.when(F.col("b").isNotNull(), M.normalised(F.col("b"), 0.0, 0.3)["score"]).alias("score"))
    medians = quantiles(scored, ["asset_class"], "score", {"peer": 0.5}).drop("n")
    m = m.join(medians, "asset_class").withColumn("x", M.normalised(F.col("a"), -0.2, 0.4)).withColumn("y", M.normalised(F.col("b"), 0.0, 0.3, F.col("peer")))
    return m.select("instrument_id", F.round(0.6 * F.col("x.score") + 0.4 * F.col("y.score"), 4).alias("composite"), F.col("y.missing").alias("degraded"))


_P = "p AS (SELECT instrument_id, nav_date, r, b, row_number() OVER (PARTITION BY instrument_id ORDER BY nav_date DESC) AS rn FROM ret JOIN bret USING (nav_date))"


def _cap(side):
    return f"CASE WHEN count(*) FILTER (b {side} 0) >= 5 THEN 100 * (exp(avg(ln(1 + r)) FILTER (b {side} 0)) - 1) / (exp(avg(ln(1 + b)) FILTER (b {side} 0)) - 1) END"


@query("reg01_reg02_benchmark", oracle(f"""WITH {_P}, m AS (SELECT instrument_id, covar_samp(r, b) / var_samp(b) AS beta, avg(r) AS mr, avg(b) AS mb, stddev_samp(r - b) * sqrt(252) AS te, {_cap('>')} AS up, {_cap('<')} AS down FROM p WHERE rn <= 252 GROUP BY instrument_id HAVING count(*) >= 252)
    SELECT instrument_id, round(CASE WHEN abs(beta) <= 10 THEN beta END, 6) AS beta, round(CASE WHEN abs(beta) <= 10 THEN (mr - {RF}/252.0 - beta * (mb - {RF}/252.0)) * 252 END, 6) AS alpha, round(te, 6) AS tracking_error, round(CASE WHEN te >= 0.01 THEN (mr - mb) * 252 / te END, 6) AS information_ratio,
        round(CASE WHEN abs(up) <= 500 THEN up END, 4) AS up_capture, round(CASE WHEN abs(down) <= 500 THEN down END, 4) AS down_capture FROM m""", "ret", "bret"))  # fmt: skip
def benchmark(spark, sf_dir):
    df = regress.benchmark_metrics(regress.paired(_ret(spark, sf_dir), _bret(spark, sf_dir)), RF)
    return _r6(df.withColumns({c: F.round(c, 4) for c in ("up_capture", "down_capture")}))


@query("reg03_reg04_correlation", oracle(f"""WITH {_P} SELECT instrument_id, round(corr(r, b) FILTER (rn <= 126), 6) AS corr_126, round(CASE WHEN count(*) FILTER (nav_date > DATE '1997-06-30' AND nav_date <= DATE '1998-06-30') >= 10 THEN (covar_samp(r, b) FILTER (nav_date > DATE '1997-06-30' AND nav_date <= DATE '1998-06-30')) / (var_samp(b) FILTER (nav_date > DATE '1997-06-30' AND nav_date <= DATE '1998-06-30')) END, 6) AS beta_cal
    FROM p GROUP BY instrument_id""", "ret", "bret"))  # fmt: skip
def correlation(spark, sf_dir):
    df = regress.paired(_ret(spark, sf_dir), _bret(spark, sf_dir))
    inside = (F.col("nav_date") > "1997-06-30") & (F.col("nav_date") <= "1998-06-30")
    x, y = F.when(inside, F.col("b")), F.when(inside, F.col("r"))
    near = F.col("rn") <= 126
    return _r6(df.groupBy("instrument_id").agg(F.corr(F.when(near, F.col("r")), F.when(near, F.col("b"))).alias("corr_126"), F.when(F.count(x) >= 10, F.covar_samp(y, x) / F.var_samp(x)).alias("beta_cal")))


_CH = "ch AS (SELECT * FROM (SELECT obs_date AS nav_date, CASE WHEN obs_date - lag(obs_date) OVER (ORDER BY obs_date) <= 7 THEN (value - lag(value) OVER (ORDER BY obs_date)) * 0.01 END AS x FROM macro WHERE series_id = '1-URGENT') WHERE x IS NOT NULL)"


@query("reg05_reg06_factor_beta", oracle(f"""WITH {_CH}, j AS (SELECT instrument_id, r, x, row_number() OVER (PARTITION BY instrument_id ORDER BY nav_date DESC) AS rn FROM ret JOIN ch USING (nav_date))
    SELECT instrument_id, count(*) AS n, round(regr_slope(r, x), 6) AS slope, round(regr_r2(r, x), 6) AS r2, round(CASE WHEN count(*) >= 120 AND regr_r2(r, x) >= 0.01 THEN -regr_slope(r, x) END, 6) AS duration FROM j WHERE rn <= 504 GROUP BY instrument_id""", "ret", "macro"))  # fmt: skip
def factor_beta(spark, sf_dir):
    x = R.gap_guarded_change(view(spark, sf_dir, "macro").where("series_id = '1-URGENT'"), "series_id", "obs_date", "value").where("change IS NOT NULL").select(F.col("obs_date").alias("nav_date"), F.col("change").alias("x"))
    df = regress.paired(_ret(spark, sf_dir), x).where("rn <= 504")
    return _r6(df.groupBy("instrument_id").agg(F.count("*").alias("n"), F.regr_slope("r", "x").alias("slope"), F.regr_r2("r", "x").alias("r2"), regress.factor_beta("r", "x", -1, 120, 0.01).alias("duration")))


@query("reg07_crisis_alpha", oracle(f"""WITH {_P}, c AS (SELECT *, sum(ln(1 + b)) OVER (PARTITION BY instrument_id ORDER BY nav_date) AS p FROM p), d AS (SELECT *, exp(p - max(p) OVER (PARTITION BY instrument_id ORDER BY nav_date)) - 1 AS dd FROM c)
    SELECT instrument_id, round(greatest(-10, least(10, exp(sum(ln(1 + r)) FILTER (dd < -0.02)) - exp(sum(ln(1 + b)) FILTER (dd < -0.02)))), 6) AS crisis_alpha FROM d GROUP BY instrument_id HAVING count(*) >= 60 AND count(*) FILTER (dd < -0.02) >= 20""", "ret", "bret"))  # fmt: skip
def crisis_alpha(spark, sf_dir):
    return _r6(regress.crisis_alpha(regress.paired(_ret(spark, sf_dir), _bret(spark, sf_dir)), -0.02))


# Two factors and a constant in closed form, from centred sums of products.
@query("reg08_fac06_multi_factor", oracle("""WITH ch5 AS (SELECT * FROM (SELECT obs_date AS nav_date, CASE WHEN obs_date - lag(obs_date) OVER (ORDER BY obs_date) <= 7 THEN (value - lag(value) OVER (ORDER BY obs_date)) * 0.01 END AS x FROM macro WHERE series_id = '5-LOW') WHERE x IS NOT NULL),
    j AS (SELECT instrument_id, r AS y, b AS u, x AS v FROM ret JOIN bret USING (nav_date) JOIN ch5 USING (nav_date)), s AS (SELECT instrument_id, count(*) AS n, avg(u) AS mu, avg(v) AS mv, avg(y) AS my, regr_sxx(u, u) AS uu, regr_sxx(v, v) AS vv, regr_sxy(u, v) AS uv, regr_sxy(u, y) AS uy, regr_sxy(v, y) AS vy, regr_sxx(y, y) AS yy FROM j GROUP BY instrument_id HAVING count(*) >= 10),
    b AS (SELECT *, uu * vv - uv * uv AS d, (uy * vv - vy * uv) / (uu * vv - uv * uv) AS bu, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS bv FROM s), e AS (SELECT *, my - bu * mu - bv * mv AS bc, (yy - bu * uy - bv * vy) / greatest(n - 3, 1) AS left_over FROM b),
    f AS (SELECT instrument_id, unnest(['const', 'b', 'x']) AS factor, unnest([bc, bu, bv]) AS beta, unnest([bc / sqrt(left_over * (1.0 / n + (mu * mu * vv - 2 * mu * mv * uv + mv * mv * uu) / d)), bu / sqrt(left_over * vv / d), bv / sqrt(left_over * uu / d)]) AS t FROM e)
    SELECT instrument_id, factor, round(beta, 6) AS beta, round(t, 6) AS t, CASE WHEN abs(t) >= 2.58 THEN '***' WHEN abs(t) >= 1.96 THEN '**' WHEN abs(t) >= 1.65 THEN '*' ELSE '' END AS mark FROM f""", "ret", "bret", "macro"))  # fmt: skip
def multi_factor(spark, sf_dir):
    b = _bret(spark, sf_dir)
    x = R.gap_guarded_change(view(spark, sf_dir, "macro").where("series_id = '5-LOW'"), "series_id", "obs_date", "value").where("change IS NOT NULL").select(F.col("obs_date").alias("nav_date"), F.col("change").alias("x"))
    df = _ret(spark, sf_dir).join(b, "nav_date").join(x, "nav_date")
    return _r6(regress.multi_factor(df, "r", ["b", "x"], "instrument_id"))


@query("wn31_rank_panel", oracle("""WITH m AS (SELECT instrument_id, CAST(date_trunc('month', nav_date) AS DATE) AS month, round(max_by(nav, nav_date) / min_by(nav, nav_date) - 1, 9) AS x FROM nav GROUP BY ALL)
    SELECT instrument_id, month, round((rank() OVER (PARTITION BY month ORDER BY x) + (count(*) OVER (PARTITION BY month, x) - 1) / 2.0) / count(*) OVER (PARTITION BY month) - 0.5, 6) AS rank_share FROM m""", "nav"))  # fmt: skip
def rank_panel(spark, sf_dir):
    m = view(spark, sf_dir, "nav").groupBy("instrument_id", F.trunc("nav_date", "month").alias("month")).agg(F.round(F.max_by("nav", "nav_date") / F.min_by("nav", "nav_date") - 1, 9).alias("x"))
    return _r6(peers.rank_shares(m.select("instrument_id", "month", F.col("x").alias("rank_share")), ["month"], ["rank_share"]))
