"""Queries over holdings, owners, flows and fundamentals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from almanac.functions import metrics as M
from almanac.lens import oracle, view
from almanac.operators import asof, holdings as H
from almanac.plans.series import _r6
from almanac.operators import fundamentals
from almanac.operators.selection import quantiles, weighted_quantile
from almanac.registry import query


def _latest(spark, sf_dir):
    return view(spark, sf_dir, "latest_holdings")


_B = "b AS (SELECT cusip, sum(market_value) / (SELECT sum(market_value) FROM latest_holdings) AS wb FROM latest_holdings GROUP BY cusip)"


@query("hld01_jn13_active_share", oracle(f"""WITH f AS (SELECT series_id, cusip, sum(pct / 100) AS wf FROM latest_holdings GROUP BY ALL), {_B}, ids AS (SELECT DISTINCT series_id FROM f),
    u AS (SELECT ids.series_id, k.cusip, f.wf, b.wb FROM ids CROSS JOIN (SELECT DISTINCT cusip FROM b) k LEFT JOIN f ON f.series_id = ids.series_id AND f.cusip = k.cusip LEFT JOIN b ON b.cusip = k.cusip),
    m AS (SELECT series_id, sum(wf) AS cf, sum(wb) AS cb, 0.5 * sum(abs(coalesce(wf, 0) - coalesce(wb, 0))) AS a, sum(CASE WHEN wf IS NOT NULL THEN least(wf, wb) ELSE 0 END) AS o, count(wf) AS nf, count(wb) AS nb, count(wf) AS nc FROM u GROUP BY series_id)
    SELECT series_id, round(a / least(cf, cb), 6) AS active_share, round(o / least(cf, cb), 6) AS overlap_share, round(o, 6) AS overlap_raw, round(cf, 6) AS fund_coverage, round(cb, 6) AS benchmark_coverage, nf AS n_fund, nb AS n_benchmark, nc AS n_common, round(nc / (nf + nb - nc), 6) AS jaccard FROM m""", "latest_holdings"))  # fmt: skip
def active_share(spark, sf_dir):
    h = _latest(spark, sf_dir)
    total = h.agg(F.sum("market_value").alias("t"))
    bench = h.groupBy("cusip").agg(F.sum("market_value").alias("v")).crossJoin(F.broadcast(total)).select("cusip", (F.col("v") / F.col("t")).alias("w"))
    return _r6(H.overlap(h.withColumn("w", F.col("pct") / 100), bench))


@query("hld02_benchmark_target", oracle("""SELECT instrument_id, coalesce(a.target, b.target, 'GLOBAL') AS target FROM cohort LEFT JOIN (VALUES ('ASIA', 'CHINA', 'CN'), ('ASIA', 'JAPAN', 'JP')) a(asset_class, label, target) USING (asset_class, label)
    LEFT JOIN (VALUES ('ASIA', 'AS'), ('EUROPE', 'EU')) b(asset_class, target) USING (asset_class)""", "cohort"))  # fmt: skip
def benchmark_target(spark, sf_dir):
    exact = spark.createDataFrame([("ASIA", "CHINA", "CN"), ("ASIA", "JAPAN", "JP")], "asset_class string, label string, a string")
    broad = spark.createDataFrame([("ASIA", "AS"), ("EUROPE", "EU")], "asset_class string, b string")
    c = view(spark, sf_dir, "cohort").join(F.broadcast(exact), ["asset_class", "label"], "left").join(F.broadcast(broad), "asset_class", "left")
    return c.select("instrument_id", F.coalesce("a", "b", F.lit("GLOBAL")).alias("target"))


def _leaves(spark, sf_dir):
    h = _latest(spark, sf_dir).select("series_id", "report_date", "cusip", "asset_class", "sector", "pct")
    edges = view(spark, sf_dir, "supplier").where("s_suppkey % 3 > 0").select(F.col("s_suppkey").cast("string").alias("cusip"), F.col("s_suppkey").cast("string").alias("child"))
    return H.look_through(h, edges)


_LOOK = """edge AS (SELECT CAST(s_suppkey AS VARCHAR) AS cusip, CAST(s_suppkey AS VARCHAR) AS child FROM supplier WHERE s_suppkey % 3 > 0),
    tag AS (SELECT h.*, e.child, k.s IS NOT NULL AS has FROM latest_holdings h LEFT JOIN edge e USING (cusip) LEFT JOIN (SELECT DISTINCT series_id AS s FROM latest_holdings) k ON k.s = e.child),
    l0 AS (SELECT series_id AS root, series_id AS walked, [series_id] AS anc, pct AS pct, pct AS raw, 1.0::DOUBLE AS weight, cusip, asset_class, sector, report_date, child, has AND child <> series_id AS ex FROM tag),
    l1 AS (SELECT l0.root, l0.child AS walked, l0.anc, t.pct * l0.raw / 100 AS pct, l0.raw / 100 AS weight, t.pct AS raw, t.cusip, t.asset_class, t.sector, t.report_date, t.child, t.has AND NOT list_contains(l0.anc, t.child) AS ex FROM l0 JOIN tag t ON t.series_id = l0.child WHERE l0.ex),
    l2 AS (SELECT l1.root, t.pct * l1.weight * l1.raw / 100 AS pct, t.cusip, t.asset_class, t.sector, t.report_date, t.child FROM l1 JOIN tag t ON t.series_id = l1.child WHERE l1.ex),
    leaf AS (SELECT root, 0 AS level, pct, asset_class, sector, report_date, child FROM l0 WHERE ex IS NOT TRUE UNION ALL SELECT root, 1, pct, asset_class, sector, report_date, child FROM l1 WHERE ex IS NOT TRUE UNION ALL SELECT root, 2, pct, asset_class, sector, report_date, child FROM l2)"""


@query("hld03_look_through", oracle(f"""WITH {_LOOK}, d AS (SELECT root, level, pct, 'asset_class' AS dimension, coalesce(asset_class, 'UNKNOWN') AS key FROM leaf UNION ALL SELECT root, level, pct, 'sector', coalesce(sector, 'UNKNOWN') FROM leaf)
    SELECT root, dimension, key, round(sum(CASE WHEN level = 0 THEN pct ELSE 0 END), 6) AS direct, round(sum(CASE WHEN level > 0 THEN pct ELSE 0 END), 6) AS indirect FROM d GROUP BY ALL""", "latest_holdings"))  # fmt: skip
def look_through(spark, sf_dir):
    return _r6(H.exposures(_leaves(spark, sf_dir), ["asset_class", "sector"]))


@query("hld04_look_through_residuals", oracle(f"""WITH {_LOOK} SELECT root, round(sum(CASE WHEN child IS NOT NULL THEN abs(pct) ELSE 0 END), 6) AS nondecomposable, round(sum(CASE WHEN asset_class IN ('SMALL', 'PROMO') THEN abs(pct) ELSE 0 END), 6) AS derivatives_gross,
    round(sum(CASE WHEN asset_class IN ('SMALL', 'PROMO') THEN pct ELSE 0 END), 6) AS derivatives_net, round(sum(pct), 6) AS total, min(report_date) AS oldest, count(*) AS n FROM leaf GROUP BY root""", "latest_holdings"))  # fmt: skip
def residuals(spark, sf_dir):
    return _r6(H.residuals(_leaves(spark, sf_dir), ["SMALL", "PROMO"]))


@query("hld06_monthly_flows", oracle("""WITH q AS (SELECT series_id, last_day(CAST(date_trunc('quarter', month_end) + INTERVAL 2 MONTH AS DATE)) AS report_date, month_end, sales, redemption, net_assets, month(month_end) - month(date_trunc('quarter', month_end)) + 1 AS o FROM flows),
    w AS (SELECT series_id, report_date, max(net_assets) AS net_assets, max(sales) FILTER (o = 1) AS s1, max(sales) FILTER (o = 2) AS s2, max(sales) FILTER (o = 3) AS s3, max(redemption) FILTER (o = 1) AS r1, max(redemption) FILTER (o = 2) AS r2, max(redemption) FILTER (o = 3) AS r3 FROM q GROUP BY ALL),
    u AS (SELECT series_id, report_date, net_assets, unnest([1, 2, 3]) AS ordinal, unnest([s1, s2, s3]) AS sales, unnest([r1, r2, r3]) AS redemption FROM w)
    SELECT series_id, last_day(CAST(report_date + to_months(ordinal - 3) AS DATE)) AS month_end, ordinal, sales, redemption, round(coalesce(sales, 0) - coalesce(redemption, 0), 6) AS net, round((coalesce(sales, 0) - coalesce(redemption, 0)) / net_assets, 6) AS share FROM u""", "flows"))  # fmt: skip
def monthly_flows(spark, sf_dir):
    q = view(spark, sf_dir, "flows").withColumn("report_date", F.last_day(F.add_months(F.trunc("month_end", "quarter"), 2))).withColumn("o", F.month("month_end") - F.month(F.trunc("month_end", "quarter")) + 1)
    cells = [F.max(F.when(F.col("o") == k, F.col(c))).alias(f"{c}_{k}") for c in ("sales", "redemption") for k in (1, 2, 3)]
    return _r6(H.monthly_flows(q.groupBy("series_id", "report_date").agg(F.max("net_assets").alias("net_assets"), *cells)))


@query("hld07_srt01_top_holdings", oracle("SELECT series_id, cusip, round(w / 100, 6) AS weight, rank FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY w DESC NULLS LAST, cusip)::INTEGER AS rank FROM (SELECT series_id, cusip, round(sum(pct), 9) AS w FROM latest_holdings GROUP BY ALL)) WHERE rank <= 10", "latest_holdings"))
def top_holdings(spark, sf_dir):
    h = _latest(spark, sf_dir).groupBy("series_id", "cusip").agg(F.round(F.sum("pct"), 9).alias("w"))
    return _r6(H.top_rows(h, ["series_id"], [F.desc_nulls_last("w"), "cusip"], 10).select("series_id", "cusip", (F.col("w") / 100).alias("weight"), "rank"))


@query("hld08_common_period", oracle("""WITH p AS (SELECT max(period) AS period FROM inst WHERE period <= DATE '1998-04-01'), i AS (SELECT * FROM inst JOIN p USING (period)), h AS (SELECT cusip, sum(market_value) AS fund_value FROM latest_holdings GROUP BY cusip)
    SELECT cik, cusip, value_usd, round(fund_value, 2) AS fund_value FROM i JOIN h USING (cusip) ORDER BY value_usd DESC, cik, cusip LIMIT 500""", "inst", "latest_holdings"))  # fmt: skip
def common_period(spark, sf_dir):
    inst = view(spark, sf_dir, "inst").where("period <= DATE '1998-04-01'")
    i = inst.join(F.broadcast(inst.agg(F.max("period").alias("period"))), "period")
    h = _latest(spark, sf_dir).groupBy("cusip").agg(F.round(F.sum("market_value"), 2).alias("fund_value"))
    return i.join(h, "cusip").select("cik", "cusip", "value_usd", "fund_value").orderBy(F.desc("value_usd"), "cik", "cusip").limit(500)


@query("hld09_worklist", oracle("""SELECT h.cusip, round(sum(pct), 4) AS weight FROM latest_holdings h LEFT JOIN part p ON h.cusip = CAST(p.p_partkey AS VARCHAR) AND p_size > 5 WHERE p_partkey IS NULL OR p_retailprice < 1000 GROUP BY h.cusip ORDER BY round(sum(pct), 9) DESC, h.cusip LIMIT 200""", "latest_holdings"))
def worklist(spark, sf_dir):
    p = view(spark, sf_dir, "part").where("p_size > 5").select(F.col("p_partkey").cast("string").alias("cusip"), "p_retailprice")
    h = _latest(spark, sf_dir).join(p, "cusip", "left").where("p_retailprice IS NULL OR p_retailprice < 1000")
    return h.groupBy("cusip").agg(F.round(F.sum("pct"), 9).alias("w")).orderBy(F.desc("w"), "cusip").limit(200).select("cusip", F.round("w", 4).alias("weight"))


@query("agg02_ordered_first", oracle("SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS newest, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest FROM orders GROUP BY o_custkey"))
def ordered_first(spark, sf_dir):
    return view(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("newest"), F.min_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("cheapest"))


@query("agg03_weighted_ratios", oracle("""WITH c AS (SELECT CAST(p_partkey AS VARCHAR) AS cusip, p_retailprice AS num, CASE WHEN p_size > 10 THEN p_size END AS den FROM part)
    SELECT series_id, report_date, count(*) AS n, round(coalesce(sum(num * qty / 100) FILTER (den IS NOT NULL), 0), 4) AS numerator, round(coalesce(sum(num * qty / 100) FILTER (den IS NOT NULL), 0) / nullif(sum(den * qty / 100), 0), 6) AS ratio
    FROM latest_holdings LEFT JOIN c USING (cusip) GROUP BY ALL""", "latest_holdings"))  # fmt: skip
def weighted_ratios(spark, sf_dir):
    c = view(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("cusip"), F.col("p_retailprice").alias("num"), F.when(F.col("p_size") > 10, F.col("p_size")).alias("den"))
    num = F.coalesce(F.sum(F.when(F.col("den").isNotNull(), F.col("num") * F.col("qty") / 100)), F.lit(0.0))
    return _latest(spark, sf_dir).join(c, "cusip", "left").groupBy("series_id", "report_date").agg(F.count("*").alias("n"), F.round(num, 4).alias("numerator"), F.round(num / F.nullif(F.sum(F.col("den") * F.col("qty") / 100), F.lit(0.0)), 6).alias("ratio"))


@query("agg04_counted_entities", oracle("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) >= 12"))
def counted_entities(spark, sf_dir):
    return view(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).where("n >= 12")


@query("agg07_insider_quarters", oracle("""SELECT issuer, last_day(CAST(date_trunc('quarter', transaction_date) + INTERVAL 2 MONTH AS DATE)) AS quarter_end, round(coalesce(sum(value_usd) FILTER (code = 'P'), 0), 2) AS bought, round(coalesce(sum(value_usd) FILTER (code = 'S'), 0), 2) AS sold, count(*) FILTER (code = 'P') AS buys, count(*) FILTER (code = 'S') AS sells FROM insider GROUP BY ALL""", "insider"))
def insider_quarters(spark, sf_dir):
    side = lambda c: F.round(F.coalesce(F.sum(F.when(F.col("code") == c, F.col("value_usd"))), F.lit(0.0)), 2)
    df = view(spark, sf_dir, "insider").groupBy("issuer", F.last_day(F.add_months(F.trunc("transaction_date", "quarter"), 2)).alias("quarter_end"))
    return df.agg(side("P").alias("bought"), side("S").alias("sold"), F.count_if(F.col("code") == "P").alias("buys"), F.count_if(F.col("code") == "S").alias("sells"))


@query("agg11_period_changes", oracle("""WITH k AS (SELECT *, dense_rank() OVER (PARTITION BY cik ORDER BY period DESC) AS k FROM inst), d AS (SELECT cik, cusip, coalesce(sum(shares) FILTER (k = 1), 0) AS now, coalesce(sum(shares) FILTER (k = 2), 0) AS before FROM k WHERE k <= 2 GROUP BY ALL) SELECT *, now - before AS change FROM d""", "inst"))
def period_changes(spark, sf_dir):
    return H.period_changes(view(spark, sf_dir, "inst"), ["cik", "cusip"], "period", "shares")


@query("agg12_top_holders", oracle("""SELECT cusip, round(sum(value_usd), 2) AS value, count(DISTINCT cik) AS holders, array_to_string((list(cik ORDER BY value_usd DESC, cik))[1:5], ',') AS first FROM (SELECT cusip, cik, round(sum(value_usd), 2) AS value_usd FROM inst WHERE period >= DATE '1998-01-01' GROUP BY ALL) GROUP BY cusip""", "inst"))
def top_holders(spark, sf_dir):
    each = view(spark, sf_dir, "inst").where("period >= DATE '1998-01-01'").groupBy("cusip", "cik").agg(F.round(F.sum("value_usd"), 2).alias("v"))
    each = each.withColumn("k", F.row_number().over(Window.partitionBy("cusip").orderBy(F.desc("v"), "cik")))
    first = F.transform(F.array_sort(F.collect_list(F.when(F.col("k") <= 5, F.struct("k", "cik")))), lambda x: x["cik"])
    return each.groupBy("cusip").agg(F.round(F.sum("v"), 2).alias("value"), F.count("*").alias("holders"), F.array_join(first, ",").alias("first"))


@query("agg13_holder_network", oracle("""WITH i AS (SELECT cusip FROM inst GROUP BY cusip ORDER BY round(sum(value_usd), 2) DESC, cusip LIMIT 12), h AS (SELECT cik FROM inst GROUP BY cik ORDER BY round(sum(value_usd), 2) DESC, cik LIMIT 8)
    SELECT cik, cusip, round(sum(value_usd), 2) AS value FROM inst WHERE cusip IN (FROM i) AND cik IN (FROM h) GROUP BY ALL""", "inst"))  # fmt: skip
def holder_network(spark, sf_dir):
    return H.holder_network(view(spark, sf_dir, "inst")).withColumn("value", F.round("value", 2))


@query("agg14_holdings_summary", oracle("SELECT series_id, report_date, count(*) AS n, round(max(pct), 6) AS largest, round(sum(pct) FILTER (qty > 10), 6) AS covered FROM latest_holdings GROUP BY ALL", "latest_holdings"))
def holdings_summary(spark, sf_dir):
    return _r6(_latest(spark, sf_dir).groupBy("series_id", "report_date").agg(F.count("*").alias("n"), F.max("pct").alias("largest"), F.sum(F.when(F.col("qty") > 10, F.col("pct"))).alias("covered")))


@query("agg15_trailing_flow", oracle("SELECT series_id, round(sum(sales - redemption) / avg(net_assets), 6) AS flow FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month_end DESC) AS k FROM flows) WHERE k <= 3 GROUP BY series_id", "flows"))
def trailing_flow(spark, sf_dir):
    k = F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("month_end")))
    return _r6(view(spark, sf_dir, "flows").withColumn("k", k).where("k <= 3").groupBy("series_id").agg((F.sum(F.col("sales") - F.col("redemption")) / F.avg("net_assets")).alias("flow")))


_W = "w AS (SELECT o_orderstatus AS family, o_orderpriority AS axis, o_totalprice AS v, o_custkey % 5 + 1 AS w FROM orders)"


@query("agg16_agg17_agg19_weighted_levels", oracle(f"WITH {_W}, f AS (SELECT axis, family, sum(w * v) / sum(w) AS s, CASE family WHEN 'F' THEN 0.5 WHEN 'O' THEN 0.3 ELSE 0.2 END AS k FROM w GROUP BY ALL) SELECT axis, round(sum(k * s) / sum(k), 4) AS score, count(*) AS families FROM f GROUP BY axis"))
def weighted_levels(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("family"), F.col("o_orderpriority").alias("axis"), F.col("o_totalprice").alias("v"), (F.col("o_custkey") % 5 + 1).alias("w"))
    f = o.groupBy("axis", "family").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("s")).withColumn("k", F.when(F.col("family") == "F", 0.5).when(F.col("family") == "O", 0.3).otherwise(0.2))
    return f.groupBy("axis").agg(F.round(F.sum(F.col("k") * F.col("s")) / F.sum("k"), 4).alias("score"), F.count("*").alias("families"))


@query("agg18_horizon_blend", oracle("""WITH h AS (SELECT o_custkey, max_by(o_totalprice, o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS a, max_by(o_totalprice, o_orderkey) FILTER (o_orderpriority = '2-HIGH') AS b, max_by(o_totalprice, o_orderkey) FILTER (o_orderpriority = '3-MEDIUM') AS c, max_by(o_totalprice, o_orderkey) AS now FROM orders GROUP BY ALL)
    SELECT o_custkey, round(coalesce(0.4 * a, 0) + coalesce(0.2 * b, 0) + coalesce(0.1 * c, 0) + (1 - CASE WHEN a IS NULL THEN 0 ELSE 0.4 END - CASE WHEN b IS NULL THEN 0 ELSE 0.2 END - CASE WHEN c IS NULL THEN 0 ELSE 0.1 END) * now, 4) AS blend FROM h"""))  # fmt: skip
def horizon_blend(spark, sf_dir):
    newest = lambda p: F.max_by(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice")), F.when(F.col("o_orderpriority") == p, F.col("o_orderkey")))
    parts = {"1-URGENT": 0.4, "2-HIGH": 0.2, "3-MEDIUM": 0.1}
    h = view(spark, sf_dir, "orders").groupBy("o_custkey").agg(*(newest(p).alias(f"h{k}") for k, p in enumerate(parts)), F.max_by("o_totalprice", "o_orderkey").alias("now"))
    zero, used = F.lit(0.0), list(enumerate(parts.values()))
    rest = 1 - sum((F.when(F.col(f"h{k}").isNull(), zero).otherwise(w) for k, w in used), zero)
    return h.select("o_custkey", F.round(sum((F.coalesce(w * F.col(f"h{k}"), zero) for k, w in used), zero) + rest * F.col("now"), 4).alias("blend"))


@query("agg20_robust_mean", oracle(f"""WITH {_W}, m AS (SELECT axis, median(v) AS m FROM w GROUP BY axis), d AS (SELECT axis, any_value(m) AS m, median(abs(v - m)) * 1.4826 AS s FROM w JOIN m USING (axis) GROUP BY axis)
    SELECT axis, round(any_value(m), 4) AS median, round(sum(w * v) / sum(w), 4) AS mean, round(sum(w * greatest(m - 1.5 * s, least(m + 1.5 * s, v))) / sum(w), 4) AS huber FROM w JOIN d USING (axis) GROUP BY axis"""))  # fmt: skip
def robust_mean(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("axis"), F.col("o_totalprice").alias("v"), (F.col("o_custkey") % 5 + 1).alias("w"))
    m = quantiles(o, ["axis"], "v", {"m": 0.5}).drop("n")
    gaps = quantiles(o.join(m, "axis").select("axis", F.abs(F.col("v") - F.col("m")).alias("gap")), ["axis"], "gap", {"s": 0.5})
    d = m.join(gaps.select("axis", (F.col("s") * 1.4826).alias("s")), "axis")
    held = F.greatest(F.col("m") - 1.5 * F.col("s"), F.least(F.col("m") + 1.5 * F.col("s"), F.col("v")))
    return o.join(d, "axis").groupBy("axis").agg(F.round(F.first("m"), 4).alias("median"), F.round(F.sum(F.col("w") * F.col("v")) / F.sum("w"), 4).alias("mean"), F.round(F.sum(F.col("w") * held) / F.sum("w"), 4).alias("huber"))


@query("agg21_weighted_median", oracle(f"WITH {_W}, r AS (SELECT axis, v, sum(w) OVER (PARTITION BY axis ORDER BY v) AS c, sum(w) OVER (PARTITION BY axis) AS t FROM w) SELECT axis, min(v) AS median FROM r WHERE c >= t / 2.0 GROUP BY axis"))
def weighted_median(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("axis"), "o_totalprice", (F.col("o_custkey") % 5 + 1).alias("w"))
    return weighted_quantile(o, ["axis"], "o_totalprice", "w", "median")


@query("agg22_agreement", oracle("""WITH s AS (SELECT o_orderpriority AS axis, o_custkey % 5 + 1 AS w, CASE WHEN o_totalprice > 200000 THEN o_totalprice / 200000 - 1 END AS z FROM orders)
    SELECT axis, round(sum(CASE WHEN z IS NOT NULL THEN w ELSE 0 END) / sum(w), 6) AS coverage, round(sum(CASE WHEN z > 0.5 THEN w ELSE 0 END) / sum(CASE WHEN z IS NOT NULL THEN w END), 6) AS agreement, round(1 / (1 + stddev_pop(z)), 6) AS dispersion FROM s GROUP BY axis"""))  # fmt: skip
def agreement(spark, sf_dir):
    z = F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice") / 200000 - 1)
    s = view(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("axis"), (F.col("o_custkey") % 5 + 1).alias("w"), z.alias("z"))
    part = lambda ok: F.sum(F.when(ok, F.col("w")).otherwise(0))
    known = F.col("z").isNotNull()
    return _r6(s.groupBy("axis").agg((part(known) / F.sum("w")).alias("coverage"), (part(F.col("z") > 0.5) / F.sum(F.when(known, F.col("w")))).alias("agreement"), (1 / (1 + F.stddev_pop("z"))).alias("dispersion")))


@query("agg23_distribution", oracle("SELECT event_type, round(min(value), 6) AS low, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, round(max(value), 6) AS high FROM events GROUP BY event_type"))
def distribution(spark, sf_dir):
    return _r6(quantiles(view(spark, sf_dir, "events"), ["event_type"], "value", {"low": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "high": 1.0}).drop("n"))


@query("agg24_agg25_confusion", oracle("""WITH a AS (SELECT obs_date, value > 3 AS x FROM macro WHERE series_id = '1-URGENT'), b AS (SELECT obs_date, value > 3 AS y FROM macro WHERE series_id = '2-HIGH')
    SELECT x, y, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM a JOIN b USING (obs_date) GROUP BY x, y""", "macro"))  # fmt: skip
def confusion(spark, sf_dir):
    m = view(spark, sf_dir, "macro")
    one = lambda s, c: m.where(F.col("series_id") == s).select("obs_date", (F.col("value") > 3).alias(c))
    n = one("1-URGENT", "x").join(one("2-HIGH", "y"), "obs_date").groupBy("x", "y").agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("t")))).select("x", "y", "n", F.round(F.col("n") / F.col("t"), 6).alias("share"))


_CONCEPTS = {"income": ("1-URGENT", 0.0), "equity": ("2-HIGH", 100000.0), "assets": ("3-MEDIUM", 0.0), "revenue": ("4-NOT SPECIFIED", 0.0), "gross": ("5-LOW", 120000.0)}
_ROW = ", ".join(f"max(val - {shift}) FILTER (concept = '{concept}') AS {name}" for name, (concept, shift) in _CONCEPTS.items())


@query("hld10_fundamental_ratios", oracle(f"""WITH c AS (SELECT cik, period_end, {_ROW} FROM facts GROUP BY cik, period_end), sh AS (SELECT cik, period_end AS s_end, max(val) - 60000 AS shares FROM facts WHERE fp = 'P' GROUP BY cik, period_end),
    y AS (SELECT cik, CAST(period_end + INTERVAL 12 MONTH AS DATE) AS due, assets AS year_before FROM c), k AS (SELECT c.*, shares, year_before FROM c ASOF LEFT JOIN sh ON c.cik = sh.cik AND c.period_end >= sh.s_end ASOF LEFT JOIN y ON c.cik = y.cik AND c.period_end >= y.due),
    p AS (SELECT CAST(ticker AS BIGINT) AS cik, date, close FROM prices), r AS (SELECT p.cik, date, period_end, income, equity, assets, revenue, gross, year_before, CASE WHEN shares > 0 THEN shares * close END AS cap FROM p ASOF LEFT JOIN k ON p.cik = k.cik AND p.date >= k.period_end),
    x AS (SELECT *, CASE WHEN assets > 0 THEN income / assets END AS roa, CASE WHEN year_before > 0 THEN assets / year_before - 1 END AS growth, CASE WHEN revenue > 0 THEN gross / revenue END AS margin FROM r)
    SELECT cik, date, round(cap, 0) AS cap, round(CASE WHEN income > 0 THEN cap / income END, 6) AS pe, round(CASE WHEN equity > 0 THEN income / equity END, 6) AS roe, round(CASE WHEN equity > 0 THEN (assets - equity) / equity END, 6) AS de, round(margin, 6) AS margin,
        round(CASE WHEN abs(roa) <= 100 THEN roa END, 6) AS roa, round(CASE WHEN abs(growth) <= 100 THEN growth END, 6) AS investment_growth, round(CASE WHEN abs(margin) <= 100 THEN margin END, 6) AS gross_profitability, period_end FROM x""", "facts", "prices"))  # fmt: skip
def fundamental_ratios(spark, sf_dir):
    value = lambda concept, shift: F.max(F.when(F.col("concept") == concept, F.col("val") - shift))
    facts = view(spark, sf_dir, "facts")
    rows = facts.groupBy("cik", "period_end").agg(*(value(*of).alias(name) for name, of in _CONCEPTS.items()))
    shares = facts.where("fp = 'P'").groupBy("cik", "period_end").agg((F.max("val") - 60000).alias("shares"))
    prices = view(spark, sf_dir, "prices").select(F.col("ticker").cast("bigint").alias("cik"), "date", "close")
    df = fundamentals.ratios(prices, fundamentals.company_rows(rows, shares), "cik", "date", "close")
    return df.select("cik", "date", F.round("cap", 0).alias("cap"), *(F.round(c, 6).alias(c) for c in ("pe", "roe", "de", "margin", "roa", "investment_growth", "gross_profitability")), "period_end")


@query("hld11_universe_features", oracle("""WITH s AS (SELECT o_custkey, arg_max(o_orderpriority, (CAST(o_orderdate AS DATE), o_orderpriority)) AS label FROM orders WHERE o_orderkey % 3 = 0 GROUP BY o_custkey), u AS (SELECT c_custkey, c_name AS ticker, c_nationkey, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS own, c_acctbal > -500 AS is_active FROM customer),
    f AS (SELECT CAST(c_custkey AS VARCHAR) AS instrument_id, ticker, n_name AS asset_class, is_active, coalesce(nullif(label, ''), own, 'unclassified') AS strategy_label, CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey AS VARCHAR) END AS cik_unpadded, CASE WHEN c_custkey % 4 > 0 THEN 'S' || c_custkey END AS sec_series_id FROM u LEFT JOIN s ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey)
    SELECT f.*, benchmark_ticker FROM f LEFT JOIN (VALUES ('1-URGENT', 'SPY'), ('2-HIGH', 'IEF'), ('BUILDING', 'XHB'), ('unclassified', 'ACWI')) b(strategy_label, benchmark_ticker) USING (strategy_label)"""))  # fmt: skip
def universe_features(spark, sf_dir):
    """Identity, strategy and benchmark per instrument: the newest label, else its own, else unclassified."""
    c, o = view(spark, sf_dir, "customer"), view(spark, sf_dir, "orders").where("o_orderkey % 3 = 0")
    text = F.col("c_custkey").cast("string")
    universe = c.join(F.broadcast(view(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey"), "left").select(text.alias("instrument_id"), F.col("c_name").alias("ticker"), F.col("n_name").alias("asset_class"), (F.col("c_acctbal") > -500).alias("is_active"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("strategy"))
    stage = o.select(F.col("o_custkey").cast("string").alias("instrument_id"), F.to_date("o_orderdate").alias("effective_date"), F.col("o_orderpriority").alias("strategy_label"))
    identity = c.where("c_custkey % 4 > 0").select(text.alias("instrument_id"), F.lpad(text, 10, "0").alias("cik"), F.concat(F.lit("S"), text).alias("sec_series_id"))
    proxies = spark.createDataFrame([("1-URGENT", "SPY"), ("2-HIGH", "IEF"), ("BUILDING", "XHB"), ("unclassified", "ACWI")], "strategy_label string, benchmark_ticker string")
    return H.universe_features(universe, stage, identity, F.broadcast(proxies))


@query("srt02_srt03_fetch_plan", oracle("""WITH w AS (SELECT ticker, max(date) AS newest, min(date) AS oldest, round(sum(volume), 4) AS size FROM prices GROUP BY ticker) SELECT ticker, newest, oldest, size FROM w ORDER BY newest, size DESC NULLS LAST, ticker LIMIT 100""", "prices"))
def fetch_plan(spark, sf_dir):
    w = view(spark, sf_dir, "prices").groupBy("ticker").agg(F.max("date").alias("newest"), F.min("date").alias("oldest"), F.round(F.sum("volume"), 4).alias("size"))
    return w.orderBy("newest", F.desc_nulls_last("size"), "ticker").limit(100)


@query("set01_union_distinct", oracle("SELECT l_partkey AS k FROM lineitem UNION SELECT p_partkey FROM part UNION SELECT s_suppkey FROM supplier"))
def union_distinct(spark, sf_dir):
    one = lambda t, c: view(spark, sf_dir, t).select(F.col(c).cast("bigint").alias("k"))
    return one("lineitem", "l_partkey").union(one("part", "p_partkey")).union(one("supplier", "s_suppkey")).distinct()
