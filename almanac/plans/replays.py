"""Queries over replays: revision diagnostics, threshold grids, gates, candidate sets, counts and folds."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from almanac.lens import oracle, view
from almanac.operators import pit
from almanac.operators import replays as R
from almanac.operators.positions import turnover
from almanac.plans.joins import _CAL, _bret, _calendar
from almanac.plans.regimes import _SC, _scores
from almanac.plans.series import _r6, _ret
from almanac.registry import query

# The revised replay is that of scores smoothed over three days; both have the same states' thresholds.
_BOTH = f"""{_SC}, two AS (SELECT axis, d, score AS latest, avg(score) OVER (PARTITION BY axis ORDER BY d ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS revised FROM sc),
    rounded AS (SELECT axis, d, round(latest, 9) AS latest, round(revised, 9) AS revised FROM two),
    stated AS (SELECT *, CASE WHEN latest > 0.5 THEN 'up' WHEN latest < -0.5 THEN 'down' END AS ls, CASE WHEN revised > 0.5 THEN 'up' WHEN revised < -0.5 THEN 'down' END AS rs FROM rounded)"""


def _both(spark, sf_dir):
    w = Window.partitionBy("axis").orderBy("d").rowsBetween(-2, 0)
    df = _scores(spark, sf_dir).select("axis", "d", F.round("score", 9).alias("latest"), F.round(F.avg("score").over(w), 9).alias("revised"))
    state = lambda c: F.when(F.col(c) > 0.5, "up").when(F.col(c) < -0.5, "down")
    return df.withColumn("latest_state", state("latest")).withColumn("revised_state", state("revised"))


@query("rp05_revision_by_axis", oracle(f"""WITH {_BOTH} SELECT axis, round(quantile_cont(abs(latest - revised), 0.5), 6) AS gap_median, round(quantile_cont(abs(latest - revised), 0.9), 6) AS gap_p90, count(*) FILTER (sign(latest) <> sign(revised)) AS sign_days,
    count(*) FILTER (ls IS DISTINCT FROM rs) AS state_days FROM stated GROUP BY axis""", "macro"))  # fmt: skip
def revision_by_axis(spark, sf_dir):
    return _r6(R.revision_by_axis(_both(spark, sf_dir), "axis"))


@query("rp05_revision_episodes", oracle(f"""WITH {_BOTH}, day AS (SELECT d, bool_or(sign(latest) <> sign(revised)) AS sg, bool_or(ls IS DISTINCT FROM rs) AS st FROM stated GROUP BY d), g AS (SELECT *, row_number() OVER (ORDER BY d) - row_number() OVER (PARTITION BY st ORDER BY d) AS g FROM day),
    e AS (SELECT count(*) AS n FROM g WHERE st GROUP BY g), q AS (SELECT count(*) AS episodes, quantile_cont(n, 0.5) AS episode_median, round(quantile_cont(n, 0.9), 6) AS episode_p90 FROM e)
    SELECT count(*) AS days, count(*) FILTER (sg AND NOT st) AS absorbed_days, count(*) FILTER (st) AS candidate_days, round(count(*) FILTER (st) / count(*), 6) AS candidate_rate, any_value(episodes) AS episodes, any_value(episode_median)::DOUBLE AS episode_median, any_value(episode_p90) AS episode_p90 FROM day, q""", "macro"))  # fmt: skip
def revision_episodes(spark, sf_dir):
    return _r6(R.revision_episodes(_both(spark, sf_dir), "d", "axis"))


_PAIR = f"{_SC}, pair AS (SELECT a.d, round(a.score, 9) AS x, round(b.score, 9) AS y FROM sc a JOIN sc b ON a.d = b.d AND a.axis = '1-URGENT' AND b.axis = '2-HIGH')"
_MARKET = "grid AS (SELECT a || ':' || b AS config, a / 4.0 AS xe, a / 8.0 AS xx, b / 4.0 AS ye, b / 8.0 AS yx FROM range(2, 6) t(a), range(2, 6) u(b))"


@query("rp09_market_grid", oracle(f"""WITH {_PAIR}, {_MARKET}, l AS (SELECT config, d, x, y, xx, yx, last_value(CASE WHEN abs(x) >= xe THEN sign(x)::INTEGER END IGNORE NULLS) OVER w AS f, last_value(CASE WHEN abs(y) >= ye THEN sign(y)::INTEGER END IGNORE NULLS) OVER w AS s FROM pair, grid WINDOW w AS (PARTITION BY config ORDER BY d)),
    r AS (SELECT config, d, f || '/' || s AS candidate, coalesce(f * x >= xx AND s * y >= yx, false) AS valid FROM l), k AS (SELECT *, coalesce(candidate <> lag(candidate) OVER (PARTITION BY config ORDER BY d), false) AS flip FROM r),
    v AS (SELECT config, candidate, row_number() OVER (PARTITION BY config ORDER BY d) - row_number() OVER (PARTITION BY config, candidate ORDER BY d) AS g FROM r WHERE valid), h AS (SELECT config, count(*) AS n FROM v GROUP BY config, candidate, g), p AS (SELECT config, count(*) - 1 AS changes, avg(n) AS published_run FROM h GROUP BY config)
    SELECT config, count(*) AS days, count(*) FILTER (valid) AS valid_days, count(*) FILTER (NOT valid) AS abstain_days, round(count(*) FILTER (flip) / greatest(1, count(*) / 252.0), 6) AS candidate_flips_per_year,
        round(coalesce(any_value(changes), 0) / greatest(1, count(*) / 252.0), 6) AS published_flips_per_year, round(any_value(published_run), 6) AS published_run, count(DISTINCT year(d)) = count(DISTINCT year(d)) FILTER (valid) AS all_years FROM k LEFT JOIN p USING (config) GROUP BY config""", "macro"))  # fmt: skip
def market_grid(spark, sf_dir):
    sc = _scores(spark, sf_dir)
    one = lambda axis, name: sc.where(F.col("axis") == axis).select("d", F.round("score", 9).alias(name))
    a, b = spark.range(2, 6).withColumnRenamed("id", "a"), spark.range(2, 6).withColumnRenamed("id", "b")
    quarter = lambda c, n: (F.col(c) / n).cast("double")
    grid = a.crossJoin(b).select(F.concat_ws(":", "a", "b").alias("config"), quarter("a", 4).alias("first_enter"), quarter("a", 8).alias("first_exit"), quarter("b", 4).alias("second_enter"), quarter("b", 8).alias("second_exit"))
    pair = one("1-URGENT", "x").join(one("2-HIGH", "y"), "d")
    return _r6(R.grid_metrics(R.grid_replay(pair, grid, "d", "x", "y"), "d"))


_LISTED = "(SELECT config, string_agg({0} || ':' || n, ',' ORDER BY {0} || ':' || n) AS {0}_counts FROM (SELECT config, {0}, count(*) AS n FROM {1} WHERE {0} IS NOT NULL GROUP BY ALL) GROUP BY config)"
_RUNS = "(SELECT config, median(n) AS {0}_run_median, max(n) AS {0}_run_max FROM (SELECT config, {0}, count(*) AS n FROM (SELECT config, {0}, row_number() OVER (PARTITION BY config ORDER BY d) - row_number() OVER (PARTITION BY config, {0} ORDER BY d) AS g FROM {1}) GROUP BY config, {0}, g) WHERE {0} IS NOT NULL GROUP BY config)"
_SPREAD = ", ".join(f"round(quantile_cont({c}, {q}), 6) AS {c}_{p}" for c in ("confidence", "first_score", "second_score") for p, q in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)))


@query("rp09_market_quality", oracle(f"""WITH {_SC}, x AS (SELECT d, round(score, 9) AS x FROM sc WHERE axis = '1-URGENT' AND day(d) <> 13), y AS (SELECT d, round(score, 9) AS y FROM sc WHERE axis = '2-HIGH' AND day(d) <> 14),
    span AS (SELECT unnest(generate_series(CAST(min(d) AS TIMESTAMP), CAST(max(d) AS TIMESTAMP), INTERVAL 1 DAY))::DATE AS d FROM (SELECT d FROM x UNION ALL SELECT d FROM y)),
    grid AS (SELECT a || ':' || b || ':' || c AS config, 1 + a / 2.0 AS scale, b / 4.0 AS enter, c * 0.4 AS least FROM range(0, 2) t(a), range(2, 5) u(b), range(0, 2) v(c)),
    s AS (SELECT config, d, isodow(d) > 5 AS closed, enter, least, CASE WHEN isodow(d) <= 5 THEN x * scale END AS first_score, CASE WHEN isodow(d) <= 5 THEN y * scale END AS second_score FROM span LEFT JOIN x USING (d) LEFT JOIN y USING (d), grid),
    l AS (SELECT *, last_value(CASE WHEN abs(first_score) >= enter THEN sign(first_score)::INTEGER END IGNORE NULLS) OVER w AS f, last_value(CASE WHEN abs(second_score) >= enter THEN sign(second_score)::INTEGER END IGNORE NULLS) OVER w AS g FROM s WINDOW w AS (PARTITION BY config ORDER BY d)),
    k AS (SELECT *, CASE WHEN f IS NOT NULL AND g IS NOT NULL THEN f || '/' || g END AS candidate, CASE WHEN first_score IS NOT NULL AND second_score IS NOT NULL THEN least(abs(first_score), abs(second_score)) END AS m FROM l),
    q AS (SELECT *, m / (1 + m) AS confidence, list_filter([CASE WHEN closed THEN 'closed' END, CASE WHEN NOT closed AND first_score IS NULL THEN 'first_missing' END, CASE WHEN NOT closed AND second_score IS NULL THEN 'second_missing' END, CASE WHEN candidate IS NULL THEN 'not_latched' END,
        CASE WHEN f * first_score < enter / 2 OR g * second_score < enter / 2 THEN 'deadband' END, CASE WHEN m / (1 + m) < least THEN 'low_confidence' END], lambda r: r IS NOT NULL) AS reasons FROM k),
    r AS (SELECT *, CASE WHEN closed THEN 'closed' WHEN first_score IS NULL OR second_score IS NULL THEN 'stale' WHEN len(reasons) = 0 THEN 'valid' ELSE 'abstain' END AS status, CASE WHEN len(reasons) = 0 THEN candidate END AS published FROM q),
    why AS (SELECT config, unnest(reasons) AS reason FROM r), shown AS (SELECT * FROM r WHERE status = 'valid')
    SELECT * FROM (SELECT config, count(*) AS days, count(*) FILTER (status = 'valid') AS valid_days, {_SPREAD} FROM r GROUP BY config) LEFT JOIN {_LISTED.format("status", "r")} USING (config) LEFT JOIN {_LISTED.format("reason", "why")} USING (config)
        LEFT JOIN {_LISTED.format("candidate", "r")} USING (config) LEFT JOIN {_LISTED.format("published", "r")} USING (config) LEFT JOIN {_RUNS.format("candidate", "r")} USING (config) LEFT JOIN {_RUNS.format("published", "shown")} USING (config)""", "macro"))  # fmt: skip
def market_quality(spark, sf_dir):
    """Score scales, entries and least confidences over a calendar with closed days, and days on which a score is missing."""
    sc = _scores(spark, sf_dir)
    one = lambda axis, name, gone: sc.where((F.col("axis") == axis) & (F.dayofmonth("d") != gone)).select("d", F.round("score", 9).alias(name))
    grid = spark.range(0, 2).withColumnRenamed("id", "a").crossJoin(spark.range(2, 5).withColumnRenamed("id", "b")).crossJoin(spark.range(0, 2).withColumnRenamed("id", "c"))
    scale, enter = 1 + F.col("a") / 2, F.col("b") / 4
    grid = grid.select(F.concat_ws(":", "a", "b", "c").alias("config"), scale.alias("first_scale"), scale.alias("second_scale"), enter.alias("first_enter"), enter.alias("second_enter"), (F.col("c") * 0.4).alias("min_confidence"))
    both = one("1-URGENT", "x", 13).join(one("2-HIGH", "y", 14), "d", "full_outer")
    return _r6(R.market_quality(R.market_replay(both, grid, "d", "x", "y", F.weekday("d") >= 5), "d"))


#: Series of each axis, the first with the configuration's weight and the second with the rest.
_AXES = {"1-URGENT": ("growth", True), "2-HIGH": ("growth", False), "3-MEDIUM": ("inflation", True), "5-LOW": ("inflation", False), "4-NOT SPECIFIED": ("credit", True)}
_AXIS = "(VALUES " + ", ".join(f"('{s}', '{a}', {str(b).lower()})" for s, (a, b) in _AXES.items()) + ") x(series_id, axis, lead)"


@query("rp12_gate_levels", oracle(f"""WITH {_CAL}, mode AS (SELECT * FROM (VALUES ('latest'), ('first')) m(mode)), cfg AS (SELECT a / 4.0 AS w, e / 4.0 AS enter, abs(a / 4.0 - 0.5) + abs(e / 4.0 - 0.5) AS distance FROM range(1, 4) t(a), range(1, 4) u(e)),
    r AS (SELECT mode, cut, series_id, observation_period, value, row_number() OVER (PARTITION BY mode, cut, series_id, observation_period ORDER BY CASE WHEN mode = 'latest' THEN -revision_number ELSE revision_number END) AS n FROM cal, mode, vintages WHERE available_at <= CAST(cut AS TIMESTAMP)),
    z AS (SELECT mode, cut, series_id, round(max_by(value, observation_period) / avg(value) - 1, 9) AS z FROM r WHERE n = 1 GROUP BY ALL),
    sc AS (SELECT w, enter, distance, mode, cut, axis, round(sum(z * CASE WHEN lead THEN w ELSE 1 - w END) / sum(CASE WHEN lead THEN w ELSE 1 - w END), 9) AS score FROM z JOIN {_AXIS} USING (series_id), cfg GROUP BY ALL),
    l AS (SELECT *, last_value(CASE WHEN abs(score) >= enter THEN sign(score)::INTEGER END IGNORE NULLS) OVER (PARTITION BY w, enter, mode, axis ORDER BY cut) AS i FROM sc),
    p AS (SELECT w, enter, distance, cut, axis, max(score) FILTER (mode = 'latest') AS ls, max(score) FILTER (mode = 'first') AS fs, coalesce(max(i) FILTER (mode = 'latest'), 0) AS li, coalesce(max(i) FILTER (mode = 'first'), 0) AS fi FROM l GROUP BY ALL HAVING count(DISTINCT mode) = 2),
    day AS (SELECT w, enter, distance, cut, string_agg(axis || li, '|' ORDER BY axis) <> string_agg(axis || fi, '|' ORDER BY axis) AS changed, coalesce(bool_or(sign(ls) <> sign(fs)) FILTER (axis = 'growth'), false) AS sg, bool_and(li <> 0 AND li * ls >= enter / 2) AS valid FROM p GROUP BY ALL),
    span AS (SELECT min(cut) AS a, max(cut) AS b, min(cut) + CAST(floor((max(cut) - min(cut)) / 2) AS INTEGER) AS m FROM cal), folds AS (SELECT 'full' AS fold, a AS lo, b AS hi FROM span UNION ALL SELECT 'early', a, m FROM span UNION ALL SELECT 'late', m + 1, b FROM span),
    k AS (SELECT w, enter, any_value(distance) AS distance, fold, count(*) AS n, count(*) FILTER (valid) AS valid, count(*) FILTER (changed) AS changed, count(*) FILTER (sg) AS sign_days FROM day JOIN folds ON cut BETWEEN lo AND hi GROUP BY w, enter, fold),
    b AS (SELECT k.*, k.changed / k.n AS rate, c.changed / c.n AS b_rate, k.valid / k.n AS share, k.valid / k.n >= c.valid / c.n AS valid_ok, k.sign_days <= c.sign_days AS signs_ok FROM k JOIN k c ON k.fold = c.fold AND c.distance = 0),
    g AS (SELECT w, enter, max(rate) FILTER (fold = 'full') AS rate, max(share) FILTER (fold = 'full') AS valid_share, max(sign_days) FILTER (fold = 'full') AS sign_days, max((b_rate - rate) / nullif(b_rate, 0)) FILTER (fold = 'full') AS relative_improvement, bool_or(signs_ok) FILTER (fold = 'full') AS signs_ok,
        bool_or(valid_ok) FILTER (fold = 'full') AS valid_ok, count(*) FILTER (fold <> 'full' AND rate < b_rate) AS folds_improved, count(*) FILTER (fold <> 'full' AND rate > b_rate) AS folds_worsened FROM b GROUP BY w, enter)
    SELECT w, enter, round(rate, 6) AS rate, round(valid_share, 6) AS valid_share, sign_days, round(relative_improvement, 6) AS relative_improvement, signs_ok, valid_ok, folds_improved, folds_worsened,
        CASE WHEN rate <= 0.02 THEN 'pass' WHEN rate <= 0.3 AND relative_improvement >= 0.1 AND signs_ok AND valid_ok THEN 'conditional_pass' ELSE 'fail' END AS level FROM g""", "vintages"))  # fmt: skip
def gate_levels(spark, sf_dir):
    """The configurations over what was known at each month's end, with revisions and as first released."""
    v = view(spark, sf_dir, "vintages")
    cal = _calendar(v)
    panels = None
    for mode, kind in (("latest", "latest"), ("first", "first_release")):
        one = pit.panel(v, cal, "cut", kind).select(F.lit(mode).alias("mode"), "cut", "series_id", "observation_period", "value")
        panels = one if panels is None else panels.unionByName(one)
    z = panels.groupBy("mode", "cut", "series_id").agg(F.round(F.max_by("value", "observation_period") / F.avg("value") - 1, 9).alias("z"))
    axes = F.broadcast(spark.createDataFrame([(s, a, b) for s, (a, b) in _AXES.items()], "series_id string, axis string, lead boolean"))
    grid = spark.range(1, 4).select((F.col("id") / 4).alias("w")).crossJoin(spark.range(1, 4).select((F.col("id") / 4).alias("enter")))
    grid = grid.withColumns({"leave": F.col("enter") / 2, "distance": F.abs(F.col("w") - 0.5) + F.abs(F.col("enter") - 0.5)})
    weight = F.when(F.col("lead"), F.col("w")).otherwise(1 - F.col("w"))
    config = ["w", "enter", "distance"]
    scores = z.join(axes, "series_id").crossJoin(F.broadcast(grid)).groupBy(*config, "leave", "mode", "cut", "axis").agg(F.round(F.sum(F.col("z") * weight) / F.sum(weight), 9).alias("score"))
    days = R.two_set_replay(scores, config, "mode", "cut", "axis", "growth", "enter", "leave")
    rows = days.crossJoin(F.broadcast(R.halves(cal, "cut"))).where("cut BETWEEN lo AND hi").groupBy(*config, "fold")
    rows = rows.agg(F.count("*").alias("n"), F.count_if("valid").alias("valid"), F.count_if("changed").alias("changed"), F.count_if("sign_changed").alias("sign_days"))
    return _r6(R.gate_levels(rows, ["w", "enter"], F.col("distance") == 0, 0.02, 0.3, 0.1))


@query("rp13_candidate_sets", oracle("""WITH m AS (SELECT (SELECT avg(r) FROM ret) AS f, (SELECT avg(b) FROM bret) AS k, (SELECT avg(x) FROM (SELECT value - lag(value) OVER (PARTITION BY series_id ORDER BY obs_date) AS x FROM macro)) AS d),
    g AS (SELECT a / 10.0 AS growth_weight, 1 - a / 10.0 AS inflation_weight, t / 10.0 AS risk_tilt, p * 5.0 AS floor_delta, c * 5.0 AS cap_delta, concat_ws('|', a, t, p, c) AS candidate FROM range(3, 8) x(a), range(-1, 2) y(t), range(0, 2) z(p), range(-1, 1) w(c)),
    s AS (SELECT *, round(abs(growth_weight - 0.5) + abs(inflation_weight - 0.5) + abs(risk_tilt) + abs(floor_delta) / 100 + abs(cap_delta) / 100, 12) AS distance FROM g),
    o AS (SELECT *, round(abs(f - k) + abs((growth_weight - inflation_weight) * d) + distance * 0.001, 9) AS objective FROM s, m)
    SELECT candidate, growth_weight, round(distance, 6) AS distance, round(objective, 6) AS objective, CASE WHEN distance = 0 THEN 'selected' ELSE 'rejected' END AS set, CASE WHEN distance > 0 THEN 'no_limits' END AS reason FROM o""", "ret", "bret", "macro"))  # fmt: skip
def candidate_sets(spark, sf_dir):
    """The grid on the means of the tables: entity and benchmark returns, and the macro series' changes."""
    part = lambda name, lo, hi: spark.range(lo, hi).withColumnRenamed("id", name)
    grid = part("a", 3, 8).crossJoin(part("t", -1, 2)).crossJoin(part("p", 0, 2)).crossJoin(part("c", -1, 1))
    grid = grid.select(F.concat_ws("|", "a", "t", "p", "c").alias("candidate"), (F.col("a") / 10).alias("growth_weight"), (1 - F.col("a") / 10).alias("inflation_weight"), (F.col("t") / 10).alias("risk_tilt"), (F.col("p") * 5.0).alias("floor_delta"), (F.col("c") * 5.0).alias("cap_delta"))
    order = Window.partitionBy("series_id").orderBy("obs_date")
    delta = view(spark, sf_dir, "macro").select((F.col("value") - F.lag("value").over(order)).alias("x")).agg(F.avg("x").alias("delta_mean"))
    metrics = _ret(spark, sf_dir).agg(F.avg("r").alias("fund_mean")).crossJoin(_bret(spark, sf_dir).agg(F.avg("b").alias("market_mean"))).crossJoin(delta)
    df = R.candidate_sets(grid, metrics, F.col("distance") == 0)
    return df.select("candidate", "growth_weight", F.round("distance", 6).alias("distance"), F.round("objective", 6).alias("objective"), "set", "reason")


@query("agg25_reason_counts", oracle("""WITH r AS (SELECT o_orderstatus AS status, unnest([CASE WHEN o_totalprice > 200000 THEN 'large' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END, CASE WHEN isodow(o_orderdate) > 5 THEN 'closed' END]) AS reason FROM orders)
    SELECT 'reason' AS kind, reason AS value, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus"""))  # fmt: skip
def reason_counts(spark, sf_dir):
    """Counts by status, and by each reason of the rows' lists of reasons."""
    o = view(spark, sf_dir, "orders")
    reasons = F.array(F.when(F.col("o_totalprice") > 200000, "large"), F.when(F.col("o_orderstatus") == "P", "pending"), F.when(F.weekday("o_orderdate") >= 5, "closed"))
    one = lambda kind, df: df.where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "value", "n")
    return one("reason", o.select(F.explode(reasons).alias("value"))).unionByName(one("status", o.select(F.col("o_orderstatus").alias("value"))))


@query("pos01_fold_metrics", oracle("""WITH h AS (SELECT asset_class AS p, instrument_id AS i, nav_date AS d, r, aum / sum(aum) OVER (PARTITION BY asset_class, nav_date) AS w FROM ret JOIN cohort USING (instrument_id)),
    ds AS (SELECT p, d, lag(d) OVER (PARTITION BY p ORDER BY d) AS before FROM (SELECT DISTINCT p, d FROM h)), e AS (SELECT h.*, ds.before, b.w AS wb FROM h JOIN ds USING (p, d) LEFT JOIN h b ON b.p = h.p AND b.i = h.i AND b.d = ds.before),
    q AS (SELECT p, d, sum(w * r) AS r, CASE WHEN any_value(before) IS NOT NULL THEN 1 - coalesce(sum(CASE WHEN wb IS NOT NULL THEN least(w, wb) END), 0) ELSE 0 END AS t FROM e GROUP BY p, d), s AS (SELECT CAST(date_trunc('month', min(nav_date)) AS DATE) AS a, max(nav_date) AS b FROM ret),
    f AS (SELECT k, CAST(a + to_months((12 * k + 36)::INTEGER) AS DATE) AS lo, CAST(a + to_months((12 * k + 48)::INTEGER) AS DATE) AS hi FROM s, range(0, 100) x(k) WHERE CAST(a + to_months((12 * k + 48)::INTEGER) AS DATE) <= b),
    j AS (SELECT p, k, d, ln(1 + r) AS l, t, sum(ln(1 + r)) OVER w AS c, sum(t) OVER (PARTITION BY p, k ORDER BY d ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS run FROM q JOIN f ON d >= lo AND d < hi WINDOW w AS (PARTITION BY p, k ORDER BY d)),
    x AS (SELECT *, 1 - exp(c - greatest(0, max(c) OVER (PARTITION BY p, k ORDER BY d))) AS down FROM j)
    SELECT p AS asset_class, k, count(*) AS n, round(exp(sum(l) * 252 / count(*)) - 1, 6) AS return_annualised, round(stddev_samp(l) * sqrt(252), 6) AS volatility, round(max(down), 6) AS drawdown, round(max(run), 6) AS turnover, round(sum(t) * 252 / count(*), 6) AS turnover_mean FROM x GROUP BY p, k""", "ret", "cohort"))  # fmt: skip
def fold_metrics(spark, sf_dir):
    """Asset classes weighted by size: return, volatility, drawdown and turnover of every fold's test year."""
    df = _ret(spark, sf_dir).join(view(spark, sf_dir, "cohort").select("instrument_id", "asset_class"), "instrument_id")
    w = df.withColumn("w", F.col("aum") / F.sum("aum").over(Window.partitionBy("asset_class", "nav_date")))
    moved = turnover(w, "asset_class", "nav_date", "instrument_id", "w")
    rows = w.groupBy("asset_class", "nav_date").agg(F.sum(F.col("w") * F.col("r")).alias("r")).join(moved, ["asset_class", "nav_date"], "left")
    first, last = df.agg(F.trunc(F.min("nav_date"), "month"), F.max("nav_date")).first()
    folds = R.fold_bounds(spark, first, last, 36, 12, 12)
    return _r6(R.fold_metrics(rows, folds, "asset_class", "nav_date", "r", "turnover"))
