"""Comparison and evaluation of replays: revisions between two, threshold grids, gates per configuration, folds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.operators.regimes import held, runs


def revision_by_axis(both: DataFrame, axis: str) -> DataFrame:
    """Per axis of (latest, revised, latest_state, revised_state): median and ninth decile of the absolute score change, days
    on which the sign changed, and on which the state did. Days that one replay lacks are not in ``both``."""
    gap = F.percentile(F.abs(F.col("latest") - F.col("revised")), F.array(F.lit(0.5), F.lit(0.9)))
    sign, state = _sign_changed(), ~F.col("latest_state").eqNullSafe(F.col("revised_state"))
    df = both.groupBy(axis).agg(gap.alias("p"), F.count_if(sign).alias("sign_days"), F.count_if(state).alias("state_days"))
    return df.select(axis, F.col("p")[0].alias("gap_median"), F.col("p")[1].alias("gap_p90"), "sign_days", "state_days")


def _sign_changed() -> Column:
    return F.coalesce(F.signum("latest") != F.signum("revised"), F.lit(False))


def revision_episodes(both: DataFrame, date: str, axis: str) -> DataFrame:
    """One row: common days, days on which a sign changed and no axis state did (the dead band absorbed it), days on which
    the candidate (all axes' states together) changed and their share, and how many episodes of such days on the calendar of
    common days there are, with median and ninth decile of their lengths."""
    named = lambda c: F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", axis, F.coalesce(c, F.lit("none"))))), "|")
    state = ~F.col("latest_state").eqNullSafe(F.col("revised_state"))
    days = both.groupBy(date).agg(F.bool_or(_sign_changed()).alias("sign"), F.bool_or(state).alias("state"), (named("latest_state") != named("revised_state")).alias("candidate"))
    # The calendar is one sequence, of a row a day.
    episodes = runs(days.withColumn("_k", F.lit(1)), ["_k"], date, "candidate").where("candidate")
    length = episodes.agg(F.count("*").alias("episodes"), F.percentile("n", F.array(F.lit(0.5), F.lit(0.9))).alias("p"))
    total = days.agg(F.count("*").alias("days"), F.count_if(F.col("sign") & ~F.col("state")).alias("absorbed_days"), F.count_if("candidate").alias("candidate_days"))
    df = total.crossJoin(F.broadcast(length))
    return df.select("days", "absorbed_days", "candidate_days", (F.col("candidate_days") / F.col("days")).alias("candidate_rate"), "episodes", F.col("p")[0].alias("episode_median"), F.col("p")[1].alias("episode_p90"))


def grid_replay(scores: DataFrame, grid: DataFrame, date: str, first: str, second: str) -> DataFrame:
    """Every configuration of a small grid over a two-axis replay: candidate quadrant, and whether it is published.

    An axis takes the sign of a score that reaches its entry threshold and keeps it; the day is valid while both scores hold
    their axis' exit threshold. Configurations (config, first_enter, first_exit, second_enter, second_exit).
    """
    order = Window.partitionBy("config").orderBy(date)
    df = scores.crossJoin(F.broadcast(grid))
    for c, name in ((first, "first"), (second, "second")):
        df = df.withColumn(f"_{name}", held(F.when(F.abs(c) >= F.col(f"{name}_enter"), F.signum(c).cast("int")), order))
    known = F.col("_first").isNotNull() & F.col("_second").isNotNull()
    valid = F.coalesce((F.col("_first") * F.col(first) >= F.col("first_exit")) & (F.col("_second") * F.col(second) >= F.col("second_exit")), F.lit(False))
    return df.withColumn("candidate", F.when(known, F.concat_ws("/", "_first", "_second"))).withColumn("valid", valid).select("config", date, "candidate", "valid")


def grid_metrics(replay: DataFrame, date: str) -> DataFrame:
    """Per configuration: days, valid and abstaining days, flips a year of 252 days of the candidate and of what was
    published, the mean length of a published run, and whether every year has a valid day."""
    order = Window.partitionBy("config").orderBy(date)
    df = replay.withColumn("_flip", F.coalesce(F.col("candidate") != F.lag("candidate").over(order), F.lit(False)))
    whole = df.groupBy("config").agg(F.count("*").alias("days"), F.count_if("valid").alias("valid_days"), F.count_if("_flip").alias("flips"), F.count_distinct(F.year(date)).alias("years"), F.count_distinct(F.when(F.col("valid"), F.year(date))).alias("valid_years"))
    shown = runs(replay.where("valid"), ["config"], date, "candidate").groupBy("config").agg((F.count("*") - 1).alias("changes"), F.avg("n").alias("published_run"))
    per_year = F.greatest(F.lit(1.0), F.col("days") / 252.0)
    df = whole.join(shown, "config", "left")
    return df.select(
        "config", "days", "valid_days", (F.col("days") - F.col("valid_days")).alias("abstain_days"), (F.col("flips") / per_year).alias("candidate_flips_per_year"),
        (F.coalesce("changes", F.lit(0)) / per_year).alias("published_flips_per_year"), "published_run", (F.col("years") == F.col("valid_years")).alias("all_years"),
    )


def market_replay(scores: DataFrame, grid: DataFrame, date: str, first: str, second: str, closed: Column) -> DataFrame:
    """(config, date, candidate, published, status, reasons, confidence, scaled scores) of every configuration and calendar day.

    The calendar runs from the first date of scores to the last, and ``closed`` says of its days which have no session; their
    scores, if any, don't count. Configurations (config, first_scale, second_scale, first_enter, second_enter,
    min_confidence): scores are scaled, an axis latches the sign of one that reaches its entry and keeps it over days without
    one, and holds while the score stays at half the entry or more on its side. Confidence is s / (1 + s) of the smaller
    scaled score. All reasons against a day are listed; one without any is valid, and publishes its candidate. Status:
    closed, stale (a score is missing), valid or abstain.
    """
    span = scores.agg(F.min(date).alias("a"), F.max(date).alias("b")).select(F.explode(F.sequence("a", "b")).alias(date))
    # Days of a calendar by a few configurations.
    df = span.join(scores, date, "left").withColumn("_closed", closed).crossJoin(F.broadcast(grid))
    order = Window.partitionBy("config").orderBy(date)
    for c, name in ((first, "first"), (second, "second")):
        df = df.withColumn(f"{name}_score", F.when(~F.col("_closed"), F.col(c) * F.col(f"{name}_scale")))
        df = df.withColumn(f"_{name}", held(F.when(F.abs(f"{name}_score") >= F.col(f"{name}_enter"), F.signum(f"{name}_score").cast("int")), order))
    smaller = F.when(F.col("first_score").isNotNull() & F.col("second_score").isNotNull(), F.least(F.abs("first_score"), F.abs("second_score")))
    df = df.withColumn("confidence", smaller / (1 + smaller)).withColumn("candidate", F.when(F.col("_first").isNotNull() & F.col("_second").isNotNull(), F.concat_ws("/", "_first", "_second")))
    open_day, off = ~F.col("_closed"), lambda name: F.col(f"_{name}") * F.col(f"{name}_score") < F.col(f"{name}_enter") / 2
    reasons = {
        "closed": F.col("_closed"), "first_missing": open_day & F.col("first_score").isNull(), "second_missing": open_day & F.col("second_score").isNull(),
        "not_latched": F.col("candidate").isNull(), "deadband": off("first") | off("second"), "low_confidence": F.col("confidence") < F.col("min_confidence"),
    }
    df = df.withColumn("reasons", F.array_compact(F.array(*(F.when(ok, name) for name, ok in reasons.items()))))
    status = F.when(F.col("_closed"), "closed").when(F.arrays_overlap("reasons", F.array(F.lit("first_missing"), F.lit("second_missing"))), "stale").when(F.size("reasons") == 0, "valid").otherwise("abstain")
    return df.select("config", date, "candidate", F.when(F.size("reasons") == 0, F.col("candidate")).alias("published"), status.alias("status"), "reasons", "confidence", "first_score", "second_score")


def market_quality(replay: DataFrame, date: str) -> DataFrame:
    """Per configuration of ``market_replay``: days, counts of statuses, reasons, candidates and published ones (as k:n, joined by
    commas), run lengths of candidates and of published days among the valid ones, and deciles and medians of confidence and
    scores. Groups are a configuration's days."""
    counted = lambda df, c: df.where(F.col(c).isNotNull()).groupBy("config", c).agg(F.count("*").alias("n")).groupBy("config").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", c, "n"))), ",").alias(f"{c}_counts"))
    lengths = lambda df, c: runs(df, ["config"], date, c).where(F.col(c).isNotNull()).groupBy("config").agg(F.median("n").alias(f"{c}_run_median"), F.max("n").alias(f"{c}_run_max"))
    spread = lambda c: F.percentile(c, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias(f"_{c}")
    names = ("confidence", "first_score", "second_score")
    df = replay.groupBy("config").agg(F.count("*").alias("days"), F.count_if(F.col("status") == "valid").alias("valid_days"), *(spread(c) for c in names))
    df = df.select("config", "days", "valid_days", *(F.col(f"_{c}")[k].alias(f"{c}_{p}") for c in names for k, p in enumerate(("p10", "p50", "p90"))))
    reasons = replay.select("config", F.explode("reasons").alias("reason"))
    for part in (counted(replay, "status"), counted(reasons, "reason"), counted(replay, "candidate"), counted(replay, "published"), lengths(replay, "candidate"), lengths(replay.where("status = 'valid'"), "published")):
        df = df.join(part, "config", "left")
    return df


def two_set_replay(scores: DataFrame, config: list[str], mode: str, date: str, axis: str, first_axis: str, enter: str, leave: str) -> DataFrame:
    """(config, date, changed, sign_changed, valid): every configuration of a grid over two information sets in one pass.

    scores: (config, mode, date, axis, score, enter, leave), modes ``latest`` and ``first``: what was known then with later
    revisions, and as first released. Each axis latches the sign of a score that reaches ``enter``. changed: the candidate
    (all axes' signs together) differs between the sets; sign_changed: the raw score of ``first_axis`` changes its sign;
    valid: in the latest set every axis has latched and holds ``leave``. Dates that one set lacks are left out.
    """
    order = Window.partitionBy(*config, mode, axis).orderBy(date)
    df = scores.withColumn("_sign", held(F.when(F.abs("score") >= F.col(enter), F.signum("score").cast("int")), order))
    df = df.withColumn("_ok", F.coalesce(F.col("_sign") * F.col("score") >= F.col(leave), F.lit(False)))
    of = lambda m, c: F.max(F.when(F.col(mode) == m, F.col(c)))
    each = df.groupBy(*config, date, axis).agg(*(of(m, c).alias(f"{m}_{n}") for m in ("latest", "first") for c, n in (("score", "score"), ("_sign", "sign"), ("_ok", "ok"))), F.count_distinct(mode).alias("_sets")).where("_sets = 2")
    named = lambda c: F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", axis, F.coalesce(c, F.lit(0))))), "|")
    sign = F.bool_or((F.col(axis) == first_axis) & (F.signum("latest_score") != F.signum("first_score")))
    return each.groupBy(*config, date).agg((named("latest_sign") != named("first_sign")).alias("changed"), F.coalesce(sign, F.lit(False)).alias("sign_changed"), F.bool_and("latest_ok").alias("valid"))


def halves(days: DataFrame, date: str) -> DataFrame:
    """(fold, lo, hi): the whole period of days, and its two halves by the calendar."""
    r = days.agg(F.min(date).alias("a"), F.max(date).alias("b")).withColumn("m", F.expr("date_add(a, cast(floor(datediff(b, a) / 2) AS int))"))
    fold = lambda name, lo, hi: F.struct(F.lit(name).alias("fold"), lo.alias("lo"), hi.alias("hi"))
    every = F.array(fold("full", F.col("a"), F.col("b")), fold("early", F.col("a"), F.col("m")), fold("late", F.date_add("m", 1), F.col("b")))
    return r.select(F.explode(every).alias("f")).select("f.*")


def gate_levels(folds: DataFrame, config: list[str], control: Column, target: float, conditional: float, improvement: float) -> DataFrame:
    """Gate per configuration from rows (config, fold, n, valid, changed, sign_days); the fold 'full' is the whole, the others
    are compared.

    The revision rate is the share of dates on which the candidate differs between two information sets. A configuration
    passes at ``target`` or less. It passes on condition at ``conditional`` or less if the rate lies ``improvement`` below
    the control's, relatively, the sign of the first axis changes on no more days, and no smaller share of days is valid.
    Folds improve or worsen by their rate against the control's.
    """
    df = folds.withColumn("rate", F.col("changed") / F.col("n")).withColumn("share", F.col("valid") / F.col("n"))
    # One row a fold.
    base = F.broadcast(df.where(control).select("fold", F.col("rate").alias("b_rate"), F.col("sign_days").alias("b_signs"), F.col("share").alias("b_share")))
    df, whole = df.join(base, "fold"), F.col("fold") == "full"
    one = lambda c: F.max(F.when(whole, c))
    df = df.groupBy(*config).agg(
        one(F.col("rate")).alias("rate"), one(F.col("share")).alias("valid_share"), one(F.col("sign_days")).alias("sign_days"), one((F.col("b_rate") - F.col("rate")) / F.nullif(F.col("b_rate"), F.lit(0.0))).alias("relative_improvement"),
        one(F.col("sign_days") <= F.col("b_signs")).alias("signs_ok"), one(F.col("share") >= F.col("b_share")).alias("valid_ok"),
        F.count_if(~whole & (F.col("rate") < F.col("b_rate"))).alias("folds_improved"), F.count_if(~whole & (F.col("rate") > F.col("b_rate"))).alias("folds_worsened"),
    )
    held_back = (F.col("rate") <= conditional) & (F.col("relative_improvement") >= improvement) & F.col("signs_ok") & F.col("valid_ok")
    return df.withColumn("level", F.when(F.col("rate") <= target, "pass").when(held_back, "conditional_pass").otherwise("fail"))


def candidate_sets(grid: DataFrame, metrics: DataFrame, baseline: Column, limit: float | None = None) -> DataFrame:
    """Candidates of a small grid with distance, objective, rank, set and reason.

    grid: (candidate, growth_weight, inflation_weight, risk_tilt, floor_delta, cap_delta), deltas in points. metrics: one row
    (fund_mean, market_mean, delta_mean) of the tables that the candidates are scored on. The distance is how far a candidate
    lies from equal weights without tilt or deltas; the objective is the gap of the means, plus the balance of the weights by
    the mean delta, plus a thousandth of the distance. Ranks go by objective, distance and name. Without a limit on the
    objective nothing but the baseline may be selected; with one, what reaches it is. Both are numbers to twelve digits.
    """
    near = F.abs(F.col("growth_weight") - 0.5) + F.abs(F.col("inflation_weight") - 0.5) + F.abs("risk_tilt") + F.abs("floor_delta") / 100 + F.abs("cap_delta") / 100
    # One row of metrics.
    df = grid.crossJoin(F.broadcast(metrics)).withColumn("distance", F.round(near, 12))
    value = F.abs(F.col("fund_mean") - F.col("market_mean")) + F.abs((F.col("growth_weight") - F.col("inflation_weight")) * F.col("delta_mean")) + F.col("distance") * 0.001
    df = df.withColumn("objective", F.round(value, 12)).withColumn("rank", F.row_number().over(Window.orderBy("objective", "distance", "candidate")))
    chosen = baseline if limit is None else F.col("objective") <= limit
    return df.select(*grid.columns, "distance", "objective", "rank", F.when(chosen, "selected").otherwise("rejected").alias("set"), F.when(~chosen, "no_limits" if limit is None else "objective").alias("reason"))


def fold_metrics(rows: DataFrame, folds: DataFrame, key: str, date: str, r: str, turnover: str, year: int = 252) -> DataFrame:
    """(key, k, n, return_annualised, volatility, drawdown, turnover, turnover_mean) of each fold's test window.

    rows: (key, date, r, turnover), daily returns and one-way turnovers (null: none). The return is compounded and brought
    to a year of ``year`` rows, volatility is that of log returns, the drawdown is from the window's own peak, its start
    included, and the turnover is the largest sum of ``year`` rows in a row; turnover_mean is its yearly mean.
    """
    # Folds are a few rows.
    df = rows.join(F.broadcast(folds), (F.col(date) >= F.col("test_from")) & (F.col(date) < F.col("test_to")))
    order = Window.partitionBy(key, "k").orderBy(date)
    path = F.sum(F.ln(1 + F.col(r))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("_l", F.ln(1 + F.col(r))).withColumn("_p", path).withColumn("_t", F.coalesce(turnover, F.lit(0.0)))
    peak = F.greatest(F.lit(0.0), F.max("_p").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("_down", 1 - F.exp(F.col("_p") - peak)).withColumn("_run", F.sum("_t").over(order.rowsBetween(1 - year, 0)))
    n = F.count("*")
    return df.groupBy(key, "k").agg(
        n.alias("n"), (F.exp(F.sum("_l") * year / n) - 1).alias("return_annualised"), (F.stddev_samp("_l") * math.sqrt(year)).alias("volatility"), F.max("_down").alias("drawdown"),
        F.max("_run").alias("turnover"), (F.sum("_t") * year / n).alias("turnover_mean"),
    )


def fold_bounds(spark, first: str, last: str, train: int, test: int, step: int) -> DataFrame:
    """Rolling folds (k, train_from, test_from, test_to), end exclusive, whose test window ends within the period."""
    months = spark.sql(f"SELECT CAST(months_between(DATE '{last}', DATE '{first}') AS int) AS m").select(F.explode(F.expr(f"sequence(0, greatest(0, div(m - {train + test}, {step})))")).alias("k"))
    at = lambda n: F.expr(f"add_months(DATE '{first}', CAST({step} * k + {n} AS int))")
    return months.select(F.col("k").cast("bigint").alias("k"), at(0).alias("train_from"), at(train).alias("test_from"), at(train + test).alias("test_to")).where(F.col("test_to") <= F.lit(last).cast("date"))
