"""State machines over dated series as window expressions.

Each machine has a region in which the state holds, so the state is the last decisive signal: no loop over days.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from almanac.operators.rolling import bands as rolling_bands
from almanac.operators.rolling import distinct_spread, rolled
from almanac.operators.slices import filled

#: From a median deviation to a standard deviation of a normal distribution.
SCALE = 1.4826


def held(signal: Column, order: WindowSpec) -> Column:
    """The newest non-null signal so far."""
    return F.last(signal, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))


def array_median(values: Column) -> Column:
    s, n = F.sort_array(values), F.size(values)
    at = lambda k: F.try_element_at(s, k.cast("int"))
    return F.when(n > 0, (at(F.floor((n + 1) / 2)) + at(F.floor((n + 2) / 2))) / 2)


def mad(values: Column) -> Column:
    """1.4826 times the median absolute deviation of an array."""
    return SCALE * array_median(F.transform(values, lambda x: F.abs(x - array_median(values))))


def band_regime(df: DataFrame, by: list[str], date: str, x: str, window: int, least: int, entry: float, leave: float) -> DataFrame:
    """df with p_entry, p_exit, state ('off' below the entry band until at or above the exit band) and stress 0..100.

    Bands are floor-index quantiles of the ``window`` rows before; with less than ``least`` the state is 'on'. The state is
    the last decisive signal only while entry <= leave, so anything else is refused. One pass along each entity holds the
    window's order, and entities of very many rows are cut into slices.
    """
    if entry > leave:
        raise ValueError("the entry band must not lie above the exit band")
    df = rolled(df, by, date, x, window, rolling_bands((entry, leave)), "_n bigint, p_entry double, p_exit double, _below bigint")
    ready = F.col("_n") >= least
    df = df.withColumn("p_entry", F.when(ready, F.col("p_entry"))).withColumn("p_exit", F.when(ready, F.col("p_exit")))
    signal = F.when(~ready | (F.col(x) >= F.col("p_exit")), "on").when(F.col(x) < F.col("p_entry"), "off")
    stress = 100 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), (0.5 - F.col("_below") / F.col("_n")) / 0.45))
    df = filled(df.withColumn("stress", F.when(ready, stress)), by, date, {"state": signal})
    return df.withColumn("state", F.coalesce("state", F.lit("on"))).drop("_n", "_below")


def fixed_band(x: Column, enter: float, leave: float, order: WindowSpec) -> Column:
    """True from above enter until below leave."""
    return F.coalesce(held(F.when(x > enter, True).when(x < leave, False), order), F.lit(False))


def debounce(df: DataFrame, by: list[str], date: str, raw: str, k: int, start: bool = False) -> DataFrame:
    """df with state (raw once it has lasted k rows, else as before), flip and dwell, rows since the last flip."""
    # Runs are counted from the places where they begin, so that all of it needs one sort.
    order = Window.partitionBy(*by).orderBy(date)
    df = df.withColumn("_at", F.row_number().over(order)).withColumn("_new", ~F.lag(raw).over(order).eqNullSafe(F.col(raw)) | (F.col("_at") == 1))
    streak = F.col("_at") - held(F.when(F.col("_new"), F.col("_at")), order) + 1
    df = df.withColumn("_streak", streak).withColumn("state", F.coalesce(held(F.when(F.col("_streak") >= k, F.col(raw)), order), F.lit(start)))
    df = df.withColumn("flip", F.col("state") != F.coalesce(F.lag("state").over(order), F.lit(start)))
    dwell = F.col("_at") - F.coalesce(held(F.when(F.col("flip"), F.col("_at")), order), F.lit(1)) + 1
    return df.withColumn("dwell", dwell).drop("_at", "_new", "_streak")


def latched_sign(df: DataFrame, by: list[str], date: str, score: str, enter: float, leave: float, confident: str | None = None) -> DataFrame:
    """df with internal and effective sign, and the reason.

    The sign latches where |score| reaches enter; it is effective unless the score is null or falls below leave on its
    side. With ``confident`` the first latch needs it, and so does being effective; later switches need only the score.
    """
    order = Window.partitionBy(*by).orderBy(date)
    s = F.col(score)
    sure = F.lit(True) if confident is None else F.coalesce(F.col(confident), F.lit(False))
    strong = F.coalesce(F.abs(s) >= enter, F.lit(False))
    begun = F.coalesce(F.max((strong & sure).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)) == 1
    df = df.withColumn("_b", begun).withColumn("internal", held(F.when(F.col("_b") & strong, F.signum(s).cast("int")), order))
    before = F.lag("internal").over(order)
    margin = F.col("internal") * s
    reason = (
        F.when(s.isNull(), "missing").when(F.col("internal").isNull(), F.when(strong, "init_low_confidence").otherwise("init_below_enter"))
        .when(before.isNull(), "init").when(before != F.col("internal"), F.when(sure, "switch").otherwise("switch_low_confidence"))
        .when(margin >= leave, F.when(sure, "hold").otherwise("hold_low_confidence")).otherwise("deadband")
    )
    return df.withColumn("reason", reason).withColumn("effective", F.when(s.isNotNull() & (margin >= leave) & sure, F.col("internal"))).drop("_b")


def axis_scores(df: DataFrame, by: list[str], z: str = "z", weight: str = "w") -> DataFrame:
    """(by, score, n): weighted mean of the available z, weights renormalised by their absolute sum."""
    ok = F.col(z).isNotNull()
    total = F.sum(F.when(ok, F.abs(weight)))
    return df.groupBy(*by).agg(F.when(total > 0, F.sum(F.col(weight) * F.col(z)) / total).alias("score"), F.count(z).alias("n"))


def contributions(df: DataFrame, by: list[str], z: str = "z", weight: str = "w") -> DataFrame:
    """The rows before axis_scores: each available series' share of the score."""
    total = F.sum(F.when(F.col(z).isNotNull(), F.abs(weight))).over(Window.partitionBy(*by))
    return df.withColumn("contribution", F.when(total > 0, F.col(weight) * F.col(z) / total)).where("contribution IS NOT NULL")


def uncertainty(score: str, order: WindowSpec, rows: int, least: int, floor: float) -> Column:
    """Scaled median deviation of the distinct scores of the last rows, floored; null below ``least`` distinct ones.

    A column, which gathers the rows anew at each row: for short windows. ``rolling_uncertainty`` is for others."""
    seen = F.collect_set(score).over(order.rowsBetween(-rows + 1, 0))
    return F.when(F.size(seen) >= least, F.greatest(mad(seen), F.lit(floor)))


def rolling_uncertainty(df: DataFrame, by: list[str], date: str, score: str, rows: int, least: int, floor: float, out: str) -> DataFrame:
    """df with the scaled median deviation of the distinct scores of the last rows, floored; null below ``least`` distinct ones."""
    df = rolled(df, by, date, score, rows, distinct_spread, "_seen bigint, _median double, _spread double")
    return df.withColumn(out, F.when(F.col("_seen") >= least, F.greatest(SCALE * F.col("_spread"), F.lit(floor)))).drop("_seen", "_median", "_spread")


def status(failed: Column, coverage: Column, expired: Column, health: Column, confidence: Column, pending: Column) -> Column:
    """The first reason in a fixed order; valid if none holds."""
    return (
        F.when(failed, "invalid").when(coverage < 0.8, "unavailable").when(expired, "stale").when(health < 0.9, "low_confidence")
        .when(confidence < 0.7, "low_confidence").when(pending, "low_confidence").otherwise("valid")
    )


def runs(df: DataFrame, by: list[str], date: str, state: str) -> DataFrame:
    """(by, state, first, last, n): runs of one state over consecutive rows."""
    order = Window.partitionBy(*by).orderBy(date)
    df = df.withColumn("_i", F.sum((~F.lag(state).over(order).eqNullSafe(F.col(state))).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return df.groupBy(*by, state, "_i").agg(F.min(date).alias("first"), F.max(date).alias("last"), F.count("*").alias("n")).drop("_i")


def transitions(df: DataFrame, by: list[str], date: str, state: str) -> DataFrame:
    """Rows whose non-null state differs from the last non-null one."""
    order = Window.partitionBy(*by).orderBy(date)
    known = df.where(F.col(state).isNotNull()).withColumn("before", F.lag(state).over(order))
    return known.where(F.col("before").isNotNull() & (F.col("before") != F.col(state)))


def nearest_lags(a: DataFrame, b: DataFrame, by: list[str], date: str) -> DataFrame:
    """For each row of a: days to the nearest date of b, the earlier of two; from the last before and the first after."""
    both = a.select(*by, date, F.lit(1).alias("_a")).unionByName(b.select(*by, date, F.col(date).alias("_d")), allowMissingColumns=True)
    order = Window.partitionBy(*by).orderBy(date)
    before, after = F.max("_d").over(order.rangeBetween(Window.unboundedPreceding, 0)), F.min("_d").over(order.rangeBetween(0, Window.unboundedFollowing))
    both = both.withColumn("_x", F.datediff(before, date)).withColumn("_y", F.datediff(after, date)).where("_a = 1")
    return both.select(*by, date, F.when(F.col("_x").isNull() | (F.col("_y") < -F.col("_x")), F.col("_y")).otherwise(F.col("_x")).alias("lag"))


def monotonic_matches(a: DataFrame, b: DataFrame, by: str, date: str, most: int) -> DataFrame:
    """(by, a_date, b_date, lag): one-to-one matches in date order within ``most`` business days, nearest first.

    The choice of a date rules out earlier ones for all later dates, so each key is walked in order, in grouped pandas.
    """
    import numpy as np

    def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):  # a key of one side only
            return pd.DataFrame([], columns=[by, "a_date", "b_date", "lag"])
        days = [np.sort(pd.to_datetime(x[date]).to_numpy().astype("datetime64[D]")) for x in (left, right)]
        out, at = [], 0
        for d in days[0]:
            # Business days are fewer than days, and at least five in seven but for two.
            first, last = np.searchsorted(days[1], [d - np.timedelta64(2 * most + 4, "D"), d + np.timedelta64(2 * most + 4, "D")])
            at = max(at, int(first))
            m = days[1][at:last]
            lag = np.sign((m - d).astype(int)) * (np.busday_count(np.minimum(d, m), np.maximum(d, m) + 1) - 1)
            fits = np.flatnonzero(np.abs(lag) <= most)
            if len(fits):
                best = int(fits[np.lexsort((lag[fits], np.abs(lag[fits])))[0]])
                out.append((left[by].iloc[0], d.astype(object), days[1][at + best].astype(object), int(lag[best])))
                at += best + 1
        return pd.DataFrame(out, columns=[by, "a_date", "b_date", "lag"])

    kind = dict(a.dtypes)[by]
    return a.groupBy(by).cogroup(b.groupBy(by)).applyInPandas(match, f"{by} {kind}, a_date date, b_date date, lag int")


def smoothed(df: DataFrame, by: list[str], date: str, x: str, group: str, half_life: float = 2.0) -> DataFrame:
    """df with ema: exponential smoothing that moves on only where ``group`` (the information set) changes.

    Change points are numbered, and their rows share the average. A null value has no average, and the next one starts anew.
    Of the points since then only those count whose weight a double can still tell from nothing, so each point looks back
    over a window of fixed length.
    """
    decay = 0.5 ** (1 / half_life)
    rows = math.ceil(60 * half_life)
    order = Window.partitionBy(*by).orderBy(date)
    df = df.withColumn("_g", F.sum((~F.lag(group).over(order).eqNullSafe(F.col(group))).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    points = df.groupBy(*by, "_g").agg(F.min_by(x, date).alias("_x"))
    points = points.withColumn("_since", F.count_if(F.col("_x").isNull()).over(Window.partitionBy(*by).orderBy("_g").rowsBetween(Window.unboundedPreceding, 0)))
    points = points.withColumn("_all", F.collect_list("_x").over(Window.partitionBy(*by, "_since").orderBy("_g").rowsBetween(-rows, 0)))
    ema = F.aggregate(F.slice("_all", F.lit(2), F.greatest(F.size("_all") - 1, F.lit(0))), F.get("_all", F.lit(0)), lambda a, v: decay * a + (1 - decay) * v)
    return df.join(points.select(*by, "_g", F.when(F.col("_x").isNotNull(), ema).alias("ema")), [*by, "_g"]).drop("_g")
