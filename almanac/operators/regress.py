"""Regressions of an entity's returns on shared series, from single aggregations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions import metrics as M


def paired(returns: DataFrame, shared: DataFrame, date: str = "nav_date", key: str = "instrument_id") -> DataFrame:
    """Returns joined to the shared series on their common dates, common rows numbered newest first."""
    both = returns.drop("rn").join(shared, date)
    return both.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date))))


def benchmark_metrics(pairs: DataFrame, rf: float, days: int = M.DAYS, key: str = "instrument_id") -> DataFrame:
    """Beta, alpha, tracking error, information ratio and up and down capture over the last ``days`` common dates."""
    last = pairs.where(F.col("rn") <= days)
    beta, active = F.covar_samp("r", "b") / F.nullif(F.var_samp("b"), F.lit(0.0)), F.col("r") - F.col("b")
    error = F.stddev_samp(active) * M.DAYS**0.5
    found = last.groupBy(key).agg(
        F.count("*").alias("n"), beta.alias("beta"), ((F.avg("r") - rf / M.DAYS - beta * (F.avg("b") - rf / M.DAYS)) * M.DAYS).alias("alpha"),
        error.alias("tracking_error"), F.when(error >= M.LEAST_VOL, F.avg(active) * M.DAYS / error).alias("information_ratio"),
        M.capture(F.col("b") > 0).alias("up_capture"), M.capture(F.col("b") < 0).alias("down_capture"),
    )
    fits = F.abs("beta") <= 10
    return found.where(F.col("n") >= days).select(key, F.when(fits, F.col("beta")).alias("beta"), F.when(fits, F.col("alpha")).alias("alpha"), "tracking_error", "information_ratio", "up_capture", "down_capture")


def factor_beta(y: str, x: str, sign: int = 1, least: int = 120, least_r2: float = 0.05) -> Column:
    """Slope of y on x, null below a count or an r-square."""
    return F.when((F.count(F.lit(1)) >= least) & (F.regr_r2(y, x) >= least_r2), sign * F.regr_slope(y, x))


def crisis_alpha(pairs: DataFrame, threshold: float = -0.1, least: int = 60, least_crisis: int = 20, bound: float = 10.0, key: str = "instrument_id", date: str = "nav_date") -> DataFrame:
    """(key, crisis_alpha): compounded return less the benchmark's over the days when the benchmark was in a drawdown."""
    w = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    df = pairs.withColumn("p", F.sum(F.log1p("b")).over(w)).withColumn("dd", F.exp(F.col("p") - F.max("p").over(w)) - 1)
    crisis = F.col("dd") < threshold
    gap = F.exp(F.sum(F.when(crisis, F.log1p("r")))) - F.exp(F.sum(F.when(crisis, F.log1p("b"))))
    return df.groupBy(key).agg(F.count("*").alias("n"), F.count_if(crisis).alias("k"), F.greatest(F.lit(-bound), F.least(F.lit(bound), gap)).alias("crisis_alpha")).where((F.col("n") >= least) & (F.col("k") >= least_crisis)).select(key, "crisis_alpha")


def multi_factor(df: DataFrame, y: str, xs: list[str], key: str) -> DataFrame:
    """(key, factor, beta, t, mark): least squares of y on xs and a constant.

    Spark sums the cross products per key in one aggregation; only these small matrices reach the solver.
    """
    cols, n = ["_one", *xs], len(xs) + 1
    df = df.withColumn("_one", F.lit(1.0))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    sums = df.groupBy(key).agg(F.array(*(F.sum(F.col(a) * F.col(b)) for a, b in pairs)).alias("g"), F.array(*(F.sum(F.col(a) * F.col(y)) for a in cols)).alias("c"), F.sum(F.col(y) * F.col(y)).alias("s"), F.count("*").alias("n"))

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                gram = np.zeros((n, n))
                gram[np.triu_indices(n)] = row.g
                gram = gram + np.triu(gram, 1).T
                inverse = np.linalg.pinv(gram)
                beta = inverse @ np.asarray(row.c)
                left = max(row.s - beta @ np.asarray(row.c), 0.0)
                se = np.sqrt(np.maximum(np.diag(inverse) * left / max(row.n - n, 1), 1e-300))
                for k, name in enumerate(["const", *xs]):
                    t = beta[k] / se[k]
                    out.append((getattr(row, key), name, float(beta[k]), float(t), "***" if abs(t) >= 2.58 else "**" if abs(t) >= 1.96 else "*" if abs(t) >= 1.65 else ""))
            yield pd.DataFrame(out, columns=[key, "factor", "beta", "t", "mark"])

    kind = dict(df.dtypes)[key]
    return sums.where(F.col("n") >= max(10, len(xs) + 2)).mapInPandas(solve, f"{key} {kind}, factor string, beta double, t double, mark string")
