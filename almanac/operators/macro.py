"""Transforms and scores of macro series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.operators.regimes import SCALE
from almanac.operators.rolling import distinct_spread, rolled


def economic_transforms(df: DataFrame, key: str, date: str, value: str, neutral: float) -> DataFrame:
    """df with six impulses of a monthly series. Shifts go by calendar month, averages by rows; too little history is null."""
    order = Window.partitionBy(key).orderBy(date)
    k = F.row_number().over(order)
    recent, prior = F.avg(value).over(order.rowsBetween(-2, 0)), F.avg(value).over(order.rowsBetween(-5, -3))
    df = df.withColumn("_k", k).withColumn("_a", recent).withColumn("_b", prior)
    for m in (3, 12):
        shifted = df.select(F.col(key), F.add_months(date, m).alias(date), F.col(value).alias(f"_m{m}"))
        df = df.join(shifted, [key, date], "left")
    x, x3, x12 = F.col(value), F.col("_m3"), F.col("_m12")
    ln = lambda c: F.ln(F.when(c > 0, c))
    yoy = x / F.nullif(x12, F.lit(0.0)) - 1
    out = {
        "log_3m3m": F.when(F.col("_k") >= 6, 4 * (ln(F.col("_a")) - ln(F.col("_b")))),
        "mean3_gap": F.when(F.col("_k") >= 3, F.col("_a") - neutral),
        "delta_3m": x - x3,
        "log_qoq": 4 * (ln(x) - ln(x3)),
        "ann3m_minus_yoy": 4 * (ln(x) - ln(x3)) - (ln(x) - ln(x12)),
        "_yoy": yoy,
    }
    df = df.select(key, date, value, *(c.alias(n) for n, c in out.items()))
    known = Window.partitionBy(key, F.col("_yoy").isNull()).orderBy(date)
    return df.withColumn("delta_3m_yoy", F.col("_yoy") - F.lag("_yoy", 3).over(known)).drop("_yoy")


def robust_z(df: DataFrame, key: str, date: str, value: str, rows: int, bound: float = 4.0) -> DataFrame:
    """df with z over the distinct values of the last rows: distance to their median in scaled median deviations."""
    df = rolled(df, [key], date, value, rows, distinct_spread, "_seen bigint, _median double, _spread double")
    z = F.greatest(F.lit(-bound), F.least(F.lit(bound), (F.col(value) - F.col("_median")) / F.nullif(SCALE * F.col("_spread"), F.lit(0.0))))
    return df.withColumn("z", F.when((F.col("_seen") >= 2) & (F.col("_spread") > 0), z)).drop("_seen", "_median", "_spread")


def weighted_components(weights: dict[str, float]) -> Column:
    """Weighted mean of the components that are present."""
    zero = F.lit(0.0)
    total = sum((F.when(F.col(c).isNotNull(), w).otherwise(0.0) for c, w in weights.items()), zero)
    return sum((F.coalesce(w * F.col(c), zero) for c, w in weights.items()), zero) / F.nullif(total, zero)
