"""Column builders for metrics of a dated series.

Aggregates expect rows numbered newest first (``rn`` = 1 is the newest surviving return ``r``), so metrics over many
horizons come out of one ``groupBy``. Each is null where its window holds too few rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS = 252
LEAST_VOL = 0.01


def clip(x: Column, digits: int = 6, bound: float = 9999.999999) -> Column:
    """Null for null and non-finite values, else held within the bound and rounded half to even."""
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.when(finite, F.bround(F.greatest(F.lit(-bound), F.least(F.lit(bound), x)), digits))


def within(x: Column, bound: float) -> Column:
    return F.when(F.abs(x) <= bound, x)


def ratio(num: Column, den: Column) -> Column:
    """Null for a null or non-positive denominator."""
    return F.when(den > 0, num / den)


def or_else(first: Column, second: Column) -> Column:
    """Zero counts as missing."""
    return F.when(first.isNotNull() & (first != 0), first).otherwise(second)


def _in(n: int, x: str | Column = "r") -> Column:
    return F.when(F.col("rn") <= n, F.col(x) if isinstance(x, str) else x)


def _full(n: int, value: Column) -> Column:
    return F.when(F.count(_in(n)) >= n, value)


def trailing_return(n: int, level: str = "nav") -> Column:
    """Newest level over the one n rows before it, less one."""
    base = F.max(F.when(F.col("rn") == n + 1, F.col(level)))
    return F.when(base != 0, F.max(F.when(F.col("rn") == 1, F.col(level))) / base - 1)


def annual_return(years: int, level: str = "nav") -> Column:
    base, last = F.max(F.when(F.col("rn") == years * DAYS + 1, F.col(level))), F.max(F.when(F.col("rn") == 1, F.col(level)))
    return F.when(base > 0, F.when(last / base <= 0, -1.0).otherwise(F.pow(last / base, 1.0 / years) - 1))


def volatility(n: int) -> Column:
    return _full(n, F.stddev_samp(_in(n)) * DAYS**0.5)


def sharpe(n: int, rf: float) -> Column:
    vol = F.stddev_samp(_in(n))
    return _full(n, F.when((vol > 0) & (vol * DAYS**0.5 >= LEAST_VOL), (F.avg(_in(n)) - rf / DAYS) / vol * DAYS**0.5))


def sortino(n: int, rf: float) -> Column:
    short = F.sqrt(F.avg(F.pow(F.least(_in(n) - rf / DAYS, F.when(F.col("rn") <= n, 0.0)), 2)))
    return _full(n, F.when(short * DAYS**0.5 >= LEAST_VOL, (F.avg(_in(n)) - rf / DAYS) / short * DAYS**0.5))


def tail_losses(n: int, level: float = 0.95) -> Column:
    """Struct (var, cvar) of the last n returns, negative for losses: the upper empirical quantile of the losses, and that
    plus the mean excess over it."""

    def both(losses: Column) -> Column:
        size = F.size(losses)
        at = F.ceil(level * (size - 1)).cast("int")
        var = F.get(losses, at)
        # Sorted, so only what stands behind the quantile lies over it.
        over = F.aggregate(F.slice(losses, at + 2, F.greatest(size - at - 1, F.lit(0))), F.lit(0.0), lambda a, x: a + x - var)
        return F.struct((-var).alias("var"), (-(var + over / ((1 - level) * size))).alias("cvar"))

    # Named by a transform, the losses are sorted once.
    return _full(n, F.get(F.transform(F.array(F.sort_array(F.collect_list(-_in(n)))), both), F.lit(0)))


def moments(n: int) -> list[Column]:
    """Count and power sums of the last n returns, from which adjusted_sharpe works."""
    return [F.count(_in(n)).alias("m0"), *(F.sum(F.pow(_in(n), k)).alias(f"m{k}") for k in range(1, 5))]


def adjusted_sharpe(rf: float) -> Column:
    """Struct of the skew- and kurtosis-adjusted yearly Sharpe ratio and its 95 % interval, from moments()."""
    n, (s1, s2, s3, s4) = F.col("m0"), (F.col(f"m{k}") for k in range(1, 5))
    m = s1 / n
    c2, c3, c4 = s2 - n * m**2, s3 - 3 * m * s2 + 2 * n * m**3, s4 - 4 * m * s3 + 6 * m**2 * s2 - 3 * n * m**4
    sd = F.sqrt(c2 / (n - 1))
    skew, kurt, sr = c3 / n / F.pow(sd, 3), c4 / n / F.pow(sd, 4) - 3, (m - rf / DAYS) / sd
    value = sr * (1 + skew / 6 * sr - kurt / 24 * sr * sr) * DAYS**0.5
    error = F.sqrt((1 + 0.5 * sr * sr - skew * sr + kurt / 4 * sr * sr) / n) * DAYS**0.5
    return F.when((n >= 30) & (sd > 0), F.struct(skew.alias("skew"), kurt.alias("kurt"), value.alias("value"), (value - 1.96 * error).alias("low"), (value + 1.96 * error).alias("high")))


def weighted_volatility(decay: float = 0.94, least: int = 20) -> Column:
    """Exponentially weighted yearly volatility, seeded with the population variance, in closed form."""
    total = F.pow(F.lit(decay), F.count("r")) * F.var_pop("r") + F.sum((1 - decay) * F.pow(F.lit(decay), F.col("rn") - 1) * F.col("r") * F.col("r"))
    return F.when(F.count("r") >= least, F.sqrt(total) * DAYS**0.5)


def rsi(n: int = 14) -> Column:
    """From differences ``d`` of the level."""
    gain, loss = F.avg(_in(n, F.greatest(F.col("d"), F.lit(0.0)))), F.avg(_in(n, F.greatest(-F.col("d"), F.lit(0.0))))
    value = F.when(loss == 0, F.when(gain > 0, 100.0).otherwise(50.0)).otherwise(100 - 100 / (1 + gain / F.nullif(loss, F.lit(0.0))))
    return F.when(F.count(_in(n, "d")) >= n, value)


def band_position(n: int = 20, level: str = "nav") -> Column:
    """Where the newest level stands between two deviations below (0) and above (1) the mean of the last n."""
    x = _in(n, level)
    mean, sd = F.avg(x), F.stddev_samp(x)
    last = F.max(F.when(F.col("rn") == 1, F.col(level)))
    return F.when(F.count(x) >= n, F.when(sd == 0, 0.5).otherwise((last - mean + 2 * sd) / (4 * F.nullif(sd, F.lit(0.0)))))


def slope_score(cumulative: Column, index: Column, scale: float, least: int) -> Column:
    """50 + 50 tanh(slope / scale) of a cumulative series, within 0 and 100."""
    value = 50 + 50 * F.tanh(F.regr_slope(cumulative, index) / scale)
    return F.when((F.count(cumulative) >= least) & value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), value)))


def capture(side: Column, least: int = 5, bound: float = 500.0) -> Column:
    """Geometric mean return of r over that of b on the days where side holds, in percent."""
    own, base = (F.exp(F.avg(F.when(side, F.log1p(x)))) - 1 for x in ("r", "b"))
    return F.when((F.count(F.when(side, 1)) >= least) & (base != 0), within(100 * own / F.nullif(base, F.lit(0.0)), bound))


def normalised(value: Column, low: float, high: float, peer: Column | None = None) -> Column:
    """Struct: value scaled to 0..100, and whether it was missing (then five below the peers' median, or 45)."""
    missing = value.isNull() | F.isnan(value)
    bound = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(100.0), x))
    stand_in = F.lit(45.0) if peer is None else F.when(peer.isNotNull(), bound(peer - 5)).otherwise(45.0)  # greatest skips nulls
    scaled = F.lit(50.0) if high == low else bound((value - low) / (high - low) * 100)
    return F.struct(F.when(missing, stand_in).otherwise(scaled).alias("score"), missing.alias("missing"))


def peaked(value: Column, target: float, half: float) -> Column:
    return F.when(value.isNull() | F.isnan(value), 45.0).otherwise(F.greatest(F.lit(0.0), 100 * (1 - F.abs(value - target) / half)))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution for z >= 0, by a rational polynomial (error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return 1 - F.exp(-z * z / 2) / 2.5066282746310002 * poly
