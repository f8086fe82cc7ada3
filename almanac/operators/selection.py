"""Exact order statistics of groups of any size, by refinement.

A quantile is a value at a place of the order, and to find it the order need not be made. A histogram of a group tells in
which of its bins the place falls; only the rows of that bin are looked at again, in finer bins, until so few are left that
one task may sort them, or all are equal. Each round is one aggregation with partial counts: a few numbers per bin are
shuffled, never the rows, so one group of all rows uses every task. Weighted quantiles count weights instead of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.work import checkpointed

#: Bins of a round, rows that one task may sort, groups up to which their bins are broadcast.
BINS, LIMIT, FEW = 4096, 100_000, 100_000


def _finite(v: str) -> Column:
    return F.when(F.abs(v) < float("inf"), F.col(v))


def _spans() -> list[Column]:
    return [F.min("v").alias("lo"), F.max("v").alias("hi"), F.min(_finite("v")).alias("least"), F.max(_finite("v")).alias("most"), F.count("*").alias("size")]


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    ok = F.lit(True)
    for c in names:
        ok &= a[c].eqNullSafe(b[f"_{c}"])
    return ok


def _met(rows: DataFrame, table: DataFrame, names: list[str], few: bool) -> DataFrame:
    """rows with the columns of a table of one row per values of names, which may be null."""
    table = table.withColumnsRenamed({c: f"_{c}" for c in names})
    return rows.join(F.broadcast(table) if few else table, _same(rows, table, names)).drop(*(f"_{c}" for c in names))


def _bin(log: bool) -> Column:
    """Bin of v within its span, rising with v; infinities and NaN have bins of their own."""
    v, lo, hi = F.col("v"), F.col("span.least"), F.col("span.most")
    even = (v / 2 - lo / 2) / F.nullif(hi / 2 - lo / 2, F.lit(0.0))
    if log:  # spans of many magnitudes: by exponents, on either side of zero
        side = lambda x, a, b: (F.ln(x) - F.ln(a)) / F.nullif(F.ln(b) - F.ln(a), F.lit(0.0))
        even = F.when(lo > 0, side(v, lo, hi)).when(hi < 0, 1 - side(-v, -hi, -lo)).otherwise(even)
    inner = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor(F.coalesce(even, F.lit(0.0)) * BINS)))
    return F.when(F.isnan(v), BINS + 1).when(v == float("inf"), BINS).when(v == float("-inf"), -1).otherwise(inner).cast("int")


def _reached(parts: DataFrame, groups: list[str], order: str) -> DataFrame:
    """The parts (groups, mass, before, targets) in which targets fall, with those targets and the mass before the part."""
    run = F.sum("mass").over(Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("_end", F.col("before") + run).withColumn("before", F.col("_end") - F.col("mass"))
    start, end = F.col("before").cast("double"), F.col("_end").cast("double")
    return parts.withColumn("targets", F.filter("targets", lambda t: (start < t) & (t <= end))).where(F.size("targets") > 0).drop("_end")


def reached(rows: DataFrame, groups: list[str], wanted: DataFrame) -> DataFrame:
    """(groups, target, v): the first value of rows (groups, v, mass) at which the running mass reaches each target.

    wanted: (groups, targets), arrays of doubles above zero and at most the group's mass. Masses are whole numbers or
    decimals, so that sums don't depend on the order of rows.
    """
    spans = rows.groupBy(*groups).agg(*_spans()).where("size > 0")
    zero = F.lit(0).cast(rows.schema["mass"].dataType)
    state = _met(spans, wanted, groups, False).withColumn("before", zero)
    done, log, few = None, False, True
    while not (left := state.where(f"size > {LIMIT} AND lo < hi")).isEmpty():
        state, few = checkpointed(state), state.count() <= FEW
        left = state.where(f"size > {LIMIT} AND lo < hi")
        closed = state.where(f"NOT (size > {LIMIT} AND lo < hi)")
        done = closed if done is None else done.unionByName(closed)
        binned = _inside(rows, left, groups, few).withColumn("bin", _bin(log)).withColumn("from", F.col("span.lo"))
        counted = binned.groupBy(*groups, "from", "bin").agg(F.sum("mass").cast(rows.schema["mass"].dataType).alias("mass"), *_spans())
        held = left.select(*groups, F.col("lo").alias("from"), "before", "targets")
        state = _reached(_met(counted, held, [*groups, "from"], few), [*groups, "from"], "bin").drop("from", "bin", "mass")
        log = not log
    if done is None:
        values = rows.groupBy(*groups, "v").agg(F.sum("mass").cast(rows.schema["mass"].dataType).alias("mass"))
        found = _reached(_met(values, state.select(*groups, "before", "targets"), groups, False), groups, "v")
    else:
        state = checkpointed(done.unionByName(state))
        few = state.count() <= FEW
        values = _inside(rows, state.where("lo < hi"), groups, few).withColumn("from", F.col("span.lo"))
        values = values.groupBy(*groups, "from", "v").agg(F.sum("mass").cast(rows.schema["mass"].dataType).alias("mass"))
        held = state.select(*groups, F.col("lo").alias("from"), "before", "targets")
        found = _reached(_met(values, held, [*groups, "from"], few), [*groups, "from"], "v")
        found = found.select(*groups, "v", "targets").unionByName(state.where("NOT lo < hi").select(*groups, F.col("lo").alias("v"), "targets"))
    return found.select(*groups, F.explode("targets").alias("target"), "v")


def _inside(rows: DataFrame, state: DataFrame, groups: list[str], few: bool) -> DataFrame:
    """Rows within one of their group's spans, with it. A group has no more spans than targets, and they don't overlap."""
    every = state.groupBy(*groups).agg(F.collect_list(F.struct("lo", "hi", "least", "most")).alias("spans"))
    span = F.get(F.filter("spans", lambda s: (F.col("v") >= s["lo"]) & (F.col("v") <= s["hi"])), F.lit(0))
    return _met(rows, every, groups, few).withColumn("span", span).drop("spans").where("span IS NOT NULL")


def _grouped(df: DataFrame, by: list[str], value: str, mass: Column) -> tuple[DataFrame, list[str], dict[str, str]]:
    names = {f"g{k}": c for k, c in enumerate(by)}
    rows = df.select(*(F.col(c).alias(g) for g, c in names.items()), F.col(value).cast("double").alias("v"), mass.alias("mass"))
    return rows.where("v IS NOT NULL AND mass > 0"), list(names), names


def quantiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float], method: str = "linear") -> DataFrame:
    """(by, n, shares' names): exact quantiles of each group's values that aren't null, n of them.

    method: ``linear`` between the two values around the place (n - 1) share, ``lower`` or ``higher`` for either of them. A
    group without a value has n 0 and nulls; null keys are a group. NaN counts as the largest value.
    """
    rows, groups, names = _grouped(df, by, value, F.lit(1).cast("bigint"))
    sizes = df.groupBy(*(F.col(c).alias(g) for g, c in names.items())).agg(F.count(value).alias("n"))
    place = {name: share * (F.col("n") - 1) for name, share in shares.items()}
    ends = {name: (F.floor(p) if method != "higher" else F.ceil(p), F.ceil(p) if method != "lower" else F.floor(p)) for name, p in place.items()}
    targets = F.array_distinct(F.array(*((e + 1).cast("double") for pair in ends.values() for e in pair)))
    found = reached(rows, groups, sizes.where("n > 0").select(*groups, targets.alias("targets")))
    values = found.groupBy(*groups).agg(F.map_from_entries(F.collect_list(F.struct("target", "v"))).alias("at"))
    values = values.withColumnsRenamed({g: f"_{g}" for g in groups})
    out = sizes.join(values, _same(sizes, values, groups), "left")

    def one(name):
        low, high = (F.col("at")[(e + 1).cast("double")] for e in ends[name])
        part = place[name] - F.floor(place[name])
        return F.when(F.col("n") > 0, F.when(low == high, low).otherwise(low * (1 - part) + high * part)).alias(name)

    return out.select(*(F.col(g).alias(c) for g, c in names.items()), "n", *(one(name) for name in shares))


def weighted_quantile(df: DataFrame, by: list[str], value: str, weight: str, out: str, share: float = 0.5) -> DataFrame:
    """(by, out): each group's first value at which the running weight reaches ``share`` of the whole.

    Weights count to nine digits after the point; rows without a positive one, or without a value, have no part, and
    groups of such rows alone are left out.
    """
    rows, groups, names = _grouped(df, by, value, F.col(weight).cast("decimal(38,9)"))
    wanted = rows.groupBy(*groups).agg(F.sum("mass").alias("t")).select(*groups, F.array(F.col("t").cast("double") * share).alias("targets"))
    return reached(rows, groups, wanted.where("targets[0] > 0")).select(*(F.col(g).alias(c) for g, c in names.items()), F.col("v").alias(out))
