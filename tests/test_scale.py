"""Operators that spread a hot or constant key: equal to the plain form, and no task gets more than its part."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanac.operators import asof, fits, holdings, peers, regimes, rolling, selection, slices

DAY = dt.date(2000, 1, 1)


def dated(spark, seed, n, keys):
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.03 else DAY + dt.timedelta(rng.randrange(60))
    left = [(rng.choice(keys), day(), k) for k in range(n)]
    right = [(rng.choice(keys), day(), None if rng.random() < 0.2 else float(k), k) for k in range(n // 3)]
    return spark.createDataFrame(left, "k string, t date, id int"), spark.createDataFrame(right, "k string, t date, v double, tie int")


@pytest.mark.parametrize("forward", [False, True])
def test_sliced_asof_equals_the_plain_one(spark, forward):
    for seed, keys in ((1, ["a"]), (2, ["a"] * 8 + ["b", "c", None]), (3, list("abcdefghij"))):
        left, right = dated(spark, seed, 400, keys)
        for on in ([], ["k"]):
            values = ["v", "tie"] if on else ["v", "tie"]
            plain = asof.asof_join(left, right, on, "t", "t", values, ["tie"], forward)
            for n in (1, 7, 256):
                sliced = asof.asof_join(left, right, on, "t", "t", values, ["tie"], forward, slices=n)
                assert Counter(map(tuple, sliced.collect())) == Counter(map(tuple, plain.collect()))
    none = right.limit(0)
    assert asof.asof_join(left, none, ["k"], "t", "t", ["v"], slices=9).where("v IS NULL").count() == 400
    assert asof.asof_join(left.limit(0), none, ["k"], "t", "t", ["v"], slices=9).count() == 0


def test_sliced_fill_equals_the_plain_one(spark):
    for seed, keys in ((4, ["a"]), (5, ["a"] * 8 + ["b", None])):
        left, right = dated(spark, seed, 300, keys)
        spine, series = left.select("k", "t").distinct(), right.select("k", "t", "v", (F.col("v") + 1).alias("u"))
        for by in ([], ["k"]):
            s, x = (spine, series) if by else (spine.select("t").distinct(), series.drop("k"))
            plain = asof.fill_onto_spine(s, x, "t", ["v", "u"], by, slices=0).collect()
            assert plain and Counter(map(tuple, asof.fill_onto_spine(s, x, "t", ["v", "u"], by, slices=16).collect())) == Counter(map(tuple, plain))


def test_a_constant_key_is_dealt_evenly(spark):
    """A million rows of one key: no slice has three times the rows of the median one, and the fill is right at every row."""
    n = 1_000_000
    left = spark.range(n).select((F.col("id") * 7919 % n).alias("t"), F.lit(1).alias("k"))
    right = spark.range(0, n, 10).select(F.col("id").alias("t"), F.lit(1).alias("k"), F.col("id").alias("v"))
    sizes = [r["count"] for r in slices.with_slices(left, "t", 64).groupBy("_slice").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 3 * statistics.median(sizes)
    found = asof.asof_join(left, right, ["k"], "t", "t", ["v"], slices=64)
    assert found.where("v = t - t % 10").count() == n


def plain_quantile(values, share, method):
    s, at = sorted(values, key=lambda v: (v != v, v)), share * (len(values) - 1)
    low, high = s[math.floor(at)], s[math.ceil(at)]
    return low if method == "lower" else high if method == "higher" else low if low == high or low != low else low * (1 - (at - math.floor(at))) + high * (at - math.floor(at))


@pytest.mark.parametrize("limit", [2, 50, 100_000])
def test_exact_quantiles_by_refinement(spark, monkeypatch, limit):
    monkeypatch.setattr(selection, "LIMIT", limit)
    monkeypatch.setattr(selection, "BINS", 8)
    rng = random.Random(limit)
    groups = {
        "even": [rng.uniform(-5, 9) for _ in range(300)], "ties": [float(rng.randrange(4)) for _ in range(300)], "wide": [math.ldexp(rng.random(), rng.randrange(-900, 900)) for _ in range(300)],
        "below": [-math.ldexp(1 + rng.random(), rng.randrange(0, 700)) for _ in range(200)], "ends": [-1.7e308, 1.7e308, *[rng.gauss(0, 1) for _ in range(80)]], "odd": [float("inf"), float("-inf"), float("nan"), float("nan"), *map(float, range(60))],
        "one": [3.5], "same": [2.5] * 120, None: [0.1 * k for k in range(77)],
    }
    rows = [(g, v, rng.randrange(1, 9)) for g, own in groups.items() for v in own] + [("even", None, 3), ("none", None, 2)]
    df = spark.createDataFrame(rows, "g string, v double, w int").repartition(5)
    shares = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}
    for method in ("linear", "lower", "higher"):
        for r in selection.quantiles(df, ["g"], "v", shares, method).collect():
            own = groups.get(r.g, [])
            assert r.n == len(own)
            for name, share in shares.items():
                want = plain_quantile(own, share, method) if own else None
                assert r[name] == want or (want != want and r[name] != r[name]) or r[name] == pytest.approx(want, rel=1e-12), (r.g, name, method)
    whole = selection.quantiles(df.where("g = 'even'"), [], "v", {"m": 0.5}).first()
    assert whole.m == pytest.approx(plain_quantile(groups["even"], 0.5, "linear"))
    for r in selection.weighted_quantile(df.where("g <> 'odd' OR g IS NULL"), ["g"], "v", "w", "m").collect():
        own, run = sorted((v, w) for g, v, w in rows if g == r.g and v is not None), 0
        for v, w in own:
            run += w
            if 2 * run >= sum(x[1] for x in own):
                break
        assert r.m == v, r.g
    assert selection.quantiles(df.limit(0), ["g"], "v", shares).collect() == [] and selection.weighted_quantile(df.limit(0), ["g"], "v", "w", "m").collect() == []


def test_one_group_of_millions_is_selected_from_by_all_tasks(spark):
    n = 10_000_000
    df = spark.range(0, n, 1, 16).select(F.lit("all").alias("g"), ((F.col("id") * 7919 + 13) % n).cast("double").alias("v"))
    r = selection.quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.999}).first()
    assert (r.n, r.a, r.b, r.c) == (n, 0.25 * (n - 1), 0.5 * (n - 1), pytest.approx(0.999 * (n - 1), rel=1e-15))


def plain_bands(values, window, shares):
    out = []
    for k, x in enumerate(values):
        before = sorted(v for v in values[max(0, k - window) : k] if v is not None)
        out.append((len(before), *(before[int(q * (len(before) - 1))] if before else None for q in shares), sum(v <= x for v in before) if x is not None else 0))
    return out


def plain_spread(values, window):
    out = []
    for k in range(len(values)):
        seen = {v for v in values[max(0, k - window + 1) : k + 1] if v is not None}
        m = statistics.median(seen) if seen else None
        out.append((len(seen), m, statistics.median(abs(v - m) for v in seen) if seen else None))
    return out


@pytest.mark.parametrize("whole", [30, 100_000])
def test_rolling_order_statistics(spark, monkeypatch, whole):
    """Entities in one piece and in slices that are shorter than the window, with ties and nulls."""
    monkeypatch.setattr(rolling, "WHOLE", whole)
    monkeypatch.setattr(rolling, "SLICE_ROWS", 10)
    rng, rows = random.Random(9), []
    for key, n in (("a", 900), ("b", 90), (None, 400), ("c", 1)):
        rows += [(key, DAY + dt.timedelta(k), None if rng.random() < 0.1 else rng.choice([rng.gauss(0, 1), float(rng.randrange(4))]), "clash") for k in range(n)]
    df = spark.createDataFrame(rows, "key string, d date, x double, _n string").repartition(6)
    own = {k: [r[2] for r in rows if r[0] == k] for k in ("a", "b", None, "c")}
    for window in (1, 2, 25):
        got = rolling.rolled(df, ["key"], "d", "x", window, rolling.bands((0.2, 0.75)), "n bigint, low double, high double, below bigint")
        assert got.columns == [*df.columns, "n", "low", "high", "below"]
        found = {(r.key, r.d): (r.n, r.low, r.high, r.below) for r in got.collect()}
        assert len(found) == len(rows)
        for key, values in own.items():
            assert [found[key, DAY + dt.timedelta(k)] for k in range(len(values))] == plain_bands(values, window, (0.2, 0.75))
        found = {(r.key, r.d): (r.n, r.m, r.s) for r in rolling.rolled(df, ["key"], "d", "x", window, rolling.distinct_spread, "n bigint, m double, s double").collect()}
        for key, values in own.items():
            for k, want in enumerate(plain_spread(values, window)):
                assert found[key, DAY + dt.timedelta(k)] == pytest.approx(want, abs=1e-12)
    assert rolling.rolled(df.limit(0), ["key"], "d", "x", 5, rolling.distinct_spread, "n bigint, m double, s double").collect() == []


def test_rolling_work_does_not_follow_the_window():
    """Ten times the window takes far less than ten times as long."""
    values, seconds = np.random.default_rng(1).normal(size=40_000), []
    for window in (1_000, 10_000):
        began = time.process_time()
        rolling.bands((0.2, 0.25))(values, window, 0)
        seconds.append(time.process_time() - began)
    assert seconds[1] < 2.5 * seconds[0]


def test_band_regime_of_a_hot_entity(spark, monkeypatch):
    rng = random.Random(4)
    rows = [("hot" if k % 10 else "b", DAY + dt.timedelta(k // 10 * 10 + (k % 10)), rng.gauss(0, 1) if rng.random() < 0.97 else None) for k in range(3000)]
    df = spark.createDataFrame(rows, "k string, d date, x double")
    plain = regimes.band_regime(df, ["k"], "d", "x", 40, 20, 0.2, 0.3).collect()
    monkeypatch.setattr(rolling, "WHOLE", 100)
    monkeypatch.setattr(rolling, "SLICE_ROWS", 50)
    assert Counter(plain) == Counter(regimes.band_regime(df, ["k"], "d", "x", 40, 20, 0.2, 0.3).collect())


def plain_leaves(rows, child_of, depth):
    """The walk as a recursion: (root, level, item) to (paths, pct, gross)."""
    out, held = {}, {}
    for fund, item, pct in rows:
        held.setdefault(fund, []).append((item, pct))

    def walk(root, fund, ancestors, weight, level):
        for item, pct in held[fund]:
            child = child_of.get(item)
            if child in held and child not in ancestors and (depth is None or level < depth):
                walk(root, child, ancestors | {fund}, weight * pct / 100, level + 1)
            else:
                n, a, b = out.get((root, level, item), (0, 0.0, 0.0))
                out[root, level, item] = n + 1, a + pct * weight, b + abs(pct * weight)

    for fund in held:
        walk(fund, fund, {fund}, 1.0, 0)
    return out


@pytest.mark.parametrize("depth", [0, 1, 2, 4, None])
def test_look_through_of_any_depth(spark, depth):
    """Chains, cycles, self-holders, two ways to one fund, short positions, one fund held twice by another."""
    rng, funds = random.Random(8), [f"f{k}" for k in range(7)]
    rows = [(f, f"stock{k}", rng.uniform(-10, 40)) for f in funds for k in rng.sample(range(6), 3)]
    rows += [(f, f"i{g}", rng.uniform(-20, 30)) for f in funds for g in rng.sample(funds, 3)] + [("f0", "other-f1", 5.0), ("f2", "i-unknown", 1.0), ("f3", "stock1", None)]
    child_of = {f"i{f}": f for f in funds} | {"other-f1": "f1", "i-unknown": "nobody"}
    want = plain_leaves([r for r in rows if r[2] is not None], child_of, depth)
    held = spark.createDataFrame([(f, DAY, i, "EQ", p) for f, i, p in rows], "series_id string, report_date date, cusip string, asset_class string, pct double")
    leaves = holdings.look_through(held, spark.createDataFrame(list(child_of.items()), "cusip string, child string"), depth)
    got = {(r.root, r.level, r.cusip): (r.n, r.pct, r.gross) for r in leaves.groupBy("root", "level", "cusip").agg(F.sum("paths").alias("n"), F.sum("pct").alias("pct"), F.sum("gross").alias("gross")).collect()}
    assert set(got) == set(want) and all(got[k][0] == want[k][0] and got[k][1:] == pytest.approx(want[k][1:], abs=1e-9) for k in want)
    assert holdings.look_through(held.limit(0), held.select("cusip", F.col("series_id").alias("child")).limit(0), depth).collect() == []


def test_rank_shares_of_many_columns(spark):
    rng = random.Random(6)
    cell = lambda: None if rng.random() < 0.1 else rng.choice([rng.gauss(0, 1), 0.0, float(rng.randrange(3))])
    rows = [(f"e{k}", DAY + dt.timedelta(31 * (k % 3)), cell(), cell(), cell(), float(k)) for k in range(400)]
    df = spark.createDataFrame(rows, "e string, m date, a double, b double, c double, r double")
    want = df
    for c in "abc":
        want = peers.average_rank_share(want, ["m"], c, f"_{c}").drop(c).withColumnRenamed(f"_{c}", c)
    plain = {r.e: (r.m, r.a, r.b, r.c, r.r) for r in want.collect()}
    for buckets in (2, 256):
        got = peers.rank_shares(df, ["m"], ["a", "b", "c"], buckets)
        assert got.columns == df.columns and {r.e: (r.m, r.a, r.b, r.c, r.r) for r in got.collect()} == plain
    shuffles = lambda cols: peers.rank_shares(df, ["m"], cols)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles(["a"]) == shuffles(["a", "b", "c"])


def test_one_month_of_very_many_entities(spark):
    """Half of a million entities share one value, the others differ: the ranks are right and no window holds more than its part."""
    n = 1_000_000
    value = F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.col("id").cast("double"))
    df = spark.range(n).select("id", F.lit(DAY).alias("m"), value.alias("x"))
    r = peers.rank_shares(df, ["m"], ["x"]).agg(F.sum("x").alias("s"), F.min("x").alias("low"), F.max("x").alias("high"), F.count_if(F.col("x") == (n / 2 + 1) / 2 / n - 0.5).alias("ties")).first()
    assert (r.high, r.ties) == (0.5, n // 2) and r.low == (n / 2 + 1) / 2 / n - 0.5 and r.s == pytest.approx(0.5, abs=1e-6)


def garch_returns(rng, n, alpha=0.1, beta=0.85):
    h, out = 1.0, []
    for _ in range(n):
        out.append(math.sqrt(h) * rng.standard_normal() / 100)
        h = 0.05 + alpha * (out[-1] * 100) ** 2 + beta * h
    return np.array(out)


def test_many_fits_at_once_are_those_of_one(spark):
    rng = np.random.default_rng(3)
    own = [garch_returns(rng, n) for n in (100, 150, 400, 1200)] + [rng.standard_t(4, n) / 100 for n in (99, 300, 1500)]
    own += [np.zeros(200), np.full(150, np.nan), rng.normal(size=5) / 100, rng.normal(size=300), np.append(rng.normal(size=150) / 100, [np.inf, np.nan]), np.array([])]
    for one, many in ((fits.garch, fits.garch_many), (fits.tail, fits.tail_many)):
        for r, got in zip(own, many(own), strict=True):
            want = one(r)
            for a, b in zip(want, got, strict=True):
                assert a == b if a is None or isinstance(a, str) else b == pytest.approx(a, rel=1e-4, abs=1e-6), (one, len(r))
    assert fits.garch_many([]) == [] and fits.tail_many([]) == []
    rows = [(f"e{k}", DAY + dt.timedelta(t), float(x) if np.isfinite(x) else None) for k, r in enumerate(own) for t, x in enumerate(r)]
    df = spark.createDataFrame(rows, "e string, d date, r double").repartition(3)
    got = {r.e: r for r in fits.entity_fits(df, "e", "d", "r").collect()}
    assert len(got) == sum(len(r) > 0 for r in own)
    assert got["e2"].vol == pytest.approx(fits.garch(own[2])[0], rel=1e-4) and got["e6"].cvar_99 == pytest.approx(fits.tail(own[6])[1], rel=1e-4)
