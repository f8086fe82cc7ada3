"""State machines, repairs and fits against plain loops, and the rules that the test tables don't reach."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from almanac.functions import metrics as M
from almanac.operators import asof, factors, fits, fundamentals, holdings, peers, pit, quality, regimes, regress, replays, returns
from almanac.sources import payloads
from almanac.streaming import ticks

DAY = dt.date(2000, 1, 1)


def series(spark, n_keys=40, length=60, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n_keys):
        x = 0.0
        for t in range(length):
            x = 0.7 * x + rng.gauss(0, 0.6)
            rows.append((k, DAY + dt.timedelta(t), None if rng.random() < 0.05 else round(x, 4), rng.random() < 0.7, rng.random() < 0.5))
    return rows, spark.createDataFrame(rows, "k int, d date, x double, sure boolean, raw boolean")


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def test_latched_sign(spark):
    rows, df = series(spark)
    got = {(r.k, r.d): (r.internal, r.effective) for r in regimes.latched_sign(df, ["k"], "d", "x", 0.75, 0.25, "sure").collect()}
    plain = {(r.k, r.d): (r.internal, r.effective) for r in regimes.latched_sign(df, ["k"], "d", "x", 0.75, 0.25).collect()}
    for k, own in by_key(rows).items():
        for sure_needed, found in ((True, got), (False, plain)):
            state = None
            for _, d, x, sure, _ in own:
                effective, ok = None, sure or not sure_needed
                if x is not None:
                    if state is None:
                        if abs(x) >= 0.75 and ok:
                            state = effective = int(math.copysign(1, x))
                    elif state * x <= -0.75:
                        state = -state
                        effective = state if ok else None
                    elif state * x >= 0.25:
                        effective = state if ok else None
                assert found[k, d] == (state, effective)


def test_debounce(spark):
    rows, df = series(spark)
    got = {(r.k, r.d): (r.state, r.flip, r.dwell) for r in regimes.debounce(df, ["k"], "d", "raw", 3).collect()}
    for k, own in by_key(rows).items():
        state = before = False
        on = off = dwell = 0
        for t, (_, d, _, _, raw) in enumerate(own):
            on, off = (on + 1, 0) if raw else (0, off + 1)
            state = True if not state and on >= 3 else False if state and off >= 3 else state
            flip = state != before
            dwell = 1 if flip or t == 0 else dwell + 1
            assert got[k, d] == (state, flip, dwell)
            before = state


def test_band_regime(spark):
    rows, df = series(spark, 10)
    df = df.where("x IS NOT NULL")
    got = {(r.k, r.d): (r.state, r.p_entry) for r in regimes.band_regime(df, ["k"], "d", "x", 20, 8, 0.2, 0.4).collect()}
    for k, own in by_key([r for r in rows if r[2] is not None]).items():
        state, xs = "on", [r[2] for r in own]
        for t, (_, d, x, *_) in enumerate(own):
            w = sorted(xs[max(0, t - 20) : t])
            entry, leave = (w[int(q * (len(w) - 1))] if len(w) >= 8 else None for q in (0.2, 0.4))
            if state == "off":
                state = "on" if leave is None or x >= leave else "off"
            else:
                state = "off" if entry is not None and x < entry else "on"
            assert got[k, d] == (state, entry)
    with pytest.raises(ValueError):
        regimes.band_regime(df, ["k"], "d", "x", 20, 8, 0.5, 0.4)


def test_smoothing_and_uncertainty(spark):
    rows, df = series(spark, 8)
    df = df.where("x IS NOT NULL").withColumn("g", F.floor("x"))
    got = {(r.k, r.d): r.ema for r in regimes.smoothed(df, ["k"], "d", "x", "g").collect()}
    u = {(r.k, r.d): r.u for r in df.withColumn("u", regimes.uncertainty("x", Window.partitionBy("k").orderBy("d"), 12, 6, 0.1)).collect()}
    for k, own in by_key([r for r in rows if r[2] is not None]).items():
        ema = group = None
        for t, (_, d, x, *_) in enumerate(own):
            if math.floor(x) != group or ema is None:
                ema, group = x if ema is None else 0.5**0.5 * ema + (1 - 0.5**0.5) * x, math.floor(x)
            assert got[k, d] == pytest.approx(ema)
            seen = sorted({r[2] for r in own[max(0, t - 11) : t + 1]})
            m = statistics.median(seen)
            want = max(1.4826 * statistics.median([abs(v - m) for v in seen]), 0.1) if len(seen) >= 6 else None
            assert u[k, d] == (None if want is None else pytest.approx(want))


def test_nearest_and_monotonic(spark):
    a = spark.createDataFrame([(1, DAY + dt.timedelta(n)) for n in (0, 10, 30)], "k int, d date")
    b = spark.createDataFrame([(1, DAY + dt.timedelta(n)) for n in (4, 16, 31)], "k int, d date")
    assert sorted(r.lag for r in regimes.nearest_lags(a, b, ["k"], "d").collect()) == [-6, 1, 4]
    found = regimes.monotonic_matches(a, b, "k", "d", 126).collect()
    assert len(found) == 3 and all(x.a_date < y.a_date and x.b_date < y.b_date for x, y in zip(found, found[1:], strict=False))


def test_repair(spark):
    levels = [10.0, 10.1, 0.05, 10.2, 10.3, 0.04, 0.04, 10.4, None, 10.5]
    df = spark.createDataFrame([("a", DAY + dt.timedelta(t), v) for t, v in enumerate(levels)] + [("dead", DAY + dt.timedelta(t), 100.0 if t < 2 else 0.5) for t in range(8)], "k string, d date, x double")
    got = {(r.k, r.d): (r.x, r.repaired) for r in quality.repaired(df, "k", "d", "x").collect()}
    assert got["a", DAY + dt.timedelta(2)] == (pytest.approx(math.sqrt(10.1 * 10.2)), True)
    assert got["a", DAY + dt.timedelta(5)][1] and got["a", DAY + dt.timedelta(8)] == (None, False)
    assert not any(v[1] for k, v in got.items() if k[0] == "dead")


def test_rejected_moves_do_not_count(spark):
    levels = [100, 101, 165, 166, 167]
    df = spark.createDataFrame([("a", DAY + dt.timedelta(t), float(v)) for t, v in enumerate(levels)], "instrument_id string, nav_date date, nav double")
    r = returns.simple_returns(df).orderBy("rn").collect()
    assert [x.rn for x in r] == [1, 2, 3] and r[-1].r == pytest.approx(0.01)


def test_asof_keeps_the_row_not_the_value(spark):
    left = spark.createDataFrame([(1, DAY + dt.timedelta(5))], "k int, t date")
    right = spark.createDataFrame([(1, DAY, 7.0), (1, DAY + dt.timedelta(4), None), (1, DAY + dt.timedelta(6), 9.0)], "k int, t date, v double")
    assert asof.asof_join(left, right, ["k"], "t", "t", ["v"]).first().v is None
    assert asof.asof_join(left, right, ["k"], "t", "t", ["v"], forward=True).first().v == 9.0


def test_peers(spark):
    rng = random.Random(3)
    rows = [(n, "g" if n < 25 else "small", rng.choice([None, 1.0, 2.0, 3.0, 4.0])) for n in range(30)]
    got = {r.i: r.p for r in peers.midrank_percentile(spark.createDataFrame(rows, "i int, g string, v double"), "g", "v", "p").collect()}
    for i, g, v in rows:
        others = [x for j, h, x in rows if h == g and j != i and x is not None]
        want = 50.0 if g == "small" else None if v is None else round(100 * (sum(x < v for x in others) + 0.5 * sum(x == v for x in others)) / len(others), 2)
        assert got[i] == (None if want is None else pytest.approx(want, abs=0.011))
    quartiles = spark.createDataFrame([(80.0, 20), (None, 20), (80.0, 5)], "p double, n int").select(peers.quartile(F.col("p"), F.col("n")).alias("q")).collect()
    assert [r.q for r in quartiles] == [1, 4, 2]


def test_point_in_time(spark):
    ts = lambda n: dt.datetime(2000, 1, 1) + dt.timedelta(n)
    rows = [("s", DAY, ts(a), float(v), r) for a, v, r in ((1, 10, 0), (5, 11, 1), (5, 12, 2), (9, 13, 3))]
    v = spark.createDataFrame(rows, "series_id string, observation_period date, available_at timestamp, value double, revision_number int")
    cal = spark.createDataFrame([(DAY + dt.timedelta(n),) for n in (0, 1, 4, 5, 8, 20)], "cut date")
    assert [r.value for r in pit.panel(v, cal, "cut").orderBy("cut").collect()] == [10, 10, 12, 12, 13]
    assert {r.value for r in pit.panel(v, cal, "cut", "first_release").collect()} == {10}
    assert pit.as_of(v, "2000-01-06").first().value == 12


def test_look_through_self_holder(spark):
    rows = [("root", "c", 50.0), ("root", "x", 50.0), ("c", "c", 40.0), ("c", "y", 60.0)]
    h = spark.createDataFrame([(s, DAY, c, "EQ", p) for s, c, p in rows], "series_id string, report_date date, cusip string, asset_class string, pct double")
    edges = spark.createDataFrame([("c", "c")], "cusip string, child string")
    leaves = holdings.look_through(h, edges).where("root = 'root'").collect()
    # The child isn't among its own ancestors when first walked, so it expands once more and stops at the depth.
    assert sorted((r.level, r.cusip, round(r.pct, 6)) for r in leaves) == [(0, "x", 50.0), (1, "y", 30.0), (2, "c", 8.0), (2, "y", 12.0)]
    assert sum(r.pct for r in leaves) == pytest.approx(100)


def test_factor_sums_give_the_fit(spark):
    rng = np.random.default_rng(0)
    z = rng.uniform(-0.5, 0.5, (60, 50, 4))
    gamma, f = np.linalg.qr(rng.normal(size=(4, 2)))[0], rng.normal(0.5, 1, (60, 2))
    r = np.einsum("tnl,lk,tk->tn", z, gamma, f) + rng.normal(0, 0.01, (60, 50))
    df = spark.createDataFrame([(t, *map(float, z[t, n]), float(r[t, n])) for t in range(60) for n in range(50)], "t int, a double, b double, c double, d double, r double")
    grams = factors.Grams.of(factors.month_sums(df, "t", ["a", "b", "c", "d"], "r"), "t", 4)
    assert np.allclose(grams.g[3], z[3].T @ z[3])
    loading, found = factors.fit(grams, 2)
    assert factors.drift(loading, gamma) < 0.02 and grams.r2(loading, found) > 0.99
    assert factors.choose(grams, 3)[0] in (1, 2)


def test_multi_factor(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(100, 2))
    y = 0.5 + x @ [1.0, -2.0] + rng.normal(0, 0.1, 100)
    df = spark.createDataFrame([("k", *map(float, row), float(v)) for row, v in zip(x, y, strict=True)], "k string, a double, b double, y double")
    got = {r.factor: r.beta for r in regress.multi_factor(df, "y", ["a", "b"], "k").collect()}
    want = np.linalg.lstsq(np.c_[np.ones(100), x], y, rcond=None)[0]
    assert [got["const"], got["a"], got["b"]] == pytest.approx(list(want))


def test_fits():
    rng = np.random.default_rng(5)
    h, r = 1.0, []
    for _ in range(1500):
        r.append(math.sqrt(h) * rng.normal() / 100)
        h = 0.05 + 0.1 * (r[-1] * 100) ** 2 + 0.85 * h
    vol, model = fits.garch(np.array(r))
    assert model == "garch" and vol == pytest.approx(math.sqrt(h) / 100 * 252**0.5, rel=0.25)
    shape, es99, es999 = fits.tail(rng.standard_t(4, 20000) * 0.01)
    assert 0.05 < shape < 0.5 and es999 < es99 < 0
    assert fits.garch(np.zeros(10)) == (None, None)


def test_normal_cdf(spark):
    rows = spark.createDataFrame([(z / 10,) for z in range(0, 50)], "z double").select("z", M.normal_cdf(F.col("z")).alias("p")).collect()
    assert all(r.p == pytest.approx(statistics.NormalDist().cdf(r.z), abs=1e-7) for r in rows)


def test_violations_and_hash(spark):
    spec = quality.TableSpec(("k",), numbers=("x",), dates=("d",), as_of="d")
    df = spark.createDataFrame([("a", "1,000.5", "2000-01-01"), ("a", "oops", "2000-13-01"), (None, None, "2031-01-01")], "k string, x string, d string")
    assert sorted(r.problem for r in quality.violations(df, spec, "2030-01-01").collect()) == ["after_as_of", "bad_value:d", "bad_value:x", "duplicate_key", "null_key:k"]
    with pytest.raises(ValueError):
        quality.violations(df.drop("k"), spec, "2030-01-01")
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert quality.table_hash(nan).first() == quality.table_hash(spark.createDataFrame([(1.0,), (None,)], "x double")).first()


def test_late_tick_is_left_out(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    batches = [[("A", at(1), 1.0), ("A", at(1, 30), 3.0)], [("A", at(9), 5.0)], [("A", at(1, 10), 99.0), ("A", at(12), 7.0)], [("A", at(16), 1.0)]]
    src = tmp_path / "src"
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "symbol string, ts timestamp, price double").coalesce(1).write.mode("append").parquet(str(src))
        q = ticks.bars(spark.readStream.schema("symbol string, ts timestamp, price double").parquet(str(src))).writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = {r.start.hour: (r.open, r.high, r.close, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[1] == (1.0, 3.0, 3.0, 2) and got[9] == (5.0, 5.0, 5.0, 1)


def test_tick_frames(spark):
    """The price stands tenth and the size eleventh; a slim frame has no size."""
    frames = [
        '{"messageType":"A","data":["2024-01-01T00:00:00.123456789Z","abc",1.5]}', '{"messageType":"H","data":[]}', '{"messageType":"A","data":["Q","2024-01-01T00:00:00Z","0","abc"]}', "junk",
        '{"messageType":"A","data":["T","2024-01-01T00:00:00.999999999-05:00",1,"abc",2,3,4,5,6,123.5,700,0,0]}', '{"messageType":"A","data":["T","2024-01-01T00:00:00Z",1,"abc",2,3,4,5,6,124.5,null]}',
        '{"messageType":"A","data":["Q","2024-01-01T00:00:00Z",1,"abc",2,3,4,5,6,7,8]}', '{"messageType":"A","data":["2024-01-01T00:00:00Z","abc",null]}', '{"messageType":"A","data":["2024-01-01 00:00:00","abc",200.5]}',
    ]
    got = ticks.parsed(spark.createDataFrame([(f,) for f in frames], "value string")).orderBy("price").collect()
    assert [(r.symbol, r.price, r.size) for r in got] == [("ABC", 1.5, 0), ("ABC", 123.5, 700), ("ABC", 124.5, 0), ("ABC", 200.5, 0)]
    at = lambda h: dt.datetime(2024, 1, 1, h)
    assert [r.ts for r in got[:3]] == [at(0), at(5), at(0)] and got[3].ts > dt.datetime(2025, 1, 1)


def test_observations_are_finite(spark):
    payload = '{"observations":[{"date":"2024-01-01","value":"NaN"},{"date":"2024-01-02","value":"Infinity"},{"date":"2024-01-03","value":"."},{"date":"2024-01-04","value":" 1.5 "},{"date":"2024-01-05","value":null}]}'
    got = payloads.observations(spark.createDataFrame([("a", payload)], "k string, p string"), "p", "k").collect()
    assert [(r.obs_date.day, r.value) for r in got] == [(4, 1.5)]


def test_smoothing_starts_anew_after_a_missing_score(spark):
    rng = np.random.default_rng(3)
    scores = [1.0, None, 5.0, *[None if rng.random() < 0.02 else float(x) for x in rng.normal(size=600)]]
    rows = [("a", dt.date(2020, 1, 1) + dt.timedelta(k), x, k) for k, x in enumerate(scores)]
    got = [r.ema for r in regimes.smoothed(spark.createDataFrame(rows, "k string, d date, x double, g int"), ["k"], "d", "x", "g").orderBy("d").collect()]
    want, before = [], None
    for x in scores:
        before = x if x is None or before is None else (1 - 0.5**0.5) * x + 0.5**0.5 * before
        want.append(before)
    assert got[:3] == [1.0, None, 5.0]
    assert all(a == b or abs(a - b) < 1e-12 for a, b in zip(got, want, strict=True))


def test_variance_path_and_tail_against_plain_loops():
    rng = np.random.default_rng(4)
    for n in (1, 63, 64, 65, 1000):
        x2, h = rng.random(n), [0.7]
        for v in x2:
            h.append(0.1 + 0.2 * v + 0.75 * h[-1])
        assert np.allclose(fits.variance_path(x2, 0.7, 0.1, 0.2, 0.75), h, rtol=1e-12)
    r = rng.standard_t(4, 4000) / 100
    shape, c99, c999 = fits.tail(r)
    losses = -r[r < 0]
    worst = lambda p: -losses[losses >= np.quantile(losses, p)].mean()
    assert 0 < shape < 0.6 and c99 == pytest.approx(worst(0.99), rel=0.15) and c999 == pytest.approx(worst(0.999), rel=0.35)
    assert fits.tail(r[:99]) == (None, None, None)


def test_loading_drift_of_the_two_newest_fits(spark):
    rng = np.random.default_rng(5)
    months = [dt.date(2018 + k // 12, k % 12 + 1, 1) for k in range(48)]
    rows = [(u, m, *(float(v) for v in z), float(z @ [1.0, 0.5] * f + rng.normal() * 0.01)) for u in ("x", "y") for m in months for f in [rng.normal()] for z in rng.random((20, 2)) - 0.5]
    df = spark.createDataFrame(rows + [("z", months[0], 0.1, 0.2, 0.3)], "u string, m date, a double, b double, r double")
    history = factors.fit_history(factors.month_sums(df, "m", ["a", "b"], "r", "u"), "u", "m", 2, 1)
    got = {r.u: r for r in factors.newest_drift(history, "u", 0.5).collect()}
    assert set(got) == {"x", "y"}
    for u in got:
        grams = factors.Grams.of(factors.month_sums(df.where(F.col("u") == u), "m", ["a", "b"], "r"), "m", 2)
        want = factors.drift(factors.fit(grams, 1)[0], factors.fit(grams.part(slice(0, 36)), 1)[0])
        assert got[u].fit_date == months[-1] and got[u].drift == pytest.approx(want, abs=1e-9) and not got[u].alert


def test_the_first_batch_of_a_key_stays(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for k, rows in enumerate([[("a", 2.0), ("a", 1.0)], [("a", 0.0), ("b", 5.0)]]):
        spark.createDataFrame(rows, "k string, v double").coalesce(1).write.mode("append").parquet(src)
        for again in range(2):
            ticks.append_new(spark.readStream.schema("k string, v double").parquet(src), out, ["k"], str(tmp_path / f"state{k}{again}")).awaitTermination()
    assert sorted((r.k, r.v) for r in spark.read.parquet(out).collect()) == [("a", 1.0), ("b", 5.0)]


def test_ticks_keep_the_kind_of_their_values(spark):
    """A price is a JSON number, never text; a slim frame's symbol is text; any offset and a blank for the T are read."""
    slim = lambda time, symbol, price: f'{{"messageType":"A","data":[{time},{symbol},{price}]}}'
    wide = lambda symbol, price, size: f'{{"messageType":"A","data":["T","2024-01-01T05:00:00.1Z",1,{symbol},1,2,3,4,5,{price},{size}]}}'
    good = '"2024-01-01T05:00:00Z"'
    kept = {
        slim('"2024-01-01 05:00:00+00:00"', '"a"', 1): 1.0, slim('"2024-01-01 10:30:00.123456789+0530"', '"a"', 2): 2.0, slim('"2024-01-01T03:00:00-02"', '"a"', 3.5): 3.5, slim('"2024-01-01T05:00Z"', '"a"', 4): 4.0,
        slim(good, '"a"', "5e0"): 5.0, slim(good, '"a"', "true"): 1.0, wide('"a"', 6, '"70"'): 6.0, wide('"a"', 7, 70.9): 7.0, wide('"a"', 123456789012345678901234567890, "{}"): 1.2345678901234568e29,
    }
    gone = [slim(good, '"a"', '"1.5"'), slim(good, '"a"', '"NaN"'), slim(good, 5, 1), slim(good, '""', 1), slim(good, '"a"', "[1]"), wide("null", 1, 1), wide('""', 1, 1), wide("0", 1, 1), '{"messageType":"A","data":{"a":1}}', '{"messageType":5}', "[1]", "", None]
    got = ticks.parsed(spark.createDataFrame([(f,) for f in [*kept, *gone]], "value string")).collect()
    assert sorted(r.price for r in got) == sorted(kept.values())
    assert {r.ts for r in got} == {dt.datetime(2024, 1, 1, 5)} and {r.symbol for r in got} == {"A"}
    assert sorted(r["size"] for r in got if r.price in (6.0, 7.0)) == [70, 70]
    assert [r.symbol for r in ticks.parsed(spark.createDataFrame([(wide("55", 1, 1),)], "value string")).collect()] == ["55"]


def test_ratios_are_of_one_period(spark):
    d = lambda m: dt.date(2020, m, 28)
    periods = [(1, d(1), 10.0, 50.0, 100.0, 20.0, 5.0), (1, d(3), None, 60.0, None, 0.0, 7.0), (2, d(2), 5.0, -1.0, 10.0, 10.0, 2000.0), (1, dt.date(2019, 1, 1), 1.0, 1.0, 80.0, 1.0, 1.0)]
    rows = fundamentals.company_rows(spark.createDataFrame(periods, "cik int, period_end date, income double, equity double, assets double, revenue double, gross double"), spark.createDataFrame([(1, d(1), 4.0), (2, d(1), 0.0)], "cik int, period_end date, shares double"))
    prices = spark.createDataFrame([(1, d(2), 3.0), (1, d(4), 2.0), (2, d(4), 1.0), (3, d(4), 1.0), (1, d(3), None)], "cik int, date date, close double")
    got = {(r.cik, r.date): r for r in fundamentals.ratios(prices, rows, "cik", "date", "close").collect()}
    a, b, c, none, e = (got[k] for k in ((1, d(2)), (1, d(4)), (2, d(4)), (3, d(4)), (1, d(3))))
    assert (a.cap, a.pe, a.roe, a.de, a.margin, a.roa, a.investment_growth) == (12.0, 1.2, 0.2, 1.0, 0.25, 0.1, 0.25) and a.period_end == d(1)
    # The newest row lacks income and assets: they aren't taken from the row before.
    assert (b.cap, b.pe, b.roe, b.de, b.margin, b.roa, b.period_end) == (8.0, None, None, None, None, None, d(3))
    assert (c.cap, c.roe, c.margin, c.gross_profitability) == (None, None, 200.0, None) and none.period_end is None and e.cap is None


def test_two_information_sets_row_by_row(spark):
    """Candidate changes, sign changes and valid dates of a grid over two sets, against plain loops."""
    rng, rows = random.Random(11), []
    for enter in (0.3, 0.6):
        for t in range(40):
            for axis in ("growth", "other"):
                for mode in ("latest", "first"):
                    if not (t == 7 and mode == "first"):
                        rows.append((enter, mode, DAY + dt.timedelta(t), axis, round(rng.gauss(0, 0.6), 3), enter / 2))
    df = spark.createDataFrame(rows, "enter double, mode string, d date, axis string, score double, leave double")
    got = {(r.enter, r.d): (r.changed, r.sign_changed, r.valid) for r in replays.two_set_replay(df, ["enter"], "mode", "d", "axis", "growth", "enter", "leave").collect()}
    score = {r[:4]: r[4] for r in rows}
    for enter in (0.3, 0.6):
        state = {}
        for t in range(40):
            d = DAY + dt.timedelta(t)
            for mode in ("latest", "first"):
                for axis in ("growth", "other"):
                    x = score.get((enter, mode, d, axis))
                    if x is not None and abs(x) >= enter:
                        state[mode, axis] = math.copysign(1, x)
            if t == 7:
                assert (enter, d) not in got
                continue
            x = {k: score[enter, k[0], d, k[1]] for k in ((m, a) for m in ("latest", "first") for a in ("growth", "other"))}
            changed = any(state.get(("latest", a)) != state.get(("first", a)) for a in ("growth", "other"))
            valid = all(("latest", a) in state and state["latest", a] * x["latest", a] >= enter / 2 for a in ("growth", "other"))
            assert got[enter, d] == (changed, x["latest", "growth"] * x["first", "growth"] < 0, valid), (enter, t)


def test_fold_metrics_row_by_row(spark):
    rng = random.Random(12)
    rows = [("p", DAY + dt.timedelta(k), rng.gauss(0, 0.02), None if k == 0 else rng.random()) for k in range(900)]
    df = spark.createDataFrame(rows, "p string, d date, r double, t double")
    folds = replays.fold_bounds(spark, DAY, DAY + dt.timedelta(899), 12, 6, 6)
    bounds = {r.k: (r.test_from, r.test_to) for r in folds.collect()}
    got = {r.k: r for r in replays.fold_metrics(df, folds, "p", "d", "r", "t", 100).collect()}
    assert set(got) == set(bounds) and len(bounds) > 1
    for k, (lo, hi) in bounds.items():
        own = [r for r in rows if lo <= r[1] < hi]
        level, peak, down = 1.0, 1.0, 0.0
        for r in own:
            level *= 1 + r[2]
            peak = max(peak, level)
            down = max(down, 1 - level / peak)
        moved, logs = [r[3] or 0.0 for r in own], [math.log1p(r[2]) for r in own]
        want = (len(own), level ** (100 / len(own)) - 1, statistics.stdev(logs) * 10, down, max(sum(moved[max(0, i - 99) : i + 1]) for i in range(len(moved))), sum(moved) * 100 / len(own))
        assert tuple(got[k][c] for c in ("n", "return_annualised", "volatility", "drawdown", "turnover", "turnover_mean")) == pytest.approx(want)
