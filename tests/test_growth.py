"""What a task reads and holds doesn't grow with the tables, and no table is made twice."""

from __future__ import annotations

import datetime as dt
import math
import random
import re
import time
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from almanac import lens
from almanac.operators import quality, regimes
from almanac.plans import contracts, joins
from almanac.sources import archives, sinks
from almanac.streaming import sessions

DATA = "/root/testdata/sf0.001"
plan = lambda df: df._jdf.queryExecution().executedPlan().toString()


def test_reported_flows_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(archives, "LINES", 100)
    counted, archived = [], archives.archived
    monkeypatch.setattr(contracts, "archived", lambda *a: counted.append(archived(*a)) or counted[-1])
    n = contracts.reported_flows(spark, DATA).count()
    assert n > 500 and [df.rdd.getNumPartitions() for df in counted] == [-(-2 * n // 100)] * 2


def test_reported_flows_are_made_once_and_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(archives, "LINES", 100)
    monkeypatch.setattr(contracts, "GROUPED", 400)
    seen, viewed, archive = [], [], contracts.archive
    monkeypatch.setattr(contracts, "archive", lambda tables, *a: seen.extend(tables.values()) or archive(tables, *a))
    monkeypatch.setattr(contracts, "view", lambda *a, **k: viewed.append(lens.view(*a, **k)) or viewed[-1])
    got = contracts.reported_flows(spark, DATA)
    # The sums need one shuffle, into tasks of GROUPED rows; the members read what was kept; a task joins no more than an archive's lines.
    lines, flows = viewed
    assert plan(flows).count("Exchange") == 1 and flows.rdd.getNumPartitions() == -(-lines.count() // 400)
    assert len(seen) == 2 and not any("Aggregate" in plan(df) for df in seen)
    want = [(r.series_id, r.month_end, r.sales, r.net_assets) for r in lens.view(spark, DATA, "flows").collect()]
    assert got.rdd.getNumPartitions() == -(-2 * len(want) // 100) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted((r.series_id, r.report_date, r.sales, r.net_assets) for r in got.collect()) == sorted(want)


def plain_repair(values, low=0.2):
    out = list(values)
    for i, v in enumerate(out):
        around = [out[k] for k in range(max(0, i - 2), min(len(out), i + 3)) if k != i and out[k] is not None and out[k] > 0]
        if v is None or v <= 0 or not around or v >= (ref := float(np.median(around))) * low:
            continue
        sides = [next((out[k] for k in ks if out[k] is not None and out[k] >= ref * low), None) for ks in (range(i - 1, -1, -1), range(i + 1, len(out)))]
        good = [x for x in sides if x is not None]
        out[i] = math.exp(sum(map(math.log, good)) / len(good)) if good else ref
    return out


def test_repairs_of_many_series_at_once(spark, monkeypatch):
    monkeypatch.setattr(quality, "CELLS", 700)
    rng, series = random.Random(3), {}
    for k in range(120):
        level = lambda: rng.choice([None, 0.0, -1.0, 0.4, 3.0, 9.0, *[100 + rng.random()] * (2 + k % 30)])
        series[f"s{k}"] = [level() for _ in range(rng.randrange(1, 90))]
    series["dead"], series["step"] = [100.0] + [1.0] * 20, [10.0] * 9 + [90.0] * 9
    day = dt.date(2000, 1, 1)
    df = spark.createDataFrame([(k, day + dt.timedelta(t), v) for k, own in series.items() for t, v in enumerate(own)], "k string, d date, x double")
    alone = {r.k for r in quality.series_flags(df, "k", "d", "x").where("dead OR step").collect()}
    got = {(r.k, r.d): (r.x, r.repaired) for r in quality.repaired(df, "k", "d", "x").collect()}
    assert {"dead", "step"} <= alone < set(series) and len(got) == sum(map(len, series.values()))
    fixed = 0
    for k, own in series.items():
        for t, (a, b) in enumerate(zip(own, own if k in alone else plain_repair(own), strict=True)):
            fixed += a != b
            assert got[k, day + dt.timedelta(t)] == (b, a != b), (k, t)
    assert fixed > 100


def test_dips_in_the_last_rows_of_what_is_repaired_at_once(spark, monkeypatch):
    tails = [[1.0], [1.0, 100.0], [1.0, 1.0], [1.0, None], [1.0, 2.0, 100.0]]
    series = {f"s{k}": [100.0 + k] * (12 + k) + tails[k % 5] for k in range(20)}
    # Whichever series is the last of its rows, a dip stands at its end.
    for own in series.values():
        x = np.array([*own, None, None], dtype=float)
        np.testing.assert_array_equal(quality._repair(x, np.array([0]), np.array([len(own)]))[:-2], np.array(plain_repair(own), dtype=float))
    monkeypatch.setattr(quality, "CELLS", 40)
    day = dt.date(2000, 1, 1)
    df = spark.createDataFrame([(k, day + dt.timedelta(t), v) for k, own in series.items() for t, v in enumerate(own)], "k string, d date, x double")
    got = {(r.k, r.d): (r.x, r.repaired) for r in quality.repaired(df, "k", "d", "x").collect()}
    want = {(k, day + dt.timedelta(t)): (b, a != b) for k, own in series.items() for t, (a, b) in enumerate(zip(own, plain_repair(own), strict=True))}
    assert got == want and sum(r for _, r in want.values()) >= 20


def test_only_dips_are_walked():
    n, m = 400, 500
    x = np.concatenate([np.append(100 + np.random.default_rng(k).random(m), [np.nan] * 2) for k in range(n)])
    x[50::97] /= 100
    starts = np.arange(n) * (m + 2)
    began = time.perf_counter()
    got = quality._repair(x, starts, starts + m)
    fast, began = time.perf_counter() - began, time.perf_counter()
    for k in range(0, n, 10):
        want = plain_repair([None if np.isnan(v) else float(v) for v in x[starts[k] : starts[k] + m]])
        np.testing.assert_array_equal(got[starts[k] : starts[k] + m], np.array(want, dtype=float))
    assert fast < (time.perf_counter() - began) * 10 / 5


def test_debounce_sorts_once(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS d", "id % 7 < 3 AS raw")
    assert len(re.findall(r"(?<!Range)\bSort \[", plan(regimes.debounce(df, ["k"], "d", "raw", 2)).split("Initial Plan")[0])) == 1


def test_xml_files_are_of_bounded_rows(spark, monkeypatch):
    where, scratch = [], contracts.scratch
    monkeypatch.setattr(contracts, "XML_ROWS", 30, raising=False)
    monkeypatch.setattr(contracts, "scratch", lambda *a: where.append(scratch(*a)) or where[-1])
    contracts.xml_holdings(spark, DATA)
    rows = [r.n for r in spark.read.text(where[0]).where("value LIKE '%<infoTable>%'").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(rows) == spark.read.parquet(f"{DATA}/part.parquet").count() > 60 and max(rows) <= 30


def test_one_value_a_key_needs_no_sort(spark):
    rows = [(1, 5.0), (1, 3.0), (2, None), (2, 7.0), (3, None), (4, float("nan")), (4, 1.0)]
    df = spark.createDataFrame(rows, "k int, v double")
    for last, want in ((False, {1: 3.0, 2: None, 3: None, 4: 1.0}), (True, {1: 5.0, 2: 7.0, 3: None})):
        one = sinks.one_a_key(df, ["k"], last=last)
        assert "SortAggregate" not in plan(one)
        found = {r.k: r.v for r in one.collect()}
        assert len(found) == 4 and all(found[k] == v for k, v in want.items()) and (not last or math.isnan(found[4]))


def test_composite_metrics_are_made_once(spark):
    assert "lineitem" not in plan(joins.composite(spark, DATA))


class Packs(dict):
    """Map state that counts its calls."""

    def iterator(self):
        self.calls = getattr(self, "calls", 0) + 1
        return iter(list(self.items()))

    def updateValue(self, key, value):
        self.calls = getattr(self, "calls", 0) + 1
        self[key] = value

    def exists(self):
        return bool(self)

    def containsKey(self, key):
        return key in self

    def removeKey(self, key):
        del self[key]


def test_state_is_read_and_written_once_a_batch():
    packs, timers = Packs(), []
    routing = sessions.Routing(1000)
    routing.init(SimpleNamespace(getMapState=lambda *a: packs, registerTimer=timers.append))
    row = lambda at, action, session=None, price=None: SimpleNamespace(at=at, action=action, session=session, ts=at, price=price, size=1)
    rows = [row(5, "subscribe", f"s{k}") for k in range(5000)] + [row(7, "unsubscribe", f"s{k}") for k in range(0, 5000, 2)] + [row(t, "tick", price=float(t)) for t in (4, 5, 6, 7, 1005)]
    told = [r for r in routing.handleInputRows(("A",), rows, None)]
    heard = {t: sorted(s for r in told if r.ts == t for s in r.sessions) for t in (4, 5, 6, 7, 1005)}
    every, odd = sorted(f"s{k}" for k in range(5000)), sorted(f"s{k}" for k in range(1, 5000, 2))
    assert heard == {4: [], 5: every, 6: every, 7: odd, 1005: []}
    assert packs.calls <= 100 and timers == [1005] and max(len(r.sessions) for r in told) <= 1000
    gone = [s for r in routing.handleExpiredTimer(("A",), None, SimpleNamespace(getExpiryTimeInMs=lambda: 1005)) for s in r.sessions]
    assert sorted(gone) == odd and not packs


def test_the_panel_is_made_once(spark):
    assert "lineitem" not in plan(contracts._panel(spark, DATA))
