"""Registered queries make the whole of their tables: no subset of entities, series or dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from almanac.lens import view
from almanac.operators import regimes as S
from almanac.plans import regimes
from almanac.registry import load

DATA = "/root/testdata/sf0.001"


def test_vintages_of_every_series(spark):
    orders, lines = view(spark, DATA, "orders"), view(spark, DATA, "lineitem")
    every = {r[0] for r in orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderpriority").distinct().collect()}
    assert len(every) == 5 and {r[0] for r in view(spark, DATA, "vintages").select("series_id").distinct().collect()} == every
    for name in ("pit01_asof_read", "pit04_freshness", "pit05_pit06_revisions", "pit07_series_audit", "pit08_merged_batches", "src06_wide_vintages", "st15_soft_threshold"):
        assert {r[0] for r in load()[name].run(spark, DATA).select("series_id").distinct().collect()} == every, name


def business_days(a, b):
    """From a to b, signed; both ends count, less one."""
    lo, hi = min(a, b), max(a, b)
    n = sum((lo + dt.timedelta(k)).weekday() < 5 for k in range((hi - lo).days + 1)) - 1
    return 0 if a == b else n if b > a else -n


def test_matches_cross_new_year(spark):
    where = "/root/testdata/sf0.01"
    rows = S.transitions(regimes._states(spark, where), ["axis"], "d", "state").collect()
    left, right = (sorted(r.d for r in rows if r.axis == axis) for axis in ("1-URGENT", "2-HIGH"))
    want, at = [], 0
    for d in left:
        near = [(abs(lag), lag, k) for k in range(at, len(right)) if abs((right[k] - d).days) < 200 and abs(lag := business_days(d, right[k])) <= 126]
        if near:
            _, lag, k = min(near)
            want.append((d, right[k], lag))
            at = k + 1
    assert any(a.year != b.year for a, b, _ in want)
    assert sorted((r.a_date, r.b_date, r.lag) for r in load()["rp03_monotonic_matches"].run(spark, where).collect()) == want


def test_matches_of_one_side_only(spark):
    a = spark.createDataFrame([(1, dt.date(2000, 1, 1)), (2, dt.date(2000, 1, 1))], "k int, d date")
    assert [r.k for r in S.monotonic_matches(a, a.where("k = 1"), "k", "d", 126).collect()] == [1]
    assert S.monotonic_matches(a.where("k = 1"), a.where("k = 2"), "k", "d", 126).count() == 0


def test_every_month_end_and_entity(spark):
    nav, months = view(spark, DATA, "nav"), lambda df, c: {r[0] for r in df.select(F.last_day(c)).distinct().collect()}
    sliced = load()["jn18_interval_slices"].run(spark, DATA)
    assert months(sliced, "as_of") == months(nav, "nav_date")
    assert sliced.count() == nav.select("instrument_id", F.last_day("nav_date")).distinct().count()
    vintages = view(spark, DATA, "vintages")
    first, last = vintages.agg(F.min("vintage_date"), F.max("vintage_date")).first()
    for name in ("pit02_panel_latest", "pit02_panel_first_release"):
        cuts = {r[0] for r in load()[name].run(spark, DATA).select("cut").distinct().collect()}
        assert (min(cuts), max(cuts)) == (first, last) and len(cuts) == (last.year - first.year) * 12 + last.month - first.month + 1
    scanned = load()["src01_series_scan"].run(spark, DATA)
    assert scanned.count() == nav.where("year(nav_date) BETWEEN 1996 AND 1999").count() > 0
    assert scanned.select("instrument_id").distinct().count() == nav.select("instrument_id").distinct().count() > 1


#: Rows, and sums of number columns, of the queries that have no SQL beside them, as they stand over the smallest tables.
STORED = {
    "dq01_repaired_series": (5334, {"nav": 547171.3365}),
    "fac02_fac03_fac04_factor_fit": (3, {"loading": 0.3374, "k": 3, "r2": 0.3915, "out_of_sample": -0.0112}),
    "fac05_loading_drift": (5, {"drift": 0.7157}),
    "fit01_fit02_udf01_entity_fits": (10, {"vol": 0.9025, "shape": -11.045, "cvar_99": -0.0994, "cvar_999": -0.0995}),
}


def test_values_of_queries_without_sql(spark):
    """A change of what they give shows here."""
    assert set(STORED) == {name for name, q in load().items() if not q.sql}
    for name, (n, sums) in STORED.items():
        rows = load()[name].run(spark, DATA).collect()
        assert len(rows) == n, name
        for c, want in sums.items():
            assert abs(sum(float(r[c]) for r in rows if r[c] is not None) - want) <= 2e-3 * max(1, abs(want)), (name, c)
