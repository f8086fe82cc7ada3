"""Merges into partitioned tables: what they read, what they write, and how repeated keys resolve."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from almanac.sources import sinks
from almanac.streaming import ticks

SCHEMA = "p string, k int, v double, seq int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, path):
    return sorted((str(r.p), r.k, r.v) for r in spark.read.schema(SCHEMA).parquet(path).collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_repeated_keys_follow_the_conflict_rules(spark):
    old = table(spark, [("a", 1, 0.0, 0)])
    new = table(spark, [("a", 2, 5.0, 2), ("a", 2, 9.0, 1), ("a", 1, 7.0, 3), ("a", 1, 8.0, 4)])
    assert [(r.k, r.v) for r in sinks.inserted(old, new, ["p", "k"], ["seq"]).collect()] == [(2, 9.0)]
    assert sorted((r.k, r.v) for r in sinks.upserted(old, new, ["p", "k"], ["seq"]).collect()) == [(1, 8.0), (2, 5.0)]
    again = sinks.upserted(sinks.upserted(old, new, ["p", "k"]), new, ["p", "k"])
    assert again.count() == 2 and again.columns == old.columns
    assert sinks.inserted(old, old.limit(0), ["p", "k"]).count() == 0


@pytest.mark.parametrize("update", [False, True])
def test_a_merge_touches_its_own_partitions(spark, tmp_path, update):
    path = str(tmp_path / "t")
    sinks.merge_into(path, table(spark, [(p, k, float(k), 0) for p in ("a", "b", "c", None) for k in range(5)]), ["p", "k"], "p", update)
    before = files(path)
    batch = table(spark, [("b", 3, 30.0, 1), ("b", 3, 31.0, 2), ("b", 9, 90.0, 1), ("d", 1, 1.5, 1)])
    # What is read of the table are the files of the partitions that the batch names.
    read = sinks.touched(spark.read.schema(SCHEMA).parquet(path), batch, "p").select(F.input_file_name()).distinct().collect()
    assert read and all("/p=b/" in r[0] for r in read)
    for _ in range(2):
        sinks.merge_into(path, batch, ["p", "k"], "p", update, ["seq"])
    after = files(path)
    untouched = {f for f in before if "/p=b/" not in f}
    assert {f: after.get(f) for f in untouched} == {f: before[f] for f in untouched}
    want = [(p, k, float(k)) for p in ("a", "b", "c", "None") for k in range(5)] + [("b", 9, 90.0), ("d", 1, 1.5)]
    want = [("b", 3, 31.0) if update and w[:2] == ("b", 3) else w for w in want]
    assert stored(spark, path) == sorted(want)
    sinks.merge_into(path, batch.limit(0), ["p", "k"], "p", update)
    assert stored(spark, path) == sorted(want)
    with pytest.raises(ValueError):
        sinks.merge_into(path, batch, ["k"], "p", update)


def test_null_partitions_and_many_of_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "NAMED", 1)
    path, rows = str(tmp_path / "t"), [(p, 1, 1.0, 0) for p in (None, "a", "b", "c")]
    sinks.merge_into(path, table(spark, rows), ["p", "k"], "p", True)
    read = sinks.touched(spark.read.schema(SCHEMA).parquet(path), table(spark, rows[:3]), "p")
    assert sorted(str(r.p) for r in read.collect()) == ["None", "a", "b"]
    sinks.merge_into(path, table(spark, [(p, k, 2.0, 0) for p in (None, "b", "c") for k in (1, 2)]), ["p", "k"], "p", True)
    assert {w for w in stored(spark, path) if w[0] != "None"} == {("a", 1, 1.0), *((p, k, 2.0) for p in ("b", "c") for k in (1, 2))}


def test_a_stream_reads_what_its_batches_touch(spark, tmp_path):
    """Restarted from its checkpoint, the stream adds new keys only, and leaves other partitions' files alone."""
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    batches = [[("a", 1, 1.0, 0), ("b", 1, 1.0, 0)], [("a", 1, 5.0, 0), ("a", 2, 2.0, 0), ("a", 2, 3.0, 0)]]
    kept = {}
    for rows in batches:
        table(spark, rows).coalesce(1).write.mode("append").parquet(src)
        ticks.append_new(spark.readStream.schema(SCHEMA).parquet(src), out, ["p", "k"], str(tmp_path / "state"), "p").awaitTermination()
        kept = kept or files(out)
    assert stored(spark, out) == [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 1.0)] and {f: files(out).get(f) for f in kept} == kept
    ticks.append_new(spark.readStream.schema(SCHEMA).parquet(src), out, ["p", "k"], str(tmp_path / "other"), "p").awaitTermination()
    assert stored(spark, out) == [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 1.0)]
