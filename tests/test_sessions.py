"""Keyed state of subscriptions and last prices: two streams, a restart, an expiry."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest

from almanac.streaming import sessions

AT = lambda m: dt.datetime(2024, 1, 1, 0, m)
TICK, MESSAGE = "symbol string, ts timestamp, price double, size bigint", "ts timestamp, session string, action string, symbols array<string>"


@pytest.fixture
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    sessions.keyed_state(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def run(spark, where, build, mode):
    """One run of the query to the end of what has arrived; a new query each time, from the same checkpoint."""
    stream = build(spark.readStream.schema(TICK).parquet(f"{where}/ticks"), spark.readStream.schema(MESSAGE).parquet(f"{where}/messages"))
    keep = lambda df, n: df.write.mode("overwrite").parquet(f"{where}/out/{mode}{n}")
    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{where}/state-{mode}").trigger(availableNow=True).start().awaitTermination()


def arrive(spark, where, ticks, messages):
    spark.createDataFrame([(s, AT(m), p, 1) for s, m, p in ticks], TICK).coalesce(1).write.mode("append").parquet(f"{where}/ticks")
    spark.createDataFrame([(AT(m), who, what, list(which)) for m, who, what, which in messages], MESSAGE).coalesce(1).write.mode("append").parquet(f"{where}/messages")


def test_subscriptions_survive_a_restart_and_expire(spark, tmp_path, store):
    where = str(tmp_path)
    build = lambda ticks, messages: sessions.deliveries(ticks, messages, 10 * 60_000, "0 seconds")

    def out():
        rows = spark.read.schema(sessions.DELIVERED).parquet(*(str(p) for p in (tmp_path / "out").iterdir())).collect() if (tmp_path / "out").exists() else []
        return Counter((r.kind, r.session, r.symbol, r.price) for r in rows)

    arrive(spark, where, [("A", 1, 1.0), ("A", 3, 3.0), ("B", 3, 30.0), ("C", 3, 9.0)], [(2, "x", "subscribe", "AB"), (3, "y", "subscribe", "AA"), (1, None, "subscribe", "A"), (1, "z", "other", "A")])
    run(spark, where, build, "append")
    want = Counter([("tick", "x", "A", 3.0), ("tick", "y", "A", 3.0), ("tick", "x", "B", 30.0)])
    assert out() == want
    # After a restart x is still subscribed to A and B; it leaves A, while y comes again and so stays longer.
    arrive(spark, where, [("A", 5, 5.0), ("A", 7, 7.0), ("B", 7, 70.0)], [(6, "x", "unsubscribe", "A"), (6, "y", "subscribe", "A")])
    run(spark, where, build, "append")
    want += Counter([("tick", "x", "A", 5.0), ("tick", "y", "A", 5.0), ("tick", "y", "A", 7.0), ("tick", "x", "B", 70.0)])
    assert out() == want
    # x's subscription of B ended at minute 12; y's of A lasts until 16.
    arrive(spark, where, [("A", 13, 13.0), ("B", 13, 130.0)], [])
    run(spark, where, build, "append")
    want += Counter([("tick", "y", "A", 13.0), ("expired", "x", "B", None)])
    assert out() == want
    arrive(spark, where, [("A", 30, 30.0), ("B", 30, 300.0)], [])
    run(spark, where, build, "append")
    assert out() == want + Counter([("expired", "y", "A", None)])


def test_last_prices_age(spark, tmp_path, store):
    where = str(tmp_path)
    build = lambda ticks, _: sessions.aging_prices(ticks, 5 * 60_000, "0 seconds")
    found = lambda: {(r.symbol, r.price, r.expired) for r in spark.read.parquet(*(str(p) for p in (tmp_path / "out").iterdir())).collect()}
    arrive(spark, where, [("A", 1, 1.0), ("A", 2, 2.0), ("A", 2, 1.5), ("B", 2, 9.0), (None, 2, 1.0)], [])
    run(spark, where, build, "update")
    assert found() == {("A", 2.0, False), ("B", 9.0, False)}
    arrive(spark, where, [("A", 1, 7.0), ("A", 20, 4.0)], [])
    run(spark, where, build, "update")
    # An older tick changes nothing; B has had none for longer than it may.
    assert found() == {("A", 2.0, False), ("B", 9.0, False), ("A", 4.0, False), ("B", 9.0, True)}
