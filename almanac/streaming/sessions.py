"""Sessions that subscribe and unsubscribe while the stream runs, and last prices that age, as keyed state.

State is kept per symbol, so a stream of any number of symbols and sessions is dealt over all tasks. It lives in the
checkpoint: a query that starts again goes on where it stopped. Timers in event time clear what has expired, once the
watermark has passed.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

DELIVERED = "kind string, session string, symbol string, ts timestamp, price double, size bigint"
PRICES = "symbol string, ts timestamp, price double, expired boolean"
#: Parts of a symbol's subscriptions, and sessions that are told in one row.
PACKS, TOGETHER = 64, 1000
_told = "kind string, sessions array<string>, symbol string, ts timestamp, price double, size bigint"
_rows = "symbol string, ts timestamp, at long, action string, session string, price double, size bigint"


def keyed_state(spark: SparkSession) -> None:
    """The store that state of this kind needs; for queries that start after it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Routing(StatefulProcessor):
    """Per symbol: who is subscribed, and until when; packed by a hash of the session, so a batch reads and writes each pack
    once, whatever the number of its rows. A row of the output is of up to TOGETHER sessions."""

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.packs = handle.getMapState("packs", "pack int", "sessions array<string>, until array<bigint>")

    def _all(self) -> dict[int, dict[str, int]]:
        # Most symbols have none, and to ask for that is the cheaper call.
        if not self.packs.exists():
            return {}
        return {pack: dict(zip(sessions, until, strict=True)) for (pack,), (sessions, until) in self.packs.iterator()}

    def _keep(self, known: dict[int, dict[str, int]], changed: set[int]) -> None:
        for pack in changed:
            if known[pack]:
                self.packs.updateValue((pack,), (list(known[pack]), list(known[pack].values())))
            elif self.packs.containsKey((pack,)):
                self.packs.removeKey((pack,))

    def _told(self, kind: str, sessions: list[str], symbol: str, ts=None, price=None, size=None) -> Iterator[Row]:
        for k in range(0, len(sessions), TOGETHER):
            yield Row(kind=kind, sessions=sessions[k : k + TOGETHER], symbol=symbol, ts=ts, price=price, size=size)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known, changed, timers, live = self._all(), set(), set(), None
        # In the order of time, messages before ticks of the same time.
        for r in sorted(rows, key=lambda r: (r.at, r.action == "tick", r.action, r.session or "")):
            if r.action == "tick":
                if live is None:
                    own = [x for pack in known.values() for x in pack.items()]
                    live = np.array([s for s, _ in own], dtype=object), np.array([u for _, u in own], dtype=np.int64)
                yield from self._told("tick", live[0][live[1] > r.at].tolist(), key[0], r.ts, r.price, r.size)
                continue
            pack = known.setdefault(at := crc32(r.session.encode()) % PACKS, {})
            if r.action == "subscribe":
                pack[r.session] = r.at + self.ttl_ms
                timers.add(r.at + self.ttl_ms)
            elif pack.pop(r.session, None) is None:
                continue
            changed.add(at)
            live = None
        self._keep(known, changed)
        for at in timers:
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, known = expiredTimerInfo.getExpiryTimeInMs(), self._all()
        gone = {pack: [s for s, until in own.items() if until <= now] for pack, own in known.items()}
        for pack, sessions in gone.items():
            for s in sessions:
                del known[pack][s]
        self._keep(known, {pack for pack, sessions in gone.items() if sessions})
        yield from self._told("expired", [s for sessions in gone.values() for s in sessions], key[0])

    def close(self) -> None:
        pass


class LastPrice(StatefulProcessor):
    """Per symbol: the newest price, the highest of one time, until none has come for some time."""

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, ts timestamp, price double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = self.last.get() if self.last.exists() else None
        for r in rows:
            if best is None or (r.at, r.price) > (best[0], best[2]):
                best = (r.at, r.ts, r.price)
        self.last.update(tuple(best))
        self.handle.registerTimer(best[0] + self.ttl_ms)
        yield Row(symbol=key[0], ts=best[1], price=best[2], expired=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last.exists():
            at, ts, price = self.last.get()
            if at + self.ttl_ms <= expiredTimerInfo.getExpiryTimeInMs():
                self.last.clear()
                yield Row(symbol=key[0], ts=ts, price=price, expired=True)

    def close(self) -> None:
        pass


def _timed(df: DataFrame, late: str) -> DataFrame:
    return df.withColumn("at", F.unix_millis("ts")).withWatermark("ts", late)


def deliveries(ticks: DataFrame, messages: DataFrame, ttl_ms: int, late: str = "1 minute") -> DataFrame:
    """A row per tick and session that is subscribed to its symbol at that time, for the append output mode.

    messages: (ts, session, action, symbols), actions ``subscribe`` and ``unsubscribe``; a subscription lasts ttl_ms from its
    newest message. Both come as streams; what arrives in one batch counts in the order of time, a message before a tick of
    the same time, an unsubscription after a subscription. A row of kind ``expired`` tells of each subscription that the
    watermark has passed. Rows without a time, symbol or session, and other actions, are left out.
    """
    ticks = ticks.select("symbol", "ts", F.lit("tick").alias("action"), F.lit(None).cast("string").alias("session"), "price", F.col("size").cast("bigint").alias("size"))
    asked = messages.where("session IS NOT NULL AND action IN ('subscribe', 'unsubscribe')").select(F.explode(F.array_distinct("symbols")).alias("symbol"), "ts", "action", "session", F.lit(None).cast("double").alias("price"), F.lit(None).cast("bigint").alias("size"))
    # One watermark for both: sessions that are silent don't hold it back.
    both = _timed(ticks.unionByName(asked).where("symbol IS NOT NULL AND ts IS NOT NULL"), late).select(*(c.split()[0] for c in _rows.split(", ")))
    told = both.groupBy("symbol").transformWithState(Routing(ttl_ms), _told, "Append", "EventTime")
    return told.select("kind", F.explode("sessions").alias("session"), "symbol", "ts", "price", "size")


def aging_prices(ticks: DataFrame, ttl_ms: int, late: str = "1 minute") -> DataFrame:
    """The newest price of each symbol that a batch has ticks of, and once more, as expired, when none has come for ttl_ms;
    for the update output mode. Rows without a time, symbol or price are left out."""
    rows = _timed(ticks.where("symbol IS NOT NULL AND ts IS NOT NULL AND price IS NOT NULL").select("symbol", "ts", "price"), late)
    return rows.groupBy("symbol").transformWithState(LastPrice(ttl_ms), PRICES, "Update", "EventTime")
