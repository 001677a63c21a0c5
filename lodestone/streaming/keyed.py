"""Keyed state with a lifetime under Structured Streaming: a store of values per key, changed by a stream, that expire by event time."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lodestone.session import shared_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def value_store(stream: DataFrame, late: str = "0 seconds") -> DataFrame:
    """K2: upsert, delete and lifetime of a value per key, as a stream of changes (key, value, at, alive).

    `stream` has key string, at timestamp, value long and lifetime long (seconds; 0 for ever). A new value takes the old
    one's place, value 0 deletes the key, and a key is deleted when the watermark passes the end of its lifetime (a timer).
    """

    class Store(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("value", "value long, at long, until long")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            newest = None
            for some in rows:
                row = some.sort_values(["at", "seq"]).iloc[-1]
                mine = (int(row["at"].value // 1000), int(row["seq"]), int(row["value"]), int(row["lifetime"]))
                newest = mine if newest is None or mine > newest else newest
            old = self.state.get()
            if newest is None or (old is not None and newest[0] < old[1]):
                return
            if old is not None and old[2]:
                self.handle.deleteTimer(old[2])
            at, _, value, lifetime = newest
            until = -(-(at + lifetime * 1_000_000) // 1000) if lifetime else 0  # milliseconds
            if value:
                self.state.update((value, at, until))
                if until:
                    self.handle.registerTimer(until)
            else:
                self.state.clear()
            yield pd.DataFrame({"key": [key[0]], "value": [value], "at": [at], "alive": [bool(value)]})

        def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
            old = self.state.get()
            if old is not None and old[2] and old[2] <= expiredTimerInfo.getExpiryTimeInMs():
                self.state.clear()
                yield pd.DataFrame({"key": [key[0]], "value": [old[0]], "at": [old[1]], "alive": [False]})

        def close(self) -> None:
            pass

    rows = stream.withWatermark("at", late).groupBy("key")
    return rows.transformWithStateInPandas(Store(), "key string, value long, at long, alive boolean", "Update", "EventTime")


def delayed(stream: DataFrame, late: str = "0 seconds") -> DataFrame:
    """K3, K4: commands (key string, at timestamp, seq long, delay long, in seconds) come out as (key, seq, due) when the
    watermark passes at + delay; until then each is a row of state of its own (equal ones share a row with their number),
    so a key may have any number of commands. A command is late if the watermark has passed its due time when it comes;
    one that is due before it comes waits until the watermark passes `at`. Without at or delay a command is never due.
    Spark's watermark begins at 1970, so commands due up to then are late."""
    due, at = F.unix_micros("at") + F.col("delay") * 1_000_000, F.unix_micros("at")
    rows = stream.withWatermark("at", late).withColumn("due", due).filter("due IS NOT NULL")
    # the mark of an event time lets the watermark of `at` release rows by `until`; a second watermark is not allowed
    rows = rows.select("key", "seq", "due", F.timestamp_micros(F.greatest("due", at)).alias("until", metadata={"spark.watermarkDelayMs": 0}))
    waiting = rows.groupBy("until", "due", "key", "seq").count()
    return waiting.select("key", "seq", "due", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("_n")).drop("_n")


def throttled(stream: DataFrame, interval_seconds: int, late: str = "0 seconds") -> DataFrame:
    """K5: of each key's rows (key string, at timestamp, seq long) those at least the interval after the last one let
    through, as (key, seq). A key's state goes when the watermark has passed the interval."""

    class Gate(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "at long, until long")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            ordered = sorted((int(at.value // 1000), int(seq)) for some in rows for at, seq in zip(some["at"], some["seq"], strict=True))
            state = self.last.get()
            last, until = state if state is not None else (None, 0)
            kept = []
            for at, seq in ordered:
                if last is None or at - last >= interval_seconds * 1_000_000:
                    kept.append(seq)
                    last = at
            if kept:
                if until:
                    self.handle.deleteTimer(until)
                until = -(-(last + interval_seconds * 1_000_000) // 1000)
                self.last.update((last, until))
                self.handle.registerTimer(until)
                yield pd.DataFrame({"key": [key[0]] * len(kept), "seq": kept})

        def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
            self.last.clear()
            return iter(())

        def close(self) -> None:
            pass

    return stream.withWatermark("at", late).groupBy("key").transformWithStateInPandas(Gate(), "key string, seq long", "Append", "EventTime")


def bounded_queues(stream: DataFrame, tick_seconds: int, capacity: int = 10_000, batch: int = 100, warn: float = 0.8) -> DataFrame:
    """K8: a queue per key (key string, at timestamp, seq long) as a stream: an arrival is dropped if the queue is full, and at
    the end of a tick that had arrivals a batch is worked off. Each time, the key's figures so far: processed, dropped, left and
    warned (ticks that ended above the warning share), the running tick counted as ended. State is five numbers a key."""

    class Queue(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("queue", "tick long, size long, done long, lost long, warned long")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            state = self.state.get()
            tick, size, done, lost, warned = state if state is not None else (None, 0, 0, 0, 0)
            for now in sorted(int(at.value // 1000) // (tick_seconds * 1_000_000) for some in rows for at in some["at"]):
                if tick is not None and now > tick:
                    work = min(batch, size)
                    size, done, warned = size - work, done + work, warned + (size > warn * capacity)
                tick = now if tick is None else max(tick, now)
                size, lost = (size + 1, lost) if size < capacity else (size, lost + 1)
            if tick is None:
                return
            self.state.update((tick, size, done, lost, warned))
            work = min(batch, size)
            yield pd.DataFrame({"key": [key[0]], "processed": [done + work], "dropped": [lost], "left": [size - work], "warned": [warned + int(size > warn * capacity)]})

        def close(self) -> None:
            pass

    return stream.withWatermark("at", "0 seconds").groupBy("key").transformWithStateInPandas(Queue(), "key string, processed long, dropped long, left long, warned long", "Update", "EventTime")


def loot_sets(stream: DataFrame, capacity: int, lifetime_seconds: int) -> DataFrame:
    """A set per key (key string, at timestamp, seq long, item long) as a stream: when a row comes to a full set, what is
    older than the lifetime goes, or, if it is full still, all; the row's item is taken if it is not there. Each time, the whole
    set as (key, item, seen). The capacity bounds the state."""

    class Loot(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("set", "items array<long>, seen array<long>")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            state = self.state.get()
            kept = dict(zip(*state, strict=True)) if state is not None else {}
            ordered = sorted((int(at.value // 1000), int(seq), int(item)) for some in rows for at, seq, item in zip(some["at"], some["seq"], some["item"], strict=True))
            for at, _, item in ordered:
                if len(kept) >= capacity:
                    kept = {k: v for k, v in kept.items() if v > at - lifetime_seconds * 1_000_000}
                if len(kept) >= capacity:
                    kept = {}
                kept.setdefault(item, at)
            if ordered:
                self.state.update((list(kept), list(kept.values())))
                yield pd.DataFrame({"key": [key[0]] * len(kept), "item": list(kept), "seen": list(kept.values())})

        def close(self) -> None:
            pass

    return stream.withWatermark("at", "0 seconds").groupBy("key").transformWithStateInPandas(Loot(), "key string, item long, seen long", "Update", "EventTime")


def emitted(rows: DataFrame, mode: str = "append") -> DataFrame:
    """All rows that a keyed stream gives until everything that is there has been read, with the number of their batch."""
    spark = rows.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/result/{number}")

    try:
        query = rows.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return spark.read.parquet(f"{folder}/result/*")


def last_batches(rows: DataFrame) -> DataFrame:
    """All rows that each key gave in the last batch in which it gave any."""
    every = emitted(rows, "update")
    last = every.groupBy("key").agg(F.max("batch").alias("batch"))
    return every.join(last, ["key", "batch"], "left_semi").drop("batch")


def last_changes(changes: DataFrame) -> DataFrame:
    """What a stream of changes leaves when all that is there has been read: each key's last change."""
    newest = Window.partitionBy("key").orderBy(F.desc("batch"), F.asc("alive"))
    return emitted(changes, "update").withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n", "batch")
