"""The seen-store and source health as keyed state of a stream, by ``transformWithState``, readable as tables.

State lies in the checkpoint's RocksDB store, so a restart goes on where the last committed batch ended. Times are held as microseconds since 1970.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.state import TTL_DAYS
from ..shipping import ship

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS, SHARES = 24 * 60 * 60 * 1000, 1024


def _ready(df: DataFrame) -> None:
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class Seen(StatefulProcessor):
    """A share of the ids: when each was seen last and when it is due to be forgotten, as one value that a batch reads and writes once, with one timer for the id that is due first.

    By the event clock an id is due once the watermark is a time to live past that, else when it hasn't come for so long.
    """

    def __init__(self, ttl_ms: int, timers: bool):
        self.ttl_ms, self.timers = ttl_ms, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "ids array<string>, at array<long>, due array<long>, wake long")

    def _held(self) -> tuple[dict[str | None, tuple[int, int]], int | None]:
        value = self.seen.get()
        if value is None:
            return {}, None
        ids, at, due, wake = value
        return dict(zip(ids, zip(at, due))), wake

    def _hold(self, held: dict[str | None, tuple[int, int]], wake: int | None) -> None:
        first = min(due for _, due in held.values()) - 1  # a timer goes off once its clock is past it
        if wake is None or first < wake:
            if wake is not None:
                self.handle.deleteTimer(wake)
            self.handle.registerTimer(first)
            wake = first
        self.seen.update((list(held), [at for at, _ in held.values()], [due for _, due in held.values()], wake))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came: dict[str | None, tuple[int, int]] = {}
        for part in rows:
            for i, at in zip(part["id"].tolist(), part["at"].tolist()):
                i = i if isinstance(i, str) else None
                n, latest = came.get(i, (0, at))
                came[i] = n + 1, max(latest, at)
        held, wake = self._held()
        now = None if self.timers else timerValues.getCurrentProcessingTimeInMs()
        out = []
        for i, (n, latest) in came.items():
            old = held.get(i)
            if old is not None and now is not None and old[1] <= now:
                old = None
            latest = latest if old is None else max(latest, old[0])
            held[i] = latest, (-(-latest // 1000) if now is None else now) + self.ttl_ms
            out.append((i, latest, n, old is None))
        self._hold(held, wake)
        yield pd.DataFrame(out, columns=["id", "at", "rows", "new"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() if self.timers else timerValues.getCurrentProcessingTimeInMs()
        held = {i: (at, due) for i, (at, due) in self._held()[0].items() if due > now}
        if held:
            self._hold(held, None)  # Spark deletes the timer that went off
        else:
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def seen_stream(entries: DataFrame, days: float = TTL_DAYS, *, lateness: str = "0 seconds", clock: str = "event", shares: int = SHARES) -> DataFrame:
    """(id, seen_at, rows, new) of every id of each batch of ``entries`` (id, seen_at); ``new`` says that no earlier batch within the time to live had it.

    By the ``event`` clock, the state after a batch is ``operators.state.upsert_seen`` of all entries so far, with the watermark as now; by the ``processing`` clock
    ids live that long after their last entry came (use a processing-time trigger: with ``availableNow`` Spark keeps asking such a stream for batches). Null ids make one id;
    entries without a time aren't kept. Ids lie in so many ``shares`` by their hash; a batch reads and writes the shares of its ids, so a store of n ids takes n / shares of
    them into a task's memory at a time. A checkpoint keeps its number of shares.
    """
    _ready(entries)
    if clock not in ("event", "processing"):
        raise ValueError(clock)
    timers = clock == "event"
    rows = entries.withWatermark("seen_at", lateness) if timers else entries
    share = F.pmod(F.xxhash64("id"), F.lit(shares)).cast("int").alias("share")
    keyed = rows.where("seen_at is not null").select("id", "seen_at", F.unix_micros("seen_at").alias("at"), share).groupBy("share")
    out = keyed.transformWithStateInPandas(Seen(int(days * DAY_MS), timers), "id string, at long, rows int, new boolean", "update", "EventTime" if timers else "ProcessingTime")
    return out.select("id", F.timestamp_micros("at").alias("seen_at"), "rows", "new")


class Health(StatefulProcessor):
    """A source's runs: one value of last times, and two maps of the runs without rows since then, so that runs may come in any order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "seen long, fetch long, run long, count long, tracked long")
        self.quiet = handle.getMapState("quiet", "run long", "n int")
        self.dead = handle.getMapState("dead", "run long", "n int")

    @staticmethod
    def _add(runs, at: int, after: int | None) -> None:
        if after is None or at > after:
            runs.updateValue((at,), ((runs.getValue((at,))[0] if runs.containsKey((at,)) else 0) + 1,))

    @staticmethod
    def _drop(runs, upto: int) -> None:
        for key in [k for k in runs.keys() if k[0] <= upto]:
            runs.removeKey(key)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen, fetch, run, count, tracked = self.last.get() if self.last.exists() else (None, None, None, None, 0)
        for row in rows:
            at, passed, raw = row["at"], row["passed"], row["raw"]
            if run is None or at > run:
                run, count = at, passed
            if passed is not None and passed > 0:
                seen = at if seen is None else max(seen, at)
                self._drop(self.quiet, seen)
            elif passed is not None:
                self._add(self.quiet, at, seen)
            tracked += raw is not None
            if raw is not None and raw > 0:
                fetch = at if fetch is None else max(fetch, at)
                self._drop(self.dead, fetch)
            elif raw is not None:
                self._add(self.dead, at, fetch)
        self.last.update((seen, fetch, run, count, tracked))
        total = lambda runs: sum(v[0] for v in runs.values())
        yield Row(source=key[0], streak=total(self.quiet), fetch_streak=total(self.dead) if tracked else None, seen=seen, last_count=count, run=run)

    def close(self) -> None:
        pass


def health_stream(log: DataFrame) -> DataFrame:
    """``operators.health.health`` of the runs so far (run_ts, source, passed, raw), for each source that a batch touches; runs may come late and out of order."""
    _ready(log)
    rows = log.select("source", F.unix_micros("run_ts").alias("at"), F.col("passed").cast("long").alias("passed"), F.col("raw").cast("long").alias("raw")).groupBy("source")
    out = rows.transformWithState(Health(), "source string, streak long, fetch_streak long, seen long, last_count long, run long", "update", "None")
    return out.select("source", "streak", "fetch_streak", F.timestamp_micros("seen").alias("last_seen"), "last_count", F.timestamp_micros("run").alias("last_run"))


def stored(spark: SparkSession, checkpoint: str, state: str) -> DataFrame:
    """A stream's state as of its last committed batch, through Spark's state reader: the key's columns and the value's, or a map's entries as ``map_key`` and ``map_value``."""
    found = spark.read.format("statestore").option("stateVarName", state).load(checkpoint)
    if "user_map_key" in found.columns:
        return found.select("key.*", F.col("user_map_key").alias("map_key"), F.col("user_map_value").alias("map_value"))
    return found.select("key.*", "value.*")


def stored_seen(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The seen-store (id, seen_at) that ``seen_stream`` keeps."""
    at: Column = F.timestamp_micros("e.at")
    return stored(spark, checkpoint, "seen").select(F.explode(F.arrays_zip("ids", "at")).alias("e")).select(F.col("e.ids").alias("id"), at.alias("seen_at"))


def stored_health(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sources' health that ``health_stream`` keeps, with the columns of ``operators.health.health``."""
    runs = lambda state: stored(spark, checkpoint, state).groupBy("source").agg(F.sum("map_value.n").alias(state))
    found = stored(spark, checkpoint, "last").join(runs("quiet"), "source", "left").join(runs("dead"), "source", "left")
    none = F.lit(0).cast("long")
    return found.select(
        "source", F.coalesce("quiet", none).alias("streak"), F.when(F.col("tracked") > 0, F.coalesce("dead", none)).alias("fetch_streak"),
        F.timestamp_micros("seen").alias("last_seen"), F.col("count").alias("last_count"), F.timestamp_micros("run").alias("last_run"),
    )
