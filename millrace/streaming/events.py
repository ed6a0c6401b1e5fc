"""Structured Streaming forms of the stateful operators, and windows over events. These are extensions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..shipping import ship

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, schema: str = EVENTS, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def first_within(df: DataFrame, keys: list[str], ttl: str = "30 days", time: str = "ts") -> DataFrame:
    """The first row of each key within the time to live; state is dropped behind the watermark."""
    return df.withWatermark(time, ttl).dropDuplicatesWithinWatermark(keys)


def tumbling(df: DataFrame, width: str, lateness: str = "1 hour") -> DataFrame:
    return _windowed(df, F.window("ts", width), lateness)


def sliding(df: DataFrame, width: str, step: str, lateness: str = "1 hour") -> DataFrame:
    return _windowed(df, F.window("ts", width, step), lateness)


def sessions(df: DataFrame, gap: str, lateness: str = "1 hour") -> DataFrame:
    src = df.withWatermark("ts", lateness) if df.isStreaming else df
    out = src.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def _windowed(df: DataFrame, window, lateness: str) -> DataFrame:
    src = df.withWatermark("ts", lateness) if df.isStreaming else df
    out = src.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


HEALTH_OUT = "source string, streak int, fetch_streak int, last_seen timestamp"


def health_stream(log: DataFrame) -> DataFrame:
    """Streaming streaks (run_ts, source, passed, raw): the state is four values for each source; null raw leaves it as it is."""

    ship(log.sparkSession)

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak, fetch, seen = state.get if state.exists else (0, -1, None)
        for run in pd.concat(list(batches)).sort_values("run_ts").itertuples(index=False):
            streak = 0 if run.passed > 0 else streak + 1
            seen = run.run_ts.to_pydatetime() if run.passed > 0 else seen
            if not pd.isna(run.raw):
                fetch = 0 if run.raw > 0 else max(fetch, 0) + 1
        state.update((streak, fetch, seen))
        yield pd.DataFrame({"source": [key[0]], "streak": [streak], "fetch_streak": pd.Series([None if fetch < 0 else fetch], dtype="Int32"), "last_seen": pd.to_datetime([seen])})

    return log.groupBy("source").applyInPandasWithState(update, HEALTH_OUT, "streak int, fetch int, seen timestamp", "update", GroupStateTimeout.NoTimeout)


def write_once(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Processes what is there and stops; each micro-batch is written under its id, so that a replay replaces it."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
