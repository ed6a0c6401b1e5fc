"""State of streams over the events: what was seen, and how sources fare."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators.seen_table import SeenTable
from ..plans import adapters as A
from ..streaming import stores
from . import health  # noqa: F401 - its SQL is shared
from .registry import ORACLE_SQL, query


def _replayed(spark, rows, order: str, parts: int, path: str, made):
    """Lands ``rows`` in so many parts, by ranges of ``order``, and runs the stream that ``made`` makes of the log after each, from where it stopped: one batch with rows for a part, of any number of files."""
    bounds = rows.agg(F.min(order).cast("double"), F.max(order).cast("double")).first()
    at = F.least(F.lit(parts - 1), F.floor((F.col(order).cast("double") - bounds[0]) / max(1.0, bounds[1] - bounds[0]) * parts))
    for part in range(parts):
        rows.where(at == part).write.mode("append").parquet(f"{path}/log")
        stream = made(spark.readStream.schema(rows.schema).parquet(f"{path}/log"))
        stream.writeStream.option("checkpointLocation", f"{path}/state").outputMode("update").trigger(availableNow=True).foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/out/batch={n}")).start().awaitTermination()


@query(
    "seen_state",
    "WITH m AS (SELECT max(ts) AS now FROM events) SELECT user_id || '|' || event_type AS id, max(ts) AS seen_at FROM events, m GROUP BY 1, now HAVING max(ts) > now - INTERVAL 3 DAY",
)
def seen_state(spark, sf_dir):
    """A seen-store of three days as a stream's state, after five batches, read back from the checkpoint. Watermarks are whole milliseconds, so the rest of the last one is judged here."""
    path = A.scratch(spark, "seen")
    rows = A.table(spark, sf_dir, "events").select(F.concat(F.col("user_id").cast("string"), F.lit("|"), "event_type").alias("id"), F.col("ts").cast("timestamp").alias("seen_at"))
    _replayed(spark, rows, "seen_at", 5, path, lambda log: stores.seen_stream(log, 3))
    held = stores.stored_seen(spark, f"{path}/state").join(F.broadcast(rows.agg(F.max("seen_at").alias("now"))))
    return held.where("seen_at > now - interval 3 days").select("id", F.col("seen_at").cast("timestamp_ntz").alias("seen_at"))


@query("health_state", ORACLE_SQL["health_streaks"])
def health_state(spark, sf_dir):
    """Runs that come out of order, in three batches; the streaks are read from the stream's state, its maps of runs without rows."""
    path = A.scratch(spark, "health")
    log = A.run_log(spark, sf_dir).withColumn("run_ts", F.col("run_ts").cast("timestamp")).withColumn("turn", F.pmod(F.xxhash64("run_ts", "source"), F.lit(1000)))
    _replayed(spark, log, "turn", 3, path, stores.health_stream)
    return stores.stored_health(spark, f"{path}/state").withColumns({c: F.col(c).cast("date") for c in ("last_seen", "last_run")})


def _database(spark, sf_dir) -> str:
    """A database in a folder of its own; its tables' files lie there."""
    path = A.scratch(spark, "db")
    name = "millrace_" + path.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


_SEEN = "store AS (SELECT user_id || '|' || event_type AS id, ts FROM events WHERE ts < TIMESTAMP '2024-01-25'), batch AS (SELECT event_id, user_id || '|' || event_type AS id FROM events WHERE ts >= TIMESTAMP '2024-01-25'), live AS (SELECT DISTINCT id FROM store WHERE ts > TIMESTAMP '2024-01-20')"


@query("seen_table", f"WITH {_SEEN}, n AS (SELECT count_if(id NOT IN (SELECT id FROM live)) AS fresh, count_if(id IN (SELECT id FROM live)) AS old FROM batch) SELECT event_id, id, fresh, old FROM batch, n WHERE id NOT IN (SELECT id FROM live)")
def seen_table_new(spark, sf_dir):
    """A batch against a bucketed store of five days, written in two runs; the counts come with the rows."""
    e = A.table(spark, sf_dir, "events").select("event_id", F.concat_ws("|", "user_id", "event_type").alias("id"), F.col("ts").cast("timestamp").alias("seen_at"))
    store, now = SeenTable(spark, _database(spark, sf_dir) + ".seen", buckets=8, days=5), datetime(2024, 1, 25)
    for run in ("seen_at < '2024-01-22'", "seen_at >= '2024-01-22' and seen_at < '2024-01-25'"):
        store.add(e.where(run))
    fresh, counts = store.only_new(e.where("seen_at >= '2024-01-25'").select("event_id", "id"), now)
    path = A.scratch(spark, "fresh")
    fresh.write.parquet(path)
    return spark.read.parquet(path).select("event_id", "id", F.lit(counts.get["new"]).alias("fresh"), F.lit(counts.get["duplicate"]).alias("old"))


@query("seen_table_rows", "SELECT user_id || '|' || event_type AS id, max(ts) AS seen_at FROM events GROUP BY 1 HAVING max(ts) > TIMESTAMP '2024-01-29'")
def seen_table_rows(spark, sf_dir):
    """The store after its old days were dropped."""
    e = A.table(spark, sf_dir, "events").select(F.concat_ws("|", "user_id", "event_type").alias("id"), F.col("ts").cast("timestamp").alias("seen_at"))
    store, now = SeenTable(spark, _database(spark, sf_dir) + ".seen", buckets=8, days=5), datetime(2024, 2, 3)
    store.add(e.where("seen_at < '2024-01-22'"))
    store.add(e.where("seen_at >= '2024-01-15'"))
    store.expire(now)
    return store.rows(now).withColumn("seen_at", F.col("seen_at").cast("timestamp_ntz"))
