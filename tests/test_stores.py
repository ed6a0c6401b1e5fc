"""Keyed state of streams and the bucketed seen-store, against their batch forms over the same rows."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import health, state
from millrace.operators.seen_table import SeenTable
from millrace.streaming import stores

T0 = datetime(2024, 1, 1)


def start(stream, folder):
    query = stream.writeStream.option("checkpointLocation", str(folder / "state")).outputMode("update").trigger(availableNow=True)
    seen = []
    query = query.foreachBatch(lambda batch, n: seen.extend(map(tuple, batch.collect()))).start()
    query.awaitTermination()
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"]]
    return seen, marks[-1] if marks else None


def test_seen_state_is_the_upsert(spark, tmp_path):
    """After every run of the stream: the state, with the watermark as now, and what counted as new; ids come back after they were forgotten."""
    rng, rows, held = random.Random(4), [], {}
    schema = "id string, seen_at timestamp"
    for run in range(4):
        new = [(rng.choice("abcdefgh"), T0 + timedelta(days=4 * run, minutes=rng.randrange(60 * 24 * 2))) for _ in range(7)] + ([(None, T0)] if run == 0 else [])
        rows += new
        spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        stream = stores.seen_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "log")), 3)
        out, mark = start(stream, tmp_path)
        assert {(r[0], r[3]) for r in out} == {(i, i not in held) for i, _ in new}
        now = datetime.fromisoformat(mark.rstrip("Z"))
        want = state.upsert_seen(spark.createDataFrame([], schema), spark.createDataFrame(rows, schema), F.lit(now), 3)
        held = {r["id"]: r["seen_at"] for r in want.collect()}
        assert {r["id"]: r["seen_at"] for r in stores.stored_seen(spark, str(tmp_path / "state")).collect()} == held
    assert len(held) < 8 < len(rows)


def test_seen_state_by_its_own_clock(spark, tmp_path):
    """Ids that come again after their time to live count as new."""
    schema, seen = "id string, seen_at timestamp", []
    (tmp_path / "log").mkdir()
    stream = stores.seen_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "log")), 1 / 86400, clock="processing")
    query = stream.writeStream.option("checkpointLocation", str(tmp_path / "state")).outputMode("update").trigger(processingTime="300 milliseconds")
    query = query.foreachBatch(lambda batch, n: seen.extend(map(tuple, batch.collect()))).start()
    try:
        for run in (1, 2):
            spark.createDataFrame([("a", T0), ("b", T0)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
            until = time.time() + 40
            while len(seen) < 2 * run and time.time() < until:
                time.sleep(0.2)
            time.sleep(1.5)
    finally:
        query.stop()
    assert sorted((r[0], r[3]) for r in seen) == [("a", True), ("a", True), ("b", True), ("b", True)]
    with pytest.raises(ValueError):
        stores.seen_stream(stream, clock="wall")


def test_health_state_in_any_order(spark, tmp_path):
    """Runs that come late, twice at one time, without raw counts: after every batch the state is that of the batch form."""
    rng, rows = random.Random(6), []
    schema = "source string, run_ts timestamp, passed long, raw long"
    runs = [(s, T0 + timedelta(hours=rng.randrange(30)), rng.choice([0, 0, 0, 2]), rng.choice([None, 0, 0, 3]) if s != "z" else None) for s in "xyz" for _ in range(14)]
    last = {}
    runs = [r for r in runs if last.setdefault(r[:2], r) is r or r[2] == last[r[:2]][2]]
    rng.shuffle(runs)
    for at in range(0, len(runs), 12):
        rows += runs[at : at + 12]
        spark.createDataFrame(runs[at : at + 12], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        start(stores.health_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "log"))), tmp_path)
        want = health.health(spark.createDataFrame(rows, schema))
        got = stores.stored_health(spark, str(tmp_path / "state")).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    spark.sql(f"CREATE DATABASE stores_test LOCATION '{tmp_path_factory.mktemp('db')}'")
    yield "stores_test"
    spark.sql("DROP DATABASE stores_test CASCADE")


def test_seen_table_is_the_upsert(spark, database):
    """Runs that overlap, days that go, batches with doubles, nulls and a hot id, against the batch form."""
    rng, rows = random.Random(9), []
    store = SeenTable(spark, f"{database}.seen", buckets=4, days=5)
    schema, empty = "id string, seen_at timestamp", spark.createDataFrame([], "id string, seen_at timestamp")
    for run in range(3):
        now = T0 + timedelta(days=3 * run + 3, hours=7)
        new = [(f"i{rng.randrange(60)}", now - timedelta(minutes=rng.randrange(60 * 72))) for _ in range(40)] + [("old", T0), (None, now), ("x", None)]
        rows += [r for r in new if None not in r]
        store.add(spark.createDataFrame(new, schema))
        want = state.upsert_seen(empty, spark.createDataFrame(rows, schema), F.lit(now), 5)
        assert sorted(map(tuple, store.rows(now).collect())) == sorted(map(tuple, want.collect()))
        batch = spark.createDataFrame([(f"i{n % 80}", n) for n in range(100)] + [("i1", 1)] * 300 + [(None, 0)] * 2, "id string, n long")
        fresh, counts = store.only_new(batch, now)
        expected = sorted(map(str, state.only_new(batch, want).collect()))
        assert sorted(map(str, fresh.collect())) == expected
        assert counts.get == {"new": len(expected), "duplicate": 402 - len(expected)}
    dropped = store.expire(now)
    assert dropped and all(d < (now - timedelta(days=5)).date() for d in dropped)
    assert sorted(map(tuple, store.rows(now).collect())) == sorted(map(tuple, want.collect()))
    assert SeenTable(spark, f"{database}.seen", buckets=99).buckets == 4


@pytest.mark.parametrize("n", [5, 2000])
def test_seen_table_is_not_shuffled(spark, database, n):
    """No exchange and no sort above the scan of the store; few ids reach the scan as a filter."""
    store = SeenTable(spark, f"{database}.plan", buckets=4)
    store.add(spark.range(3000).selectExpr("cast(id AS string) AS id", "timestamp '2024-01-01' AS seen_at"))
    marked = store.marked(spark.range(n).selectExpr("cast(id + 2998 AS string) AS id"), T0)
    assert marked.where("known").count() == 2
    lines = marked._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    above, level = [], depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < level:
            above, level = [*above, lines[i]], depth[i]
    join = next(i for i, line in enumerate(above) if "LeftSemi" in line)
    assert not any("Exchange" in line or "Sort " in line for line in above[: join + 1])
    assert "Bucketed: true" in lines[at] and ("In(id" in lines[at]) == (n == 5)
