"""Seen-stores, upserts, watermarks and run markers, as immutable versions of small tables."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TTL_DAYS, KEPT_VERSIONS = 30, 5


def only_new(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose id is not in the store. Doubles within the batch stay."""
    return batch.join(seen.select("id"), "id", "left_anti")


def marked(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """``batch`` with ``known``: whether the store holds the row's id; one join for the new rows and for the counts of both."""
    ids = seen.select("id").distinct().withColumn("known", F.lit(True))
    return batch.join(ids, "id", "left").withColumn("known", F.coalesce("known", F.lit(False))).select(*batch.columns, "known")


def split_new(batch: DataFrame, seen: DataFrame, *, distinct_within_batch: bool = False) -> tuple[DataFrame, DataFrame]:
    """(new rows, one row with the counts of new and duplicate rows)."""
    fresh = only_new(batch, seen)
    if distinct_within_batch:
        fresh = fresh.dropDuplicates(["id"])
    marked = batch.select("id").join(seen.select("id").distinct().withColumn("old", F.lit(True)), "id", "left")
    return fresh, marked.agg(F.count_if(F.col("old").isNull()).alias("new"), F.count_if(F.col("old")).alias("duplicate"))


def processed(batch: DataFrame, now: Column) -> DataFrame:
    """Entries for the store: rows that were classified, whatever the verdict; failed rows are tried again."""
    return batch.where(F.col("classified")).select("id", now.alias("seen_at"))


def upsert_seen(store: DataFrame, entries: DataFrame, now: Column, days: int = TTL_DAYS) -> DataFrame:
    """The store with the entries, latest time for each id, without those ``days`` old or older."""
    both = store.select("id", "seen_at").unionByName(entries.select("id", "seen_at"))
    return both.groupBy("id").agg(F.max("seen_at").alias("seen_at")).where(F.col("seen_at") > now - F.make_dt_interval(F.lit(days)))


def upsert(table: DataFrame, rows: DataFrame, key: str, version: str) -> DataFrame:
    """The row of the highest version for each key."""
    both = table.unionByName(rows)
    return both.groupBy(key).agg(F.max_by(F.struct(*[c for c in both.columns if c != key]), version).alias("r")).select(key, "r.*")


def newer_than(rows: DataFrame, state: DataFrame, column: str) -> DataFrame:
    """Rows above the known high-water mark (one row, column ``last``); all rows where nothing is known."""
    last = state.agg(F.max("last").alias("_last"))
    return rows.join(F.broadcast(last), F.col("_last").isNull() | (F.col(column) > F.col("_last"))).drop("_last")


def _hadoop(spark: SparkSession, path: str):
    """(Hadoop's file system of ``path``, a maker of its paths), so that any store that Spark reads will do."""
    jvm = spark._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of a state table's committed versions, oldest first: by version, as text, then by the time of the commit."""
    fs, make = _hadoop(spark, path)
    if not fs.exists(make(path)):
        return []
    found = []
    for folder in fs.listStatus(make(path)):
        name, done = folder.getPath().getName(), make(folder.getPath(), "_SUCCESS")
        if name.startswith("version=") and fs.exists(done):
            found.append((name.removeprefix("version=").partition("~")[0], fs.getFileStatus(done).getModificationTime(), name))
    return [name for *_, name in sorted(found)]


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A state table's newest version, empty where there is none yet. Only that version's folder is read."""
    empty = spark.createDataFrame([], schema)
    held = versions(spark, path)
    return spark.read.schema(empty.schema).parquet(f"{path}/{held[-1]}") if held else empty


def write_state(df: DataFrame, path: str, version: str, keep: int = KEPT_VERSIONS) -> str:
    """Writes a new version beside the old ones and removes all but the last ``keep``; versions sort as text (a run's time), and readers take the last.

    A version counts only once its files are committed, so a run that dies leaves the old version in force. Runs that write one version
    at the same time don't touch each other: each has a folder of its own, and the later commit is read.
    """
    target = f"{path}/version={version}~{uuid.uuid4().hex[:12]}"
    df.write.parquet(target)
    fs, make = _hadoop(df.sparkSession, path)
    for old in versions(df.sparkSession, path)[: -max(1, keep)]:
        fs.delete(make(f"{path}/{old}"), True)
    return target


def sent_marker(spark: SparkSession, path: str, day: str) -> bool:
    """True the first time that a day is marked: the one that makes the day's file, which can be made once, sends."""
    fs, make = _hadoop(spark, path)
    try:
        fs.create(make(f"{path}/sent={day}"), False).close()
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()) or fs.exists(make(f"{path}/sent={day}")):
            return False
        raise
