"""Feeds as a stream: ``spark.readStream.format("feed_log")``, with an offset for each source.

A poll of a source lands its body under the source and the poll's number; bodies aren't changed afterwards. The stream's offset is the last poll
of every source, so each micro-batch reads the polls since the last one, a batch that is repeated after a restart reads the same bodies, and sources
may come, go quiet and come back. Bodies are read and parsed in the tasks; the driver holds one number for each source.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..shipping import ship
from ..sources.feeds import answer, parse_feed
from ..sources.folders import partition_folder, partition_value, shared_path, whole_text

LOG_ENTRY = "source string, poll long, pos int, title string, link string, content string, published string"
POLLS_PER_TASK = 16


class FolderLog:
    """Landed bodies in ``<path>/source=<name>/poll=<number>/``; ``path`` is a folder that all executors share."""

    def __init__(self, path: str):
        self.root = shared_path(path)

    def latest(self) -> dict[str, int]:
        polls: dict[str, int] = {}
        for folder in self.root.glob("source=*/poll=*"):
            source = partition_value(folder.parent)
            if next(folder.glob("part-*"), None):
                polls[source] = max(polls.get(source, 0), int(partition_value(folder)))
        return polls

    def body(self, source: str, poll: int) -> str | None:
        """None where a source had no such poll."""
        return whole_text(self.root / partition_folder("source", source) / f"poll={poll}")


class FeedLogReader(DataSourceStreamReader):
    def __init__(self, path: str, polls: int):
        self.log, self.polls = FolderLog(path), polls

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.log.latest()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for source in sorted(end):
            for first in range(int(start.get(source, 0)) + 1, int(end[source]) + 1, self.polls):
                out.append(InputPartition((source, first, min(first + self.polls - 1, int(end[source])))))
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        source, first, last = partition.value
        for poll in range(first, last + 1):
            for pos, entry in enumerate(parse_feed(self.log.body(source, poll))):
                yield source, poll, pos, *entry

    def commit(self, end: dict) -> None:
        """Bodies stay: another stream may read them."""


class FeedLog(DataSource):
    """Options: ``path`` and ``pollsPerTask``."""

    @classmethod
    def name(cls) -> str:
        return "feed_log"

    def schema(self) -> str:
        return LOG_ENTRY

    def streamReader(self, schema) -> FeedLogReader:
        return FeedLogReader(self.options["path"], int(self.options.get("pollsPerTask", POLLS_PER_TASK)))


def read_feed_log(spark: SparkSession, path: str, polls_per_task: int = POLLS_PER_TASK) -> DataFrame:
    """The stream of entries (source, poll, pos, title, link, content, published)."""
    ship(spark)
    spark.dataSource.register(FeedLog)
    return spark.readStream.format("feed_log").option("path", path).option("pollsPerTask", polls_per_task).load()


def land(bodies: DataFrame, path: str) -> None:
    """Appends bodies (source, poll, body) to the log; polls count from 1 within each source, and one body belongs to each."""
    bodies.select("source", "poll", F.col("body").alias("value")).write.mode("append").partitionBy("source", "poll").text(path)


def poll_feeds(sources: DataFrame, poll: int, path: str, fetch: Callable, retry: Callable | None = None, concurrency: int = 16) -> None:
    """Asks every source (name, url) once, in the executors, and lands the answers that hold a feed as this ``poll``."""
    ship(sources.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(n, answer(u, fetch, retry)) for n, u in zip(batch["name"], batch["url"], strict=True)]
            found = [(n, b.decode("utf-8", "replace") if isinstance(b, bytes) else b) for n, b in found if b]
            yield pd.DataFrame(found, columns=["source", "body"])

    got = sources.select("name", "url").repartition(concurrency).mapInPandas(run, "source string, body string")
    land(got.withColumn("poll", F.lit(poll)), path)
