"""The seen-store as a table in buckets by id: a run shuffles its batch to the store, never the store.

The table is partitioned by day, so that what is past the time to live goes by dropping days, and each day's files are bucketed and sorted by id, with a Parquet Bloom filter
on it. Runs append; an id counts by its latest time. A batch of few ids is looked up by them: Spark then opens only their buckets, and in these only what the Bloom filters don't rule out.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .state import TTL_DAYS

BUCKETS, FEW, SALTS = 64, 1000, 16


class SeenTable:
    def __init__(self, spark: SparkSession, name: str, *, buckets: int = BUCKETS, days: int = TTL_DAYS):
        """``name`` is made, with so many buckets, if it isn't there; a table that is there keeps its own."""
        self.spark, self.name, self.days = spark, name, days
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (id STRING, seen_at TIMESTAMP, day DATE) USING parquet OPTIONS ('parquet.bloom.filter.enabled#id' = 'true') "
            f"PARTITIONED BY (day) CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS"
        )
        found = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
        self.buckets = int(found["data_type"])

    def add(self, entries: DataFrame) -> None:
        """Appends (id, seen_at): one file for each day and bucket. Entries without id or time aren't kept."""
        rows = entries.where("id is not null and seen_at is not null").groupBy("id").agg(F.max("seen_at").alias("seen_at"))
        rows.withColumn("day", F.to_date("seen_at")).repartition(self.buckets, "id").write.insertInto(self.name)

    def live(self, now: datetime) -> DataFrame:
        """(id, seen_at) of what is younger than the time to live, days that are too old unread."""
        since = now - timedelta(days=self.days)
        return self.spark.table(self.name).where((F.col("day") >= F.lit(since.date())) & (F.col("seen_at") > F.lit(since)))

    def rows(self, now: datetime) -> DataFrame:
        """The store itself, as ``upsert_seen`` gives it: the buckets are summed up where they lie."""
        return self.live(now).groupBy("id").agg(F.max("seen_at").alias("seen_at"))

    def marked(self, batch: DataFrame, now: datetime) -> DataFrame:
        """``batch`` with ``known``: whether the store holds the row's id. The store is streamed past the batch's ids, bucket by bucket, unshuffled and unsorted. Null ids are never known."""
        ids = batch.select("id").where("id is not null").distinct()
        store, few = self.live(now).select("id"), [r["id"] for r in ids.limit(FEW + 1).collect()]
        if len(few) <= FEW:  # the same rows by way of less
            store = store.where(F.col("id").isin(few))
        found = store.join(ids.repartition(self.buckets, "id").hint("shuffle_hash"), "id", "left_semi").distinct()
        # an id that fills the batch is dealt out over several tasks; what was found is small
        salted = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("known", F.lit(True))
        dealt = batch.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(salted, ["id", "_salt"], "left")
        return dealt.withColumn("known", F.coalesce("known", F.lit(False))).select(*batch.columns, "known")

    def only_new(self, batch: DataFrame, now: datetime) -> tuple[DataFrame, Observation]:
        """(rows whose id the store doesn't hold, the counts ``new`` and ``duplicate``, which come with them). Read the counts after the rows."""
        counts = Observation()
        marked = self.marked(batch, now).observe(counts, F.count_if(~F.col("known")).alias("new"), F.count_if("known").alias("duplicate"))
        return marked.where(~F.col("known")).drop("known"), counts

    def expire(self, now: datetime) -> list[date]:
        """Drops the days that lie whole before the time to live, and says which."""
        since = (now - timedelta(days=self.days)).date()
        days = [date.fromisoformat(r["partition"].partition("=")[2]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]
        old = sorted(d for d in days if d < since)
        for day in old:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (day = DATE '{day}')")
        return old
