"""Source health: streaks of runs without rows, statuses, pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Runs without rows before a source counts as quiet, by category; failed fetches before it is dead.
MEDIA_LIMIT, OFFICIAL_LIMIT, DEAD_LIMIT = 3, 21, 3


def health(log: DataFrame) -> DataFrame:
    """State of each source after its runs (run_ts, source, passed, raw).

    streak: runs since the last one that passed rows. fetch_streak: runs with raw 0 since the last with raw rows; runs
    with null raw leave it as it is, and a source never tracked has null. Three aggregations on one key, no window.
    """
    run = F.col("run_ts")
    marks = log.groupBy("source").agg(
        F.max(F.when(F.col("passed") > 0, run)).alias("last_seen"),
        F.max(F.when(F.col("raw") > 0, run)).alias("last_fetch"),
        F.max(run).alias("last_run"),
        F.max_by("passed", run).alias("last_count"),
        F.count("raw").alias("tracked"),
    )
    joined = log.join(marks.select("source", "last_seen", "last_fetch"), "source")
    streaks = joined.groupBy("source").agg(
        F.count_if((F.col("passed") <= 0) & (F.col("last_seen").isNull() | (run > F.col("last_seen")))).alias("streak"),
        F.count_if((F.col("raw") <= 0) & (F.col("last_fetch").isNull() | (run > F.col("last_fetch")))).alias("fetch_streak"),
    )
    return marks.join(streaks, "source").select(
        "source", "streak", F.when(F.col("tracked") > 0, F.col("fetch_streak")).alias("fetch_streak"), "last_seen", "last_count", "last_run"
    )


def silence_limit(configured: Column, category: Column) -> Column:
    """The configured runs; 0 or null means the category's default."""
    return F.coalesce(F.nullif(configured, F.lit(0)), F.when(category == "official", F.lit(OFFICIAL_LIMIT)).otherwise(F.lit(MEDIA_LIMIT)))


def health_status(state: DataFrame, limits: DataFrame) -> DataFrame:
    """Sources that need a look: DEAD (fetching fails), QUIET (nothing passes) or SILENT (not tracked), dead first, longest streak next."""
    joined = state.join(limits, "source", "left").withColumn("limit", F.coalesce("limit", F.lit(MEDIA_LIMIT)))
    dead = F.coalesce(F.col("fetch_streak") >= DEAD_LIMIT, F.lit(False))
    status = F.when(F.col("fetch_streak").isNull(), "SILENT").when(dead, "DEAD").otherwise("QUIET")
    return joined.where(dead | (F.col("streak") >= F.col("limit"))).withColumn("status", status).orderBy((F.col("status") == "DEAD").desc(), F.desc("streak"), "source")


def prune_unknown(state: DataFrame, known: DataFrame) -> DataFrame:
    return state.join(known.select("source").distinct(), "source", "left_semi")
