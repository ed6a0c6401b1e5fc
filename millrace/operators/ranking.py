"""Story clusters, account radar, caps and first-seen deduplication.

Greedy selection with a cap per source equals taking each source's first k rows in rank order, so all of it is
``row_number``; Spark turns the rank limits into per-group limits before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import normalize_title, strip

# How many rows the selections show.
STORIES, STORIES_PER_SOURCE, RADAR, RADAR_SCORE, MOVERS, SOURCE_ROWS, COMPANY_ROWS = 12, 2, 5, 4, 5, 15, 10
EPOCH = "1970-01-01 00:00:00"


def _when(col: Column, like: DataFrame, name: str) -> Column:
    return F.coalesce(col, F.lit(EPOCH).cast(like.schema[name].dataType))


def story_cluster(story_key: Column, title: Column) -> Column:
    """The stripped key, or ``title:`` and the normal form of the title where there is none."""
    key = strip(F.coalesce(story_key, F.lit("")))
    return F.when(key != "", key).otherwise(F.concat(F.lit("title:"), normalize_title(title)))


def story_clusters(articles: DataFrame) -> DataFrame:
    """One row for each cluster: the row of the highest importance, then latest, then first, with the cluster's ``size``.

    One shuffle by cluster with partial aggregation; no row but the best of each partition travels.
    """
    at = _when(F.col("published_at"), articles, "published_at")
    columns = [c for c in articles.columns]
    rank = F.struct(F.col("importance").alias("i"), at.alias("t"), (-F.col("seq")).alias("s"))
    best = articles.withColumn("cluster", story_cluster(F.col("story_key"), F.col("title"))).groupBy("cluster").agg(
        F.max_by(F.struct(*columns), rank).alias("r"), F.count("*").alias("size"), F.min("seq").alias("first_seq")
    )
    return best.select("cluster", "size", "first_seq", "r.*")


def top_stories(articles: DataFrame, *, limit: int | None = STORIES, per_source: int | None = STORIES_PER_SOURCE) -> DataFrame:
    """Clusters by importance, size and recency; at most ``per_source`` of a source and ``limit`` in all."""
    stories = story_clusters(articles).withColumn("_t", _when(F.col("published_at"), articles, "published_at"))
    order = [F.desc("importance"), F.desc("size"), F.desc("_t"), F.asc("first_seq")]
    if per_source is not None:
        stories = stories.withColumn("_n", F.row_number().over(Window.partitionBy("source_name").orderBy(*order))).where(F.col("_n") <= per_source).drop("_n")
    if limit is None:
        return stories.drop("_t")
    return stories.orderBy(*order).limit(limit).drop("_t")


def account_signals(signals: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """One row for each company and story: the highest score, then latest, then first; ``sources`` counts its rows."""
    at = _when(F.col("published_at"), signals, "published_at")
    rank = F.struct(F.col("score").alias("i"), at.alias("t"), (-F.col("seq")).alias("s"))
    out = (
        signals.withColumn("cluster", story_cluster(F.col("story_key"), F.col("title")))
        .groupBy("company_name", "cluster")
        .agg(F.max_by(F.struct(*[c for c in signals.columns if c != "company_name"]), rank).alias("r"), F.count("*").alias("sources"))
        .select("company_name", "cluster", "sources", "r.*")
    )
    if companies is not None:
        out = out.join(companies.select(F.col("name").alias("company_name"), "priority"), "company_name", "left")
    else:
        out = out.withColumn("priority", F.lit(None).cast("string"))
    rank_of = F.when(F.col("priority") == "high", 0).when(F.col("priority") == "low", 2).otherwise(1)
    return out.withColumn("priority_rank", rank_of)


def radar(signals: DataFrame, companies: DataFrame | None = None, *, limit: int = RADAR, min_score: int = RADAR_SCORE) -> DataFrame:
    """The strongest moves that a company itself makes, its priority breaking ties."""
    eligible = account_signals(signals, companies).where((F.col("score") >= min_score) & F.col("company_is_actor"))
    at = _when(F.col("published_at"), signals, "published_at")
    return eligible.orderBy(F.desc("score"), F.asc("priority_rank"), at.desc(), F.asc("seq")).limit(limit)


def radar_more(signals: DataFrame, companies: DataFrame | None = None, *, limit: int = RADAR, min_score: int = RADAR_SCORE) -> DataFrame:
    """One row: how many groups, of any score, the radar doesn't show."""
    groups = account_signals(signals, companies)
    able = F.count_if((F.col("score") >= min_score) & F.col("company_is_actor"))
    return groups.agg(F.count("*").alias("groups"), F.least(able, F.lit(limit)).alias("shown")).withColumn("more", F.greatest(F.lit(0), F.col("groups") - F.col("shown")))


def first_seen(df: DataFrame, key: Column, order: str = "seq") -> DataFrame:
    """The first row of each key by ``order``; partial aggregation, no window over a hot key."""
    names = df.columns
    return df.withColumn("_k", key).groupBy("_k").agg(F.min_by(F.struct(*names), order).alias("r")).select("r.*")


def distinct_titles(signals: DataFrame) -> DataFrame:
    """Signals with one title, whatever the company, count once; the empty normal form is a title too."""
    return first_seen(signals, normalize_title(F.col("title")))


def latest_per_source(df: DataFrame, limit: int = SOURCE_ROWS) -> DataFrame:
    """The most recent rows of each source."""
    order = Window.partitionBy("source_name").orderBy(F.desc(_when(F.col("published_at"), df, "published_at")), F.asc("seq"))
    return df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= limit).drop("_n")


def first_per_company(df: DataFrame, limit: int = COMPANY_ROWS) -> DataFrame:
    """The first rows of each company in feed order."""
    order = Window.partitionBy("company_name").orderBy("seq")
    return df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= limit).drop("_n")


def movers(matrix: DataFrame, *, limit: int = MOVERS, floor: float = 1000.0) -> DataFrame:
    """The cells of a long matrix (country, crop, value, yoy_pct, pos) that moved most."""
    able = matrix.where((F.col("value") >= floor) & F.col("yoy_pct").isNotNull())
    return able.orderBy(F.abs("yoy_pct").desc(), "pos").limit(limit)
