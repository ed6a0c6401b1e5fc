"""Source health, counters, cost and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters, geo, health, metrics
from ..plans import adapters as A
from .registry import query

_HEALTH = f"""WITH {A.RUN_LOG}, marks AS (SELECT source, max(CASE WHEN passed > 0 THEN run_ts END) AS last_seen, max(CASE WHEN raw > 0 THEN run_ts END) AS last_fetch, max(run_ts) AS last_run, arg_max(passed, run_ts) AS last_count, count(raw) AS tracked FROM run_log GROUP BY 1),
state AS (SELECT l.source, count_if(passed <= 0 AND (last_seen IS NULL OR run_ts > last_seen)) AS streak, CASE WHEN max(tracked) > 0 THEN count_if(raw <= 0 AND (last_fetch IS NULL OR run_ts > last_fetch)) END AS fetch_streak,
  max(last_seen) AS last_seen, max(last_count) AS last_count, max(last_run) AS last_run FROM run_log l JOIN marks m ON l.source = m.source GROUP BY l.source)"""


def _state(spark, sf_dir):
    return health.health(A.run_log(spark, sf_dir))


@query("health_streaks", f"{_HEALTH} SELECT * FROM state")
def health_streaks(spark, sf_dir):
    return _state(spark, sf_dir)


def _limits(spark, sf_dir):
    sources = A.run_log(spark, sf_dir).select("source").distinct()
    return sources.where(~F.col("source").endswith("7")).withColumn("limit", F.when(F.col("source").endswith("1"), 1).otherwise(3))


@query(
    "health_status",
    f"{_HEALTH}, st AS (SELECT s.source, streak, fetch_streak, CASE WHEN s.source LIKE '%7' THEN 3 WHEN s.source LIKE '%1' THEN 1 ELSE 3 END AS \"limit\" FROM state s) SELECT source, streak, fetch_streak, \"limit\", CASE WHEN fetch_streak IS NULL THEN 'SILENT' WHEN fetch_streak >= 3 THEN 'DEAD' ELSE 'QUIET' END AS status FROM st WHERE coalesce(fetch_streak >= 3, false) OR streak >= \"limit\"",
)
def health_status(spark, sf_dir):
    return health.health_status(_state(spark, sf_dir), _limits(spark, sf_dir)).select("source", "streak", "fetch_streak", "limit", "status")


@query("health_prune", f"{_HEALTH} SELECT source, streak FROM state WHERE source NOT LIKE '%7'")
def health_prune(spark, sf_dir):
    return health.prune_unknown(_state(spark, sf_dir), _limits(spark, sf_dir)).select("source", "streak")


@query("threshold_lookup", "SELECT n_name, CASE WHEN n_nationkey % 3 = 0 THEN CASE WHEN n_regionkey = 2 THEN 21 ELSE 3 END ELSE n_nationkey % 3 * 5 END AS lim FROM nation")
def threshold_lookup(spark, sf_dir):
    category = F.when(F.col("n_regionkey") == 2, "official").otherwise("media")
    return A.table(spark, sf_dir, "nation").select("n_name", health.silence_limit(F.col("n_nationkey") % 3 * 5, category).alias("lim"))


@query("source_counts", "SELECT event_type AS source, count(*) AS raw, count_if(value > 60) AS passed FROM events GROUP BY 1")
def source_counts(spark, sf_dir):
    return metrics.source_counts(A.table(spark, sf_dir, "events").withColumnRenamed("event_type", "source"), F.col("value") > 60)


@query("run_counters", f"WITH {A.ARTICLES}, d AS (SELECT *, seq % 5 = 0 AS dup FROM articles) SELECT count(*) AS fetched, count_if(dup) AS duplicate, count_if(NOT dup AND NOT classified) AS unclassified, count_if(NOT dup AND classified AND NOT relevant) AS rejected, count_if(NOT dup AND classified AND relevant) AS accepted FROM d")
def run_counters(spark, sf_dir):
    return metrics.run_counters(A.articles(spark, sf_dir).withColumn("duplicate", F.col("seq") % 5 == 0))


def _prices(spark):
    return spark.createDataFrame(metrics.PRICES, metrics.PRICE_SCHEMA)


_SUMS = "count(*) AS calls, CAST(sum(i) AS BIGINT) AS input_tokens, CAST(sum(o) AS BIGINT) AS output_tokens, CAST(sum(cr) AS BIGINT) AS cache_read, CAST(sum(cw) AS BIGINT) AS cache_write, round(sum(cost), 6) AS cost"


@query("cost_by_stage", f"WITH {A.USAGE} SELECT stage, {_SUMS} FROM priced GROUP BY 1")
def cost_by_stage(spark, sf_dir):
    return metrics.cost_table(A.usage(spark, sf_dir), _prices(spark))


@query("cost_by_model", f"WITH {A.USAGE} SELECT model, {_SUMS} FROM priced GROUP BY 1")
def cost_by_model(spark, sf_dir):
    return metrics.cost_by(A.usage(spark, sf_dir), _prices(spark), "model")


@query("cost_rollup", f"WITH {A.USAGE} SELECT stage, model, count(*) AS calls, round(sum(cost), 6) AS cost FROM priced GROUP BY GROUPING SETS ((stage), (model), ())")
def cost_rollup(spark, sf_dir):
    return metrics.cost_rollup(A.usage(spark, sf_dir), _prices(spark))


@query("geo_rate", "SELECT c_mktsegment, CASE WHEN count(*) > 0 THEN CAST(CAST(round_even(count_if(c_acctbal > 0) / count(*) * 100, 0) AS INTEGER) AS VARCHAR) || '% (' || count_if(c_acctbal > 0) || '/' || count(*) || ')' ELSE 'N/A' END AS rate FROM customer GROUP BY 1")
def geo_rate(spark, sf_dir):
    grouped = A.table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count_if(F.col("c_acctbal") > 0).alias("ok"), F.count("*").alias("n"))
    return grouped.select("c_mktsegment", metrics.rate_display(F.col("ok"), F.col("n")).alias("rate"))


@query(
    "geo_resolve",
    "SELECT c_custkey, CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey AS DOUBLE) WHEN n_regionkey <> 1 THEN CAST(100 + n_regionkey AS DOUBLE) END AS latitude, CASE WHEN n_nationkey % 2 = 0 THEN 'cache' WHEN n_regionkey <> 1 THEN 'centroid' END AS resolved_by FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def geo_resolve(spark, sf_dir):
    nation = A.table(spark, sf_dir, "nation")
    rows = A.table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat(F.lit("  "), F.lower("n_name")).alias("place_name"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("country_iso"))
    cache = nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("place_name"), F.col("n_nationkey").cast("double").alias("latitude"), F.lit(0.0).alias("longitude"))
    centroids = A.table(spark, sf_dir, "region").where("r_regionkey <> 1").select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("iso"), (F.col("r_regionkey") + 100.0).alias("lat"), F.lit(1.0).alias("lon"))
    return geo.resolve_places(rows, cache, centroids).select("c_custkey", "latitude", "resolved_by")


@query("places_to_ask", "SELECT lower(n_name) AS place_name FROM nation WHERE n_nationkey % 2 <> 0")
def places_to_ask(spark, sf_dir):
    nation = A.table(spark, sf_dir, "nation")
    return geo.places_to_ask(nation.select(F.col("n_name").alias("place_name")), nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("place_name")))


@query("flag_lookup", "SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN '🌍' WHEN n_nationkey % 5 = 1 THEN 'K' WHEN n_nationkey % 5 = 2 THEN 'F' ELSE '' END AS flag FROM nation")
def flag_lookup(spark, sf_dir):
    names = F.element_at(F.array(F.lit("global"), F.lit(" England "), F.lit("france"), F.lit("Nowhere"), F.lit("")), (F.col("n_nationkey") % 5 + 1).cast("int"))
    flags = spark.range(2).select(F.when(F.col("id") == 0, "UK").otherwise("France").alias("name"), F.when(F.col("id") == 0, "K").otherwise("F").alias("flag"))
    return geo.country_flags(A.table(spark, sf_dir, "nation").select("n_nationkey", names.alias("country")), flags).select("n_nationkey", "flag")


@query("source_verdicts", f"WITH {A.ARTICLES} SELECT source_name AS source, max(published_at) AS newest, count(*) AS entries, 'PASS' AS verdict, date_diff('day', CAST(max(published_at) AS DATE), DATE '2024-01-31') AS age_days FROM articles GROUP BY 1")
def source_verdicts(spark, sf_dir):
    rows = A.articles(spark, sf_dir).withColumnRenamed("source_name", "source")
    sources = rows.select("source").distinct().withColumn("error", F.lit(None).cast("string"))
    return metrics.source_verdicts(rows, sources, A.now()).select("source", "newest", "entries", "verdict", "age_days")


@query("recipient_groups", "WITH r AS (SELECT n_nationkey AS seq, 'g' || n_regionkey AS grp, n_name AS email, n_nationkey % 4 = 1 AS p FROM nation), x AS (SELECT grp, arg_min(email, (CASE WHEN p THEN 0 ELSE 1 END) * 1000 + seq) AS prim FROM r GROUP BY 1) SELECT r.grp AS \"group\", prim AS \"primary\", coalesce(string_agg(email, ',' ORDER BY seq) FILTER (WHERE email <> prim), '') AS cc FROM r JOIN x ON r.grp = x.grp GROUP BY 1, 2")
def recipient_groups(spark, sf_dir):
    rows = A.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("seq"), F.concat(F.lit("g"), F.col("n_regionkey").cast("string")).alias("group"), F.col("n_name").alias("email"), (F.col("n_nationkey") % 4 == 1).alias("is_primary"), F.lit(True).alias("active"))
    return metrics.recipient_groups(rows).withColumn("cc", F.array_join("cc", ","))


@query("drop_reasons", f"WITH {A.ARTICLES}, r AS (SELECT CASE WHEN seq % 11 = 0 THEN 'empty' WHEN seq % 13 = 0 THEN 'undated' WHEN published_at < TIMESTAMP '{A.NOW}' - INTERVAL 48 HOUR THEN 'old' WHEN NOT contains(lower(title), 'the') THEN 'keywords' END AS reason FROM articles) SELECT reason, count(*) AS n FROM r GROUP BY 1")
def drop_reasons(spark, sf_dir):
    a = A.articles(spark, sf_dir)
    reason = filters.drop_reason(F.when(F.col("seq") % 11 == 0, " ").otherwise(F.col("title")), F.col("url"), F.when(F.col("seq") % 13 != 0, F.col("published_at")), A.now(), F.lit(48), filters.contains_any(F.col("title"), ["the"]))
    return a.select(reason.alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
