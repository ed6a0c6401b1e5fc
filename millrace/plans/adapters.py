"""The driver's tables as the engine's entities, and the same as SQL for the checks."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def now():
    return F.expr(f"timestamp_ntz'{NOW}'")


_CATEGORY = "element_at(array('crop_production','crop_land_use','yields','agtech','climate_weather','markets','regulation','company_news','other'), cast(doc_id % 9 as int) + 1)"


def articles(spark: SparkSession, sf_dir: str, content: bool = False) -> DataFrame:
    """Documents as articles; ``content`` adds the whole text."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(True).alias("known"))
    d = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return d.select(
        F.col("doc_id").alias("seq"),
        F.expr("substring(replace(text, '\\n', ' '), 1, 60)").alias("title"),
        F.concat(F.lit("https://x.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("source_name"),
        F.col("lang").alias("original_language"),
        F.expr(f"timestamp_ntz'{NOW}' - make_dt_interval(0, cast(doc_id % 96 as int))").alias("published_at"),
        F.expr(_CATEGORY).alias("category"),
        F.expr("cast(1 + (doc_id * 7) % 5 as int)").alias("importance"),
        F.expr("case when doc_id % 3 = 0 then concat('story-', doc_id % 40) else '' end").alias("story_key"),
        F.expr("coalesce(known, false)").alias("classified"),
        F.expr("coalesce(quality = 1, false)").alias("relevant"),
        *([F.coalesce("text", F.lit("")).alias("content")] if content else []),
    )


ARTICLES = f"""articles AS (
  SELECT d.doc_id AS seq, substr(replace(d.text, chr(10), ' '), 1, 60) AS title, 'https://x.example/' || d.doc_id AS url,
    d.source AS source_name, d.lang AS original_language, TIMESTAMP '{NOW}' - to_hours(d.doc_id % 96) AS published_at,
    (['crop_production','crop_land_use','yields','agtech','climate_weather','markets','regulation','company_news','other'])[d.doc_id % 9 + 1] AS category,
    CAST(1 + (d.doc_id * 7) % 5 AS INTEGER) AS importance, CASE WHEN d.doc_id % 3 = 0 THEN 'story-' || (d.doc_id % 40) ELSE '' END AS story_key,
    l.doc_id IS NOT NULL AS classified, coalesce(l.quality = 1, false) AS relevant, coalesce(d.text, '') AS content
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

# normal form of Latin titles, and the cluster of a story
NORM = "trim(regexp_replace(regexp_replace(lower(strip_accents({0})), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g'))"
CLUSTER = "CASE WHEN trim(story_key) <> '' THEN trim(story_key) ELSE 'title:' || " + NORM.format("title") + " END"


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, c = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.join(c, F.col("user_id") == F.col("c_custkey")).select(
        F.col("event_id").alias("seq"), F.col("c_name").alias("company_name"), F.when(F.col("c_custkey") % 2 == 0, "client").otherwise("prospect").alias("company_type"),
        F.concat_ws(" ", "event_type", F.lit("no"), k.cast("string")).alias("title"), F.col("event_type").alias("signal_type"), F.expr("cast(1 + floor(value) % 5 as int)").alias("score"),
        (k % 4 != 0).alias("company_is_actor"), F.concat(F.lit("k"), k.cast("string")).alias("story_key"), F.col("ts").alias("published_at"), F.lit(True).alias("classified"),
    )


SIGNALS = """signals AS (
  SELECT event_id AS seq, c_name AS company_name, CASE WHEN c_custkey % 2 = 0 THEN 'client' ELSE 'prospect' END AS company_type,
    event_type || ' no ' || CAST(json_extract_string(props, '$.k') AS VARCHAR) AS title, event_type AS signal_type, CAST(1 + floor(value) % 5 AS INTEGER) AS score,
    CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 <> 0 AS company_is_actor, 'k' || json_extract_string(props, '$.k') AS story_key, ts AS published_at
  FROM events JOIN customer ON user_id = c_custkey)"""


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.expr("element_at(array('high','medium','low'), cast(c_custkey % 3 as int) + 1)").alias("priority"), (F.col("c_acctbal") > 0).alias("enabled"),
        F.when(F.col("c_custkey") % 2 == 0, "client").otherwise("prospect").alias("company_type"), F.lit("").alias("search_keywords"),
    )


COMPANIES = "companies AS (SELECT c_name AS name, (['high','medium','low'])[c_custkey % 3 + 1] AS priority, c_acctbal > 0 AS enabled, CASE WHEN c_custkey % 2 = 0 THEN 'client' ELSE 'prospect' END AS company_type FROM customer)"


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions: production of each country, commodity, market year and month."""
    t = lambda n: table(spark, sf_dir, n)
    lines = t("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    joined = lines.join(t("part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")).join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy(F.col("n_name").alias("Country"), F.col("p_type").alias("Commodity"), F.year("l_shipdate").alias("Market_Year"), F.month("l_shipdate").alias("Month")).agg(F.sum("l_quantity").alias("Value"))


FACTS = """facts AS (
  SELECT n_name AS "Country", p_type AS "Commodity", CAST(year(l_shipdate) AS INTEGER) AS "Market_Year", CAST(month(l_shipdate) AS INTEGER) AS "Month", sum(l_quantity) AS "Value"
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4)"""
LATEST = """latest AS (SELECT "Country", "Commodity", "Market_Year", arg_max_null("Value", "Month") AS value, max("Month") AS revision FROM facts GROUP BY 1, 2, 3)"""


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select((F.col("n_regionkey") * 100 + F.col("n_nationkey")).alias("ord"), F.col("n_name").alias("name"), F.col("r_name").alias("region"))


COUNTRIES = "countries AS (SELECT n_regionkey * 100 + n_nationkey AS ord, n_name AS name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey)"


def crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("crop")).distinct()


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs by day and event type and user bucket; days without rows count 0, and a third of the sources has no raw count."""
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.concat_ws("-", "event_type", (F.col("user_id") % 30).cast("string")).alias("source"), "value", (F.col("user_id") % 3).alias("m"))
    counts = e.groupBy("day", "source").agg(F.count("*").alias("raw"), F.count_if(F.col("value") > 60).alias("passed"))
    days = e.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    sources = e.groupBy("source").agg(F.max("m").alias("m"))
    grid = sources.join(F.broadcast(days)).select("source", "m", F.explode(F.sequence("a", "b")).alias("day"))
    full = grid.join(counts, ["day", "source"], "left")
    return full.select(F.col("day").alias("run_ts"), "source", F.coalesce("passed", F.lit(0)).alias("passed"), F.when(F.col("m") != 0, F.coalesce("raw", F.lit(0))).alias("raw"))


RUN_LOG = """ev AS (SELECT CAST(ts AS DATE) AS day, event_type || '-' || (user_id % 30) AS source, value, user_id % 3 AS m FROM events),
cnt AS (SELECT day, source, count(*) AS raw, count_if(value > 60) AS passed FROM ev GROUP BY 1, 2),
grid AS (SELECT s.source, s.m, CAST(d AS DATE) AS day FROM (SELECT source, max(m) AS m FROM ev GROUP BY 1) s, (SELECT unnest(generate_series((SELECT min(day) FROM ev), (SELECT max(day) FROM ev), INTERVAL 1 DAY)) AS d)),
run_log AS (SELECT g.day AS run_ts, g.source, CAST(coalesce(c.passed, 0) AS BIGINT) AS passed, CASE WHEN g.m <> 0 THEN coalesce(c.raw, 0) END AS raw FROM grid g LEFT JOIN cnt c ON g.day = c.day AND g.source = c.source)"""


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return c.select(
        F.col("role").alias("stage"), F.expr("element_at(array('small','large','unlisted'), cast(conv_id % 3 as int) + 1)").alias("model"), (n * 400).alias("input_tokens"), (F.col("turn") * 100 + 7).alias("output_tokens"),
        (n * 3).alias("cache_read"), (F.col("turn") * 11).alias("cache_write"), (F.col("conv_id") % 2 == 0).alias("batch"),
    )


USAGE = """usage_ AS (SELECT role AS stage, (['small','large','unlisted'])[conv_id % 3 + 1] AS model, coalesce(length(text), 0) * 400 AS i, turn * 100 + 7 AS o, coalesce(length(text), 0) * 3 AS cr, turn * 11 AS cw, conv_id % 2 = 0 AS batch FROM conversations),
priced AS (SELECT *, (i * ri + o * ro + cw * ri * 1.25::DOUBLE + cr * ri * 0.1::DOUBLE) / 1000000 * CASE WHEN batch THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS cost FROM (
  SELECT *, CASE WHEN model = 'small' THEN CASE WHEN i + cr + cw > 100000 THEN 0.5::DOUBLE ELSE 0.1::DOUBLE END ELSE 3.0::DOUBLE END AS ri,
    CASE WHEN model = 'small' THEN CASE WHEN i + cr + cw > 100000 THEN 2.5::DOUBLE ELSE 0.5::DOUBLE END ELSE 15.0::DOUBLE END AS ro FROM usage_))"""


def seen_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the documents, seen up to 40 days ago."""
    d = table(spark, sf_dir, "documents").where("doc_id % 5 = 0")
    return d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.expr(f"timestamp_ntz'{NOW}' - make_dt_interval(cast(doc_id % 41 as int))").alias("seen_at"))


SEEN = f"seen AS (SELECT 'd' || doc_id AS id, TIMESTAMP '{NOW}' - to_days(CAST(doc_id % 41 AS INTEGER)) AS seen_at FROM documents WHERE doc_id % 5 = 0)"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which driver and executors share, for queries that write and read back."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = os.path.join(tempfile.gettempdir(), "millrace-scratch")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
