"""Stories, radar, deduplication and matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import flag_emoji
from ..operators import classify, filters, grouping, matrix, ranking, state
from ..plans import adapters as A
from ..plans import daily
from .registry import query

_RANKED = f"""clustered AS (SELECT *, {A.CLUSTER} AS cluster FROM articles),
reps AS (SELECT *, count(*) OVER (PARTITION BY cluster) AS size, min(seq) OVER (PARTITION BY cluster) AS first_seq,
  row_number() OVER (PARTITION BY cluster ORDER BY importance DESC, published_at DESC, seq) AS rn FROM clustered)"""
_CAP = ", capped AS (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY importance DESC, size DESC, published_at DESC, first_seq) AS sn FROM reps WHERE rn = 1)"
_STORY = ["cluster", "size", "seq", "title", "source_name", "importance", "published_at", "category"]


@query("top_stories", f"WITH {A.ARTICLES}, {_RANKED}{_CAP} SELECT {', '.join(_STORY)} FROM capped WHERE sn <= 2 ORDER BY importance DESC, size DESC, published_at DESC, first_seq LIMIT 12")
def top_stories(spark, sf_dir):
    return ranking.top_stories(A.articles(spark, sf_dir)).select(*_STORY)


@query("top_stories_uncapped", f"WITH {A.ARTICLES}, {_RANKED} SELECT {', '.join(_STORY)} FROM reps WHERE rn = 1")
def top_stories_uncapped(spark, sf_dir):
    return ranking.top_stories(A.articles(spark, sf_dir), limit=None, per_source=None).select(*_STORY)


_GROUPS = f"""grouped AS (SELECT s.*, {A.CLUSTER} AS cluster FROM signals s),
acc AS (SELECT g.*, count(*) OVER (PARTITION BY company_name, cluster) AS sources, row_number() OVER (PARTITION BY company_name, cluster ORDER BY score DESC, published_at DESC, seq) AS rn FROM grouped g),
able AS (SELECT a.*, CASE c.priority WHEN 'high' THEN 0 WHEN 'low' THEN 2 ELSE 1 END AS priority_rank FROM acc a LEFT JOIN companies c ON a.company_name = c.name WHERE rn = 1)"""


@query("radar", f"WITH {A.SIGNALS}, {A.COMPANIES}, {_GROUPS} SELECT company_name, cluster, sources, score, priority_rank, published_at, seq FROM able WHERE score >= 4 AND company_is_actor ORDER BY score DESC, priority_rank, published_at DESC, seq LIMIT 5")
def radar(spark, sf_dir):
    return ranking.radar(A.signals(spark, sf_dir), A.companies(spark, sf_dir)).select("company_name", "cluster", "sources", "score", "priority_rank", "published_at", "seq")


@query("radar_more", f"WITH {A.SIGNALS}, {A.COMPANIES}, {_GROUPS} SELECT count(*) AS groups, least(count_if(score >= 4 AND company_is_actor), 5) AS shown, greatest(0, count(*) - least(count_if(score >= 4 AND company_is_actor), 5)) AS more FROM able")
def radar_more(spark, sf_dir):
    return ranking.radar_more(A.signals(spark, sf_dir), A.companies(spark, sf_dir))


@query("signal_title_dedup", f"WITH {A.SIGNALS} SELECT seq, title, company_name FROM (SELECT *, row_number() OVER (PARTITION BY {A.NORM.format('title')} ORDER BY seq) AS rn FROM signals) WHERE rn = 1")
def signal_title_dedup(spark, sf_dir):
    return ranking.distinct_titles(A.signals(spark, sf_dir)).select("seq", "title", "company_name")


@query("per_source_recency_cap", f"WITH {A.ARTICLES} SELECT seq, source_name, published_at FROM (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY published_at DESC, seq) AS rn FROM articles) WHERE rn <= 15")
def per_source_recency_cap(spark, sf_dir):
    return ranking.latest_per_source(A.articles(spark, sf_dir)).select("seq", "source_name", "published_at")


@query("first_n_cap", f"WITH {A.SIGNALS} SELECT seq, company_name FROM (SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY seq) AS rn FROM signals) WHERE rn <= 10")
def first_n_cap(spark, sf_dir):
    return ranking.first_per_company(A.signals(spark, sf_dir)).select("seq", "company_name")


@query("first_seen_url", f"WITH {A.ARTICLES} SELECT arg_min(seq, seq) AS seq, source_name FROM articles GROUP BY source_name")
def first_seen_url(spark, sf_dir):
    return ranking.first_seen(A.articles(spark, sf_dir), F.col("source_name")).select("seq", "source_name")


def _ids(spark, sf_dir):
    return A.articles(spark, sf_dir).withColumn("id", F.concat(F.lit("d"), F.col("seq").cast("string")))


@query("anti_join_new", f"WITH {A.ARTICLES}, {A.SEEN} SELECT 'd' || seq AS id, title FROM articles WHERE 'd' || seq NOT IN (SELECT id FROM seen)")
def anti_join_new(spark, sf_dir):
    return state.only_new(_ids(spark, sf_dir), A.seen_store(spark, sf_dir)).select("id", "title")


@query("new_counts", f"WITH {A.ARTICLES}, {A.SEEN} SELECT count_if('d' || seq NOT IN (SELECT id FROM seen)) AS new, count_if('d' || seq IN (SELECT id FROM seen)) AS duplicate FROM articles")
def new_counts(spark, sf_dir):
    return state.split_new(_ids(spark, sf_dir), A.seen_store(spark, sf_dir))[1]


@query(
    "stream_counters",
    f"WITH {A.ARTICLES}, {A.SEEN}, m AS (SELECT *, 'd' || seq IN (SELECT id FROM seen) AS known FROM articles) SELECT 'article' AS stream, count(*) AS fetched, count_if(known) AS duplicate, count_if(NOT known AND NOT classified) AS unclassified, count_if(NOT known AND classified AND NOT relevant) AS rejected, count_if(NOT known AND classified AND relevant) AS accepted FROM m",
)
def stream_counters(spark, sf_dir):
    """The counters of a stream, observed while its new rows are judged and written."""
    found = daily.judged(_ids(spark, sf_dir), A.seen_store(spark, sf_dir), lambda rows, kind: rows, "article", F.col("relevant"))
    return daily.counter_rows(spark, {"article": found})


@query(
    "seen_upsert_ttl",
    f"WITH {A.ARTICLES}, {A.SEEN} SELECT id, max(seen_at) AS seen_at FROM (SELECT * FROM seen UNION ALL SELECT 'd' || seq, TIMESTAMP '{A.NOW}' FROM articles WHERE classified) GROUP BY id HAVING max(seen_at) > TIMESTAMP '{A.NOW}' - INTERVAL 30 DAY",
)
def seen_upsert_ttl(spark, sf_dir):
    return state.upsert_seen(A.seen_store(spark, sf_dir), state.processed(_ids(spark, sf_dir), A.now()), A.now())


@query("high_water_mark", f"WITH {A.FACTS} SELECT * FROM facts WHERE \"Market_Year\" > 1999")
def high_water_mark(spark, sf_dir):
    known = spark.range(1).select(F.lit(1999).alias("last"))
    return state.newer_than(A.facts(spark, sf_dir), known, "Market_Year")


_KEYS = ["Country", "Commodity", "Market_Year"]


def _latest(spark, sf_dir):
    return matrix.latest_revision(A.facts(spark, sf_dir), _KEYS)


@query("psd_latest_revision", f"WITH {A.FACTS}, {A.LATEST} SELECT * FROM latest")
def psd_latest_revision(spark, sf_dir):
    return _latest(spark, sf_dir)


_YOY = """yoy AS (SELECT name, crop, value, CASE WHEN previous > 0 THEN round((value - previous) / previous * 100, 1) END AS yoy_pct FROM (
  SELECT "Country" AS name, "Commodity" AS crop, max(CASE WHEN "Market_Year" = 2000 THEN value END) AS value, max(CASE WHEN "Market_Year" = 1999 THEN value END) AS previous FROM latest GROUP BY 1, 2) WHERE value IS NOT NULL)"""
_LONG = f"WITH {A.FACTS}, {A.LATEST}, {A.COUNTRIES}, {_YOY}, crops AS (SELECT DISTINCT p_type AS crop FROM part), long AS (SELECT c.ord, c.name, c.region, k.crop, y.value, y.yoy_pct FROM countries c CROSS JOIN crops k LEFT JOIN yoy y ON y.name = c.name AND y.crop = k.crop QUALIFY count(y.value) OVER (PARTITION BY c.name) > 0)"


def _long(spark, sf_dir):
    return matrix.matrix_long(_latest(spark, sf_dir), A.countries(spark, sf_dir), A.crops(spark, sf_dir), 2000)


@query("psd_matrix_long", f"{_LONG} SELECT * FROM long")
def psd_matrix_long(spark, sf_dir):
    return _long(spark, sf_dir).select("ord", "name", "region", "crop", "value", "yoy_pct")


_CROPS = ["ECONOMY", "STANDARD", "PROMO", "SMALL", "MEDIUM", "LARGE"]


@query(
    "psd_matrix_wide",
    f"{_LONG} SELECT ord, name, region, " + ", ".join(f"max(CASE WHEN crop = '{c}' THEN value END) AS \"{c}_value\", max(CASE WHEN crop = '{c}' THEN yoy_pct END) AS \"{c}_yoy_pct\"" for c in _CROPS) + " FROM long GROUP BY 1, 2, 3",
)
def psd_matrix_wide(spark, sf_dir):
    return matrix.matrix_wide(_long(spark, sf_dir), _CROPS)


@query("psd_yoy", f"WITH {A.FACTS}, {A.LATEST} SELECT \"Country\", \"Commodity\", \"Market_Year\", value, CASE WHEN py = \"Market_Year\" - 1 AND pv > 0 THEN round((value - pv) / pv * 100, 1) END AS yoy_pct FROM (SELECT *, lag(value) OVER w AS pv, lag(\"Market_Year\") OVER w AS py FROM latest WINDOW w AS (PARTITION BY \"Country\", \"Commodity\" ORDER BY \"Market_Year\"))")
def psd_yoy(spark, sf_dir):
    return matrix.year_on_year_all(_latest(spark, sf_dir), ["Country", "Commodity"]).drop("revision")


@query("psd_movers", f"{_LONG} SELECT name, crop, value, yoy_pct FROM long WHERE value >= 100 AND yoy_pct IS NOT NULL ORDER BY abs(yoy_pct) DESC, ord, crop LIMIT 5")
def psd_movers(spark, sf_dir):
    return ranking.movers(_long(spark, sf_dir).withColumn("pos", F.struct("ord", "crop")), floor=100.0).select("name", "crop", "value", "yoy_pct")


@query("psd_latest_period", f"WITH {A.FACTS} SELECT max(\"Market_Year\") AS latest_year, max(\"Month\") FILTER (WHERE \"Market_Year\" = (SELECT max(\"Market_Year\") FROM facts)) AS latest_month FROM facts")
def psd_latest_period(spark, sf_dir):
    return matrix.latest_period(A.facts(spark, sf_dir))


@query("region_bands", f"WITH {A.COUNTRIES} SELECT ord, name, region, region IS DISTINCT FROM lag(region) OVER (ORDER BY ord) AS new_band FROM countries")
def region_bands(spark, sf_dir):
    return matrix.region_bands(A.countries(spark, sf_dir))


@query("release_detect", f"WITH {A.FACTS}, p AS (SELECT \"Country\", max(\"Market_Year\") AS y, arg_max(\"Month\", \"Market_Year\" * 100 + \"Month\") AS m FROM facts GROUP BY 1) SELECT \"Country\", y AS latest_year, m AS latest_month, (y <> 2001 OR m <> 11) AS is_new FROM p")
def release_detect(spark, sf_dir):
    p = A.facts(spark, sf_dir).groupBy("Country").agg(F.max(F.struct("Market_Year", "Month")).alias("p")).select("Country", F.col("p.Market_Year").alias("latest_year"), F.col("p.Month").alias("latest_month"))
    return p.withColumn("is_new", matrix.is_new_release(F.col("latest_year"), F.col("latest_month"), F.lit(2001), F.lit(11)))


@query("dataset_routing", f"WITH {A.COUNTRIES} SELECT name, metric, CASE WHEN region = 'EUROPE' AND metric = 'area' THEN 'union_area' ELSE 'global' END AS dataset FROM countries, (VALUES ('area'), ('production')) m(metric)")
def dataset_routing(spark, sf_dir):
    rows = A.countries(spark, sf_dir).withColumn("metric", F.explode(F.array(F.lit("area"), F.lit("production"))))
    return rows.select("name", "metric", matrix.routed_dataset(F.col("region") == "EUROPE", F.col("metric")).alias("dataset"))


@query("pivot_top6", f"WITH {A.FACTS} SELECT \"Country\", sum(CASE WHEN \"Commodity\" = 'ECONOMY' THEN \"Value\" END) AS \"ECONOMY\", sum(CASE WHEN \"Commodity\" = 'PROMO' THEN \"Value\" END) AS \"PROMO\" FROM facts GROUP BY 1 ORDER BY coalesce(\"ECONOMY\", 0) DESC, 1 LIMIT 6")
def pivot_top6(spark, sf_dir):
    sums = A.facts(spark, sf_dir).groupBy("Country", "Commodity").agg(F.sum("Value").alias("Value"))
    return matrix.pivot_top(sums, group="Country", variable="Commodity", value="Value", order_by="ECONOMY", variables=["ECONOMY", "PROMO"])


@query("category_counts", f"WITH {A.ARTICLES} SELECT category, count(*) AS n, min(seq) AS first_seq FROM articles GROUP BY 1")
def category_counts(spark, sf_dir):
    return grouping.category_counts(A.articles(spark, sf_dir))


@query("company_groups", f"WITH {A.SIGNALS} SELECT company_name, count(*) AS n, string_agg(title, ' | ' ORDER BY seq) AS titles FROM signals GROUP BY 1")
def company_groups(spark, sf_dir):
    return grouping.company_groups(A.signals(spark, sf_dir))


@query("union_streams", f"WITH {A.ARTICLES}, {A.SIGNALS} SELECT stream, count(*) AS n, min(seq) AS first_seq FROM (SELECT 'article' AS stream, seq FROM articles UNION ALL SELECT 'signal', seq FROM signals) GROUP BY 1")
def union_streams(spark, sf_dir):
    rows = grouping.union_streams(article=A.articles(spark, sf_dir).select("seq", "title"), signal=A.signals(spark, sf_dir).select("seq", "company_name"))
    return rows.groupBy("stream").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))


@query("split_accounts", f"WITH {A.SIGNALS} SELECT 'client' AS kind, count(*) AS n FROM signals WHERE company_type = 'client' UNION ALL SELECT 'prospect', count(*) FROM signals WHERE company_type = 'prospect'")
def split_accounts(spark, sf_dir):
    clients, prospects = filters.split_accounts(A.signals(spark, sf_dir))
    return clients.agg(F.lit("client").alias("kind"), F.count("*").alias("n")).unionByName(prospects.agg(F.lit("prospect").alias("kind"), F.count("*").alias("n")))


@query("relevance", f"WITH {A.ARTICLES} SELECT seq, category FROM articles WHERE relevant")
def relevance(spark, sf_dir):
    return filters.relevant_articles(A.articles(spark, sf_dir)).select("seq", "category")


@query("chunk_assign", f"WITH {A.ARTICLES}, n AS (SELECT seq, row_number() OVER (ORDER BY seq) - 1 AS r FROM articles) SELECT seq, CAST(r // 5 AS VARCHAR) AS chunk_id, CAST(r % 5 AS INTEGER) AS item_index FROM n")
def chunk_assign(spark, sf_dir):
    return classify.chunks(A.articles(spark, sf_dir), 5).select("seq", "chunk_id", "item_index")


@query(
    "chunk_result_join",
    f"WITH {A.ARTICLES}, n AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS r FROM articles), c AS (SELECT seq, CAST(r // 5 AS VARCHAR) AS chunk_id, CAST(r % 5 AS INTEGER) AS item_index, category FROM n) SELECT seq, chunk_id, item_index, item_index < 4 AS classified, CASE WHEN item_index < 4 THEN CASE WHEN seq % 7 = 0 THEN 'other' ELSE category END END AS category FROM c",
)
def chunk_result_join(spark, sf_dir):
    items = classify.chunks(A.articles(spark, sf_dir), 5)
    answer = F.to_json(F.struct("item_index", F.when(F.col("seq") % 7 == 0, "no such").otherwise(F.col("category")).alias("category")))
    raw = items.where("item_index < 4").groupBy("chunk_id").agg(F.concat(F.lit("["), F.array_join(F.collect_list(answer), ","), F.lit(',{"item_index":-1},{"item_index":99}]')).alias("json"))
    out = classify.judge_articles(classify.apply_results(items.drop("classified", "relevant", "importance", "story_key"), classify.parse_results(raw, "article")))
    return out.select("seq", "chunk_id", "item_index", "classified", F.when(F.col("classified"), F.col("category")).alias("category"))


@query("clamp_scores", f"WITH {A.SIGNALS}, v AS (SELECT seq, company_is_actor, CASE seq % 4 WHEN 0 THEN '9' WHEN 1 THEN 'x' WHEN 2 THEN CAST(score AS VARCHAR) END AS raw FROM signals), c AS (SELECT seq, company_is_actor, coalesce(least(greatest(try_cast(raw AS INTEGER), 1), 5), 3) AS s FROM v) SELECT seq, CASE WHEN company_is_actor THEN s ELSE least(s, 2) END AS score FROM c")
def clamp_scores(spark, sf_dir):
    raw = F.when(F.col("seq") % 4 == 0, "9").when(F.col("seq") % 4 == 1, "x").when(F.col("seq") % 4 == 2, F.col("score").cast("string"))
    return A.signals(spark, sf_dir).select("seq", classify.signal_score(raw, F.col("company_is_actor")).alias("score"))


@query("label_maps", f"WITH {A.ARTICLES} SELECT seq, CASE category WHEN 'crop_production' THEN 'Production' WHEN 'crop_land_use' THEN 'Acreage' WHEN 'yields' THEN 'Yields' WHEN 'agtech' THEN 'Agtech' WHEN 'climate_weather' THEN 'Weather' WHEN 'markets' THEN 'Markets' WHEN 'regulation' THEN 'Regulation' WHEN 'company_news' THEN 'Company news' ELSE 'Other' END AS theme FROM articles")
def label_maps(spark, sf_dir):
    return A.articles(spark, sf_dir).select("seq", grouping.label(F.col("category"), grouping.THEMES, "Other").alias("theme"))


@query("dataset_labels", "SELECT page_id, code, CASE code WHEN '1' THEN 'one' WHEN '2' THEN 'two' ELSE code END AS label FROM (SELECT page_id, CAST(page_id % 4 AS VARCHAR) AS code FROM pages)")
def dataset_labels(spark, sf_dir):
    names = spark.range(1, 3).select(F.col("id").cast("string").alias("code"), F.when(F.col("id") == 1, "one").otherwise("two").alias("label"))
    return grouping.dataset_labels(A.table(spark, sf_dir, "pages").select("page_id", (F.col("page_id") % 4).cast("string").alias("code")), names).select("page_id", "code", "label")


@query("flag_emoji", "SELECT n_name, upper(substr(n_name, 1, 2)) AS iso, chr(127397 + ascii(substr(upper(n_name), 1, 1))) || chr(127397 + ascii(substr(upper(n_name), 2, 1))) AS flag FROM nation")
def flags(spark, sf_dir):
    iso = F.upper(F.substring("n_name", 1, 2))
    return A.table(spark, sf_dir, "nation").select("n_name", iso.alias("iso"), flag_emoji(iso).alias("flag"))
