"""Filters of the scans, and extraction out of pages and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import read_minutes
from ..operators import filters
from ..plans import adapters as A
from ..sinks import archive
from ..sources import extractors, feeds
from .registry import query


@query("lookback_filter", f"WITH {A.ARTICLES} SELECT seq FROM articles WHERE published_at >= TIMESTAMP '{A.NOW}' - to_hours(CASE WHEN seq % 4 = 0 THEN 72 WHEN seq % 4 = 1 THEN 336 ELSE 48 END)")
def lookback_filter(spark, sf_dir):
    url = F.when(F.col("seq") % 4 == 1, "https://news.google.com/rss").otherwise(F.col("url"))
    hours = filters.look_back_hours(F.when(F.col("seq") % 4 == 0, 72).otherwise(0), url)
    return A.articles(spark, sf_dir).where(filters.recent(F.col("published_at"), A.now(), hours)).select("seq")


@query("undated_policy", f"WITH {A.ARTICLES}, u AS (SELECT seq AS pos, source_name AS source, CASE WHEN seq % 2 = 0 THEN published_at END AS p FROM articles) SELECT pos, source, coalesce(p, TIMESTAMP '{A.NOW}') AS published_at FROM (SELECT *, row_number() OVER (PARTITION BY source, p IS NULL ORDER BY pos) AS n FROM u) WHERE p IS NOT NULL OR n <= 25")
def undated_policy(spark, sf_dir):
    rows = A.articles(spark, sf_dir).select(F.col("seq").alias("pos"), F.col("source_name").alias("source"), F.when(F.col("seq") % 2 == 0, F.col("published_at")).alias("published_at"))
    return filters.undated_policy(rows, A.now())


@query("keyword_prefilter", f"WITH {A.ARTICLES} SELECT seq FROM articles WHERE CASE WHEN seq % 3 = 0 THEN contains(lower(title || ' ' || content), 'tion') ELSE contains(lower(title || ' ' || content), 'ing') OR contains(lower(title || ' ' || content), 'eau') END")
def keyword_prefilter(spark, sf_dir):
    own = F.when(F.col("seq") % 3 == 0, F.array(F.lit("TION"))).otherwise(F.array().cast("array<string>"))
    return A.articles(spark, sf_dir, content=True).where(filters.article_match(F.col("title"), F.col("content"), own, ["ing", "eau"])).select("seq")


@query("keyword_extend", f"WITH {A.ARTICLES} SELECT seq FROM articles WHERE contains(lower(title || ' ' || content), 'ing') OR (seq % 3 = 0 AND contains(lower(title || ' ' || content), 'tion'))")
def keyword_extend(spark, sf_dir):
    own = F.when(F.col("seq") % 3 == 0, F.array(F.lit("tion")))
    return A.articles(spark, sf_dir, content=True).where(filters.publication_match(F.col("title"), F.col("content"), own, ["ing"])).select("seq")


@query("signal_filter", f"WITH {A.SIGNALS} SELECT seq FROM signals WHERE (seq % 6 = 0 OR published_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY) AND (seq % 2 = 0 OR contains(title, 'click'))")
def signal_filter(spark, sf_dir):
    published = F.when(F.col("seq") % 6 != 0, F.col("published_at"))
    keep = filters.signal_recent(published, A.now()) & filters.signal_match(F.col("title"), F.when(F.col("seq") % 2 == 0, "posts").otherwise("press"), ["click"])
    return A.signals(spark, sf_dir).where(keep).select("seq")


_TITLES = ["We're hiring: Head of Sales", "Now hiring interns", "Seed Market Size, 2024 - 2030", "Internal report", "Apply now for the grant", "Wheat up 2%", "Global forecast", "Request a sample today"]
_CASE = " ".join(f"WHEN {i} THEN '{t.replace(chr(39), chr(39) * 2)}'" for i, t in enumerate(_TITLES))
_NOISE = "|".join(p.replace("'", "''") for p in filters.NOISE_PATTERNS)


@query(
    "noise_filter",
    f"WITH t AS (SELECT doc_id, CASE doc_id % 8 {_CASE} END || ' ' || replace(text, chr(10), ' ') AS title FROM documents), m AS (SELECT *, regexp_extract(title, '(?i)({_NOISE})') AS hit FROM t) SELECT doc_id, title, hit <> '' AND NOT (contains(lower(hit), 'hiring') AND regexp_matches(title, '(?i){filters.SENIOR_ROLE}')) AS noise FROM m",
)
def noise_filter(spark, sf_dir):
    fixed = F.element_at(F.array(*[F.lit(t) for t in _TITLES]), (F.col("doc_id") % 8 + 1).cast("int"))
    title = F.concat_ws(" ", fixed, F.expr("replace(text, '\\n', ' ')"))
    return A.table(spark, sf_dir, "documents").select("doc_id", title.alias("title")).withColumn("noise", filters.is_noise(F.col("title")))


@query("dataset_prefix", "SELECT p_partkey, p_brand FROM part WHERE lower(p_brand) LIKE 'brand#1%' OR lower(p_brand) LIKE 'brand#22%'")
def dataset_prefix(spark, sf_dir):
    return A.table(spark, sf_dir, "part").where(filters.dataset_prefix(F.col("p_brand"), ["Brand#1", "brand#22"])).select("p_partkey", "p_brand")


@query("title_rules", f"WITH {A.ARTICLES} SELECT seq, starts_with(title, 'The') AS p, contains(lower(title), 'ing') OR contains(lower(title), 'eau') AS a, regexp_matches(title, '(?i)^[a-e]') AS r FROM articles")
def title_rules(spark, sf_dir):
    t = F.col("title")
    return A.articles(spark, sf_dir).select("seq", filters.title_rule(t, "prefix", ["The"]).alias("p"), filters.title_rule(t, "any", ["ing", "EAU"]).alias("a"), filters.title_rule(t, "regex", ["^[a-e]"]).alias("r"))


@query("signal_queries", "SELECT c_name AS company_name, q AS query, CASE q WHEN 'press' THEN c_name || ' agriculture' ELSE '\"' || c_name || '\" site:linkedin.com when:7d' END AS text FROM customer, (VALUES ('press'), ('posts')) v(q) WHERE c_acctbal > 0")
def signal_queries(spark, sf_dir):
    rows = feeds.signal_queries(A.companies(spark, sf_dir))
    text = F.url_decode(F.regexp_extract("url", r"\?q=(.*)&hl=en$", 1))
    return rows.select("company_name", "query", text.alias("text"))


@query("html_links", "SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS href FROM (SELECT page_id, regexp_extract_all(html, '<a\\s+href=\"([^\"]*)\"', 1) AS l FROM pages)")
def html_links(spark, sf_dir):
    return extractors.page_links(A.table(spark, sf_dir, "pages").select("page_id", "html"))


@query("html_title_h1", "SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS h1 FROM pages")
def html_title_h1(spark, sf_dir):
    title, h1 = extractors.page_head(F.col("html"))
    return A.table(spark, sf_dir, "pages").select("page_id", title.alias("title"), h1.alias("h1"))


@query("read_minutes", "WITH t AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<style.*?</style>', ' ', 'g'), '(?s)<title.*?</title>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g') AS x FROM pages) SELECT page_id, CAST(greatest(1, round_even(len(list_filter(regexp_split_to_array(x, '[\\s   \u0085　]+'), lambda w: w <> '')) / 230, 0)) AS INTEGER) AS minutes FROM t")
def minutes(spark, sf_dir):
    return A.table(spark, sf_dir, "pages").select("page_id", read_minutes(F.col("html")).alias("minutes"))


@query("json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark, sf_dir):
    return A.table(spark, sf_dir, "events").select("event_id", F.from_json("props", "struct<k:int>")["k"].alias("k"))


_CATEGORIES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in archive.CATEGORY_LABELS.items())


@query("archive_rows", f"WITH {A.ARTICLES} SELECT seq AS id, title, url, '' AS summary, CASE category {_CATEGORIES} END AS category, original_language AS tags, strftime(published_at, '%Y-%m-%d') AS day FROM articles")
def archive_rows(spark, sf_dir):
    rows = A.articles(spark, sf_dir).withColumn("id", F.col("seq")).withColumn("summary", F.lit(None).cast("string")).withColumn("tags", F.array("original_language"))
    return archive.archive_rows(rows).withColumn("tags", F.array_join("tags", ","))
