"""Feed scans: fetching behind a function, RSS and Atom parsing, and the three streams' filters."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_catalogue_date, parse_feed_date
from ..functions.text import source_part, stable_id, strip, title_part, unescape_html
from ..functions.urls import dataset_code, dataset_url, search_url
from ..operators import filters
from ..schemas import FEED_ENTRY
from ..shipping import ship

RETRY_STATUSES = {403, 429, 503}


def parse_feed(body: str | bytes | None) -> list[tuple[str, str, str, str]]:
    """(title, link, content, published) of each RSS item or Atom entry; broken feeds have none."""
    try:
        root = ET.fromstring(body or "")
    except ET.ParseError:
        return []
    local = lambda e: e.tag.rpartition("}")[2]
    out = []
    for entry in root.iter():
        if local(entry) not in ("item", "entry"):
            continue
        got: dict[str, str] = {}
        for child in entry:
            text = "".join(child.itertext()).strip()
            if local(child) == "link" and not text:
                text = child.get("href", "")
            got.setdefault(local(child), text)
        pick = lambda *names: next((got[n] for n in names if got.get(n)), "")  # noqa: E731, B023
        out.append((pick("title"), pick("link", "id"), pick("encoded", "content", "summary", "description"), pick("published", "updated", "pubDate", "date")))
    return out


def answer(url: str, fetch: Callable[[str], tuple[int, bytes]], retry: Callable[[str], tuple[int, bytes]] | None = None) -> bytes | None:
    """The body of a feed. A refused, failed or empty answer (search feeds may be empty) is asked once more by ``retry``; None without one."""
    for call in (fetch, retry):
        if call is None:
            continue
        try:
            status, body = call(url)
        except Exception:  # noqa: BLE001 - any network failure leads to the retry
            continue
        if status == 200 and (filters.SEARCH_HOST in url or parse_feed(body)):
            return body
        if status != 200 and status not in RETRY_STATUSES:
            return None
    return None


def fetch_feeds(sources: DataFrame, fetch: Callable[[str], tuple[int, bytes]], retry: Callable[[str], tuple[int, bytes]] | None = None, concurrency: int = 16) -> DataFrame:
    """Entries of every source's feed, in one go; ``streaming.feed_log`` lands bodies and reads them as a stream."""
    ship(sources.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(n, i, *e) for n, u in zip(batch["name"], batch["url"], strict=True) for i, e in enumerate(parse_feed(answer(u, fetch, retry)))]
            yield pd.DataFrame(rows, columns=["source", "pos", "title", "link", "content", "published"])

    return sources.select("name", "url").repartition(concurrency).mapInPandas(run, FEED_ENTRY)


def entries_of(feeds: DataFrame) -> DataFrame:
    """Entries of feeds that are there already (source, body)."""
    ship(feeds.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(s, i, *e) for s, b in zip(batch["source"], batch["body"], strict=True) for i, e in enumerate(parse_feed(b))]
            yield pd.DataFrame(rows, columns=["source", "pos", "title", "link", "content", "published"])

    return feeds.select("source", "body").mapInPandas(run, FEED_ENTRY)


def _joined(entries: DataFrame, sources: DataFrame) -> DataFrame:
    config = sources.select(F.col("name").alias("source"), F.col("url").alias("source_url"), "country", "category", "keywords_filter", "lookback_hours")
    out = entries.join(config, "source").withColumn("title", unescape_html(F.col("title"))).withColumn("content", F.coalesce("content", F.lit("")))
    return out.withColumn("published_at", parse_feed_date(F.col("published"))).withColumn("link", strip(F.col("link")))


def articles(entries: DataFrame, sources: DataFrame, now: Column) -> DataFrame:
    """Article scan: media feeds, dated rows within the look-back, keywords; undated rows go."""
    rows = _joined(entries, sources.where("enabled and source_type = 'rss' and category = 'media'"))
    hours = filters.look_back_hours(F.col("lookback_hours"), F.col("source_url"))
    keep = filters.named(F.col("title"), F.col("link")) & F.col("published_at").isNotNull() & filters.recent(F.col("published_at"), now, hours)
    keep = keep & filters.article_match(F.col("title"), F.col("content"), F.col("keywords_filter"))
    return rows.where(keep).select(
        stable_id(F.col("link"), F.col("title")).alias("id"), "title", F.col("link").alias("url"), F.col("source").alias("source_name"), "published_at",
        F.substring("content", 1, 2500).alias("raw_content"), F.lit(3).alias("importance"), F.lit(False).alias("relevant"), F.lit(False).alias("classified"), F.col("pos"),
    )


def publications(entries: DataFrame, sources: DataFrame, now: Column) -> DataFrame:
    """Publication scan: official feeds, a week back, some undated rows, extended keywords; relevant until judged."""
    rows = _joined(entries, sources.where("enabled and source_type = 'rss' and category = 'official'")).where(filters.named(F.col("title"), F.col("link")))
    hours = filters.look_back_hours(F.col("lookback_hours"), F.lit(""), filters.PUBLICATION_HOURS)
    rows = rows.where(F.col("published_at").isNull() | filters.recent(F.col("published_at"), now, hours))
    rows = filters.undated_policy(rows, now).where(filters.publication_match(F.col("title"), F.col("content"), F.col("keywords_filter")))
    return rows.select(
        stable_id(F.col("link"), F.col("title")).alias("id"), "title", F.col("link").alias("url"), F.col("source").alias("source_name"), "country", "published_at",
        F.substring("content", 1, 500).alias("summary"), F.lit(True).alias("relevant"), F.lit(False).alias("classified"), F.col("pos"),
    )


def signal_queries(companies: DataFrame) -> DataFrame:
    """Two search feeds for each enabled company: its press query and its posts."""
    quoted = F.concat(F.lit('"'), F.col("name"), F.lit('"'))
    press = F.coalesce(F.nullif(strip(F.col("search_keywords")), F.lit("")), F.concat(F.col("name"), F.lit(" agriculture")))
    posts = F.concat(quoted, F.lit(" site:linkedin.com when:7d"))
    kinds = F.array(F.struct(F.lit("press").alias("query"), press.alias("text")), F.struct(F.lit("posts").alias("query"), posts.alias("text")))
    return companies.where("enabled").select(F.col("name").alias("company_name"), "company_type", F.explode(kinds).alias("q")).select("company_name", "company_type", "q.query", search_url(F.col("q.text")).alias("url"))


def signals(entries: DataFrame, now: Column) -> DataFrame:
    """Signal scan over entries (company_name, company_type, query, pos, title, link, published): look-back, noise and terms."""
    rows = entries.withColumn("published_at", parse_feed_date(F.col("published"))).withColumn("title", unescape_html(F.col("title")))
    rows = rows.where(filters.named(F.col("title"), F.col("link")) & filters.signal_recent(F.col("published_at"), now))
    rows = rows.withColumn("source_name", source_part(F.col("title"))).withColumn("title", title_part(F.col("title")))
    rows = rows.where(~filters.is_noise(F.col("title")) & filters.signal_match(F.col("title"), F.col("query")))
    source = F.when((F.col("source_name") == "") & (F.col("query") == "posts"), "LinkedIn").otherwise(F.col("source_name"))
    return rows.withColumn("source_name", source).withColumn("id", stable_id(F.col("link"), F.col("title")))


def catalogue_updates(items: DataFrame, prefixes: list[str], now: Column, hours: int = 48) -> DataFrame:
    """Dataset updates from a catalogue feed (title, link, pubDate, description, seq): the first row of each wanted code."""
    from ..operators.ranking import first_seen

    rows = items.withColumn("code", dataset_code(F.col("link"), F.col("title"), F.col("description"))).withColumn("published_at", parse_catalogue_date(F.col("pubDate")))
    rows = rows.where(F.col("code").isNotNull() & filters.dataset_prefix(F.col("code"), prefixes) & filters.recent(F.col("published_at"), now, F.lit(hours)))
    return first_seen(rows, F.col("code")).withColumn("url", dataset_url(F.col("code")))


#: What an item may hold; all lists, as any child may be there several times or not at all.
ITEM = "struct<title: array<string>, link: array<string>, pubDate: array<string>, description: array<string>>"


def xml_items(feeds: DataFrame, body: str = "body") -> DataFrame:
    """(source, seq, title, link, pubDate, description) of RSS 2.0 and RDF bodies, by Spark's typed XML reader.

    Every item is one struct, so a child that is missing or empty is null in its own item; of repeated children the first counts. Children of other
    namespaces have other names. CDATA is text, and markup within a child stays in its text. Bodies that are null or no XML give no items.
    """
    parsed = F.from_xml(F.col(body), f"channel struct<item: array<{ITEM}>>, item array<{ITEM}>", {"mode": "PERMISSIVE"})
    items = F.concat(*(F.coalesce(c, F.array().cast(f"array<{ITEM}>")) for c in (parsed["channel"]["item"], parsed["item"])))
    rows = feeds.select("source", F.posexplode(items).alias("seq", "item"))
    return rows.select("source", "seq", *(F.nullif(F.get(F.col(f"item.{c}"), F.lit(0)), F.lit("")).alias(c) for c in ("title", "link", "pubDate", "description")))
