"""Explicit schemas of all entities, closed vocabularies and their defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCATION = "struct<place_name:string,country_iso:string,latitude:double,longitude:double>"
SOURCE = "name string, url string, category string, source_type string, country string, enabled boolean, keywords_filter array<string>, scraper_id string, lookback_hours int, max_silent_days int"
RECIPIENT = "name string, email string, active boolean, `group` string, is_primary boolean, lead_id string"
COMPANY = "name string, company_type string, search_keywords string, enabled boolean, priority string"
COUNTRY = "name string, region string, flag_emoji string, enabled boolean, has_scraper boolean, pan_regional_sources array<string>"
ARTICLE = f"id string, title string, url string, source_name string, published_at timestamp, original_language string, summary string, category string, tags array<string>, location {LOCATION}, relevant boolean, raw_content string, importance int, story_key string, classified boolean"
PUBLICATION = f"id string, title string, url string, source_name string, country string, flag_emoji string, published_at timestamp, original_language string, summary string, relevant boolean, location {LOCATION}, classified boolean"
SIGNAL = f"id string, title string, url string, company_name string, company_type string, signal_type string, summary string, source_name string, published_at timestamp, original_language string, location {LOCATION}, classified boolean, score int, angle string, story_key string, company_is_actor boolean"
BRIEF = "takeaway string, sections array<struct<label:string,text:string>>"
PSD_FACT = "Commodity_Code int, Country_Code string, Market_Year int, Month int, Attribute_Description string, Value double"
SEEN = "id string, seen_at timestamp"
HEALTH = "name string, streak int, fetch_streak int, last_seen timestamp, last_count int, last_raw_count int, last_run timestamp"
GEOCACHE = "place_name string, latitude double, longitude double, created_at timestamp"
SIDRA = "array<struct<D1C:string,D1N:string,D2C:string,D2N:string,D3C:string,D3N:string,D4C:string,D4N:string,V:string>>"
FEED_ENTRY = "source string, pos int, title string, link string, content string, published string"
USAGE = "stage string, model string, input_tokens bigint, output_tokens bigint, cache_read bigint, cache_write bigint, batch boolean"

# Closed vocabularies, each with the value that an unknown one becomes.
VOCABULARIES = {
    "source_category": (["media", "official", "company"], "media"),
    "source_type": (["rss", "scraper", "api", "google_news"], "rss"),
    "company_type": (["client", "prospect"], "prospect"),
    "recipient_group": (["internal", "client"], "internal"),
    "article_category": (["crop_production", "crop_land_use", "yields", "agtech", "climate_weather", "markets", "regulation", "company_news", "other"], "other"),
    "signal_type": (["market", "agtech", "regulation", "partnership", "executive", "product", "financial", "other"], "other"),
}


def coerce(col: Column, vocabulary: str) -> Column:
    """Values outside the vocabulary, null too, become its default."""
    values, default = VOCABULARIES[vocabulary]
    return F.when(col.isin(values), col).otherwise(F.lit(default))
