"""Configuration tables: property-typed pages with cursors, cached snapshots, and the views that scans use."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import COMPANY, COUNTRY, RECIPIENT, SOURCE, coerce

TABLES = {"sources": SOURCE, "recipients": RECIPIENT, "companies": COMPANY, "countries": COUNTRY}


def read_pages(query: Callable[[str | None], dict]) -> list[dict]:
    """All results of a paged query that returns results, has_more and next_cursor."""
    out, cursor = [], None
    while True:
        page = query(cursor)
        out += page.get("results", [])
        cursor = page.get("next_cursor")
        if not page.get("has_more") or not cursor:
            return out


#: Where a property of each declared type holds its value; texts count by their first part.
VALUE_PATHS = {
    "title": ".title[0].plain_text", "rich_text": ".rich_text[0].plain_text", "select": ".select.name", "url": ".url", "email": ".email", "checkbox": ".checkbox", "number": ".number",
}


def parsed_pages(pages: DataFrame, json: str = "json") -> DataFrame:
    """``pages`` with their JSON text as a variant, ``page``: each text is parsed once, whatever is read from it. Text that is no JSON gives null."""
    return pages.withColumn("page", F.try_parse_json(json))


def _base(name: str) -> str:
    return f"$.properties['{name}']"


def property_value(page: Column, name: str) -> Column:
    """A property of a page (a variant) as text, read where its declared type holds it; null where it is missing, empty or of another type."""
    kind, out = F.try_variant_get(page, _base(name) + ".type", "string"), F.lit(None).cast("string")
    for known, path in VALUE_PATHS.items():
        out = F.when(kind == known, F.try_variant_get(page, _base(name) + path, "string")).otherwise(out)
    return out


def property_choices(page: Column, name: str) -> Column:
    chosen = F.try_variant_get(page, _base(name) + ".multi_select", "array<struct<name:string>>")
    return F.coalesce(F.transform(chosen, lambda x: x["name"]), F.array().cast("array<string>"))


def property_state(page: Column, name: str) -> Column:
    """``missing`` where a page has no such property, ``empty`` where it is there without a value (null, or a list without parts), else ``held``; null where the page is no JSON."""
    kind = F.try_variant_get(page, _base(name) + ".type", "string")
    value, parts = F.lit(None).cast("variant"), F.lit(None).cast("array<variant>")
    for known in [*VALUE_PATHS, "multi_select"]:
        value = F.when(kind == known, F.try_variant_get(page, f"{_base(name)}.{known}", "variant")).otherwise(value)
        if known in ("title", "rich_text", "multi_select"):
            parts = F.when(kind == known, F.try_variant_get(page, f"{_base(name)}.{known}", "array<variant>")).otherwise(parts)
    none = value.isNull() | F.is_variant_null(value) | (F.coalesce(F.size(parts), F.lit(1)) == 0)
    return F.when(page.isNull(), None).when(F.try_variant_get(page, _base(name), "variant").isNull(), "missing").when(none, "empty").otherwise("held")


def page_schema(pages: DataFrame) -> DataFrame:
    """One row: the schema that all pages have in common, to see a table's properties change."""
    return parsed_pages(pages).agg(F.schema_of_variant_agg("page").alias("schema"))


def source_rows(pages: DataFrame) -> DataFrame:
    """Sources out of property pages (json); 0 hours and runs mean the default."""
    p = lambda n: property_value(F.col("page"), n)
    return parsed_pages(pages).select(
        F.coalesce(p("Name"), F.lit("")).alias("name"), F.coalesce(p("URL"), F.lit("")).alias("url"), coerce(F.lower(p("Source Category")), "source_category").alias("category"), coerce(F.lower(p("Type")), "source_type").alias("source_type"),
        F.coalesce(p("Country"), F.lit("")).alias("country"), F.coalesce(p("Enabled").cast("boolean"), F.lit(False)).alias("enabled"), property_choices(F.col("page"), "Keywords Filter").alias("keywords_filter"),
        F.coalesce(p("Scraper ID"), F.lit("")).alias("scraper_id"), F.coalesce(p("Lookback Hours").try_cast("int"), F.lit(0)).alias("lookback_hours"), F.coalesce(p("Max Silent Days").try_cast("int"), F.lit(0)).alias("max_silent_days"),
    )


def recipient_rows(pages: DataFrame) -> DataFrame:
    p = lambda n: F.coalesce(property_value(F.col("page"), n), F.lit(""))
    return parsed_pages(pages).select(
        p("Name").alias("name"), p("Email").alias("email"), (p("Active") == "true").alias("active"), coerce(F.lower(p("Group")), "recipient_group").alias("group"),
        (p("Is Primary") == "true").alias("is_primary"), p("Lead ID").alias("lead_id"),
    )


def company_rows(pages: DataFrame) -> DataFrame:
    p = lambda n: F.coalesce(property_value(F.col("page"), n), F.lit(""))
    return parsed_pages(pages).select(
        p("Company Name").alias("name"), coerce(F.lower(p("Type")), "company_type").alias("company_type"), p("Search Keywords").alias("search_keywords"),
        (p("Enabled") == "true").alias("enabled"), F.coalesce(F.nullif(p("Priority"), F.lit("")), F.lit("medium")).alias("priority"),
    )


def country_rows(pages: DataFrame) -> DataFrame:
    p = lambda n: F.coalesce(property_value(F.col("page"), n), F.lit(""))
    return parsed_pages(pages).select(
        p("Country").alias("name"), p("Region").alias("region"), p("Flag Emoji").alias("flag_emoji"), (p("Enabled") == "true").alias("enabled"), (p("Has Scraper") == "true").alias("has_scraper"),
        property_choices(F.col("page"), "Pan-regional Source").alias("pan_regional_sources"),
    )


def read_snapshot(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The four tables of a YAML snapshot; missing keys become nulls, a missing file empty tables."""
    import yaml

    held: dict[str, Any] = yaml.safe_load(Path(path).read_text()) if Path(path).exists() else {}
    return from_dicts(spark, held or {})


def from_dicts(spark: SparkSession, held: dict[str, list[dict]]) -> dict[str, DataFrame]:
    from pyspark.sql.types import StructType

    out = {}
    for name, ddl in TABLES.items():
        schema = StructType.fromDDL(ddl)
        out[name] = spark.createDataFrame([tuple(row.get(f.name) for f in schema) for row in held.get(name, [])], schema)
    return out


def write_snapshot(tables: dict[str, DataFrame], path: str) -> None:
    """Configuration is small by nature, so it goes through the driver."""
    import yaml

    held = {k: [r.asDict(recursive=True) for r in df.collect()] for k, df in tables.items()}
    Path(path).write_text(yaml.safe_dump(held, allow_unicode=True, sort_keys=False))


def active(df: DataFrame) -> DataFrame:
    return df.where("enabled" if "enabled" in df.columns else "active")


def by_type(companies: DataFrame, company_type: str) -> DataFrame:
    return companies.where(F.col("enabled") & (F.col("company_type") == company_type))


def create_tables(spark: SparkSession, database: str, seed: dict[str, DataFrame | list[dict]] | None = None) -> list[str]:
    """The configuration tables, silent days included; ``seed`` (tables, or rows as dictionaries) fills those that are empty. Running it again changes nothing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    given = {name: rows for name, rows in (seed or {}).items() if isinstance(rows, DataFrame)}
    small = from_dicts(spark, {name: rows for name, rows in (seed or {}).items() if name not in given})
    for name, ddl in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING parquet")
        if (name in given or (seed or {}).get(name)) and not spark.table(f"{database}.{name}").limit(1).count():
            rows = given.get(name, small[name])
            rows.select(*spark.table(f"{database}.{name}").columns).write.insertInto(f"{database}.{name}")
    return list(TABLES)
