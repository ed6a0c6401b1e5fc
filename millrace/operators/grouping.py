"""Grouped listings, label maps, and unions of the three streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Display names.
THEMES = {
    "crop_production": "Production",
    "crop_land_use": "Acreage",
    "yields": "Yields",
    "agtech": "Agtech",
    "climate_weather": "Weather",
    "markets": "Markets",
    "regulation": "Regulation",
    "company_news": "Company news",
    "other": "Other",
}


def label(col: Column, names: dict[str, str], default: str) -> Column:
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[F.coalesce(col, F.lit(""))], F.lit(default))


def category_counts(rows: DataFrame, key: str = "category") -> DataFrame:
    """Rows by category, most first, then first seen."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min("seq").alias("first_seq")).orderBy(F.desc("n"), "first_seq")


def company_groups(signals: DataFrame) -> DataFrame:
    """Each company's signals in order, companies by code point."""
    return signals.groupBy("company_name").agg(
        F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "title"))), lambda x: x["title"]), " | ").alias("titles")
    ).orderBy("company_name")


def union_streams(**streams: DataFrame) -> DataFrame:
    """Rows of all streams with ``stream`` named; columns that one lacks are null."""
    out = None
    for name, df in streams.items():
        part = df.withColumn("stream", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def dataset_labels(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``label`` of each dataset code; the code itself where none is known."""
    return rows.join(names.select("code", F.col("label").alias("_label")), "code", "left").withColumn("label", F.coalesce("_label", "code")).drop("_label")
