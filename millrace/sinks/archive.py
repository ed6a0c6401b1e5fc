"""Archive rows and sinks that can be written again without doubling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.grouping import label
from ..shipping import ship

# The archive's bounds and choices.
TITLE_CHARS, TEXT_CHARS, TAGS = 200, 2000, 25
CATEGORY_LABELS = {
    "crop_production": "🛡️ Crop Protection |",
    "crop_land_use": "🌾 Crop land use |",
    "yields": "📈 Yields |",
    "agtech": "🚀 AgTech |",
    "climate_weather": "🌍 Climate |",
    "markets": "💸 Market |",
    "regulation": "⚖️ Regulation |",
    "company_news": "💸 Market |",
    "other": "🤷 Misc |",
}
SIGNAL_LABELS = {
    "market": "M&A",
    "agtech": "Product Launch",
    "regulation": "Regulation",
    "partnership": "Partnership",
    "executive": "Leadership Change",
    "product": "Product Launch",
    "financial": "Earnings",
    "other": "Other",
}
COMPANY_LABELS = {"client": "Other", "prospect": "Other"}


def archive_rows(articles: DataFrame) -> DataFrame:
    """Rows as the archive takes them: bounded texts and tags, day of publication, display names."""
    return articles.select(
        "id", F.substring("title", 1, TITLE_CHARS).alias("title"), "url", F.substring(F.coalesce("summary", F.lit("")), 1, TEXT_CHARS).alias("summary"),
        label(F.col("category"), CATEGORY_LABELS, CATEGORY_LABELS["other"]).alias("category"), F.slice("tags", 1, TAGS).alias("tags"), F.date_format("published_at", "yyyy-MM-dd").alias("day"),
    )


def archive_signals(signals: DataFrame) -> DataFrame:
    """Signals as the archive takes them; it doesn't tell clients from prospects."""
    return signals.select(
        "id", F.substring("title", 1, TITLE_CHARS).alias("title"), "url", "company_name", label(F.col("company_type"), COMPANY_LABELS, "Other").alias("company_type"),
        label(F.col("signal_type"), SIGNAL_LABELS, "Other").alias("signal_type"), F.substring(F.coalesce("summary", F.lit("")), 1, TEXT_CHARS).alias("summary"), F.date_format("published_at", "yyyy-MM-dd").alias("day"),
    )


def archive_publications(publications: DataFrame) -> DataFrame:
    return publications.select(
        "id", F.substring("title", 1, TITLE_CHARS).alias("title"), "url", "source_name", "country", F.substring(F.coalesce("summary", F.lit("")), 1, TEXT_CHARS).alias("summary"),
        F.date_format("published_at", "yyyy-MM-dd").alias("day"),
    )


def post_rows(rows: DataFrame, post: Callable[[dict], int], concurrency: int = 5) -> DataFrame:
    """Posts each row, ``concurrency`` at a time, one row to each id; 409 (there already) is success. One row with the counts."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ok = failed = 0
        for batch in batches:
            for row in batch.to_dict("records"):
                try:
                    good = post(row) in (200, 201, 409)
                except Exception:  # noqa: BLE001
                    good = False
                ok, failed = ok + good, failed + (not good)
        yield pd.DataFrame({"ok": [ok], "failed": [failed]})

    return rows.dropDuplicates(["id"]).repartition(concurrency, "id").mapInPandas(run, "ok long, failed long").agg(F.sum("ok").alias("ok"), F.sum("failed").alias("failed"))


def merge_by_id(archive: DataFrame, rows: DataFrame) -> DataFrame:
    """The archive with new rows added and known ones replaced. Of new rows with one id the least by all other columns stays, so that reruns agree."""
    others = [c for c in rows.columns if c != "id"]
    one = rows.groupBy("id").agg(F.min(F.struct(*others)).alias("_r")).select("id", "_r.*").select(*rows.columns)
    return archive.join(rows.select("id"), "id", "left_anti").unionByName(one)


def write_trimmed(facts: DataFrame, path: str) -> None:
    facts.write.mode("overwrite").option("header", True).csv(path)
