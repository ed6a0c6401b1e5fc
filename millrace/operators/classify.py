"""The boundary to an expensive classifier: chunks, retries, result contracts, and what results do to rows."""

from __future__ import annotations

import contextlib
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..functions.text import strip
from ..schemas import BRIEF, coerce
from ..shipping import ship

# Rows to a request.
CHUNK = {"article": 5, "signal": 8, "publication": 8}
BODY_CHARS, SUMMARY_CHARS, RAW_CHARS = 1200, 500, 2500
POLL_SECONDS, TIMEOUT_SECONDS = 15, 20 * 60
CONTRACTS = {
    "article": "struct<item_index:int,relevant:boolean,category:string,summary:string,tags:array<string>,importance:string,story_key:string,place:string,country_iso:string>",
    "signal": "struct<item_index:int,signal_type:string,summary:string,score:string,angle:string,company_is_actor:boolean,story_key:string>",
    "publication": "struct<item_index:int,relevant:boolean,summary:string,place:string,country_iso:string>",
}


def chunks(rows: DataFrame, size: int, span: int = 320) -> DataFrame:
    """``rows`` with chunk_id and item_index, ``size`` rows to a chunk in the order of ``seq``; only the last chunk may be short.

    Rows are numbered within ranges of ``seq`` and the counts of the ranges before are added, so no task sees all rows, however sparse ``seq`` is.
    """
    part = F.floor(F.col("seq") / span)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_c"))
    counts = counts.select("_part", F.floor(F.col("_part") / span).alias("_far"), "_c")
    far = counts.groupBy("_far").agg(F.sum("_c").alias("_n_far"))
    far = far.select("_far", (F.sum("_n_far").over(Window.orderBy("_far")) - F.col("_n_far")).alias("_before_far"))  # a row for each ``span`` ranges
    near = F.sum("_c").over(Window.partitionBy("_far").orderBy("_part")) - F.col("_c")
    offsets = counts.withColumn("_before", near).join(far, "_far").select("_part", (F.col("_before") + F.col("_before_far")).alias("_offset"))
    n = F.row_number().over(Window.partitionBy("_part").orderBy("seq")) - 1
    out = rows.withColumn("_part", part).withColumn("_n", n).join(offsets, "_part").withColumn("_n", F.col("_n") + F.col("_offset"))
    return out.withColumn("chunk_id", F.floor(F.col("_n") / size).cast("string")).withColumn("item_index", (F.col("_n") % size).cast("int")).select(*rows.columns, "chunk_id", "item_index")


def apply_results(items: DataFrame, results: DataFrame) -> DataFrame:
    """Joins results (chunk_id, item_index, result) to their items; indices out of range fall out, items without one stay unclassified."""
    out = items.join(results, ["chunk_id", "item_index"], "left")
    return out.withColumn("classified", F.col("result").isNotNull())


def parse_results(raw: DataFrame, kind: str) -> DataFrame:
    """Answers (chunk_id, json array) as rows (chunk_id, item_index, result); what doesn't parse is no result. Doubles: the last wins."""
    parsed = raw.select("chunk_id", F.posexplode(F.from_json("json", f"array<{CONTRACTS[kind]}>")).alias("_p", "result")).where("result.item_index is not null")
    return parsed.groupBy("chunk_id", F.col("result.item_index").alias("item_index")).agg(F.max_by("result", "_p").alias("result"))


def retry_set(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Requests without a good result."""
    good = results.where(F.col("error").isNull()).select("custom_id")
    return requests.join(good, "custom_id", "left_anti")


def clamp(col: Column, low: int = 1, high: int = 5, default: int = 3) -> Column:
    """A whole number within the bounds; what is missing or no number becomes the default."""
    return F.coalesce(F.least(F.greatest(col.try_cast("int"), F.lit(low)), F.lit(high)), F.lit(default))


def signal_score(score: Column, is_actor: Column) -> Column:
    """Clamped; 2 at most where the company isn't the one that acts."""
    value = clamp(score)
    return F.when(F.coalesce(is_actor, F.lit(False)), value).otherwise(F.least(value, F.lit(2)))


def signal_angle(score: Column, angle: Column) -> Column:
    return F.when(score >= 4, angle)


def judge_articles(items: DataFrame) -> DataFrame:
    """Articles with what their result says; unclassified ones stay irrelevant."""
    r = F.col("result")
    return (
        items.withColumn("relevant", F.coalesce(r["relevant"], F.lit(False)))
        .withColumn("category", F.when(F.col("classified"), coerce(r["category"], "article_category")).otherwise(F.col("category")))
        .withColumn("importance", F.when(F.col("classified"), clamp(r["importance"])).otherwise(F.lit(3)))
        .withColumn("story_key", F.coalesce(r["story_key"], F.lit("")))
        .withColumn("summary", F.coalesce(F.nullif(r["summary"], F.lit("")), F.col("title")))
        .drop("result")
    )


def call_in_batches(rows: DataFrame, classify: Callable[[list[dict]], list[dict]], schema: str, *, concurrency: int = 2, retries: int = 3, fallback: Callable[[list[dict]], list[dict]] | None = None) -> DataFrame:
    """Sends each chunk to ``classify``; ``concurrency`` partitions call at a time, each retries with doubling waits, then asks the fallback once.

    ``rows``: chunk_id, item_index and whatever the classifier reads; returns its dicts as ``schema``. A chunk that fails for good gives no rows.
    """
    ship(rows.sparkSession)
    names = StructType.fromDDL(schema).names

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        items = part.sort_values("item_index").to_dict("records")
        for call, tries in ((classify, retries), (fallback, 1)):
            if call is None:
                continue
            for attempt in range(tries):
                try:
                    return pd.DataFrame([{"chunk_id": key[0], **r} for r in call(items)])
                except Exception:  # noqa: BLE001 - any failure of the service counts as one try
                    if attempt + 1 < tries:
                        time.sleep(2**attempt)
        return pd.DataFrame(columns=names)

    return rows.repartition(concurrency, "chunk_id").groupBy("chunk_id").applyInPandas(run, schema)


class BatchService(Protocol):
    """A service that takes many requests at once and is asked for the results later."""

    def submit(self, requests: list[dict]) -> str: ...

    def ended(self, batch: str) -> bool: ...

    def results(self, batch: str) -> list[dict]: ...

    def cancel(self, batch: str) -> None: ...


def call_in_bulk(
    requests: DataFrame, service: BatchService, *, poll_seconds: float = POLL_SECONDS, timeout_seconds: float = TIMEOUT_SECONDS,
    clock: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep,
) -> tuple[DataFrame, DataFrame]:
    """(results: custom_id, json, error; the requests that still need the direct way) of one batch of ``requests`` (custom_id, json).

    The batch is cancelled when it hasn't ended in time; then, and when the service fails, all requests are left. Answers with an error and
    requests without an answer are left too; answers to what wasn't asked are dropped. A run's requests go through the driver, as one call takes them all.
    """
    spark, schema = requests.sparkSession, "custom_id string, json string, error string"
    empty = spark.createDataFrame([], schema)
    try:
        batch = service.submit([r.asDict() for r in requests.collect()])
        deadline = clock() + timeout_seconds
        while not service.ended(batch):
            if clock() > deadline:
                with contextlib.suppress(Exception):
                    service.cancel(batch)
                return empty, requests
            wait(poll_seconds)
        answers = [(r["custom_id"], r.get("json"), r.get("error")) for r in service.results(batch)]
    except Exception:  # noqa: BLE001 - any failure of the service leads to the direct way
        return empty, requests
    found = spark.createDataFrame(answers, schema).join(requests.select("custom_id"), "custom_id", "left_semi")
    return found.where("error is null"), retry_set(requests, found)


def parse_sections(json: Column) -> Column:
    """A brief out of an answer: takeaway and the sections that have a label and a text, stripped; null without any content."""
    raw = F.from_json(json, BRIEF)
    sections = F.transform(F.coalesce(raw["sections"], F.array().cast("array<struct<label:string,text:string>>")), lambda s: F.struct(strip(s["label"]).alias("label"), strip(s["text"]).alias("text")))
    sections = F.filter(sections, lambda s: (F.coalesce(s["label"], F.lit("")) != "") & (F.coalesce(s["text"], F.lit("")) != ""))
    takeaway = F.coalesce(strip(raw["takeaway"]), F.lit(""))
    return F.when((takeaway != "") | (F.size(sections) > 0), F.struct(takeaway.alias("takeaway"), sections.alias("sections")))


def translate_titles(rows: DataFrame, translate: Callable[[list[str]], list[str]], language: str = "original_language") -> DataFrame:
    """Titles that aren't English are translated batch by batch; where that fails they stay."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for titles in batches:
            try:
                yield pd.Series(translate(titles.tolist()), dtype=object)
            except Exception:  # noqa: BLE001
                yield titles

    udf = F.pandas_udf(run, "string")
    foreign = rows.where(F.col(language) != "en").withColumn("title", udf("title"))
    return foreign.unionByName(rows.where((F.col(language) == "en") | F.col(language).isNull()))


def either(first: DataFrame, second: Callable[[], DataFrame]) -> DataFrame:
    """The first extractor's rows, or the second's where the first has none. The first runs once: its rows are kept until they are read."""
    held = first.persist()
    if held.limit(1).count():
        return held
    held.unpersist()
    return second()
