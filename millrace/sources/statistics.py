"""Periodic statistics: zipped CSV cubes and header-first JSON tables."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ..functions.text import format_amount, safe_number
from ..schemas import PSD_FACT, SIDRA
from ..shipping import ship


def unzip_rows(files: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """Rows of the CSV members of zip files (path, content) as cells, each with its member's header; one file to a task, streamed."""
    ship(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(n for n in z.namelist() if n.lower().endswith(".csv")):
                        with z.open(name) as f:
                            held, size, header = [], 0, None
                            for cells in csv.reader(io.TextIOWrapper(f, "utf-8", errors="replace", newline="")):
                                if header is None:
                                    header = [c.strip() for c in cells]
                                    continue
                                held.append(cells)
                                size += sum(map(len, cells))
                                if size > chunk:
                                    yield pd.DataFrame({"path": path, "header": [header] * len(held), "cells": held})
                                    held, size = [], 0
                            yield pd.DataFrame({"path": path, "header": [header] * len(held), "cells": held})

    return files.select("path", "content").mapInPandas(run, "path string, header array<string>, cells array<string>")


def zipped_csv(spark: SparkSession, path: str, schema: str = PSD_FACT) -> DataFrame:
    """A zipped CSV cube with a declared schema."""
    return declared(unzip_rows(spark.read.format("binaryFile").load(path)), schema)


def declared(rows: DataFrame, schema: str = PSD_FACT) -> DataFrame:
    """Columns of a schema out of rows of cells, found by their names in the header, however many there are; null where one is missing or doesn't parse."""
    found = lambda f: F.array_position("header", f.name).cast("int")
    cell = lambda f: F.when(found(f) > 0, F.nullif(F.try_element_at("cells", found(f)), F.lit("")))
    return rows.select(*[cell(f).try_cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])


def fresh_copy(cached_month: str | None, today: str) -> bool:
    """A cached copy of today is fresh."""
    return cached_month == today


def cached_facts(spark: SparkSession, cache: str, fetch: Callable[[], DataFrame], *, fresh: bool, schema: str = PSD_FACT) -> DataFrame:
    """Facts from a fresh cache (CSV with a header), else fetched and cached; where fetching fails an old cache will do, and without one the failure stands."""

    def read() -> DataFrame | None:
        try:
            return spark.read.option("header", True).schema(schema).csv(cache)
        except AnalysisException:
            return None

    if fresh and (held := read()) is not None:
        return held
    try:
        facts = fetch()
        facts.write.mode("overwrite").option("header", True).csv(cache)
    except Exception:
        if (held := read()) is not None:
            return held
        raise
    return read()


def datasets_needed(metrics: list[str], members: bool) -> list[str]:
    """Only the datasets that some cell reads."""
    wanted = ["global"]
    if members and "area" in metrics:
        wanted.append("union_area")
    return wanted


def json_table(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Rows of a JSON table whose first row is a header: all but that one, with their position."""
    parsed = bodies.select(F.posexplode(F.from_json(body, SIDRA)).alias("pos", "r"))
    return parsed.where("pos > 0").select("pos", "r.*").withColumn("value", safe_number(F.col("V")))


def first_year(rows: DataFrame) -> DataFrame:
    """One row: the first plausible year by position."""
    year = F.col("D3C").try_cast("int")
    return rows.withColumn("year", year).where(F.col("year").between(2000, 2030)).agg(F.min_by("year", "pos").alias("year"))


def headline(rows: DataFrame, year: Column, *, area: str = "216", production: str = "215", limit: int = 6) -> DataFrame:
    """One row: the summary of the crops with the largest production."""
    from ..operators.matrix import pivot_top

    wide = pivot_top(rows.where("value is not null"), group="D4N", variable="D2C", value="value", order_by=production, variables=[area, production], limit=limit)
    parts = F.filter(F.array(format_amount(F.col(area), "ha planted"), format_amount(F.col(production), "t produced")), lambda p: p.isNotNull())
    line = F.when(F.size(parts) > 0, F.concat(F.col("D4N"), F.lit(": "), F.array_join(parts, ", ")))
    ordered = wide.select(F.coalesce(production, F.lit(0.0)).alias("p"), "D4N", line.alias("line")).where("line is not null")
    lines = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("p"), "D4N", "line"))), lambda x: x["line"])
    return ordered.agg(F.array_join(lines, " | ").alias("summary")).withColumn("year", year)


#: Fixed value: the page of the statistics table.
SURVEY_URL = "https://sidra.ibge.gov.br/tabela/5457"


def annual_release(latest: DataFrame, known: DataFrame, crops: DataFrame, now: Column) -> DataFrame:
    """The publication of a new survey year, or no row: ``latest`` holds the rows of the newest year, ``known`` the last year seen (column last), ``crops`` the headline figures."""
    from ..operators.state import newer_than

    year = newer_than(first_year(latest).where("year is not null"), known, "year")
    lines = headline(crops, F.lit(0)).select("summary")
    text = F.when(F.coalesce("summary", F.lit("")) != "", F.format_string("IBGE PAM %d — Brazil crop production highlights: %s", "year", "summary")).otherwise(
        F.format_string("IBGE PAM %d data released — detailed crop statistics now available at SIDRA.", "year")
    )
    title = F.format_string("IBGE PAM %d: Brazil Municipal Agricultural Production", "year")
    out = year.join(F.broadcast(lines), F.lit(True), "left").select("year", title.alias("title"), F.lit(SURVEY_URL).alias("url"), F.lit("ibge_pam").alias("source"), text.alias("summary"))
    return out.withColumn("published_at", now)
