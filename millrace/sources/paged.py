"""Paged services as a Spark data source: ``spark.read.format("paged")``.

A service answers page by page; each page names the cursor of the next. A partition of the reader is one walk along the cursors of one table, from
a start to its end (or to the cursor at which another walk starts), so pages are neither listed nor held on the driver. A page that fails is asked again at the same cursor; if
it keeps failing, the task fails, and Spark's retry walks again from the partition's start. Filters on ``table`` choose the walks.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Iterator
from importlib import import_module
from typing import Any, NamedTuple, Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from ..shipping import ship
from .folders import partition_folder, partition_value, shared_path, whole_text

PAGE_ROW = "table string, cursor string, pos int, json string"
ATTEMPTS, WAIT_SECONDS = 3, 0.5


class Walk(NamedTuple):
    """Pages of a table from one cursor (None: the first page) up to, but without, another (None: the last page)."""

    table: str
    start: str | None = None
    until: str | None = None


class Client(Protocol):
    """What a service has to offer; it is made on each side from the reader's options."""

    def walks(self) -> Iterable[Walk]: ...

    def page(self, table: str, cursor: str | None) -> dict[str, Any]: ...


class FolderPages:
    """Pages that lie as JSON in ``<path>/table=<name>/cursor=<cursor>/``, the first one under ``first``; ``path`` is a folder that all executors share."""

    def __init__(self, options: dict[str, str]):
        self.root = shared_path(options["path"])

    def walks(self) -> Iterator[Walk]:
        for folder in sorted(self.root.glob("table=*")):
            yield Walk(partition_value(folder))

    def page(self, table: str, cursor: str | None) -> dict[str, Any]:
        text = whole_text(self.root / partition_folder("table", table) / partition_folder("cursor", cursor or "first"))
        if text is None:
            raise FileNotFoundError(f"no page {cursor or 'first'} of {table} in {self.root}")
        return json.loads(text)


def client_of(options: dict[str, str]) -> Client:
    """The client that the option ``client`` names as ``module:class``."""
    module, _, name = options.get("client", "millrace.sources.paged:FolderPages").partition(":")
    return getattr(import_module(module), name)(options)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.tables = options, None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("table",):
                self._only({f.value})
            elif isinstance(f, In) and f.attribute == ("table",):
                self._only(set(f.value))
            else:
                yield f

    def _only(self, tables: set[str]) -> None:
        self.tables = tables if self.tables is None else self.tables & tables

    def partitions(self) -> list[InputPartition]:
        walks = client_of(self.options).walks()
        # Spark wants one partition at least; without a walk it has nothing to read
        return [InputPartition(w) for w in walks if self.tables is None or w.table in self.tables] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        client, walk = client_of(self.options), partition.value
        cursor, seen = walk.start, set()
        while True:
            seen.add(cursor)
            page = self._page(client, walk.table, cursor)
            for pos, row in enumerate(page.get("results", [])):
                yield walk.table, cursor, pos, json.dumps(row, ensure_ascii=False)
            cursor = page.get("next_cursor") if page.get("has_more") else None
            if not cursor or cursor == walk.until:
                return
            if cursor in seen:
                raise ValueError(f"the pages of {walk.table} come back to cursor {cursor}")

    def _page(self, client: Client, table: str, cursor: str | None) -> dict[str, Any]:
        attempts, wait = int(self.options.get("attempts", ATTEMPTS)), float(self.options.get("wait", WAIT_SECONDS))
        for n in range(attempts):
            try:
                return client.page(table, cursor)
            except Exception:  # noqa: BLE001 - whatever went wrong, the page is asked again
                if n + 1 == attempts:
                    raise
                time.sleep(wait * 2**n)
        raise ValueError("attempts must be 1 at least")


class Paged(DataSource):
    """Options: ``client`` (module:class), ``attempts`` and ``wait`` (seconds, doubled each time), and what the client needs."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return PAGE_ROW

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def read_paged(spark: SparkSession, **options: str) -> DataFrame:
    """(table, cursor, pos, json): a row for each result of each page of a paged service."""
    ship(spark)
    spark.dataSource.register(Paged)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("paged").options(**options).load()


def write_pages(rows: DataFrame, table: str, page: Column, path: str) -> None:
    """``rows`` (json) as pages for ``FolderPages``, by their page numbers (0, 1, 2, ...); for exports and replays of a service's answers."""
    pages = rows.groupBy(page.cast("long").alias("_page")).agg(F.array_sort(F.collect_list("json")).alias("rows"))
    last = pages.agg(F.max("_page").alias("_last"))
    more = F.when(F.col("_page") < F.col("_last"), F.concat(F.lit('true,"next_cursor":"'), (F.col("_page") + 1).cast("string"), F.lit('"}'))).otherwise("false}")
    body = F.concat(F.lit('{"results":['), F.array_join("rows", ","), F.lit('],"has_more":'), more)
    cursor = F.when(F.col("_page") == 0, "first").otherwise(F.col("_page").cast("string"))
    pages = pages.crossJoin(F.broadcast(last))  # one row
    pages.select(F.lit(table).alias("table"), cursor.alias("cursor"), body.alias("value")).write.mode("append").partitionBy("table", "cursor").text(path)
