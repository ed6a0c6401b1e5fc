"""Zipped CSV cubes as a data source: ``spark.read.format("zipped_csv")``.

A partition is one member of one zip. The planner reads the zips' directories only; a task opens its zip where it lies, seeks to its member and
streams it, so neither a zip nor a member is held whole, and the members of one zip are read side by side.
"""

from __future__ import annotations

import csv
import io
import posixpath
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schemas import PSD_FACT
from ..shipping import ship
from .statistics import declared

CELLS = "path string, member string, row long, header array<string>, cells array<string>"
BATCH_ROWS = 4096


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def zip_files(path: str) -> list[str]:
    """The zip itself, or the zips within a folder."""
    store, at = open_store(path)
    found = store.get_file_info(at)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.type == fs.FileType.File:
        return [at]
    return sorted(f.path for f in store.get_file_info(fs.FileSelector(at, recursive=True)) if f.type == fs.FileType.File and f.path.lower().endswith(".zip"))


class ZipReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        store, _ = open_store(self.path)
        out = []
        for file in zip_files(self.path):
            with store.open_input_file(file) as raw, zipfile.ZipFile(raw) as z:
                out += [InputPartition((file, n)) for n in sorted(z.namelist()) if n.lower().endswith(".csv")]
        return out or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        file, member = partition.value
        store, _ = open_store(self.path)
        with store.open_input_file(file) as raw, zipfile.ZipFile(raw) as z, z.open(member) as f:
            lines = csv.reader(io.TextIOWrapper(f, "utf-8-sig", errors="replace", newline=""))
            header, held, row = [c.strip() for c in next(lines, [])], [], 0
            for cells in lines:
                held.append(cells)
                if len(held) == BATCH_ROWS:
                    yield self._batch(file, member, row, header, held)
                    row, held = row + len(held), []
            if held:
                yield self._batch(file, member, row, header, held)

    @staticmethod
    def _batch(file: str, member: str, row: int, header: list[str], held: list[list[str]]) -> pa.RecordBatch:
        n, texts = len(held), pa.list_(pa.string())
        columns = [pa.array([posixpath.basename(file)] * n), pa.array([member] * n), pa.array(range(row, row + n), pa.int64()), pa.array([header] * n, texts), pa.array(held, texts)]
        return pa.RecordBatch.from_arrays(columns, ["path", "member", "row", "header", "cells"])


class ZippedCsv(DataSource):
    """Option: ``path``, a zip or a folder of zips."""

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> ZipReader:
        return ZipReader(self.options["path"])


def read_zipped(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, row, header, cells): a row for each line below the header of each CSV member."""
    ship(spark)
    spark.dataSource.register(ZippedCsv)
    return spark.read.format("zipped_csv").option("path", path).load()


def read_facts(spark: SparkSession, path: str, schema: str = PSD_FACT) -> DataFrame:
    """A zipped cube with a declared schema; columns are found by their names in each member's own header."""
    return declared(read_zipped(spark, path), schema)
