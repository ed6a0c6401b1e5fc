"""The archive as a sink with two phases: ``df.write.format("archive")``.

A task stages its rows under a token of its own; only the driver's ``commit`` publishes the tokens of the attempts that Spark counts, in one
step, and ``abort`` discards them. Attempts that failed, or ran twice by speculation, stay unpublished. A run that was committed before
isn't committed again, so a repeated job changes nothing.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from importlib import import_module
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..shipping import ship
from ..sources.folders import shared_path


class Archive(Protocol):
    """What an archive has to offer; it is made on each side from the writer's options."""

    def stage(self, run: str, rows: Iterable[dict[str, Any]]) -> tuple[str, int, int]:
        """Takes rows without showing them: (token, rows taken, rows refused)."""
        ...

    def publish(self, run: str, tokens: list[str], ok: int, failed: int) -> bool:
        """Shows what the tokens stand for, all at once; False if the run was published before."""
        ...

    def discard(self, run: str, tokens: list[str]) -> None: ...


class FolderArchive:
    """Staged rows as JSON lines in ``<path>/rows/``, a run's manifest in ``<path>/runs/``; ``path`` is a folder that all executors share.

    A manifest is linked into place whole, and only once; what no manifest names was never published. Rows without an id are refused.
    """

    def __init__(self, options: dict[str, str]):
        self.root = shared_path(options["path"])

    def stage(self, run: str, rows: Iterable[dict[str, Any]]) -> tuple[str, int, int]:
        token, ok, failed = f"{uuid.uuid4().hex}.json", 0, 0
        (self.root / "rows").mkdir(parents=True, exist_ok=True)
        with open(self.root / "rows" / token, "w", encoding="utf-8") as out:
            for row in rows:
                if row.get("id") is None:
                    failed += 1
                    continue
                out.write(json.dumps(row, ensure_ascii=False, default=str) + "\n")
                ok += 1
        return token, ok, failed

    def publish(self, run: str, tokens: list[str], ok: int, failed: int) -> bool:
        runs = self.root / "runs"
        runs.mkdir(parents=True, exist_ok=True)
        draft = runs / f".{uuid.uuid4().hex}"
        draft.write_text(json.dumps({"run": run, "files": tokens, "ok": ok, "failed": failed}), encoding="utf-8")
        try:
            os.link(draft, runs / f"{run}.json")  # fails if it is there, so the first of two wins
            return True
        except FileExistsError:
            return False
        finally:
            draft.unlink()

    def discard(self, run: str, tokens: list[str]) -> None:
        for token in tokens:
            (self.root / "rows" / token).unlink(missing_ok=True)

    def manifests(self) -> list[dict[str, Any]]:
        return [json.loads(p.read_text(encoding="utf-8")) for p in sorted((self.root / "runs").glob("*.json"))]


@dataclass
class Staged(WriterCommitMessage):
    token: str
    ok: int
    failed: int


def archive_of(options: dict[str, str]) -> Archive:
    """The archive that the option ``client`` names as ``module:class``."""
    module, _, name = options.get("client", "millrace.sinks.two_phase:FolderArchive").partition(":")
    return getattr(import_module(module), name)(options)


class ArchiveWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.options, self.run = options, options["run"]

    def write(self, iterator: Iterator) -> Staged:
        return Staged(*archive_of(self.options).stage(self.run, (r.asDict(recursive=True) for r in iterator)))

    def commit(self, messages) -> None:
        archive, staged = archive_of(self.options), [m for m in messages if m]
        tokens = [m.token for m in staged]
        if not archive.publish(self.run, tokens, sum(m.ok for m in staged), sum(m.failed for m in staged)):
            archive.discard(self.run, tokens)

    def abort(self, messages) -> None:
        archive_of(self.options).discard(self.run, [m.token for m in messages if m])


class ArchiveSink(DataSource):
    """Options: ``run`` (its name decides whether it was written before), ``client`` (module:class), and what the client needs."""

    @classmethod
    def name(cls) -> str:
        return "archive"

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(dict(self.options))


def write_archive(rows: DataFrame, run: str, **options: str) -> None:
    """Writes ``rows`` (with an id) as one run."""
    ship(rows.sparkSession)
    rows.sparkSession.dataSource.register(ArchiveSink)
    rows.write.format("archive").options(run=run, **options).mode("append").save()


def new_rows(rows: DataFrame, archived: DataFrame, order: str) -> DataFrame:
    """What a run has to write: the first row of each id by ``order``, if the archive doesn't hold the id. Rows without id stay, to be refused and counted."""
    known = rows.where("id is not null").groupBy("id").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "id"]), order).alias("_r"))
    known = known.select("id", "_r.*").select(*rows.columns).join(archived.select("id"), "id", "left_anti")
    return known.unionByName(rows.where("id is null"))


def read_archive(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Published rows with ``run``; files that no manifest names don't count. The driver holds the manifests: a name for each task of each run."""
    held = FolderArchive({"path": path}).manifests()
    files = [(m["run"], f) for m in held for f in m["files"]]
    if not files:
        return spark.createDataFrame([], f"{schema}, run string")
    rows = spark.read.schema(schema).json([f"{path.rstrip('/')}/rows/{f}" for _, f in files])
    named = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return rows.withColumn("_file", named).join(F.broadcast(spark.createDataFrame(files, "run string, _file string")), "_file").drop("_file")


def run_counts(spark: SparkSession, path: str) -> DataFrame:
    """(run, ok, failed) of the published runs."""
    return spark.createDataFrame([(m["run"], m["ok"], m["failed"]) for m in FolderArchive({"path": path}).manifests()], "run string, ok long, failed long")
