"""Helpers shared by the corpus operators."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

SEED = 20240131


#: Texts go to Python in batches of about so many bytes, so that a worker's memory doesn't depend on the rows' lengths.
BATCH_BYTES = "4m"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent, a local master (tests) gets a temporary folder; a cluster is refused,
    since its executors would each write to their own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = os.path.join(tempfile.gettempdir(), "millrace-checkpoints")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage in storage that survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_ready(df: DataFrame) -> SparkSession:
    """The session of ``df``, with this package on its executors and, unless the caller chose, batches of ``BATCH_BYTES``."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_key(col: Column | str) -> Column:
    """A non-null key that keeps a null source apart from every string."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), col.cast("string")))


def held_out(doc_id: Column | str) -> Column:
    """True for the rows that no model may learn from: crc32(doc_id as text) mod 4 = 2."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def utf8_bytes(text: Column | str) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.octet_length(col).cast("long"), F.lit(0).cast("long"))


def row_hash(text: Column | str) -> Column:
    """Tells the texts of rows with one id, or none, apart; such rows spread by it. Null texts are alike."""
    col = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(col, F.lit("")), col.isNull())


def whole_ids(df: DataFrame) -> DataFrame:
    """``df`` with ``no_id`` and without null doc_ids: pandas makes floats of a column with nulls, which aren't exact over 2**53."""
    return df.withColumn("no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))


def real_ids(df: DataFrame) -> DataFrame:
    """The way back from ``whole_ids``."""
    return df.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def shield(df: DataFrame, also: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with new names, free in it, for the caller's columns that are named like the operators' own (``_m_...``) or one of ``also``; and the way back."""
    taken, back = {c.lower() for c in df.columns}, {}
    for c in df.columns:
        if c.lower().startswith("_m_") or c.lower() in also:
            new = f"_user_{c}"
            while new.lower() in taken:
                new = f"_user{new}"
            taken.add(new.lower())
            back[new] = c
    return (df.withColumnsRenamed({c: new for new, c in back.items()}) if back else df), back


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Renames such columns of the first argument while the operator runs, so that they come back as they were."""

    @functools.wraps(operator)
    def run(df: DataFrame, *args, **options) -> DataFrame:
        held, back = shield(df)
        out = operator(held, *args, **options)
        return out.withColumnsRenamed(back) if back else out

    return run
