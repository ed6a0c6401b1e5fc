"""Gets work to the executors: the package's source where it isn't installed, and rows in shares that keep all cores busy."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="millrace-")
    path = os.path.join(folder, "millrace.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"millrace/{file.relative_to(root)}")
    sc.addPyFile(path)


def ship_active() -> None:
    """The same for the active session, for expressions that run Python."""
    session = SparkSession.getActiveSession()
    if session is not None:
        ship(session)


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt out evenly over all cores, before work that costs far more than moving them: a table of one row group is one task otherwise."""
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
