"""Proportional stratified interleaving of sources into shards.

Rows are shuffled by a seeded hash, ranked within their source, laid out by fractional
rank ``(rank - 1/2) / n_source`` and cut into contiguous shards whose row counts differ
by one at most. Every stretch of that layout holds each source in its overall share.

No rank needs a whole source or the whole table in one task: the hash's leading hex
digits cut each source into slices of about ``SLICE_ROWS`` rows, counts of slices are summed up first, and a window
numbers rows only within a slice. The same is done for the global position. All of it runs on keys that are written down
once; whole rows are shuffled once, to meet their places.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SEED, materialise, shielded, source_key, table, utf8_bytes

#: Rows that a window numbers in one task; a slice holds so many at most (but for rows that agree in id and text, which share one).
SLICE_ROWS = 50_000


def shuffle_key(df: DataFrame, doc_id: str, text: str, seed: int):
    """Hex digest that orders the rows; it depends on the seed, the id and the text alone."""
    part = lambda c: F.coalesce(c, F.lit("-"))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), part(F.col(doc_id).cast("string")), part(F.md5(F.col(text).cast("binary")))).cast("binary"))


def _with_fraction(rows: DataFrame, n: int) -> DataFrame:
    """Adds ``_m_frac``, the fractional rank in the source, and ``_m_part``, its slice of the layout; needs ``_m_src`` and ``_m_key``."""
    digits = max(2, math.ceil(math.log(max(1, n / SLICE_ROWS), 16)))
    rows = rows.withColumn("_m_slice", F.substring("_m_key", 1, digits))
    counts = materialise(rows.groupBy("_m_src", "_m_slice").agg(F.count("*").alias("_m_cnt")), "shard-slices")
    by_source = Window.partitionBy("_m_src")
    before = counts.select(
        "_m_src",
        "_m_slice",
        F.coalesce(F.sum("_m_cnt").over(by_source.orderBy("_m_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_m_before"),
        F.sum("_m_cnt").over(by_source).alias("_m_n_src"),
    )
    number = F.row_number().over(Window.partitionBy("_m_src", "_m_slice").orderBy("_m_key"))
    ranked = rows.withColumn("_m_rn", number).join(before, ["_m_src", "_m_slice"])
    parts = 4 * max(1, math.ceil(n / SLICE_ROWS))
    return ranked.withColumn("_m_frac", (F.col("_m_before") + F.col("_m_rn") - F.lit(0.5)) / F.col("_m_n_src")).withColumn("_m_part", F.floor(F.col("_m_frac") * parts).cast("long"))


def _positions(keys: DataFrame) -> tuple[DataFrame, int]:
    """(``keys`` (_m_key, _m_src and others) with ``_m_pos``, the place of each row in the layout; the count of rows)."""
    n = keys.count()
    ranked = materialise(_with_fraction(keys, n).drop("_m_slice", "_m_rn", "_m_before", "_m_n_src"), "shard-ranks")
    everything = Window.orderBy("_m_part")  # over a few rows for each SLICE_ROWS
    parts = ranked.groupBy("_m_part").agg(F.count("*").alias("_m_cnt"))
    layout = parts.select("_m_part", F.coalesce(F.sum("_m_cnt").over(everything.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_m_start"))
    number = F.row_number().over(Window.partitionBy("_m_part").orderBy("_m_frac", "_m_src", "_m_key"))
    placed = ranked.withColumn("_m_rn", number).join(layout, "_m_part")
    return placed.withColumn("_m_pos", F.col("_m_start") + F.col("_m_rn") - 1).drop("_m_part", "_m_frac", "_m_rn", "_m_start"), n


def _cut(placed: DataFrame, n: int, n_shards: int, shard: str, slot: str) -> DataFrame:
    """The layout cut into ``n_shards`` stretches."""
    out = placed.withColumn(shard, F.expr(f"cast((_m_pos * {n_shards}) div {max(1, n)}L as int)"))
    return out.withColumn(slot, F.expr(f"_m_pos - (`{shard}` * {n}L + {n_shards - 1}) div {n_shards}"))


@shielded
def interleave(
    df: DataFrame, n_shards: int, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, shard: str = "shard", slot: str = "slot"
) -> DataFrame:
    """``df`` with the columns ``shard`` (0 .. n_shards - 1) and ``slot`` (gapless from 0 in each shard).

    Shard row counts differ by one at most, and every shard has each source in proportion.
    Null ids, texts and sources are values like any other (null sources make one stratum);
    empty texts count as rows; repeated rows are all placed, in adjacent ranks of their source;
    an empty table gives an empty table; columns named like the new ones are replaced.
    """
    df = df.drop(*[c for c in df.columns if c.lower() in (shard.lower(), slot.lower())])
    keyed = df.withColumn("_m_key", shuffle_key(df, doc_id, text, seed)).withColumn("_m_src", source_key(source))
    placed, n = _positions(materialise(keyed.select("_m_key", "_m_src"), "shard-keys"))
    # rows that agree in id, text and source share their places out
    places = placed.groupBy("_m_key", "_m_src").agg(F.sort_array(F.collect_list("_m_pos")).alias("_m_places"))
    nth = F.row_number().over(Window.partitionBy("_m_key", "_m_src").orderBy("_m_key"))
    out = keyed.join(places, ["_m_key", "_m_src"]).withColumn("_m_pos", F.element_at("_m_places", nth))
    return _cut(out, n, n_shards, shard, slot).select(*df.columns, shard, slot)


def write_shards(df: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder of Parquet files for each shard, rows in the order of their slots."""
    df.repartition(F.col(shard)).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)


def op1_interleaved_shards(spark, sf_dir: str) -> DataFrame:
    """Texts are read once: their sizes, checksums and keys are written down first."""
    docs = table(spark, sf_dir, "documents")
    digest = docs.select(
        "doc_id", "source", (utf8_bytes("text") + 1).alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        shuffle_key(docs, "doc_id", "text", SEED).alias("_m_key"), source_key("source").alias("_m_src"),
    )
    placed, n = _positions(materialise(digest, "shard-digests"))
    return _cut(placed, n, 8, "shard", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source"
    )
