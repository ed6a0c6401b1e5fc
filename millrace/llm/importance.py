"""Importance resampling toward a target corpus over hashed word n-grams.

A streaming CRC ring reads each text once: it keeps the running zlib states of the features that began at the last
``n`` words, extends each by a space and the next word, and emits the bucket of every state. No feature is ever built as a string.

Counts of buckets are summed over all rows of both corpora; a row's weight is the sum of its features' log ratios, and
Gumbel noise from a hash of its id turns the highest scores into a draw without replacement. Texts are scanned twice (for the counts, for the
weights), so nothing of their size is written down; ranks come from one sort by range of the narrow scores.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, python_ready, row_hash, table

WORDS, BUCKETS, NOISE_SEED, MIN_WORDS, PERCENT = 3, 10_000, 42, 20, 5
#: Bytes of a text whose words are held at a time; rows of one task of the final sort.
PIECE, SORT_ROWS = 1 << 18, 500_000

#: Words are runs of ASCII letters, ASCII digits and all other characters beyond ASCII; only A-Z are lower-cased.
_TO_WORDS = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists, each from about ``PIECE`` bytes of it."""
    at, n = 0, len(text)
    while at < n:
        end = min(n, at + PIECE)
        piece = text[at:end].translate(_TO_WORDS)
        if end < n:
            cut = piece.rfind(b" ", 1)  # the piece may begin with the space that ended the last one
            while cut < 0:  # a word that runs on: the piece grows up to its end
                more = text[end : end + PIECE].translate(_TO_WORDS)
                stop = more.find(b" ")
                piece, end = piece + (more if stop < 0 else more[:stop]), end + (len(more) if stop < 0 else stop)
                cut = len(piece) if stop >= 0 or end >= n else -1
            piece, end = piece[:cut], at + cut
        yield piece.split()
        at = end


class Ring:
    """Running CRC-32 states of the features that began at the last ``n`` words of a text."""

    def __init__(self, n: int):
        self.n, self.states = n, []

    def feed(self, words: list[bytes]) -> list[int]:
        """The states after each word, that is the checksums of all features that end there."""
        crc, back, states, out = zlib.crc32, 1 - self.n, self.states, []
        for w in words:
            if back and states:
                spaced = b" " + w
                states = [crc(spaced, s) for s in states[back:]]
            else:
                states = []
            states.append(crc(w))
            out += states
        self.states = states
        return out


def text_buckets(text: bytes | None, n: int = WORDS, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them) of one text, piece by piece."""
    ring = Ring(n)
    for words in words_of(text or b""):
        found = ring.feed(words)
        yield len(words), np.fromiter(found, np.uint32, len(found)) % np.uint32(buckets)


def bucket_counts(docs: DataFrame, n: int = WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows fall in each bucket: one row for each bucket reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in text_buckets(text.as_py(), n, buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "count"])

    python_ready(docs)
    counted = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "bucket long, count long")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("count").alias("count")).collect():
        out[r["bucket"]] = r["count"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's smoothed share in the target to that in the raw corpus, in whole thousandths, rounded down."""
    s_all, t_all, k = int(raw.sum()), int(target.sum()), len(raw)
    ratio = lambda s, t: (float(t + 1) * float(s_all + k)) / (float(s + 1) * float(t_all + k))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def scored(docs: DataFrame, target: DataFrame, *, n: int = WORDS, buckets: int = BUCKETS, seed: int = NOISE_SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and ``text_hash`` of every row, written down.

    Null and empty texts have no features and weight 0. A null doc_id draws its noise as the empty string does. Repeated rows are scored row by
    row, and alike. Without a target all gains show the raw corpus alone. An empty table gives an empty table.
    Whole texts of any length are read, a piece at a time. Other columns are not read.
    """
    spark = python_ready(docs)
    gains = spark.sparkContext.broadcast(bucket_gains(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gains.value
        for batch in batches:
            out = []
            for text in batch.column(1):
                words = features = weight = 0
                for count, found in text_buckets(text.as_py(), n, buckets):
                    words, features, weight = words + count, features + len(found), weight + int(gain[found].sum())
                out.append((words, features, weight))
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], ["doc_id", "text_hash", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), row_hash("text").alias("text_hash"))
    rows = rows.mapInArrow(run, f"doc_id {kind}, text_hash long, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    return materialise(rows.withColumn("score", F.col("weight") + noise), "importance-scores")


def ranked(rows: DataFrame, *, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``rows`` (from ``scored``) with ``rank``: 1, 2, ... for the drawn ones, null for the others.

    Of the N rows with ``min_words`` words at least, the floor(percent N / 100) highest scores are drawn; ties go to the smaller
    doc_id (null last), then by the text's hash. Rows are sorted by range; a row's rank is its place in its range plus
    the rows of the ranges before, of which the driver holds one count each.
    """
    spark, long = rows.sparkSession, rows.where(F.col("n_words") >= min_words)
    n = long.count()
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("text_hash")]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / SORT_ROWS))
    # equal rows may fill several ranges: a number that is fixed in the written table tells them apart
    ranged = long.withColumn("_m_nth", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "_m_nth").sortWithinPartitions(*order, "_m_nth")
    placed = materialise(ranged.drop("_m_nth").withColumn("_m_at", F.monotonically_increasing_id()), "importance-order")
    part, inside = F.shiftright("_m_at", 33), F.col("_m_at").bitwiseAND(F.lit((1 << 33) - 1))
    before, starts = 0, []
    for r in sorted(placed.groupBy(part.alias("part")).count().collect(), key=lambda r: r["part"]):
        starts.append((r["part"], before))
        before += r["count"]
    starts = F.broadcast(spark.createDataFrame(starts, "_m_part long, _m_before long"))  # one row for each range
    place = F.col("_m_before") + inside + 1
    drawn = placed.withColumn("_m_part", part).join(starts, "_m_part").withColumn("rank", F.when(place <= percent * n // 100, place))
    short = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*rows.columns, "rank").unionByName(short)


def resample(docs: DataFrame, target: DataFrame, *, min_words: int = MIN_WORDS, percent: int = PERCENT, **options) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns. Rows that agree in id and text are drawn together, if any of them is."""
    drawn = ranked(scored(docs, target, **options), min_words=min_words, percent=percent).where("rank is not null")
    keys = drawn.select(F.col("doc_id").alias("_m_id"), F.col("text_hash").alias("_m_hash")).distinct()
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["_m_id"]) & (row_hash(docs["text"]) == keys["_m_hash"]), "left_semi")


def op11_importance_ring(spark, sf_dir: str) -> DataFrame:
    rows = ranked(scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return rows.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
