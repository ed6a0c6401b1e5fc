"""Language identification with bit-sliced Bloom filters over character n-grams.

One Bloom filter for each language, stored side by side: slot ``i`` of the table is a
mask with one bit for each language, in as many 64-bit words as the languages need (4 MB a word). The masks at an n-gram's hash positions,
ANDed, name all languages whose filter has it. A text's popcounts by language are corrected for
each filter's false-positive rate, ``(hits - n f) / (1 - f)``, and the language with the most wins.

Fitting counts n-grams on a bounded sample of labelled rows (``SAMPLE`` expected rows for each
language, chosen by a hash of the id); an n-gram enters the filter of a language when
it is frequent there, also against the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, materialise, python_ready, shield, table
from .textkernel import PIECE, codes, fold_table, letter_table, mix

GRAM, HASHES, SLOT_BITS = 4, 3, 19
SAMPLE, MIN_COUNT, MIN_SHARE = 4000, 3, 0.4
_TIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def gram_batches(text: str, size: int = PIECE) -> Iterator[np.ndarray]:
    """Hashes of all character n-grams of letters of a whole text, about ``size`` at a time; a blank stands for each run of other characters.

    What a piece leaves unfinished goes on into the next, so the result doesn't depend on the cut. Nothing comes out of a text without letters.
    """
    held, some, whole = np.full(1, 32, np.uint64), False, True
    for at in range(0, len(text), size):
        c = codes(text[at : at + size])
        f = np.where(letter_table()[c], fold_table()[c], np.uint32(32))
        before = np.concatenate([held[-1:].astype(np.uint32), f[:-1]])
        f = f[(f != 32) | (before != 32)]
        some = some or bool((f != 32).any())
        last = at + size >= len(text)
        held = np.concatenate([held, f])
        if not some:
            continue
        if last:
            held = np.concatenate([held, np.full(int(held[-1] != 32), 32, np.uint64)])
            if whole:
                held = np.concatenate([held, np.full(max(0, GRAM - len(held)), 32, np.uint64)])
        n = len(held) - GRAM + 1
        if n < 1:
            continue
        out = np.zeros(n, np.uint64)
        for j in range(GRAM):
            out = out * np.uint64(0x100000001B3) + held[j : j + n]
        held, whole = held[n:], False
        yield mix(out)


def positions(grams: np.ndarray) -> list[np.ndarray]:
    return [((grams * t) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for t in _TIMES[:HASHES]]


class BitSlicedFilters:
    """``slots``: uint64 masks, a row of words for each slot; ``languages``: the language of each bit."""

    def __init__(self, slots: np.ndarray, languages: list[str]):
        self.slots, self.languages = slots, languages
        fill = np.array([np.count_nonzero(slots[:, b // 64] & np.uint64(1 << b % 64)) / len(slots) for b in range(len(languages))])
        self.false_rate = np.minimum(fill**HASHES, 0.99)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        first, *rest = positions(grams)
        out = self.slots[first]
        for p in rest:
            out &= self.slots[p]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, share of the n-grams that the best filter has, corrected); ``und`` and 0 without letters."""
        hits, n = np.zeros(len(self.languages)), 0
        for grams in gram_batches(text or ""):
            n += len(grams)
            m = self.masks(grams)
            hits += [np.count_nonzero(m[:, b // 64] & np.uint64(1 << b % 64)) for b in range(len(self.languages))]
        if not n or not self.languages:
            return "und", 0.0
        clean = np.maximum(0.0, (hits - n * self.false_rate) / (1 - self.false_rate))
        best = int(np.argmax(clean))  # ties: the first language by code point
        return self.languages[best], float(min(1.0, clean[best] / n))


def fit(labelled: DataFrame, *, sample: int = SAMPLE) -> BitSlicedFilters:
    """Filters from ``text``, ``lang`` and ``doc_id``; null texts and languages teach nothing."""
    spark = python_ready(labelled)
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return BitSlicedFilters(np.zeros((1 << SLOT_BITS, 1), np.uint64), [])
    shares = spark.createDataFrame([(x, b, min(1.0, sample / sizes[x])) for b, x in enumerate(languages)], "lang string, bit int, share double")
    dice = F.pmod(F.xxhash64(F.lit(17), "doc_id", "text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = rows.join(F.broadcast(shares), "lang").where(dice < F.col("share")).select("bit", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b, texts in batch.groupby("bit")["text"]:
                parts = [g for t in texts for g in gram_batches(t)]
                value, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
                yield pd.DataFrame({"gram": value.view(np.int64), "bit": np.int32(b), "n": n.astype(np.int64)})

    grams = chosen.mapInPandas(count, "gram long, bit int, n long").groupBy("gram", "bit").agg(F.sum("n").alias("n"))
    grams = materialise(grams, "language-grams")
    totals = grams.groupBy("bit").agg(F.sum("n").alias("total"))  # one row for each language
    rated = grams.join(F.broadcast(totals), "bit").withColumn("rate", F.col("n") / F.col("total"))
    top = rated.groupBy("gram").agg(F.max("rate").alias("most"), F.collect_list(F.struct("bit", "n", "rate")).alias("by"))
    kept = top.withColumn("x", F.explode("by")).where((F.col("x.n") >= MIN_COUNT) & (F.col("x.rate") >= F.col("most") * MIN_SHARE))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            g, bit = batch["gram"].to_numpy(np.int64).view(np.uint64), batch["bit"].to_numpy(np.int64)
            for p in positions(g):
                yield pd.DataFrame({"slot": p, "word": bit // 64, "mask": np.left_shift(np.int64(1), bit % 64)})

    bits = kept.select("gram", F.col("x.bit").alias("bit")).mapInPandas(place, "slot long, word long, mask long")
    table_ = bits.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toPandas()  # at most 2**SLOT_BITS rows for each word of the masks
    slots = np.zeros((1 << SLOT_BITS, -(-len(languages) // 64)), np.uint64)
    slots[table_["slot"].to_numpy(np.int64), table_["word"].to_numpy(np.int64)] = table_["mask"].to_numpy(np.int64).view(np.uint64)
    return BitSlicedFilters(slots, languages)


def predict(docs: DataFrame, filters: BitSlicedFilters, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score`` (replaced where they exist)."""
    sc = python_ready(docs).sparkContext
    shared = sc.broadcast((filters.slots, filters.languages))

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = BitSlicedFilters(*shared.value)
        for batch in texts:
            yield pd.DataFrame([model.predict(t) for t in batch], columns=["lang", "score"])

    udf = F.pandas_udf(run, "lang string, score double")
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "lang_score")]
    return docs.select(*keep, udf(F.col(text)).alias("_m_lang")).select(*keep, F.col("_m_lang.lang").alias("lang_pred"), F.col("_m_lang.score").alias("lang_score"))


def identify(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, lang) with ``held_out``, ``lang_pred`` and ``lang_score``.

    Learns from the rows that aren't held out. Null texts and texts without letters get ``und`` and 0;
    ties go to the first language by code point; repeated rows are predicted alike; without labelled rows all are ``und``.
    """
    docs = docs.withColumn("held_out", held_out("doc_id"))
    return predict(docs, fit(docs.where(~F.col("held_out"))))


#: Documents below this share of known n-grams are in none of the languages.
MIN_SCORE = 0.2


def known_language(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is known, columns as they were."""
    held, back = shield(docs, also=("lang_pred", "lang_score", "held_out"))
    judged = identify(held)
    kept = judged.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= min_score)).select(*held.columns)
    return kept.withColumnsRenamed(back) if back else kept


def op3_bloom_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))
