"""Substring deduplication by sliding runs of consecutive sentences.

At every sentence the shortest run of consecutive sentences is hashed that starts there, and the shortest
that ends there, with ``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words (or one sentence of
``ALONE_WORDS`` words); so a repeated passage is covered up to its last sentence.
Equal hashes are joined globally; the run that comes first by (doc_id, text, position) stays,
and sentences that any other run covers are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, python_ready, real_ids, row_hash, table, whole_ids
from .textkernel import mix, powers, span_batches

MIN_SENTENCES, MIN_WORDS, ALONE_WORDS = 2, 16, 40
#: Chinese and Japanese write no white space after a sentence.
_END = re.compile(r"(?:[.!?…]+[\"'”’»)\]]*(?=\s|$)|[。！？][.!?…。！？]*[\"'”’»)\]」』）]*|\n)\s*")
_MARK = re.compile("[.!?…。！？\n]")
_UNSPACED = re.compile("[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U000323af]")


def sentence_cuts(text: str) -> np.ndarray:
    """Character positions between sentences, with 0 and the end; the pieces make up the whole text."""
    cuts, at = [0], 0
    for mark in _MARK.finditer(text):
        if mark.start() >= at and (end := _END.match(text, mark.start())):
            at = end.end()
            cuts.append(at)
    if at < len(text):
        cuts.append(len(text))
    return np.array(cuts, np.int64)


def word_counts(text: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many words each run of letters counts as: one, or its letters of scripts that put no space between words."""
    if not _UNSPACED.search(text):
        return np.ones(len(start), np.int64)
    held = np.zeros(len(text) + 1, np.int64)
    held[[m.end() for m in _UNSPACED.finditer(text)]] = 1
    held = np.cumsum(held)
    return np.maximum(held[end] - held[start], 1)


def batch_runs(texts: Iterable[str | None], min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS, alone_words: int = ALONE_WORDS) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (index of the text, first sentence, count of sentences, hash, second hash) of the runs that start or end at each sentence."""
    for ids, bounds, words, start, stop in span_batches(texts):
        if not len(words):
            continue
        own = [sentence_cuts(texts[i] or "") + lo for i, lo in zip(ids, bounds.tolist(), strict=True)]
        cuts, sizes = np.concatenate(own), np.array([len(c) for c in own])
        lead = np.cumsum(sizes) - sizes  # the first cut of each text; the piece after its last cut holds no word
        counts = np.ones(len(words), np.int64) if not any(_UNSPACED.search(texts[i] or "") for i in ids) else word_counts("\n".join(texts[i] or "" for i in ids), start, stop)
        first = np.searchsorted(start, cuts)
        count = np.concatenate([[0], np.cumsum(counts)])[first]
        has = np.flatnonzero(np.diff(first) > 0)  # sentences without words neither start nor count
        of = np.searchsorted(lead, has, side="right") - 1
        low, high = lead[of], lead[of] + sizes[of] - 1
        rank, single = np.arange(len(has)), (count[has + 1] - count[has]) >= alone_words
        # forwards: the first cut with enough words and sentences
        kth = np.append(has, np.full(min_sentences, len(cuts)))[rank + min_sentences - 1] + 1
        until = np.where(single, has + 1, np.maximum(np.searchsorted(count, count[has] + min_words, side="left"), kth))
        ahead = until <= high
        # backwards: the last sentence at which a run can start that ends with the words of a sentence
        kth = np.concatenate([np.full(min_sentences - 1, -1), has])[: len(has)]
        back = np.where(single, has, np.minimum(np.searchsorted(count, count[has + 1] - min_words, side="right") - 1, kth))
        behind = back >= low
        a = np.concatenate([has[ahead], back[behind]])
        b = np.concatenate([until[ahead], has[behind] + 1])
        a, b = np.divmod(np.unique(a * (len(cuts) + 1) + b), len(cuts) + 1)
        power, inverse = powers(len(words) + 1)
        lo, hi, found = first[a], first[b], []
        for salt in (np.uint64(0), np.uint64(0xD6E8FEB86659FD93)):
            p = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(mix(words ^ salt) * power[: len(words)], out=p[1:])
            found.append(mix((p[hi] - p[lo]) * inverse[lo] + (hi - lo).astype(np.uint64)).view(np.int64))
        of = np.searchsorted(lead, a, side="right") - 1
        yield np.array(ids)[of], a - lead[of], b - a, *found


def sentence_runs(docs: DataFrame, **bounds: int) -> DataFrame:
    """doc_id, row (the hash of the text), at, n, h1, h2 of every run of every text; ``bounds`` as in ``batch_runs``."""
    python_ready(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for of, at, n, h1, h2 in batch_runs(batch["text"].tolist(), **bounds):
                rows = batch[["doc_id", "no_id", "row"]].iloc[of].reset_index(drop=True)
                yield rows.assign(at=at.astype(np.int32), n=n.astype(np.int32), h1=h1, h2=h2)

    rows = whole_ids(docs.select("doc_id", row_hash("text").alias("row"), "text"))
    return real_ids(rows.mapInPandas(run, "doc_id long, no_id boolean, row long, at int, n int, h1 long, h2 long"))


def repeated_runs(docs: DataFrame, **bounds: int) -> DataFrame:
    """doc_id, row, at, n, first_doc_id of every run that is not the first of its kind.

    Counts by hash come first, so that only runs that occur again are sent with their places.
    """
    found = materialise(sentence_runs(docs, **bounds), "sentence-runs")
    again = found.groupBy("h1", "h2").agg(F.count("*").alias("copies")).where("copies > 1").select("h1", "h2")
    shared = materialise(found.join(materialise(again, "repeated-hashes"), ["h1", "h2"]), "shared-runs")
    place = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row", "at")
    first = materialise(shared.groupBy("h1", "h2").agg(F.min(place).alias("first")), "first-runs")  # read back, so that the join can split a hot run
    return shared.join(first, ["h1", "h2"]).where(place != F.col("first")).select("doc_id", "row", "at", "n", F.col("first.doc_id").alias("first_doc_id"))


def without_repeats(docs: DataFrame, **bounds: int) -> DataFrame:
    """The rows that lose sentences: doc_id, n_sentences, n_removed, first_doc_ids, text (what stays), removed (what goes).

    ``bounds`` are ``min_sentences``, ``min_words`` and ``alone_words``. With ``min_words=1`` every run of ``min_sentences`` sentences counts, however short; the default leaves
    turns of phrase alone, of which any large corpus repeats some by chance.

    The first of equal runs is that of the least doc_id (null ids come last), then by a hash of the text, then by position. Rows that
    agree in id and text are one document: a run that only they hold stays in all of them, else each loses it. Rows with one id, or none, and
    different texts are judged apart; first_doc_ids leaves out null ids. Null and empty texts lose nothing and aren't in the result. Sentences compare by
    their words (letters and digits, case folded). Extra columns are left out. An empty table gives an empty table.
    """
    python_ready(docs)
    covered = repeated_runs(docs, **bounds).groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(
        F.sort_array(F.collect_set(F.struct("at", "n"))).alias("covered"), F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids")
    )
    texts = docs.select("doc_id", "text", row_hash("text").alias("row"))
    joined = texts.join(covered, (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select(
        "doc_id", "text", F.transform("covered", lambda x: x["at"]).alias("at"), F.transform("covered", lambda x: x["n"]).alias("n"), "first_doc_ids"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size, lost, stays, goes = [], [], [], []
            for text, at, n in zip(batch["text"], batch["at"], batch["n"], strict=True):
                cuts = sentence_cuts(text)
                gone = np.zeros(len(cuts), np.int64)
                np.add.at(gone, at, 1)
                np.add.at(gone, np.asarray(at) + n, -1)
                gone = np.cumsum(gone)[:-1] > 0
                # stretches of sentences that stay or go together
                turn = np.concatenate([[0], np.flatnonzero(np.diff(gone)) + 1, [len(gone)]])
                parts: tuple[list[str], list[str]] = ([], [])
                for a, b in zip(turn[:-1].tolist(), turn[1:].tolist(), strict=True):
                    parts[int(gone[a])].append(text[cuts[a] : cuts[b]])
                size.append(len(gone))
                lost.append(int(gone.sum()))
                stays.append("".join(parts[0]))
                goes.append("".join(parts[1]))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "no_id": batch["no_id"], "n_sentences": size, "n_removed": lost, "first_doc_ids": batch["first_doc_ids"], "text": stays, "removed": goes})

    return real_ids(whole_ids(joined).mapInPandas(run, "doc_id long, no_id boolean, n_sentences int, n_removed int, first_doc_ids array<long>, text string, removed string"))


def op7_sentence_spans(spark, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
