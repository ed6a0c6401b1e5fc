"""How far the sources of each language are apart in their terms, in exact whole numbers.

A byte-level tokenizer finds terms: a lookup table over the concatenated UTF-8 of a batch marks letters and lower-cases them, edges of that mask are
the terms' bounds, xxhash groups the slices, and each slice is compared byte by byte with its group's first, so that no collision joins two terms.
Counts by language, source and term are summed up in Spark, terms in too few documents go, and what stays is
dealt out in blocks of terms. A block is one CSR matrix (sources by terms) in which sums over rows by ``reduceat`` give its part of every pair's divergence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, python_ready, table

MIN_DOCUMENTS, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Entries of one block, pairs that one task of it gives, and slices that are compared at a time.
BLOCK_ENTRIES, TASK_PAIRS, COMPARE = 1 << 18, 1 << 20, 1 << 16

#: Bytes of terms, lower-cased: ASCII letters and all bytes beyond ASCII; 0 for all else.
_LETTERS = np.array([c if c >= 128 or chr(c).islower() else c + 32 if chr(c).isupper() else 0 for c in range(256)], np.uint8)


def term_slices(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, ends, document of each) of the terms of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    low = _LETTERS[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = low > 0
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    # a text ends a term, even if the next one goes on with a letter
    firsts = offsets[:-1][np.diff(offsets) > 0]
    begins[firsts] = inside[firsts]
    starts = np.flatnonzero(begins)
    stops[:-1] = inside[:-1] & (~inside[1:] | begins[1:])
    ends = np.flatnonzero(stops) + 1
    return low, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def slice_groups(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, digest=xxhash.xxh3_64_intdigest) -> tuple[np.ndarray, list[bytes]]:
    """(group of each slice, bytes of each group): slices are in one group if, and only if, their bytes are the same."""
    raw = low.tobytes()
    view = memoryview(raw)
    hashes = np.fromiter((digest(view[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
    _, first, group = np.unique(hashes, return_index=True, return_inverse=True)
    own, size = starts[first][group], ends - starts
    wrong = size != (ends - starts)[first][group]
    for at in range(0, len(starts), COMPARE):
        at = slice(at, at + COMPARE)
        same = np.flatnonzero(~wrong[at]) + at.start
        if not len(same):
            continue
        step = np.cumsum(size[same])
        inner = np.arange(step[-1]) - np.repeat(step - size[same], size[same])
        differs = low[np.repeat(starts[same], size[same]) + inner] != low[np.repeat(own[same], size[same]) + inner]
        wrong[same] = np.add.reduceat(differs, step - size[same], dtype=np.int64) > 0
    terms = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    if wrong.any():
        others: dict[bytes, int] = {}
        for i in np.flatnonzero(wrong).tolist():
            term = raw[starts[i] : ends[i]]
            group[i] = others.setdefault(term, len(terms))
            if group[i] == len(terms):
                terms.append(term)
    return group, terms


def _batch_counts(docs: np.ndarray, groups: np.ndarray, terms: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, term, occurrences, documents) of the slices with these documents and terms; ``groups`` has each document's."""
    pair, times = np.unique(docs * n_terms + terms, return_counts=True)
    key, at = np.unique(groups[pair // n_terms] * n_terms + pair % n_terms, return_inverse=True)
    return key // n_terms, key % n_terms, np.bincount(at, times, len(key)).astype(np.int64), np.bincount(at, minlength=len(key))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, documents): occurrences of each term in the texts of each language and source, and the rows that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            offsets = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, text.offset * 4).astype(np.int64) if len(text) else np.zeros(1, np.int64)
            data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if text.buffers()[2] else np.zeros(0, np.uint8)
            low, starts, ends, doc = term_slices(data, offsets - offsets[0])
            if not len(starts):
                continue
            group, terms = slice_groups(low, starts, ends)
            named = batch.select(["lang", "source"]).to_pandas()
            of_doc = named.groupby(["lang", "source"], sort=False).ngroup().to_numpy()
            g, t, count, documents = _batch_counts(doc, of_doc, group, len(terms))
            names = named.iloc[np.unique(of_doc, return_index=True)[1]]
            take = lambda values, at: pa.array(values, pa.string()).take(pa.array(at))
            words = pa.array(terms, pa.binary()).cast(pa.string()).take(pa.array(t))
            yield pa.RecordBatch.from_arrays([take(names["lang"], g), take(names["source"], g), words, pa.array(count), pa.array(documents)], ["lang", "source", "term", "count", "documents"])

    python_ready(docs)
    whole = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = whole.mapInArrow(run, "lang string, source string, term string, count long, documents long")
    return found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("documents").alias("documents"))


def shares(count: np.ndarray, total, terms: int) -> np.ndarray:
    """1 + floor(SCALE (count + PRIOR) / (total + PRIOR terms)), exact for totals up to 9 10^15: a long division, three digits at a time."""
    below = np.asarray(total, np.int64) + PRIOR * terms
    rest, out = np.asarray(count, np.int64) + PRIOR, np.zeros(np.shape(count), np.int64)
    whole, rest = np.divmod(rest, below)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + digits
    return 1 + whole * SCALE + out


def block_parts(entries: pd.DataFrame, groups: pd.DataFrame, part: int = 0, parts: int = 1, first: bool = True, top: int = TOP) -> pd.DataFrame:
    """(source, part, item, value) that one block of a language's terms adds.

    ``entries`` (source, term, count, lang_count) are the occurring ones of the block, ``groups`` (source, total, lang_total, terms) all sources of the
    language. Pairs are given for the sources of this ``part`` of ``parts``, and, where the block adds nothing to them, only by the ``first`` block.
    """
    groups = groups.sort_values("source")
    names, total = groups["source"].to_numpy(object), groups["total"].to_numpy(np.int64)
    n, n_terms, lang_total = len(groups), int(groups["terms"].iloc[0]), int(groups["lang_total"].iloc[0])
    mine = np.arange(part, n, parts)
    words, column = np.unique(entries["term"].to_numpy(object), return_inverse=True) if len(entries) else (np.zeros(0, object), np.zeros(0, np.int64))
    row = np.searchsorted(names, entries["source"].to_numpy(object)) if len(entries) else np.zeros(0, np.int64)
    order = np.lexsort((column, row))
    column, row, count = column[order], row[order], entries["count"].to_numpy(np.int64)[order]
    starts = np.searchsorted(row, np.arange(n + 1))
    full = np.flatnonzero(np.diff(starts))
    pairs, found = [], np.zeros(0, np.int64)
    if len(words) or (first and not n_terms):
        none = shares(np.zeros(n, np.int64), total, n_terms) if n_terms else np.zeros(n, np.int64)
        held = shares(count, total[row], n_terms) if len(words) else count
        for g in mine.tolist():
            own = slice(starts[g], starts[g + 1])
            line = np.full(len(words), none[g])
            line[column[own]] = held[own]
            sums = np.zeros(n, np.int64)
            if len(full):
                at = line[column]
                sums[full] = np.add.reduceat(np.abs(held - at) - np.abs(none[row] - at), starts[full])
            # sources without a term stand at their empty share: the line's own entries in order, the others all at its empty share
            rank = np.sort(held[own])
            before = np.concatenate([[0], np.cumsum(rank)])
            k = np.searchsorted(rank, none)
            sums += none * k - before[k] + (before[-1] - before[k]) - none * (len(rank) - k) + (len(words) - len(rank)) * np.abs(none - none[g])
            pairs.append(np.delete(sums, g))
        lang = np.zeros(len(words), np.int64)
        lang[column] = entries["lang_count"].to_numpy(np.int64)[order]
        lead = held - shares(lang, lang_total, n_terms)[column] if len(words) else held
        good = np.flatnonzero((lead > 0) & (row % parts == part))
        good = good[np.lexsort((column[good], -lead[good], row[good]))]
        place = np.arange(len(good)) - np.searchsorted(row[good], row[good])
        found = good[place < top]
    else:
        lead = count
        pairs = [np.zeros(n - 1, np.int64)] * len(mine) if first else []
    others = [np.delete(names, g) for g in mine.tolist()] if pairs else []
    n_pairs = sum(map(len, pairs))
    out = {
        "source": [*np.repeat(names[mine], n - 1 if pairs else 0), *names[row[found]]],
        "part": ["pair"] * n_pairs + ["term"] * len(found),
        "item": [x for line in [*others, words[column[found]]] for x in line],
        "value": np.concatenate([*pairs, lead[found]]).astype(np.int64),
    }
    return pd.DataFrame({c: pd.Series(x, dtype=np.int64 if c == "value" else object) for c, x in out.items()})


def divergences(docs: DataFrame, *, min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (text, lang, source).

    ``pair``: the summed differences between a source's shares of the language's kept terms and those of each other source. ``term``: the ``top`` terms in which a
    source exceeds the language most. Null texts, languages and sources are empty strings; a source without terms takes part with its smoothed shares; a language
    without kept terms gives pairs of value 0. Repeated rows count each time; texts of any length count whole; ids and other columns are not read; an empty table gives none.
    """
    spark = python_ready(docs)
    rows = term_counts(docs)
    by_term = Window.partitionBy("lang", "term")
    kept = rows.withColumn("lang_documents", F.sum("documents").over(by_term)).withColumn("lang_count", F.sum("count").over(by_term)).where(F.col("lang_documents") >= min_documents)
    kept = materialise(kept.select("lang", "source", "term", "count", "lang_count"), "divergence-terms")
    blocks = max(1, math.ceil(kept.count() / BLOCK_ENTRIES))
    by_lang = Window.partitionBy("lang")
    occurring = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    sizes = kept.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("*").alias("terms"))
    groups = occurring.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").withColumn("total", F.coalesce("total", F.lit(0))).withColumn("terms", F.coalesce("terms", F.lit(0)))
    groups = materialise(groups.withColumn("lang_total", F.sum("total").over(by_lang)).withColumn("n", F.count("*").over(by_lang)), "divergence-groups")
    # a language of many sources is dealt out by sources too, so that no task gives over TASK_PAIRS pairs or so
    most = groups.agg(F.max("n")).first()[0] or 0
    parts = max(1, math.ceil(most * most / TASK_PAIRS))
    numbered = lambda df: df.withColumn("part_no", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    entries = numbered(kept.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")))
    lines = numbered(groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def run(key, found: pd.DataFrame, every: pd.DataFrame) -> pd.DataFrame:
        out = block_parts(found, every, int(key[2]), parts, int(key[1]) == 0, top)
        return out.assign(lang=key[0])[["lang", "source", "part", "item", "value"]]

    keys = ("lang", "block", "part_no")
    given = entries.groupBy(*keys).cogroup(lines.groupBy(*keys)).applyInPandas(run, "lang string, source string, part string, item string, value long")
    summed = given.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return summed.withColumn("rank", place).where((F.col("part") == "pair") | (F.col("rank") <= top))


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS lang_count FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= 30
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), langs AS (
  SELECT lang, count(*) AS v, sum(lang_count) AS total FROM kept GROUP BY lang
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (g.total + 5 * l.v)::HUGEINT AS p,
    1 + (1000000000 * (k.lang_count + 5)::HUGEINT) // (l.total + 5 * l.v)::HUGEINT AS q
  FROM totals g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts QUALIFY part = 'pair' OR rank <= 50
"""
