"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages. Words are hashed to ``SLOTS`` terms; document
frequencies of the passages' terms are counted over the whole corpus. A randomised SVD of the TF-IDF
passages, whose products are summed by partition, gives a latent space of ``RANK`` dimensions. Every
window of every text meets the passages (the stated query set) of which it and its surroundings hold the part
``PARAPHRASE`` of the words: these pairs are looked up by the passages' rarest words, without loss.
They are compared by cosine in the latent space, as a window and in runs of the passage's own length, and
verified by the longest common subsequence of words and, for paraphrases, by the item's answer (its last sentence).

Sizes are bounded: the term table has ``SLOTS`` entries and the basis ``SLOTS`` x ``RANK`` floats
at most; passages go to the executors ``BLOCK_PASSAGES`` at a time, each block in a search of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, python_ready, real_ids, row_hash, shielded, table, whole_ids
from .spans import sentence_cuts
from .textkernel import word_batches, word_spans

SLOT_BITS, RANK, OVERSAMPLE, ROUNDS = 16, 96, 16, 2
SLOTS = 1 << SLOT_BITS
WINDOW, STRIDE, BLOCK_PASSAGES = 32, 8, 50_000
#: A window, or a run in it as long as the passage, is a candidate at this cosine; a copy shares this part of a passage's words in order, a paraphrase less but the answer's words too.
MIN_COSINE, COPY, PARAPHRASE, ANSWER = 0.5, 0.8, 0.6, 0.5
#: A passage of fewer words is held only by a text that has it word for word: a few words in order are no sign of it.
SHORT = 5
#: Pairs of windows and passages that are looked up at once, but for those of a single window; terms whose sums travel together.
PAIRS, TERM_BLOCK = 1 << 18, 64


def _slots(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def passages(text: str | None) -> list[np.ndarray]:
    """Word hashes of windows of ``WINDOW`` words, half overlapping; the last ends with the text."""
    words = word_spans(text)[0] if text else np.zeros(0, np.uint64)
    if len(words) <= WINDOW:
        return [words] if len(words) else []
    starts = [*range(0, len(words) - WINDOW, WINDOW // 2), len(words) - WINDOW]
    return [words[s : s + WINDOW] for s in starts]


def answer_words(text: str) -> np.ndarray:
    """The words of the last sentence that has any."""
    cuts = sentence_cuts(text)
    words, start, _ = word_spans(text)
    if not len(words):
        return words
    first = np.searchsorted(start, cuts)
    last = np.flatnonzero(np.diff(first) > 0)[-1]
    return words[first[last] : first[last + 1]]


def lcs_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence (bit-parallel over ``a``)."""
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b.tolist():
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def held_whole(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether ``a`` is a run of consecutive words of ``b``."""
    if len(a) > len(b):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(b, len(a)) == a).all(1).any())


def document_frequencies(docs: DataFrame, used: np.ndarray) -> tuple[np.ndarray, int]:
    """How many rows of ``docs`` hold each term marked in ``used``, and the count of rows."""
    shared = python_ready(docs).sparkContext.broadcast(used)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marked, total, rows = shared.value, np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            rows += len(batch)
            for ids, offsets, words in word_batches(batch["text"]):
                slot = _slots(words)
                hit = np.flatnonzero(marked[slot])
                doc = np.repeat(np.arange(len(ids)), np.diff(offsets))[hit]
                pairs = np.unique(doc * SLOTS + slot[hit])
                total += np.bincount(pairs % SLOTS, minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"slot": np.append(at, -1), "n": np.append(total[at], rows)})

    sums = docs.select("text").mapInPandas(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    shared.destroy()
    out, rows = np.zeros(SLOTS), 0
    for r in sums:
        if r["slot"] < 0:
            rows = r["n"]
        else:
            out[r["slot"]] = r["n"]
    return out, rows


class Space:
    """Term weights and the projection of the terms in use to the latent space."""

    def __init__(self, used: np.ndarray, idf: np.ndarray, other: float, basis: np.ndarray):
        self.index = np.full(SLOTS, len(basis), np.int32)
        self.index[used] = np.arange(len(basis))
        self.weight = np.full(SLOTS, other, np.float32)
        self.weight[used] = idf[used]
        self.vectors = np.vstack([basis * idf[used][:, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)

    def project(self, words: np.ndarray) -> np.ndarray:
        v = self.vectors[self.index[_slots(words)]].sum(0)
        return v / max(float(np.linalg.norm(v)), 1e-9)


def _row_vector(words: np.ndarray, index: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    slot, n = np.unique(_slots(words), return_counts=True)
    x = n * idf[slot]
    return index[slot], x / max(float(np.linalg.norm(x)), 1e-9)


def randomised_svd(benchmark: DataFrame, used: np.ndarray, idf: np.ndarray, rank: int = RANK, rounds: int = ROUNDS, seed: int = 11) -> np.ndarray:
    """Right singular vectors (terms in use x rank) of the TF-IDF passages of ``benchmark`` (text).

    Each round sends a thin matrix out and sums ``A^T (A Q)`` over the partitions by blocks of terms.
    """
    sc = python_ready(benchmark).sparkContext
    n = len(used)
    width = min(rank + OVERSAMPLE, n)
    index = np.full(SLOTS, -1, np.int64)
    index[used] = np.arange(n)
    q = np.random.default_rng(seed).normal(size=(n, width))
    z = q
    for _ in range(rounds):
        q = np.linalg.qr(z)[0]
        shared = sc.broadcast((q, index, idf))

        def run(batches: Iterator[pd.DataFrame], shared=shared, n=n, width=width) -> Iterator[pd.DataFrame]:
            q, index, idf = shared.value
            out, touched = np.zeros((n, width)), np.zeros(n, bool)
            for batch in batches:
                for text in batch["text"]:
                    for words in passages(text):
                        at, x = _row_vector(words, index, idf)
                        out[at] += x[:, None] * (x @ q[at])
                        touched[at] = True
            blocks = np.unique(np.flatnonzero(touched) // TERM_BLOCK)
            yield pd.DataFrame({"block": blocks, "v": [out[i * TERM_BLOCK : (i + 1) * TERM_BLOCK].tobytes() for i in blocks]})

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"block": rows["block"].iloc[:1], "v": [np.sum([np.frombuffer(v) for v in rows["v"]], axis=0).tobytes()]})

        z = np.zeros((n, width))
        for r in benchmark.mapInPandas(run, "block long, v binary").groupBy("block").applyInPandas(add, "block long, v binary").collect():
            z[r["block"] * TERM_BLOCK : (r["block"] + 1) * TERM_BLOCK] = np.frombuffer(r["v"]).reshape(-1, width)
        shared.destroy()
    values, vectors = np.linalg.eigh(q.T @ z)
    best = np.argsort(-values)[:rank]
    return q @ vectors[:, best]


def _windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of the windows of a batch of documents, in words of the batch."""
    size = np.diff(offsets)
    count = np.where(size > WINDOW, -(-(size - WINDOW) // STRIDE) + 1, np.minimum(size, 1))
    doc = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(offsets[doc] + nth * STRIDE, np.maximum(offsets[doc + 1] - WINDOW, offsets[doc]))
    return doc, start, np.minimum(start + WINDOW, offsets[doc + 1])


def _block_sums(vectors: np.ndarray, term: np.ndarray, offsets: np.ndarray, start: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the term vectors over the blocks of ``STRIDE`` words that the windows at ``start`` take up.

    Returns the sums, with a zero block at the end, and the first block of each document.
    """
    size = np.diff(offsets)
    blocks = -(-size // STRIDE)
    first = np.concatenate([[0], np.cumsum(blocks)])
    null = len(vectors) - 1
    padded = np.full(first[-1] * STRIDE, null, np.int32)
    padded[np.arange(len(term)) + np.repeat(first[:-1] * STRIDE - offsets[:-1], size)] = term
    padded = padded.reshape(-1, STRIDE)
    need = np.zeros(first[-1] + WINDOW // STRIDE + 1, bool)
    lead = first[doc] + (start - offsets[doc]) // STRIDE
    for k in range(WINDOW // STRIDE):
        need[lead + k] = True
    used = np.flatnonzero(need[: first[-1]])
    sums = np.zeros((first[-1] + 1, vectors.shape[1]), np.float32)
    for lo in range(0, len(used), 4096):
        at = used[lo : lo + 4096]
        sums[at] = np.einsum("ijk->ik", vectors[padded[at]])
    return sums, first


def _window_sums(vectors, term, sums, first, offsets, doc, start, end) -> np.ndarray:
    """Sums of the term vectors over windows: of whole blocks where a window starts with one, else word by word."""
    gap = start - offsets[doc]
    lead = first[doc] + gap // STRIDE
    out = np.zeros((len(doc), vectors.shape[1]), np.float32)
    for k in range(WINDOW // STRIDE):
        out += sums[np.where(lead + k < first[doc + 1], lead + k, len(sums) - 1)]
    odd = np.flatnonzero(gap % STRIDE)
    if len(odd):
        at = start[odd][:, None] + np.arange(WINDOW)
        inside = at < end[odd][:, None]
        rows = np.where(inside, term[np.minimum(at, len(term) - 1)], len(vectors) - 1)
        out[odd] = np.einsum("ijk->ik", vectors[rows])
    return out


def _shared_words(term, terms, lengths, at, passage, lo, hi) -> np.ndarray:
    """Which pairs (window, passage) can reach the least overlap: those whose region holds enough of the passage's words."""
    out = np.zeros(len(at), bool)
    width = 2 * WINDOW
    order = np.argsort(at, kind="stable")
    for first in range(0, len(lo), 256):
        s, e = np.searchsorted(at, [first, first + 256], sorter=order)
        if s == e:
            continue
        n = min(256, len(lo) - first)
        cell = lo[first : first + n, None] + np.arange(width)
        inside = cell < hi[first : first + n, None]
        present = np.zeros((n, terms.max() + 2), bool)
        row, col = np.nonzero(inside)
        known = term[cell[row, col]]
        ok = known < present.shape[1] - 1
        present[row[ok], known[ok]] = True
        for k in range(s, e, 200_000):
            pairs = order[k : min(e, k + 200_000)]
            found = present[(at[pairs] - first)[:, None], terms[passage[pairs]]]
            out[pairs] = found.sum(1) >= PARAPHRASE * lengths[passage[pairs]]
    return out


def _postings(terms: np.ndarray, lengths: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The passages by their rarest terms, so many of each that ``PARAPHRASE`` of its words can't do without all of them.

    Returns the first place of each term, with the end, and the passages.
    """
    weight = np.where(terms >= 0, idf[terms], -1)
    order = np.argsort(-weight, axis=1, kind="stable")
    least = np.ceil(PARAPHRASE * lengths - 1e-9).astype(np.int64)
    passage, nth = np.nonzero(np.arange(terms.shape[1]) < (lengths - least + 1)[:, None])
    pairs = np.unique(terms[passage, order[passage, nth]].astype(np.int64) * len(terms) + passage)
    term, passage = np.divmod(pairs, len(terms))
    return np.searchsorted(term, np.arange(len(idf) + 1)), passage


def _candidates(term, first, posted, passages, lo, hi) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (window, passage) whose region holds one of the passage's posted terms, about ``PAIRS`` at a time."""
    count = np.append(np.diff(first), 0)[term]
    hot = np.flatnonzero(count)
    count, lead = count[hot], first[term[hot]]
    lo, hi = np.searchsorted(hot, lo), np.searchsorted(hot, hi)
    before = np.concatenate([[0], np.cumsum(count)])
    total = np.concatenate([[0], np.cumsum(before[hi] - before[lo])])
    a = 0
    while a < len(lo):
        b = max(a + 1, int(np.searchsorted(total, total[a] + PAIRS, side="right")) - 1)
        size = hi[a:b] - lo[a:b]
        word = np.repeat(lo[a:b] - np.cumsum(size) + size, size) + np.arange(size.sum())
        each = count[word]
        place = np.repeat(lead[word] - np.cumsum(each) + each, each) + np.arange(each.sum())
        window = np.repeat(np.repeat(np.arange(a, b), size), each)
        yield np.divmod(np.unique(window * passages + posted[place]), passages)
        a = b


def _run_cosine(vectors: np.ndarray, term: np.ndarray, target: np.ndarray, length: int) -> float:
    """The largest cosine of a run of ``length`` words with a passage."""
    sums = np.cumsum(np.vstack([np.zeros((1, vectors.shape[1])), vectors[term]]), axis=0)
    length = min(length, len(term))
    runs = sums[length:] - sums[:-length]
    return float((runs @ target / np.maximum(np.sqrt(np.einsum("ij,ij->i", runs, runs)), 1e-9)).max())


def _search_block(docs: DataFrame, passage: list[np.ndarray], answer: list[np.ndarray], space: Space, used: np.ndarray) -> DataFrame:
    """doc_id, row, passage (its number), cosine, overlap of the rows of ``docs`` that hold one of the passages, written down."""
    targets = np.stack([space.project(w) for w in passage]).astype(np.float32)
    shared = python_ready(docs).sparkContext.broadcast((space, targets, passage, answer, used))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space, targets, passage, answer, used = shared.value
        lengths = np.array([len(w) for w in passage])
        terms = np.full((len(passage), WINDOW), -1, np.int32)
        for k, w in enumerate(passage):
            terms[k, : len(w)] = space.index[_slots(w)]
        first, posted = _postings(terms, lengths, space.weight[used])
        for batch in batches:
            best: dict[tuple[int, int], tuple[float, float]] = {}
            for ids, offsets, hashes in word_batches(batch["text"]):
                if not len(hashes):
                    continue
                doc, start, end = _windows(offsets)
                term = space.index[_slots(hashes)]
                region_lo = np.maximum(offsets[doc], start - WINDOW // 2)
                region_hi = np.minimum(offsets[doc + 1], end + WINDOW // 2)
                for at, near_to in _candidates(term, first, posted, len(passage), region_lo, region_hi):
                    low, high = at[:1].sum(), at[-1:].sum() + 1
                    held = _shared_words(term, terms, lengths, at - low, near_to, region_lo[low:high], region_hi[low:high])
                    at, near_to = at[held], near_to[held]
                    if not len(at):
                        continue
                    rich, of = np.unique(at, return_inverse=True)
                    sums, at_block = _block_sums(space.vectors, term, offsets, start[rich], doc[rich])
                    x = _window_sums(space.vectors, term, sums, at_block, offsets, doc[rich], start[rich], end[rich])
                    x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x))[:, None], 1e-9)
                    for w, k, p in zip(at.tolist(), of.tolist(), near_to.tolist(), strict=True):
                        key = (ids[doc[w]], p)
                        if key in best and best[key][1] >= 1:
                            continue
                        a, b = region_lo[w], region_hi[w]
                        if lengths[p] < SHORT:
                            overlap = float(held_whole(passage[p], hashes[a:b]))
                        else:
                            overlap = lcs_length(passage[p], hashes[a:b]) / len(passage[p])
                        if overlap < PARAPHRASE:
                            continue
                        if overlap < COPY:
                            near = hashes[a : min(offsets[doc[w] + 1], b + WINDOW)]
                            if np.isin(answer[p], near).mean() < ANSWER:
                                continue
                        cosine = float(x[k] @ targets[p])
                        if cosine < MIN_COSINE:
                            cosine = _run_cosine(space.vectors, term[a:b], targets[p], len(passage[p]))
                        if cosine >= MIN_COSINE:
                            best[key] = max(best.get(key, (0.0, 0.0)), (cosine, overlap), key=lambda v: v[1])
            at = [d for d, _ in best]
            yield batch[["doc_id", "no_id", "row"]].iloc[at].reset_index(drop=True).assign(
                passage=np.array([p for _, p in best], np.int64), cosine=np.array([c for c, _ in best.values()], float), overlap=np.array([o for _, o in best.values()], float)
            )

    rows = whole_ids(docs.select("doc_id", row_hash("text").alias("row"), "text"))
    found = materialise(rows.mapInPandas(search, "doc_id long, no_id boolean, row long, passage long, cosine double, overlap double"), "leaks-found")
    shared.destroy()
    return real_ids(found)


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, row, item_id, cosine, overlap: the rows of ``docs``, told apart by the hash of the text, and what they hold."""
    spark = python_ready(docs)
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("doc_id"), "text")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, n, w.tobytes(), answer_words(t).tobytes()) for i, n, t in zip(batch["doc_id"], batch["no_id"], batch["text"], strict=True) for w in passages(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "no_id", "words", "answer"])

    pieces = real_ids(whole_ids(items).mapInPandas(cut, "doc_id long, no_id boolean, words binary, answer binary")).withColumnRenamed("doc_id", "item_id").distinct()
    pieces = materialise(pieces, "leak-passages")
    schema = "doc_id long, row long, item_id long, cosine double, overlap double"
    n_pieces = pieces.count()
    if not n_pieces:
        return spark.createDataFrame([], schema)
    slots = F.transform(F.sequence(F.lit(7), F.length("words"), F.lit(8)), lambda i: F.substring("words", i, F.lit(2)))
    # a word's slot is its highest two bytes, the last ones as numpy writes them
    marked = np.zeros(SLOTS, bool)
    for r in pieces.select(F.explode(slots).alias("s")).distinct().collect():
        marked[int.from_bytes(r["s"], "little")] = True
    used = np.flatnonzero(marked)
    df, n_docs = document_frequencies(docs, marked)
    idf = np.zeros(SLOTS)
    idf[used] = np.log1p((n_docs + 1) / (df[used] + 1))
    space = Space(used, idf, float(idf[used].mean()), randomised_svd(items, used, idf))
    blocks, found = -(-n_pieces // BLOCK_PASSAGES), None
    for k in range(blocks):
        part = pieces.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k)
        held = sorted((bytes(r["words"]), bytes(r["answer"])) for r in part.select("words", "answer").distinct().collect())
        if not held:
            continue
        words, answers = ([np.frombuffer(x[i], np.uint64) for x in held] for i in (0, 1))
        numbered = spark.createDataFrame([(i, *x) for i, x in enumerate(held)], "passage long, words binary, answer binary")
        leaks = _search_block(docs, words, answers, space, used).join(numbered.join(part, ["words", "answer"]).select("passage", "item_id"), "passage")
        found = leaks if found is None else found.unionByName(leaks)
    return found.select("doc_id", "row", "item_id", "cosine", "overlap")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, overlap (share of the passage's words in order) for each document and item that it holds.

    ``docs``: doc_id, text; ``benchmark``: item_id, text. Null and wordless texts hold nothing; a passage of fewer than ``SHORT`` words is held
    only word for word. Rows with one doc_id count as one document, items with one id as one item; null ids are ids like others.
    """
    return _leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("overlap").alias("overlap"))


@shielded
def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, columns as they were. Rows with one id, or none, are judged by their own texts."""
    leaked = _leaks(docs, benchmark).select(F.col("doc_id").alias("_m_leaked"), F.col("row").alias("_m_row")).distinct()
    return docs.join(leaked, (row_hash(docs["text"]) == F.col("_m_row")) & docs["doc_id"].eqNullSafe(F.col("_m_leaked")), "left_anti")


def op4_latent_leaks(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
