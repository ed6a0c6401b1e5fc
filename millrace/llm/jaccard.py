"""Jaccard self-join on word shingles with Bayesian pruning of MinHash candidates.

Texts with the same words form a class, and one text stands for it. Representatives whose
signatures agree in one of ``BANDS`` bands share a bucket; buckets are linked as stars, and the
components of those links hold all candidate pairs. A component is one unit of work, or if it is large, each
pair of its blocks that have a bucket in common: MinHash values are compared ``STEP`` at a time, pairs go
whose posterior probability of reaching the threshold falls below ``TOLERANCE`` (uniform prior, binomial
matches), and the rest are verified on the exact shingle sets. Units put out links by row, never pairs.

Blocks keep texts of like buckets together, so a component that weak likenesses string out costs in proportion to
its buckets. Only a group whose texts all share buckets meets all its blocks: its rows go to as many
units as it has blocks of ``BLOCK_ROWS``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, python_ready, real_ids, row_hash, shielded, table, whole_ids
from .graph import connected_components
from .textkernel import minhash, shingle_batch, word_batches

WORDS, THRESHOLD = 5, 0.8
#: 25 bands of 5 values miss a pair at the threshold with probability 5e-5.
BANDS, ROWS, HASHES, STEP, TOLERANCE = 25, 5, 128, 16, 1e-6
BLOCK_ROWS, BLOCK_SHINGLES, PACK_ROWS = 2048, 1_000_000, 1500


def min_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For 0, 1, .. ``HASHES`` compared values: the fewest matches at which a pair stays."""
    out = []
    for n in range(HASHES + 1):
        # P(J >= t | m of n agree) = P(Binomial(n + 1, t) <= m)
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _digest(words: np.ndarray, text: str) -> bytes:
    body = b"w" + words.tobytes() if len(words) else b"t" + text.encode("utf-8", "surrogatepass")
    return hashlib.blake2b(body, digest_size=16).digest()


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, row (the hash of the text), digest (null for a null text), n_shingles, signature of each row."""
    python_ready(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, own = batch["text"].tolist(), batch[["doc_id", "no_id", "row"]]
            for ids, offsets, words in word_batches(texts):
                so, sh = shingle_batch(offsets, words, WORDS)
                sig = minhash(so, sh, HASHES)
                yield own.iloc[ids].reset_index(drop=True).assign(
                    digest=[None if texts[i] is None else _digest(words[offsets[k] : offsets[k + 1]], texts[i]) for k, i in enumerate(ids)],
                    n_shingles=np.diff(so).astype(np.int64),
                    signature=[s.tobytes() for s in sig],
                )

    rows = whole_ids(docs.select("doc_id", row_hash("text").alias("row"), "text"))
    return real_ids(rows.mapInPandas(run, "doc_id long, no_id boolean, row long, digest binary, n_shingles long, signature binary"))


def band_keys() -> Column:
    """The hashes of the bands of ``signature``."""
    width = ROWS * 4
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * width + 1, F.lit(width))))


def bucket_stars(reps: DataFrame) -> DataFrame:
    """Edges (u, v) from each representative to the least of every bucket that it shares."""
    bands = reps.where("n_shingles > 0").select("digest", F.explode(band_keys()).alias("band"))
    heads = bands.groupBy("band").agg(F.min("digest").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
    return bands.join(heads, "band").where("digest <> v").select(F.col("digest").alias("u"), "v")


def block_count() -> Column:
    """How many blocks hold ``n`` rows of ``weight`` shingles."""
    return F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")


def cut_large(members: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, pairs) for the components that need several blocks. blocks: digest, block; pairs: block, first, second.

    A text goes where the least text of all its buckets goes, and such places are cut by hash to the size of a block.
    ``pairs`` has the units of each block: it and every block that has a text in one of the same buckets.
    """
    sums = F.count("*").alias("n"), F.sum("n_shingles").alias("weight")
    large = members.groupBy("comp").agg(*sums).select("comp", block_count().alias("blocks")).where("blocks > 1")
    large = materialise(large, "jaccard-large")
    inside = members.join(large, "comp").select("digest", "comp", "blocks", "n_shingles")
    bands = materialise(inside.join(reps.select("digest", "signature"), "digest").select("digest", F.explode(band_keys()).alias("band")), "jaccard-bands")
    heads = materialise(bands.groupBy("band").agg(F.min("digest").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n"), "jaccard-heads")
    homes = bands.join(heads, "band").groupBy("digest").agg(F.min("head").alias("home"))
    place = F.pmod(F.xxhash64(F.coalesce("home", "digest")), F.col("blocks"))
    placed = materialise(inside.join(homes, "digest", "left").select("digest", "comp", "n_shingles", place.alias("place")), "jaccard-places")
    cuts = materialise(placed.groupBy("comp", "place").agg(*sums).select("comp", "place", block_count().alias("cuts")), "jaccard-cuts")
    block = F.xxhash64("comp", "place", F.pmod(F.xxhash64("digest"), F.col("cuts"))).bitwiseOR(F.lit(1))
    blocks = materialise(placed.join(cuts, ["comp", "place"]).select("digest", block.alias("block")), "jaccard-blocks")
    met = bands.join(heads.select("band"), "band").join(blocks, "digest").select("band", "block").distinct()
    met = materialise(met, "jaccard-met")
    pairs = met.select("band", F.col("block").alias("first")).join(met.select("band", F.col("block").alias("second")), "band").where("first < second")
    own = blocks.select(F.col("block").alias("first"), F.col("block").alias("second"))
    pairs = pairs.select("first", "second").unionByName(own).distinct()
    return blocks, materialise(pairs.select(F.explode(F.array_distinct(F.array("first", "second"))).alias("block"), "first", "second"), "jaccard-pairs")


def _surviving(a: np.ndarray, b: np.ndarray, same: bool, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    matches = np.zeros((len(a), len(b)), np.uint8)
    for k in range(STEP):
        matches += a[:, k, None] == b[None, :, k]
    keep = matches >= least[STEP]
    if same:
        keep = np.triu(keep, 1)
    i, j = np.nonzero(keep)
    count = matches[i, j].astype(np.int32)
    for lo in range(STEP, HASHES, STEP):
        for at in range(0, len(i), 100_000):
            part = slice(at, at + 100_000)
            count[part] += (a[i[part], lo : lo + STEP] == b[j[part], lo : lo + STEP]).sum(1)
        ok = count >= least[lo + STEP]
        i, j, count = i[ok], j[ok], count[ok]
    return i, j


def _exact(sets_a: list[np.ndarray], sets_b: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs reach the threshold, on the shingle sets (sorted, distinct)."""
    size_a, size_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    total = size_a[i] + size_b[j]
    able = np.minimum(size_a[i], size_b[j]) >= threshold * np.maximum(size_a[i], size_b[j])
    shared = np.zeros(len(i), np.int64)
    flat_a, flat_b = np.concatenate(sets_a), np.concatenate(sets_b)
    both = np.intersect1d(np.unique(flat_a), np.unique(flat_b), assume_unique=True)
    cells = len(sets_a) * len(sets_b)
    if able.sum() * 15e-6 <= len(both) * cells * 7e-11 + 0.01:
        for k in np.flatnonzero(able):
            shared[k] = len(np.intersect1d(sets_a[i[k]], sets_b[j[k]], assume_unique=True))
    else:
        # all intersections of the two blocks at once, as products of incidence matrices by column
        def columns(flat, sizes):
            col = np.searchsorted(both, flat)
            hit = np.flatnonzero((col < len(both)) & (both[np.minimum(col, len(both) - 1)] == flat))
            row = np.repeat(np.arange(len(sizes)), sizes)[hit]
            order = np.argsort(col[hit], kind="stable")
            return row[order], col[hit][order]

        row_a, col_a = columns(flat_a, size_a)
        row_b, col_b = columns(flat_b, size_b)
        grid = np.zeros((len(sets_a), len(sets_b)), np.float32)
        step = 2048
        for lo in range(0, len(both), step):
            parts = []
            for row, col, n in ((row_a, col_a, len(sets_a)), (row_b, col_b, len(sets_b))):
                s, e = np.searchsorted(col, [lo, lo + step])
                x = np.zeros((n, min(step, len(both) - lo)), np.float32)
                x[row[s:e], col[s:e] - lo] = 1
                parts.append(x)
            grid += parts[0] @ parts[1].T
        shared = grid[i, j].astype(np.int64)
    # J >= t, in whole numbers where t has few digits
    return able & (shared * 1000 >= round(threshold * 1000) * (total - shared))


def link_rows(rows: pd.DataFrame, first: int, second: int, threshold: float, least: list[int]) -> pd.DataFrame:
    """Links between the rows of block ``first`` and those of block ``second`` of one component: digest, links (rows at the other ends), root."""
    rows = rows.drop_duplicates("digest").reset_index(drop=True)
    sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
    sig = np.stack([np.frombuffer(s, np.uint32) for s in rows["signature"]])
    copies, block = rows["copies"].to_numpy(np.int64), rows["block"].to_numpy()
    x, y = np.flatnonzero(block == first), np.flatnonzero(block == second)
    links = np.zeros(len(rows), np.int64)
    root = np.arange(len(rows))
    if len(x) and len(y):
        i, j = _surviving(sig[x], sig[y], first == second, least)
        if len(i):
            ok = _exact([sets[k] for k in x], [sets[k] for k in y], i, j, threshold)
            i, j = x[i[ok]], y[j[ok]]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            while True:
                low = np.minimum(root[i], root[j])
                old = root.copy()
                np.minimum.at(root, i, low)
                np.minimum.at(root, j, low)
                root = root[root]
                if (root == old).all():
                    break
    linked = links > 0
    digest = rows["digest"].to_numpy()
    return pd.DataFrame({"digest": digest[linked], "links": links[linked], "root": digest[root[linked]]})


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(rows, classes). rows: doc_id, row, digest of each row; classes: digest, class (null, doc_id, row), links, copies of each distinct text.

    Two texts are linked if the Jaccard similarity of their sets of ``WORDS``-word shingles (letters and digits,
    case folded) reaches ``threshold``; a text of fewer words is one shingle. Texts without words
    equal only themselves; a null text has no class. The class is named by the row of the least doc_id of all texts that links connect
    (null ids come last, rows with one id go by ``row``, the hash of the text).
    """
    python_ready(docs)
    least = min_matches(threshold)
    signed = materialise(signatures(docs), "jaccard-signatures")
    reps = signed.where("digest is not null").groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")).alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    reps = materialise(reps, "jaccard-representatives")
    comps = connected_components(bucket_stars(reps)).withColumnRenamed("node", "digest")
    members = materialise(comps.join(reps.select("digest", "rep", "copies", "n_shingles"), "digest"), "jaccard-members")
    blocks, pairs = cut_large(members, reps)
    n_rows, weight = members.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    packs = max(1, n_rows // PACK_ROWS, weight // BLOCK_SHINGLES)
    # blocks are odd; the texts of small components get even numbers, each its own, so that no key of the join below is hot
    block = F.coalesce("block", F.xxhash64("digest").bitwiseAND(F.lit(-2)))
    placed = members.join(blocks, "digest", "left").select("rep", F.struct("digest", "comp", "copies", block.alias("block")).alias("m"))
    texts = docs.select("doc_id", "text", row_hash("text").alias("row")).where("text is not null")
    wanted = texts.join(placed, (F.col("row") == F.col("rep.row")) & F.col("doc_id").eqNullSafe(F.col("rep.doc_id"))).select("text", "m.*")

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, digests = batch["text"].tolist(), batch["digest"].tolist()
            for ids, offsets, words in word_batches(texts):
                so, sh = shingle_batch(offsets, words, WORDS)
                sig = minhash(so, sh, HASHES)
                # another text of the same id may have the same row hash
                own = [k for k, i in enumerate(ids) if _digest(words[offsets[k] : offsets[k + 1]], texts[i]) == bytes(digests[i])]
                at = [ids[k] for k in own]
                yield pd.DataFrame(
                    {
                        "digest": [digests[i] for i in at],
                        "comp": batch["comp"].iloc[at].array,
                        "copies": batch["copies"].iloc[at].array,
                        "block": batch["block"].iloc[at].array,
                        "signature": [sig[k].tobytes() for k in own],
                        "shingles": [np.unique(sh[so[k] : so[k + 1]]).tobytes() for k in own],
                    }
                )

    full = wanted.mapInPandas(shingles, "digest binary, comp binary, copies long, block long, signature binary, shingles binary")
    small = F.col("first").isNull()
    unit = F.when(small, F.pmod(F.xxhash64("comp"), F.lit(packs))).otherwise(F.xxhash64("first", "second"))
    place = [F.when(small, F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in ("block", "first", "second")]
    units = full.join(pairs, "block", "left").select("digest", "comp", "copies", "signature", "shingles", *place, unit.alias("unit"))

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [link_rows(part, int(first), int(second), threshold, least) for (_, first, second), part in rows.groupby(["comp", "first", "second"], sort=False)]
        return pd.concat(parts, ignore_index=True)

    links = units.groupBy("unit").applyInPandas(verify, "digest binary, links long, root binary")
    links = materialise(links, "jaccard-links")
    joined = connected_components(links.select(F.col("digest").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "digest")
    counts = links.groupBy("digest").agg(F.sum("links").alias("links"))
    texts = reps.select("digest", "rep", "copies").join(joined, "digest", "left").join(counts, "digest", "left")
    texts = texts.select("digest", "rep", "copies", F.coalesce("comp", "digest").alias("comp"), F.coalesce("links", F.lit(0)).alias("links"))
    ids = texts.groupBy("comp").agg(F.min("rep").alias("class"))
    return signed.select("doc_id", "row", "digest"), materialise(texts.join(ids, "comp").select("digest", "class", "links", "copies"), "jaccard-classes")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links, n_copies for each row of ``docs`` (doc_id, text).

    n_links counts the other rows whose texts reach the threshold, equal texts included; n_copies the other rows with the same words.
    A row with a null text is alone; a null doc_id is a row like others. An empty table gives an empty table.
    """
    rows, classes = near_classes(docs, threshold)
    return rows.join(classes, "digest", "left").select(
        "doc_id",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class.doc_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("copies") - 1, F.lit(0)).cast("long").alias("n_copies"),
    )


@shielded
def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, that of the least doc_id; columns as they were. Rows with null texts all stay.

    Of rows that agree in id and text one stays, whichever comes first.
    """
    rows, classes = near_classes(docs, threshold)
    texts = rows.where("digest is not null")
    gone = texts.join(classes, "digest").where(~(F.col("row").eqNullSafe(F.col("class.row")) & F.col("doc_id").eqNullSafe(F.col("class.doc_id"))))
    gone = gone.select(F.col("doc_id").alias("_m_gone"), F.col("row").alias("_m_row")).distinct()
    kept = docs.join(gone, (row_hash(docs["text"]) == F.col("_m_row")) & docs["doc_id"].eqNullSafe(F.col("_m_gone")), "left_anti")
    if not texts.groupBy("doc_id", "row").count().where("count > 1").limit(1).count():
        return kept
    marked = kept.withColumn("_m_row", row_hash("text"))
    some = marked.where("text is not null").dropDuplicates(["doc_id", "_m_row"])
    return some.unionByName(marked.where("text is null")).drop("_m_row")


def op6_bayes_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
