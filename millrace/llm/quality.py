"""Text quality: random Fourier features over document statistics, ridge regression, isotonic calibration.

Statistics of each text are standardised, mapped to cosines that approximate a Gaussian
kernel, and fitted to the labels by ridge regression. Its normal equations are summed by
partition and again by group of partitions, so the driver holds ``SUM_GROUPS`` matrices of a fixed size. Scores of labelled rows are then summed up
in ``BINS`` bins and calibrated by pooling adjacent violators. All labelled rows take part in every sum.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, materialise, python_ready, real_ids, table, whole_ids
from .textkernel import PIECE, codes, fold_table, letter_table, word_batches

FEATURES, GAMMA, RIDGE, BINS, SUM_GROUPS = 192, 0.06, 1e-3, 512, 16
STATS = 20


def text_statistics(text: str | None) -> np.ndarray:
    """``STATS`` numbers that describe one whole text; zeros for null and empty ones."""
    out = np.zeros(STATS)
    text = text or ""
    if not text:
        return out
    n = letters = upper = digits = space = symbols = dots = doubled = 0
    letter, fold = letter_table(), fold_table()
    common = np.zeros(128, np.int64)
    for at in range(0, len(text), PIECE):
        c = codes(text[at : at + PIECE])
        n += len(c)
        is_letter = letter[c]
        letters += int(is_letter.sum())
        upper += int((is_letter & (fold[c] != c)).sum())
        doubled += int((c[1:] == c[:-1]).sum())
        common += np.bincount(c[c < 128], minlength=128)
    digits, space = int(common[48:58].sum()), int(common[32] + common[9:14].sum())
    dots = int(common[[33, 44, 46, 58, 59, 63]].sum())
    symbols = int(common[33:48].sum() + common[58:65].sum() + common[91:97].sum() + common[123:127].sum()) - dots
    words = np.concatenate([h for _, _, h in word_batches([text])])
    w = len(words)
    _, counts = np.unique(words, return_counts=True)
    lines = text.split("\n")
    distinct_lines = len({zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in lines})
    tokens = max(1, text.count(" ") + len(lines))
    repeat = float((words[1:] == words[:-1]).mean()) if w > 1 else 0.0
    pairs = words[1:] * np.uint64(3) + words[:-1]
    out[:] = [
        np.log1p(n), np.log1p(w), letters / n, upper / max(1, letters), digits / n, space / n, symbols / n, dots / n, doubled / n,
        letters / max(1, w) / 10, len(counts) / max(1, w), float(counts.max()) / w if w else 0.0, repeat,
        len(np.unique(pairs)) / max(1, len(pairs)), distinct_lines / len(lines), n / len(lines) / 200 if len(lines) else 0.0,
        (common[33] + common[63]) / tokens, common[124] / tokens, common[[35, 36, 37, 38, 42]].sum() / tokens, float(counts[counts > 1].sum()) / w if w else 0.0,
    ]
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``stats`` (binary, ``STATS`` doubles) of each row."""

    python_ready(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id", "no_id"]].assign(stats=[text_statistics(t).tobytes() for t in batch["text"]])

    return real_ids(whole_ids(docs.select("doc_id", "text")).mapInPandas(run, "doc_id long, no_id boolean, stats binary"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, STATS)


class Model:
    def __init__(self, mean, scale, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.direction = rng.normal(0.0, np.sqrt(2 * GAMMA), (STATS, FEATURES))
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weight = np.zeros(FEATURES + 1)
        self.edge, self.value = np.array([0.0]), np.array([0.5])

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ self.direction + self.phase), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weight

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.edge, self.value)


def pool_adjacent(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence that is closest to ``value`` by weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            t = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / t, t, a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def _reduced(rows: DataFrame, part, width: int, add=np.add) -> np.ndarray:
    """``part(stats matrix, labels)``, a vector of ``width`` doubles, of all rows, put together by ``add``; zeros without rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, at = None, TaskContext.get().partitionId()
        for batch in batches:
            if len(batch):
                one = part(_matrix(batch["stats"]), batch["label"].to_numpy(float))
                total = one if total is None else add(total, one)
        yield pd.DataFrame({"g": [at % SUM_GROUPS], "total": [total.tobytes()]} if total is not None else {"g": [], "total": []})

    def put(found: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"g": found["g"].iloc[:1], "total": [add.reduce([np.frombuffer(t) for t in found["total"]]).tobytes()]})

    kind = "g int, total binary"
    parts = rows.select("stats", "label").mapInPandas(run, kind).groupBy("g").applyInPandas(put, kind).collect()
    return add.reduce([np.frombuffer(r["total"]) for r in parts]) if parts else np.zeros(width)


def fit(rows: DataFrame) -> Model:
    """From ``stats`` and ``label`` (0 or 1). Without rows, every score is 0.5."""

    def moments(x, y):
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    m = _reduced(rows, moments, 1 + 2 * STATS)
    n = max(1.0, m[0])
    mean = m[1 : 1 + STATS] / n
    scale = np.sqrt(np.maximum(m[1 + STATS :] / n - mean**2, 1e-8))
    model = Model(mean, scale)
    if not m[0]:
        return model
    d = FEATURES + 1

    def equations(x, y):
        f = model.features(x)
        return np.concatenate([(f.T @ f).ravel(), f.T @ y])

    s = _reduced(rows, equations, d * d + d)
    a = s[: d * d].reshape(d, d)
    model.weight = np.linalg.solve(a + RIDGE * n * np.eye(d) / 10, s[d * d :])

    def extent(x, y):
        raw = model.raw(x)
        return np.array([raw.min(), -raw.max()])

    lo, hi = _reduced(rows, extent, 2, np.minimum) * [1, -1]
    hi = max(hi, lo + 1e-9)

    def bins(x, y):
        at = np.clip(((model.raw(x) - lo) / (hi - lo) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])

    b = _reduced(rows, bins, 2 * BINS)
    full = np.flatnonzero(b[:BINS])
    model.edge = lo + (full + 0.5) * (hi - lo) / BINS
    model.value = np.clip(pool_adjacent(b[BINS:][full] / b[:BINS][full], b[:BINS][full]), 0, 1)
    return model


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text).

    Null texts score like empty ones. Null qualities and held-out rows teach nothing. Repeated ids
    are scored row by row. An empty table gives an empty table; without labels all scores are 0.5.
    """
    stats = materialise(with_statistics(docs), "quality-stats")
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("double").alias("label"))
    model = fit(materialise(stats.where(~held_out("doc_id")).join(known, "doc_id").select("stats", "label"), "quality-labelled"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch[["doc_id", "no_id"]].assign(score=shared.value.score(_matrix(batch["stats"])))

    scored = real_ids(whole_ids(stats).mapInPandas(run, "doc_id long, no_id boolean, score double"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).cast("int").alias("predicted"))


def op8_kernel_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
