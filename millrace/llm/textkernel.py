"""Vectorised text primitives: folded code points, word hashes, shingles, MinHash.

All functions work on whole texts. Long texts are cut at non-word characters into
pieces of about ``PIECE`` characters so that memory stays bounded; the pieces' word
arrays are joined again, so results don't depend on the cut.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np

PIECE = 1 << 18
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15


@functools.cache
def fold_table() -> np.ndarray:
    """Code point -> lower-cased code point for letters and digits, 0 for all else."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x20000):
        s = chr(c)
        if s.isalnum():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    out[0x20000:0x323B0] = np.arange(0x20000, 0x323B0, dtype=np.uint32)
    return out


@functools.cache
def letter_table() -> np.ndarray:
    """True for code points that are letters."""
    out = np.zeros(0x110000, bool)
    for c in range(0x20000):
        out[c] = chr(c).isalpha()
    out[0x20000:0x323B0] = True
    return out


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on uint64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power_row(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@functools.cache
def _held_powers() -> tuple[np.ndarray, np.ndarray]:
    return _power_row(2 * PIECE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse at least; one pair of arrays is kept, longer ones are made for the call."""
    return _held_powers() if n <= 2 * PIECE else _power_row(n)


def _word_hashes(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word (run of letters and digits, case folded)."""
    f = fold_table()[codes(text)]
    n = len(f)
    word = np.empty(n + 2, bool)
    word[0] = word[-1] = False
    word[1:-1] = f > 0
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    power, inverse = powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(f.astype(np.uint64) * power[:n], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64)), start, end


def _pieces(text: str, size: int = PIECE) -> Iterator[str]:
    at, n = 0, len(text)
    while n - at > size:
        cut = at + size
        while cut > at + size // 2 and text[cut - 1].isalnum():
            cut -= 1
        if cut == at + size // 2:
            # a word of over half a piece: go forward to its end
            cut = at + size
            while cut < n and text[cut].isalnum():
                cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def word_batches(texts: Iterable[str | None], size: int = PIECE) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Whole documents in batches of about ``size`` characters.

    Yields (indices of the documents, offsets into the words, word hashes). A null text has no words.
    """
    ids: list[int] = []
    held: list[str] = []
    chars = 0

    def flush():
        joined = "\n".join(held)
        hashes, start, _ = _word_hashes(joined)
        bounds = np.cumsum([0] + [len(t) + 1 for t in held])
        return ids, np.searchsorted(start, bounds).astype(np.int64), hashes

    for i, text in enumerate(texts):
        text = text or ""
        if len(text) > size:
            if ids:
                yield flush()
                ids, held, chars = [], [], 0
            parts = [_word_hashes(p)[0] for p in _pieces(text, size)]
            whole = np.concatenate(parts)
            yield [i], np.array([0, len(whole)], np.int64), whole
            continue
        if chars + len(text) > size and ids:
            yield flush()
            ids, held, chars = [], [], 0
        ids.append(i)
        held.append(text)
        chars += len(text) + 1
    if ids:
        yield flush()


def span_batches(texts: Iterable[str | None], size: int = PIECE) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Whole documents in batches of about ``size`` characters, with the places of their words.

    Yields (indices of the documents, first character of each in the batch, word hashes, starts, ends).
    """
    ids: list[int] = []
    held: list[str] = []
    chars = 0

    def flush():
        bounds = np.cumsum([0] + [len(t) + 1 for t in held])[:-1]
        return ids, bounds, *_word_hashes("\n".join(held))

    for i, text in enumerate(texts):
        text = text or ""
        if ids and chars + len(text) > size:
            yield flush()
            ids, held, chars = [], [], 0
        if len(text) > size:
            yield [i], np.zeros(1, np.int64), *word_spans(text)
            continue
        ids.append(i)
        held.append(text)
        chars += len(text) + 1
    if ids:
        yield flush()


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with their character spans in one text."""
    at, out = 0, []
    for piece in _pieces(text):
        h, s, e = _word_hashes(piece)
        out.append((h, s + at, e + at))
        at += len(piece)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


_RNG = np.random.default_rng(7919)
_SLOT = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words; fewer words make one run; none make none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    out = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        out += words[j : n - k + 1 + j] * _SLOT[j]
    return mix(out + np.uint64(k))


def shingle_batch(offsets: np.ndarray, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many documents at once: (offsets, hashes)."""
    sizes = np.diff(offsets)
    counts = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    out_off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    n = len(words)
    if n == 0:
        return out_off, np.zeros(0, np.uint64)
    if n >= k:
        runs = run_hashes(words, k)
    else:
        runs = np.zeros(0, np.uint64)
    long_doc = np.flatnonzero(sizes >= k)
    out = np.empty(out_off[-1], np.uint64)
    if len(long_doc):
        keep = np.zeros(len(runs) + 1, np.int32)
        np.add.at(keep, offsets[long_doc], 1)
        np.add.at(keep, offsets[long_doc] + counts[long_doc], -1)
        mask = np.cumsum(keep[:-1]) > 0
        target = np.ones(out_off[-1], bool)
        short = np.flatnonzero((sizes > 0) & (sizes < k))
        target[out_off[short]] = False
        out[target] = runs[mask]
    for d in np.flatnonzero((sizes > 0) & (sizes < k)):
        out[out_off[d]] = run_hashes(words[offsets[d] : offsets[d + 1]], k)[0]
    return out_off, out


@functools.cache
def _minhash_keys(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(104729)
    return rng.integers(0, 1 << 32, k, dtype=np.uint32), rng.integers(0, 1 << 31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minhash(offsets: np.ndarray, shingles: np.ndarray, k: int) -> np.ndarray:
    """(documents, k) uint32 signatures; documents without shingles get all ones."""
    n = len(offsets) - 1
    out = np.full((n, k), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if not len(full):
        return out
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    at = offsets[full]
    flip, times = _minhash_keys(k)
    v = np.empty_like(x)
    for i in range(k):
        np.bitwise_xor(x, flip[i], out=v)
        np.multiply(v, times[i], out=v)
        out[full, i] = np.minimum.reduceat(v, at)
    return out
