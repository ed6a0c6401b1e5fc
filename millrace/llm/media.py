"""Texts as PNG images in binary columns: lossless storage, checked reading, perceptual hashes.

A payload becomes an 8-bit grey image ``WIDTH`` samples wide. Rows are filtered (none, sub or
up, whichever gives the smallest differences), deflated and written as IDAT chunks with
their checksums. Reading tests the signature, every chunk's checksum and the sizes,
inflates, and undoes all five filters of the PNG specification with numpy. The feature is a
64-bit hash of the lowest frequencies of a cosine transform of the image, shrunk to 32 x 32.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import python_ready, real_ids, table, whole_ids

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH, LEVEL, CHUNK = 64, 3, 1 << 20
SIDE, LOW = 32, 8


def pad(data: bytes) -> bytes:
    """``data`` with bytes 0 up to a positive multiple of ``WIDTH``."""
    return data + bytes(-len(data) % WIDTH if data else WIDTH)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes) -> bytes:
    """A grey 8-bit PNG of ``payload``, whose length is a positive multiple of ``WIDTH``."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    left = np.zeros_like(image)
    left[:, 1:] = image[:, :-1]
    above = np.zeros_like(image)
    above[1:] = image[:-1]
    forms = [image, image - left, image - above]
    kind = int(np.argmin([np.minimum(f, 0 - f).sum(dtype=np.int64) for f in forms]))
    rows = np.empty((len(image), WIDTH + 1), np.uint8)
    rows[:, 0], rows[:, 1:] = kind, forms[kind]
    packed = zlib.compress(rows.tobytes(), LEVEL)
    parts = [SIGNATURE, _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(image), 8, 0, 0, 0, 0))]
    parts += [_chunk(b"IDAT", packed[i : i + CHUNK]) for i in range(0, len(packed), CHUNK)]
    return b"".join([*parts, _chunk(b"IEND", b"")])


def _undo_diagonals(part: np.ndarray, above: np.ndarray, kind: int) -> np.ndarray:
    """Undoes the filters average (3) and Paeth (4): a sample needs those to the left and above, so all samples of a diagonal go at once."""
    height, width = part.shape
    held = np.zeros((height + 1, width + 1), np.int32)
    held[0, 1:] = above
    for t in range(height + width - 1):
        y = np.arange(max(0, t - width + 1), min(height, t + 1))
        x = t - y
        a, b, c = held[y + 1, x], held[y, x + 1], held[y, x]
        if kind == 3:
            guess = (a + b) // 2
        else:
            pa, pb, pc = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
            guess = np.where((pa <= pb) & (pa <= pc), a, np.where(pb <= pc, b, c))
        held[y + 1, x + 1] = (part[y, x] + guess) & 255
    return held[1:, 1:].astype(np.uint8)


def _unfilter(rows: np.ndarray) -> np.ndarray:
    kinds, data = rows[:, 0], rows[:, 1:]
    out = np.empty_like(data)
    above = np.zeros(data.shape[1], np.uint8)
    edges = np.flatnonzero(np.diff(kinds)) + 1
    for lo, hi in zip([0, *edges], [*edges, len(kinds)], strict=True):
        kind, part = kinds[lo], data[lo:hi]
        if kind == 0:
            out[lo:hi] = part
        elif kind == 1:
            np.cumsum(part, axis=1, dtype=np.uint8, out=out[lo:hi])
        elif kind == 2:
            np.cumsum(part, axis=0, dtype=np.uint8, out=out[lo:hi])
            out[lo:hi] += above
        elif kind in (3, 4):
            out[lo:hi] = _undo_diagonals(part, above, kind)
        else:
            raise ValueError(f"unknown row filter {kind}")
        above = out[hi - 1]
    return out


def decode_png(data: bytes) -> np.ndarray:
    """The samples of a grey 8-bit PNG without interlacing; raises ValueError on any damage."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, header, packed, ended = 8, None, [], False
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("cut short")
        (n,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(body) < n or struct.pack(">I", zlib.crc32(kind + body)) != data[at + 8 + n : at + 12 + n]:
            raise ValueError(f"checksum of {kind!r} is wrong")
        at += 12 + n
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        elif kind == b"IEND":
            ended = True
            break
    if header is None or not ended or header[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not a whole grey 8-bit PNG")
    width, height = header[:2]
    raw = zlib.decompress(b"".join(packed))
    if len(raw) != height * (width + 1):
        raise ValueError("wrong count of samples")
    return _unfilter(np.frombuffer(raw, np.uint8).reshape(height, width + 1))


@functools.cache
def _cosines() -> np.ndarray:
    k, n = np.arange(LOW)[:, None], np.arange(SIDE)[None, :]
    return np.cos(np.pi * (2 * n + 1) * k / (2 * SIDE))


def _shrink(image: np.ndarray, axis: int) -> np.ndarray:
    """Means over ``SIDE`` bands along the axis; fewer samples are repeated."""
    n = image.shape[axis]
    if n < SIDE:
        return np.take(image, np.arange(SIDE) * n // SIDE, axis=axis)
    edge = np.arange(SIDE) * n // SIDE
    sums = np.add.reduceat(image, edge, axis=axis)
    width = np.diff([*edge, n])
    return sums / (width[:, None] if axis == 0 else width)


def cosine_hash(image: np.ndarray) -> bytes:
    """8 bytes: one bit for each of the 8 x 8 lowest frequencies that is above their median (the mean left out)."""
    small = _shrink(_shrink(image.astype(np.float64), 0), 1)
    c = _cosines()
    low = (c @ small @ c.T).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes()


def to_media(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, media (PNG) and cosine_hash (binary) of each row; a null text counts as empty."""
    python_ready(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.iloc[lo : lo + 256]
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in part[text]]
                padded = [pad(r) for r in raw]
                yield part[["doc_id", "no_id"]].assign(
                    n_bytes=[len(r) for r in raw], media=[encode_png(p) for p in padded], cosine_hash=[cosine_hash(np.frombuffer(p, np.uint8).reshape(-1, WIDTH)) for p in padded]
                )

    return real_ids(whole_ids(docs.select("doc_id", text)).mapInPandas(run, "doc_id long, no_id boolean, n_bytes long, media binary, cosine_hash binary"))


def read_media(media: DataFrame) -> DataFrame:
    """Digests of what the stored images hold, from doc_id, n_bytes and media."""
    python_ready(media)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, no_id, n, png in zip(batch["doc_id"], batch["no_id"], batch["n_bytes"], batch["media"], strict=True):
                image = decode_png(png)
                payload = image.tobytes()
                out.append((doc_id, no_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(png), hashlib.sha256(png).hexdigest(), cosine_hash(image).hex()))
            yield pd.DataFrame(out, columns=["doc_id", "no_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return real_ids(whole_ids(media).mapInPandas(run, "doc_id long, no_id boolean, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"))


def op5_png_media(spark, sf_dir: str) -> DataFrame:
    """Null and empty texts make one row of 64 bytes 0; equal texts give equal values; an empty table gives an empty table."""
    return read_media(to_media(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "media"))
