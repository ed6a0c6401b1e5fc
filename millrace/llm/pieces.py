"""Exact SentencePiece BPE encoding by a table of prefixes, and decoding.

The merges of a text end in tokens of which each, merged alone, gives itself, and of which each neighbouring pair, merged together, gives the same
two. So every prefix of a text has one last token: the one that an automaton of all pieces finds to end there and that is compatible with the last token of what
stands before it. The table keeps that token's length for every prefix, in time linear in the text, and the ids are then recovered backwards.

Where no piece holds a space mark after another character, no merge crosses from a word to the next mark, so a text is encoded word by word, and frequent words are
remembered. Normalising and decoding are the library's.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from .common import python_ready, table

SPACE = "▁"
#: The largest model file that is sent to the executors; words and pairs that a worker remembers, and the longest such word.
MODEL_BYTES, HELD_WORDS, HELD_PAIRS, HELD_LENGTH = 64 << 20, 1 << 18, 1 << 19, 48
#: From so many characters on, a word's table is held in four bytes a prefix.
LONG_WORD = 4096
#: Characters of a text that are cut into words at a time.
STRETCH = 1 << 16


class PieceEncoder:
    """Encodes as ``sentencepiece`` does with the BPE model whose file holds ``model``."""

    def __init__(self, model: bytes):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(lib.get_piece_size())
        if any(lib.is_unused(i) for i in ids):
            raise ValueError("models with unused pieces aren't supported")
        self.special = {lib.id_to_piece(i) for i in ids if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if any(lib.is_byte(i) for i in ids) else None
        self.ids = {p: i for i in ids if (p := lib.id_to_piece(i)) not in self.special}
        self.scores = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.whole = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.pieces = [lib.id_to_piece(i) for i in ids]
        self.lengths = [len(p) for p in self.pieces]
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.held: dict[str, array] = {}
        self.older: dict[str, array] = {}
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if self.merged(p) == [p]:  # others never come out of merges
                self.automaton.add_word(p, i)
        self.automaton.make_automaton()

    def merged(self, text: str, edge: int = 0) -> list[str] | None:
        """The definition, for short texts: characters, of which the neighbours that make the best piece are merged, the leftmost first.

        None as soon as a merge crosses ``edge``, a count of characters from the left.
        """
        parts, score, none = list(text), self.scores.get, -np.inf
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > none:
            i = pairs.index(best)
            if i < edge:  # the edge is counted in parts from here on
                edge -= 1
                if i == edge:
                    return None
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether two pieces stay as they are when their characters are merged together."""
        key, pairs = a * len(self.pieces) + b, self.pairs
        known = pairs.get(key)
        if known is None:
            left, right = self.pieces[a], self.pieces[b]
            if len(pairs) >= HELD_PAIRS:
                pairs.clear()
            known = pairs[key] = self.merged(left + right, len(left)) == [left, right]
        return known

    def last_tokens(self, text: str) -> list[int] | array:
        """The id of the last token of every prefix; -1 where it is a character that is no piece."""
        last = [-1] * (len(text) + 1) if len(text) < LONG_WORD else array("i", [-1]) * (len(text) + 1)
        lengths, pairs, n = self.lengths, self.pairs, len(self.pieces)
        for end, token in self.automaton.iter(text):
            i = end + 1
            if last[i] >= 0:
                continue
            j = i - lengths[token]
            if j:
                before = last[j]
                if before < 0:
                    ok = self.merged(text[j - 1 : i], 1) == [text[j - 1], text[j:i]]
                else:
                    ok = pairs.get(before * n + token)
                    if ok is None:
                        ok = self.compatible(before, token)
                if not ok:
                    continue
            last[i] = token
        return last

    def word_ids(self, text: str) -> list[int]:
        """Ids of a stretch that no merge leaves."""
        last, i, out, lengths = self.last_tokens(text), len(text), [], self.lengths
        while i:
            token = last[i]
            if token >= 0:
                out.append(token)
                i -= lengths[token]
            else:
                i -= 1
                out.extend([self.library.unk_id()] if self.byte_ids is None else [self.byte_ids[b] for b in reversed(text[i].encode())])
        out.reverse()
        return out

    def stretches(self, text: str) -> Iterator[slice]:
        """The text in stretches of about ``STRETCH`` characters that begin at words; whole, if words can't be told apart."""
        at, n = 0, len(text)
        while at < n:
            end = text.find(SPACE, at + STRETCH) if self.whole else n
            while 0 < end < n and text[end - 1] == SPACE:  # not within a run of spaces
                end = text.find(SPACE, end + 1)
            yield slice(at, at := end if end > 0 else n)

    def encode(self, text: str, bos: bool = True, eos: bool = True) -> array:
        """The ids, without sampling; one id for neighbouring unknown characters if the model has no pieces for bytes."""
        text, held = self.library.normalize(text), self.held
        out = array("I", [self.library.bos_id()] if bos else [])
        for at in self.stretches(text):
            for word in self.words(text[at]) if self.whole else [text[at]]:
                found = held.get(word)
                if found is None:
                    found = self.older.get(word) or array("I", self.word_ids(word))
                    if len(word) <= HELD_LENGTH:
                        if len(held) >= HELD_WORDS:  # words in use come back from the older ones
                            self.older, self.held = held, (held := {})
                        held[word] = found
                out.extend(found)
        if self.byte_ids is None:
            unknown = self.library.unk_id()
            out = array("I", [x for i, x in enumerate(out) if x != unknown or not i or out[i - 1] != unknown])
        if eos:
            out.append(self.library.eos_id())
        return out

    def decode(self, ids) -> str:
        return self.library.decode(list(ids))


@functools.lru_cache(2)
def encoder(model: bytes) -> PieceEncoder:
    """One for each worker and model."""
    return PieceEncoder(model)


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver. It must be one whose own pieces the encoder and the library encode alike."""
    with open(path, "rb") as f:
        model = f.read(MODEL_BYTES + 1)
    if len(model) > MODEL_BYTES:
        raise ValueError(f"{path} has over {MODEL_BYTES} bytes")
    own = encoder(model)
    pieces = [p.replace(SPACE, " ") for p in own.ids]
    if any(own.encode(p, False, False).tolist() != ids for p, ids in zip(pieces, own.library.encode(pieces), strict=True)):
        raise ValueError(f"{path} doesn't hold a BPE model of this kind")
    return model


def _over_texts(docs: DataFrame, model: str, kind: str, columns: list[str], row) -> DataFrame:
    """doc_id and ``columns`` (of ``kind``), which ``row(encoder, text)`` gives for every row; a null text is an empty one."""
    spark = python_ready(docs)
    held = spark.sparkContext.broadcast(model_bytes(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(held.value)
        for batch in batches:
            rows = [row(own, text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], ["doc_id", *columns])

    types = {"ids": [pa.list_(pa.int32())], "digest": [pa.int64(), pa.string(), pa.string()]}[kind]
    sql = {"ids": "array<int>", "digest": "long, string, string"}[kind].split(", ")
    schema = ", ".join(["doc_id " + docs.schema["doc_id"].dataType.simpleString(), *(f"{c} {t}" for c, t in zip(columns, sql, strict=True))])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ``ids`` (array of int, begin and end included) of every row of ``docs`` (doc_id, text).

    ``model`` is the path of a SentencePiece BPE model on the driver. Null and empty texts have the begin and end ids alone; texts of any length are encoded whole;
    repeated rows and null ids come back row by row; other columns are not read; an empty table gives an empty table.
    """
    return _over_texts(docs, model, "ids", ["ids"], lambda own, text: (np.frombuffer(own.encode(text), np.uint32).astype(np.int32),))


def decoded(tokens: DataFrame, model: str) -> DataFrame:
    """``tokens`` with ``text``, decoded from its column ``ids``; a null list decodes to null."""
    spark = python_ready(tokens)
    held = spark.sparkContext.broadcast(model_bytes(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            texts = [None if x is None else encoder(held.value).decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    tokens = tokens.drop("text")
    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, StructField("text", StringType())]))


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit integers) and decoded_sha256 (of the decoded text's UTF-8), rows as in ``encoded``."""

    def row(own: PieceEncoder, text: str) -> tuple[int, str, str]:
        ids = np.frombuffer(own.encode(text), np.uint32).astype("<u4")
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(own.decode(ids.tolist()).encode()).hexdigest()

    return _over_texts(docs, model, "digest", ["n_tokens", "ids_sha256", "decoded_sha256"], row)


def op12_prefix_pieces(spark, sf_dir: str, model: str | None = None) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), model or public_tokenizers.path("piece_bpe_32k.model"))
