"""Importance resampling, piece encoding and the divergence audit, each against a plain version over all rows, and odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from compare import same

from millrace.llm import divergence, importance, mixing, pieces
from millrace.llm.queries import QUERIES


@pytest.fixture(scope="module")
def documents(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet")


LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

# --- 11


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_buckets(words, n=3, buckets=10_000):
    return [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain_resampling(rows, targets):
    """(doc_id, features, weight, score, rank) as the definition has them."""
    words = [plain_words(t) for _, t in rows]
    found = [plain_buckets(w) for w in words]
    s, t = Counter(b for f in found for b in f), Counter(b for x in targets for b in plain_buckets(plain_words(x)))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[i] + 1) * (s_all + 10_000) / ((s[i] + 1) * (t_all + 10_000)))) for i in range(10_000)]
    out = []
    for (i, _), f in zip(rows, found):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    long = sorted((x for x, w in zip(out, words) if len(w) >= 20), key=lambda x: (-x[3], math.inf if x[0] is None else x[0]))
    for place, x in enumerate(long[: 5 * len(long) // 100]):
        x[4] = place + 1
    return Counter(map(tuple, out))


def resampled(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_op11_matches_definition(spark, sf_dir, documents):
    bench = pd.read_parquet(f"{sf_dir}/benchmark.parquet").text
    got = resampled(QUERIES["op11_importance_ring"](spark, sf_dir))
    assert got == plain_resampling(list(zip(documents.doc_id.tolist(), documents.text)), bench)
    assert sum(r[4] is not None for r in got) > 40


@pytest.mark.parametrize("piece", [8, 61, 1 << 18])
def test_ring_over_pieces(piece, monkeypatch):
    """Features cross the pieces of a text, whatever their size, and words longer than a piece stay whole."""
    monkeypatch.setattr(importance, "PIECE", piece)
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice(["a", "B", "é", "7", " ", "  ", "-", "\x00", "日本", "x" * 90, "\n"]) for _ in range(rng.randrange(120)))
        for n in (1, 2, 4):
            got = Counter(b for _, found in importance.text_buckets(text.encode(), n) for b in found.tolist())
            assert got == Counter(plain_buckets(plain_words(text), n))
            assert sum(w for w, _ in importance.text_buckets(text.encode(), n)) == len(plain_words(text))
    assert [*importance.text_buckets(None)] == []


def test_resampling_of_odd_rows(spark):
    """Nulls, empty and very long texts, ties and repeated rows, equal rows over many ranges, clashing names, empty tables."""
    kind = "doc_id long, text string, rank string, _m_at int"
    rows = [(i % 70, f"word{i % 7} " * 25, "r", i) for i in range(400)] + [(None, "same words " * 15, "r", 1)] * 300
    rows += [(None, None, "r", 1), (1000, "", "r", 2), (1001, "...", "r", 3), (1002, "long text of words " * 60_000, "r", 4)]
    docs, bench = spark.createDataFrame(rows, kind).repartition(5), spark.createDataFrame([("word3 word3",), (None,)], "text string")
    got = resampled(importance.ranked(importance.scored(docs, bench)))
    want = plain_resampling([r[:2] for r in rows], ["word3 word3"])
    drop = lambda c: Counter((a, b, w, s) for (a, b, w, s, _), n in c.items() for _ in range(n))
    assert drop(got) == drop(want) and sorted(r[4] for r in got.elements() if r[4]) == list(range(1, 36))
    # ties within one id and score may fall to any of the equal rows; the scores by rank are fixed
    by_rank = lambda c: sorted((r[4], r[3], r[0] is None, r[0]) for r in c.elements() if r[4])
    assert by_rank(got) == by_rank(want)
    kept = importance.resample(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in got.elements() if r[4]}
    none = docs.limit(0)
    assert importance.ranked(importance.scored(none, bench)).count() == 0 and importance.resample(none, bench).count() == 0
    assert importance.ranked(importance.scored(docs, bench.limit(0))).count() == len(rows)


# --- 12


@pytest.fixture(scope="module")
def model_path():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own(model_path):
    return pieces.PieceEncoder(pieces.model_bytes(model_path))


def test_op12_matches_library(spark, sf_dir, documents, own):
    def digest(text):
        ids = own.library.encode(text or "", add_bos=True, add_eos=True)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(own.library.decode(ids).encode()).hexdigest()

    got = sorted(tuple(r) for r in QUERIES["op12_prefix_pieces"](spark, sf_dir).collect())
    assert got == sorted((i, *digest(t)) for i, t in zip(documents.doc_id.tolist(), documents.text))


def odd_texts(own, seed, n):
    rng = random.Random(seed)
    other = ["a", "the", " ", "   ", "\u2581", "日本語", "é", "e\u0301", "🙂", "<s>", "<0x41>", "\x00", "\n", "\t", "ß", "\ud7ff", "\ufffd", "x" * 70]
    known = list(own.ids)
    for _ in range(n):
        text = "".join(rng.choice(known) if rng.random() < 0.5 else rng.choice(other) for _ in range(rng.randrange(30)))
        yield text.replace(pieces.SPACE, "") if rng.random() < 0.5 else text


def test_prefix_table_on_odd_texts(own, monkeypatch):
    """Against the library, also when words and pairs are forgotten at once and long words use the compact table."""
    texts = [*odd_texts(own, 3, 3000), "", " ", "\u2581" * 40, "".join(p.strip(pieces.SPACE) for p in list(own.ids)[::9])]
    want = own.library.encode(texts, add_bos=True, add_eos=True)
    assert [own.encode(t).tolist() for t in texts] == want
    for name, value in {"HELD_WORDS": 3, "HELD_PAIRS": 5, "LONG_WORD": 4, "STRETCH": 7}.items():
        monkeypatch.setattr(pieces, name, value)
    assert [own.encode(t).tolist() for t in texts] == want
    monkeypatch.setattr(own, "whole", False)  # as for vocabularies whose pieces hold spaces
    assert [own.encode(t).tolist() for t in texts[:500]] == want[:500]


def test_prefix_table_is_that_of_the_merges(own):
    """The last token of every prefix, against merging that prefix by the definition."""
    for text in list(odd_texts(own, 8, 60)):
        text = text[:40]
        last = own.last_tokens(text)
        for i in range(1, len(text) + 1):
            token = own.merged(text[:i])[-1]
            assert (own.pieces[last[i]] if last[i] >= 0 else text[i - 1]) == token


def test_encoding_of_odd_rows(spark, model_path, own):
    rows = [(1, "some text", "x"), (1, "some text", "x"), (None, None, "y"), (2, "", None), (3, "long words " * 40_000, "z"), (9007199254740993, "日本", "w"), (None, " ", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    tokens = pieces.encoded(docs, model_path)
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in tokens.collect())
    assert got == Counter((i, tuple(own.library.encode(t or "", add_bos=True, add_eos=True))) for i, t, _ in rows)
    back = Counter((r["doc_id"], r["text"]) for r in pieces.decoded(tokens, model_path).collect())
    assert back == Counter((i, t or "") for i, t, _ in rows)
    assert pieces.digests(docs.limit(0), model_path).count() == 0 and pieces.encoded(docs.limit(0), model_path).count() == 0
    with pytest.raises(Exception):
        pieces.model_bytes(__file__)


# --- 13


def plain_terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_divergences(rows, least=30, top=50):
    """(lang, source, part, item, value, rank) in whole numbers of any size; rows are (text, lang, source)."""
    counts, holders, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source, terms = lang or "", source or "", plain_terms(text)
        groups[lang].add(source)
        counts[lang, source].update(terms)
        holders[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in holders[lang].items() if n >= least]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources - {s}]
            term = [(q[t] - p[s][t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out |= {(lang, s, part, item, -value, i + 1) for i, (value, item) in enumerate(found)}
    return out


def test_op13_matches_sql(spark, sf_dir, duck):
    assert same(QUERIES["op13_source_divergence"](spark, sf_dir), duck, divergence.OP13_SQL) > 1000


@pytest.mark.parametrize("entries, pairs", [(1 << 18, 1 << 20), (9, 7)])
def test_divergence_of_odd_rows(spark, monkeypatch, entries, pairs):
    """Nulls, sources and languages without terms or without kept ones, ties, repeated and very long rows, one source, clashing names; one block and many."""
    monkeypatch.setattr(divergence, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(divergence, "TASK_PAIRS", pairs)
    rng = random.Random(11)
    words = ["alpha", "Beta", "γ", "Δelta", "日本", "e", "E", "zz", "ÄÖ", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = [(" 1".join(rng.choices(words, k=rng.randrange(20))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "ü", None, ""])) for _ in range(500)]
    rows += [(None, "en", "empty"), ("", "en", "empty"), ("123 ...", "fr", "x"), ("few", "fr", "y"), ("few", "fr", "y"), ("alone " * 40, "it", "one")]
    rows += [("alone", "it", "one")] * 40 + [("Long text, with words; " * 50_000, "de", "b")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, source string, term int, count int")
    got = {tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.divergences(docs).collect()}
    assert got == plain_divergences(rows)
    assert {r for r in got if r[0] == "fr"} == {("fr", "x", "pair", "y", 0, 1), ("fr", "y", "pair", "x", 0, 1)}
    assert divergence.divergences(docs.limit(0)).count() == 0


def test_byte_terms(monkeypatch):
    """Slices against the pattern, texts that touch, and a hash that throws terms together."""
    rng = random.Random(12)
    texts = ["".join(rng.choice(["a", "B", "é", "日本", "7", " ", "-", "\x00", "Z", "{", "@", "`"]) for _ in range(rng.randrange(12))) for _ in range(300)]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    low, starts, ends, doc = divergence.term_slices(np.frombuffer(b"".join(raw), np.uint8), offsets)
    want = [(i, w) for i, t in enumerate(texts) for w in plain_terms(t)]
    assert [(d, low[s:e].tobytes().decode()) for s, e, d in zip(starts, ends, doc.tolist())] == want
    for size in (7, 1 << 16):
        monkeypatch.setattr(divergence, "COMPARE", size)
        for digest in (len, lambda v: 0, lambda v: v[0], hash):
            group, terms = divergence.slice_groups(low, starts, ends, lambda v: digest(bytes(v)) & 0xFFFFFFFF)
            assert [terms[g].decode() for g in group] == [w for _, w in want] and len({terms[g] for g in group}) == len(set(group.tolist()))


def test_shares_are_exact():
    rng = random.Random(13)
    for _ in range(300):
        total, terms = rng.randrange(10 ** rng.randrange(1, 15)), rng.randrange(1, 10 ** rng.randrange(1, 12))
        count = rng.randrange(total + 1)
        assert divergence.shares(np.array([count]), total, terms)[0] == 1 + 10**9 * (count + 5) // (total + 5 * terms)


# --- 10: equal rows, many sources


def plain_taken(sizes_by_source, targets):
    """Words that are taken of each source whose rows are all alike: whole passes, and rows that fit by half at least."""
    out = {}
    for s, (size, n) in sizes_by_source.items():
        passes = int(targets[s] / (size * n) + 1e-9)
        out[s] = size * n * passes + size * min(n, max(0, math.floor((targets[s] - passes * size * n) / size + 0.5)))
    return out


def test_equal_rows_are_cut_between(spark):
    """Sources of rows that agree in id and text come as near their targets as one row allows, alone and among others; empty texts take no room."""
    rows = [(None, "one two three four", "a", i) for i in range(1000)] + [(7, "five words are in here", "b", i) for i in range(333)] + [(i, f"text {i} " * (i % 9), "c", i) for i in range(400)] + [(None, "", None, i) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int").repartition(7)
    out = mixing.mixture(docs).collect()
    assert len(out) == len(rows) and {r["extra"] for r in out} == set(range(1000))
    taken, target, one = Counter(), {}, Counter()
    for r in out:
        taken[r["source"]] += r["_m_size"] * r["_m_passes"]
        target[r["source"]] = r["_m_target"]
        one[r["source"]] = max(one[r["source"]], r["_m_size"])
        assert len(r["_m_shards"]) == r["_m_passes"] <= 2
    assert all(abs(taken[s] - target[s]) <= one[s] for s in ("a", "b", "c")), (taken, target)
    want = plain_taken({"a": (4, 1000), "b": (5, 333)}, target)
    assert {s: taken[s] for s in want} == want
    again = Counter((r["source"], r["doc_id"], r["_m_passes"]) for r in mixing.mixture(docs.repartition(3)).collect())
    assert again == Counter((r["source"], r["doc_id"], r["_m_passes"]) for r in out)


@pytest.mark.parametrize("items", [10**9, 50])
def test_splits_of_any_size(monkeypatch, items):
    """More blocks than numpy draws from at once, by a lowered limit and by four million sources' worth of them."""
    monkeypatch.setattr(mixing, "DRAW_ITEMS", items)
    rng = np.random.default_rng(3)
    quotas = rng.integers(0, 40, 300) if items == 50 else np.full(3, 600_000_000)
    parts = mixing.splitting_tree(quotas, 8, np.random.default_rng(1))
    assert (parts.sum(0) == quotas).all() and (parts >= 0).all() and np.ptp(parts.sum(1)) <= 1
    assert (np.abs(parts - quotas / 8) < 8 * np.sqrt(quotas / 8 + 1)).all()
