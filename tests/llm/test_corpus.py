"""The corpus operators against brute force, round trips, held-out accuracy and odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from compare import same
from pyspark.sql import functions as F

from millrace.llm import chat, decontam, graph, jaccard, langid, media, mixing, oracles, quality, sharding, spans, textkernel, urlrules
from millrace.llm.queries import ORACLE_SQL, QUERIES

DOC = "doc_id long, text string, lang string, source string, n_chars long, shard string, _m_key int"
LONG = "word " * 30_000 + "end."
ODD = [
    (1, None, "en", "a", None, "x", 1), (2, "", "en", "a", 0, None, 2), (3, "A plain short text, here.", None, None, 3, "y", None), (3, "A plain short text, here.", None, None, 3, "y", None),
    (None, "No id at all, but a text of some words.", "en", "b", 1, "", 0), (5, "!!! ??? 123", "fr", "b", 2, "z", 9), (6, LONG, "en", "b", 9, "q", 9), (7, "Ünï ßtraße 漢字 🙂", "de", None, 1, "", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def documents(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(name, spark, duck, sf_dir):
    same(QUERIES[name](spark, sf_dir), duck, ORACLE_SQL[name])


# --- kernel


def plain_words(t):
    return [w for w in re.findall(r"[^\W_]+", (t or "").lower())]


def test_kernel_agrees_with_plain_words():
    texts = [None, "", "a b c", "Ünï-ßtraße 12x", LONG, "x" * 3000, "...", "one two three four five six"]
    for size in (1 << 20, 64):
        seen = {}
        for ids, off, h in textkernel.word_batches(texts, size):
            for k, i in enumerate(ids):
                seen[i] = h[off[k] : off[k + 1]]
        for i, t in enumerate(texts):
            assert len(seen[i]) == len(plain_words(t))
        vocabulary = {}
        for i, t in enumerate(texts):
            for w, h in zip(plain_words(t), seen[i].tolist(), strict=True):
                assert vocabulary.setdefault(w, h) == h
        assert len(set(vocabulary.values())) == len(vocabulary)
    for ids, off, h in textkernel.word_batches(texts):
        so, sh = textkernel.shingle_batch(off, h, 5)
        for k, i in enumerate(ids):
            assert so[k + 1] - so[k] == max(len(plain_words(texts[i])) - 4, min(1, len(plain_words(texts[i]))))
            assert (sh[so[k] : so[k + 1]] == textkernel.run_hashes(h[off[k] : off[k + 1]], 5)).all()


# --- 1


def test_shards(spark, sf_dir, documents):
    out = QUERIES["op1_interleaved_shards"](spark, sf_dir).toPandas()
    assert sorted(out.doc_id) == sorted(documents.doc_id) and out.groupby("shard").size().max() - out.groupby("shard").size().min() <= 1
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    by = out.groupby(["source", "shard"]).size().unstack(fill_value=0)
    assert (by.max(axis=1) - by.min(axis=1) <= 2).all()
    m = out.merge(documents, on="doc_id")
    assert (m.text_crc32 == m.text.map(lambda t: zlib.crc32(t.encode()))).all() and (m["size"] == m.text.map(lambda t: len(t.encode()) + 1)).all()


def test_shards_by_brute_force(spark, odd, nothing):
    out = sharding.interleave(odd, 3).toPandas()
    assert list(out.columns) == [c for c in odd.columns if c != "shard"][:5] + ["_m_key", "shard", "slot"]
    assert len(out) == len(ODD) and sorted(out.groupby("shard").size()) == [2, 3, 3]
    again = sharding.interleave(odd.repartition(5), 3).toPandas()
    key = lambda d: sorted(map(repr, d[["doc_id", "text", "shard", "slot"]].fillna("-").values.tolist()))
    assert key(out) == key(again)
    assert sharding.interleave(nothing, 3).count() == 0


# --- 2


def test_urls(spark):
    urls = [None, "no scheme", "HTTP://A.Example.ORG/es/1?x", "http://example.org/en/12", "http://example.org/en/2", "http://org", "http://x.com/fr/", "http://x.com/de/1", "http://notexample.org/es/", "http://b.net/?q#f", ""]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(0, 1), (1, None)], "doc_id long, quality int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlrules.judge_urls(pages, labels).collect()}
    assert got[0] == ("", "", None, "allow") and got[1][:3] == ("", "", None)
    assert got[2] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[3][2:] == ("example.org/en/1", "block") and got[4][2:] == ("org/", "allow")
    assert got[5][:3] == ("org", "", None) and got[6][2:] == ("com/fr/", "allow") and got[7][2:] == ("com/de/", "block") and got[8][2:] == ("org/", "allow") and got[9][:2] == ("b.net", "/")
    assert urlrules.judge_urls(pages.limit(0), labels.limit(0)).count() == 0


def test_host_label_like_the_marker(spark):
    """Good pages of bad.example.net stay good, and a bad one among them can be mined."""
    urls = ["http://bad.example.net/a/x"] * 40 + ["http://ill.example.net/b/x"] * 10 + ["http://bad.example.net/c/x"] * 10
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(60)], "doc_id long, quality int")
    got = {r["page_id"]: r["verdict"] for r in urlrules.judge_urls(pages, labels, stated=[]).collect()}
    assert got == {i: "allow" if i < 40 else "block" for i in range(60)}


def test_mined_rules_by_brute_force(spark, sf_dir):
    pages, labels = (spark.read.parquet(f"{sf_dir}/../sf0.1/{t}.parquet") for t in ("pages", "labels"))
    host, path = urlrules.url_host(F.col("url")), urlrules.url_path(F.col("url"))
    rows = pages.join(labels, pages["page_id"] == labels["doc_id"]).select(urlrules.url_tokens(F.col("url"), host, path).alias("tokens"), (F.col("quality") == 0).alias("bad")).collect()
    from itertools import combinations

    n, bad = Counter(), Counter()
    for r in rows:
        for k in range(1, len(r["tokens"]) + 1):
            for c in combinations(sorted(r["tokens"]), k):
                n[c] += 1
                bad[c] += r["bad"]
    base, total, want = sum(r["bad"] for r in rows) / len(rows), len(rows), set()
    for c, b in bad.items():
        p, z = b / n[c], urlrules.WILSON_Z
        low = (p + z * z / (2 * n[c]) - z * np.sqrt(p * (1 - p) / n[c] + z * z / (4 * n[c] ** 2))) / (1 + z * z / n[c])
        if b >= np.ceil(urlrules.MIN_SUPPORT * total) and p >= urlrules.MIN_CONFIDENCE and p / base >= urlrules.MIN_LIFT and low >= urlrules.MIN_LOWER:
            want.add(c)
    labelled = spark.createDataFrame([(r["tokens"], r["bad"]) for r in rows], "tokens array<string>, bad boolean")
    assert {tuple(r["antecedent"]) for r in urlrules.mine_rules(labelled).collect()} == want


# --- 3


def test_language(spark, sf_dir, documents):
    out = QUERIES["op3_bloom_language"](spark, sf_dir).toPandas().merge(documents, on="doc_id")
    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = out[out.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98 and out.score.between(0, 1).all()


def test_language_odd(spark, odd, nothing, documents):
    train = spark.createDataFrame(documents[["doc_id", "text", "lang"]])
    got = langid.predict(odd, langid.fit(train)).toPandas()
    assert list(got.lang_pred[got.text.isna() | got.text.isin(["", "!!! ??? 123"])]) == ["und"] * 3 and (got.lang_pred[got.doc_id == 6] != "und").all()
    assert langid.identify(nothing).count() == 0 and len(langid.known_language(odd).columns) == len(odd.columns)


def test_filters_hold_every_gram():
    grams = textkernel.mix(np.arange(1000, dtype=np.uint64))
    slots = np.zeros((1 << langid.SLOT_BITS, 1), np.uint64)
    for p in langid.positions(grams):
        slots[p, 0] |= np.uint64(2)
    f = langid.BitSlicedFilters(slots, ["a", "b"])
    assert (f.masks(grams) == 2).all() and np.count_nonzero(f.masks(textkernel.mix(np.arange(5000, 9000, dtype=np.uint64)))) < 5


# --- 4


def test_leaks(spark, sf_dir, documents):
    bench = pd.read_parquet(f"{sf_dir}/benchmark.parquet")
    flat = lambda t: " " + " ".join(plain_words(t)) + " "
    texts = [(i, flat(t)) for i, t in zip(documents.doc_id, documents.text, strict=True)]
    want = {(d, i) for i, t in zip(bench.item_id, bench.text, strict=True) for d, x in texts if flat(t) in x}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_latent_leaks"](spark, sf_dir).collect()}
    assert want <= got and len(got - want) <= len(want) // 20


def test_paraphrases_are_found(spark, sf_dir, documents):
    """A fifth of the words replaced; recall against the planted pairs is 0.9 at least, clean documents stay."""
    rng = random.Random(4)
    bench = pd.read_parquet(f"{sf_dir}/benchmark.parquet")
    clean = [t for t in documents.text if 50 < len(t.split()) < 400][:60]
    pool = [w for t in clean for w in t.split()]
    rows, want = [], set()
    for k, (i, t) in enumerate(zip(bench.item_id, bench.text, strict=True)):
        words = [rng.choice(pool) if rng.random() < 0.2 else w.upper() for w in t.split()]
        rows.append((1000 + k, rng.choice(clean) + "\n" + " ".join(words) + "\n" + rng.choice(clean)))
        want.add((1000 + k, i))
    rows += [(2000 + k, " ".join(rng.choices(pool, k=200))) for k in range(40)]
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench)).collect()}
    assert len(want & got) >= 0.9 * len(want) and not [d for d, _ in got if d >= 2000]


def test_short_item_in_a_third_of_the_documents(spark, sf_dir, documents):
    bench = pd.read_parquet(f"{sf_dir}/benchmark.parquet")[["item_id", "text"]]
    item = " ".join(bench.text[0].split()[:15])
    bench = spark.createDataFrame([(int(i), t) for i, t in zip(bench.item_id, bench.text, strict=True)] + [(-1, item)], "item_id long, text string")
    rng, rows, want = random.Random(8), [], set()
    for d, text in zip(documents.doc_id, documents.text, strict=True):
        words = (text or "").split()
        if d % 3 == 0 and len(words) >= 60:
            at = rng.randrange(len(words))
            text = " ".join([*words[:at], item, *words[at:]])
            want.add(d)
        rows.append((int(d), text))
    got = {r["doc_id"] for r in decontam.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect() if r["item_id"] == -1}
    assert len(want) > 200 and want <= got


def test_lcs():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(1, 20)), rng.integers(0, 6, rng.integers(1, 30))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert decontam.lcs_length(a, b) == table[-1, -1]


def test_leaks_odd(spark, odd, nothing):
    bench = spark.createDataFrame([(1, "No id at all, but a text of some words."), (2, None), (3, ""), (4, "two words")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(odd, bench).collect()] == [(None, 1)]
    assert decontam.without_leaks(odd, bench).count() == len(ODD) - 1 and decontam.without_leaks(odd, bench.limit(0)).count() == len(ODD)
    assert decontam.find_leaks(nothing, bench).count() == 0


# --- 5


def test_png_round_trip(spark, odd, nothing):
    got = media.read_media(media.to_media(odd).select("doc_id", "n_bytes", "media")).toPandas()
    for (_, text, *_), r in zip(ODD, got.itertuples(), strict=True):
        raw = (text or "").encode()
        padded = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    assert got.media_sha256[2] == got.media_sha256[3] and got.feature[0] == got.feature[1] and media.to_media(nothing).count() == 0


def test_png_filters_and_damage():
    rng = np.random.default_rng(2)
    image = rng.integers(0, 256, (9, 64), dtype=np.uint8)
    rows = np.zeros((9, 65), np.uint8)
    at = lambda y, x: int(image[y, x]) if y >= 0 and x >= 0 else 0
    for y in range(9):
        kind = y % 5
        rows[y, 0] = kind
        for x in range(64):
            a, b, c = at(y, x - 1), at(y - 1, x), at(y - 1, x - 1)
            p = a + b - c
            guess = [0, a, b, (a + b) // 2, min(((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c)))[2]][kind]
            rows[y, x + 1] = (int(image[y, x]) - guess) & 255
    assert (media._unfilter(rows) == image).all()
    png = media.encode_png(image.tobytes())
    assert (media.decode_png(png) == image).all()
    for k in (3, 20, len(png) // 2, len(png) - 6):
        broken = bytearray(png)
        broken[k] ^= 1
        with pytest.raises(ValueError):
            media.decode_png(bytes(broken))
    with pytest.raises(ValueError):
        media.decode_png(png[:-12])


# --- 6


def brute_links(rows):
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := plain_words(t)) else frozenset([t]) for i, t in rows}
    links, parent = defaultdict(int), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    posting = defaultdict(list)
    for j in ids:
        for i, n in Counter(i for s in sets[j] for i in posting[s]).items():
            if n * 10 >= 8 * (len(sets[i]) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[j]:
            posting[s].append(j)
    return {i: (root(i), links[i]) for i in ids}


def test_jaccard_join(spark, sf_dir, documents):
    want = brute_links(zip(documents.doc_id, documents.text, strict=True))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in QUERIES["op6_bayes_jaccard"](spark, sf_dir).collect()}
    assert got == want


def test_large_group_in_blocks(spark, monkeypatch):
    """A group over several blocks loses no link, by products of incidence matrices or pair by pair."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 40)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_links(rows)


def test_strung_out_component(spark, monkeypatch):
    """Groups that only a weak likeness strings together stay apart in blocks, and lose no link."""
    rng = random.Random(9)

    def words(n):
        return [f"w{rng.randrange(9000)}" for _ in range(n)]

    rows, tail = [], words(90)
    for g in range(60):
        base = tail + words(30)
        tail = base[30:]  # three quarters of each group's text are in the next group's
        for k in range(6):
            w = list(base)
            w[rng.randrange(len(w))] = f"x{k}"
            rows.append((g * 6 + k, " ".join(w)))
    seen = {}

    def cut(*tables, real=jaccard.cut_large):
        seen["blocks"], seen["pairs"] = real(*tables)
        return seen["blocks"], seen["pairs"]

    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 12)
    monkeypatch.setattr(jaccard, "cut_large", cut)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_links(rows)
    held, n = seen["blocks"].groupBy("block").count().toPandas()["count"], seen["pairs"].select("first", "second").distinct().count()
    assert held.sum() > 200 and n < len(held) * (len(held) + 1) / 4


def test_jaccard_odd(spark, odd, nothing):
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in jaccard.near_duplicates(odd).collect()}
    assert got[1] == (1, 0, 0) and got[3] == (3, 1, 1) and got[None] == (None, 0, 0) and got[2] == (2, 0, 0)
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "5", "6", "7", "None"]
    assert jaccard.near_duplicates(nothing).count() == 0 and jaccard.one_of_each(nothing).count() == 0


def test_clashing_names(spark, documents):
    """Columns named like the operators' own, or like their results, come back as they were."""
    docs = documents.head(60).assign(_m_key=range(60), _m_gone="g", _m_lang="l", _m_src=1.5, lang_pred="p", digest="d", text_="t")
    df = spark.createDataFrame(docs)
    bench = spark.createDataFrame([(1, "no such item anywhere in here at all")], "item_id long, text string")
    for run in (langid.known_language, jaccard.one_of_each, lambda d: decontam.without_leaks(d, bench), mixing.mixed_rows, lambda d: sharding.interleave(d, 4)):
        out = run(df).toPandas()
        assert list(out.columns)[: len(docs.columns)] == list(docs.columns) and len(out)
        both = out.merge(docs, on="doc_id", suffixes=("", "_was"))
        assert all((both[c] == both[f"{c}_was"]).all() for c in docs.columns if c != "doc_id")


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in range(60):
        for a, b in pairs:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r["node"]: r["comp"] for r in graph.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == parent


# --- 7


def brute_repeats(rows):
    """Which sentences go, by comparing word tuples."""
    first, found = {}, []
    for i, t in sorted(rows):
        cuts = spans.sentence_cuts(t).tolist() if t else [0, 0]
        sent = [plain_words(t[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)] if t else []
        long_enough = lambda part: (sum(map(bool, part)) >= spans.MIN_SENTENCES and sum(map(len, part)) >= spans.MIN_WORDS) or (len(part) == 1 and len(part[0]) >= spans.ALONE_WORDS)
        own = set()  # runs that start at a sentence, and runs that end with it
        for s in range(len(sent)):
            if sent[s]:
                stop = next((e for e in range(s + 1, len(sent) + 1) if long_enough(sent[s:e])), None)
                start = next((b for b in range(s, -1, -1) if long_enough(sent[b : s + 1])), None)
                own |= {(s, stop)} - {(s, None)}
                own |= {(start, s + 1)} - {(None, s + 1)}
        found += [(i, s, e, tuple(w for x in sent[s:e] for w in x)) for s, e in sorted(own)]
    for i, s, _, w in found:
        first.setdefault(w, (i, s))
    gone = defaultdict(set)
    for i, s, e, w in found:
        if first[w] != (i, s):
            gone[i] |= set(range(s, e))
    return {i: len(g) for i, g in gone.items()}


def test_repeated_spans(spark, sf_dir, documents):
    got = {r["doc_id"]: r["n_removed"] for r in QUERIES["op7_sentence_spans"](spark, sf_dir).collect()}
    assert got == brute_repeats(list(zip(documents.doc_id, documents.text, strict=True)))


def test_planted_passage(spark, odd, nothing):
    passage = " ".join(f"tok{i}" + ("." if i % 13 == 12 else "") for i in range(60)) + "."
    rows = [(1, f"Start one. {passage} End one."), (2, f"Begin.\n{passage}\nStop here."), (3, "Start one. End one.")]
    out = spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["first_doc_ids"], r["text"]) for r in out] == [(2, [1], "Begin.\nStop here.")]
    assert all("".join(t[a:b] for a, b in zip(c[:-1], c[1:], strict=True)) == t for t in (LONG, passage) if (c := spans.sentence_cuts(t).tolist()))
    assert {r["doc_id"] for r in spans.without_repeats(odd).collect()} <= {6} and spans.without_repeats(nothing).count() == 0


def test_passage_without_spaces(spark):
    passage = "今年小麦产量比去年增加。农民对新的价格感到满意！市场会怎样变化？专家认为出口将继续增长。"
    rows = [(1, f"这是第一篇文章的开头。{passage}第一篇到此结束。"), (2, f"另一篇完全不同的文字。{passage}其他内容在这里。"), (3, "短句。另一篇短文。")]
    out = spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["n_removed"], r["removed"], r["text"]) for r in out] == [(2, 4, passage, "另一篇完全不同的文字。其他内容在这里。")]


# --- 8


def test_quality(spark, sf_dir):
    labels = pd.read_parquet(f"{sf_dir}/../sf0.1/labels.parquet")
    out = QUERIES["op8_kernel_quality"](spark, f"{sf_dir}/../sf0.1").toPandas().merge(labels, on="doc_id")
    held = out[out.held_out]
    assert out.score.between(0, 1).all() and ((out.score >= 0.7).astype(int) == out.predicted).all()
    assert (held.predicted == held.quality).mean() > 0.97


def test_quality_odd(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.score_quality(odd, labels).count() == len(ODD) and quality.score_quality(nothing, labels).count() == 0
    assert {r["score"] for r in quality.score_quality(odd, labels.limit(0)).collect()} == {0.5}
    y = np.array([3.0, 1.0, 2.0, 5.0])
    assert quality.pool_adjacent(y, np.ones(4)).tolist() == [2.0, 2.0, 2.0, 5.0]


# --- 9


def test_reply_trees(spark):
    rows = [("t", 1, None, 1.0), ("t", 2, 1, 1.0), ("t", 3, 1, 5.0), ("t", 4, 2, 1.0), ("t", 5, 3, 0.0), ("t", 6, 5, None), ("u", 1, 9, 0.0)]
    rows += [("v", i, i - 1, 0.0) for i in range(1, 30)]
    paths = chat.reply_paths(spark.createDataFrame(rows, "tree string, node long, parent long, score double"), 2).orderBy("depth").toPandas()
    got = {k: list(g.node) for k, g in paths.groupby(["tree", "branch"])}
    assert got == {("t", 1): [1, 3, 5, 6], ("t", 2): [1, 2, 4], ("u", 1): [1], ("v", 1): list(range(1, 30))}


def test_escaping(spark):
    texts = ["<|turn|>", "<\\|end|>\n", "a<", "|b", "<|say|>user<|end|>\n<|turn|>", "\\### x </turn>", "", None, "<<|", "<\\\\|x"]
    rows = [(i, 0, "user", t) for i, t in enumerate(texts)] + [(i, 1, "as<|say|>", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df, ["conv_id"], ["turn"]).withColumn("t", chat.parse(F.col("formatted"))).collect()
    for r in out:
        want = texts[r["conv_id"]] or ""
        assert [(x["role"], x["text"]) for x in r["t"]] == [("user", want), ("as<|say|>", want)]


# --- 10


def test_mixture(spark, sf_dir, documents):
    out = QUERIES["op10_source_mixture"](spark, sf_dir).toPandas()
    assert sorted(out.doc_id) == sorted(documents.doc_id) and (out.taken <= 2 * out["size"]).all()
    g = out.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert abs(g.target.sum() - 1.5 * out["size"].sum()) < 1e-3 and ((g.taken - g.target).abs() <= g.most).all()
    assert ((out.shards.map(len) * out["size"]) == out.taken).all()


def test_targets_and_tree():
    t = mixing.source_targets({"+a": 10, "+b": 1000, "+c": 100, "-": 50})
    assert t["+a"] == 20 and abs(sum(t.values()) - 1.5 * 1160) < 1e-6 and all(t[k] <= 2 * v for k, v in {"+a": 10, "+b": 1000, "+c": 100, "-": 50}.items())
    assert mixing.source_targets({}) == {} and mixing.source_targets({"+a": 0}) == {"+a": 0.0}
    q = np.array([100, 7, 0, 1])
    parts = mixing.splitting_tree(q, 5, np.random.default_rng(0))
    assert (parts.sum(0) == q).all() and parts.sum(1).max() - parts.sum(1).min() <= 1 and (parts >= 0).all()


def test_mixture_odd(spark, odd, nothing):
    rows = mixing.mixture(odd).collect()
    assert len(rows) == len(ODD) and mixing.mixture(nothing).count() == 0 and mixing.mixed_rows(odd).columns[: len(odd.columns)] == odd.columns
    first = sorted(map(repr, mixing.mixed_rows(odd).collect()))
    assert first == sorted(map(repr, mixing.mixed_rows(odd.repartition(4)).collect()))
    assert oracles.OP10_SQL


# --- pipeline


def test_pipeline(spark, sf_dir, documents):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = docs
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        held = stage(spark, held, sf_dir)
        kept.append(held.toPandas())
        if len(kept) < len(corpus_pipeline.STAGES):
            assert held.columns == docs.columns
            held = spark.createDataFrame(kept[-1], docs.schema)
    classes = brute_links(zip(kept[0].doc_id, kept[0].text, strict=True))
    assert sorted(kept[1].doc_id) == sorted(i for i, (c, _) in classes.items() if i == c)
    assert set(kept[2].doc_id) <= set(kept[1].doc_id) and len(kept[0]) >= 0.99 * len(documents)
    assert kept[3].groupby("doc_id").size().max() <= 2 and len(kept[4]) == len(kept[3])
