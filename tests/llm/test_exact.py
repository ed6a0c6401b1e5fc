"""The corpus operators against plain versions of their methods, and the inputs that are easy to get wrong."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, common, decontam, jaccard, langid, media, mixing, quality, sharding, spans, textkernel, urlrules
from millrace.llm.queries import QUERIES


@pytest.fixture(scope="module")
def documents(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet")


def plain_words(t):
    return [w for w in re.findall(r"[^\W_]+", (t or "").lower())]


# --- rows that share an id, and ids that aren't plain numbers

BIG = 9007199254740993  # not a float


def test_ids_stay_whole(spark):
    rows = [(BIG, "one text of some words here"), (None, "another text of some words"), (BIG + 2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = {BIG, None, BIG + 2}
    assert {r["doc_id"] for r in jaccard.near_duplicates(docs).collect()} == want
    assert {r["doc_id"] for r in media.read_media(media.to_media(docs)).collect()} == want
    labels = spark.createDataFrame([(BIG, 1)], "doc_id long, quality int")
    assert {r["doc_id"] for r in quality.score_quality(docs, labels).collect()} == want
    bench = spark.createDataFrame([(None, "text of some words"), (BIG, "one text"), (BIG + 2, "no such thing")], "item_id long, text string").coalesce(1)
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench).collect()}
    assert got == {(BIG, None), (None, None), (BIG, BIG)}


def test_spans_of_rows_with_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" + ("." if i % 6 == 5 else "") for i in range(30)) for x in "abc")
    rows = [(1, f"{a} Here it ends."), (2, f"{a} There it ends."), (2, f"{b} Elsewhere."), (None, f"{c} Nowhere."), (None, f"{a} Nobody."), (3, f"{c} Else.")]
    got = {(r["doc_id"], r["text"].strip()): r["first_doc_ids"] for r in spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(2, "There it ends."): [1], (None, "Nobody."): [1], (None, "Nowhere."): [3]}


def test_short_passage_inside_sentences(spark):
    """A passage whose first and last sentences run on into their hosts still goes by its whole sentences."""
    inner = "the harvest was early this year. prices rose in every market we follow, and stocks fell."
    rows = [(1, f"Some words before {inner} And after."), (2, f"Other ones, that run on into. {inner} No more of it.")]
    # one whole sentence of seven words in all lies between the ends that differ: no run
    assert spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), min_words=1).count() == 0
    rows = [(i, f"{x} words that lead into one two three. four five six seven eight nine ten eleven. twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen. and so on {x}") for i, x in enumerate("pq")]
    assert [(r["doc_id"], r["n_removed"]) for r in spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [(1, 2)]


@pytest.mark.parametrize("words", [6, 9, 15, 21])
def test_short_repeats_without_a_floor(spark, words):
    """Three whole sentences of so many words in all: found when no words are asked for, and by default from 16 words on."""
    own = lambda x: " ".join(f"{x}{i}." for i in range(12))
    passage = " ".join(f"p{i}{'.' if i % (words // 3) == words // 3 - 1 else ''}" for i in range(words))
    docs = spark.createDataFrame([(1, f"{own('a')} {passage} {own('b')}"), (2, f"{own('c')} {passage} {own('d')}"), (3, own("e"))], "doc_id long, text string")
    got = lambda **bounds: [(r["doc_id"], r["n_removed"], r["removed"].strip()) for r in spans.without_repeats(docs, **bounds).collect()]
    assert got(min_words=1) == [(2, 3, passage)]
    assert got() == ([(2, 3, passage)] if words >= spans.MIN_WORDS else [])


def test_one_of_each_by_row(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(1, t, "x"), (1, "something quite different from all others", "y"), (None, t + " z", "n"), (None, t, "n"), (1, t, "x"), (2, None, "a"), (2, None, "a")]
    out = sorted(map(tuple, jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()), key=repr)
    assert out == sorted([(1, t, "x"), (1, "something quite different from all others", "y"), (2, None, "a"), (2, None, "a")], key=repr)


def test_many_rows_without_id(spark):
    """Null ids spread by their texts: as many rows come back as went in."""
    rows = [(None, f"text number {i} of many with {i * 7} and {i * 13} in it") for i in range(300)] * 2
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 600 and {r["n_copies"] for r in got} == {1}


def test_leaks_by_row(spark):
    bench = spark.createDataFrame([(1, "a whole benchmark item of more than some words stands here"), (2, "four words in all"), (3, "uniqueword")], "item_id long, text string")
    rows = [(1, "It says: a whole benchmark item of more than some words stands here, word for word."), (1, "A clean text."), (None, "four words in all"), (None, "four other words in all of it"), (4, "has uniqueword in it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench).collect()} == {(1, 1), (None, 2), (4, 3)}
    assert sorted(r["text"] for r in decontam.without_leaks(docs, bench).collect()) == ["A clean text.", "four other words in all of it"]


def test_passages_in_blocks(spark, sf_dir, monkeypatch):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench).collect()}
    monkeypatch.setattr(decontam, "BLOCK_PASSAGES", 40)
    assert whole and whole == {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench).collect()}


def test_clashing_names(spark):
    df = spark.createDataFrame([(i, f"text {i} of some words", "en", "s", 1, 2, 3, "k") for i in range(20)], "doc_id long, text string, lang string, source string, _m_x int, _user__m_x int, held_out int, _user_held_out string")
    bench = spark.createDataFrame([(1, "no such item")], "item_id long, text string")
    for run in (langid.known_language, jaccard.one_of_each, lambda d: decontam.without_leaks(d, bench), mixing.mixed_rows, lambda d: sharding.interleave(d, 4), mixing.mixture):
        out = run(df)
        assert out.columns[: len(df.columns)] == df.columns and {tuple(r[4:8]) for r in out.collect()} <= {(1, 2, 3, "k")}


def test_folder_is_refused_off_local_masters(spark, monkeypatch):
    class Far:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: type("K", (), {"get": staticmethod(lambda k, d=None: None)}))})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(Far)


# --- 1


def test_layout_is_rank_and_cut(spark, documents, monkeypatch):
    """Against ranks and one global sort in plain Python, with slices so small that many are needed."""
    monkeypatch.setattr(sharding, "SLICE_ROWS", 40)
    docs = spark.createDataFrame(documents[["doc_id", "text", "source"]])
    keyed = docs.withColumn("k", sharding.shuffle_key(docs, "doc_id", "text", common.SEED)).withColumn("s", common.source_key("source")).select("doc_id", "k", "s").toPandas()
    keyed["r"] = keyed.sort_values("k").groupby("s").cumcount() + 1
    keyed["f"] = (keyed.r - 0.5) / keyed.groupby("s").k.transform("size")
    order, n = keyed.sort_values(["f", "s", "k"]).doc_id.tolist(), len(keyed)
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.interleave(docs, 7).collect()}
    for pos, doc in enumerate(order):
        shard = pos * 7 // n
        assert got[doc] == (shard, pos - -(-shard * n // 7))


# --- 2


def test_urls_odd(spark):
    long = "http://long.example.net/" + "x/" * 50_000
    pages = spark.createDataFrame([(1, long, "p"), (1, long, "p"), (None, "http://a.net/", "p")], "page_id long, url string, host string")
    labels = spark.createDataFrame([(1, 0), (None, 0)], "doc_id long, quality int")
    got = sorted(((r["page_id"], len(r["path"]), r["verdict"]) for r in urlrules.judge_urls(pages, labels).collect()), key=str)
    assert [x[:2] for x in got] == [(1, 100_001), (1, 100_001), (None, 1)]


def test_rules_of_many_tokens_and_ties(spark):
    """A rule that takes four tokens together is found; rules of equal confidence and support are told apart by their words."""
    urls, bad = [], []
    for m in range(16):
        for rep in range(6):
            keys = "&".join(f"{k}=1" for i, k in enumerate("abcd") if m >> i & 1)
            urls.append(f"http://h.example.net/{rep}/p?{keys}")
            bad.append(m == 15)
    labels = spark.createDataFrame([(i, int(not b)) for i, b in enumerate(bad)], "doc_id long, quality int")
    out = urlrules.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), labels, stated=[]).collect()
    judged = {r["page_id"]: (r["verdict"], r["mined_rule"]) for r in out}
    assert all(judged[i][0] == "block" for i, b in enumerate(bad) if b)
    assert len({judged[i][1] for i, b in enumerate(bad) if b}) == 1 and all(f"query={k}" in judged[bad.index(True)][1] for k in "abcd")


# --- 3


def plain_grams(t):
    f = "".join(c.lower() if len(c.lower()) == 1 else c for c in (t or "") if True)
    f = " " + " ".join(re.findall(r"[^\W\d_]+", f)) + " "
    return [] if not f.strip() else [f[i : i + 4] for i in range(max(1, len(f) - 3))]


def test_language_by_plain_sets(spark, sf_dir, documents):
    """The same rates and limits with Python sets in place of Bloom filters."""
    out = QUERIES["op3_bloom_language"](spark, sf_dir).toPandas().set_index("doc_id")
    counts = defaultdict(Counter)
    for i, t, lang in zip(documents.doc_id, documents.text, documents.lang, strict=True):
        if lang and not out.held_out[i]:
            counts[lang].update(plain_grams(t))
    total = {k: sum(c.values()) for k, c in counts.items()}
    most = Counter()
    for k, c in counts.items():
        for g, n in c.items():
            most[g] = max(most[g], n / total[k])
    held = {k: {g for g, n in c.items() if n >= langid.MIN_COUNT and n / total[k] >= most[g] * langid.MIN_SHARE} for k, c in counts.items()}
    wrong = 0
    for i, t in zip(documents.doc_id, documents.text, strict=True):
        g = plain_grams(t)
        if not g:
            assert out.lang_pred[i] == "und"
            continue
        hits = {k: sum(x in s for x in g) / len(g) for k, s in held.items()}
        best = max(sorted(hits), key=hits.get)
        wrong += best != out.lang_pred[i]
        assert abs(hits[out.lang_pred[i]] - out.score[i]) < 0.05
    assert wrong <= len(documents) // 500


def test_more_languages_than_bits(spark):
    rng = random.Random(3)
    alphabets = {f"l{k:03d}": [chr(0x4E00 + k * 40 + i) for i in range(3)] for k in range(130)}
    rows = []
    for k, (lang, letters) in enumerate(alphabets.items()):
        rows += [(k * 100 + i, " ".join("".join(rng.choices(letters, k=4)) for _ in range(80)), lang) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.fit(docs)
    assert filters.slots.shape[1] == 3 and len(filters.languages) == 130
    got = langid.predict(docs, filters).toPandas()
    assert (got.lang == got.lang_pred).all()


def test_grams_do_not_depend_on_pieces():
    for t in ("", "  ..", "Ab", "x", "Some words, 12 and more... ", "a" * 50 + " " * 40 + "b" * 9, "..Ünï ßt 漢字--"):
        whole = np.concatenate([*langid.gram_batches(t), np.zeros(0, np.uint64)])
        assert len(whole) == len(plain_grams(t))
        for size in (1, 3, 7):
            assert (np.concatenate([*langid.gram_batches(t, size), np.zeros(0, np.uint64)]) == whole).all()


# --- 5


def test_feature_is_the_low_cosines(spark, documents):
    def feature(payload):
        image = np.frombuffer(payload, np.uint8).reshape(-1, 64).astype(float)
        def shrink(x, n):  # rows to 32 bands
            if n < 32:
                return np.array([x[i * n // 32] for i in range(32)])
            edge = [i * n // 32 for i in range(33)]
            return np.array([x[edge[i] : edge[i + 1]].mean(0) for i in range(32)])

        small = shrink(shrink(image, len(image)).T, 64).T
        low = [[sum(small[y, x] * math.cos(math.pi * (2 * y + 1) * u / 64) * math.cos(math.pi * (2 * x + 1) * v / 64) for y in range(32) for x in range(32)) for v in range(8)] for u in range(8)]
        flat = np.array(low).ravel()
        return flat, np.median(flat[1:])

    some = documents.iloc[[0, 5, 40, 77]]
    got = media.read_media(media.to_media(spark.createDataFrame(some[["doc_id", "text"]]))).toPandas().set_index("doc_id")
    for i, t in zip(some.doc_id, some.text, strict=True):
        flat, middle = feature(media.pad((t or "").encode()))
        bits = np.unpackbits(np.frombuffer(bytes.fromhex(got.feature[i]), np.uint8)).astype(bool)
        sure = np.abs(flat - middle) > 1e-6 * np.abs(flat).max()
        assert (bits[sure] == (flat > middle)[sure]).all() and sure.sum() >= 60


# --- 8


def test_quality_fit_by_one_matrix(spark, sf_dir):
    """The sums by partition give the same model as all labelled rows in one matrix."""
    folder = f"{sf_dir}/../sf0.1"
    docs, labels = (pd.read_parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    stats = np.stack([quality.text_statistics(t) for t in docs.text])
    out = QUERIES["op8_kernel_quality"](spark, folder).toPandas().set_index("doc_id").loc[docs.doc_id]
    known = docs.assign(at=range(len(docs)), held=out.held_out.to_numpy()).merge(labels, on="doc_id")
    known = known[~known.held & known.quality.notna()]
    x, y = stats[known["at"]], known.quality.to_numpy(float)
    model = quality.Model(x.mean(0), np.sqrt(np.maximum((x * x).mean(0) - x.mean(0) ** 2, 1e-8)))
    f = model.features(x)
    model.weight = np.linalg.solve(f.T @ f + quality.RIDGE * len(x) * np.eye(f.shape[1]) / 10, f.T @ y)
    raw = f @ model.weight
    lo, hi = raw.min(), raw.max()
    at = np.clip(((raw - lo) / (hi - lo) * quality.BINS).astype(int), 0, quality.BINS - 1)
    n, s = np.bincount(at, minlength=quality.BINS), np.bincount(at, y, minlength=quality.BINS)
    full = np.flatnonzero(n)
    value, edge = quality.pool_adjacent(s[full] / n[full], n[full]), lo + (full + 0.5) * (hi - lo) / quality.BINS
    want = np.interp(model.raw(stats), edge, np.clip(value, 0, 1))
    # a row on the edge of two bins may fall into the other one
    assert np.quantile(np.abs(want - out.score.to_numpy()), 0.99) < 0.02


# --- 9


def test_cycles_and_doubles(spark):
    rows = [("a", 1, 2, 1.0), ("a", 2, 1, 1.0), ("a", 3, 1, 1.0), ("b", 1, 1, 1.0), ("c", 1, None, 0.0), ("c", 2, 1, 0.0), ("c", 2, 1, 0.0), ("c", 3, 4, 0.0), ("c", 4, 3, 0.0), (None, 1, None, 0.0), (None, 2, 1, 0.0), ("d", None, 1, 0.0)]
    got = chat.reply_paths(spark.createDataFrame(rows, "tree string, node long, parent long, score double")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("c", 1, 0, 1), ("c", 1, 1, 2), (None, 1, 0, 1), (None, 1, 1, 2)], key=repr)


def test_paths_by_walking(spark):
    """Random trees: every leaf's path and score by walking up, the best two of each tree."""
    rng, rows, want = random.Random(5), [], {}
    for tree in range(12):
        parent = {k: None if k == 0 else rng.randrange(max(0, k - 4), k) for k in range(rng.randrange(1, 60))}
        score = {k: float(rng.randrange(5)) for k in parent}
        rows += [(f"t{tree}", k, p, score[k]) for k, p in parent.items()]
        paths = []
        for leaf in set(parent) - set(parent.values()):
            path = [leaf]
            while parent[path[-1]] is not None:
                path.append(parent[path[-1]])
            paths.append((-sum(score[k] for k in path), leaf, path[::-1]))
        for b, (_, _, path) in enumerate(sorted(paths)[:2], 1):
            want[f"t{tree}", b] = path
    out = chat.reply_paths(spark.createDataFrame(rows, "tree string, node long, parent long, score double"), 2).orderBy("depth").toPandas()
    assert {k: list(g.node) for k, g in out.groupby(["tree", "branch"])} == want


def test_chat_odd(spark, tmp_path):
    rows = [(None, 1, "user", "hi"), (None, 2, "assistant", None), (5, 1, "user", "a"), (5, 1, "assistant", "b"), (5, 1, "assistant", "b"), (6, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/some/conversations.parquet")
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat.op9_reply_chat(spark, f"{tmp_path}/some").collect()}
    assert got == {None: (2, 0), 5: (3, 2), 6: (1, 0), -7: (2, 26)}
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert [r["conv_id"] for r in chat.op9_reply_chat(spark, f"{tmp_path}/none").collect()] == [-7]


# --- 10


def test_blocks_fill_the_quotas(spark, documents):
    """Every block goes whole to one shard in each pass, and shards hold as many blocks but for one."""
    out = mixing.mixture(spark.createDataFrame(documents[["doc_id", "text", "source"]])).toPandas()
    where, blocks = {}, defaultdict(set)
    for source, key, shards in zip(out.source, out._m_key, out._m_shards, strict=True):
        for p, shard in enumerate(shards):
            block = (source, key[:2], p)
            assert where.setdefault(block, shard) == shard
            blocks[int(shard)].add(block)
    held = [len(blocks[s]) for s in range(8)]
    assert max(held) - min(held) <= 1 and (out._m_shards.map(len) == out._m_passes).all()


def test_prefix_end_digit_by_digit(spark, documents, monkeypatch):
    """The prefix of each source by one sort in plain Python, with so few rows to a window that digits are needed."""
    monkeypatch.setattr(mixing, "EDGE_ROWS", 2)
    out = mixing.mixture(spark.createDataFrame(documents[["doc_id", "text", "source"]])).toPandas()
    for _, g in out.groupby("source"):
        g = g.sort_values("_m_key")
        size, target = int(g._m_size.sum()), g._m_target.iloc[0]
        whole = int(target / size + 1e-9)
        before = g._m_size.cumsum() - g._m_size
        assert (g._m_passes == whole + (before + g._m_size / 2 <= target - whole * size)).all()


def test_many_sources(spark):
    rows = [(i, "a few words " * (1 + i % 3), f"s{i:05d}") for i in range(21_000)]
    out = mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, source string")).agg(F.count("*"), F.sum("_m_size"), F.sum("_m_target")).first()
    assert out[0] == 21_000 and abs(out[2] - 1.5 * out[1]) < 1e-3


# --- pipeline


def test_stages_by_brute_force(spark, sf_dir, documents):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = pd.read_parquet(f"{sf_dir}/benchmark.parquet")
    flat = lambda t: " " + " ".join(plain_words(t)) + " "
    leaky = {i for i, t in zip(documents.doc_id, documents.text, strict=True) if any(flat(b) in flat(t) for b in bench.text)}
    kept = {r["doc_id"] for r in stages["decontamination"](spark, docs, sf_dir).select("doc_id").collect()}
    assert not kept & leaky and len(kept) >= 0.99 * (len(documents) - len(leaky))
    known = {r["doc_id"] for r in stages["language id"](spark, docs, sf_dir).select("doc_id").collect()}
    judged = QUERIES["op3_bloom_language"](spark, sf_dir).toPandas()
    assert known == set(judged.doc_id[(judged.lang_pred != "und") & (judged.score >= langid.MIN_SCORE)])
    mixed = Counter(r["doc_id"] for r in stages["source mixture"](spark, docs, sf_dir).select("doc_id").collect())
    taken = mixing.mixture(docs).toPandas()
    assert mixed == Counter({i: n for i, n in zip(taken.doc_id, taken._m_passes, strict=True) if n})
    placed = stages["sharding"](spark, docs, sf_dir).toPandas()
    plain = QUERIES["op1_interleaved_shards"](spark, sf_dir).toPandas()
    assert placed.set_index("doc_id")[["shard", "slot"]].sort_index().equals(plain.set_index("doc_id")[["shard", "slot"]].sort_index())
    assert textkernel.PIECE
