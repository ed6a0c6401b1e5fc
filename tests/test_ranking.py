"""Selections: the known cases, and random inputs against a small Python model."""

import random
import re
import time
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.operators import filters, geo, grounding, health, matrix, metrics, ranking, state
from millrace.functions import text

NOW = datetime(2026, 9, 23, 6)
ART = "seq long, title string, source_name string, published_at timestamp, importance int, story_key string"
SIG = "seq long, title string, company_name string, published_at timestamp, score int, story_key string, company_is_actor boolean"


def art(i, **o):
    row = {"seq": i, "title": f"Story {i}", "source_name": "Src A", "published_at": NOW - timedelta(hours=i), "importance": 3, "story_key": ""} | o
    return tuple(row.values())


def sig(i, **o):
    row = {"seq": i, "title": f"Signal {i}", "company_name": "C", "published_at": NOW, "score": 4, "story_key": "", "company_is_actor": True} | o
    return tuple(row.values())


def test_clusters_collapse(spark):
    rows = [art(i, story_key="k", source_name=f"s{i}") for i in range(11)] + [art(20, importance=4)]
    out = ranking.top_stories(spark.createDataFrame(rows, ART)).collect()
    assert [(r["importance"], r["size"]) for r in out] == [(4, 1), (3, 11)]


def test_title_is_the_fallback_key(spark):
    out = ranking.top_stories(spark.createDataFrame([art(1, title="Wheat up 2%!"), art(2, title="wheat UP 2%")], ART)).collect()
    assert [r["size"] for r in out] == [2]


def test_caps(spark):
    rows = [art(i) for i in range(5)] + [art(10 + i, source_name=f"s{i}") for i in range(20)]
    out = ranking.top_stories(spark.createDataFrame(rows, ART)).collect()
    assert len(out) == 12 and sum(r["source_name"] == "Src A" for r in out) <= 2


def model(rows):
    """Greedy selection as written: clusters in rank order, at most two of a source, twelve in all."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[5] or "title:" + text.plain_title(r[1])].append(r)
    reps = []
    for g in groups.values():
        rep = sorted(g, key=lambda r: (-r[4], -(r[3] or datetime(1970, 1, 1)).timestamp(), r[0]))[0]
        reps.append((rep, len(g), min(r[0] for r in g)))
    reps.sort(key=lambda x: (-x[0][4], -x[1], -(x[0][3] or datetime(1970, 1, 1)).timestamp(), x[2]))
    used, out = defaultdict(int), []
    for rep, n, _ in reps:
        if used[rep[2]] < 2 and len(out) < 12:
            used[rep[2]] += 1
            out.append((rep[0], n))
    return out


def test_random_selections(spark):
    rng = random.Random(5)
    for _ in range(6):
        rows = [
            art(i, source_name=f"s{rng.randrange(6)}", importance=rng.randrange(1, 6), story_key=rng.choice(["", "a", "b", f"k{rng.randrange(9)}"]), published_at=rng.choice([None, NOW - timedelta(hours=rng.randrange(9))]))
            for i in range(60)
        ]
        assert [(r["seq"], r["size"]) for r in ranking.top_stories(spark.createDataFrame(rows, ART)).collect()] == model(rows)


def test_radar(spark):
    rows = [sig(i, story_key="d", company_name="A") for i in range(7)] + [sig(8, score=3), sig(9, score=5, company_is_actor=False), sig(10, score=5, company_name="B")]
    df = spark.createDataFrame(rows, SIG)
    out = ranking.radar(df).collect()
    assert [(r["score"], r["sources"]) for r in out] == [(5, 1), (4, 7)]
    assert ranking.radar_more(df).first()["more"] == 2


def test_radar_priority_breaks_ties(spark):
    df = spark.createDataFrame([sig(i, company_name=f"c{i}") for i in range(8)], SIG)
    companies = spark.createDataFrame([("c6", "high")], "name string, priority string")
    out = ranking.radar(df, companies).collect()
    assert len(out) == 5 and out[0]["company_name"] == "c6" and ranking.radar_more(df, companies).first()["more"] == 3


def test_empty_tables(spark):
    assert ranking.top_stories(spark.createDataFrame([], ART)).count() == 0
    assert ranking.radar_more(spark.createDataFrame([], SIG)).first()["more"] == 0


def test_flags(spark):
    df = spark.createDataFrame([("fr",), ("EU",), ("",), ("XYZ",), (None,)], "c string")
    assert [r[0] for r in df.select(text.flag_emoji(F.col("c"))).collect()] == ["🇫🇷", "🇪🇺", "", "", ""]
    names = spark.createDataFrame([(0, " United Kingdom"), (1, "france"), (2, "GLOBAL"), (3, "x"), (4, None)], "i int, country string")
    flags = spark.createDataFrame([("UK", "U"), ("France", "F")], "name string, flag string")
    assert [r["flag"] for r in geo.country_flags(names, flags).orderBy("i").collect()] == ["U", "F", "🌍", "", ""]


def test_noise(spark):
    noise = ["We are hiring a data intern", "Seed Market Size to reach", "Apply now: agronomist", "Corn 2024–2030 global market outlook"]
    keep = ["Hiring: Head of Agronomy", "Company opens plant", "International trade", None]
    df = spark.createDataFrame([(t,) for t in noise + keep], "t string")
    assert [r[0] for r in df.select(filters.is_noise(F.col("t"))).collect()] == [True] * 4 + [False] * 4


def test_seen_store(spark):
    now = F.lit(NOW)
    store = spark.createDataFrame([("a", NOW - timedelta(days=29)), ("b", NOW - timedelta(days=30)), ("c", NOW - timedelta(days=31))], "id string, seen_at timestamp")
    batch = spark.createDataFrame([("c", True), ("d", True), ("d", True), ("e", False)], "id string, classified boolean")
    assert sorted(r["id"] for r in state.only_new(batch, store).collect()) == ["d", "d", "e"]
    assert sorted(r["id"] for r in state.upsert_seen(store, state.processed(batch, now), now).collect()) == ["a", "c", "d"]


def test_state_versions(spark, tmp_path):
    path = str(tmp_path / "seen")
    assert state.read_state(spark, path, "id string").count() == 0
    state.write_state(spark.createDataFrame([("a",), ("b",)], "id string"), path, "2026-01-01")
    state.write_state(spark.createDataFrame([("c",)], "id string"), path, "2026-01-02")
    assert [r["id"] for r in state.read_state(spark, path, "id string").collect()] == ["c"]
    marks = str(tmp_path / "sent")
    assert state.sent_marker(spark, marks, "d1") and not state.sent_marker(spark, marks, "d1") and state.sent_marker(spark, marks, "d2")


def test_health_against_a_model(spark):
    rng = random.Random(3)
    log = [(d, f"s{s}", rng.choice([0, 0, 1]), rng.choice([None, 0, 2]) if s % 2 else None) for s in range(8) for d in range(12)]
    got = {r["source"]: (r["streak"], r["fetch_streak"]) for r in health.health(spark.createDataFrame(log, "run_ts int, source string, passed int, raw int")).collect()}
    for s in range(8):
        streak, fetch = 0, None
        for _, name, passed, raw in log:
            if name == f"s{s}":
                streak = 0 if passed > 0 else streak + 1
                if raw is not None:
                    fetch = 0 if raw > 0 else (fetch or 0) + 1
        assert got[f"s{s}"] == (streak, fetch)


def test_revisions_and_change(spark):
    rows = [("A", 1, 5.0), ("A", 3, None), ("B", 2, 7.0), ("B", 1, 9.0)]
    out = {r["k"]: r["value"] for r in matrix.latest_revision(spark.createDataFrame(rows, "k string, Month int, Value double"), ["k"]).collect()}
    assert out == {"A": None, "B": 7.0}
    gap = spark.createDataFrame([("x", 2000, 1.0), ("x", 2002, 2.0), ("x", 2003, 3.0)], "k string, Market_Year int, value double")
    assert [r["yoy_pct"] for r in matrix.year_on_year_all(gap, ["k"]).orderBy("Market_Year").collect()] == [None, None, 50.0]


def test_cost(spark):
    prices = spark.createDataFrame(metrics.PRICES, metrics.PRICE_SCHEMA)
    rows = [("s", "small", 100_000, 0, 0, 0, False), ("s", "small", 100_001, 0, 0, 0, False), ("s", "none", 1_000_000, None, 0, 0, True)]
    usage = spark.createDataFrame(rows, "stage string, model string, input_tokens long, output_tokens long, cache_read long, cache_write long, batch boolean")
    assert [round(r["cost"], 7) for r in metrics.call_cost(usage, prices).orderBy("input_tokens").collect()] == [0.01, 0.0500005, 1.5]


def test_grounding(spark):
    cases = [
        ("up 1,200 t", "rose 1200", []), ("up 23%", "2.3", ["23"]), ("about 12 t", "12.4 t", []), ("15.0 t", "15", []), ("in Q33 and 12-week", "", []),
        ("in 2026", "", []), ("top 10 and 45", "", ["45"]), ("45 then 45", "", ["45"]), ("5 t", "", []),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, t string, s string")
    got = [r[0] for r in df.orderBy("i").select(grounding.ungrounded(F.col("t"), F.col("s"))).collect()]
    assert got == [c for *_, c in cases]
    fixed = spark.createDataFrame([("A robust plan — Leverage it",)], "t string").select(grounding.autofix(F.col("t"))).first()[0]
    assert fixed == "A strong plan, Use it"


def plain_ungrounded(text, source):
    """Every figure by its own patterns."""
    src, out, seen = source.replace(",", ""), [], set()
    for token in re.findall(r"\d[\d.,]*", text):
        norm = token.strip(".,").replace(",", "")
        if len(norm) < 2 or re.fullmatch(r"(19|20)\d\d", norm) or norm in seen:
            continue
        seen.add(norm)
        q, alone = re.escape(token), lambda v: re.search(rf"(?<!\d){re.escape(v)}(?!\d)", src)
        structure = re.search(rf"(?i)([QH]{q}\b|\btop[\s-]{q}\b|\bG{q}\b|{q}[\s-](?:week|day|month|year|quarter))", text)
        if not (structure or alone(norm) or (norm.endswith(".0") and alone(norm[:-2])) or ("." not in norm and re.search(rf"(?<!\d){re.escape(norm)}\.\d", src))):
            out.append(token)
    return out


def test_figures_against_their_own_patterns(spark):
    """Figures with points, commas and endings, in and out of structure, over random texts and sources."""
    rng = random.Random(21)
    piece = lambda: rng.choice(["12", "1", "2024", "12.5", "12.0", "1,200", "1.2.3", "1.2.3.4", "3.", "7,", "..", " ", " ", "Q", "H", "top ", "top-", "G", " G", " weeks", "-day", "x", "é", "year ", "00", "99", ". "])
    rows = [(i, "".join(piece() for _ in range(rng.randrange(14))), "".join(piece() for _ in range(rng.randrange(10)))) for i in range(1500)]
    df = spark.createDataFrame(rows, "i int, t string, s string")
    both = df.select("i", grounding.ungrounded(F.col("t"), F.col("s")).alias("a"), grounding.ungrounded(F.col("t"), figures=grounding.source_figures(F.col("s"))).alias("b"))
    got = {r["i"]: (r["a"], r["b"]) for r in both.collect()}
    assert got == {i: (w, w) for i, t, s in rows for w in [plain_ungrounded(t, s)]}
    assert sum(bool(a) for a, _ in got.values()) > 300


def test_cost_of_figures_is_linear(spark):
    """Eight times the figures take no more than about eight times as long."""

    def took(n):
        text = " ".join(str(10**7 + 37 * i) for i in range(n))
        df = spark.range(4, numPartitions=1).select(F.lit(text).alias("t"), F.concat(F.lit(text), F.col("id").cast("string")).alias("s")).persist()
        df.count()
        best = 1e9
        for _ in range(3):
            began = time.perf_counter()
            df.select(F.size(grounding.ungrounded(F.concat("t", F.lit(" 123456789")), F.col("s"))).alias("n")).agg(F.sum("n")).collect()
            best = min(best, time.perf_counter() - began)
        df.unpersist()
        return best

    few, many = took(2000), took(16000)
    assert many < 16 * few + 1


LINES = {
    "en": "The price of wheat is not the only thing that farmers look at this year.", "fr": "Le prix du blé est au plus haut et les agriculteurs ne sont pas contents.",
    "de": "Die Preise für den Weizen sind im Juli nicht gestiegen, und das ist auch gut.", "es": "El precio del trigo no sube y los agricultores lo saben por la prensa.",
    "pt": "Os preços do trigo não sobem e os agricultores vendem mais na bolsa.", "it": "Il prezzo del grano non sale e gli agricoltori sono in attesa della pioggia.",
    "pl": "Ceny pszenicy nie rosną, a rolnicy czekają na deszcz i dopłaty od rządu.", "nl": "De prijs van het graan is niet gestegen en dat is een zorg voor de boeren.",
    "ro": "Prețul grâului nu este mai mare, iar fermierii din sud au de așteptat pentru plată.", "tr": "Buğday fiyatı bu yıl çok arttı ve çiftçiler için daha iyi bir sezon olarak görülüyor.",
    "hu": "A búza ára nem emelkedett, és az aszály is gond, hogy ezt ne feledjük.", "uk": "Ціни на пшеницю не зростають, і аграрії чекають на дощ від середи до п'ятниці.",
    "cs": "Cena pšenice se nezvýšila, ale je to pro zemědělce v kraji problém.", "sv": "Priset på vete är inte högre och det är en oro för bönderna som odlar.",
}


def test_languages(spark, sf_dir):
    """A sentence of each language, texts without any common word, and the labelled documents."""
    rows = [*LINES.items(), ("en", None), ("en", ""), ("en", "12 ... !"), ("en", "Xyz qqq")]
    df = spark.createDataFrame(rows, "lang string, t string").select("lang", text.guess_language(F.col("t")).alias("got"))
    assert [r for r in df.collect() if r["lang"] != r["got"]] == []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang is not null").select((text.guess_language(F.col("text")) == F.col("lang")).cast("int").alias("ok"))
    assert docs.agg(F.avg("ok")).first()[0] > 0.97


def test_state_of_runs_that_meet(spark, tmp_path):
    """Runs of one version don't touch each other, a run that dies leaves nothing that counts, and old versions go."""
    path, frame = str(tmp_path / "s"), lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    assert state.versions(spark, path) == []
    one, two = state.write_state(frame("a"), path, "2026-01-01"), state.write_state(frame("b"), path, "2026-01-01")
    assert one != two and [r["id"] for r in state.read_state(spark, path, "id string").collect()] == ["b"]
    frame("lost").write.parquet(f"{path}/version=2026-09-09~dead")
    (tmp_path / "s" / "version=2026-09-09~dead" / "_SUCCESS").unlink()
    assert [r["id"] for r in state.read_state(spark, path, "id string").collect()] == ["b"]
    for day in ("02", "03", "04"):
        state.write_state(frame(day), path, f"2026-01-{day}", keep=2)
    assert [v.partition("~")[0] for v in state.versions(spark, path)] == ["version=2026-01-03", "version=2026-01-04"]
    assert [state.sent_marker(spark, str(tmp_path / "m"), d) for d in ("x", "x", "y")] == [True, False, True]
