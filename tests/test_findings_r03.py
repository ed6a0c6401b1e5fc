"""Cases of the third round's findings, each on tables of a few rows."""

from datetime import datetime, timedelta

import duckdb
import pytest
from compare import same
from pyspark.sql import functions as F

from millrace import catalog
from millrace.functions import text
from millrace.operators import grounding, state
from millrace.queries import stores as replays
from millrace.queries.extracts import NOW
from millrace.sources import extractors
from millrace.sources.html import parse_html, select_text
from millrace.streaming import stores


@pytest.fixture
def holds(spark, tmp_path):
    """Runs a query over the given tables (name: DataFrame) and holds it against its SQL."""

    def run(name, **tables):
        con = duckdb.connect()
        for table, df in tables.items():
            df.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
            con.sql(f"create view {table} as select * from read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
        return same(catalog.QUERIES[name](spark, str(tmp_path)), con, catalog.ORACLE_SQL[name])

    return run


def test_banned_words_by_the_letters_of_the_sql(spark, holds):
    texts = ["und\u00df\u00f6be", "wei\u00dfund", "hund", "the\u0436", "\u00e0the", "The end und", "eau\u0153", "eau\nthing", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert holds("banned_words", documents=docs) == 5
    by_unicode = docs.select(F.explode(grounding.banned_words(F.col("text"), ["und", "the", "eau", "thing"])).alias("w"), "doc_id").orderBy("doc_id", "w")
    assert [tuple(r) for r in by_unicode.collect()] == [("the", 5), ("und", 5), ("eau", 7), ("thing", 7)]


HEADINGS = ["Fish &amp; chips", "cut &amp", "a &quot;b&quot;", "&amp;lt;", "&#39;x&#39; &copy", "caf\u00e9 R&D", "plain"]


def _pages(spark, extra=()):
    rows = [(i, f"https://h.example/{i}", f"<html><h1>{h}</h1><p>&quot;</p></html>") for i, h in enumerate([*HEADINGS, *extra])]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_extract_lateral_reads_the_references_of_its_sql(spark, holds):
    assert holds("extract_lateral", pages=_pages(spark)) == len(HEADINGS)
    rule = extractors.Rule(rows="h1", references=("amp",))
    assert extractors.rules_of(extractors.rules_json({"r": rule, "all": extractors.Rule(rows="h1")})) == {"r": rule, "all": extractors.Rule(rows="h1")}


def test_page_nodes_reads_the_references_of_its_sql(spark, holds):
    assert holds("page_nodes", pages=_pages(spark, ["x &lt;y&gt; z", "&nbsp;n"])) == len(HEADINGS) + 2
    assert [r["text"] for r in select_text(_pages(spark), "h1").orderBy("page_id").collect()][1:5] == ["cut &", 'a "b"', "&lt;", "'x' \u00a9"]
    assert parse_html("<b a='&lt;&amp;'>&lt;</b>", ()).first("b").attrs["a"] == "&lt;&amp;"


def test_extract_mapa_with_keys_that_look_like_years(spark, holds):
    assert holds("extract_mapa", customer=spark.range(2000, 2045).select(F.col("id").alias("c_custkey"))) == 16
    page = "<a href='/dam/2012/x_enero.pdf'>Avance</a><a href='/dam/2025/y_enero.pdf'>Avance</a><a href='/dam/2012/03-24/z.pdf'>Avance</a>"
    assert [r[3] for r in extractors.extract("mapa", "https://h.example/", page, NOW)] == ["https://h.example/dam/2025/y_enero.pdf"]


def test_pages_of_one_row_group_keep_all_cores_busy(spark):
    page = "<h4 class='titreSearch'><a href='/r'>Blé</a></h4><div class='date'>24/03/2026</div>"
    pages = spark.range(0, 800, 1, 1).select(F.lit("agreste").alias("source"), F.lit("https://h.example/").alias("url"), F.lit(page).alias("html"), F.col("id").alias("page_id"))
    for rows in (extractors.run_extractors(pages, NOW), select_text(pages, "h4")):
        shares = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert len(shares) == 8 and max(shares) <= 110 and sum(shares) == 800


def test_salvage_makes_each_text_once(spark):
    rows = [(1, "Up 125 now.", [("a", "Held 40 tonnes. Lost 77."), ("b", "Gone 99.")], "40 tonnes"), (2, None, [("a", "Fine.")], "x"), (3, "Plain.", [("a", "No 55.")], None), (4, "Plain.", [("a", "Yes 55.")], "55")]
    briefs = spark.createDataFrame(rows, "id long, takeaway string, sections array<struct<label string, text string>>, source_text string")
    out = grounding.salvage(briefs)
    assert out.columns == briefs.columns
    got = [(r["id"], r["takeaway"], [tuple(s) for s in r["sections"]]) for r in out.where("size(sections) = 1").orderBy("id").collect()]
    assert got == [(1, "Held 40 tonnes.", [("a", "Held 40 tonnes.")]), (4, "Plain.", [("a", "Yes 55.")])]
    tokens = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("(\\d[\\d.,]*), 1)")
    assert tokens(out.where("size(sections) = 1")) == 4  # two for the takeaway, two for the sections


def test_banned_words_in_one_pass(spark):
    words = ["game", "game-changer", "changer", "a.b", "robust", "robust"]
    texts = ["A Game-Changer here", "game, a.b robust", "axb gamer", "", None, "changer game-changers", "robust\u00e9"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string").select("id", grounding.banned_words(F.col("t"), words).alias("w"))
    assert [r["w"] for r in docs.orderBy("id").collect()] == [["game", "game-changer", "changer"], ["game", "a.b", "robust"], [], [], [], ["game", "changer"], []]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(docs).count("regexp_extract_all") == 2 and "rlike" not in plan(docs).lower()
    given = spark.createDataFrame([("x \u2014 Robust " + "w " * 320,), ("Fine",), (None,)], "t string")
    issues = given.select(grounding.hard_issues(F.concat(F.upper("t"), F.lit(" delve"))).alias("i"))
    assert [r["i"] for r in issues.collect()][:2] == [["Contains an em/en dash.", "Too long: 324 words (max 320).", "Banned word: 'robust'.", "Banned word: 'delve'."], ["Banned word: 'delve'."]]
    assert plan(issues).count("upper(") == 1


def test_seen_state_holds_ids_by_the_share(spark, tmp_path):
    """Parts land in several files and are one batch each; the state has a value for each share, not for each id, and is the batch form."""
    rows = spark.range(0, 4000, 1, 4).select(F.format_string("i%d", F.col("id") % 900).alias("id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7 % 4000 * 60).alias("seen_at"))
    replays._replayed(spark, rows, "seen_at", 2, str(tmp_path), lambda log: stores.seen_stream(log, 1, shares=16))
    assert len(list((tmp_path / "log").glob("*.parquet"))) == 8
    batches = spark.read.parquet(*[str(f) for f in (tmp_path / "out").glob("batch=*")])
    assert batches.agg(F.sum("rows")).first()[0] == 4000 and batches.count() == 1800 and batches.where("new").count() >= 900
    assert stores.stored(spark, f"{tmp_path}/state", "seen").count() == 16
    want = state.upsert_seen(rows.limit(0), rows, F.lit(rows.agg(F.max("seen_at")).first()[0]), 1)
    got = stores.stored_seen(spark, f"{tmp_path}/state")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and 0 < want.count() < 900


def test_seen_state_to_the_microsecond(spark, holds):
    """Times three days before the last, by one microsecond more and less; users and times that are null."""
    last = datetime(2024, 1, 10, 0, 0, 0, 1500)
    back = [timedelta(0), timedelta(days=3), timedelta(days=3, microseconds=-1), timedelta(days=3, microseconds=1), timedelta(days=3, microseconds=500), timedelta(days=9), timedelta(days=2)]
    rows = [(i, last - d, None if i == 6 else i, "view") for i, d in enumerate(back)] + [(7, None, 7, "view"), (8, last - timedelta(days=5), 2, "view")]
    assert holds("seen_state", events=spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")) == 3


def test_guessed_languages_look_at_each_word_once(spark, holds):
    """Every common word alone, each with the next, ties, words of no language, marks between words, nulls; the words are filtered once, on all cores."""
    words = [w for line in text.COMMON_WORDS.values() for w in line.split()]
    texts = [*words, *map(" ".join, zip(words, words[1:])), "the le der", "of, OF;of des des", "der9die_und", "xyz", "0~", "", " ", None, "de la de la en", "\u0130\u00c7IN bir", "\U00010428 the", "a\u0301 the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert holds("guessed_languages", documents=docs) == len(texts)
    plan = docs.select(text.guess_language(F.col("text")).alias("l"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("filter(") == 1
