"""Typed feeds, paged tables, the feed stream, the archive in two phases, and extraction in SQL: failures, restarts and odd inputs."""

import json
import subprocess
import sys
from datetime import UTC, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from stand_ins import FlakyPages, count

from millrace.sinks import two_phase
from millrace.sources import extractors, feeds, paged
from millrace.streaming import feed_log

# --- items of feeds


def test_items_keep_their_own_children(spark):
    """Missing, empty and repeated children, CDATA, markup, attributes, other namespaces, RDF, no items, no XML."""
    bodies = {
        "own": "<rss><channel><item><title>A</title></item><item><title>B</title><pubDate>2024-01-30</pubDate><link>l</link></item><item/></channel></rss>",
        "odd": "<rss xmlns:dc='http://p'><channel><item><dc:title>no</dc:title><title><![CDATA[C & <b>c</b>]]></title><title>again</title><pubDate/><link rel='x'>m</link><description>d <i>e</i></description></item></channel></rss>",
        "rdf": "<rdf:RDF xmlns:rdf='r'><channel/><item><title>R</title></item></rdf:RDF>", "none": "<rss><channel/></rss>", "broken": "<rss><channel><item>", "null": None, "empty": "",
    }
    rows = feeds.xml_items(spark.createDataFrame(list(bodies.items()), "source string, body string")).collect()
    got = {(r["source"], r["seq"]): (r["title"], r["link"], r["pubDate"], r["description"]) for r in rows}
    assert got == {
        ("own", 0): ("A", None, None, None), ("own", 1): ("B", "l", "2024-01-30", None), ("own", 2): (None, None, None, None),
        ("odd", 0): ("C & <b>c</b>", "m", None, "d <i>e</i>"), ("rdf", 0): ("R", None, None, None),
    }


def test_items_need_no_python(spark):
    plan = feeds.xml_items(spark.createDataFrame([("s", "<rss/>")], "source string, body string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


# --- paged tables


def test_pages_are_asked_again(spark, tmp_path):
    """Every page is refused once; two walks of one table meet without a gap or a double; only the wanted tables are walked."""
    options = {"client": "stand_ins:FlakyPages", "folder": str(tmp_path), "wait": "0"}
    rows = paged.read_paged(spark, **options).where(F.col("table").isin("a", "b"))
    assert rows.rdd.getNumPartitions() == 3
    got = sorted((r["table"], r["cursor"] or "0", r["pos"], json.loads(r["json"])["n"]) for r in rows.collect())
    assert got == sorted([("a", str(n), i, n) for n in range(10) for i in range(2)] + [("b", "0", i, 0) for i in range(2)])
    assert not list(tmp_path.glob("asked-c*"))
    assert paged.read_paged(spark, **options).where("table = 'b' and table = 'a'").count() == 0


def test_pages_that_keep_failing_fail(spark, tmp_path):
    options = {"client": "stand_ins:FlakyPages", "folder": str(tmp_path), "wait": "0", "attempts": "2"}
    reader = paged.PagedReader({**options, "refuse": "2"})
    with pytest.raises(ConnectionError):
        list(reader.read(reader.partitions()[0]))
    with pytest.raises(ValueError, match="come back"):
        list(paged.PagedReader(options).read(paged.InputPartition(paged.Walk("c"))))
    assert count(tmp_path, "a-None") == 3 and FlakyPages(options).walks()[0].until == "5"


def test_folder_without_pages(spark, tmp_path):
    assert paged.read_paged(spark, path=str(tmp_path)).count() == 0


# --- feeds as a stream


def _bodies(spark, polls):
    rows = [(s, p, f"<rss><channel><item><title>{s} {p}</title></item>\n<item><title>more</title></item></channel></rss>") for s, p in polls]
    return spark.createDataFrame(rows, "source string, poll int, body string")


def test_stream_restarts_in_the_middle(spark, tmp_path):
    """A batch that dies is read again as it was, though polls landed meanwhile; nothing is lost or doubled."""
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    seen: list[tuple] = []

    def run(sink):
        query = feed_log.read_feed_log(spark, log, 1).writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(sink).start()
        query.awaitTermination()

    def keep(batch, n):
        seen.extend((n, r["source"], r["poll"], r["pos"]) for r in batch.collect())

    def die(batch, n):
        batch.collect()
        raise ConnectionError("sink")

    feed_log.land(_bodies(spark, [("a b/c", 1), ("d", 1), ("a b/c", 2)]), log)
    run(keep)
    feed_log.land(_bodies(spark, [("a b/c", 3), ("new é", 1)]), log)
    with pytest.raises(Exception, match="sink"):
        run(die)
    feed_log.land(_bodies(spark, [("d", 2), ("d", 3)]), log)
    run(keep)
    run(keep)
    want = {0: [("a b/c", 1), ("a b/c", 2), ("d", 1)], 1: [("a b/c", 3), ("new é", 1)], 2: [("d", 2), ("d", 3)]}
    assert sorted(seen) == sorted((n, s, p, i) for n, polls in want.items() for s, p in polls for i in range(2))


def test_poll_lands_what_holds_a_feed(spark, tmp_path):
    sources = spark.createDataFrame([("good", "https://f/1"), ("refused", "https://f/2"), ("gone", "https://f/3"), ("broken", "https://f/4")], "name string, url string")
    body = b"<rss><channel><item><title>t</title></item></channel></rss>"
    fetch = lambda u: {"1": (200, body), "2": (503, b""), "3": (404, b""), "4": (200, b"<no")}[u[-1]]
    retry = lambda u: (200, body.replace(b">t<", b">again<"))
    feed_log.poll_feeds(sources, 1, str(tmp_path), fetch, retry)
    log = feed_log.FolderLog(str(tmp_path))
    assert log.latest() == {"good": 1, "refused": 1, "broken": 1} and "again" in log.body("refused", 1) and log.body("gone", 1) is None


# --- the archive in two phases


def test_attempts_that_do_not_count_are_not_published(spark, tmp_path):
    """A speculative attempt, an aborted run and a run that was committed before leave the archive as it is."""
    options = {"run": "r1", "path": str(tmp_path)}
    rows = [Row(id=f"x{i}", v=i) for i in range(5)] + [Row(id=None, v=9)]
    writer = two_phase.ArchiveWriter(options)
    first, _twice = writer.write(iter(rows)), writer.write(iter(rows))
    writer.commit([first, None])
    again = two_phase.ArchiveWriter(options)
    again.commit([again.write(iter(rows))])
    lost = two_phase.ArchiveWriter({**options, "run": "r2"})
    lost.abort([lost.write(iter(rows)), None])
    got = two_phase.read_archive(spark, str(tmp_path), "id string, v int")
    assert sorted(tuple(r) for r in got.collect()) == [(f"x{i}", i, "r1") for i in range(5)]
    assert [tuple(r) for r in two_phase.run_counts(spark, str(tmp_path)).collect()] == [("r1", 5, 1)]
    assert len(list((tmp_path / "rows").iterdir())) == 2  # what counts, and the attempt that Spark never told about


def test_failed_tasks_are_tried_again(tmp_path):
    """In a session that retries tasks: the first attempt dies half way through its rows."""
    code = f"""
from pyspark.sql import SparkSession
from millrace.sinks import two_phase as t
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
rows = spark.range(40).repartition(4).selectExpr("concat('x', id) AS id", "id AS v")
t.write_archive(rows, "r", client="stand_ins:FlakyArchive", path={str(tmp_path)!r})
try:
    t.write_archive(rows, "s", client="stand_ins:FlakyArchive", path={str(tmp_path)!r}, refuse="99")
except Exception as e:
    print("failed")
got = t.read_archive(spark, {str(tmp_path)!r}, "id string, v long")
print(got.count(), got.distinct().count(), [tuple(r) for r in t.run_counts(spark, {str(tmp_path)!r}).collect()])
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200)
    assert out.stdout.split("\n")[-3:-1] == ["failed", "40 40 [('r', 40, 0)]"], out.stderr[-2000:]
    assert (tmp_path / "asked-x7").stat().st_size > 1


def test_new_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4), (None, 5), ("c", 6)], "id string, v int")
    held = spark.createDataFrame([("c", 0)], "id string, v int")
    assert sorted(map(tuple, two_phase.new_rows(rows, held, "v").collect()), key=str) == sorted([("a", 1), ("b", 3), (None, 4), (None, 5)], key=str)
    assert two_phase.read_archive(spark, str(tmp_path), "id string").count() == 0


# --- extraction in SQL


def test_rules_are_a_value(spark):
    with pytest.raises(TypeError):
        extractors.RULES["own"] = extractors.Rule(rows="b")
    rules = extractors.with_rules(own=extractors.Rule(rows="b", strip_title=(("x", "y"),)))
    assert "own" not in extractors.RULES and extractors.rules_of(extractors.rules_json(rules)) == rules


def test_lateral_extract_equals_frame_form(spark):
    """Built-in rules over pages of several rows, and a source without a rule, in both forms."""
    now = datetime(2026, 3, 25, tzinfo=UTC)
    item = lambda k, title, day: f"<div class='ndm-result-container'><div class='ndm-result-title'><a href='/s{k}'>{title}</a></div><span class='ndm-result-date'>{day}</span></div>"
    pages = [("statcan", f"https://h/{n}", "".join(item(k, t, d) for k, (t, d) in enumerate([("Field crops", "2026-03-24"), ("Trade", "2026-03-24"), ("Grain <b>stocks</b>", "2026-03-24"), ("Field crops", "2020-01-01")]))) for n in range(3)]
    pages += [("nobody", "https://h/9", "<p>x</p>"), ("ksh", "https://h/8", "")]
    df = spark.createDataFrame(pages, "source string, url string, html string")
    df.createOrReplaceTempView("lateral_pages")
    extractors.register_sql(spark)
    text = "SELECT r.* FROM lateral_pages p, LATERAL extract_rows(p.source, p.url, p.html, '2026-03-25T00:00:00') r"
    frame = sorted(map(str, extractors.run_extractors(df, now).collect()))
    assert sorted(map(str, spark.sql(text).collect())) == frame and len(frame) == 7
    with pytest.raises(Exception, match="must be a constant"):
        spark.sql(text.replace("'2026-03-25T00:00:00'", "p.url")).collect()


# --- configuration as variants


def test_a_page_is_parsed_once(spark):
    """Whatever is read from it; values of every type, bad JSON, missing and null pages."""
    from millrace.sources import config

    page = {"properties": {"Name": {"type": "title", "title": [{"plain_text": "N"}, {"plain_text": "more"}]}, "Lookback Hours": {"type": "number", "number": 24}, "Enabled": {"type": "checkbox", "checkbox": True}, "URL": {"type": "url", "url": None}, "Keywords Filter": {"type": "multi_select", "multi_select": [{"name": "a"}, {"name": "b"}]}}}
    df = spark.createDataFrame([(json.dumps(page),), ("{broken",), (None,), ("[]",)], "json string")
    rows = config.source_rows(df)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") + plan.count("ParseJson") + plan.count("parseJson") <= 2 and plan.count("get_json_object") == 0
    got = [tuple(r[c] for c in ("name", "url", "enabled", "keywords_filter", "lookback_hours")) for r in rows.collect()]
    assert got == [("N", "", True, ["a", "b"], 24)] + [("", "", False, [], 0)] * 3
    states = config.parsed_pages(df).select(*(config.property_state(F.col("page"), n).alias(n) for n in ("Name", "URL", "None"))).collect()
    assert [tuple(r) for r in states] == [("held", "empty", "missing"), (None,) * 3, (None,) * 3, ("missing",) * 3]


# --- zipped cubes


def test_zips_are_read_by_member(spark, tmp_path):
    """A partition for each CSV member; quoted line ends, a byte order mark, bad bytes, members without rows, nested folders, no zips."""
    import zipfile

    from millrace.sources import zips

    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", "\ufeffA,B\n" + "\n".join(f'{i},"two\nlines, {i}"' for i in range(9000)))
        z.writestr("empty.csv", "")
        z.writestr("head.csv", "A,B\n")
        z.writestr("y.txt", "no")
    with zipfile.ZipFile(tmp_path / "in" / "b.ZIP", "w") as z:
        z.writestr("in/x.csv", b"B,A\n\xff,7\n,8,more\n")
    rows = zips.read_zipped(spark, f"file://{tmp_path}")
    assert rows.rdd.getNumPartitions() == 4
    facts = zips.read_facts(spark, str(tmp_path), "A int, B string, C int")
    got = sorted(map(tuple, facts.collect()), key=str)
    assert got == sorted([(i, f"two\nlines, {i}", None) for i in range(9000)] + [(7, "\ufffd", None), (8, None, None)], key=str)
    assert [r["row"] for r in rows.where("member = 'x.csv'").orderBy("row").collect()] == list(range(9000))
    (tmp_path / "none").mkdir()
    assert zips.read_zipped(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        zips.read_zipped(spark, str(tmp_path / "nowhere")).count()
