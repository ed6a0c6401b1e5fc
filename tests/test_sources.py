"""Feeds, pages, configuration, sinks and streams."""

from datetime import UTC, datetime

from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import dates, text, urls
from millrace.operators import classify, filters
from millrace.plans import adapters, daily
from millrace.sinks import archive, render, report
from millrace.sources import config, extractors, feeds, html, statistics
from millrace.streaming import events

NOW = datetime(2026, 3, 25, tzinfo=UTC)
RSS = """<rss><channel><item><title>Wheat &amp;amp; corn</title><link> https://x/1 </link><pubDate>Tue, 24 Mar 2026 10:00:00 GMT</pubDate><description>harvest</description></item>
<item><title>Old wheat</title><link>https://x/2</link><pubDate>01/01/2026</pubDate></item><item><title></title><link>https://x/3</link></item><item><title>Undated crop</title><link>https://x/4</link></item></channel></rss>"""
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link href="https://y/1"/><updated>2026-03-24T01:02:03Z</updated></entry></feed>'


def test_feed_parsing():
    assert [e[1] for e in feeds.parse_feed(RSS)] == ["https://x/1", "https://x/2", "https://x/3", "https://x/4"]
    assert feeds.parse_feed(ATOM) == [("A", "https://y/1", "", "2026-03-24T01:02:03Z")]
    assert feeds.parse_feed("<broken") == []


def sources(spark):
    rows = [("m", "https://x/rss", "media", "rss", "", True, [], "", 0, 0), ("o", "https://x/off", "official", "rss", "France", True, None, "", 0, 0)]
    return spark.createDataFrame(rows, schemas.SOURCE)


def test_scans(spark):
    calls = {"https://x/rss": (200, RSS.encode()), "https://x/off": (503, b"")}
    entries = feeds.fetch_feeds(sources(spark), lambda u: calls[u], lambda u: (200, RSS.encode()), concurrency=1)
    now = F.lit(NOW)
    got = feeds.articles(entries, sources(spark), now).collect()
    assert [(r["title"], r["url"]) for r in got] == [("Wheat & corn", "https://x/1")]
    pubs = feeds.publications(entries, sources(spark), now).orderBy("pos").collect()
    assert [r["title"] for r in pubs] == ["Wheat & corn", "Undated crop"]
    bodies = spark.createDataFrame([("m", RSS)], "source string, body string")
    assert feeds.xml_items(bodies).count() >= 3 and feeds.entries_of(bodies).count() == 4


def test_lookback_keeps_the_exact_hour(spark):
    df = spark.createDataFrame([(datetime(2026, 3, 23),), (datetime(2026, 3, 22, 23, 59, 59),)], "t timestamp")
    assert [r[0] for r in df.select(filters.recent(F.col("t"), F.lit(datetime(2026, 3, 25)), F.lit(48))).collect()] == [True, False]


def test_document_tree():
    root = html.parse_html("<ul><li class='a b'>x<li>y<br>z</ul><p>one<p>two <b>three")
    assert [n.text() for n in root.select("li")] == ["x", "y z"]
    assert [n.text() for n in root.select("li.a, p")] == ["x", "one", "two three"]


def page(name):
    d, old = "24/03/2026", "01/01/2020"
    pages = {
        "agreste": f"<h4 class='titreSearch'><a href='/r1'>Blé</a></h4><div class='date'>{d}</div><h4 class='titreSearch'><a href='/r2'>Vieux</a></h4><div class='date'>{old}</div>",
        "bcr": f"<p>{d} <a href='/a.pdf?x'>Informe</a></p><a href='/b.html'>no</a>",
        "caa": f"<div class='card-info'><div class='date'>{d}</div><div class='text'><a href='/d'>CEREALES. Avance</a></div></div><div class='card-info'><div class='date'>{d}</div><div class='text'><a href='/e'>OTROS</a></div></div>",
        "coceral": "<div class='antpar1'><h1>Forecast</h1><div class='par1descr'><strong>24 March 2026</strong></div></div>",
        "conab": f"<div>{d}<a href='/noticias/1'>Safra de grãos deve crescer neste ano</a></div>",
        "destatis": "<div class='c-result'><h3 class='c-result__heading'><a href='/p'>Crops</a></h3><span class='c-result__date'>24 March 2026</span></div>",
        "esmis": "<tr><td>March 24, 2026</td><td><a href='/r.txt'>txt</a><a href='/r.pdf'>Crop Production</a></td></tr>",
        "govua": "<div class='views-row'><div class='node__title'><h2><a href='/n'>Area of crops</a></h2><div class='node__title-info'>24 March 2026</div></div></div>",
        "grainsa": "<a href='/f 24-03-2026.xlsx'>Production report</a>",
        "istat": "<article><time datetime='2026-03-24'></time><a href='/i'>Crop estimates</a></article>",
        "jrc": "<a class='search-entry-title' href='/mars/2026/03/24/b'>JRC MARS Bulletin</a>",
        "ksh": "<table><tr><td class='descr'><div class='pub_title'><a href='/k'>Harvest</a></div><div class='pub_start'><b>2026-03-24</b></div></td></tr></table>",
        "mapa": "<a href='/dam/2026/03-24/avance.pdf'>Avance 24/03/2026</a><a href='/dam/2026/03-24/avance.xlsx'>Avance 24/03/2026</a>",
        "statcan": "<div class='ndm-result-container'><div class='ndm-result-title'><a href='/s'>Field crops</a></div><span class='ndm-result-date'>2026-03-24</span></div>" * 12,
        "tuik": "<table><tr role='row'><td><div class='news-content'><a href='/t'>Bitkisel Üretim İstatistikleri</a></div><span class='float-right'>24 Mart 2026</span></td></tr></table>",
        "uk_defra": "<li class='gem-c-document-list__item'><div class='gem-c-document-list__item-title'><a href='/u'>Agricultural land use in England</a></div><time datetime='2026-03-24'></time></li>",
    }
    return pages[name]


def test_extractors(spark):
    names = [n for n in extractors.RULES if "_" not in n or n == "uk_defra"]
    rows = [(n, "https://h.example/list/", page(n)) for n in names] + [("nobody", "https://h.example/", "")]
    out = extractors.run_extractors(spark.createDataFrame(rows, "source string, url string, html string"), NOW)
    got = {}
    for r in out.collect():
        got.setdefault(r["source"], []).append(r)
    assert {k: len(v) for k, v in got.items()} == {n: 1 for n in [*names, "nobody"]}
    assert all(r[0]["published"] == "2026-03-24" for n, r in got.items() if n != "nobody")
    assert got["esmis"][0]["url"].endswith("/r.pdf") and got["coceral"][0]["url"] == "https://h.example/list/"
    assert extractors.publications(out).count() == len(names)


def test_statistics(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", '"Market_Year","Commodity_Code","Value","Month","Country_Code","Attribute_Description"\n2024,1,5.5,3,FR,"Area, sown"\n2023,1,,2,FR,Production\n')
    got = sorted(statistics.zipped_csv(spark, str(tmp_path / "a.zip")).collect(), key=lambda r: r["Market_Year"])
    assert [(r["Market_Year"], r["Value"], r["Attribute_Description"]) for r in got] == [(2023, None, "Production"), (2024, 5.5, "Area, sown")]
    row = lambda v, y, c, n: f'{{"D2C":"{v}","D3C":"{y}","D4N":"{c}","V":"{n}"}}'
    body = "[" + ",".join([row("h", "h", "h", "h"), row("215", "2024", "Soy", "153,200,000"), row("216", "2024", "Soy", "46100000"), row("215", "2024", "Corn", "1000"), row("215", "2024", "Rye", "-")]) + "]"
    rows = statistics.json_table(spark.createDataFrame([(body,)], "body string"))
    assert statistics.first_year(rows).first()["year"] == 2024
    assert statistics.headline(rows, F.lit(2024)).first()["summary"] == "Soy: 46.1M ha planted, 153.2M t produced | Corn: 1K t produced"


def test_configuration(spark, tmp_path):
    pages = iter([{"results": [1], "has_more": True, "next_cursor": "c"}, {"results": [2], "has_more": False}])
    assert config.read_pages(lambda cursor: next(pages)) == [1, 2]
    page_json = '{"properties":{"Name":{"type":"title","title":[{"plain_text":"S"}]},"Source Category":{"type":"select","select":{"name":"Strange"}},"Enabled":{"type":"checkbox","checkbox":true},"Keywords Filter":{"type":"multi_select","multi_select":[{"name":"a"},{"name":"b"}]},"Lookback Hours":{"type":"number","number":72}}}'
    row = config.source_rows(spark.createDataFrame([(page_json,)], "json string")).first()
    assert (row["name"], row["category"], row["enabled"], row["keywords_filter"], row["lookback_hours"], row["max_silent_days"]) == ("S", "media", True, ["a", "b"], 72, 0)
    path = str(tmp_path / "c.yaml")
    config.write_snapshot(config.from_dicts(spark, {"companies": [{"name": "A", "enabled": True, "company_type": "client"}]}), path)
    assert config.by_type(config.read_snapshot(spark, path)["companies"], "client").count() == 1


def test_dates(spark):
    cases = ["24/03/2026", "24-03-2026", "2026-03-24", "24 March 2026", "24 Mar 2026", "March 24, 2026", "Mar 24, 2026", "24.03.2026", "2026-03-24T10:00:00", "Tue, 24 Mar 2026 10:00:00 +0000"]
    df = spark.createDataFrame([(c,) for c in [*cases, "soon", None]], "t string")
    got = [r[0] for r in df.select(dates.parse_flexible_date(F.col("t")).cast("date").cast("string")).collect()]
    assert got == ["2026-03-24"] * len(cases) + [None, None]
    written = spark.createDataFrame([("le 24 mars 2026",), ("24 Mart 2026",), ("enero de 2026",), ("May 5, 2026 x",)], "t string")
    assert [r[0] for r in written.select(dates.parse_written_date(F.col("t")).cast("date").cast("string")).collect()] == ["2026-03-24", "2026-03-24", "2026-01-01", "2026-05-05"]
    mention = spark.createDataFrame([("enero 2025, marzo de 2026, febrero 2026",), ("none",)], "t string")
    assert [str(r[0]) for r in mention.select(dates.latest_month_mention(F.col("t"))).collect()] == ["2026-03-01", "None"]


def test_text(spark):
    df = spark.createDataFrame([("one  two three-, four", "T - a - B", "caf&eacute; ")], "a string, b string, c string")
    r = df.select(text.clip_text(F.col("a"), 15), text.title_part(F.col("b")), text.source_part(F.col("b")), text.unescape_html(F.col("c")), text.subject_hook(F.lit("First one. Second."), F.lit("x"))).first()
    assert list(r) == ["one two…", "T - a", "B", "café", "First one"]
    u = df.select(urls.search_url(F.lit("a b&c")), urls.resolve(F.lit("../z"), F.lit("https://h/x/y/")), urls.title_from_url(F.lit("https://h/corn-report_2.pdf"))).first()
    assert u[0].endswith("?q=a+b%26c&hl=en") and u[1] == "https://h/x/z" and u[2] == "Corn Report 2"


def test_classifier_boundary(spark):
    rows = classify.chunks(spark.range(12).select(F.col("id").alias("seq"), F.lit("t").alias("title")), 5)
    assert rows.groupBy("chunk_id").count().agg(F.max("count")).first()[0] == 5

    def service(items):
        if any(i["seq"] == 3 for i in items):
            raise RuntimeError("refused")
        return [{"item_index": i["item_index"], "ok": True} for i in items]

    out = classify.call_in_batches(rows, service, "chunk_id string, item_index int, ok boolean", retries=1)
    assert out.count() == 7
    raw = spark.createDataFrame([("r1", None), ("r2", "err")], "custom_id string, error string")
    assert [r[0] for r in classify.retry_set(spark.createDataFrame([("r1",), ("r2",), ("r3",)], "custom_id string"), raw).orderBy("custom_id").collect()] == ["r2", "r3"]


def test_sinks(spark):
    stories = spark.createDataFrame([("<b>T</b>", "javascript:x", "S", 2)], "title string, url string, source_name string, size long")
    out = render.render_digest(title="D", takeaway="a < b", stories=stories)
    assert "&lt;b&gt;T" in out and "javascript" not in out and "Account radar" not in out and len(out) < render.MAX_BYTES
    assert out.index("a &lt; b") < out.index("Top stories")
    posted = archive.post_rows(spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "id string"), lambda r: {"a": 409, "b": 200, "c": 500}[r["id"]]).first()
    assert (posted["ok"], posted["failed"]) == (2, 1)
    assert report.report_subject(["QUIET", "DEAD"]) == "1 DEAD" and report.report_subject([]) == "OK" and report.should_send(True) and not report.should_send(False)


def daily_inputs(spark, sf_dir):
    articles = adapters.articles(spark, sf_dir).withColumn("id", F.concat(F.lit("d"), F.col("seq").cast("string"))).withColumn("summary", F.lit("Wheat rose 45 percent."))
    articles = articles.withColumn("place_name", F.when(F.col("seq") % 2 == 0, "paris").otherwise("nowhere")).withColumn("country_iso", F.lit("FR"))
    days = F.to_timestamp(F.lit("2024-01-30"))
    publications = spark.createDataFrame([(f"p{i}", f"Bulletin {i} &amp; more", f"https://x.example/{i}", "Office", "France", i % 2 == 0) for i in range(6)], "id string, title string, url string, source_name string, country string, relevant boolean")
    publications = publications.withColumn("classified", F.lit(True)).withColumn("published_at", days).withColumn("summary", F.lit(""))
    signals = adapters.signals(spark, sf_dir).withColumn("id", F.concat(F.lit("s"), F.col("seq").cast("string")))
    sources = spark.createDataFrame([("dead", "u", "media", "rss", "", True, [], "", 0, 0), ("fine", "u", "official", "rss", "", True, [], "", 0, 0), ("off", "u", "media", "rss", "", False, [], "", 0, 0)], schemas.SOURCE)
    runs = spark.createDataFrame([(datetime(2024, 1, d), s, p, r) for d in (28, 29, 30) for s, p, r in (("dead", 0, 0), ("fine", 3, 9), ("off", 0, 0))], "run_ts timestamp, source string, passed int, raw int")
    counts = spark.createDataFrame([("dead", 0, 0), ("fine", 0, 4)], "source string, passed int, raw int")
    matrix = spark.createDataFrame([("NATION_1", "wheat", 5000.0, 12.5, 1), ("NATION_2", "wheat", 10.0, 90.0, 2)], "name string, crop string, value double, yoy_pct double, pos int")
    return daily.Inputs(articles, publications, signals, adapters.companies(spark, sf_dir), sources, adapters.seen_store(spark, sf_dir), runs, counts, matrix, new_release=True)


def test_daily_run(spark, sf_dir):
    """The whole run: known rows go, everything accepted is archived, the digest has its sections in order, state moves on."""
    inputs, asked, sent = daily_inputs(spark, sf_dir), [], []
    places = (spark.createDataFrame([("Paris", 48.9, 2.3)], "place_name string, latitude double, longitude double"), spark.createDataFrame([("FR", 46.0, 2.0)], "iso string, lat double, lon double"))

    def brief(source, issues):
        asked.append(source)
        return {"takeaway": "Wheat rose 45 percent. More is known.", "sections": [{"label": "Grain", "text": "Robust demand."}]}

    services = daily.Services(judge=lambda df, kind: df, brief=brief, post=lambda row: 200, send=lambda subject, html: sent.append(subject) or True)
    run = daily.run_daily(inputs, services, now=datetime(2024, 1, 31), cache=places[0], centroids=places[1], marker=lambda: not sent)
    c = {r["stream"]: r for r in run.counters.collect()}
    assert c["article"]["fetched"] == 1000 and c["article"]["duplicate"] == 200 and c["publication"]["accepted"] == 3 and c["publication"]["rejected"] == 3
    assert all(r["fetched"] == r["duplicate"] + r["unclassified"] + r["rejected"] + r["accepted"] for r in c.values())
    order = [run.html.index(x) for x in ("Wheat rose 45 percent", "Strong demand", "Top stories", "Account radar", "Movers", "Publications", "Bulletin 0 &amp; more")]
    assert order == sorted(order) and "NATION_2" not in run.html and "Robust" not in run.html
    assert len(asked) == 1 and run.brief_status == "included (1 sections)" and "- Bulletin 0 & more" in asked[0]
    assert run.subject == "Digest 31 Jan: Wheat rose 45 percent" and sent == [run.subject] and run.sent
    n_articles = c["article"]["accepted"]
    assert run.archived["articles"] == (n_articles, 0) and run.archived["publications"] == (3, 0) and run.archived["signals"][0] == run.signals.count()
    assert {r["resolved_by"] for r in run.articles.select("resolved_by").distinct().collect()} == {"cache", "centroid"}
    assert {(r["source"], r["status"], r["streak"]) for r in run.health.collect()} == {("dead", "DEAD", 4)}
    assert run.seen.where("id like 'p%'").count() == 6 and "1 DEAD" in run.report and "archived publications" in run.report
    run.close()


def test_daily_run_that_only_looks(spark, sf_dir):
    """A dry run leaves everything as it is; a brief that fails is an entry in the report."""
    inputs, posted = daily_inputs(spark, sf_dir), []

    def breaks(source, issues):
        raise RuntimeError("no brief today")

    run = daily.run_daily(inputs, daily.Services(judge=lambda df, kind: df, brief=breaks, post=posted.append, send=posted.append), now=datetime(2024, 1, 31), dry_run=True)
    assert not posted and not run.sent and not run.archived and run.seen is inputs.seen
    assert run.brief is None and run.brief_status == "omitted (error: RuntimeError)" and "no brief today" in run.report
    assert {(r["source"], r["streak"]) for r in run.health.collect()} == {("dead", 3)}
    run.close()


def test_counters_take_no_job(spark):
    """They come with the one job that writes a stream, also where the judge uses its rows twice; ids that the store holds twice, doubles and null ids count as they are."""
    rows = [("a", "t &amp; u"), ("a", "x"), ("b", "x"), (None, "x"), ("c", "x"), ("d", "x")]
    batch = spark.createDataFrame(rows, "id string, title string")
    seen = spark.createDataFrame([("b", 1), ("b", 2), (None, 3), ("z", 4)], "id string, seen_at int")

    def judge(df, kind):
        assert kind == "k"
        told = df.where("id is not null").groupBy("id").agg((F.col("id") == "c").alias("relevant"))
        return df.join(told, "id", "left").withColumn("classified", F.coalesce(F.col("id") != "d", F.lit(True)))

    found = daily.judged(batch, seen, judge, "k", F.col("relevant"))
    spark.sparkContext.setJobGroup("counters", "none")
    counters = daily.counter_rows(spark, {"k": found, "again": found})
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("counters")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [tuple(r) for r in counters.collect()] == [(k, 6, 1, 1, 3, 1) for k in ("k", "again")]
    assert sorted((r["id"] or "-", r["title"]) for r in found.rows.collect()) == [("-", "x"), ("a", "t & u"), ("a", "x"), ("c", "x"), ("d", "x")]
    empty = daily.judged(batch.limit(0), seen, judge, "k", F.col("relevant"))
    assert [tuple(r)[1:] for r in daily.counter_rows(spark, {"k": empty}).collect()] == [(0,) * 5] and empty.rows.count() == 0


def test_streams(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1, 0, i % 50), i % 3, "a" if i % 2 else "b", float(i), "{}") for i in range(100)]
    df = spark.createDataFrame(rows, events.EVENTS)
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = events.first_within(events.read_events(spark, str(tmp_path / "in")), ["user_id"], "1 day")
    q = events.write_once(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert events.tumbling(df, "10 minutes").agg(F.sum("n")).first()[0] == 100
    assert events.sessions(df, "5 minutes").agg(F.sum("n")).first()[0] == 100
    assert events.sliding(df, "10 minutes", "5 minutes").agg(F.sum("n")).first()[0] == 200


def test_health_stream(spark, tmp_path):
    log = [(datetime(2026, 1, 1 + d), s, p, r) for d, (s, p, r) in enumerate([("a", 1, 0), ("a", 0, None), ("a", 0, 0), ("b", 0, None)])]
    schema = "run_ts timestamp, source string, passed int, raw int"
    spark.createDataFrame(log, schema).coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = events.health_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "log")))
    events.write_once(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "update").awaitTermination(120)
    got = {r["source"]: (r["streak"], r["fetch_streak"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": (2, 2), "b": (1, None)}
