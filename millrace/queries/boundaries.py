"""State tables, sinks, classifier calls and the brief, over stand-ins for what lies outside."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify, geo, grounding, matrix, state
from ..plans import adapters as A
from ..sinks import archive, render, report
from .registry import query

# --- state


@query("state_versions", "SELECT n_name AS id, n_nationkey + 100 AS v, 2 AS held FROM nation WHERE n_nationkey < 20")
def state_versions(spark, sf_dir):
    """Four versions written, one of them twice, two kept, the newest read; a state that isn't there is empty."""
    path, rows = A.scratch(spark, "state"), A.table(spark, sf_dir, "nation").select(F.col("n_name").alias("id"), F.col("n_nationkey").alias("v"))
    schema = "id string, v int"
    first = state.read_state(spark, path, schema).unionByName(rows)
    for hour in ("08", "09", "10"):
        state.write_state(first, path, f"2024-01-30T{hour}", keep=2)
    state.write_state(rows.where("v < 5"), path, "2024-01-31T10", keep=2)
    state.write_state(rows.where("v < 20").withColumn("v", F.col("v") + 100), path, "2024-01-31T10", keep=2)
    return state.read_state(spark, path, schema).withColumn("held", F.lit(len(state.versions(spark, path))))


@query("sent_markers", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS runs, 1 AS first FROM events WHERE event_type = 'purchase' OR event_id % 500 = 0 GROUP BY 1")
def sent_markers(spark, sf_dir):
    """Every day of the events is asked for once by each of its runs; one of them is the first. A day holds a few runs, and the driver asks, as a run does."""
    path, asked = A.scratch(spark, "sent"), []
    runs = A.table(spark, sf_dir, "events").where("event_type = 'purchase' OR event_id % 500 = 0").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("runs"))
    for r in runs.collect():  # one row a day
        asked.append((r["day"], r["runs"], sum(state.sent_marker(spark, path, r["day"]) for _ in range(min(3, r["runs"])))))
    return spark.createDataFrame(asked, "day string, runs long, first int")


@query("cache_upsert", "SELECT n_name AS place_name, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey + 0.5 ELSE n_nationkey END AS latitude FROM nation UNION ALL SELECT r_name, -1 FROM region")
def cache_upsert(spark, sf_dir):
    """Places by the newest answer, new ones added."""
    n = A.table(spark, sf_dir, "nation")
    held = n.select(F.col("n_name").alias("place_name"), F.col("n_nationkey").cast("double").alias("latitude"), F.lit(1).alias("at"))
    new = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("place_name"), (F.col("n_nationkey") + 0.5).cast("double").alias("latitude"), F.lit(2).alias("at"))
    late = n.where("n_nationkey % 2 = 1").select(F.col("n_name").alias("place_name"), F.lit(99.0).alias("latitude"), F.lit(0).alias("at"))
    more = A.table(spark, sf_dir, "region").select(F.col("r_name").alias("place_name"), F.lit(-1.0).alias("latitude"), F.lit(1).alias("at"))
    return state.upsert(held, new.unionByName(late).unionByName(more), "place_name", "at").select("place_name", "latitude")


def _ask(place: str) -> tuple[float, float] | None:
    key = int(place.rsplit("_", 1)[-1])
    if key % 5 == 0:
        raise TimeoutError(place)
    return None if key % 3 == 0 else (key + 0.25, -1.0)


@query("asked_places", "SELECT lower(n_name) AS place_name, CASE WHEN n_nationkey % 5 <> 0 AND n_nationkey % 3 <> 0 THEN n_nationkey + 0.25 ELSE 50 END AS latitude, CASE WHEN n_nationkey % 5 <> 0 AND n_nationkey % 3 <> 0 THEN 'api' ELSE 'centroid' END AS resolved_by FROM nation WHERE n_nationkey % 2 = 1")
def asked_places(spark, sf_dir):
    """Places that no cache has are asked of a service that answers, doesn't know or fails; the rest goes to the country's middle."""
    n = A.table(spark, sf_dir, "nation")
    rows = n.where("n_nationkey % 2 = 1").select(F.lower("n_name").alias("place_name"), F.lit("xx").alias("country_iso"))
    cache = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("place_name"), F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"))
    centroids = spark.range(1).select(F.lit("XX").alias("iso"), F.lit(50.0).alias("lat"), F.lit(5.0).alias("lon"))
    answers = geo.ask_places(geo.places_to_ask(rows, cache), _ask, delay=0.0)
    return geo.resolve_places(rows, cache, centroids, answers).select("place_name", "latitude", "resolved_by")


# --- sinks


def _post(row: dict) -> int:
    key = int(row["id"])
    if key % 11 == 0:
        raise ConnectionError
    return [200, 201, 409, 500][key % 4]


@query("posted_rows", "SELECT count_if(c_custkey % 11 <> 0 AND c_custkey % 4 <> 3) AS ok, count_if(c_custkey % 11 = 0 OR c_custkey % 4 = 3) AS failed FROM customer")
def posted_rows(spark, sf_dir):
    """Each id once, though rows come twice; known rows count as posted."""
    rows = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    return archive.post_rows(rows.unionByName(rows), _post)


@query("merged_archive", "SELECT n_name AS id, CASE WHEN n_nationkey < 10 THEN 'new' ELSE 'old' END AS v FROM nation WHERE n_nationkey <> 3 UNION ALL SELECT 'NATION_3', 'new'")
def merged_archive(spark, sf_dir):
    n = A.table(spark, sf_dir, "nation")
    held = n.where("n_nationkey <> 3").select(F.col("n_name").alias("id"), F.lit("old").alias("v"))
    new = n.where("n_nationkey < 10").select(F.col("n_name").alias("id"), F.lit("new").alias("v"))
    return archive.merge_by_id(held, new.unionByName(new))


_SIGNALS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in archive.SIGNAL_LABELS.items())


@query("archived_signals", f"SELECT c_custkey AS id, CASE (['market', 'agtech', 'executive', 'unheard of'])[c_custkey % 4 + 1] {_SIGNALS} ELSE 'Other' END AS signal_type, 'Other' AS company_type, repeat('x', 200) AS title, '' AS summary FROM customer")
def archived_signals(spark, sf_dir):
    kind = F.element_at(F.array(F.lit("market"), F.lit("agtech"), F.lit("executive"), F.lit("unheard of")), (F.col("c_custkey") % 4 + 1).cast("int"))
    rows = A.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.lit("x" * 300).alias("title"), F.lit("u").alias("url"), F.col("c_name").alias("company_name"), F.lit("client").alias("company_type"), kind.alias("signal_type"),
        F.lit(None).cast("string").alias("summary"), F.current_timestamp().alias("published_at"),
    )
    return archive.archive_signals(rows).select("id", "signal_type", "company_type", "title", "summary")


@query("archived_publications", "SELECT n_name AS title, 'R' || n_regionkey AS country, repeat('y', 2000) AS summary, '2024-01-30' AS day FROM nation")
def archived_publications(spark, sf_dir):
    rows = A.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("title"), F.lit("u").alias("url"), F.lit("s").alias("source_name"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country"),
        F.lit("y" * 2500).alias("summary"), F.to_timestamp(F.lit("2024-01-30 10:00:00")).alias("published_at"),
    )
    return archive.archive_publications(rows).select("title", "country", "summary", "day")


_HEAD = "<!DOCTYPE html><html><head><meta charset=''utf-8''><title>D &amp; d</title></head><body><h1>D &amp; d</h1>"


@query(
    "digest_html",
    f"SELECT '{_HEAD}<p><strong>Up &lt; down</strong></p><h3>Grain</h3><p>Text</p><section><h2>Top stories</h2><ul>' || (SELECT string_agg('<li><a href=\"https://x.example/' || r_regionkey || '\">' || r_name || ' &lt;b&gt;</a> <small>S' || CASE WHEN r_regionkey > 0 THEN ', ' || (r_regionkey + 1) || ' sources' ELSE '' END || '</small></li>', '' ORDER BY r_regionkey) FROM region) || '</ul></section><section><h2>Publications</h2><ul><li><a href=\"#\">P</a></li></ul></section></body></html>' AS html",
)
def digest_html(spark, sf_dir):
    """Brief, stories and publications, all values escaped, empty blocks and unsafe links left out."""
    stories = A.table(spark, sf_dir, "region").orderBy("r_regionkey").select(
        F.concat("r_name", F.lit(" <b>")).alias("title"), F.concat(F.lit("https://x.example/"), F.col("r_regionkey").cast("string")).alias("url"), F.lit("S").alias("source_name"), (F.col("r_regionkey") + 1).alias("size")
    )
    published = spark.range(1).select(F.lit("P").alias("title"), F.lit("javascript:x").alias("url"))
    page = render.render_with_fallback(title="D & d", takeaway="Up < down", sections=[("Grain", "Text")], stories=stories, publications=published, radar=stories.limit(0))
    return spark.createDataFrame([(page,)], "html string")


@query("digest_fallback", "SELECT '<html><body><section><h2>Top stories</h2><ul>' || (SELECT string_agg('<li><a href=\"#\">' || r_name || '</a></li>', '' ORDER BY r_regionkey) FROM region) || '</ul></section></body></html>' AS html")
def digest_fallback(spark, sf_dir):
    """Movers without their columns can't be rendered; the stories go out all the same."""
    stories = A.table(spark, sf_dir, "region").orderBy("r_regionkey").select(F.col("r_name").alias("title"), F.lit("").alias("url"))
    page = render.render_with_fallback(title="D", stories=stories, movers=spark.range(1))
    return spark.createDataFrame([(page,)], "html string")


@query(
    "matrix_html",
    "SELECT '<table><tr><th></th><th>c</th></tr>' || string_agg(CASE WHEN band THEN '<tr><th colspan=''2''>R' || n_regionkey || '</th></tr>' ELSE '' END || '<tr><td>' || n_name || '</td><td>' || CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey || ' <small>' || printf('%+.1f', n_nationkey - 10.0) || '%</small>' ELSE '–' END || '</td></tr>', '' ORDER BY n_regionkey, n_nationkey) || '</table>' AS html FROM (SELECT *, n_regionkey IS DISTINCT FROM lag(n_regionkey) OVER (ORDER BY n_regionkey, n_nationkey) AS band FROM nation)",
)
def matrix_html(spark, sf_dir):
    rows = A.table(spark, sf_dir, "nation").orderBy("n_regionkey", "n_nationkey").select(
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("region"), F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey")).alias("c_value"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey") - 10.0).alias("c_yoy_pct"),
    )
    return spark.createDataFrame([(render.render_matrix([r.asDict() for r in rows.collect()], ["c"]),)], "html string")


@query(
    "run_reports",
    "SELECT '<h1>' || subject || '</h1><table><tr><td>fetched</td><td>5</td></tr></table><table><tr><th>source</th><th>status</th></tr>' || (SELECT string_agg('<tr><td>' || n_name || '</td><td>' || CASE n_nationkey % 2 WHEN 0 THEN 'DEAD' ELSE 'QUIET' END || '</td></tr>', '' ORDER BY n_nationkey) FROM nation) || '</table>' AS html, true AS failed, false AS well FROM (SELECT count_if(n_nationkey % 2 = 0) || ' DEAD' AS subject FROM nation)",
)
def run_reports(spark, sf_dir):
    """The worst first; failures are always sent, success only if asked for."""
    rows = A.table(spark, sf_dir, "nation").orderBy("n_nationkey").select(F.col("n_name").alias("source"), F.when(F.col("n_nationkey") % 2 == 0, "DEAD").otherwise("QUIET").alias("status"))
    return spark.createDataFrame([(report.report_html({"fetched": 5}, health=rows), report.should_send(True), report.should_send(False))], "html string, failed boolean, well boolean")


@query("mail_envelopes", "SELECT 'g' || n_regionkey AS who, min(n_nationkey) AS first, count(*) AS bcc FROM nation GROUP BY 1")
def mail_envelopes(spark, sf_dir):
    groups = A.table(spark, sf_dir, "nation").groupBy(F.concat(F.lit("g"), F.col("n_regionkey").cast("string")).alias("primary")).agg(
        F.min("n_nationkey").alias("first"), F.transform(F.slice(F.sort_array(F.collect_list("n_nationkey")), 2, 1000), lambda x: x.cast("string")).alias("cc")
    )
    first = {r["primary"]: r["first"] for r in groups.collect()}
    made = report.mail_envelopes(groups, "s", "h")
    return spark.createDataFrame([(m["to"], first[m["to"]], len(m["bcc"])) for m in made], "who string, first int, bcc long")


# --- the classifier's boundary


@query("retried_requests", "SELECT CAST(c_custkey AS VARCHAR) AS custom_id FROM customer WHERE c_custkey % 3 <> 0")
def retried_requests(spark, sf_dir):
    """Every third request had a good answer, every third an error, the rest none."""
    requests = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("custom_id"))
    results = A.table(spark, sf_dir, "customer").where("c_custkey % 3 < 2").select(F.col("c_custkey").cast("string").alias("custom_id"), F.when(F.col("c_custkey") % 3 == 1, "overloaded").alias("error"))
    return classify.retry_set(requests, results)


def _service(items: list[dict]) -> list[dict]:
    """Refuses chunks that begin with a multiple of seven, every time."""
    if items[0]["seq"] % 7 == 0:
        raise RuntimeError("refused")
    return [{"item_index": i["item_index"], "seq": i["seq"], "said": "first"} for i in items]


def _other_service(items: list[dict]) -> list[dict]:
    if items[0]["seq"] % 14 == 0:
        raise RuntimeError("refused too")
    return [{"item_index": i["item_index"], "seq": i["seq"], "said": "second"} for i in items]


@query("called_chunks", "WITH n AS (SELECT s_suppkey AS seq, s_suppkey // 5 * 5 AS lead FROM supplier) SELECT seq, CASE WHEN lead % 7 <> 0 THEN 'first' ELSE 'second' END AS said FROM n WHERE lead % 14 <> 0")
def called_chunks(spark, sf_dir):
    """Chunks of five; what the first service refuses goes to the second, what both refuse gives no rows."""
    rows = classify.chunks(A.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("seq")), 5)
    return classify.call_in_batches(rows, _service, "chunk_id string, item_index int, seq long, said string", retries=1, fallback=_other_service).select("seq", "said")


class _Bulk:
    """A batch service that ends at the second look, answers most requests, and one that nobody asked."""

    def __init__(self, patience: int):
        self.looks, self.patience, self.cancelled = 0, patience, False

    def submit(self, requests: list[dict]) -> str:
        self.requests = requests
        return "b1"

    def ended(self, batch: str) -> bool:
        self.looks += 1
        return self.looks > self.patience

    def results(self, batch: str) -> list[dict]:
        keys = [int(r["custom_id"]) for r in self.requests]
        return [{"custom_id": str(k), "json": f"[{k}]", "error": "errored" if k % 5 == 1 else None} for k in keys if k % 5 != 2] + [{"custom_id": "-1", "json": "[]"}]

    def cancel(self, batch: str) -> None:
        self.cancelled = True


@query(
    "bulk_requests",
    "SELECT 'in time' AS run, CAST(s_suppkey AS VARCHAR) AS custom_id, CASE WHEN s_suppkey % 5 IN (1, 2) THEN 'left' ELSE '[' || s_suppkey || ']' END AS outcome FROM supplier UNION ALL SELECT 'too late', CAST(s_suppkey AS VARCHAR), 'left' FROM supplier",
)
def bulk_requests(spark, sf_dir):
    """All requests in one batch: answered, in error, unanswered; and a batch that doesn't end in time, which is cancelled."""
    requests = A.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("custom_id"), F.lit("{}").alias("json"))
    out = None
    for run, patience in (("in time", 1), ("too late", 10**6)):
        ticks = iter(range(10**6))
        done, left = classify.call_in_bulk(requests, _Bulk(patience), timeout_seconds=5, clock=lambda ticks=ticks: next(ticks), wait=lambda s: None)
        part = done.select(F.lit(run).alias("run"), "custom_id", F.col("json").alias("outcome")).unionByName(left.select(F.lit(run).alias("run"), "custom_id", F.lit("left").alias("outcome")))
        out = part if out is None else out.unionByName(part)
    return out


def _upper(titles: list[str]) -> list[str]:
    return [t.upper() for t in titles]


def _fails(titles: list[str]) -> list[str]:
    raise ConnectionError


@query("translated_titles", f"WITH {A.ARTICLES} SELECT seq, CASE WHEN original_language <> 'en' THEN upper(title) ELSE title END AS title, title AS kept FROM (SELECT seq, original_language, 't' || seq AS title FROM articles)")
def translated_titles(spark, sf_dir):
    """Titles that aren't English are translated; where that fails they stay."""
    rows = A.articles(spark, sf_dir).select("seq", "original_language", F.concat(F.lit("t"), F.col("seq").cast("string")).alias("title"))
    kept = classify.translate_titles(rows, _fails).select("seq", F.col("title").alias("kept"))
    return classify.translate_titles(rows, _upper).select("seq", "title").join(kept, "seq")


@query("either_tier", "SELECT 'first' AS tier, r_name AS name FROM region UNION ALL SELECT 'second', n_name FROM nation")
def either_tier(spark, sf_dir):
    """The second tier is asked only where the first has no rows."""
    first = A.table(spark, sf_dir, "region").select(F.lit("first").alias("tier"), F.col("r_name").alias("name"))
    second = A.table(spark, sf_dir, "nation").select(F.lit("second").alias("tier"), F.col("n_name").alias("name"))

    def never():
        raise AssertionError("the first tier has rows")

    return classify.either(first, never).unionByName(classify.either(first.limit(0), lambda: second))


@query("parsed_briefs", "SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'Up.' WHEN 1 THEN '' END AS takeaway, CASE n_nationkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 END AS sections FROM nation WHERE n_nationkey % 4 < 2")
def parsed_briefs(spark, sf_dir):
    """Answers with both, with sections alone, without content, and broken ones."""
    given = F.element_at(F.array(
        F.lit('{"takeaway": " Up. ", "sections": [{"label": "a", "text": " t "}, {"label": "", "text": "x"}]}'), F.lit('{"sections": [{"label": "a", "text": "t"}]}'), F.lit('{"takeaway": " ", "sections": []}'), F.lit("[broken")
    ), (F.col("n_nationkey") % 4 + 1).cast("int"))
    rows = A.table(spark, sf_dir, "nation").select("n_nationkey", classify.parse_sections(given).alias("b")).where("b is not null")
    return rows.select("n_nationkey", "b.takeaway", F.size("b.sections").alias("sections"))


@query(
    "brief_loop",
    "SELECT * FROM (VALUES ('at once', 1, 'included (1 sections)', 'Wheat rose 45 percent.', 'We use, much.'), ('asked again', 2, 'included (1 sections)', 'Wheat rose 45 percent.', 'We use, much.'), ('salvaged', 3, 'included (salvaged, 1 sections)', 'We use, much.', 'We use, much.'), ('hopeless', 3, 'omitted (99)', NULL, NULL), ('empty', 1, 'omitted (generation empty)', NULL, NULL)) v(run, calls, status, takeaway, first)",
)
def brief_loop(spark, sf_dir):
    """A draft that is right, one that is mended when asked again, one that loses a sentence, one that loses all, and none."""
    out = []
    for run in ("at once", "asked again", "salvaged", "hopeless", "empty"):
        calls: list[list[str]] = []

        def draft(source, issues, run=run, calls=calls):
            calls.append(issues)
            if run == "empty":
                return {}
            right = run == "at once" or (run == "asked again" and issues)
            text = "We leverage — much." if run != "hopeless" else "Only 99 left."
            return {"takeaway": "Wheat rose 45 percent." if right else "Wheat rose 99 percent.", "sections": [{"label": "a", "text": text}]}

        brief, status = grounding.generate_brief(spark, draft, "- Wheat: it rose 45 percent")
        out.append((run, len(calls), status, (brief or {}).get("takeaway"), brief["sections"][0][1] if brief else None))
    return spark.createDataFrame(out, "run string, calls int, status string, takeaway string, first string")


# --- matrices


@query(
    "all_matrices",
    f"""WITH f AS (SELECT 'production' AS metric, n_name AS name, p_type AS crop, year(l_shipdate) AS y, month(l_shipdate) AS m, sum(l_quantity) AS v FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
two AS (SELECT * FROM f UNION ALL SELECT 'area', name, crop, y, m, v * 2 FROM f WHERE name <> 'NATION_1'), l AS (SELECT metric, name, crop, y, arg_max(v, m) AS v FROM two GROUP BY ALL), {A.COUNTRIES},
crops AS (SELECT DISTINCT p_type AS crop, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'cereals' ELSE 'oilseeds' END AS family FROM part), cuts AS (SELECT crop, 'all' AS cut FROM crops UNION ALL SELECT crop, family FROM crops),
grid AS (SELECT metric || '_' || cut AS matrix, metric, c.name, crop FROM countries c, cuts, (VALUES ('area'), ('production')) m(metric)),
filled AS (SELECT g.*, n.v AS value, CASE WHEN n.v IS NOT NULL AND b.v > 0 THEN round((n.v - b.v) / b.v * 100, 1) END AS yoy_pct FROM grid g LEFT JOIN l n ON n.metric = g.metric AND n.name = g.name AND n.crop = g.crop AND n.y = 1997 LEFT JOIN l b ON b.metric = g.metric AND b.name = g.name AND b.crop = g.crop AND b.y = 1996)
SELECT matrix, name, crop, value, yoy_pct FROM filled f WHERE EXISTS (SELECT 1 FROM filled x WHERE x.matrix = f.matrix AND x.name = f.name AND x.value IS NOT NULL)""",
)
def all_matrices(spark, sf_dir):
    """Both metrics, whole and by two families of crops: six matrices in one pass."""
    facts = A.facts(spark, sf_dir)
    both = facts.withColumn("metric", F.lit("production")).unionByName(facts.where("Country <> 'NATION_1'").withColumn("Value", F.col("Value") * 2).withColumn("metric", F.lit("area")))
    latest = matrix.latest_revision(both, ["metric", "Country", "Commodity", "Market_Year"])
    crops = A.crops(spark, sf_dir).withColumn("pos", F.col("crop")).withColumn("family", F.when(F.col("crop").isin("ECONOMY", "PROMO"), "cereals").otherwise("oilseeds"))
    return matrix.matrices(latest, A.countries(spark, sf_dir), crops, 1997).select("matrix", "name", "crop", "value", "yoy_pct")
