"""The daily run: scan, deduplicate, judge, place, brief, select, render, archive, remember, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import preheader, subject_hook, unescape_html
from ..operators import filters, geo, grounding, grouping, health, ranking, state
from ..sinks import archive, render, report
from .adapters import scratch

Judge = Callable[[DataFrame, str], DataFrame]


@dataclass
class Inputs:
    """What the scans gave. Articles, publications and signals need id; ``runs`` is the health log so far (run_ts, source, passed, raw)."""

    articles: DataFrame
    publications: DataFrame
    signals: DataFrame
    companies: DataFrame
    sources: DataFrame
    seen: DataFrame
    runs: DataFrame | None = None
    counts: DataFrame | None = None
    matrix: DataFrame | None = None
    release_label: str = ""
    new_release: bool = False


@dataclass
class Services:
    """Calls that leave the engine, each optional: what is missing is left out of the digest."""

    judge: Judge
    brief: Callable[[str, list[str]], dict | None] | None = None
    translate: Callable[[DataFrame], DataFrame] | None = None
    geocode: Callable[[DataFrame], DataFrame] | None = None
    post: Callable[[dict], int] | None = None
    send: Callable[[str, str], bool] | None = None


@dataclass
class Daily:
    """What a run gives: planned tables, the digest, and what was done outside."""

    articles: DataFrame
    publications: DataFrame
    signals: DataFrame
    clients: DataFrame
    prospects: DataFrame
    stories: DataFrame
    radar: DataFrame
    more: int
    movers: DataFrame | None
    seen: DataFrame
    counters: DataFrame
    health: DataFrame | None
    brief: dict | None = None
    brief_status: str = "not run"
    subject: str = ""
    html: str = ""
    archived: dict[str, tuple[int, int]] = field(default_factory=dict)
    places: DataFrame | None = None
    sent: bool = False
    report: str = ""
    errors: list[str] = field(default_factory=list)

    def close(self) -> None:
        """Nothing is held: the judged rows lie in the shared folder, for its own clean-up."""


@dataclass
class Judged:
    """A stream's new rows with their verdicts, written down, and its counters, which were observed on the way."""

    rows: DataFrame
    known: Observation
    verdicts: Observation

    def counters(self) -> dict[str, int]:
        return {**self.known.get, **self.verdicts.get}


def judged(rows: DataFrame, seen: DataFrame, judge: Judge, kind: str, relevant: Column) -> Judged:
    """New rows only, entities in titles resolved, with what the expensive judge says.

    One job joins, judges, counts and writes to the shared folder, so nothing is asked or read again for a counter, or when an executor is lost.
    """
    spark, known, verdicts, path = rows.sparkSession, Observation(), Observation(), scratch(rows.sparkSession, f"judged-{kind}")
    marked = state.marked(rows.withColumn("title", unescape_html(F.col("title"))), seen)
    marked = marked.observe(known, F.count("*").alias("fetched"), F.count_if("known").alias("duplicate"))
    said, fits = F.col("classified"), F.coalesce(relevant, F.lit(False))
    found = judge(marked.where(~F.col("known")).drop("known"), kind)
    found = found.observe(verdicts, F.count_if(~said).alias("unclassified"), F.count_if(said & ~fits).alias("rejected"), F.count_if(said & fits).alias("accepted"))
    found.write.parquet(path)
    return Judged(spark.read.schema(found.schema).parquet(path), known, verdicts)


def counter_rows(spark: SparkSession, streams: dict[str, Judged]) -> DataFrame:
    """(stream, fetched, duplicate, unclassified, rejected, accepted): a row for each stream, without a job."""
    names = ("fetched", "duplicate", "unclassified", "rejected", "accepted")
    held = [(kind, *(int(found.counters()[n]) for n in names)) for kind, found in streams.items()]
    return spark.createDataFrame(held, ", ".join(["stream string", *(f"{n} long" for n in names)]))


def run_daily(
    inputs: Inputs, services: Services, *, now: datetime, cache: DataFrame | None = None, centroids: DataFrame | None = None, title: str = "Digest", dry_run: bool = False,
    marker: Callable[[], bool] | None = None,
) -> Daily:
    """A whole run. Everything accepted is archived, the digest carries a selection. A dry run sends, archives and remembers nothing.

    ``services.judge(rows, kind)`` sets classified and relevant (signals: signal_type). A brief, mail or archive that fails is an entry in
    ``errors``, never the end of the run. ``marker`` is True the first time that it's asked on a day; the digest is sent then only.
    """
    spark, at = inputs.articles.sparkSession, F.lit(now)
    done: list[str] = []
    relevant = {"article": F.col("relevant"), "publication": F.col("relevant"), "signal": F.col("signal_type").isNotNull()}
    found = {kind: judged(rows, inputs.seen, services.judge, kind, relevant[kind]) for kind, rows in (("article", inputs.articles), ("publication", inputs.publications), ("signal", inputs.signals))}
    articles, publications, signals = (x.rows for x in found.values())
    accepted = filters.relevant_articles(articles)
    official = filters.relevant_publications(publications)
    heard = ranking.distinct_titles(filters.relevant_signals(signals))
    if services.translate is not None:
        accepted, official, heard = (services.translate(x) for x in (accepted, official, heard))
    places = None
    if cache is not None and centroids is not None:
        placed = [x for x in (accepted, official, heard) if "place_name" in x.columns]
        if placed:
            asked = placed[0].select("place_name")
            for x in placed[1:]:
                asked = asked.unionByName(x.select("place_name"))
            places = geo.places_to_ask(asked, cache)
            answers = services.geocode(places) if services.geocode is not None else None
            accepted, official, heard = (geo.resolve_places(x, cache, centroids, answers) if "place_name" in x.columns else x for x in (accepted, official, heard))
    clients, prospects = filters.split_accounts(heard)
    stories, radar = ranking.top_stories(accepted), ranking.radar(heard, inputs.companies)
    more = ranking.radar_more(heard, inputs.companies).first()["more"]
    movers = ranking.movers(inputs.matrix) if inputs.matrix is not None and inputs.new_release else None

    brief, status = None, "not run"
    if services.brief is not None:
        try:
            brief, status = make_brief(spark, accepted, clients, prospects, official, services.brief)
        except Exception as e:  # noqa: BLE001 - a digest without a brief beats none
            status = f"omitted (error: {type(e).__name__})"
            done.append(f"brief: {e}")

    counters = counter_rows(spark, found)
    seen = inputs.seen
    if not dry_run:
        entries = [state.processed(x, at) for x in (articles, publications, signals)]
        seen = state.upsert_seen(inputs.seen, entries[0].unionByName(entries[1]).unionByName(entries[2]), at)

    flagged = None
    if inputs.runs is not None:
        log = inputs.runs
        if inputs.counts is not None and not dry_run:
            log = log.unionByName(inputs.counts.select(at.cast(log.schema["run_ts"].dataType).alias("run_ts"), "source", "passed", "raw"))
        limits = inputs.sources.where("enabled").select(F.col("name").alias("source"), health.silence_limit(F.col("max_silent_days"), F.col("category")).alias("limit"))
        flagged = health.health_status(health.prune_unknown(health.health(log), limits), limits)

    out = Daily(accepted, official, heard, clients, prospects, stories, radar, more, movers, seen, counters, flagged, brief, status, places=places, errors=done)
    lead = [r["title"] for r in stories.limit(4).collect()]
    words = spark.createDataFrame([((brief or {}).get("takeaway") or "", lead)], "takeaway string, titles array<string>")
    line = words.select(
        subject_hook(F.col("takeaway"), F.coalesce(F.try_element_at("titles", F.lit(1)), F.lit(""))).alias("hook"), preheader(F.col("titles"), skip_first=brief is None).alias("pre")
    ).first()
    out.subject = f"{title} {now:%d %b}: {line['hook']}" if line["hook"] else f"{title} {now:%d %b %Y}"
    shown = radar if "url" in radar.columns else radar.withColumn("url", F.lit(""))
    out.html = render.render_with_fallback(
        title=out.subject, preheader=line["pre"], takeaway=(brief or {}).get("takeaway", ""), sections=(brief or {}).get("sections"), stories=stories, radar=shown, more=more, movers=movers, publications=official
    )
    if not dry_run and services.post is not None:
        for kind, rows in (("articles", _archivable(accepted)), ("publications", archive.archive_publications(official)), ("signals", _archivable_signals(heard))):
            counts = archive.post_rows(rows, services.post).first()
            out.archived[kind] = (counts["ok"] or 0, counts["failed"] or 0)
    if not dry_run and services.send is not None and (marker is None or marker()):
        try:
            out.sent = bool(services.send(out.subject, out.html))
        except Exception as e:  # noqa: BLE001 - reported below
            out.errors.append(f"send: {e}")
    totals = {r["stream"]: f"{r['fetched']} fetched, {r['duplicate']} known, {r['accepted']} accepted, {r['rejected']} rejected, {r['unclassified']} unjudged" for r in counters.collect()}
    out.report = report.report_html({**totals, "brief": status, **{f"archived {k}": f"{a} of {a + b}" for k, (a, b) in out.archived.items()}}, health=flagged, error="; ".join(out.errors))
    return out


def _archivable(rows: DataFrame) -> DataFrame:
    for name, value in (("summary", F.lit("")), ("tags", F.array().cast("array<string>")), ("category", F.lit("other"))):
        rows = rows if name in rows.columns else rows.withColumn(name, value)
    return archive.archive_rows(rows)


def _archivable_signals(rows: DataFrame) -> DataFrame:
    for name in ("summary", "url"):
        rows = rows if name in rows.columns else rows.withColumn(name, F.lit(""))
    return archive.archive_signals(rows)


def make_brief(spark: SparkSession, articles: DataFrame, clients: DataFrame, prospects: DataFrame, publications: DataFrame, generate: Callable[[str, list[str]], dict | None]) -> tuple[dict | None, str]:
    """The day's brief out of everything accepted; none without articles."""
    if not articles.limit(1).count():
        return None, "omitted (no articles)"
    parts = None
    for kind, df in (("", articles), ("Client signals", clients), ("Prospect signals", prospects), ("Publications", publications)):
        category = F.col("category") if not kind and "category" in df.columns else F.lit(kind or "Articles")
        summary = F.col("summary") if "summary" in df.columns else F.lit("")
        part = df.select(category.alias("category"), F.monotonically_increasing_id().alias("seq"), "title", summary.alias("summary"))
        parts = part if parts is None else parts.unionByName(part)
    return grounding.generate_brief(spark, generate, grounding.source_text(parts).first()["source_text"])


def streams(articles: DataFrame, publications: DataFrame, signals: DataFrame) -> DataFrame:
    """All three streams with the columns they share."""
    return grouping.union_streams(article=articles, publication=publications, signal=signals)
