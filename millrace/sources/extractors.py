"""Rows (title, url, date, summary) out of agency pages, each described by a rule instead of a program.

A rule names the row selector, where title, link and date are, the title test, the look-back and what happens
to undated rows. One vectorised function runs the rules over a table of pages; the same checks then apply as columns.
"""

from __future__ import annotations

import dataclasses
import functools
import json
import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from types import MappingProxyType
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions.dates import MENTION_YEARS, MONTHS, OTHER_SPELLINGS
from ..functions.text import stable_id
from ..shipping import ship, spread
from .html import Node, parse_html

ROW = "source string, pos int, title string, url string, published string, summary string, raw_rows int"
ROW_TYPE = StructType([StructField(c.split()[0], IntegerType() if c.endswith(" int") else StringType()) for c in ROW.split(", ")])


@dataclass(frozen=True)
class Rule:
    rows: str
    title: str = ""
    link: str = "a[href]"
    date: str = ""
    language: str = "en"
    title_kind: str = ""
    title_values: tuple[str, ...] = ()
    min_title: int = 1
    href: str = ""
    leading: int = 0
    limit: int = 0
    hours: int = 48
    undated: str = "drop"
    ancestors: int = 0
    page_url: bool = False
    unique: str = ""
    skip_href: str = ""
    min_year: int = -1
    named: str = ""
    or_title: bool = False
    prefix: str = ""
    max_text: int = 0
    detail: bool = False
    month_row: str = ""
    other: str = ""
    strip_title: tuple[tuple[str, str], ...] = field(default=())
    zipped: str = ""
    references: tuple[str, ...] | None = None


_GENERIC = "~result|publication|document|entry|item"
_DATED = "~date|data|time|pubdate,time"

# Where each agency's pages hold their rows, the titles that count, and what titles become. ``other`` names the rule for pages on which the first finds no row.
RULES: Mapping[str, Rule] = MappingProxyType({
    "agreste": Rule(rows="h4.titreSearch", language="fr", zipped="~date|info", other="agreste_links"),
    "agreste_links": Rule(rows=_GENERIC, title="a[href]", date="~date|time|info|meta", language="fr", min_title=10),
    "bcr": Rule(rows="a[href]", href=r"\.pdf(\?|$)", hours=24 * 40, language="es", ancestors=1, unique="url", named="Informe GEA %d/%m/%Y", prefix="BCR GEA: ", month_row="BCR GEA: estimaciones nacionales de producción — %s"),
    "caa": Rule(rows="div.card-info", title="div.text", date="div.date", title_kind="prefix", title_values=("CEREALES.",), language="es"),
    "coceral": Rule(rows="div.antpar1", title="h1", date="div.par1descr", leading=10, page_url=True),
    "conab": Rule(rows="a[href]", href=r"/noticias/", min_title=25, title_kind="any", title_values=("safra", "grãos", "soja", "milho", "trigo", "colheita"), ancestors=3, undated="now", hours=168),
    "destatis": Rule(rows="div.c-result", title="h3.c-result__heading", date="span.c-result__date", leading=10, strip_title=((r"(?i)^Date:\s*", ""), (r"(?i)^(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+\d{4}\s*[.\-|]?\s*", ""))),
    "esmis": Rule(rows="tr", hours=168, unique="day", page_url=True, max_text=600, named="%(heading)s — %d %b %Y", other="esmis_blocks"),
    "esmis_blocks": Rule(rows="li,article,div", hours=168, unique="day", page_url=True, max_text=600, leading=400, named="%(heading)s — %d %b %Y"),
    "govua": Rule(rows="div.views-row", title="h2", date="div.node__title-info", leading=10, title_kind="any", title_values=("crops",)),
    "grainsa": Rule(rows="a[href]", href=r"\.(xlsx?|pdf)(\?|$)", min_title=5, ancestors=3, hours=24 * 35),
    "istat": Rule(rows="article", title="a[href]", date=_DATED, title_kind="any", title_values=("agricult", "crop", "cereal", "farm"), hours=72, other="istat_links"),
    "istat_links": Rule(rows="a[href]", href=r"press-release|archivio|comunicato|nota|report|publication", or_title=True, min_title=15, title_kind="any", title_values=("agricult", "crop", "cereal", "farm"), ancestors=1, hours=72),
    "jrc": Rule(rows="a.search-entry-title", title_kind="regex", title_values=(r"MARS Bulletin", r"crop monitoring"), hours=168, detail=True),
    "ksh": Rule(rows="td.descr", title="div.pub_title", date="div.pub_start"),
    "mapa": Rule(rows="a[href]", href=r"/dam/.*\.(pdf|xlsx?|csv)$", skip_href=r"metodolog|glosario|nota[-_]", language="es", min_year=1, unique="report", hours=168, prefix="MAPA: "),
    "statcan": Rule(rows="div.ndm-result-container", title="div.ndm-result-title", date="span.ndm-result-date", title_kind="any", title_values=("crop", "grain", "field", "farm"), unique="url", limit=10),
    "tuik": Rule(rows="tr[role]", title="div.news-content", date="span.float-right", language="tr", title_kind="prefix", title_values=("Bitkisel Üretim", "Bitkisel Uretim", "Crop Production"), strip_title=((r"^Bitkisel Üretim İstatistikleri[ ,.-]*", "Crop production statistics "), (r"^Bitkisel Üretim[ ,.-]*", "Crop production "))),
    "uk_defra": Rule(rows="li.gem-c-document-list__item", title="div.gem-c-document-list__item-title", date="time", title_kind="prefix", title_values=("Agricultural land use",)),
})


def with_rules(base: Mapping[str, Rule] = RULES, **own: Rule) -> dict[str, Rule]:
    """The rules with some added or replaced: a value for ``run_extractors``; the table itself can't be changed."""
    return {**base, **own}


def rules_json(rules: Mapping[str, Rule]) -> str:
    """Rules as text, for ``extract_rows`` in SQL."""
    return json.dumps({name: dataclasses.asdict(rule) for name, rule in rules.items()}, ensure_ascii=False)


def rules_of(text: str) -> dict[str, Rule]:
    """The way back from ``rules_json``; fields that are left out keep their defaults."""
    fixed = lambda v: tuple(tuple(x) if isinstance(x, list) else x for x in v) if isinstance(v, list) else v
    return {name: Rule(**{k: fixed(v) for k, v in fields.items()}) for name, fields in json.loads(text).items()}


_NUMERIC = re.compile(r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})")
_FILE = re.compile(r"\.(pdf|xlsx?|csv|zip|txt|xml)(\?|$)")
_ISO = re.compile(r"(\d{4})[-/](\d{2})[-/](\d{2})")


@functools.lru_cache(64)
def _month_names(language: str) -> tuple[dict[str, int], re.Pattern, re.Pattern]:
    """The months' names in a language and in English, and the patterns of dates that hold them: day first, month first."""
    months = {n: i for lang in dict.fromkeys((language, "en")) for i, n in reversed(list(enumerate(MONTHS[lang] + [x[:3] for x in MONTHS[lang]])))}
    months = {n: i % 12 + 1 for n, i in months.items()}
    names = "|".join(sorted(map(re.escape, months), key=len, reverse=True))
    return months, re.compile(rf"(\d{{1,2}})\.?\s+(?:de\s+)?({names})\.?,?\s+(?:de\s+)?(\d{{4}})"), re.compile(rf"\b({names})\.?\s+(\d{{1,2}}),?\s+(\d{{4}})")


def find_date(text: str, language: str = "en") -> str | None:
    """The first date in a text as ``yyyy-mm-dd``."""
    if m := _ISO.search(text):
        y, mo, d = m.groups()
    elif m := _NUMERIC.search(text):
        d, mo, y = m.groups()
    else:
        months, day_first, month_first = _month_names(language)
        low = text.lower()
        if m := day_first.search(low):
            d, mo, y = m[1], months[m[2]], m[3]
        elif m := month_first.search(low):
            d, mo, y = m[2], months[m[1]], m[3]
        else:
            return None
    try:
        return datetime(int(y), int(mo), int(d), tzinfo=UTC).isoformat()[:10]
    except ValueError:
        return None


def _date_of(rule: Rule, row: Node, href: str) -> str | None:
    node = row
    if rule.date:
        found = row.first(rule.date)
        return find_date(found.attrs.get("datetime", "") + " " + found.text(), rule.language) if found else None
    for _ in range(rule.ancestors + 1):
        if date := find_date(node.text(), rule.language):
            return date
        if node.parent is None:
            break
        node = node.parent
    return find_date(href, rule.language)


def _title_fits(rule: Rule, title: str) -> bool:
    low = title.lower()
    if len(title) < rule.min_title:
        return False
    if rule.title_kind == "prefix":
        return any(low.startswith(v.lower()) for v in rule.title_values)
    if rule.title_kind == "any":
        return any(v in low for v in rule.title_values)
    if rule.title_kind == "regex":
        return any(re.search(v, title, re.IGNORECASE) for v in rule.title_values)
    return True


def _best_link(row: Node) -> Node | None:
    """A PDF before another file before a page."""
    links = [a for a in row.select("a[href]")]
    rank = lambda a: 0 if a.attrs["href"].lower().endswith(".pdf") else 1 if re.search(r"\.(xlsx?|csv|zip|txt)$", a.attrs["href"].lower()) else 2
    return min(links, key=rank, default=None)


def _report_key(href: str, title: str) -> str:
    """Year and month name of a report, so that its formats are one; else its address without the ending."""
    stem = re.sub(r"\.(pdf|xlsx?|csv)$", "", href.lower())
    text = f"{href.rsplit('/', 1)[-1]} {title}".lower()
    month = next((m for m in MONTHS["es"] if m in text), None)
    year = re.search(r"20\d\d", href) or re.search(r"20\d\d", title)
    return f"{year[0]}_{month}" if month and year else stem


def _detail_date(page: str, language: str) -> str | None:
    """The date that a detail page declares: a time, a publication's meta field, or a text classed as a date."""
    root = parse_html(page)
    declared = [n.attrs.get("datetime", "") for n in root.select("time")]
    declared += [n.attrs.get("content", "") for n in root.select("meta") if n.attrs.get("property") == "article:published_time" or n.attrs.get("name") == "publish_date"]
    declared += [n.text() for n in root.select("~date|published|release") if n.tag in ("p", "span", "div")]
    return next((d for d in (find_date(x, language) for x in declared) if d), None)


def _heading(root: Node, url: str) -> str:
    """A page's first heading, or what its address ends in."""
    return next((h.text() for h in root.select("h1")), "") or url.rstrip("/").rsplit("/", 1)[-1].replace("-", " ").title()


def extract(
    name: str, url: str, page: str, now: datetime, fetch: Callable[[str], str | None] | None = None, *, rules: Mapping[str, Rule] | None = None, source: str | None = None
) -> list[tuple]:
    """The rows of one page under the rule ``name``: (source, pos, title, url, date, summary, rows before the checks).

    ``fetch`` gives the pages of rules that look for the date there; without it such rows count as undated.
    """
    rules, source = rules or RULES, source or name
    rule = rules[name]
    root = parse_html(page, rule.references)
    rows = root.select(rule.rows)
    while not rows and rule.other:
        other = rules[rule.other]
        if other.references != rule.references:
            root = parse_html(page, other.references)
        rule, rows = other, root.select(other.rows)
    dates = [d.text() for d in root.select(rule.zipped)] if rule.zipped else []
    raw, out, seen = len(rows), [], set()
    oldest = now - timedelta(hours=rule.hours)
    for pos, row in enumerate(rows[: rule.leading] if rule.leading else rows):
        if rule.max_text and len(row.text()) > rule.max_text:
            continue
        link = row if row.tag == "a" and "href" in row.attrs else _best_link(row)
        href = link.attrs["href"].strip() if link else ""
        if rule.page_url and (not rule.named or not _FILE.search(href.lower())):
            href = url  # the page itself stands for rows without a file
        if rule.named:
            title = row.text() if row.tag == "a" else ""
        else:
            holder = row.first(rule.title) if rule.title else row if row.tag != "tr" or link is None else link
            if holder is None:
                continue
            inner = holder.first("a[href]") if rule.title and holder.first("a[href]") is not None else holder
            title = inner.text()
        if not href or href.startswith("javascript:") or (rule.href and not re.search(rule.href, f"{href} {title}" if rule.or_title else href, re.IGNORECASE)):
            continue
        if rule.skip_href and re.search(rule.skip_href, f"{href} {title}", re.IGNORECASE):
            continue
        if not title and rule.href:
            title = re.sub(r"[-_]+", " ", re.sub(r"\.\w+$", "", href.rsplit("/", 1)[-1])).strip().title()
        fits = _title_fits(rule, title)
        for pattern, new in rule.strip_title:
            title = re.sub(pattern, new, title).strip()
        if not rule.named and not (title and fits):
            continue
        full = urljoin(url, href)
        if rule.zipped:
            date = find_date(dates[pos], rule.language) if pos < len(dates) else None
        elif rule.detail:
            date = find_date(m[0], rule.language) if (m := _ISO.search(href)) else _detail_date((fetch(full) if fetch else None) or "", rule.language)
        else:
            date = _date_of(rule, row, href)
        year = int(m[1]) if rule.min_year >= 0 and (m := re.search(r"/(20[1-3]\d)/", full)) else None
        if date is None and year is not None and year < now.year - rule.min_year:
            continue  # a date of its own decides before a folder's number
        if date is None and year is None:
            if rule.undated != "now":
                continue
            date = now.strftime("%Y-%m-%d")
        day = datetime.fromisoformat(date).replace(tzinfo=UTC) if date else None
        if day and day < oldest:
            continue
        if rule.named and len(title) <= 10:
            title = day.strftime(rule.named.replace("%(heading)s", _heading(root, url).replace("%", "%%")))
        key = full if rule.unique == "url" else date if rule.unique == "day" else _report_key(full, title) if rule.unique == "report" else None
        if key is not None:
            if key in seen:
                continue
            seen.add(key)
        title = title if not rule.prefix or title.startswith(rule.prefix.split(":")[0]) else rule.prefix + title
        out.append((source, pos, title, full, date, title, raw))
        if rule.limit and len(out) >= rule.limit:
            break
    if rule.month_row and (latest := _latest_month(root.text(), rule.language)) and latest >= oldest.replace(day=1, hour=0, minute=0, second=0, microsecond=0):
        title = rule.month_row % f"{MONTHS[rule.language][latest.month - 1]} {latest.year}"
        out.append((source, len(rows), title, url, latest.strftime("%Y-%m-%d"), title, raw))
    return out


def _latest_month(text: str, language: str) -> datetime | None:
    """The latest month that a page names with a year of ``MENTION_YEARS``."""
    names = {m: i for i, m in enumerate(MONTHS[language], 1)} | OTHER_SPELLINGS.get(language, {})
    found = re.findall(rf"\b({'|'.join(names)})\b[\s,]+(?:de\s+)?(\d{{4}})", text.lower())
    able = [datetime(int(y), names[m], 1, tzinfo=UTC) for m, y in found if MENTION_YEARS[0] <= int(y) <= MENTION_YEARS[1]]
    return max(able, default=None)


def run_extractors(pages: DataFrame, now: datetime, fetch: Callable[[str], str | None] | None = None, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """Rows out of ``pages`` (source, url, html). A source without a rule gives one row with a null title, so that it can be counted."""
    ship(pages.sparkSession)
    rules = dict(rules)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ROW.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            for source, url, page in zip(batch["source"], batch["url"], batch["html"], strict=True):
                out += extract(source, url, page, now, fetch, rules=rules) if source in rules else [(source, 0, None, url, None, None, 0)]
            yield pd.DataFrame(out, columns=names)

    return spread(pages.select("source", "url", "html")).mapInPandas(run, ROW)


@dataclass
class ExtractPlan(AnalyzeResult):
    """What ``extract_rows`` knows once its query is planned."""

    now: str = ""
    rules: str | None = None


class ExtractRows:
    """``LATERAL extract_rows(source, url, html, now, rules)``: the rows of one page, as ``run_extractors`` gives them.

    ``now`` is a time in ISO form, ``rules`` the text of ``rules_json`` (left out or null: the built-in rules). Both must be constants: they are read once, when the query is planned.
    """

    def __init__(self, analyzed: ExtractPlan):
        self.now, self.rules = datetime.fromisoformat(analyzed.now).replace(tzinfo=UTC), rules_of(analyzed.rules) if analyzed.rules else RULES

    @staticmethod
    def analyze(source: AnalyzeArgument, url: AnalyzeArgument, html: AnalyzeArgument, now: AnalyzeArgument, rules: AnalyzeArgument | None = None) -> AnalyzeResult:
        for name, given in (("now", now), ("rules", rules)):
            if given is not None and not given.isConstantExpression:
                raise ValueError(f"{name} must be a constant")
        datetime.fromisoformat(now.value)
        if rules is not None and rules.value:
            rules_of(rules.value)
        return ExtractPlan(schema=ROW_TYPE, now=now.value, rules=rules.value if rules is not None else None)

    def eval(self, source: str, url: str, html: str, now: str, rules: str | None = None):
        if source in self.rules:
            yield from extract(source, url, html, self.now, rules=self.rules)
        else:
            yield source, 0, None, url, None, None, 0


def register_sql(spark: SparkSession) -> None:
    """Makes ``extract_rows`` known to SQL."""
    ship(spark)
    spark.udtf.register("extract_rows", udtf(ExtractRows))


def publications(rows: DataFrame, country: Column | None = None) -> DataFrame:
    """Extracted rows as publications: stripped, with id, relevant until judged."""
    return rows.where("title is not null").select(
        stable_id(F.col("url"), F.col("title")).alias("id"), F.trim("title").alias("title"), "url", F.col("source").alias("source_name"),
        (country if country is not None else F.lit("")).alias("country"), F.to_timestamp("published").alias("published_at"), "summary", F.lit(True).alias("relevant"), F.lit(False).alias("classified"),
    )


def raw_counts(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """How many rows each source's pages held before the checks, and how many came through: what source health records."""
    found = rows.where("title is not null").groupBy("source").agg(F.count("*").alias("passed"), F.max("raw_rows").alias("raw"))
    return pages.select("source").distinct().join(found, "source", "left").select("source", F.coalesce("passed", F.lit(0)).alias("passed"), F.coalesce("raw", F.lit(0)).alias("raw"))


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every link of every page, by regular expression within code generation: page_id, pos, href."""
    found = F.regexp_extract_all(html, F.lit(r'<a\s+href="([^"]*)"'), 1)
    return pages.select("page_id", F.posexplode(found).alias("pos", "href"))


def page_head(html: Column) -> tuple[Column, Column]:
    """(title, first heading) of a page."""
    return F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1), F.regexp_extract(html, r"(?s)<h1>(.*?)</h1>", 1)
