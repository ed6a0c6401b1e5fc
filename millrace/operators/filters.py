"""Row filters of the feed scans. ``now`` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import strip
from ..functions.urls import SEARCH_HOST
from ..vocabulary import DEFAULT_KEYWORDS, term_pattern

#: Hours that a source looks back unless its configuration says so.
ARTICLE_HOURS, SEARCH_HOURS, PUBLICATION_HOURS, SIGNAL_DAYS, UNDATED_LIMIT = 48, 336, 168, 7, 25

# Farm-input terms that a press signal may name instead of a crop.
INPUT_TERMS = [
    "crop protection", "pesticide", "herbicide", "fungicide", "insecticide", "fertilizer", "fertiliser", "seed", "seeds", "biotech",
    "biostimulant", "ag tech", "agtech", "agrochemical", "plant science", "precision ag", "digital farming", "agriculture", "agribusiness", "farm", "farming",
]

# Headline patterns of job posts and market-report advertising, and of senior roles.
NOISE_PATTERNS = [
    r"\bhiring\b", r"\bintern(ship)?\b", r"linkedin jobs", r"#hiring",
    r"\bwe'?re hiring\b", r"\bjob (opening|offer)\b", r"\bapply now\b",
    r"request (for )?(a )?sample", r"\bcagr\b", r"market (size|report|research|forecast)",
    r"\b20\d\d\s*[-–]\s*20\d\d\b.*\bmarket\b",
]
SENIOR_ROLE = r"\b(head|director|vp|vice president|chief|cmo|cco|general manager|country manager)\b"


def named(title: Column, link: Column) -> Column:
    """Title and link both hold something but white space."""
    some = lambda c: F.length(strip(F.coalesce(c, F.lit("")))) > 0
    return some(title) & some(link)


def look_back_hours(configured: Column, url: Column, default: int = ARTICLE_HOURS) -> Column:
    """The configured hours; 0 or null means the default, longer for search feeds."""
    return F.coalesce(F.nullif(configured, F.lit(0)), F.when(url.contains(SEARCH_HOST), F.lit(SEARCH_HOURS)).otherwise(F.lit(default)))


def recent(published: Column, now: Column, hours: Column) -> Column:
    """Not older than the hours before ``now``; exactly that old counts."""
    return published >= now - F.make_dt_interval(F.lit(0), hours.cast("int"))


def contains_any(text: Column, words: list[str] | Column) -> Column:
    """Any of the words as a substring, whatever the case. A literal list becomes one factored pattern."""
    if isinstance(words, Column):
        low = F.lower(text)
        return F.coalesce(F.exists(words, lambda w: low.contains(F.lower(w))), F.lit(False))
    return contains_terms(text, [f"*{w}*" for w in words])


def contains_terms(text: Column, terms: list[str]) -> Column:
    """Any of the terms, in the vocabulary's notation (word edges, unless a star opens an end), whatever the case."""
    pattern = term_pattern(terms)
    return F.coalesce(F.lower(text).rlike(pattern), F.lit(False)) if pattern else F.lit(False)


def _default_match(text: Column, words: list[str] | None) -> Column:
    """The built-in vocabulary with its word edges; a list of the caller's own counts by substrings."""
    return contains_terms(text, DEFAULT_KEYWORDS) if words is None else contains_any(text, words)


def article_match(title: Column, content: Column, own_words: Column, default: list[str] | None = None) -> Column:
    """A source's own keywords replace the defaults."""
    text = F.concat_ws(" ", title, content)
    return F.when(F.size(F.coalesce(own_words, F.array().cast("array<string>"))) > 0, contains_any(text, own_words)).otherwise(_default_match(text, default))


def publication_match(title: Column, content: Column, own_words: Column, default: list[str] | None = None) -> Column:
    """A source's own keywords extend the defaults."""
    text = F.concat_ws(" ", title, content)
    return _default_match(text, default) | contains_any(text, F.coalesce(own_words, F.array().cast("array<string>")))


def signal_match(title: Column, query: Column, keywords: list[str] | None = None) -> Column:
    """Press queries need a crop or farm-input term in the title; other queries pass."""
    return (query != "press") | _default_match(title, keywords) | contains_any(title, INPUT_TERMS)


def is_noise(title: Column) -> Column:
    """Job posts and report advertising, but for senior hires: the leftmost match decides."""
    text = F.coalesce(title, F.lit(""))
    found = F.regexp_extract(text, "(?iU)(" + "|".join(NOISE_PATTERNS) + ")", 1)
    senior = F.lower(found).contains("hiring") & text.rlike("(?iU)" + SENIOR_ROLE)
    return (found != "") & ~senior


def undated_policy(df: DataFrame, now: Column, *, limit: int = UNDATED_LIMIT) -> DataFrame:
    """Publications without a date are taken as published ``now``, the first ``limit`` of each source by position; dated ones stay.

    The limit is counted before any keyword filter.
    """
    undated = df.where("published_at is null").withColumn("_n", F.row_number().over(Window.partitionBy("source").orderBy("pos"))).where(F.col("_n") <= limit)
    taken = undated.drop("_n").withColumn("published_at", now.cast(df.schema["published_at"].dataType)).select(*df.columns)
    return df.where("published_at is not null").unionByName(taken)


def signal_recent(published: Column, now: Column, days: int = SIGNAL_DAYS) -> Column:
    """Within the days; undated signals stay."""
    return published.isNull() | (published >= now - F.make_dt_interval(F.lit(days)))


def dataset_prefix(code: Column, prefixes: list[str]) -> Column:
    low = F.lower(code)
    return F.exists(F.array(*[F.lit(p.lower()) for p in prefixes]), lambda p: F.startswith(low, p))


def drop_reason(title: Column, link: Column, published: Column, now: Column, hours: Column, match: Column) -> Column:
    """Why a row goes, in the order of the checks; null if it stays. Counts by reason don't depend on the optimiser."""
    return (
        F.when(~named(title, link), "empty").when(published.isNull(), "undated").when(~recent(published, now, hours), "old").when(~match, "keywords").otherwise(F.lit(None))
    )


def title_rule(title: Column, kind: str, values: list[str]) -> Column:
    """The title predicates of extractors: any, contains, prefix or regex."""
    low = F.lower(title)
    if kind == "prefix":
        tests = [title.startswith(v) for v in values]
    elif kind == "regex":
        tests = [title.rlike(f"(?i){v}") for v in values]
    else:
        tests = [low.contains(v.lower()) for v in values]
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def recent_cutoff_year(df: DataFrame, codes: list[int], year: int, back: int = 4) -> DataFrame:
    """Statistics rows of the wanted commodities from the last years; all rows where that leaves none."""
    wanted = (F.col("Market_Year") >= year - back) & F.col("Commodity_Code").isin(codes)
    return df.where(wanted) if df.where(wanted).limit(1).count() else df


def relevant_articles(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce("relevant", F.lit(False)))


def relevant_publications(df: DataFrame) -> DataFrame:
    """Unjudged publications pass: they are relevant by default."""
    return df.where(F.coalesce("relevant", F.lit(True)))


def relevant_signals(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce("classified", F.lit(False)) & F.col("signal_type").isNotNull())


def split_accounts(signals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clients, prospects)."""
    return signals.where(F.col("company_type") == "client"), signals.where(F.col("company_type") == "prospect")
