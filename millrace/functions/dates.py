"""Date parsing as chains of ``try_to_timestamp``; everything is UTC."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Month names by language, January first.
MONTHS = {
    "en": ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"],
    "fr": ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"],
    "es": ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"],
    "tr": ["ocak", "şubat", "mart", "nisan", "mayıs", "haziran", "temmuz", "ağustos", "eylül", "ekim", "kasım", "aralık"],
}
OTHER_SPELLINGS = {"es": {"setiembre": 9}}
#: Years that a mention of a month may name.
MENTION_YEARS = (2020, 2035)


def _shape(form: str) -> str:
    """A loose pattern of the texts that a form can fit, so that most parsers aren't tried at all."""
    out = re.sub(r"'(.)'", lambda m: m[1], form)
    out = re.sub(r"MMMM?", "~", out)
    out = re.sub(r"[dMyHms]+", "#", out)
    return "^" + out.replace(".", r"\.").replace("~", r"\p{L}+").replace("#", r"[0-9]+").replace("XXX", "[^ ]+").replace(" Z", " [-+].*").replace(" z", " [A-Za-z].*") + "$"


def _first(texts: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(t.rlike(_shape(f)), F.try_to_timestamp(t, F.lit(f))) for t, f in texts])


def _rfc2822(col: Column) -> Column:
    """``[Mon, ]24 Mar 2026 10:00[:00] GMT|+0200``; the weekday is left off, since the parser refuses it."""
    t = F.regexp_replace(strip(col), r"^[A-Za-z]{3,9},\s*", "")
    t = F.regexp_replace(t, r"\s*\([^)]*\)$", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\s(UT|UTC|Z)$", " GMT"), r"\s+", " ")
    t = F.regexp_replace(t, r"^(\d{1,2} [A-Za-z]{3}) (\d{2}) ", "$1 20$2 ")
    return _first([(t, "d MMM yyyy HH:mm:ss Z"), (t, "d MMM yyyy HH:mm:ss z"), (t, "d MMM yyyy HH:mm Z"), (t, "d MMM yyyy HH:mm z"), (t, "d MMM yyyy HH:mm:ss")])


def parse_feed_date(col: Column) -> Column:
    """RFC 2822, else day/month/year or ISO, with or without a time, on the first 19 characters."""
    t = F.substring(strip(col), 1, 19)
    return F.coalesce(_rfc2822(col), _first([(t, "dd/MM/yyyy HH:mm:ss"), (t, "dd/MM/yyyy"), (t, "yyyy-MM-dd'T'HH:mm:ss"), (t, "yyyy-MM-dd HH:mm:ss"), (t, "yyyy-MM-dd")]))


def parse_flexible_date(col: Column) -> Column:
    """Ten written forms in order, then RFC 2822."""
    t = strip(col)
    forms = ["d/M/yyyy", "d-M-yyyy", "yyyy-M-d", "d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d.M.yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'"]
    return F.coalesce(_first([(t, f) for f in forms]), _rfc2822(col))


def parse_catalogue_date(col: Column) -> Column:
    """RFC 2822 and the five forms of dataset catalogues."""
    t = strip(col)
    return F.coalesce(_rfc2822(col), _first([(t, f) for f in ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy")]))


def month_number(name: Column, languages: tuple[str, ...] = ("en", "fr", "es", "tr")) -> Column:
    """1 to 12 from a month's name or its first three letters (English only)."""
    known: dict[str, int] = {}
    for lang in languages:
        for i, month in enumerate(MONTHS[lang], 1):
            known.setdefault(month, i)
            if lang == "en":
                known.setdefault(month[:3], i)
        known |= OTHER_SPELLINGS.get(lang, {})
    pairs = [F.lit(x) for pair in known.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(strip(F.coalesce(name, F.lit("")))))


def parse_written_date(col: Column, languages: tuple[str, ...] = ("en", "fr", "es", "tr")) -> Column:
    """The first ``24 month 2026`` or ``month 24, 2026`` or ``dd/mm/yyyy`` or ``month 2026`` within a text."""
    word = r"([\p{L}]+)"
    day_first = rf"(?U)(\d{{1,2}})\.?\s+{word},?\s+(\d{{4}})"
    name_first = rf"(?U){word}\s+(\d{{1,2}}),?\s+(\d{{4}})"
    month_only = rf"(?U){word}\s+(?:de\s+)?(\d{{4}})"
    part = lambda p, i: F.nullif(F.regexp_extract(col, p, i), F.lit(""))

    def made(y, m, d):
        return F.when(m.isNotNull(), F.to_timestamp(F.try_to_timestamp(F.format_string("%s-%02d-%02d", y, m, d.cast("int")), F.lit("yyyy-MM-dd"))))

    numeric = r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})"
    return F.coalesce(
        made(part(numeric, 3), part(numeric, 2).cast("int"), part(numeric, 1)),
        made(part(day_first, 3), month_number(part(day_first, 2), languages), part(day_first, 1)),
        made(part(name_first, 3), month_number(part(name_first, 1), languages), part(name_first, 2)),
        made(part(month_only, 2), month_number(part(month_only, 1), languages), F.lit(1)),
    )


def latest_month_mention(col: Column, language: str = "es", first_year: int = MENTION_YEARS[0], last_year: int = MENTION_YEARS[1]) -> Column:
    """The latest ``month year`` that a text mentions, as the first of that month; years out of bounds don't count; null without one."""
    names = "|".join(MONTHS[language] + list(OTHER_SPELLINGS.get(language, {})))
    found = F.regexp_extract_all(F.lower(col), F.lit(rf"(?U)\b(?:{names})\b[\s,]+(?:de\s+)?\d{{4}}"), 0)
    year = lambda t: F.regexp_extract(t, r"(\d{4})$", 1).cast("int")
    able = F.filter(found, lambda t: year(t).between(first_year, last_year))
    return F.array_max(F.transform(able, lambda t: F.make_date(year(t), month_number(F.regexp_extract(t, r"^(\p{L}+)", 1), (language,)), F.lit(1))))


def path_year(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/(\d{4})/", 1), F.lit("")).cast("int")


def path_date(url: Column) -> Column:
    """``/2026/03/24`` or ``/2026-03`` in a URL; a missing day is 1."""
    year, month = F.regexp_extract(url, r"(\d{4})[/-](\d{2})", 1), F.regexp_extract(url, r"(\d{4})[/-](\d{2})", 2)
    day = F.coalesce(F.nullif(F.regexp_extract(url, r"\d{4}[/-]\d{2}[/-](\d{2})", 1), F.lit("")), F.lit("01"))
    return F.try_to_timestamp(F.concat_ws("-", F.nullif(year, F.lit("")), month, day), F.lit("yyyy-MM-dd"))
