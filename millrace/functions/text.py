"""Text functions on columns; Python only where Spark has no equivalent (unescaping, NFKD)."""

from __future__ import annotations

import functools
import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..shipping import ship_active

_STRIP = r"(?U)^\s+|\s+$"


def strip(col: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(col, _STRIP, "")


def squeeze(col: Column) -> Column:
    """White space runs become one space, none at the ends."""
    return F.regexp_replace(strip(F.coalesce(col, F.lit(""))), r"(?U)\s+", " ")


def stable_id(url: Column, title: Column) -> Column:
    """First 16 hex digits of sha256 of the stripped url, a bar, and the stripped lower-case title."""
    key = F.concat(strip(F.coalesce(url, F.lit(""))), F.lit("|"), F.lower(strip(F.coalesce(title, F.lit("")))))
    return F.substring(F.sha2(key.cast("binary"), 256), 1, 16)


def dated_id(code: Column, day: Column) -> Column:
    """Id of a dataset update: code and calendar day."""
    return F.substring(F.sha2(F.concat(F.lower(code), F.lit("|"), F.date_format(day, "yyyy-MM-dd")).cast("binary"), 256), 1, 16)


_KEPT = frozenset("abcdefghijklmnopqrstuvwxyz0123456789 ")


class _Plain(dict):
    """What becomes of each code point: the letters, digits and spaces of its compatibility decomposition, in lower case."""

    def __missing__(self, code: int) -> str:
        self[code] = "".join(c for c in unicodedata.normalize("NFKD", chr(code)).lower() if c in _KEPT)
        return self[code]


_PLAIN = _Plain()


def plain_title(title: str | None) -> str:
    """The normal form of one title; ``normalize_title`` is the same on columns."""
    return " ".join((title or "").translate(_PLAIN).split())


@functools.cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """(characters outside ASCII that become one kept character, those characters, and those that become several)."""
    seen = [(chr(c), _PLAIN[c]) for c in range(0x80, 0x110000) if unicodedata.decomposition(chr(c))]
    one = [(c, to) for c, to in seen if len(to) == 1]
    return "".join(c for c, _ in one), "".join(to for _, to in one), {c: to for c, to in seen if len(to) > 1}


def normalize_title(col: Column) -> Column:
    """Compatibility decomposition, lower case, ``[a-z0-9 ]``, single spaces; within code generation.

    Characters that become one are translated; the few that become several (ligatures, units) are looked up one by one, only in rows that hold any.
    """
    many, ones, several = _folds()
    text = F.translate(F.coalesce(col, F.lit("")), many, ones)
    names = F.str_to_map(F.lit(",".join(f"{c}:{to}" for c, to in several.items())), F.lit(","), F.lit(":"))
    spelled = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(names, c), c)), "")
    text = F.when(text.rlike("[" + "".join(several) + "]"), spelled).otherwise(text)
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9 ]", ""), r" +", " "))


def unescape_html(col: Column) -> Column:
    """Entities become characters, ends stripped; null stays null."""
    ship_active()

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else html.unescape(t).strip())

    return run(col)


def clip_text(col: Column, limit: int) -> Column:
    """At most ``limit`` characters, cut at a word's end, with an ellipsis where cut."""
    flat = squeeze(col)
    cut = F.substring(flat, 1, limit)
    head = F.when(cut.contains(" "), F.regexp_extract(cut, r"(?s)^(.*) [^ ]*$", 1)).otherwise(cut)
    return F.when(F.length(flat) <= limit, flat).otherwise(F.concat(F.regexp_replace(head, r"[,;:·\-]+$", ""), F.lit("…")))


def subject_hook(takeaway: Column, top_title: Column) -> Column:
    """First sentence of the takeaway, else the top story's title, at 60 characters."""
    first = F.regexp_replace(F.split(strip(takeaway), r"(?<=[.!?])\s+")[0], r"\.+$", "")
    return F.when(F.length(F.coalesce(takeaway, F.lit(""))) > 0, clip_text(first, 60)).otherwise(clip_text(top_title, 60))


def preheader(titles: Column, skip_first: bool) -> Column:
    """The next three titles, joined, at 140 characters."""
    return clip_text(F.array_join(F.slice(titles, 2 if skip_first else 1, 3), " · "), 140)


def title_part(col: Column) -> Column:
    """``Title`` of ``Title - Source``, split at the last `` - ``."""
    return F.when(col.contains(" - "), F.regexp_extract(col, r"(?s)^(.*) - (.*)$", 1)).otherwise(col)


def source_part(col: Column) -> Column:
    return F.when(col.contains(" - "), F.regexp_extract(col, r"(?s)^(.*) - (.*)$", 2)).otherwise(F.lit(""))


def visible_text(html_col: Column) -> Column:
    t = F.regexp_replace(html_col, r"(?s)<(style|title).*?</\1>", " ")
    return F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", " "), r"<[^>]+>", " ")


def word_count(col: Column) -> Column:
    flat = squeeze(col)
    return F.when(flat == "", 0).otherwise(F.size(F.split(flat, " ")))


def read_minutes(html_col: Column, words_per_minute: int = 230) -> Column:
    """Reading time of the visible text, one minute at least; halves go to the even number."""
    return F.greatest(F.lit(1), F.bround(word_count(visible_text(html_col)) / words_per_minute, 0).cast("int"))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_REGIONAL = "".join(chr(0x1F1E6 + i) for i in range(26))


def flag_emoji(iso: Column) -> Column:
    """Two-letter country code to its flag; empty where it isn't one."""
    code = F.upper(strip(F.coalesce(iso, F.lit(""))))
    return F.when(code.rlike("^[A-Z]{2}$"), F.translate(code, _LETTERS, _REGIONAL)).otherwise(F.lit(""))


def format_amount(col: Column, unit: str) -> Column:
    """``46.1M unit`` from a million on, else ``46K unit``; null for null and 0."""
    return F.when(col >= 1_000_000, F.format_string(f"%.1fM {unit}", col / 1_000_000)).when(col != 0, F.format_string(f"%.0fK {unit}", col / 1_000))


def signed_percent(col: Column) -> Column:
    return F.format_string("%+.1f%%", col)


def grouped_number(col: Column) -> Column:
    return F.format_number(col, 0)


def runtime_display(seconds: Column) -> Column:
    return F.when(seconds < 60, F.format_string("%.0fs", seconds)).otherwise(F.format_string("%.1f min", seconds / 60))


def safe_number(col: Column) -> Column:
    """A number with thousands commas; null for placeholders and anything else."""
    t = strip(col)
    return F.when(t.isin("", "-", "...", "X"), None).otherwise(F.regexp_replace(t, ",", "").try_cast("double"))


def clean_prefixes(title: Column, prefixes: dict[str, str]) -> Column:
    """The first prefix that fits is replaced; ``{"Date: ": ""}`` strips one."""
    out = title
    for old, new in reversed(list(prefixes.items())):
        out = F.when(title.startswith(old), F.concat(F.lit(new), F.substring(title, len(old) + 1, 2**31 - 1))).otherwise(out)
    return out


def _among(values: list[str], word: Column) -> Column:
    return word.isin(values)


#: Short words that a text of some lines can hardly do without, by language.
COMMON_WORDS = {
    "en": "the of and to in is that for was with as on are by from which this not",
    "fr": "le les des et du une que dans pour qui sur est au avec par ne pas plus",
    "de": "der die und das den von mit des für auf ist nicht ein eine dem zu im auch",
    "es": "el los las que y en del por con para una no se su al lo como más",
    "pt": "o os das dos e em que um uma para com não por mais na no ao",
    "it": "il di che e gli della per con non una sono del le è alla nel",
    "pl": "i w na z się nie że do jest to od oraz dla przez",
    "nl": "de het een van en in dat op te voor met zijn niet aan",
    "ro": "și în de la cu pe nu o din pentru este mai care a",
    "tr": "ve bir bu için ile de da olarak en daha çok olan",
    "hu": "a az és hogy nem egy is meg csak volt azt ezt",
    "uk": "і в на з що не до та як від для у за",
    "cs": "a se na je že v s z do pro jako ale o",
    "sv": "och att det som en på är av för med den inte",
}


def word_weights() -> dict[str, dict[str, int]]:
    """What each word says for its languages, in sixtieths: one that several share says as much less."""
    shared: dict[str, int] = {}
    for words in COMMON_WORDS.values():
        for w in set(words.split()):
            shared[w] = shared.get(w, 0) + 1
    return {lang: {w: 60 // shared[w] for w in dict.fromkeys(words.split())} for lang, words in COMMON_WORDS.items()}


def _shared_kinds() -> dict[tuple[int, ...], list[str]]:
    """Words by what they say for each language, the kinds of most words first."""
    weights = list(word_weights().values())
    kinds: dict[tuple[int, ...], list[str]] = {}
    for word in dict.fromkeys(w for words in weights for w in words):
        kinds.setdefault(tuple(words.get(word, 0) for words in weights), []).append(word)
    return dict(sorted(kinds.items(), key=lambda kind: -len(kind[1])))


def guess_language(col: Column, default: str = "en") -> Column:
    """The language whose common words weigh most in the whole text, the first listed of equals; the default without any such word.

    A text's words are looked at once: the common ones become a string of one sign each, by kind, and the languages' counts are taken from that string.
    """
    kinds = _shared_kinds()
    signs = [chr(ord("0") + i) for i in range(len(kinds))]  # ASCII, so that bytes are signs
    if signs[-1] > "~":
        raise ValueError("too many kinds of words")

    def sign(word: Column) -> Column:
        return F.coalesce(*[F.when(_among(words, word), F.lit(s)) for s, words in zip(signs, kinds.values())])

    def best(found: Column) -> Column:
        counts = [F.octet_length(found) - F.octet_length(F.replace(found, F.lit(s))) for s in signs]
        total = lambda n: functools.reduce(lambda a, b: a + b, [count * kind[n] for count, kind in zip(counts, kinds) if kind[n]])
        totals = F.array(*[total(n) for n in range(len(COMMON_WORDS))])
        langs = F.array(*[F.lit(lang) for lang in COMMON_WORDS])
        at = lambda t: F.when(F.array_max(t) > 0, F.element_at(langs, F.array_position(t, F.array_max(t)).cast("int"))).otherwise(default)
        return F.get(F.transform(F.array(totals), at), F.lit(0))

    common = functools.partial(_among, [word for words in kinds.values() for word in words])
    plain = F.replace(F.coalesce(col, F.lit("")), F.lit("\u0130"), F.lit("i"))  # in lower case that letter has a mark, which would end the word
    words = F.split(F.lower(plain), r"\P{L}+")
    found = F.array_join(F.transform(F.filter(words, common), sign), "")
    return F.get(F.transform(F.array(found), best), F.lit(0))
