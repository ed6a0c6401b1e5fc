"""Checks and repairs of generated briefs: style, banned words, and numbers that the sources don't hold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import squeeze, word_count
from ..schemas import BRIEF

MAX_WORDS = 320

# Words a brief may not use, each with its replacement.
REPLACEMENTS = {
    "leverage": "use",
    "landscape": "market",
    "robust": "strong",
    "seamless": "smooth",
    "game-changer": "major shift",
    "cutting-edge": "advanced",
    "unlock": "open up",
    "harness": "use",
    "pivotal": "key",
    "crucial": "key",
    "underscore": "show",
    "navigate": "handle",
    "delve": "look",
    "realm": "area",
    "testament": "sign",
    "foster": "support",
    "empower": "enable",
    "streamline": "simplify",
    "elevate": "raise",
    "transformative": "major",
    "dynamic": "shifting",
    "optimize": "improve",
}

# Turns of phrase that are only warned about.
TELLS = ["not just", "it's not about", "isn't about", "rather than", "instead of", "the question isn't", "x is dead"]


def brief_text(takeaway: Column, sections: Column) -> Column:
    return F.array_join(F.concat(F.array(takeaway), F.transform(sections, lambda s: s["text"])), " ")


def banned_words(text: Column, words: list[str] | None = None, letters: str | None = None) -> Column:
    """The banned words in a text, in the order of the list. They stand alone by Unicode's word edges, or where ``letters``, a character class, says what makes up words.

    One pass over the text finds them all; words that begin with another one of the list take a pass of their own.
    """
    start, end = (rf"(?<!{letters})", rf"(?!{letters})") if letters else (r"(?U)\b", r"\b")
    passes: list[list[str]] = []
    for word in dict.fromkeys(words or REPLACEMENTS):
        fit = next((p for p in passes if not any(w.startswith(word) or word.startswith(w) for w in p)), None)
        fit.append(word) if fit is not None else passes.append([word])
    found = lambda low: F.concat(*[F.regexp_extract_all(low, F.lit(start + "(?=(" + "|".join(rf"\Q{w}\E" for w in p) + ")" + end + ")"), 1) for p in passes])
    return F.array_intersect(F.array(*[F.lit(w) for w in words or REPLACEMENTS]), found(F.lower(F.coalesce(text, F.lit("")))))


def hard_issues(text: Column) -> Column:
    """Array of what must not ship: dashes, length, banned words."""

    def found(t: Column) -> Column:
        long = _let(word_count(t), lambda n: F.when(n > MAX_WORDS, F.format_string(f"Too long: %d words (max {MAX_WORDS}).", n)))
        # The messages.
        rules = F.array(F.when(t.rlike("[—–]"), F.lit("Contains an em/en dash.")), long)
        return F.concat(F.filter(rules, lambda x: x.isNotNull()), F.transform(banned_words(t), lambda w: F.concat(F.lit("Banned word: '"), w, F.lit("'."))))

    return _let(text, found)


def soft_warnings(text: Column) -> Column:
    low = F.lower(text)
    return F.filter(F.array(*[F.lit(t) for t in TELLS]), lambda t: low.contains(t))


def _norm(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(token, r"^[.,]+|[.,]+$", ""), ",", "")


def number_tokens(text: Column) -> Column:
    """Array of (token, norm): figures that claim something. One-digit numbers, years and doubles are left out, the first spelling stays.

    Doubles meet by sorting, so the cost is that of sorting a text's figures.
    """
    raw = F.transform(F.regexp_extract_all(text, F.lit(r"(\d[\d.,]*)"), 1), lambda t, i: F.struct(_norm(t).alias("norm"), i.alias("pos"), t.alias("token")))
    claims = F.array_sort(F.filter(raw, lambda x: (F.length(x["norm"]) >= 2) & ~x["norm"].rlike(r"^(19|20)\d\d$")))
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform(claims, lambda x: x["norm"]))
    first = F.filter(F.arrays_zip(claims.alias("c"), before.alias("b")), lambda x: x["c"].isNotNull() & ~x["c"]["norm"].eqNullSafe(x["b"]))
    placed = F.array_sort(F.transform(first, lambda x: F.struct(x["c"]["pos"].alias("pos"), x["c"]["token"].alias("token"), x["c"]["norm"].alias("norm"))))
    return F.transform(placed, lambda x: F.struct(x["token"].alias("token"), x["norm"].alias("norm")))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where it is used for each element of an array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _marked(text: Column) -> Column:
    """Every run of digits in brackets, so that a part of a longer number is no substring."""
    return F.regexp_replace(text, r"(\d+)", "<$1>")


def source_figures(source: Column) -> Column:
    """What a source supports: ``forms``, the figures of one run of digits or two with a point between, once more with ``.0``; ``marked``, the text in which longer ones are looked up.

    It is made once for each source, in time that goes with its length; commas are taken out.
    """
    plain = F.regexp_replace(F.coalesce(source, F.lit("")), ",", "")
    runs = F.regexp_extract_all(plain, F.lit(r"(\d+)"), 1)
    pairs = F.regexp_extract_all(plain, F.lit(r"(?<!\d)(?=(\d+\.\d+))"), 1)  # they overlap: 1.2.3 holds two
    forms = F.array_distinct(F.concat(runs, pairs))
    return F.struct(F.concat(forms, F.transform(forms, lambda f: F.concat(f, F.lit(".0")))).alias("forms"), _marked(plain).alias("marked"))


def structure(text: Column) -> Column:
    """Where a text's figures are structure: ``heads``, after Q, H, G or top, with the letter that follows; ``tails``, before a unit of time. The words of the patterns."""
    heads = F.regexp_extract_all(text, F.lit(r"(?iU)(?:[QH]|\btop[\s-]|\bG)(?=(\d[\d.,]*\w?))"), 1)
    tails = F.regexp_extract_all(text, F.lit(r"(?iU)(\d[\d.,]*)[\s-](?:week|day|month|year|quarter)"), 1)
    return F.struct(F.array_distinct(heads).alias("heads"), F.array_distinct(tails).alias("tails"))


def structural(token: Column, held: Column) -> Column:
    """Quarters, halves, top lists, groups and durations are structure, not figures; ``held`` is the text's ``structure``."""

    def heads(h: Column) -> Column:
        after = F.substr(h, F.length(token) + 1, F.lit(1))
        word = ~after.isin("", ".", ",")
        return h.startswith(token) & F.when(token.rlike(r"\d$"), ~word).otherwise(word)

    return F.exists(held["heads"], heads) | F.exists(held["tails"], lambda t: t.endswith(token))


def _unsupported(claims: Column, figures: Column) -> Column:
    """The claims whose figure doesn't stand alone in the source, nor without ``.0``, nor as the whole part of a decimal.

    Claims and the source's forms are sorted together; a claim that follows its own form is supported.
    """
    forms = F.transform(F.array_distinct(figures["forms"]), lambda f: F.struct(f.alias("norm"), F.lit(-1).alias("pos"), F.lit("").alias("token")))
    asked = F.transform(claims, lambda x, i: F.struct(x["norm"].alias("norm"), i.alias("pos"), x["token"].alias("token")))
    both = F.array_sort(F.concat(forms, asked))
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform(both, lambda x: x["norm"]))
    left = F.filter(F.arrays_zip(both.alias("c"), before.alias("b")), lambda x: x["c"].isNotNull() & (x["c"]["pos"] >= 0) & ~x["c"]["norm"].eqNullSafe(x["b"]))
    # figures of three runs and more are rare, and looked up by themselves
    alone = lambda norm: norm.rlike(r"\..*\.") & (figures["marked"].contains(_marked(norm)) | (norm.endswith(".0") & figures["marked"].contains(_marked(F.regexp_replace(norm, r"\.0$", "")))))
    return F.array_sort(F.transform(F.filter(left, lambda x: ~alone(x["c"]["norm"])), lambda x: F.struct(x["c"]["pos"].alias("pos"), x["c"]["token"].alias("token"))))


def ungrounded(text: Column, source: Column | None = None, *, figures: Column | None = None) -> Column:
    """Array of the tokens of a text that the source doesn't support; ``figures`` is the source's ``source_figures``, made before where several texts share it."""

    def missing(claims: Column) -> Column:
        given = F.struct(claims.alias("claims"), (source_figures(source) if figures is None else figures).alias("figures"), structure(text).alias("held"))
        found = _let(given, lambda g: F.struct(_unsupported(g["claims"], g["figures"]).alias("missing"), g["held"].alias("held")))
        return _let(found, lambda f: F.transform(F.filter(f["missing"], lambda x: ~structural(x["token"], f["held"])), lambda x: x["token"]))

    # most texts claim nothing, and then the source isn't looked at
    return _let(number_tokens(text), lambda claims: F.when(F.size(claims) == 0, F.array().cast("array<string>")).otherwise(missing(claims)))


def autofix(text: Column) -> Column:
    """Dashes become commas, banned words their replacements (a capital stays one), and the spacing is cleaned."""
    out = F.regexp_replace(text, "[—–]", ", ")
    for word, new in REPLACEMENTS.items():
        capital = rf"(?U)\b(?=\p{{Lu}})(?i:\Q{word}\E)\b"
        out = F.regexp_replace(F.regexp_replace(out, capital, new[0].upper() + new[1:]), rf"(?iU)\b\Q{word}\E\b", new)
    return squeeze(F.regexp_replace(F.regexp_replace(out, r"\s+,", ","), r",\s*,", ","))


def trim_sections(takeaway: Column, sections: Column, limit: int = MAX_WORDS) -> Column:
    """The longest leading run of sections with which the brief stays within the words."""
    n = F.transform(sections, lambda s: word_count(s["text"]))
    kept = F.filter(F.sequence(F.lit(0), F.size(sections)), lambda k: F.aggregate(F.slice(n, F.lit(1), k), word_count(takeaway), lambda a, x: a + x) <= limit)
    return F.slice(sections, F.lit(1), F.coalesce(F.array_max(kept), F.lit(0)))


def keep_grounded(text: Column, source: Column | None = None, *, figures: Column | None = None) -> Column:
    """The sentences without figures that the source doesn't support; ``source`` or ``figures`` as in ``ungrounded``."""
    keep = lambda f: F.array_join(F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: (s != "") & (F.size(ungrounded(s, figures=f)) == 0)), " ")
    return F.trim(_let(source_figures(source), keep) if figures is None else keep(figures))


def salvage(briefs: DataFrame) -> DataFrame:
    """Briefs (takeaway, sections, source_text) without unsupported sentences; what has no takeaway or no section then goes.

    A brief's texts are made once, as an array of one or none that is exploded: a condition on columns would have them made again for it.
    """

    def made(figures: Column) -> Column:
        sections = F.transform("sections", lambda s: F.struct(s["label"].alias("label"), keep_grounded(s["text"], figures=figures).alias("text")))
        return F.struct(keep_grounded(F.col("takeaway"), figures=figures).alias("takeaway"), F.filter(sections, lambda s: s["text"] != "").alias("sections"))

    filled = F.transform(
        F.array(_let(source_figures(F.col("source_text")), made)),
        lambda m: F.struct(F.when(m["takeaway"] == "", F.get(m["sections"], F.lit(0))["text"]).otherwise(m["takeaway"]).alias("takeaway"), m["sections"].alias("sections")),
    )
    left = F.filter(filled, lambda m: (F.coalesce(m["takeaway"], F.lit("")) != "") & (F.size(m["sections"]) > 0))
    out = briefs.withColumn("_left", F.explode(left))
    return out.select(*[F.col("_left")[c].alias(c) if c in ("takeaway", "sections") else F.col(c) for c in briefs.columns])


def source_text(items: DataFrame) -> DataFrame:
    """One row: the lines of all items (category, seq, title, summary), categories with the most items first.

    It is the input of one generated brief, so it's gathered on purpose.
    """
    line = F.concat(F.lit("- "), F.col("title"), F.lit(": "), F.coalesce("summary", F.lit("")))
    groups = items.groupBy("category").agg(F.count("*").alias("n"), F.min("seq").alias("s"), F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))).alias("l"))
    block = F.concat(F.col("category"), F.lit("\n"), F.array_join(F.transform("l", lambda x: x["line"]), "\n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "s", block.alias("b"))))
    return groups.agg(F.array_join(F.transform(ordered, lambda x: x["b"]), "\n\n").alias("source_text"))


def repaired(briefs: DataFrame) -> DataFrame:
    """Style mended: dashes, banned words and spacing in every text, then whole sections off the end until the length fits."""
    sections = F.transform("sections", lambda s: F.struct(s["label"].alias("label"), autofix(s["text"]).alias("text")))
    out = briefs.withColumn("takeaway", autofix(F.coalesce("takeaway", F.lit("")))).withColumn("sections", sections)
    return out.withColumn("sections", trim_sections(F.col("takeaway"), F.col("sections")))


def unsupported(briefs: DataFrame) -> DataFrame:
    """Briefs with ``issues``: the figures that their source_text doesn't hold."""
    return briefs.withColumn("issues", ungrounded(brief_text(F.col("takeaway"), F.col("sections")), F.col("source_text")))


def generate_brief(spark: SparkSession, generate: Callable[[str, list[str]], dict | None], source: str, rounds: int = 3) -> tuple[dict | None, str]:
    """(brief or None, what happened). Style is mended, never a reason to ask again; figures that the source doesn't hold are.

    After ``rounds`` the sentences with such figures go, and what is left is a brief only if every figure in it is supported.
    A run has one brief, so one row is all that Spark sees.
    """
    schema, issues, last = f"{BRIEF}, source_text string", [], None
    for _ in range(rounds):
        made = generate(source, issues)
        if not made or not (made.get("takeaway") or made.get("sections")):
            return None, "omitted (generation empty)"
        row = (made.get("takeaway") or "", [(s["label"], s["text"]) for s in made.get("sections") or []], source)
        last = repaired(spark.createDataFrame([row], schema))
        found = unsupported(last).first()
        issues = list(found["issues"])
        if not issues:
            return _plain(found), f"included ({len(found['sections'])} sections)"
    left = unsupported(repaired(salvage(last))).collect()
    if left and not left[0]["issues"]:
        return _plain(left[0]), f"included (salvaged, {len(left[0]['sections'])} sections)"
    return None, f"omitted ({'; '.join(issues)[:120]})"


def _plain(row) -> dict:
    return {"takeaway": row["takeaway"], "sections": [(s["label"], s["text"]) for s in row["sections"]]}
