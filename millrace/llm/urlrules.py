"""URL filtering by mined association rules.

A URL becomes a small set of tokens (host, its labels, first folders, file ending, query
keys, fragment). Spark's FP-growth mines the token combinations of labelled URLs; rules
``tokens -> bad`` are kept if their support, confidence and lift reach the limits. An
inverted index matches them: each rule is listed under its rarest token only, distinct
token sets (not rows) look up their tokens there, and the rest of the rule is verified.

Stated host/path rules come first; the mined rules judge what no stated rule fits.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Marks the bad URLs among the items; no token of a URL starts like it.
BAD = "verdict=bad"
#: A rule holds for at least this share of the labelled URLs, and this share of those it fits is bad.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.002, 0.35, 2.0
#: Rules seen on few URLs must also have this confidence at the lower end of their Wilson interval.
MIN_LOWER, WILSON_Z = 0.25, 1.645
SALTS = 16
STATED = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens; never null."""
    labels = F.split(host, r"\.")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda p: F.concat(F.lit("query="), F.regexp_extract(p, r"(?s)^([^=]*)", 1)))
    found = F.concat(
        F.array(F.concat(F.lit("host="), host), F.concat(F.lit("tld="), F.element_at(labels, -1))),
        F.transform(labels, lambda x: F.concat(F.lit("label="), x)),
        F.array(
            F.concat(F.lit("dir="), F.regexp_extract(path, r"(?s)^/([^/]*)/", 1)),
            F.concat(F.lit("end="), F.regexp_extract(path, r"(?s)\.([A-Za-z0-9]{1,8})$", 1)),
            F.when(F.length(path) > 1, F.when(path.endswith("/"), F.lit("slash=yes"))),
            F.when(F.coalesce(url, F.lit("")).contains("#"), F.lit("fragment=yes")),
        ),
        keys,
    )
    return F.array_sort(F.array_distinct(F.filter(found, lambda t: t.isNotNull() & ~t.endswith("="))))


def stated_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest stated rule that fits, by length of host and path; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def mine_rules(
    labelled: DataFrame, *, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, max_antecedent: int | None = None
) -> DataFrame:
    """Rules (antecedent, first, confidence, support, lift) from ``tokens`` and ``bad``; ``first`` is the rarest token.

    The count of frequent tokens is at most (mean tokens of a URL) / ``min_support``, whatever the number of rows. ``max_antecedent`` leaves out
    rules of more tokens. Items and frequent sets are written down, since mining and every step after it start from them.
    """
    items = labelled.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"))
    items = materialise(items, "url-items")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    n = F.lit(float(items.count()))
    fitted, z2 = F.col("support") / F.col("confidence") * n, WILSON_Z**2
    centre = F.col("confidence") + z2 / (2 * fitted)
    spread = WILSON_Z * F.sqrt(F.col("confidence") * (1 - F.col("confidence")) / fitted + z2 / (4 * fitted * fitted))
    mined = model.associationRules.where((F.col("consequent") == F.array(F.lit(BAD))) & (F.col("lift") >= min_lift))
    rules = mined.where((centre - spread) / (1 + z2 / fitted) >= MIN_LOWER).select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support", "lift")
    rules = materialise(rules if max_antecedent is None else rules.where(F.size("antecedent") <= max_antecedent), "url-rules")
    single = items.select(F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("freq"))
    named = rules.withColumn("token", F.explode("antecedent")).join(single, "token")
    return named.groupBy("antecedent", "confidence", "support", "lift").agg(F.min_by("token", F.struct("freq", "token")).alias("first"))


def best_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct token set (``tokens``) that a rule fits, the most confident rule; of those the one of the most support, then the last by its words."""
    looked = sets.withColumn("first", F.explode("tokens")).join(rules, "first")
    fits = looked.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    return fits.groupBy("tokens").agg(F.max(F.struct("confidence", "support", F.array_join("antecedent", " ").alias("mined_rule"))).alias("best")).select("tokens", "best.*")


def judge_urls(pages: DataFrame, labels: DataFrame, stated: list[tuple[str, str, str]] = STATED) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, confidence for every row of ``pages`` (page_id, url).

    ``labels`` (doc_id, quality) names the pages that are known to be good (1) or bad (0); null
    qualities teach nothing. A null url has empty host and path and is allowed unless a mined rule
    fits its (empty) tokens, which none does. Repeated rows are each judged alike; no rows give no rows. A URL counts whole,
    whatever its length; other columns of ``pages`` are left out.
    """
    url = F.col("url")
    base = pages.select("page_id", "url").withColumn("host", url_host(url)).withColumn("path", url_path(url))
    base = base.withColumn("tokens", url_tokens(url, F.col("host"), F.col("path")))
    base = base.withColumn("stated", stated_rule(F.col("host"), F.col("path"), stated))
    known = labels.select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad")).where("bad is not null and page_id is not null")
    rules = mine_rules(base.select("page_id", "tokens").join(known, "page_id"))
    sets = base.where("stated is null").select("tokens").distinct()
    best = materialise(best_rules(sets, rules), "url-judged").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = base.drop("url").withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    return rows.join(best, ["tokens", "salt"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("stated.rule").alias("rule"),
        F.coalesce(F.col("stated.verdict"), F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.when(F.col("stated").isNull(), F.col("mined_rule")).alias("mined_rule"),
    )


def op2_url_rules(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
