"""Run counters, per-source counts, token usage and cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An example price list, USD for a million tokens by model; over the threshold of prompt tokens the long rates hold. Callers pass their own as a table.
PRICES = [
    ("small", 0.10, 0.50, 100_000, 0.50, 2.50),
    ("small-previous", 1.00, 5.00, None, None, None),
    ("large", 3.00, 15.00, None, None, None),
]
PRICE_SCHEMA = "model string, input double, output double, long_threshold long, long_input double, long_output double"
DEFAULT_INPUT, DEFAULT_OUTPUT = 3.00, 15.00
CACHE_WRITE, CACHE_READ, BATCH = 1.25, 0.10, 0.50


def call_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """``usage`` with the cost of each call; models without a price get the default one. Null counts are 0."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    joined = usage.join(prices, "model", "left")
    prompt = n("input_tokens") + n("cache_read") + n("cache_write")
    long = F.coalesce(prompt > F.col("long_threshold"), F.lit(False))
    rate_in = F.when(long, F.col("long_input")).otherwise(F.coalesce("input", F.lit(DEFAULT_INPUT)))
    rate_out = F.when(long, F.col("long_output")).otherwise(F.coalesce("output", F.lit(DEFAULT_OUTPUT)))
    cost = n("input_tokens") * rate_in + n("output_tokens") * rate_out + n("cache_write") * rate_in * CACHE_WRITE + n("cache_read") * rate_in * CACHE_READ
    cost = cost / 1_000_000 * F.when(F.col("batch"), BATCH).otherwise(1.0)
    return joined.withColumn("cost", cost).select(*usage.columns, "cost")


def cost_by(usage: DataFrame, prices: DataFrame, key: str) -> DataFrame:
    priced = call_cost(usage, prices)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return priced.groupBy(key).agg(
        F.count("*").alias("calls"), total("input_tokens"), total("output_tokens"), total("cache_read"), total("cache_write"), F.round(F.sum("cost"), 6).alias("cost")
    )


def cost_rollup(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost by stage, by model and in all, in one pass."""
    priced = call_cost(usage, prices)
    return priced.groupingSets([["stage"], ["model"], []], "stage", "model").agg(F.count("*").alias("calls"), F.round(F.sum("cost"), 6).alias("cost"))


def cost_table(usage: DataFrame, prices: DataFrame) -> DataFrame:
    return cost_by(usage, prices, "stage").orderBy(F.desc("cost"), "stage")


def run_counters(rows: DataFrame) -> DataFrame:
    """One row: fetched, duplicate, unclassified, rejected and accepted rows (columns duplicate, classified, relevant)."""
    new = ~F.col("duplicate")
    return rows.agg(
        F.count("*").alias("fetched"),
        F.count_if(F.col("duplicate")).alias("duplicate"),
        F.count_if(new & ~F.col("classified")).alias("unclassified"),
        F.count_if(new & F.col("classified") & ~F.col("relevant")).alias("rejected"),
        F.count_if(new & F.col("classified") & F.col("relevant")).alias("accepted"),
    )


def source_counts(rows: DataFrame, passed: Column, key: str = "source") -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("raw"), F.count_if(passed).alias("passed"))


def rate_display(ok: Column, attempted: Column) -> Column:
    """``95% (38/40)``, or N/A where nothing was tried."""
    return F.when(attempted > 0, F.format_string("%d%% (%d/%d)", F.bround(ok / attempted * 100, 0).cast("int"), ok.cast("int"), attempted.cast("int"))).otherwise(F.lit("N/A"))


def source_verdicts(entries: DataFrame, sources: DataFrame, now: Column) -> DataFrame:
    """Each source's newest entry, its age in days and PASS, EMPTY (no rows) or FAIL (an error)."""
    newest = entries.groupBy("source").agg(F.max("published_at").alias("newest"), F.count("*").alias("entries"))
    out = sources.join(newest, "source", "left").withColumn("entries", F.coalesce("entries", F.lit(0)))
    verdict = F.when(F.col("error").isNotNull(), "FAIL").when(F.col("entries") == 0, "EMPTY").otherwise("PASS")
    return out.withColumn("verdict", verdict).withColumn("age_days", F.datediff(now, F.col("newest")))


def recipient_groups(recipients: DataFrame) -> DataFrame:
    """For each group the primary address (the marked one, else the first) and the others, in order."""
    active = recipients.where("active")
    primary = F.min_by("email", F.struct((~F.coalesce("is_primary", F.lit(False))).alias("p"), F.col("seq")))
    rows = active.groupBy("group").agg(primary.alias("primary"), F.sort_array(F.collect_list(F.struct("seq", "email"))).alias("all"))
    return rows.select("group", "primary", F.filter(F.transform("all", lambda r: r["email"]), lambda e: e != F.col("primary")).alias("cc"))
