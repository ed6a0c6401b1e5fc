"""Mixing sources to target weights with exact quotas for every output shard.

Each source's rows are permuted by a seeded hash whose leading hex digits cut it into
blocks. A source's target is met by whole passes over it and a prefix of the permutation.
The blocks to take, counted by source, are split over the output shards by a binary
tree: at each node the left half's quota is one multivariate hypergeometric draw from the
node's quotas, so every shard holds a random but exact part. Permuted blocks
then fill the quotas without overlap, and each shard is shuffled on its own.

The driver holds one row for each source (its size, target and quotas), as weights are stated by source; blocks and rows stay in Spark.
Where a source's prefix ends is found digit by digit, so no task orders more than ``EDGE_ROWS`` distinct rows of a source. Rows that agree in id and text are numbered
where the prefix ends among them.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SEED, materialise, shield, shielded, source_key, table
from .sharding import shuffle_key

WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2
#: Blocks to a source for each output shard, at least; hex digits by which the end of a prefix is narrowed down; rows among which it is then found.
SHARD_BLOCKS, DIGITS, EDGE_ROWS = 32, 2, 50_000
BROADCAST_ROWS = 200_000
#: numpy's limit on the items of one hypergeometric draw.
DRAW_ITEMS = 10**9
#: Sorts after every hex digit, so a source with this bound is taken whole.
ALL = "g"


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: dict[str, int], weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> dict[str, float]:
    """Targets by weight that sum up to ``share`` of all sizes; none is above ``cap`` times its size, and the excess goes to the rest by weight.

    Sources go by code point, the null source (key ``-``) last.
    """
    order = sorted(sizes, key=lambda s: (s == "-", s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    by_room = sorted(order, key=lambda s: (cap * sizes[s] / weight[s], order.index(s)))
    left, heavy, out = share * sum(sizes.values()), sum(weight.values()), {}
    for s in by_room:
        if left / heavy * weight[s] > cap * sizes[s]:
            out[s] = float(cap * sizes[s])
            left -= cap * sizes[s]
            heavy -= weight[s]
        else:
            break
    for s in by_room[len(out) :]:
        out[s] = left / heavy * weight[s]
    return out


def _drawn(rng: np.random.Generator, colours: np.ndarray, n: int) -> np.ndarray:
    """``n`` draws without replacement, by colour: one multivariate hypergeometric draw.

    numpy takes fewer than 10^9 items. More are split into two groups of colours first, whose shares come from the normal
    distribution of the same mean and variance: at such counts it differs from the exact one by less than a draw shows.
    """
    total = int(colours.sum())
    if total < DRAW_ITEMS:
        return rng.multivariate_hypergeometric(colours, n, method="marginals")
    if len(colours) == 1:
        return np.array([n], np.int64)
    half = len(colours) // 2
    a = int(colours[:half].sum())
    share = a / total
    mean, deviation = n * share, math.sqrt(max(0.0, n * share * (1 - share) * ((total - n) / max(1, total - 1))))
    k = min(max(round(rng.normal(mean, deviation)), n - (total - a), 0), a, n)
    return np.concatenate([_drawn(rng, colours[:half], k), _drawn(rng, colours[half:], n - k)])


def splitting_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) block counts whose column sums are ``quotas`` and whose row sums differ by one at most."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(lo: int, hi: int, q: np.ndarray, cut: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = q
            return
        mid = (lo + hi) // 2
        left = _drawn(rng, q, int(cut[mid] - cut[lo])) if len(q) else q
        split(lo, mid, left, cut)
        split(mid, hi, q - left, cut)

    cut = np.arange(shards + 1) * int(quotas.sum()) // shards
    split(0, shards, quotas.astype(np.int64), cut)
    return out


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def sized(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """``df`` with _m_size, _m_src and _m_key (the place in the permutation)."""
    return df.withColumn("_m_size", word_count(text)).withColumn("_m_src", source_key(source)).withColumn("_m_key", shuffle_key(df, doc_id, text, seed))


def _prefix_ends(narrow: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """(_m_src, _m_upto, _m_some): rows whose key is less are taken once more, and so are those with this key: all, or, where it isn't null, ``_m_some`` of them.

    Only rows that agree in id and text share a key. ``sources`` has the words to take (``_m_room``) of each source. The sums of the blocks by the next ``DIGITS`` digits of the key
    show in which block a source's room ends, and only that block goes on.
    """
    before = Window.partitionBy("_m_src").orderBy("_m_next")
    rows, at = narrow.select("_m_src", "_m_key", "_m_size"), sources.select("_m_src", "_m_room", F.lit("").alias("_m_prefix"))
    ends, digits = [], 0
    while True:
        digits += DIGITS
        rows = rows.join(_small(at, n_sources), "_m_src").where(F.col("_m_key").startswith(F.col("_m_prefix"))).drop("_m_prefix", "_m_room")
        rows = materialise(rows, "mixture-edge") if digits > DIGITS else rows
        sums = rows.groupBy("_m_src", F.substring("_m_key", 1, digits).alias("_m_next")).agg(F.sum("_m_size").alias("size"), F.count("*").alias("n"), (F.min("_m_key") < F.max("_m_key")).alias("several"))
        sums = sums.join(_small(at, n_sources), "_m_src")
        sums = materialise(sums.withColumn("_m_before", F.sum("size").over(before) - F.col("size")), "mixture-sums")
        over = sums.where(F.col("_m_before") + F.col("size") > F.col("_m_room"))
        edge = over.groupBy("_m_src").agg(F.min_by(F.struct(F.col("_m_next").alias("_m_prefix"), (F.col("_m_room") - F.col("_m_before")).alias("_m_room"), "n", "several"), "_m_next").alias("e"))
        at = materialise(edge.select("_m_src", "e._m_prefix", "e._m_room", "e.n", "e.several"), "mixture-edges")
        # a source whose room is never passed is taken whole
        ends.append(sums.select("_m_src").distinct().join(at.select("_m_src"), "_m_src", "left_anti").select("_m_src", F.lit(ALL).alias("_m_upto"), F.lit(None).cast("long").alias("_m_some")))
        most = at.where("several").agg(F.max("n")).first()[0] or 0
        at = at.select("_m_src", "_m_room", "_m_prefix")
        if most <= EDGE_ROWS or digits >= 32:
            break
    inside = rows.join(_small(at, n_sources), "_m_src").where(F.col("_m_key").startswith(F.col("_m_prefix")))
    each = inside.groupBy("_m_src", "_m_room", "_m_key").agg(F.sum("_m_size").alias("size"), F.count("*").alias("n"), F.max("_m_size").alias("one"))
    each = each.withColumn("_m_before", F.sum("size").over(Window.partitionBy("_m_src").orderBy("_m_key")) - F.col("size"))
    # a row is taken if half of it at least is within the room
    fits = F.when(F.col("one") > 0, F.floor((F.col("_m_room") - F.col("_m_before")) / F.col("one") + 0.5)).otherwise(F.col("n"))
    each = each.where(F.col("_m_before") + F.col("one") / 2 <= F.col("_m_room")).withColumn("some", F.when(fits < F.col("n"), F.greatest(fits, F.lit(1))).cast("long"))
    last = each.groupBy("_m_src").agg(F.max(F.struct("_m_key", "some")).alias("last"))
    ends.append(at.join(last, "_m_src", "left").select("_m_src", F.coalesce("last._m_key", "_m_prefix").alias("_m_upto"), F.col("last.some").alias("_m_some")))
    out = ends[0]
    for more in ends[1:]:
        out = out.unionByName(more)
    return materialise(out, "mixture-ends")


def _placed(narrow: DataFrame, weights, share: float, cap: float, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(by source: _m_src, _m_source_size, _m_target, _m_whole, _m_upto, _m_some; by block: _m_src, _m_block, _m_at, the shard of each pass), marked to be broadcast if small."""
    spark = narrow.sparkSession
    digits = max(2, math.ceil(math.log(SHARD_BLOCKS * shards, 16)))
    blocks = narrow.groupBy("_m_src", F.substring("_m_key", 1, digits).alias("_m_block")).agg(F.sum("_m_size").alias("size"), F.min("_m_key").alias("least"))
    blocks = materialise(blocks, "mixture-blocks")
    sizes = {r["_m_src"]: r["size"] for r in blocks.groupBy("_m_src").agg(F.sum("size").alias("size")).collect()}
    targets = source_targets(sizes, weights, share, cap)
    plan = []
    for s in sorted(sizes):
        passes = int(targets[s] / sizes[s] + 1e-9) if sizes[s] else 0
        plan.append((s, sizes[s], targets[s], passes, max(0.0, targets[s] - passes * sizes[s]) if sizes[s] else 0.0))
    sources = spark.createDataFrame(plan, "_m_src string, _m_source_size long, _m_target double, _m_whole int, _m_room double")
    ends = _prefix_ends(narrow, sources.where("_m_room > 0"), len(plan))
    by_source = sources.join(ends, "_m_src", "left").select("_m_src", "_m_source_size", "_m_target", "_m_whole", F.coalesce("_m_upto", F.lit("")).alias("_m_upto"), "_m_some")
    by_source = materialise(by_source, "mixture-sources")
    takes = blocks.join(_small(by_source, len(plan)), "_m_src").select("_m_src", "_m_block", (F.col("_m_whole") + F.when(F.col("least") <= F.col("_m_upto"), 1).otherwise(0)).alias("takes")).where("takes > 0")
    takes = materialise(takes, "mixture-takes")
    quota = {r["_m_src"]: r["n"] for r in takes.groupBy("_m_src").agg(F.sum("takes").alias("n")).collect()}
    names = sorted(quota)
    parts = splitting_tree(np.array([quota[s] for s in names], np.int64), shards, np.random.default_rng(seed))
    until = [(s, x) for s, x in zip(names, np.cumsum(parts, axis=0).T.tolist(), strict=True)]
    until = spark.createDataFrame(until, "_m_src string, _m_until array<long>")
    # a source's block takes in a drawn order fill its quotas shard by shard
    drawn = takes.select("_m_src", "_m_block", F.explode(F.sequence(F.lit(0), F.col("takes").cast("int") - 1)).alias("pass"))
    dice = F.md5(F.concat_ws("|", F.lit(f"{seed}-draw"), "_m_src", "_m_block", F.col("pass").cast("string")).cast("binary"))
    drawn = drawn.withColumn("place", F.row_number().over(Window.partitionBy("_m_src").orderBy(dice)) - 1).join(_small(until, len(names)), "_m_src")
    shard = F.size(F.filter("_m_until", lambda n: n <= F.col("place")))
    lists = drawn.groupBy("_m_src", "_m_block").agg(F.transform(F.array_sort(F.collect_list(F.struct("pass", shard.alias("shard")))), lambda x: x["shard"]).alias("_m_at"))
    lists = materialise(lists, "mixture-placed")
    return _small(by_source, len(plan)), _small(lists, lists.count())


def _mixed(rows: DataFrame, narrow: DataFrame, weights, share: float, cap: float, shards: int, seed: int) -> DataFrame:
    """``rows`` (from ``sized``; ``narrow`` are the same rows, written down) with _m_source_size, _m_target, _m_passes and _m_shards."""
    by_source, placed = _placed(narrow, weights, share, cap, shards, seed)
    digits = max(2, math.ceil(math.log(SHARD_BLOCKS * shards, 16)))
    out = rows.withColumn("_m_block", F.substring("_m_key", 1, digits)).join(by_source, "_m_src").join(placed, ["_m_src", "_m_block"], "left")
    out = out.withColumn("_m_once", (F.col("_m_key") <= F.col("_m_upto")).cast("int"))
    if by_source.where("_m_some is not null").limit(1).count():
        cut = F.coalesce((F.col("_m_key") == F.col("_m_upto")) & F.col("_m_some").isNotNull(), F.lit(False))
        out = out.where(~cut).unionByName(_some_of_equal(out.where(cut)))
    out = out.withColumn("_m_passes", F.col("_m_whole") + F.col("_m_once"))
    out = out.withColumn("_m_shards", F.slice(F.coalesce("_m_at", F.array().cast("array<int>")), F.lit(1), F.col("_m_passes")))
    return out.select(*rows.columns, "_m_source_size", "_m_target", "_m_passes", "_m_shards")


def _some_of_equal(rows: DataFrame) -> DataFrame:
    """``rows``, which agree in id and text within each source, with ``_m_once`` 1 for ``_m_some`` of them and 0 for the others.

    They are written down with a number of their own; each is counted within the task that wrote it, and the tasks' counts are summed up, so no task holds all of them.
    """
    held = materialise(rows.withColumn("_m_id", F.monotonically_increasing_id()), "mixture-equal").withColumn("_m_part", F.shiftright("_m_id", 33))
    counts = held.groupBy("_m_src", "_m_part").agg(F.count("*").alias("_m_n"))
    before = counts.select("_m_src", "_m_part", (F.sum("_m_n").over(Window.partitionBy("_m_src").orderBy("_m_part")) - F.col("_m_n")).alias("_m_before"))
    nth = F.row_number().over(Window.partitionBy("_m_src", "_m_part").orderBy("_m_id"))
    numbered = held.withColumn("_m_nth", nth).join(before, ["_m_src", "_m_part"])
    return numbered.withColumn("_m_once", (F.col("_m_before") + F.col("_m_nth") <= F.col("_m_some")).cast("int")).select(*rows.columns)


def mixture(
    df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, share: float = SHARE, cap: float = CAP, shards: int = 8, seed: int = SEED
) -> DataFrame:
    """``df`` with _m_size, _m_key, _m_source_size, _m_target, _m_passes (times the row is taken) and _m_shards (the shard of each pass).

    Size is the count of words between ASCII white space. Null texts have size 0, null sources make one
    source that comes last, null ids are values like others. Of identical rows (id and text) as many are taken as the target has room for. A source whose
    texts are all empty has target 0 and none of its rows is taken. An empty table gives an empty table. A column
    of ``df`` that has one of these names is replaced.
    """
    df = df.drop("_m_size", "_m_key", "_m_source_size", "_m_target", "_m_passes", "_m_shards")
    held, back = shield(df)
    rows = sized(held, doc_id, text, source, seed)
    out = _mixed(rows, materialise(rows.select("_m_src", "_m_key", "_m_size"), "mixture-rows"), weights, share, cap, shards, seed).drop("_m_src")
    return out.withColumnsRenamed(back) if back else out


@shielded
def mixed_rows(df: DataFrame, *, seed: int = SEED, **options) -> DataFrame:
    """The mixture itself: ``df``'s columns, one row for each time a row is taken, with ``mix_shard`` and ``mix_order`` (the shuffle in the shard)."""
    taken = mixture(df, seed=seed, **options)
    out = taken.select(*df.columns, "_m_key", F.posexplode("_m_shards").alias("_m_pass", "mix_shard"))
    return out.withColumn("mix_order", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_m_pass").cast("string"), F.col("_m_key")).cast("binary"))).select(*df.columns, "mix_shard", "mix_order")


def write_mixture(df: DataFrame, path: str, files: int = 16, **options) -> None:
    """One folder for each shard, of Parquet files that hold its rows in the shuffled order: the rows are cut into ranges, about ``files`` of them to a shard."""
    rows, shards = mixed_rows(df, **options), options.get("shards", 8)
    rows.repartitionByRange(files * shards, "mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order").write.partitionBy("mix_shard").parquet(path)


def op10_source_mixture(spark, sf_dir: str) -> DataFrame:
    """Texts are read once: what the mixture needs of a row is written down first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    narrow = materialise(sized(docs).drop("text"), "mixture-rows")
    mixed = _mixed(narrow, narrow, WEIGHTS, SHARE, CAP, 8, SEED)
    return mixed.select(
        "doc_id",
        F.col("_m_size").alias("size"),
        F.col("_m_source_size").alias("source_size"),
        F.col("_m_target").alias("target"),
        (F.col("_m_size") * F.col("_m_passes")).cast("long").alias("taken"),
        "source",
        F.col("_m_shards").alias("shards"),
    )


def mixture_taken(spark, sf_dir: str) -> DataFrame:
    """What the mixture takes of each document, without the drawn shards, so that SQL can express it."""
    return op10_source_mixture(spark, sf_dir).drop("shards")
