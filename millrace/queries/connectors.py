"""Data sources and sinks of the library's own: paged tables, feeds as a stream, zipped cubes, the archive in two phases."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ..plans import adapters as A
from ..sinks import two_phase
from ..shipping import ship
from ..sources import config, paged, zips
from ..sources.folders import shared_path
from ..streaming import feed_log
from .registry import ORACLE_SQL, query
from .scans import _page


@query("config_paged", ORACLE_SQL["config_companies"])
def config_paged(spark, sf_dir):
    """Companies out of pages of 100, beside the pages of another table that the filter leaves unread."""
    k, path = F.col("c_custkey"), A.scratch(spark, "pages")
    page = _page(("Company Name", "title", F.col("c_name")), ("Type", "select", F.when(k % 2 == 0, "Client").otherwise("Partner")), ("Search Keywords", "rich_text", F.concat(F.lit("seeds "), k.cast("string"))), ("Enabled", "checkbox", F.col("c_acctbal") > 0), ("Priority", "select", F.when(k % 3 == 0, "high")))
    paged.write_pages(A.table(spark, sf_dir, "customer").select(page, "c_custkey"), "companies", F.floor(k / 100), path)
    nations = A.table(spark, sf_dir, "nation").select(F.to_json(F.struct("n_name")).alias("json"))
    paged.write_pages(nations, "countries", F.lit(0), path)
    return config.company_rows(paged.read_paged(spark, path=path).where("table = 'companies'"))


def _landed(spark, sf_dir, polls: list[int]):
    """The documents of each source as feed bodies, dealt out over three polls."""
    xml = F.format_string("<item><title>No %d</title><link>https://x.example/%d</link><pubDate>%d chars</pubDate></item>", "doc_id", "doc_id", F.length(F.coalesce("text", F.lit(""))))
    docs = A.table(spark, sf_dir, "documents").where("source is not null").withColumn("poll", (F.col("doc_id") % 3 + 1).cast("int")).where(F.col("poll").isin(polls))
    items = docs.groupBy("source", "poll").agg(F.array_sort(F.collect_list(F.struct("doc_id", xml.alias("xml")))).alias("items"))
    return items.select("source", "poll", F.concat(F.lit("<rss><channel>"), F.array_join(F.transform("items", lambda x: x["xml"]), ""), F.lit("</channel></rss>")).alias("body"))


@query(
    "feed_stream",
    "SELECT source, CAST(doc_id % 3 + 1 AS BIGINT) AS poll, CAST(row_number() OVER (PARTITION BY source, doc_id % 3 ORDER BY doc_id) - 1 AS INTEGER) AS pos, 'No ' || doc_id AS title, 'https://x.example/' || doc_id AS link, length(coalesce(text, '')) || ' chars' AS published FROM documents WHERE source IS NOT NULL",
)
def feed_stream(spark, sf_dir):
    """Two polls read by one run of a stream, the third by a run that starts where the first left off."""
    path = A.scratch(spark, "feeds")
    for polls in ([1, 2], [3]):
        feed_log.land(_landed(spark, sf_dir, polls), f"{path}/log")
        entries = feed_log.read_feed_log(spark, f"{path}/log")
        entries.writeStream.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).format("parquet").start(f"{path}/entries").awaitTermination()
    return spark.read.parquet(f"{path}/entries").select("source", "poll", "pos", "title", "link", "published")


@query(
    "archive_commits",
    """WITH r AS (SELECT o_custkey AS c, o_orderkey AS k, CAST(o_orderpriority AS VARCHAR) AS p FROM orders), a AS (SELECT c, arg_min(k, k) AS k FROM r WHERE k % 2 = 0 GROUP BY c),
    b AS (SELECT c, min(k) AS k FROM r WHERE k % 3 = 0 AND c NOT IN (SELECT c FROM a) GROUP BY c)
    SELECT 'c' || c AS id, k AS "order", 'first' AS run, (SELECT count(*) FROM a) AS ok FROM a UNION ALL SELECT 'c' || c, k, 'second', (SELECT count(*) FROM b) FROM b""",
)
def archive_commits(spark, sf_dir):
    """Two runs, the second written twice under its name: it adds only customers that the first didn't hold, and counts once."""
    path, orders = A.scratch(spark, "archive"), A.table(spark, sf_dir, "orders")
    schema = "id string, `order` long"
    for run, step in (("first", 2), ("second", 3), ("second", 3)):
        rows = orders.where(F.col("o_orderkey") % step == 0).select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("id"), F.col("o_orderkey").alias("order"))
        two_phase.write_archive(two_phase.new_rows(rows, two_phase.read_archive(spark, path, schema), "order"), run, path=path)
    return two_phase.read_archive(spark, path, schema).join(F.broadcast(two_phase.run_counts(spark, path)), "run").select("id", "order", "run", "ok")


@query("zipped_members", "SELECT o_orderkey AS \"Order\", CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS \"Customer\", CAST(o_orderstatus AS VARCHAR) AS \"Status\", CAST(NULL AS INTEGER) AS \"None\" FROM orders")
def zipped_members(spark, sf_dir):
    """A zip for each priority with a CSV member for each status; members order their columns differently, some cells are empty, names are quoted."""
    path = A.scratch(spark, "zips")
    ship(spark)

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        folder = shared_path(path)
        folder.mkdir(parents=True, exist_ok=True)
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for n, (status, part) in enumerate(rows.groupby("status")):
                lines = [f'{o},"{status}",{"" if o % 7 == 0 else c}' if n % 2 else f'{"" if o % 7 == 0 else c},{o},{status}' for o, c in zip(part["o"], part["c"], strict=True)]
                z.writestr(f"{status}.CSV", "\n".join(["Order,Status,Customer" if n % 2 else " Customer ,Order,Status", *lines]))
            z.writestr("notes.txt", "not a table")
        (folder / f"{abs(hash(key))}.zip").write_bytes(out.getvalue())
        return pd.DataFrame({"n": [len(rows)]})

    orders = A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("o"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("status"), "o_orderpriority")
    orders.groupBy("o_orderpriority").applyInPandas(write, "n long").collect()
    return zips.read_facts(spark, path, "`Order` long, Customer long, Status string, None int")
