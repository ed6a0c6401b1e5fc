"""Country by commodity matrices over a long fact table with revisions.

One aggregation over the facts replaces a scan for each cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_revision(facts: DataFrame, keys: list[str], value: str = "Value", revision: str = "Month") -> DataFrame:
    """The value of the last revision for each key; a null value there stays null. Ties go to the first row by ``seq`` if there is one."""
    order = F.struct(F.col(revision).alias("r"), (-F.col("seq")).alias("s")) if "seq" in facts.columns else F.col(revision)
    return facts.groupBy(*keys).agg(F.max_by(value, order).alias("value"), F.max(revision).alias("revision"))


def percent_change(now: Column, before: Column, digits: int | None = 1) -> Column:
    """Change in percent where both are there and the earlier is above 0."""
    raw = F.when(now.isNotNull() & (before > 0), (now - before) / before * 100)
    return raw if digits is None else F.round(raw, digits)


def year_on_year(latest: DataFrame, keys: list[str], year: int, year_col: str = "Market_Year") -> DataFrame:
    """Value of ``year`` and its change against the year before, in one pass without a self-join; keys without a value in ``year`` go."""
    out = latest.where(F.col(year_col).isin(year, year - 1)).groupBy(*keys).agg(
        F.max(F.when(F.col(year_col) == year, F.col("value"))).alias("value"), F.max(F.when(F.col(year_col) == year - 1, F.col("value"))).alias("previous")
    )
    return out.where("value is not null").withColumn("yoy_pct", percent_change(F.col("value"), F.col("previous")))


def year_on_year_all(latest: DataFrame, keys: list[str], year_col: str = "Market_Year") -> DataFrame:
    """Change against the year before for every year; a gap gives null, not the change over the gap."""
    order = Window.partitionBy(*keys).orderBy(year_col)
    before = F.when(F.lag(year_col).over(order) == F.col(year_col) - 1, F.lag("value").over(order))
    return latest.withColumn("yoy_pct", percent_change(F.col("value"), before))


def latest_period(facts: DataFrame) -> DataFrame:
    """One row: the latest year, and the latest month within it."""
    year = facts.agg(F.max("Market_Year").alias("latest_year"), F.max(F.struct("Market_Year", "Month")).alias("p"))
    return year.select("latest_year", F.col("p.Month").alias("latest_month"))


def matrix_long(latest: DataFrame, countries: DataFrame, crops: DataFrame, year: int) -> DataFrame:
    """The dense grid of declared countries and crops with value and change; countries without any value go.

    ``countries``: ord, name, region; ``crops``: pos, crop. Both are configuration, so the grid is small; facts are aggregated first.
    """
    cells = year_on_year(latest.select(F.col("Country").alias("name"), F.col("Commodity").alias("crop"), "Market_Year", "value"), ["name", "crop"], year)
    grid = countries.select("ord", "name", "region").crossJoin(crops)
    full = grid.join(cells, ["name", "crop"], "left")
    return full.withColumn("_n", F.count("value").over(Window.partitionBy("name"))).where("_n > 0").drop("_n", "previous")


def matrices(latest: DataFrame, countries: DataFrame, crops: DataFrame, year: int) -> DataFrame:
    """All matrices in one pass, long: those of ``crops`` (pos, crop, family), whole (``all``) and by family, for each ``metric`` of ``latest``.

    Columns matrix (metric and family), name, region, ord, crop, pos, value, yoy_pct; a country without any value in a matrix is not in it.
    """
    keys = ["metric", "name", "crop"]
    cells = year_on_year(latest.select("metric", F.col("Country").alias("name"), F.col("Commodity").alias("crop"), "Market_Year", "value"), keys, year).drop("previous")
    cuts = crops.select("pos", "crop", F.explode(F.array(F.lit("all"), F.col("family"))).alias("cut"))
    metrics = latest.select("metric").distinct()
    grid = countries.select("ord", "name", "region").crossJoin(cuts).crossJoin(metrics)  # all of it is configuration
    full = grid.join(cells, keys, "left").withColumn("matrix", F.concat_ws("_", "metric", "cut"))
    return full.withColumn("_n", F.count("value").over(Window.partitionBy("matrix", "name"))).where("_n > 0").drop("_n", "metric", "cut")


def matrix_wide(long: DataFrame, crops: list[str]) -> DataFrame:
    """One row for each country, a value and a change column for each crop."""
    return long.groupBy("ord", "name", "region").pivot("crop", crops).agg(F.first("value").alias("value"), F.first("yoy_pct").alias("yoy_pct"))


def region_bands(countries: DataFrame) -> DataFrame:
    """``new_band``: the region differs from that of the row before, in declared order."""
    before = F.lag("region").over(Window.orderBy("ord"))
    return countries.withColumn("new_band", ~F.col("region").eqNullSafe(before) | (F.row_number().over(Window.orderBy("ord")) == 1))


def routed_dataset(eu_member: Column, metric: Column) -> Column:
    """The dataset that feeds a cell: area of members comes from the union's own, the rest from the global one."""
    return F.when(eu_member & (metric == "area"), F.lit("union_area")).otherwise(F.lit("global"))


def is_new_release(latest_year: Column, latest_month: Column, known_year: Column, known_month: Column) -> Column:
    """The period differs from the known one, years counted too; nothing known, nothing new."""
    known = known_year.isNotNull() & known_month.isNotNull()
    return known & ((latest_year != known_year) | (latest_month != known_month))


def pivot_top(rows: DataFrame, *, group: str, variable: str, value: str, order_by: str, variables: list[str], limit: int = 6) -> DataFrame:
    """Variables as columns for each group; the groups with the most of one of them (missing: 0) come first."""
    wide = rows.groupBy(group).pivot(variable, variables).agg(F.max(value))
    return wide.orderBy(F.coalesce(order_by, F.lit(0)).desc(), F.asc(group)).limit(limit)
