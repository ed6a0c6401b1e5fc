"""Places to coordinates and flags, by broadcast lookups of small tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..shipping import ship

#: Fixed value: seconds between two requests to the geocoding service.
REQUEST_DELAY = 1.1

# Other spellings of country names.
ALIASES = {
    "united kingdom": "UK", "great britain": "UK", "england": "UK",
    "united states": "USA", "us": "USA", "czech republic": "Czechia",
    "eu": "Europe", "european union": "Europe", "türkiye": "Turkey",
}
GLOBE = "🌍"


def place_key(col: Column) -> Column:
    return F.lower(strip(F.coalesce(col, F.lit(""))))


def resolve_places(rows: DataFrame, cache: DataFrame, centroids: DataFrame, api: DataFrame | None = None) -> DataFrame:
    """Coordinates from the cache, else an external answer, else the country's centroid; ``resolved_by`` names which.

    ``rows``: place_name, country_iso; ``cache`` and ``api``: place_name, latitude, longitude; ``centroids``: iso, lat, lon.
    Left joins on unique keys; Spark broadcasts the small tables by their size.
    """
    out = rows.withColumn("_place", place_key(F.col("place_name"))).withColumn("_iso", F.upper(strip(F.coalesce(F.col("country_iso"), F.lit("")))))
    known = cache.select(place_key(F.col("place_name")).alias("_place"), F.col("latitude").alias("_lat1"), F.col("longitude").alias("_lon1")).where("_place <> ''")
    out = out.join(known, "_place", "left")
    if api is not None:
        found = api.select(place_key(F.col("place_name")).alias("_place"), F.col("latitude").alias("_lat2"), F.col("longitude").alias("_lon2"))
        out = out.join(found, "_place", "left")
    else:
        out = out.withColumn("_lat2", F.lit(None).cast("double")).withColumn("_lon2", F.lit(None).cast("double"))
    out = out.join(centroids.select(F.upper("iso").alias("_iso"), "lat", "lon"), "_iso", "left")
    by = F.when(F.col("_lat1").isNotNull(), "cache").when(F.col("_lat2").isNotNull(), "api").when(F.col("lat").isNotNull(), "centroid")
    return out.select(
        *rows.columns, F.coalesce("_lat1", "_lat2", "lat").alias("latitude"), F.coalesce("_lon1", "_lon2", "lon").alias("longitude"), by.alias("resolved_by")
    )


def places_to_ask(rows: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct places that the cache lacks: what a rate-limited service has to be asked."""
    wanted = rows.select(place_key(F.col("place_name")).alias("place_name")).where("place_name <> ''").distinct()
    return wanted.join(cache.select(place_key(F.col("place_name")).alias("place_name")), "place_name", "left_anti")


def ask_places(places: DataFrame, ask: Callable[[str], tuple[float, float] | None], delay: float = REQUEST_DELAY) -> DataFrame:
    """place_name, latitude, longitude of the places that the service knows; asked one after the other, ``delay`` seconds apart, as its terms want."""
    ship(places.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = -delay
        for batch in batches:
            out = []
            for name in batch["place_name"]:
                time.sleep(max(0.0, last + delay - time.monotonic()) if last >= 0 else 0.0)
                last = time.monotonic()
                try:
                    found = ask(name)
                except Exception:  # noqa: BLE001 - an unanswered place falls to the centroid
                    found = None
                if found is not None:
                    out.append((name, float(found[0]), float(found[1])))
            yield pd.DataFrame(out, columns=["place_name", "latitude", "longitude"])

    # one caller, or the rate would be that of every task
    return places.select("place_name").coalesce(1).mapInPandas(run, "place_name string, latitude double, longitude double")


def country_flags(rows: DataFrame, flags: DataFrame, name: str = "country") -> DataFrame:
    """``flag`` for a country's name: as it is, by alias, whatever the case; a globe for Global, empty if unknown."""
    clean = strip(F.coalesce(F.col(name), F.lit("")))
    alias = F.lit(None).cast("string")
    for k, v in ALIASES.items():
        alias = F.when(F.lower(clean) == k, F.lit(v)).otherwise(alias)
    keyed = rows.withColumn("_key", F.lower(F.coalesce(alias, clean)))
    found = flags.select(F.lower("name").alias("_key"), F.col("flag").alias("_flag"))
    out = keyed.join(found, "_key", "left")
    return out.select(*rows.columns, F.when(F.lower(clean) == "global", F.lit(GLOBE)).otherwise(F.coalesce("_flag", F.lit(""))).alias("flag"))
