"""Coordinates: lookup by query text, backfill of missing coordinates, sanity box.

The coordinate table ``(query, lat, lon)`` replaces the geocoder and its cache: a row
with a NULL pair is a cached miss. Joins carry no hint: Spark broadcasts the table where its size
allows and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letwise import constants as K
from letwise import functions as LF
from letwise.operators.dedup import latest_per_key


def one_per_query(geo: DataFrame) -> DataFrame:
    """One row per query text, so that a lookup never multiplies rows. A hit goes before a cached miss,
    then the greatest pair; rows without a query are dropped."""
    return latest_per_key(geo.where(F.col("query").isNotNull()).select(
        "query", (F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("_hit"), "lat", "lon"),
        ["query"], ["_hit", "lat", "lon"]).drop("_hit")


def lookup_coordinates(df: DataFrame, query_col: str, geo: DataFrame) -> DataFrame:
    """Add ``latitude``/``longitude`` from the coordinate table; a blank query or a
    miss gives a NULL pair. Rows stay one to one."""
    g = one_per_query(geo).select(F.col("query").alias("_q"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    j = df.join(g, (df[query_col] == g["_q"]) & (df[query_col] != ""), "left")
    return j.withColumn("latitude", F.col("_lat")).withColumn("longitude", F.col("_lon")) \
            .drop("_q", "_lat", "_lon")


def missing_coordinates() -> F.Column:
    """Either coordinate missing."""
    return F.col("latitude").isNull() | F.col("longitude").isNull()


def _candidates(region, state, country: str = K.COUNTRY):
    """J4 query texts: ``'region, state, country'`` when both are present, and
    ``'state, country'`` when the state is present; NULL otherwise. Parts are used as
    stored (not trimmed); presence is Python truthiness (``''`` = missing)."""
    both = LF.is_present(region) & LF.is_present(state)
    q1 = F.when(both, F.concat_ws(", ", region, state, F.lit(country)))
    q2 = F.when(LF.is_present(state), F.concat_ws(", ", state, F.lit(country)))
    return q1, q2


def backfill_coordinates(table: DataFrame, geo: DataFrame) -> DataFrame:
    """M2: fill both coordinates of rows where either is missing, from the first hit of
    the fallback chain (region+state, then state). Rows without a state are never filled.

    Only rows with a missing coordinate move: their distinct (region, state) pairs (D3) are resolved against
    the coordinate table (J4) and joined back to them, NULL equal to NULL (J5). All other rows pass by.
    """
    pairs = resolve_pairs(table, geo)
    p = pairs.select(F.col("region").alias("_pr"), F.col("state").alias("_ps"),
                     F.col("lat").alias("_plat"), F.col("lon").alias("_plon"))
    lacking = table.where(missing_coordinates())
    j = lacking.join(p, lacking["region"].eqNullSafe(p["_pr"]) & lacking["state"].eqNullSafe(p["_ps"]), "left")
    hit = F.col("_plat").isNotNull()
    filled = (j.withColumn("latitude", F.when(hit, F.col("_plat")).otherwise(F.col("latitude")))
              .withColumn("longitude", F.when(hit, F.col("_plon")).otherwise(F.col("longitude")))
              .select(*table.columns))
    return table.where(~missing_coordinates()).unionByName(filled)


def pairs_to_fill(table: DataFrame) -> DataFrame:
    """D3: distinct (region, state) of rows with a missing coordinate."""
    return table.where(missing_coordinates()).select("region", "state").distinct()


def resolve_pairs(table: DataFrame, geo: DataFrame) -> DataFrame:
    """For each pair to fill, the first hit of the fallback chain; pairs with no hit
    are dropped (they stay missing). Output ``(region, state, lat, lon)``."""
    pairs = pairs_to_fill(table)
    geo = one_per_query(geo.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()))
    q1, q2 = _candidates(F.col("region"), F.col("state"))
    pq = pairs.withColumn("_q1", q1).withColumn("_q2", q2)
    g1 = geo.select(F.col("query").alias("_g1q"), F.col("lat").alias("_lat1"), F.col("lon").alias("_lon1"))
    g2 = geo.select(F.col("query").alias("_g2q"), F.col("lat").alias("_lat2"), F.col("lon").alias("_lon2"))
    j = pq.join(g1, pq["_q1"] == g1["_g1q"], "left").join(g2, pq["_q2"] == g2["_g2q"], "left")
    use1 = F.col("_lat1").isNotNull()
    return j.select(
        "region", "state",
        F.when(use1, F.col("_lat1")).otherwise(F.col("_lat2")).alias("lat"),
        F.when(use1, F.col("_lon1")).otherwise(F.col("_lon2")).alias("lon"),
    ).where(F.col("lat").isNotNull())


def bbox_report(table: DataFrame, by=("state",), lat_range=K.BBOX_LAT, lon_range=K.BBOX_LON) -> DataFrame:
    """Per group, rows with coordinates, rows outside the box, rows missing them."""
    has = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    inside = F.col("latitude").between(*lat_range) & F.col("longitude").between(*lon_range)
    return table.groupBy(*by).agg(
        F.count(F.when(has, 1)).alias("n_with_coords"),
        F.count(F.when(has & ~inside, 1)).alias("n_outside"),
        F.count(F.when(~has, 1)).alias("n_missing"),
    )
