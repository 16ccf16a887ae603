"""City coordinates and distance filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlink import refdata
from leadlink.functions import text as T

EARTH_KM = 6371.0


def locate(cities: DataFrame, geocoded: DataFrame, spark: SparkSession) -> DataFrame:
    """Coordinates from the geocoder's answers, else from the local table; status tells which."""
    key = T.strip(F.lower(T.text(F.col("city"))))
    g = geocoded.select(F.col("city"), F.col("lat").alias("_la"), F.col("lon").alias("_lo"))
    local = F.broadcast(refdata.gazetteer(spark).select("city_key", F.col("lat").alias("_lb"), F.col("lon").alias("_lc")))
    j = cities.join(g, "city", "left").withColumn("city_key", key).join(local, "city_key", "left")
    status = F.when(F.col("_la").isNotNull(), "geocoded").when(F.col("_lb").isNotNull(), "local table").otherwise("unknown city")
    return j.select(*cities.columns, F.coalesce("_la", "_lb").alias("lat"), F.coalesce("_lo", "_lc").alias("lon"), status.alias("status"))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2
    )
    return 2 * EARTH_KM * F.asin(F.sqrt(a))


def within_radius(rows: DataFrame, centres: DataFrame, key: str = "city") -> DataFrame:
    """Rows within radius_km of their search centre; a centre with radius 0 and no rows uses 1 km.

    rows: key, lat, lon. centres: key, clat, clon, radius_km (one row per search).
    """
    j = rows.join(centres, key).withColumn("km", distance_km(F.col("clat"), F.col("clon"), F.col("lat"), F.col("lon")))
    near = j.where(F.col("km") <= F.greatest(F.col("radius_km"), F.when(F.col("radius_km") == 0, 1).otherwise(0)))
    hit = near.groupBy(key).agg(F.count_if(F.col("km") <= F.col("radius_km")).alias("_n"))
    return near.join(hit, key).where((F.col("km") <= F.col("radius_km")) | (F.col("_n") == 0)).drop("_n")
