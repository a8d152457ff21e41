"""Great-circle distance [K8, H19]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revisio.schema import EARTH_RADIUS_KM, RADIUS_KM, SITES


def haversine_km(lat: Column, lon: Column, site_lat: Column, site_lon: Column) -> Column:
    """Kilometres; NULL when both coordinates are NULL. The guard comes first, since least and greatest skip NULLs.

    Half a coordinate pair is an error of the data and fails the query.
    """
    dlat, dlon = F.radians(site_lat - lat), F.radians(site_lon - lon)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat)) * F.cos(F.radians(site_lat)) * F.pow(F.sin(dlon / 2), 2)
    distance = F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), h))))
    half = F.raise_error(F.lit("a coordinate pair is half null")).cast("double")
    return F.when(lat.isNull() & lon.isNull(), F.lit(None).cast("double")).when(lat.isNull() | lon.isNull(), half).otherwise(distance)


def sites(spark: SparkSession, radius_km: float = RADIUS_KM) -> DataFrame:
    return spark.createDataFrame([(k, n, la, lo, radius_km) for k, n, la, lo in SITES], "site_key string, site_name string, site_latitude double, site_longitude double, radius_km double")


def measured(facts: DataFrame, radius_km: float = RADIUS_KM) -> DataFrame:
    """Each row with each configured site, its distance and whether it is inside. The sites are a constant of three rows."""
    pairs = facts.crossJoin(F.broadcast(sites(facts.sparkSession, radius_km).drop("site_name")))
    far = haversine_km(F.col("latitude"), F.col("longitude"), F.col("site_latitude"), F.col("site_longitude"))
    return pairs.withColumn("epicentral_distance_km", far).withColumn("within_radius", F.col("epicentral_distance_km") <= F.col("radius_km")).drop("site_latitude", "site_longitude", "radius_km")


def bridge(facts: DataFrame, radius_km: float = RADIUS_KM) -> DataFrame:
    """Each revision with each configured site [C9, K10]."""
    slim = facts.select("canonical_event_id", "source_updated_at", "payload_hash", "latitude", "longitude")
    return measured(slim, radius_km).select("canonical_event_id", "source_updated_at", "payload_hash", "site_key", "epicentral_distance_km", "within_radius")
