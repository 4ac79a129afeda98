"""Queries of the distance and trade-area operators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tallyloom.functions import geo as gfx
from tallyloom.operators import geo as gx, joins
from tallyloom.plans import retail
from tallyloom.registry import query
from tallyloom.registry.sql import GEO, PAIRS, PLACED, sql
from tallyloom.sources import model

NEAREST = f"""{PAIRS}, nearest AS (
  SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY original_customerid ORDER BY miles, storeid) = 1)"""


def _six(name: str, source=None):
    return F.round((F.col(source or name)).cast("decimal(28,8)"), 5).alias(name)


@query("make_points", sql(PLACED, "SELECT original_customerid, lat AS point_lat, lon AS point_lon FROM placed"))
def make_points(spark, d):
    df = gx.with_point(model.geocoded_customers(spark, d))
    return df.select(
        "original_customerid", F.col("Centroid.lat").alias("point_lat"), F.col("Centroid.lon").alias("point_lon")
    )


@query("parse_wkt", sql(GEO, "SELECT locationid, location, latitude AS lat, longitude AS lon FROM geo_text"))
def parse_wkt(spark, d):
    return gx.parse_wkt_point(model.geolocation(spark, d).select("locationid", "location"), "location")


def _home(spark, d):
    """Each customer with the store of their own nation."""
    stores = model.stores(spark, d).withColumnRenamed("storeid", "homestore")
    return model.geocoded_customers(spark, d).join(stores, "homestore")


@query(
    "store_distance",
    sql(
        PAIRS,
        """SELECT original_customerid, homestore, round(miles::DECIMAL(28,8), 5) AS miles FROM pairs WHERE storeid = homestore""",
        d="miles",
    ),
)
def store_distance(spark, d):
    miles = gfx.distance_miles("store_lat", "store_lon", "lat", "lon")
    return _home(spark, d).withColumn("m", miles).select("original_customerid", "homestore", _six("miles", "m"))


@query(
    "store_direction",
    sql(PAIRS, "SELECT original_customerid, homestore, direction FROM pairs WHERE storeid = homestore"),
)
def store_direction(spark, d):
    way = gfx.cardinal("store_lat", "store_lon", "lat", "lon").alias("direction")
    return _home(spark, d).select("original_customerid", "homestore", way)


@query(
    "customer_store_distances",
    sql(
        PAIRS,
        """SELECT original_customerid, count(*) AS stores, round(min(miles)::DECIMAL(28,8), 5) AS nearest,
  round(max(miles)::DECIMAL(28,8), 5) AS farthest, arg_min_null(direction, miles) AS nearest_direction FROM pairs GROUP BY 1""",
        d="nearest, farthest",
    ),
)
def customer_store_distances(spark, d):
    """How many stores there are, the nearest with its direction, and the farthest: the one nearest to the far side of the globe."""
    people, stores = model.geocoded_customers(spark, d), model.stores(spark, d)
    near = gx.nearest_store(people, stores).join(stores, "storeid")
    way = gfx.cardinal("store_lat", "store_lon", "lat", "lon").alias("nearest_direction")
    near = near.select("original_customerid", "Min_DistanceMiles", way)
    far_side = people.select("original_customerid", (-F.col("lat")).alias("lat"), F.when(F.col("lon") > 0, F.col("lon") - 180.0).otherwise(F.col("lon") + 180.0).alias("lon"))
    far = gx.nearest_store(far_side, stores).select("original_customerid", (math.pi * gfx.EARTH_RADIUS_MILES - F.col("Min_DistanceMiles")).alias("f"))
    both = joins.append_fields(near.join(far, "original_customerid"), stores.agg(F.count("*").alias("stores")))
    return both.select("original_customerid", "stores", _six("nearest", "Min_DistanceMiles"), _six("farthest", "f"), "nearest_direction")


@query(
    "trade_area_members",
    sql(
        PAIRS,
        """SELECT original_customerid, storeid, round(miles::DECIMAL(28,8), 5) AS miles FROM pairs WHERE miles <= 5""",
        d="miles",
    ),
)
def trade_area_members(spark, d):
    near = gx.within_radius(model.geocoded_customers(spark, d), model.stores(spark, d), 5.0)
    return near.select("original_customerid", "storeid", _six("miles", "DistanceMiles"))


@query(
    "nearest_store",
    sql(
        NEAREST,
        'SELECT original_customerid, storeid, round(miles::DECIMAL(28,8), 5) AS "Min_DistanceMiles" FROM nearest',
        d="Min_DistanceMiles",
    ),
)
def nearest_store(spark, d):
    near = gx.nearest_store(model.geocoded_customers(spark, d), model.stores(spark, d))
    return near.select("original_customerid", "storeid", _six("Min_DistanceMiles"))


@query(
    "trade_area_summary",
    sql(
        NEAREST + """, near AS (
  SELECT p.original_customerid, p.storeid, radians(latitude) AS a, radians(longitude) AS o, latitude::DECIMAL(9,5) AS y, longitude::DECIMAL(9,5) AS x
  FROM pairs p JOIN geo ON locationid = p.storeid WHERE miles <= 5),
middle AS (SELECT original_customerid, avg(cos(a) * cos(o)) AS mx, avg(cos(a) * sin(o)) AS my, avg(sin(a)) AS mz FROM near GROUP BY 1),
points AS (SELECT original_customerid, 'MULTIPOINT(' || string_agg(x || ' ' || y, ', ' ORDER BY x, y) || ')' AS area
  FROM (SELECT DISTINCT original_customerid, x, y FROM near) GROUP BY 1),
covering AS (
  SELECT original_customerid, string_agg(storeid::VARCHAR, ',' ORDER BY storeid) AS s FROM near GROUP BY 1)""",
        """SELECT n.original_customerid, storeid, round(miles::DECIMAL(28,8), 5) AS "Min_DistanceMiles", s AS "CoveringStores",
  round(degrees(atan2(mz, sqrt(mx * mx + my * my)))::DECIMAL(28,8), 5) AS "CentroidLat",
  round(degrees(atan2(my, mx))::DECIMAL(28,8), 5) AS "CentroidLon", area AS "CombinedArea", 5.0 AS "RadiusSize"
  FROM nearest n LEFT JOIN covering c ON n.original_customerid = c.original_customerid
  LEFT JOIN middle m ON n.original_customerid = m.original_customerid LEFT JOIN points p ON n.original_customerid = p.original_customerid""",
        d="Min_DistanceMiles, CentroidLat, CentroidLon, RadiusSize",
    ),
)
def trade_area_summary(spark, d):
    out = retail.trade_area_summary(model.geocoded_customers(spark, d), model.stores(spark, d), "original_customerid")
    stores = F.array_join("CoveringStores", ",").alias("CoveringStores")
    middle = [_six("CentroidLat"), _six("CentroidLon")]
    return out.select("original_customerid", "storeid", _six("Min_DistanceMiles"), stores, *middle, "CombinedArea", "RadiusSize")


@query(
    "trade_area_buckets",
    sql(
        NEAREST,
        """SELECT CASE WHEN miles >= 5 THEN ' > 5 Miles' ELSE ' < 5 Miles' END AS "Greater or Less Than 5 Miles",
  count(DISTINCT original_customerid) AS "Customers" FROM nearest GROUP BY 1""",
    ),
)
def trade_area_buckets(spark, d):
    return retail.trade_area_buckets(model.geocoded_customers(spark, d), model.stores(spark, d))
