"""Store distance, trade areas and the nearest store.

Stores carry ``storeid, store_lat, store_lon``; customers carry ``lat, lon``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyloom.functions import geo
from tallyloom.session import checkpointed

# Sizes of the nested grid cells of the nearest-store search; each divides the one before it.
GRID_DEGREES = (30.0, 6.0, 1.0, 0.125)


def with_point(df: DataFrame, lat: str = "lat", lon: str = "lon", name: str = "Centroid") -> DataFrame:
    return df.withColumn(name, geo.point(lat, lon))


def parse_wkt_point(df: DataFrame, col: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return df.withColumns({lat: geo.wkt_latitude(col), lon: geo.wkt_longitude(col)})


def within_radius(customers: DataFrame, stores: DataFrame, miles: float = 5.0) -> DataFrame:
    """(customer, store) rows that lie within the radius, with ``DistanceMiles``.

    A store is repeated for each grid cell its circle touches, a customer sits in one cell, and the
    two meet by equality on the cell; only then is the distance checked.
    """
    reach = miles / geo.EARTH_RADIUS_MILES  # radians
    step = max(math.degrees(reach), 1e-6)
    columns = max(int(360 // step), 1)
    width, height = 360.0 / columns, step
    margin = 1e-9

    lat, lon = F.col("store_lat"), F.col("store_lon")
    south, north = lat - math.degrees(reach) - margin, lat + math.degrees(reach) + margin
    # Longitude span of a circle; every meridian once it holds a pole.
    sine = F.lit(math.sin(min(reach, math.pi / 2))) / F.cos(F.radians(lat))
    span = F.when((south <= -90) | (north >= 90), F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(sine, F.lit(1.0)))) + margin
    )
    west, east = _cell(lon - span + 180.0, width), _cell(lon + span + 180.0, width)
    rows = F.sequence(_cell(south, height), _cell(north, height))
    cols = F.when(east - west >= columns - 1, F.sequence(F.lit(0).cast("bigint"), F.lit(columns - 1).cast("bigint")))
    cols = cols.otherwise(F.sequence(west, F.greatest(east, west)))
    cells = stores.filter(geo.valid_lat_lon("store_lat", "store_lon")).select("*", F.explode(rows).alias("__y"))
    cells = cells.select("*", F.explode(cols).alias("__x0"))
    cells = cells.withColumn("__x", F.pmod("__x0", F.lit(columns))).drop("__x0")

    placed = customers.filter(geo.valid_lat_lon("lat", "lon")).withColumns(
        {
            "__y": _cell(F.col("lat"), height),
            "__x": F.pmod(_cell(F.col("lon") + 180.0, width), F.lit(columns)),
        }
    )
    distance = geo.distance_miles("store_lat", "store_lon", "lat", "lon")
    met = placed.join(cells, ["__y", "__x"]).drop("__y", "__x")
    return met.withColumn("DistanceMiles", distance).filter(F.col("DistanceMiles") <= miles)


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("bigint")


def _grid(lat: Column, lon: Column, size: float) -> tuple[Column, Column]:
    """Row and column of the grid cell of ``size`` degrees; the north pole and the date line belong to the last one."""
    y = F.least(F.floor((lat + 90.0) / size), F.lit(round(180 / size) - 1))
    return y.cast("int"), F.least(F.floor((lon + 180.0) / size), F.lit(round(360 / size) - 1)).cast("int")


def nearest_store(customers: DataFrame, stores: DataFrame) -> DataFrame:
    """Customers with ``Min_DistanceMiles`` and ``storeid`` of the closest store (ties: smaller id).

    The same way for any number of stores. Grid cells that hold customers get finer from level to level; a cell
    keeps, of its parent's stores, those that can be nearest to some point in it: no farther from its centre than
    the closest one by more than the cell's diameter. So the search grows with the stores and the occupied cells,
    customers meet the few stores left by equality on their cell, and every row gets its own answer whether keys
    repeat or not. Rows without valid coordinates are left out; without stores nobody has a nearest one.
    """
    lat, lon = F.col("lat"), F.col("lon")
    known = customers.filter(geo.valid_lat_lon("lat", "lon"))
    places = stores.filter(geo.valid_lat_lon("store_lat", "store_lon")).select("storeid", "store_lat", "store_lon")
    finest = dict(zip(("__y", "__x"), _grid(lat, lon, GRID_DEGREES[-1]), strict=True))
    cells = checkpointed(known.select(*[c.alias(n) for n, c in finest.items()]).distinct())

    left, above = places, None
    for size in GRID_DEGREES:
        step = round(size / GRID_DEGREES[-1])
        cell = F.struct(F.floor(F.col("__y") / step).cast("int").alias("y"), F.floor(F.col("__x") / step).cast("int").alias("x"))
        if above is None:  # a fixed number of coarse cells
            every = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in range(round(180 / size)) for x in range(round(360 / size))])
            left = left.withColumn("cell", F.explode(every)).join(cells.select(cell.alias("cell")).distinct(), "cell")
        else:
            left = left.withColumnRenamed("cell", "parent").join(cells.select(cell.alias("cell"), above.alias("parent")).distinct(), "parent")
        centre = ((F.col("cell.y") + 0.5) * size - 90.0, (F.col("cell.x") + 0.5) * size - 180.0)
        left = left.withColumn("away", geo.distance_miles("store_lat", "store_lon", *centre))
        # No point of a cell is farther from its centre than half the diagonal it would have on the equator.
        diameter = geo.EARTH_RADIUS_MILES * math.radians(size) * math.sqrt(2) + 1e-6
        closest = F.min("away").over(W.partitionBy("cell"))
        left = left.withColumn("closest", closest).filter(F.col("away") <= F.col("closest") + diameter)
        left, above = left.select("cell", "storeid", "store_lat", "store_lon"), cell
    lists = left.groupBy(F.col("cell.y").alias("__cy"), F.col("cell.x").alias("__cx"))
    lists = checkpointed(lists.agg(F.collect_list(F.struct("storeid", "store_lat", "store_lon")).alias("__stores")))

    met = known.withColumns(finest).join(lists, (F.col("__y") == F.col("__cy")) & (F.col("__x") == F.col("__cx")))
    measured = F.transform(
        "__stores", lambda s: F.struct(geo.distance_miles(s["store_lat"], s["store_lon"], lat, lon).alias("miles"), s["storeid"].alias("id"))
    )
    best = met.withColumn("__best", F.array_min(measured))
    return best.select(
        *[F.col(f"`{c}`") for c in customers.columns], F.col("__best.miles").alias("Min_DistanceMiles"), F.col("__best.id").alias("storeid")
    )
