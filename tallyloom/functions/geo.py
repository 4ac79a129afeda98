"""Distance, direction and coordinate parsing with built-in trigonometry."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyloom.functions.formulas import col

EARTH_RADIUS_MILES = 3958.7613
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


def valid_lat_lon(lat: str | Column, lon: str | Column) -> Column:
    return F.coalesce(col(lat).between(-90.0, 90.0) & col(lon).between(-180.0, 180.0), F.lit(False))


def point(lat: str | Column, lon: str | Column) -> Column:
    """A ``struct<lat,lon>``; NULL when either coordinate is missing or out of range."""
    made = F.struct(col(lat).cast("double").alias("lat"), col(lon).cast("double").alias("lon"))
    return F.when(valid_lat_lon(lat, lon), made)


def distance_miles(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle (haversine) miles."""
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    half_lat, half_lon = F.sin((lat2 - lat1) / 2), F.sin((lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def sphere_mean(lat: str | Column, lon: str | Column) -> Column:
    """Aggregate: the middle of points as ``struct<lat,lon>``, by their mean unit vector, so that the date line is no edge.

    NULL without points and for points that balance (two opposite ones), which have no middle.
    """
    lat, lon = F.radians(col(lat)), F.radians(col(lon))
    x, y, z = F.avg(F.cos(lat) * F.cos(lon)), F.avg(F.cos(lat) * F.sin(lon)), F.avg(F.sin(lat))
    flat = F.sqrt(x * x + y * y)
    made = F.struct(F.degrees(F.atan2(z, flat)).alias("lat"), F.degrees(F.atan2(y, x)).alias("lon"))
    return F.when(F.sqrt(x * x + y * y + z * z) > 1e-9, made)


def multipoint(points: Column) -> Column:
    """WKT of an array of ``struct<lon,lat>`` in decimals; NULL for NULL."""
    parts = F.transform(points, lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string")))
    return F.concat(F.lit("MULTIPOINT("), F.array_join(parts, ", "), F.lit(")"))


def cardinal(lat1, lon1, lat2, lon2) -> Column:
    """Compass point (eight sectors) of the way from point 1 to point 2; NULL for the same point."""
    same = (col(lat1) == col(lat2)) & (col(lon1) == col(lon2))
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    east = F.sin(lon2 - lon1) * F.cos(lat2)
    north = F.cos(lat1) * F.sin(lat2) - F.sin(lat1) * F.cos(lat2) * F.cos(lon2 - lon1)
    sector = F.pmod(F.floor((F.degrees(F.atan2(east, north)) + 382.5) / 45), F.lit(8)).cast("int")
    return F.when(~same, F.element_at(F.array(*[F.lit(p) for p in COMPASS]), sector + 1))


def wkt_longitude(c: str | Column) -> Column:
    return _wkt_number(c, 1)


def wkt_latitude(c: str | Column) -> Column:
    return _wkt_number(c, 2)


def _wkt_number(c: str | Column, group: int) -> Column:
    """Coordinate out of ``POINT(lon lat)``; NULL when the text is not such a point."""
    number = r"(-?[0-9]+(?:\.[0-9]+)?)"
    pattern = rf"^\s*POINT\s*\(\s*{number}\s+{number}\s*\)\s*$"
    return F.nullif(
        F.regexp_extract(col(c), pattern, group), F.lit("")
    ).try_cast("double")
