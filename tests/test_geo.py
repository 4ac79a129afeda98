import math
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import geo as gfx
from tallyloom.operators import geo as ops
from tallyloom.plans import retail


def miles(a, b):
    (la, lo), (lb, lp) = (tuple(map(math.radians, p)) for p in (a, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * gfx.EARTH_RADIUS_MILES * math.asin(min(1.0, math.sqrt(h)))


def places(spark, points, key, lat, lon):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(points)], f"{key} bigint, {lat} double, {lon} double")


@pytest.fixture(scope="module")
def world():
    """Clusters, poles, the antimeridian, and a third of the customers in one spot."""
    rng = random.Random(7)
    stores = [(rng.uniform(-89, 89), rng.uniform(-180, 180)) for _ in range(25)]
    stores += [(89.99, 10.0), (-89.99, -170.0), (5.0, 179.99), (5.0, -179.99), (0.0, 0.0), (40.0, -75.0)]
    people = [(40.01, -75.01)] * 60
    people += [(min(90.0, max(-90.0, s[0] + rng.uniform(-0.1, 0.1))), (s[1] + rng.uniform(-0.1, 0.1) + 180) % 360 - 180) for s in stores for _ in range(3)]
    people += [(90.0, -100.0), (-90.0, 33.0), (5.0, 180.0), (5.0, -180.0)]
    return people, stores


@pytest.mark.parametrize("radius", [5.0, 60.0, 900.0, 7000.0])
def test_radius_equals_brute_force(spark, world, radius):
    people, stores = world
    got = ops.within_radius(
        places(spark, people, "id", "lat", "lon"), places(spark, stores, "storeid", "store_lat", "store_lon"), radius
    )
    found = [(r.id, r.storeid) for r in got.select("id", "storeid").collect()]
    want = {(i, j) for i, p in enumerate(people) for j, s in enumerate(stores) if miles(p, s) <= radius}
    assert len(found) == len(set(found)) and set(found) == want


@pytest.mark.parametrize("more", [0, 2000])
def test_nearest_equals_brute_force(spark, world, more):
    people, stores = world
    rng = random.Random(11)
    stores = stores[:5] if not more else stores + [(40 + rng.gauss(0, 0.2), -75 + rng.gauss(0, 0.2)) for _ in range(more)]
    out = ops.nearest_store(places(spark, people, "id", "lat", "lon"), places(spark, stores, "storeid", "store_lat", "store_lon"))
    assert out.columns == ["id", "lat", "lon", "Min_DistanceMiles", "storeid"]
    got = {r.id: (r.storeid, r.Min_DistanceMiles) for r in out.collect()}
    assert len(got) == len(people)
    for i, p in enumerate(people):
        best = min(miles(s, p) for s in stores)
        assert got[i][1] == pytest.approx(best, abs=1e-6)
        assert miles(stores[got[i][0]], p) == pytest.approx(best, abs=1e-6)


def test_nearest_keeps_repeated_keys_and_the_smaller_id(spark):
    people = spark.createDataFrame([(1, 10.0, 10.0), (1, -10.0, 100.0), (1, -10.0, 100.0)], "id int, lat double, lon double")
    stores = spark.createDataFrame([(7, 10.1, 10.0), (5, 10.1, 10.0), (9, -10.0, 99.0)], "storeid int, store_lat double, store_lon double")
    assert sorted(r.storeid for r in ops.nearest_store(people, stores).collect()) == [5, 9, 9]


def test_five_mile_edge(spark):
    north = math.degrees(5.0 / gfx.EARTH_RADIUS_MILES)
    customers = places(spark, [(north - 1e-9, 0.0), (north + 1e-6, 0.0)], "id", "lat", "lon")
    store = places(spark, [(0.0, 0.0)], "storeid", "store_lat", "store_lon")
    assert [r.id for r in ops.within_radius(customers, store).collect()] == [0]


def test_points_skip_bad_coordinates(spark):
    customers = spark.createDataFrame([(1, 10.0, 10.0), (2, 95.0, 0.0), (3, None, 5.0)], "id int, lat double, lon double")
    stores = places(spark, [(10.0, 10.0)], "storeid", "store_lat", "store_lon")
    assert [r.Centroid is not None for r in ops.with_point(customers).orderBy("id").collect()] == [True, False, False]
    assert [r.Min_DistanceMiles for r in ops.nearest_store(customers, stores).collect()] == [0.0]
    assert ops.nearest_store(customers, stores.limit(0)).count() == 0


@pytest.mark.parametrize("lat, lon, way", [(1, 0, "N"), (1, 1, "NE"), (0, 1, "E"), (-1, 1, "SE"), (-1, 0, "S"), (-1, -1, "SW"), (0, -1, "W"), (1, -1, "NW"), (0, 0, None)])
def test_cardinal(spark, lat, lon, way):
    row = spark.range(1).select(gfx.cardinal(F.lit(0.0), F.lit(0.0), F.lit(float(lat)), F.lit(float(lon))).alias("w"))
    assert row.first().w == way


@pytest.mark.parametrize("text, lat, lon", [("POINT(-121.5 38.25)", 38.25, -121.5), (" POINT (1 -2) ", -2.0, 1.0), ("POINT(1)", None, None), ("LINE(1 2)", None, None), (None, None, None)])
def test_wkt(spark, text, lat, lon):
    df = spark.createDataFrame([(text,)], "w string")
    row = ops.parse_wkt_point(df, "w").first()
    assert (row.lat, row.lon) == (lat, lon)


def test_trade_area_summary_at_the_date_line(spark):
    stores = spark.createDataFrame([(1, 10.0, 179.99), (2, 10.0, -179.99), (3, 10.02, 180.0), (4, 40.0, 0.0)], "storeid int, store_lat double, store_lon double")
    customers = spark.createDataFrame([(1, 10.0, 180.0), (2, 40.01, 0.01), (3, -50.0, 0.0)], "c int, lat double, lon double")
    out = {r["c"]: r for r in retail.trade_area_summary(customers, stores, "c", 5.0).collect()}
    assert out[1]["CoveringStores"] == [1, 2, 3] and out[1]["CombinedArea"] == "MULTIPOINT(-179.99000 10.00000, 179.99000 10.00000, 180.00000 10.02000)"
    assert abs(abs(out[1]["CentroidLon"]) - 180) < 1e-6 and abs(out[1]["CentroidLat"] - 10.00667) < 1e-4
    assert (out[2]["CentroidLat"], out[2]["CentroidLon"]) == pytest.approx((40.0, 0.0))
    assert [out[3][c] for c in ("CoveringStores", "CentroidLat", "CentroidLon", "CombinedArea")] == [None] * 4


def test_sphere_mean_of_opposite_points(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 180.0)], "a double, b double")
    assert df.agg(gfx.sphere_mean("a", "b").alias("m")).first()["m"] is None
    assert df.limit(0).agg(gfx.sphere_mean("a", "b").alias("m")).first()["m"] is None
