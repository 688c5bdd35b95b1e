"""Distance joins, nearest places and search steps against every pair."""

import random
import re

import pytest
from pyspark.sql import functions as F

from curbwise.functions import geo
from curbwise.functions.geo import haversine_m, with_ellipsoid_m
from curbwise.operators import cluster, naming, nearby
from test_geo import vincenty

METRE = 1 / 111032.0


def scatter(rnd, n, lat, lng, d_lat, d_lng):
    """Points around a place; longitudes turn over at 180 degrees, latitudes stay below the pole."""
    out = []
    for i in range(n):
        y, x = lat + rnd.uniform(-d_lat, d_lat), lng + rnd.uniform(-d_lng, d_lng)
        out.append((i, max(-90.0, min(90.0, y)), (x + 180) % 360 - 180))
    return out


@pytest.mark.parametrize("lat, lng, d_lat, d_lng", [
    (39.9, 116.3, 0.01, 0.012), (0.0, 0.0, 0.01, 0.01), (-17.0, 180.0, 0.01, 0.01), (65.0, -180.0, 0.01, 0.02),
    (89.995, 0.0, 0.01, 180.0), (-89.99, 40.0, 0.012, 180.0), (88.998, 180.0, 0.01, 0.6),
])
def test_pairs_within_reach_anywhere_on_earth(spark, lat, lng, d_lat, d_lng):
    rnd = random.Random(lat)
    a, b = scatter(rnd, 60, lat, lng, d_lat, d_lng), scatter(rnd, 60, lat, lng, d_lat, d_lng)
    left = spark.createDataFrame(a, "i int, lat double, lng double")
    right = spark.createDataFrame(b, "j int, poi_lat double, poi_lng double")
    got = {(r.i, r.j) for r in nearby.within_metres(left, right, 400.0, []).collect()}
    # Near a pole the plain formula is exact enough only on a sphere, so the pairs are measured by the engine itself.
    every = with_ellipsoid_m(left.crossJoin(right), "lat", "lng", "poi_lat", "poi_lng", "d", 8)
    want = {(r.i, r.j) for r in every.where("d <= 400").collect()}
    assert got == want and want


@pytest.mark.parametrize("lat, lng, d_lat, d_lng", [
    (39.9, 116.3, 0.01, 0.012), (-17.0, 180.0, 0.01, 0.01), (89.995, 0.0, 0.01, 180.0), (88.998, 180.0, 0.01, 0.6),
])
def test_blocks_have_the_pairs_within_reach(spark, monkeypatch, lat, lng, d_lat, d_lng):
    monkeypatch.setattr(nearby, "BLOCK_POINTS", 3)
    monkeypatch.setattr(nearby, "BLOCK_PAIRS", 40)
    rnd = random.Random(lat)
    a, b = scatter(rnd, 60, lat, lng, d_lat, d_lng), scatter(rnd, 60, lat, lng, d_lat, d_lng)
    left = spark.createDataFrame([*a, *a[:5], (None, lat, lng), (98, None, lng), (99, lat, None)], "i int, lat double, lng double")
    right = spark.createDataFrame([*b, *b[:5], (98, None, lng), (99, lat, None)], "j int, poi_lat double, poi_lng double")
    got = nearby.within_metres_by_block(left, right, 400.0, [])
    every = with_ellipsoid_m(left.crossJoin(right), "lat", "lng", "poi_lat", "poi_lng", "d", 8)
    key = lambda r: (r.i is None, r.i, r.j, r[-1])
    got, want = sorted(got.collect(), key=key), sorted(every.where("d <= 400").collect(), key=key)
    assert want and [tuple(r)[:-1] for r in got] == [tuple(r)[:-1] for r in want]
    assert max(abs(x.distance - y.d) for x, y in zip(got, want, strict=True)) < 1e-7


def test_chord_is_the_distance_to_some_nanometres(spark):
    rnd, rows = random.Random(4), []
    for _ in range(400):
        lat, lng, reach = rnd.uniform(-84, 84), rnd.uniform(-180, 180), rnd.uniform(0.0001, 0.009)
        rows.append((lat, lng, lat + rnd.uniform(-reach, reach), (lng + rnd.uniform(-reach, reach) + 180) % 360 - 180))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    here, there = geo.axis_and_plane_m("a"), geo.axis_and_plane_m("c")
    df = df.withColumn("chord", F.expr(geo.near_m(*here, "b", *there, "d")))
    for r in with_ellipsoid_m(df, "a", "b", "c", "d", "exact", 8).where(f"exact <= {geo.CHORD_REACH_M}").collect():
        assert abs(r.chord - r.exact) < 2e-8
    metres = [0.0, 0.0004, 0.0005, 0.0015, 1.0005, 299.99949999, 299.9995, 300.0]
    got = spark.createDataFrame([(m,) for m in metres], "m double").select(geo.whole_mm(F.col("m")), F.round("m", 3)).collect()
    assert [r[0] for r in got] == [r[1] for r in got]


def test_search_of_pois_is_compiled_and_a_crowded_cell_is_many_tasks(spark):
    points = spark.createDataFrame([(i, "bj", 39.9, 116.3 + i * 1e-7) for i in range(3000)], "id int, city string, lat double, lng double")
    pois = spark.createDataFrame(
        [(1, "bj", 39.9005, 116.3, "gate", "150700")], "poi_id bigint, city string, lat double, lng double, name string, typecode string"
    )
    near = naming.pois_around(points, pois)
    code = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package").codegenString(near._jdf.queryExecution().executedPlan())
    assert all(int(size) < 8000 for size in re.findall(r"maxMethodCodeSize:(\d+)", code))  # else the JVM interprets it
    per_task = near.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 3000 and max(r["count"] for r in per_task) < 3000


def test_pois_are_ranked_where_they_are_found(spark, monkeypatch):
    monkeypatch.setattr(nearby, "BLOCK_POINTS", 2)
    rnd = random.Random(6)
    asked = [(i % 9 if i % 4 else None, "bj", 39.9 + rnd.uniform(0, 0.006), 116.3 + rnd.uniform(0, 0.006)) for i in range(20)]
    asked += [(100 + i, "bj", 39.901, 116.301 + i * 1e-5) for i in range(9)] + [(108, "bj", 39.901, 116.30108), (7, None, 39.9, 116.3)]
    points = spark.createDataFrame(asked, "request_id bigint, city string, lat double, lng double")
    found = [(i % 35, "bj", 39.9 + rnd.uniform(0, 0.006), 116.3 + rnd.uniform(0, 0.006), "gate", "150700") for i in range(40)]
    found += [(50 + i, "bj", 39.902, 116.302, "gate", "150700") for i in range(3)]
    pois = spark.createDataFrame(found, "poi_id bigint, city string, lat double, lng double, name string, typecode string")
    keys = ["request_id"]
    got = naming.ranked_by_distance(naming.pois_around(points, pois, together=keys), keys)
    want = naming.ranked_by_distance(naming.pois_around(points, pois), keys)
    told = lambda df: sorted(map(str, df.select("request_id", "poi_id", "distance", "place").collect()))
    assert sorted(got.columns) == sorted(want.columns) and told(got) == told(want)
    settled = naming.pois_around(points, pois, together=keys).groupBy("request_id").agg(F.bool_or("_scattered").alias("s"))
    assert {r.s for r in settled.collect()} == {True, False}
    # The window of keys that are in one block stands on the join without an exchange; the other one has its own.
    plan = got._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[row_number.*?SortMergeJoin", plan, re.S)
    assert ["Exchange" in w for w in windows] == [False, True]


def test_flat_distance_is_within_its_share(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(400):
        lat, lng, reach = rnd.uniform(-84, 84), rnd.uniform(-180, 180), rnd.uniform(0.0001, 0.04)
        rows.append((lat, lng, lat + rnd.uniform(-reach, reach), (lng + rnd.uniform(-reach, reach) + 180) % 360 - 180))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").withColumn("flat", F.expr(nearby.flat_m("a", "b", "c", "d")))
    for r in with_ellipsoid_m(df, "a", "b", "c", "d", "exact", 8).where("exact BETWEEN 1 AND 5000").collect():
        assert abs(r.flat - r.exact) <= nearby.FLAT_SHARE * r.exact


def test_steps_equal_the_exact_ones_and_few_pairs_are_measured(spark):
    rnd = random.Random(5)
    rows = [(39.9, 116.3, 39.9 + rnd.uniform(-0.01, 0.01), 116.3 + rnd.uniform(-0.012, 0.012)) for _ in range(3000)]
    rows += [(39.9, 116.3, 39.9 + step * METRE * share, 116.3) for step in nearby.RADIUS_STEPS for share in (0.99999, 1.00001)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    exact = with_ellipsoid_m(df, "a", "b", "c", "d", "m").withColumn("want", nearby.step_radius(F.col("m")))
    got = nearby.with_step(exact, "a", "b", "c", "d", "step")
    assert got.where("NOT (want <=> step)").count() == 0 and got.count() == len(rows)
    assert {r.step for r in got.select("step").distinct().collect()} == {*nearby.RADIUS_STEPS, None}
    flat = df.withColumn("flat", F.expr(nearby.flat_m("a", "b", "c", "d")))
    measured = flat.where(nearby._unsure(F.col("flat"), F.col("a"), nearby.RADIUS_STEPS)).count()
    assert measured * 50 < len(rows)


def test_nearest_place_equals_the_least_of_all(spark):
    rnd = random.Random(11)
    points = [(39.9 + rnd.uniform(0, 0.03), 116.3 + rnd.uniform(0, 0.03)) for _ in range(40)]
    places = [(i, 39.9 + rnd.uniform(0, 0.02), 116.3 + rnd.uniform(0, 0.02), f"p{i}") for i in range(25)]
    places += [(100, *places[0][1:]), (99, *places[0][1:])]
    found = {(r.lat, r.lng): r.id for r in nearby.nearest_place(
        spark.createDataFrame(points, "lat double, lng double"),
        spark.createDataFrame(places, "id int, place_lat double, place_lng double, name string"), 700.0, "id", ["id", "name"],
    ).collect()}
    for lat, lng in points:
        metres, best = min((round(vincenty(lat, lng, y, x), 3), i) for i, y, x, _ in places)
        assert found.get((lat, lng)) == (best if metres <= 700 else None)
    assert 0 < len(found) < len(points)


def test_addresses_come_from_the_next_cell(spark):
    rows = [(7, 39.9, 116.3, "北京市海淀区路7号", None, None, None, None), (8, 39.9005, 116.3, "路8号", None, None, None, None)]
    addresses = spark.createDataFrame(
        rows, "point_id bigint, lat double, lng double, formatted_address string, province string, address_city string,"
        " district string, township string",
    )
    places = spark.createDataFrame([(39.9004, 116.3002), (39.95, 116.3)], "lat double, lng double")
    got = [(r.lat, r.address) for r in naming.nearest_addresses(places, addresses).collect()]
    assert got == [(39.9004, "路8号")]


def test_names_go_by_rank_where_ids_are_equal(spark):
    point = "struct<id:string,lat:double,lng:double,score:double,count:bigint,status:int,ext:string,tag:string,show:int,pick:int>"
    same = [("wx4eqdqkx", 39.9, 116.3, 0.5, 5, 0, "", "AC01", 0, 0), ("wx4eqdqkx", 39.90001, 116.3, 0.4, 4, 0, "", "AC01", 0, 0)]
    recs = spark.createDataFrame(
        [("bj", "wx4eqdqk", 39.9, 116.3, 100, 2, 1, same)],
        f"city string, startPos string, lat double, lng double, radius int, num int, update bigint, recomms array<{point}>",
    )
    names = spark.createDataFrame([("bj", "wx4eqdqk", 1, "a"), ("bj", "wx4eqdqk", 2, "b")], "city string, startPos string, rank int, name string")
    [row] = naming.attach_names(recs, names).collect()
    assert [(p.id, p["count"], p.name) for p in row.recomms] == [("wx4eqdqkx", 5, "a"), ("wx4eqdqkx", 4, "b")]


def test_a_group_of_fifty_thousand_points(spark):
    # Five hundred crowds of a hundred points each on a line; every fifth gap is too wide to cross.
    rows = spark.range(50_000).select(
        F.lit("g").alias("g"), F.format_string("%05d", "id").alias("spot"),
        (39.9 + (F.col("id") % 500 * 25 + F.floor(F.col("id") % 500 / 5) * 10) * METRE).alias("lat"),
        (116.3 + F.floor(F.col("id") / 500) * 0.05 * METRE).alias("lng"),
    )
    got = cluster.label_points(rows, ["g"]).groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()
    assert sorted((r.cluster, r.n) for r in got) == [(f"{first:05d}", 500) for first in range(0, 500, 5)]


def test_haversine_of_equal_points(spark):
    assert spark.range(1).select(haversine_m("1D", "2D", "1D", "2D").alias("m")).first().m == 0.0
