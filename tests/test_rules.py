import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from curbwise.functions import calendar, text
from curbwise.functions.measures import rounded_mean
from curbwise.operators import naming, nearby, orders, recommend, roads, spots
from verification import inputs as given


def test_upper_quartile_case(spark):
    df = spark.createDataFrame([("k", c) for c in (1, 1, 2, 5, 9, 14)], "k string, cnt bigint")
    for keep in (spots.upper_quartile, spots.upper_quartile_bounded):
        assert sorted(r.cnt for r in keep(df, ["k"]).collect()) == [9, 14]


@pytest.mark.parametrize("counts", [
    [7], [1, 1], [1, 1, 1, 5], [5, 1, 1, 1], [1, 1, 1, 6], [2, 3, 4], [1, 1, 1, 1, 900], [10**9, 1, 1, 1, 1],
])
def test_median_gate_matches_the_definition(spark, counts):
    df = spark.createDataFrame([("k", c) for c in counts], "k string, cnt bigint")
    kept = sorted(r.cnt for r in recommend.drop_rare_when_uneven(df, ["k"]).collect())
    uneven = len(counts) > 1 and statistics.mean(counts) ** 2 < statistics.variance([*map(int, counts)])
    middle = statistics.median(counts)
    assert kept == sorted(c for c in counts if not uneven or c >= middle)


def _place(spark, distances):
    """Points due north of one expected point."""
    rows = [("bj", "aaaaaa", "aaaaaaaa", 39.9, 116.3, f"s{i}", 1, 39.9 + d / 111032.0, 116.3) for i, d in enumerate(distances)]
    return spark.createDataFrame(
        rows, "city string, exp_rough string, exp_geohash string, exp_lat double, exp_lng double, spot string,"
        " cnt bigint, lat double, lng double",
    )


def test_step_radius_cases(spark):
    kept = recommend.within_step_radius(_place(spark, [120, 149, 151])).collect()
    assert sorted(r.spot for r in kept) == ["s0", "s1"] and {r.radius for r in kept} == {150}
    assert recommend.within_step_radius(_place(spark, [1001.5])).count() == 0
    steps = spark.createDataFrame([(100.0,), (100.1,), (999.0,), (1000.1,)], "d double")
    assert [r.r for r in steps.select(nearby.step_radius(F.col("d")).alias("r")).collect()] == [100, 150, 1000, None]


def test_score_case(spark):
    df = spark.createDataFrame([("k", 10), ("k", 5)], "k string, cnt bigint")
    assert sorted(r.score for r in recommend.scored(df, ["k"]).collect()) == [0.359712, 0.719424]


def test_weighted_centre_case(spark):
    df = spark.createDataFrame(
        [("k", 0, 3, 0.0, 10.0), ("k", 0, 1, 4.0, 10.0)], "k string, cluster int, cnt bigint, lat double, lng double"
    )
    row = recommend.cluster_centres(df, ["k"]).collect()[0]
    assert (row.lat, row.lng, row.cnt) == (1.0, 10.0, 4)


def test_name_choice_cases(spark):
    rows = [(1, 1, "bus stop", "150700", 10.0), (1, 2, "hotel", "100000", 45.0), (2, 3, "mall", "060101", 15.0),
            (3, 4, "far hotel", "100000", 51.0), (3, 5, "mall", "060101", 52.0)]
    df = spark.createDataFrame(rows, "point int, poi_id int, poi_name string, typecode string, distance double")
    names = {r.point: r.name for r in naming.best_names(df, ["point"]).collect()}
    assert names == {1: "hotel附近", 2: "mall", 3: "far hotel附近"}


def test_name_used_once_per_recommendation(spark):
    uses = spark.createDataFrame(
        [("bj", "x", 1, 39.9, 116.3), ("bj", "x", 2, 39.90001, 116.3), ("bj", "x", 3, 39.90002, 116.3),
         ("bj", "y", 1, 39.90001, 116.3), ("bj", "z", 1, 39.95, 116.3)],
        "city string, startPos string, rank int, lat double, lng double",
    )
    pois = spark.createDataFrame(
        [(1, "bj", 39.9, 116.3, "gate", "150700"), (2, "bj", 39.9003, 116.3, "hall", "100000")],
        "poi_id bigint, city string, lat double, lng double, name string, typecode string",
    )
    names = {(r.startPos, r.rank): r.name for r in naming.chosen_names(uses, pois).collect()}
    # The hotel type outranks the stop; the third point finds both used and takes the nearest.
    assert names == {("x", 1): "hall附近", ("x", 2): "gate", ("x", 3): "gate", ("y", 1): "hall附近", ("z", 1): ""}


def test_nearest_search_falls_back_to_the_full_radius(spark):
    places = spark.createDataFrame([("bj", 39.9, 116.3), ("bj", 39.91, 116.3)], "city string, lat double, lng double")
    pois = spark.createDataFrame(
        [(1, "bj", 39.902, 116.3, "gate", "150700"), (2, "bj", 39.90215, 116.3, "hall", "100000"),
         (3, "bj", 39.91, 116.3001, "mall", "060101")],
        "poi_id bigint, city string, lat double, lng double, name string, typecode string",
    )
    names = {r.lat: r.name for r in naming.searched_names(places, pois).collect()}
    assert names == {39.9: "gate附近"}


def test_best_names_search_each_place_once_and_far_only_where_nothing_is_close(spark, monkeypatch):
    from verification.queries import REGISTRY

    asked = given.demo(spark, SMALL, "request")
    plain = naming.best_names(naming.pois_around(asked, given.demo(spark, SMALL, "poi")), ["request_id"])
    twice = asked.unionByName(asked.withColumn("request_id", F.col("request_id") + 1_000_000))
    demo, search, searches = given.demo, naming.pois_around, []
    monkeypatch.setattr(given, "demo", lambda spark, sf, name: twice if name == "request" else demo(spark, sf, name))

    def counted(points, pois, reach=naming.SEARCH_REACH_M):
        searches.append((reach, points.count()))
        return search(points, pois, reach)

    monkeypatch.setattr(naming, "pois_around", counted)
    got = REGISTRY["best_poi_names"].run(spark, SMALL).collect()
    want = {r.request_id: r.name for r in plain.collect()}
    assert want and sorted(map(tuple, got)) == sorted([*want.items(), *((k + 1_000_000, name) for k, name in want.items())])
    places = asked.select("city", "lat", "lng").distinct().count()
    assert [reach for reach, _ in searches] == [naming.PREFERRED_REACH_M, naming.SEARCH_REACH_M]
    assert searches[0][1] == places > searches[1][1]


def test_address_names_leave_no_address_out(spark):
    from verification.queries import REGISTRY

    data = "/root/testdata/sf0.001"
    rows = REGISTRY["address_names"].run(spark, data)
    assert rows.count() == spark.read.parquet(f"{data}/customer.parquet").count()
    assert rows.where("address = ''").count() == 0
    schema = "point_id bigint, formatted_address string, province string, address_city string, district string, township string"
    addresses = spark.createDataFrame([(1, "北京市海淀区路7号", "北京市", None, "海淀区", None)], schema)
    got = naming.address_names(spark.range(1, 3).toDF("point_id"), addresses)
    assert sorted(map(tuple, got.collect())) == [(1, "路7号"), (2, "")]


def test_address_trims(spark):
    rows = [("街道口东", None, None, None, None), ("海淀镇中心镇北", None, None, None, None),
            ("北京市海淀区北京市场", "北京市", "北京市", "海淀区", None)]
    df = spark.createDataFrame(rows, "n string, p string, c string, d string, t string")
    got = [r.s for r in df.select(text.trim_address(*map(F.col, "npcdt")).alias("s")).collect()]
    assert got == ["街道口东", "中心", "场"]


def test_one_bad_element_empties_a_chain(spark):
    rows = [("a:1:2.5:3.5\tb:2:1.0:1.0",), ("a:1:2.5:3.5\tb:x:1.0:1.0",), ("a:1:2.5",), ("",), (None,), ("a:1:1:1:1",)]
    df = spark.createDataFrame(rows, "c string")
    got = [r.u for r in df.select(text.unpack_chain(F.col("c")).alias("u")).collect()]
    assert [len(u) for u in got] == [2, 0, 0, 0, 0, 0]
    assert got[0][1].asDict() == {"geohash": "b", "cnt": 2, "lat": 1.0, "lng": 1.0}


def test_road_cases(spark):
    points = spark.createDataFrame([(1, 39.9, 116.3), (2, 39.9, 116.3)], "point_id bigint, lat double, lng double")
    near = spark.createDataFrame(
        [(1, "a", 9.0, "北", "road"), (1, "b", 10.0, "南", "road"), (1, "c", 1.0, "南", "roadinter")],
        "point_id bigint, name string, distance double, direction string, type string",
    )
    rows = {r.point_id: r for r in roads.snap_to_nearest(points, near).collect()}
    assert rows[1].road == "a" and rows[1].snap_lat < 39.9
    assert (rows[2].snap_lat, rows[2].snap_lng) == (39.9, 116.3)
    assert roads.snap_to_all(points, near).count() == 2
    assert roads.snap_to_all(points, near, include_intersections=True).count() == 3


def test_latest_row_with_equal_versions_is_settled(spark):
    rows = [(1, 10, "b"), (1, 10, "a"), (1, 9, "z"), (2, None, "n")]
    df = spark.createDataFrame(rows, "k bigint, v bigint, x string").repartition(3)
    assert {(r.k, r.x) for r in orders.latest_rows(df, ["k"], "v").collect()} == {(1, "a"), (2, "n")}


def test_rounded_mean_takes_ties_up(spark):
    rows = [(39900000500000, 1), (39900001499999, 1), (3 * 39900000500000, 3), (-39900000500000, 1)]
    df = spark.createDataFrame(rows, "t bigint, n bigint").select(F.col("t").cast("decimal(30,0)").alias("t"), "n")
    assert [r.m for r in df.select(rounded_mean("t", "n").alias("m")).collect()] == [39.900001, 39.900001, 39.900001, -39.900001]


def test_training_window():
    assert calendar.training_days(dt.date(2017, 4, 15)) == (20170101, 20170331)
    assert calendar.training_days(dt.date(2017, 4, 1)) == (20161201, 20170228)
    assert calendar.training_days(dt.date(2017, 1, 2)) == (20161001, 20161231)


def test_epoch_text_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        df = spark.createDataFrame([(0,), (1483228799,), (-1,)], "s bigint")
        got = [r.t for r in df.select(calendar.epoch_text(F.col("s")).alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["1970-01-01 00:00:00", "2016-12-31 23:59:59", "1969-12-31 23:59:59"]
