import math

import pytest
from pyspark.sql import functions as F

from curbwise.functions import cells, geo


def vincenty(lat1, lng1, lat2, lng2):
    """Textbook inverse solution, iterated until it stands still."""
    a, f = 6378137.0, 1 / 298.257223563
    b = (1 - f) * a
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    lam = dl = math.radians(lng2 - lng1)
    for _ in range(200):
        ss = math.hypot(
            math.cos(u2) * math.sin(lam),
            math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam),
        )
        if ss == 0:
            return 0.0
        cs = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(ss, cs)
        sa = math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
        c2a = 1 - sa * sa
        m = cs - 2 * math.sin(u1) * math.sin(u2) / c2a if c2a else 0.0
        c = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        last, lam = lam, dl + (1 - c) * f * sa * (sigma + c * ss * (m + c * cs * (2 * m * m - 1)))
        if abs(lam - last) < 1e-14:
            break
    u = c2a * (a * a - b * b) / (b * b)
    big_a = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
    big_b = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    return b * big_a * (sigma - big_b * ss * (m + big_b / 4 * (
        cs * (2 * m * m - 1) - big_b / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3))))


PAIRS = [
    (39.9, 116.3, 39.9, 116.3), (39.9, 116.3, 39.9001, 116.3), (39.9, 116.3, 39.905, 116.31),
    (0.0, 0.0, 0.0, 0.01), (31.2, 121.4, 39.9, 116.3), (-33.9, 151.2, 51.5, -0.1), (89.0, 10.0, 89.0, -160.0),
]


def test_ellipsoid_distance(spark):
    df = spark.createDataFrame(PAIRS, "a double, b double, c double, d double")
    for row in geo.with_ellipsoid_m(df, "a", "b", "c", "d", "m", geo.FAR_STEPS).collect():
        assert row.m == pytest.approx(vincenty(row.a, row.b, row.c, row.d), abs=1e-5)
    near = geo.with_ellipsoid_m(df.limit(4), "a", "b", "c", "d", "m").collect()
    for row in near:
        assert row.m == pytest.approx(vincenty(row.a, row.b, row.c, row.d), abs=1e-6)


def test_destination_returns_the_distance(spark):
    df = spark.createDataFrame(
        [(39.9, 116.3, float(b), 123.4) for b in range(0, 360, 45)], "lat double, lng double, brg double, m double"
    )
    for row in geo.with_destination(df, "lat", "lng", "brg", "m", "to_lat", "to_lng").collect():
        assert vincenty(row.lat, row.lng, row.to_lat, row.to_lng) == pytest.approx(123.4, abs=1e-6)
        north = row.to_lat - row.lat
        assert (north > 1e-9) == (row.brg in (0, 45, 315))


def test_outside_the_datum_nothing_moves(spark):
    rows = [(39.9, 72.003), (39.9, 137.8348), (0.8292, 100.0), (55.8272, 100.0), (39.9, 116.3)]
    df = spark.createDataFrame(rows, "lat double, lng double")
    lat, lng = geo.gcj_to_wgs("lat", "lng")
    moved = df.select("*", lat.alias("a"), lng.alias("b"), geo.outside_datum("lat", "lng").alias("out")).collect()
    assert [r.out for r in moved] == [True] * 4 + [False]
    assert all(r.a == r.lat and r.b == r.lng for r in moved[:4])
    assert 1e-4 < abs(moved[4].a - 39.9) < 1e-2


def test_geohash_of_known_places(spark):
    df = spark.createDataFrame([(57.64911, 10.40744), (-25.382708, -49.265506), (89.99, 179.99)], "lat double, lng double")
    texts = [r.g for r in cells.with_geohash(df, "lat", "lng", "g", 11).collect()]
    assert texts[:2] == ["u4pruydqqvj", "6gkzwgjzn82"]
    assert texts[2].startswith("zzz")
    bad = spark.createDataFrame([(90.0, 10.0), (-91.0, 10.0)], "lat double, lng double")
    assert [r.g for r in cells.with_geohash(bad, "lat", "lng", "g", 5).collect()] == [None, None]
    with pytest.raises(ValueError):
        cells.with_geohash(df, "lat", "lng", "g", 13)
    with pytest.raises(ValueError):
        cells.with_geohash(df, "lat", "lng", "g", 0)


@pytest.mark.parametrize("precision", [1, 5, 6, 8, 12])
def test_decode_lands_in_the_same_cell(spark, precision):
    df = spark.range(300).select(
        (F.col("id") * 37 % 160 - 80 + 0.137).alias("lat"), (F.col("id") * 91 % 340 - 170 + 0.733).alias("lng")
    ).where(geo.outside_datum("lat", "lng"))
    coded = cells.with_geohash(df, "lat", "lng", "g", precision)
    back = cells.with_decoded(coded, "g", "la", "ln").where(geo.outside_datum("la", "ln"))
    again = cells.with_geohash(back, "la", "ln", "h", precision)
    assert again.where("g <> h").count() == 0
    assert again.count() > 100


def test_parent_cell_matches_the_text_prefix(spark):
    df = spark.range(200).select((F.col("id") / 7 - 10).alias("lat"), (F.col("id") * 1.3 - 100).alias("lng"))
    coded = cells.with_cell(df, "lat", "lng", "c", 8)
    rows = coded.select(
        cells.cell_text("c", 8).alias("t"), cells.parent_cell("c", 8, 6).alias("p")
    ).select("t", cells.cell_text("p", 6).alias("q")).collect()
    assert all(r.t[:6] == r.q for r in rows)
