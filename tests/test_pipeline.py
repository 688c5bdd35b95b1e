import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from curbwise.operators import publish, recommend, spots
from curbwise.plans import merge, mine
from curbwise.session import staged_path
from curbwise.sources import schemas, tables
from scripts.check_oracles import TABLES, differences
from verification import inputs as given
from verification.queries import REGISTRY

# A cross-section that touches every module; scripts/check_oracles.py runs them all.
CHECKED = (
    "merge_one_day", "merge_months_from_tsv", "city_replace", "chain_csv_round_trip", "candidate_chains",
    "recommended_spots", "recommended_spots_from_packed_chains", "named_recommendations", "persisted_details",
    "published_documents", "batch_lookup", "lookup_by_geohash", "heat_query_clustered", "heat_statistics",
    "road_snapping", "detail_numbers", "geohash_decode", "gcj_to_wgs", "training_window", "day_and_month_keys",
)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_oracle(spark, db, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    assert differences(got, db.sql(entry.oracle_sql()[name]).df()) is None
    assert len(got) > 0


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_invariants(spark):
    rows = recommend.flattened(given.recommendations(spark, SMALL)).collect()
    best = {}
    for r in rows:
        assert 0 < r.score < 1 and r.radius in (100, 150, 200, 300, 500, 1000)
        best.setdefault((r.city, r.startPos), []).append((r.score, r["count"]))
    for scores in best.values():
        assert max(scores)[1] == max(c for _, c in scores)
    kept = given.kept(spark, SMALL).agg(F.sum("cnt")).collect()[0][0]
    assert kept == sum(r["count"] for r in rows)


def test_same_result_for_any_partitioning(spark):
    orders = given.positions(spark, SMALL)
    seen = []
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.enabled", parts == 1)
        result = recommend.recommend(mine.mine_chains(orders.repartition(parts, "driver_id")), 1)
        seen.append(sorted(map(repr, result.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.set("spark.sql.adaptive.enabled", True)
    assert seen[0] == seen[1]


def test_packed_lines_hold_every_spot_in_its_rough_cell(spark):
    chains = given.chains(spark, SMALL)
    packed = spots.packed_chains(chains)
    assert packed.count() == packed.select("city", "exp_geohash", F.left("cooccurs", F.lit(6))).distinct().count()
    assert packed.select("city", "exp_geohash").distinct().count() == chains.points.count()
    candidates, shared = recommend.unpacked_candidates(packed)
    assert candidates.count() == recommend.candidate_rows(chains).count()
    listed = packed.select("exp_geohash", F.explode(F.split("cooccurs", "\t")).alias("s")).where("s <> ''")
    assert listed.count() == chains.cooccur.count()
    again = recommend.flattened(mine.recommend_packed(packed, 1)).drop("update")
    direct = recommend.flattened(recommend.recommend(chains, 1)).drop("update")
    assert again.exceptAll(direct).count() == 0 and direct.exceptAll(again).count() == 0


def test_empty_day_fails(spark):
    orders, ext = given.demo(spark, SMALL, "order"), given.demo(spark, SMALL, "order_ext")
    path = staged_path(spark, "gated")
    merge.merge_days_to_table(orders, ext, 20170115, 20170116, path)
    before = tables.read_positions(spark, path).count()
    with pytest.raises(tables.EmptyDayError, match="no records for 20170116$"):
        merge.merge_days_to_table(orders.where("dt <> 20170116"), ext, 20170115, 20170117, path)
    assert tables.read_positions(spark, path).count() == before > 0


def test_bad_number_in_tsv_fails(spark):
    path = staged_path(spark, "bad-tsv")
    spark.createDataFrame([("20170101", "bj", "x1")], "a string, b string, c string").write.option("sep", "\t").csv(path)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        tables.read_tsv(spark, path, schemas.EXT_EXPORT).collect()


def test_replacing_a_city_with_nothing_clears_it(spark):
    path = staged_path(spark, "info")
    info = given.info(spark, SMALL)
    tables.replace_cities(info, path)
    tables.replace_city(info.limit(0), path, "sh")
    left = {r.city for r in tables.read_city_table(spark, path, schemas.INFO).select("city").distinct().collect()}
    assert left == {"bj"}


def test_lookup_answers(spark):
    info, detail = given.info(spark, SMALL), given.detail(spark, SMALL)
    known = info.where("city = 'bj'").orderBy("geohash").first()
    asked = spark.createDataFrame(
        [(1, "bj", None, None, known.geohash + "xyz1"), (2, "bj", 10.0, 10.0, None), (3, "bj", None, None, None),
         (4, "nowhere", 39.9, 116.3, None), (5, "bj", 0.0, 0.0, "")],
        "request_id bigint, city string, lat double, lng double, geohash string",
    )
    rows = {r.request_id: r for r in publish.lookup(asked, info, detail, given.cities(spark), 99).collect()}
    assert rows[1].ret == 0 and rows[1].geohash == known.geohash and len(rows[1].recomms) == known.num
    assert (rows[2].ret, rows[2].num, rows[2].radius, rows[2].regeo, rows[2].recomms, rows[2].update_time) == (
        0, 0, 0, "no recomms", [], 99)
    assert rows[3].ret == -1 and rows[4].ret == -2
    assert rows[5].geohash == "s0000000" and rows[5].ret == 0


def test_scan_prunes_days_and_columns(spark):
    df = tables.scan_coordinates(spark, given.positions_path(spark, SMALL), 20170110, 20170111, "bj")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "EqualTo(city,bj)" in plan
    assert "service_order_id" not in plan.split("ReadSchema")[1]


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
