"""Whole-span replacement, and counting a stream of files."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from conftest import SMALL
from curbwise import session
from curbwise.plans import merge
from curbwise.session import staged_path, staging_root, staging_run
from curbwise.sources import replace, tables
from curbwise.streaming import spot_counts
from verification import inputs as given


def days(spark, path):
    return sorted((r.dt, r.n) for r in spark.read.parquet(path).groupBy("dt").agg(F.sum("n").alias("n")).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "dt int, n int")


def test_days_without_rows_are_cleared_and_others_stay(spark):
    path = staged_path(spark, "span")
    replace.replace_partitions(frame(spark, [(1, 10), (2, 20), (2, 5), (3, 30)]), path, "dt", ["1", "2", "3"])
    replace.replace_partitions(frame(spark, [(1, 11)]), path, "dt", ["1", "2"])
    assert days(spark, path) == [(1, 11), (3, 30)]
    replace.replace_partitions(frame(spark, []), path, "dt", ["1"])
    assert days(spark, path) == [(3, 30)]
    with pytest.raises(ValueError, match="outside the span: dt=4"):
        replace.replace_partitions(frame(spark, [(4, 1)]), path, "dt", ["3"])
    assert days(spark, path) == [(3, 30)]


def test_a_write_that_fails_changes_nothing(spark):
    path = staged_path(spark, "span")
    replace.replace_partitions(frame(spark, [(1, 10), (2, 20)]), path, "dt", ["1", "2"])
    broken = frame(spark, [(1, 1), (2, 2)]).withColumn(
        "n", F.when(F.col("dt") == 2, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n"))
    )
    with pytest.raises(Exception, match="lost"):
        replace.replace_partitions(broken, path, "dt", ["1", "2"])
    assert days(spark, replace.settled(spark, path)) == [(1, 10), (2, 20)]


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_decided_replacement_is_finished_by_the_next_reader(spark, monkeypatch, moves):
    path = staged_path(spark, "span")
    replace.replace_partitions(frame(spark, [(1, 10), (2, 20), (3, 30)]), path, "dt", ["1", "2", "3"])
    done, move = [], replace._Files.move

    def cut_off(self, source, target):
        if target[0].startswith("dt="):
            if len(done) == moves:
                raise OSError("killed")
            done.append(target)
        move(self, source, target)

    monkeypatch.setattr(replace._Files, "move", cut_off)
    with pytest.raises(OSError, match="killed"):
        replace.replace_partitions(frame(spark, [(1, 11), (2, 22), (4, 44)]), path, "dt", ["1", "2", "3", "4"])
    monkeypatch.setattr(replace._Files, "move", move)
    assert days(spark, replace.settled(spark, path)) == [(1, 11), (2, 22), (4, 44)]
    assert [name for name in replace._Files(spark, path).names() if name.startswith(("_staged", "_replace"))] == []


def test_a_month_whose_day_lost_its_orders(spark):
    orders, ext = given.demo(spark, SMALL, "order"), given.demo(spark, SMALL, "order_ext")
    folder, path = staged_path(spark, "exports"), staged_path(spark, "months")
    merge.export_months(orders, ext, given.MONTHS, folder)
    merge.merge_tsv_to_table(spark, folder, given.MONTHS, path)
    before = {r.dt for r in tables.read_positions(spark, path).select("dt").distinct().collect()}
    merge.export_months(orders.where("dt <> 20170210"), ext, given.MONTHS, folder)
    merge.merge_tsv_to_table(spark, folder, [201702], path)
    after = {r.dt for r in tables.read_positions(spark, path).select("dt").distinct().collect()}
    assert 20170210 in before and after == before - {20170210}


def test_a_served_city_without_rows_is_cleared(spark):
    path = staged_path(spark, "info")
    info = given.info(spark, SMALL)
    tables.replace_cities(info, path, ["bj", "sh"], ("geohash",))
    tables.replace_cities(info.where("city = 'sh'"), path, ["bj", "sh"])
    assert {r.city for r in spark.read.parquet(path).select("city").distinct().collect()} == {"sh"}


def totals(spark, path):
    return sorted(map(tuple, spot_counts.spots_of_days(spot_counts.read_day_counts(spark, path)).collect()))


def test_any_batches_give_the_result_of_one(spark):
    rows = given.positions(spark, SMALL).where("dt BETWEEN 20170101 AND 20170104")
    source, path = staged_path(spark, "stream"), staged_path(spark, "counts")
    rows.repartition(6).write.parquet(source)
    whole = spot_counts.day_totals(rows).drop("since")
    want = sorted(map(tuple, spot_counts.spots_of_days(whole).collect()))
    for files, fresh in ((2, True), (4, True), (6, False)):  # the last goes over the table of the one before again
        path = staged_path(spark, "counts") if fresh else path
        stream = spot_counts.order_files(spark, source, files)
        spot_counts.keep_counting(stream, path, staged_path(spark, "state"), delay="30 days").awaitTermination()
        assert totals(spark, path) == want
    # The same batch once more, and an older one after it.
    spot_counts.upsert_days(spot_counts.day_totals(rows), path, 1)
    spot_counts.upsert_days(spot_counts.day_totals(rows.where("service_order_id % 2 = 0")), path, 0)
    assert totals(spark, path) == want
    assert spot_counts.read_day_counts(spark, staged_path(spark, "none")).count() == 0


def test_the_demo_orders_make_the_rules_act(spark):
    from curbwise.operators import recommend

    chains = given.chains(spark, SMALL)
    stepped = recommend.within_step_radius(recommend.candidate_rows(chains))
    assert {r.radius for r in stepped.select("radius").distinct().collect()} == {100, 150, 200, 300, 500, 1000}
    kept = given.kept(spark, SMALL)
    assert 0 < kept.count() < stepped.count()
    found = given.recommendations(spark, SMALL)
    assert 0 < found.count() < chains.points.count()
    named = recommend.flattened(given.named(spark, SMALL))
    fallback = named.where(F.col("name").endswith("-推荐上车点"))
    assert fallback.where("name <> '-推荐上车点'").count() > 0 and fallback.where("name = '-推荐上车点'").count() > 0
    assert 0 < given.named(spark, SMALL).where("regeo = ''").count() < found.count()


def test_tables_whose_staged_folder_is_gone_are_derived_again(spark):
    from verification.queries import REGISTRY

    data = f"file://{SMALL}"  # remembered apart from the tables of the other tests
    names = ("address_marker_trim", "cell_counts")
    with staging_run(spark):
        inside = [sorted(map(tuple, REGISTRY[name].run(spark, data).collect())) for name in names]
    after = [sorted(map(tuple, REGISTRY[name].run(spark, data).collect())) for name in names]
    assert after == inside and all(inside)


def _on_a_cluster(spark):
    other = spark.newSession()
    other.conf.set("spark.master", "spark://host:7077")  # as its sessions say; the work stays here
    return other


def test_a_cluster_stages_in_a_folder_without_a_scheme(spark):
    from verification.queries import REGISTRY

    cluster, data = _on_a_cluster(spark), f"file:{SMALL}"  # remembered apart from the tables of the other tests
    assert "://" not in staging_root(cluster) and staging_root(cluster) == staging_root(spark)
    for name in ("compass_bearing", "address_trim"):
        got = sorted(map(tuple, REGISTRY[name].run(cluster, data).collect()))
        assert got and got == sorted(map(tuple, REGISTRY[name].run(spark, SMALL).collect()))


def test_a_folder_that_executors_do_not_share_is_refused(spark, monkeypatch):
    write = DataFrameWriter.parquet
    monkeypatch.setattr(session, "_shared", set())
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: write(spark.range(0).write, path))
    with pytest.raises(RuntimeError, match="do not share"):
        staging_root(_on_a_cluster(spark))
