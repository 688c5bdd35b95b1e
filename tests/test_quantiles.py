"""Exact quantiles by histograms against percentile."""

import random

from pyspark.sql import functions as F

from curbwise.operators.quantiles import exact_quantiles, value_bucket

SHARES = {"low": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "p90": 0.9, "high": 1.0}


def both(df, keys):
    got = {tuple(r[k] for k in keys): tuple(r[n] for n in SHARES) for r in exact_quantiles(df, keys, "v", SHARES).collect()}
    parts = df.groupBy(*keys).agg(F.percentile("v", F.array(*map(F.lit, SHARES.values()))).alias("p"))
    want = {tuple(r[k] for k in keys): tuple(r.p) for r in parts.where("p IS NOT NULL").collect()}
    return got, want


def close(got, want):
    return got.keys() == want.keys() and all(
        abs(a - b) <= 1e-9 * max(1, abs(b)) for key in want for a, b in zip(got[key], want[key], strict=True)
    )


def test_equal_to_percentile(spark):
    rng = random.Random(2)
    rows = [(None if g == 3 else f"g{g}", rng.choice([rng.gauss(0, 1e6), float(rng.randrange(-3, 4)), 0.0, None, 1e-300, 7.5]))
            for g in range(6) for _ in range(rng.choice([1, 2, 3, 40, 300]))]
    rows += [("only null", None), ("one", 4.25)]
    assert close(*both(spark.createDataFrame(rows, "g string, v double"), ["g"]))
    empty = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(empty, ["g"], "v", SHARES).count() == 0


def test_buckets_never_fall(spark):
    values = sorted([0.0, -1.0, 1.0, 1e-320, -1e-320, 1.7e308, -1.7e308, *[random.Random(4).uniform(-9, 9) for _ in range(500)]])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    buckets = [r.b for r in df.orderBy("v").select(value_bucket(F.col("v")).alias("b")).collect()]
    assert buckets == sorted(buckets)


def test_one_group_of_ten_million_rows(spark):
    # The numbers 0 to 9,999,999 in a mixed order, each once: nothing per group but its buckets is held.
    rows = spark.range(10_000_000).select(F.lit("g").alias("g"), ((F.col("id") * 7_654_321) % 10_000_000).cast("double").alias("v"))
    [row] = exact_quantiles(rows, ["g"], "v", {"q1": 0.25, "q2": 0.5}).collect()
    assert (row.q1, row.q2) == (9_999_999 * 0.25, 9_999_999 * 0.5)
    assert rows.select(value_bucket(F.col("v"))).distinct().count() < 64 * 25
