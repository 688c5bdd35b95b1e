"""From orders to spots: cell encoding, pre-aggregation, chains of spots.

Scale notes. Orders are reduced to one row per (expected cell, start cell) in
a single pass with map-side combining; everything later reads that small
table. The sums are exact decimals, so two-level aggregation and task retries
give the same bits. A precision-6 cell holds 32 x 32 precision-8 cells, which
bounds every group keyed by the rough cell at 1,024 spots and 1,024 expected
points however many orders a place has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbwise.functions import cells
from curbwise.functions.cells import ROUGH_PRECISION, SPOT_PRECISION
from curbwise.functions.measures import PICO_SUM, joined_sum, pico_degrees, pico_sums, rounded_mean
from curbwise.functions.text import pack_chain, pack_spot
from curbwise.operators.quantiles import exact_quantiles

CELLS_PER_ROUGH = 32 ** (SPOT_PRECISION - ROUGH_PRECISION)
SUPPORT_QUANTILE = 0.75

_SPOT = ["spot", "cnt", "lat", "lng"]


@dataclass(frozen=True)
class Chains:
    """Candidate chains in normal form, one row per point, spot or link.

    points:  city, exp_geohash, exp_rough, exp_lat, exp_lng
    around:  city, rough, spot, cnt, lat, lng      (shared by a rough cell's points)
    cooccur: city, exp_geohash, spot, cnt, lat, lng
    shared:  city, exp_geohash, shared             (cooccur spots that can be around-spots)
    """

    points: DataFrame
    around: DataFrame
    cooccur: DataFrame
    shared: DataFrame


def encode_orders(orders: DataFrame) -> DataFrame:
    """Every order with its expected and start cells as geohash text."""
    coded = cells.with_cell(orders, "expect_start_latitude", "expect_start_longitude", "_exp")
    coded = cells.with_cell(coded, "start_latitude", "start_longitude", "_start")
    text = coded.select(
        "city",
        F.col("expect_start_latitude").alias("exp_lat"), F.col("expect_start_longitude").alias("exp_lng"),
        cells.cell_text("_exp", SPOT_PRECISION).alias("exp_geohash"),
        F.col("start_latitude").alias("start_lat"), F.col("start_longitude").alias("start_lng"),
        cells.cell_text("_start", SPOT_PRECISION).alias("start_geohash"),
    )
    return text.select(
        "*",
        cells.prefix(F.col("exp_geohash"), ROUGH_PRECISION).alias("exp_rough"),
        cells.prefix(F.col("start_geohash"), ROUGH_PRECISION).alias("start_rough"),
    )


def cell_pairs(orders: DataFrame) -> DataFrame:
    """Orders folded to one row per city, expected cell and start cell.

    Groups on integer cell ids: no text is built per order.
    """
    coded = cells.with_cell(orders, "expect_start_latitude", "expect_start_longitude", "exp_cell")
    coded = cells.with_cell(coded, "start_latitude", "start_longitude", "start_cell")
    sides = {
        "exp_lat": "expect_start_latitude", "exp_lng": "expect_start_longitude",
        "start_lat": "start_latitude", "start_lng": "start_longitude",
    }
    whole = coded.where(F.col("exp_cell").isNotNull() & F.col("start_cell").isNotNull()).select(
        "city", "exp_cell", "start_cell", *[pico_degrees(c).alias(n) for n, c in sides.items()]
    )
    folded = whole.groupBy("city", "exp_cell", "start_cell").agg(
        F.count(F.lit(1)).alias("rows"), *[c for n in sides for c in pico_sums(n)]
    )
    return folded.select(
        "city", "exp_cell", "start_cell", "rows", *[joined_sum(n).alias(f"{n}_sum") for n in sides]
    )


def _means(df: DataFrame, keys: list[str], side: str) -> DataFrame:
    """Row count and rounded mean coordinates per key, from the pair sums."""
    total = df.groupBy(*keys).agg(
        F.sum("rows").alias("cnt"),
        F.sum(f"{side}_lat_sum").cast(PICO_SUM).alias("_lat"),
        F.sum(f"{side}_lng_sum").cast(PICO_SUM).alias("_lng"),
    )
    return total.select(
        *keys, "cnt", rounded_mean("_lat", "cnt").alias("lat"), rounded_mean("_lng", "cnt").alias("lng")
    )


def spot_stats(pairs: DataFrame) -> DataFrame:
    """Orders and mean coordinates of every start cell."""
    return _means(pairs, ["city", "start_cell"], "start")


def spot_table(stats: DataFrame) -> DataFrame:
    """Spots with their geohash and rough cell as text."""
    text = stats.select(
        "city", cells.cell_text("start_cell", SPOT_PRECISION).alias("spot"), "cnt", "lat", "lng"
    )
    return text.select("city", cells.prefix(F.col("spot"), ROUGH_PRECISION).alias("rough"), *_SPOT)


def ordered_spots(spots: DataFrame) -> DataFrame:
    """Spots with their ``order_id``, dealt out and sorted by it: what ``prefix_filter`` reads after it is written."""
    numbered = spots.withColumn("order_id", cells.order_id(F.col("spot"), SPOT_PRECISION))
    return numbered.repartitionByRange("order_id").sortWithinPartitions("order_id")


def rough_cell_sets(spots: DataFrame) -> DataFrame:
    """The spots of each rough cell, at most 1,024 of them, as a sorted array."""
    return spots.groupBy("city", "rough").agg(F.sort_array(F.collect_set("spot")).alias("spots"))


def cooccurring_sets(pairs: DataFrame) -> DataFrame:
    """Per expected cell its mean coordinates, and the set and total count of the spots its own riders used."""
    used = attach_spot_stats(pairs.select("city", "exp_cell", "start_cell"), spot_stats(pairs), "start_cell")
    sets = used.groupBy("city", "exp_cell").agg(
        F.sort_array(F.collect_set(cells.cell_text("start_cell", SPOT_PRECISION))).alias("spots"), F.sum("cnt").alias("total")
    )
    text_sets = sets.select("city", cells.cell_text("exp_cell", SPOT_PRECISION).alias("exp_geohash"), "spots", "total")
    return expected_points(pairs).join(text_sets, ["city", "exp_geohash"])


def expected_points(pairs: DataFrame) -> DataFrame:
    """Mean requested coordinates of every expected cell."""
    means = _means(pairs, ["city", "exp_cell"], "exp")
    text = means.select(
        "city", cells.cell_text("exp_cell", SPOT_PRECISION).alias("exp_geohash"),
        F.col("lat").alias("exp_lat"), F.col("lng").alias("exp_lng"),
    )
    return text.select(
        "city", "exp_geohash", cells.prefix(F.col("exp_geohash"), ROUGH_PRECISION).alias("exp_rough"),
        "exp_lat", "exp_lng",
    )


def attach_spot_stats(rows: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Rows with the statistics of their start cell."""
    return rows.join(stats, ["city", key], "left")


def cell_counts(encoded: DataFrame) -> DataFrame:
    """Exact number of distinct expected and start cells per city."""
    return encoded.groupBy("city").agg(
        F.count_distinct("exp_geohash").alias("exp_cells"),
        F.count_distinct("start_geohash").alias("start_cells"),
    )


def support_threshold() -> Column:
    return F.percentile("cnt", F.lit(SUPPORT_QUANTILE))


def upper_quartile(spots: DataFrame, keys: list[str]) -> DataFrame:
    """Spots whose count reaches the exact upper quartile of their group.

    For groups without a size bound: the quantile is a partial aggregate, and
    joining it back lets adaptive execution split a skewed group. Its buffer
    holds the distinct counts of a group; where these may be very many,
    ``upper_quartile_any_size`` holds none.
    """
    limits = spots.groupBy(*keys).agg(support_threshold().alias("_limit"))
    return spots.join(limits, keys).where(F.col("cnt") >= F.col("_limit")).drop("_limit")


def upper_quartile_any_size(spots: DataFrame, keys: list[str]) -> DataFrame:
    """The same for groups of any number of rows and distinct counts."""
    limits = exact_quantiles(spots, keys, "cnt", {"_limit": SUPPORT_QUANTILE})
    return spots.join(limits, keys).where(F.col("cnt") >= F.col("_limit")).drop("_limit")


def upper_quartile_bounded(spots: DataFrame, keys: list[str]) -> DataFrame:
    """The same for groups bounded by a rough cell, in one shuffle."""
    whole = Window.partitionBy(*keys)
    return (
        spots.withColumn("_limit", support_threshold().over(whole))
        .where(F.col("cnt") >= F.col("_limit")).drop("_limit")
    )


def around_spots(spots: DataFrame) -> DataFrame:
    """Well-supported spots of each rough cell."""
    return upper_quartile_bounded(spots, ["city", "rough"])


def cooccurring_spots(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    """Well-supported spots among those each expected cell's own riders used.

    A spot's count is its total over the whole city and window.
    """
    used = attach_spot_stats(pairs.select("city", "exp_cell", "start_cell"), stats, "start_cell")
    kept = upper_quartile(used, ["city", "exp_cell"])
    return kept.select(
        "city", cells.cell_text("exp_cell", SPOT_PRECISION).alias("exp_geohash"),
        cells.cell_text("start_cell", SPOT_PRECISION).alias("spot"), "cnt", "lat", "lng",
    )


def shared_spots(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    """Well-supported co-occurring spots of the point's own rough cell, as an array.

    Only these can also be around-spots. The quantile looks at all linked spots
    but the array holds one rough cell's, at most 1,024, so one aggregate gives
    both and the links need no second join.
    """
    used = attach_spot_stats(pairs.select("city", "exp_cell", "start_cell"), stats, "start_cell")
    own = cells.parent_cell("start_cell", SPOT_PRECISION, ROUGH_PRECISION) == cells.parent_cell(
        "exp_cell", SPOT_PRECISION, ROUGH_PRECISION
    )
    spot = cells.cell_text("start_cell", SPOT_PRECISION)
    folded = used.groupBy("city", "exp_cell").agg(
        support_threshold().alias("_limit"),
        F.collect_list(F.when(own, F.struct(spot.alias("spot"), "cnt"))).alias("_own"),
    )
    kept = F.filter("_own", lambda s: s["cnt"] >= F.col("_limit"))
    return folded.select(
        "city", cells.cell_text("exp_cell", SPOT_PRECISION).alias("exp_geohash"),
        F.transform(kept, lambda s: s["spot"]).alias("shared"),
    )


def build_chains(pairs: DataFrame) -> Chains:
    stats = spot_stats(pairs)
    return Chains(
        points=expected_points(pairs),
        around=around_spots(spot_table(stats)),
        cooccur=cooccurring_spots(pairs, stats),
        shared=shared_spots(pairs, stats),
    )


def around_join(points: DataFrame, around: DataFrame, how: str = "left") -> DataFrame:
    """Expected points with every spot of their own rough cell (no neighbours)."""
    return points.join(
        around.withColumnRenamed("rough", "exp_rough"), ["city", "exp_rough"], how
    )


def chain_rows(chains: Chains) -> DataFrame:
    """Long form: one row per expected point, kind and spot.

    A point without around-spots keeps one row with a NULL spot.
    """
    columns = ["city", "exp_geohash", "exp_lat", "exp_lng", "kind", *_SPOT]
    around = around_join(chains.points, chains.around).withColumn("kind", F.lit("around"))
    linked = chains.points.join(chains.cooccur, ["city", "exp_geohash"]).withColumn("kind", F.lit("cooccur"))
    return around.select(*columns).unionByName(linked.select(*columns))


def packed_chains(chains: Chains) -> DataFrame:
    """The text form: a line per expected point and rough cell of its co-occurring spots.

    The line of the point's own rough cell is always there and carries the
    around list. Both lists are bounded by a rough cell, at every size of the
    data; readers take all lines of a point together.
    """
    packed = pack_spot(F.col("spot"), F.col("cnt"), F.col("lat"), F.col("lng"))
    around = chains.around.groupBy("city", F.col("rough").alias("_own")).agg(
        pack_chain(F.sort_array(F.collect_set(packed))).alias("arounds")
    )
    items = chains.cooccur.select(
        "city", "exp_geohash", cells.prefix(F.col("spot"), ROUGH_PRECISION).alias("_rough"), packed.alias("item")
    )
    own_lines = chains.points.select(
        "city", "exp_geohash", F.col("exp_rough").alias("_rough"), F.lit(None).cast("string").alias("item")
    )
    linked = items.unionByName(own_lines).groupBy("city", "exp_geohash", "_rough").agg(
        pack_chain(F.sort_array(F.collect_set("item"))).alias("cooccurs")
    )
    lines = chains.points.join(linked, ["city", "exp_geohash"]).withColumn(
        "_own", F.when(F.col("_rough") == F.col("exp_rough"), F.col("_rough"))
    )
    return lines.join(around, ["city", "_own"], "left").select(
        "city", "exp_geohash", F.coalesce("arounds", F.lit("")).alias("arounds"), "exp_lat", "exp_lng", "cooccurs"
    )
