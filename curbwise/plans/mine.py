"""From order positions to scored recommendations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from curbwise.functions.calendar import training_days
from curbwise.operators.recommend import recommend, recommend_candidates, unpacked_candidates
from curbwise.operators.spots import Chains, build_chains, cell_pairs
from curbwise.session import stage
from curbwise.sources import tables


def mine_chains(orders: DataFrame) -> Chains:
    """Candidate chains of every city in ``orders``.

    The orders are read once. The folded pairs are staged because four plans
    read them; everything after works on that much smaller table.
    """
    return build_chains(stage(cell_pairs(orders), "pairs"))


def mine(
    spark: SparkSession, positions_path: str, today: dt.date, run_epoch: int, city: str | None = None
) -> DataFrame:
    """Recommendations from the default training window of the positions table."""
    first, last = training_days(today)
    orders = tables.scan_coordinates(spark, positions_path, first, last, city)
    return recommend(mine_chains(orders), run_epoch)


def recommend_packed(packed: DataFrame, run_epoch: int) -> DataFrame:
    """Recommendations from chains kept in the packed text form."""
    return recommend_candidates(*unpacked_candidates(packed), run_epoch)
