"""Name every recommendation and its points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.functions.text import name_or_fallback
from curbwise.operators.naming import attach_names, chosen_names, nearest_addresses
from curbwise.operators.recommend import flattened, with_recommendations
from curbwise.session import stage


def name_recommendations(recommendations: DataFrame, pois: DataFrame, addresses: DataFrame) -> DataFrame:
    """Add ``name`` to every point and ``regeo`` to every recommendation.

    A point without a point of interest around it is named by the nearest
    address in reach; ``regeo`` is that of the expected point, empty where
    nothing is in reach. Both kinds of places are searched together.
    ``recommendations`` is read several times: pass a table, not a long plan.
    """
    kept = with_recommendations(recommendations)
    points = flattened(kept).select(
        "city", "startPos", "rank", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng")
    )
    names = chosen_names(points, pois)
    named = stage(points.join(names, ["city", "startPos", "rank"], "left"), "names")
    asked = named.where(F.coalesce("name", F.lit("")) == "").select("lat", "lng").union(kept.select("lat", "lng"))
    near = nearest_addresses(asked, addresses).select("lat", "lng", "address")
    shown = named.join(near, ["lat", "lng"], "left").select(
        "city", "startPos", "rank", name_or_fallback(F.col("name"), F.col("address")).alias("name")
    )
    located = attach_names(kept, shown).join(near, ["lat", "lng"], "left")
    return located.select(*kept.columns, F.coalesce("address", F.lit("")).alias("regeo"))
