"""Text helpers: packed spot lists, address trimming, spot names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators of the packed form and the packed element's fields.
FIELD_SEP = ":"
SPOT_SEP = "\t"
SPOT_TYPE = "struct<geohash:string,cnt:bigint,lat:double,lng:double>"

# Address markers, name suffixes and their distances.
ADDRESS_MARKERS = ("街道", "镇", "乡")
DISTRICT_MARKER = "区"
NEARBY_SUFFIX = "附近"
FALLBACK_SUFFIX = "-推荐上车点"
BARE_NAME_M = 20.0

# Compass words and their bearings in degrees.
COMPASS = {"北": 0, "东北": 45, "东": 90, "东南": 135, "南": 180, "西南": 225, "西": 270, "西北": 315}


def pack_spot(geohash: Column, cnt: Column, lat: Column, lng: Column) -> Column:
    return F.concat_ws(FIELD_SEP, geohash, cnt.cast("string"), lat.cast("string"), lng.cast("string"))


def pack_chain(spots: Column) -> Column:
    return F.concat_ws(SPOT_SEP, spots)


def unpack_chain(chain: Column) -> Column:
    """Array of spots; one malformed element empties the whole list."""

    def parse(item: Column) -> Column:
        part = F.split(item, FIELD_SEP)
        return F.struct(
            part.getItem(0).alias("geohash"),
            F.get(part, F.lit(1)).try_cast("bigint").alias("cnt"),
            F.get(part, F.lit(2)).try_cast("double").alias("lat"),
            F.get(part, F.lit(3)).try_cast("double").alias("lng"),
            (F.size(part) == 4).alias("whole"),
        )

    parsed = F.transform(F.split(chain, SPOT_SEP), parse)
    sound = F.forall(
        parsed,
        lambda s: s["whole"] & s["cnt"].isNotNull() & s["lat"].isNotNull() & s["lng"].isNotNull(),
    )
    spots = F.transform(
        parsed,
        lambda s: F.struct(
            s["geohash"].alias("geohash"), s["cnt"].alias("cnt"), s["lat"].alias("lat"), s["lng"].alias("lng")
        ),
    )
    empty = F.array().cast(f"array<{SPOT_TYPE}>")
    return F.when(chain.isNotNull() & (chain != "") & sound, spots).otherwise(empty)


def drop_first(text: Column, part: Column) -> Column:
    """Remove the first occurrence of ``part``; a NULL or empty part removes nothing."""
    literal = F.concat(F.lit(r"\Q"), F.coalesce(part, F.lit("")), F.lit(r"\E"))
    return F.array_join(F.split(text, literal, 2), "")


def trim_by_marker(name: Column, with_district: bool = False) -> Column:
    """Text between the first marker and its next occurrence.

    Markers are tried in order; one at the very start of the name does not count.
    """
    markers = ADDRESS_MARKERS + ((DISTRICT_MARKER,) if with_district else ())
    trimmed = name
    for marker in reversed(markers):
        trimmed = F.when(F.instr(name, marker) > 1, F.split(name, marker).getItem(1)).otherwise(trimmed)
    return trimmed


def trim_address(name: Column, province: Column, city: Column, district: Column, township: Column) -> Column:
    """Short address: without its components, or by marker where it has none."""
    parts = (province, city, district, township)
    short = name
    for part in parts:
        short = drop_first(short, part)
    has_parts = F.coalesce(*parts).isNotNull()
    return F.when(has_parts, short).otherwise(trim_by_marker(name))


def decorated_name(name: Column, distance: Column) -> Column:
    """The bare name when close, else marked as nearby."""
    return F.when(distance <= BARE_NAME_M, name).otherwise(F.concat(name, F.lit(NEARBY_SUFFIX)))


def name_or_fallback(name: Column, address: Column) -> Column:
    """A found name, else the point's address marked as a recommended spot."""
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(F.coalesce(address, F.lit("")), F.lit(FALLBACK_SUFFIX)))


def bearing(word: Column) -> Column:
    """Degrees of a compass word; NULL for any other word."""
    pairs = [F.lit(v) for item in COMPASS.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), word)


def opposite(degrees: Column) -> Column:
    return (degrees + 180) % 360


def parse_lng_lat(pair: Column) -> tuple[Column, Column]:
    """(lat, lng) of a ``"lng,lat"`` string."""
    part = F.split(pair, ",")
    return part.getItem(1).try_cast("double"), part.getItem(0).try_cast("double")


def polyline_points(line: Column) -> Column:
    """The ``"lng,lat"`` strings of a ``;``-separated line, for ``posexplode``."""
    return F.split(line, ";")
