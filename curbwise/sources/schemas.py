"""Explicit schemas of the inputs and of the published tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "float": T.FloatType(), "smallint": T.ShortType(), "tinyint": T.ByteType(),
}


def _fields(**kinds: str) -> list[T.StructField]:
    """Nullable fields given as ``type="name name …"`` groups keep their order per group."""
    return [T.StructField(name, _TYPES[kind]) for kind, names in kinds.items() for name in names.split()]


def _field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, _TYPES[kind])


_ORDER_FIELDS = [
    _field("dt", "int"), _field("city", "string"),
    *_fields(bigint="service_order_id user_id driver_id", int="start_time end_time"),
    *_fields(string="start_position start_address end_position end_address"),
    *_fields(
        double="expect_start_latitude expect_start_longitude expect_end_latitude expect_end_longitude "
        "start_latitude start_longitude end_latitude end_longitude"
    ),
]
_EXT_FIELDS = [
    _field("dt", "int"), _field("dest_city", "string"), _field("service_order_id", "bigint"),
    *_fields(
        double="create_order_longitude create_order_latitude confirm_latitude confirm_longitude "
        "arrive_latitude arrive_longitude"
    ),
]

ORDER_EXPORT = T.StructType(_ORDER_FIELDS)
EXT_EXPORT = T.StructType(_EXT_FIELDS)
RAW_ORDER = T.StructType(
    [*_ORDER_FIELDS, _field("status", "int"), _field("passenger_name", "string"), _field("update_time", "bigint")]
)
RAW_EXT = T.StructType([*_EXT_FIELDS, _field("update_time", "bigint")])

EXT_COORDINATES = EXT_EXPORT.names[3:]
POSITION_COLUMNS = ORDER_EXPORT.names[1:] + EXT_COORDINATES
POSITIONS = T.StructType([*_ORDER_FIELDS[1:], *_EXT_FIELDS[3:], _field("dt", "int")])

PACKED_CHAIN = T.StructType(
    [_field("exp_geohash", "string"), _field("arounds", "string"),
     *_fields(double="exp_lat exp_lng"), _field("cooccurs", "string")]
)

_POINT_FIELDS = [
    _field("id", "string"), *_fields(double="lat lng score"), _field("count", "bigint"), _field("status", "int"),
    *_fields(string="ext tag", int="show pick"),
]
RECOMM_POINT = T.StructType(_POINT_FIELDS)
NAMED_POINT = T.StructType([*_POINT_FIELDS, _field("name", "string")])

_RECOMMENDATION_FIELDS = [
    *_fields(string="city startPos", double="lat lng", int="radius num", bigint="update")
]
RECOMMENDATION = T.StructType(
    [*_RECOMMENDATION_FIELDS, T.StructField("recomms", T.ArrayType(RECOMM_POINT))]
)
NAMED_RECOMMENDATION = T.StructType(
    [*_RECOMMENDATION_FIELDS, T.StructField("recomms", T.ArrayType(NAMED_POINT)), _field("regeo", "string")]
)

INFO = T.StructType(
    _fields(string="geohash city regeo", smallint="radius num", int="create_time update_time")
)
DETAIL = T.StructType(
    [*_fields(string="exp_geohash city id", double="lat lng"), _field("name", "string"),
     _field("score", "float"), _field("tag", "string"), _field("status", "tinyint"),
     *_fields(int="count show pick"), _field("ext", "string"), *_fields(int="create_time update_time")]
)
