"""Geohash cells: integer cell ids for grouping, base-32 text for output.

A cell id packs the longitude and latitude indices of a cell into one long.
Per-row work (grouping and shuffling every order) uses ids; the text is only
rendered once per aggregated cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbwise.functions.geo import computed_once, gcj_to_wgs, wgs_to_gcj

# Fixed value: the geohash alphabet.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

SPOT_PRECISION = 8
ROUGH_PRECISION = 6
ID_PRECISION = 9
FULL_PRECISION = 12

_AXIS_BITS = 30
_AXIS_CELLS = 1 << _AXIS_BITS


def _bits(precision: int) -> tuple[int, int]:
    """(longitude bits, latitude bits) of a precision."""
    if not isinstance(precision, int) or isinstance(precision, bool):
        raise ValueError("precision must be an integer")
    if not 1 <= precision <= FULL_PRECISION:
        raise ValueError("precision must be between 1 and 12")
    return (5 * precision + 1) // 2, 5 * precision // 2


def wgs_cell(lat: str, lng: str, precision: int) -> str:
    """SQL text of a WGS-84 point's cell id; NULL for a latitude outside [-90, 90)."""
    x_bits, y_bits = _bits(precision)
    turned = f"({lng} - floor(({lng} + 180D) / 360D) * 360D + 180D)"
    x = f"shiftright(floor({turned} / 360D * {_AXIS_CELLS}D), {_AXIS_BITS - x_bits})"
    y = f"shiftright(floor(({lat} + 90D) / 180D * {_AXIS_CELLS}D), {_AXIS_BITS - y_bits})"
    return f"CASE WHEN {lat} >= -90D AND {lat} < 90D THEN shiftleft({x}, {y_bits}) | {y} END"


def with_cell(df: DataFrame, lat: str, lng: str, out: str, precision: int = SPOT_PRECISION) -> DataFrame:
    """Add the cell id of a GCJ-02 point, taken after conversion to WGS-84."""
    wgs_lat, wgs_lng = gcj_to_wgs(lat, lng)
    keep = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*keep, wgs_lat.alias("_wlat"), wgs_lng.alias("_wlng")).select(
        *keep, F.expr(computed_once(wgs_cell("_wlat", "_wlng", precision))).alias(out)
    )


def _char_pairs() -> str:
    """Two-character texts of every (5 longitude bits, 5 latitude bits) block.

    Longitude and latitude bits alternate, longitude first. The list folds to
    one literal, so rendering a cell is a lookup per two characters.
    """
    texts = []
    for x in range(32):
        for y in range(32):
            woven = 0
            for bit in range(4, -1, -1):
                woven = woven << 2 | (x >> bit & 1) << 1 | (y >> bit & 1)
            texts.append(ALPHABET[woven >> 5] + ALPHABET[woven & 31])
    return f"split('{','.join(texts)}', ',')"


_CHAR_PAIRS = _char_pairs()


def cell_text(cell: str, precision: int) -> Column:
    """The base-32 geohash of a cell id."""
    x_bits, y_bits = _bits(precision)
    pairs = (precision + 1) // 2
    x = f"shiftleft(shiftright({cell}, {y_bits}), {5 * pairs - x_bits})"
    y = f"shiftleft({cell} & {(1 << y_bits) - 1}L, {5 * pairs - y_bits})"
    blocks = []
    for up in range(5 * (pairs - 1), -1, -5):
        index = f"(shiftright({x}, {up}) & 31L) * 32L + (shiftright({y}, {up}) & 31L)"
        blocks.append(f"get({_CHAR_PAIRS}, int({index}))")
    return F.expr(f"substring(concat({', '.join(blocks)}), 1, {precision})")


def parent_cell(cell: str, precision: int, parent: int) -> Column:
    """The id of the coarser cell that holds a cell."""
    x_bits, y_bits = _bits(precision)
    px_bits, py_bits = _bits(parent)
    x = f"shiftright({cell}, {y_bits + x_bits - px_bits})"
    y = f"shiftright({cell} & {(1 << y_bits) - 1}L, {y_bits - py_bits})"
    return F.expr(f"shiftleft({x}, {py_bits}) | {y}")


def with_geohash(df: DataFrame, lat: str, lng: str, out: str, precision: int = FULL_PRECISION) -> DataFrame:
    """Add the geohash text of a GCJ-02 point."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    return with_cell(df, lat, lng, "_cell", precision).select(
        *keep, cell_text("_cell", precision).alias(out)
    )


def prefix(geohash: Column, precision: int) -> Column:
    """Truncate a geohash to a coarser precision."""
    return F.substring(geohash, 1, precision)


def order_id(geohash: Column, precision: int) -> Column:
    """The geohash as a number in the order of its text: cells with a common prefix are one range."""
    total = F.lit(0).cast("bigint")
    for at in range(1, precision + 1):
        total = total * len(ALPHABET) + (F.instr(F.lit(ALPHABET), F.substring(geohash, at, 1)) - 1)
    return total


def prefix_range(text: str, precision: int) -> tuple[int, int]:
    """The first order id of the cells with this prefix, and the first beyond them."""
    if len(text) > precision or not set(text) <= set(ALPHABET):
        raise ValueError(f"{text!r} is no prefix of a geohash of {precision} characters")
    first = 0
    for char in text:
        first = first * len(ALPHABET) + ALPHABET.index(char)
    width = len(ALPHABET) ** (precision - len(text))
    return first * width, (first + 1) * width


def with_decoded(df: DataFrame, geohash: str, out_lat: str, out_lng: str) -> DataFrame:
    """Add the GCJ-02 centre of a geohash cell of any length up to 12."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    padded = F.rpad(F.col(geohash), FULL_PRECISION, ALPHABET[0])
    # Of a character's five bits, the outer three belong to one axis and the
    # inner two to the other; the axes swap with every character.
    outer = "".join(str((v >> 4 & 1) * 4 + (v >> 2 & 1) * 2 + (v & 1)) for v in range(32))
    inner = "".join(str((v >> 3 & 1) * 2 + (v >> 1 & 1)) for v in range(32))
    total = 5 * F.length(F.col(geohash))
    df = df.select(
        *keep, F.translate(padded, ALPHABET, outer).alias("_outer"), F.translate(padded, ALPHABET, inner).alias("_inner"),
        F.floor((total + 1) / 2).cast("int").alias("_xb"), F.floor(total / 2).cast("int").alias("_yb"),
    )

    def digit(name: str, at: int) -> Column:
        return F.substring(F.col(name), at + 1, 1).cast("bigint")

    x = y = F.lit(0).cast("bigint")
    for k in range(0, FULL_PRECISION, 2):
        x = x * 32 + digit("_outer", k) * 4 + digit("_inner", k + 1)
        y = y * 32 + digit("_inner", k) * 8 + digit("_outer", k + 1)
    half_x = F.pow(F.lit(2.0), _AXIS_BITS - 1 - F.col("_xb"))
    half_y = F.pow(F.lit(2.0), _AXIS_BITS - 1 - F.col("_yb"))
    df = df.select(
        *keep,
        ((y + half_y) / _AXIS_CELLS * 180.0 - 90.0).alias("_wlat"),
        ((x + half_x) / _AXIS_CELLS * 360.0 - 180.0).alias("_wlng"),
    )
    lat, lng = wgs_to_gcj("_wlat", "_wlng")
    # Generated rather than projected for the same reason as ``computed_once``.
    return df.select(*keep, F.inline(F.array(F.struct(lat.alias(out_lat), lng.alias(out_lng)))))
