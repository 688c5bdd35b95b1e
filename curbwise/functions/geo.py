"""Earth distances and the GCJ-02 datum offset as native expressions.

Coordinates are given as column names (or any SQL text), and formulas are SQL
text: the JVM parses one string instead of being driven node by node. The
ellipsoidal solutions iterate, so they are DataFrame helpers (``with_*``); each
step is one projection, which keeps expressions small and the whole loop inside
generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Mean sphere radius, WGS-84 axes, datum ellipsoid, datum box.
SPHERE_RADIUS_M = 6371000.0
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = (1 - WGS84_F) * WGS84_A
DATUM_A = 6378137.0
DATUM_E2 = 0.00669342162296594323
DATUM_LNG_RANGE = (72.004, 137.8347)
DATUM_LAT_RANGE = (0.8293, 55.8271)

# Steps after which the ellipsoid iteration is exact to a micrometre: each step
# shrinks the error about 300-fold, so near points need few.
NEAR_STEPS = 3
FAR_STEPS = 8

# Up to this reach the chord through the earth, with the bend of a sphere of this
# radius, is the ellipsoid distance to about ten nanometres (see ``near_m``).
CHORD_REACH_M = 1_000.0
CHORD_RADIUS_M = 6_367_000.0

_TINY = "1e-300D"


def computed_once(expression: str) -> str:
    """SQL text that the optimizer will not copy into a filter below it.

    A predicate on a computed column is pushed down by substituting the
    column's expression, which repeats a long formula per row and multiplies
    through chained steps. A one-element explode keeps the value a plain column
    for later filters and joins, still inside generated code.
    """
    return f"explode(array({expression}))"


def haversine_m(lat1: str, lng1: str, lat2: str, lng2: str) -> Column:
    """Great-circle distance in metres."""
    return F.expr(
        f"{2 * SPHERE_RADIUS_M}D * asin(sqrt("
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians({lng2} - {lng1}) / 2), 2)))"
    )


def _outside(lat: str, lng: str) -> str:
    (west, east), (south, north) = DATUM_LNG_RANGE, DATUM_LAT_RANGE
    return f"NOT ({lng} BETWEEN {west}D AND {east}D AND {lat} BETWEEN {south}D AND {north}D)"


def outside_datum(lat: str, lng: str) -> Column:
    """True where the GCJ-02 offset does not apply."""
    return F.expr(_outside(lat, lng))


def _offset_m(east: str, north: str) -> tuple[str, str]:
    """Raw (north, east) offset at a place given as degrees from 105E 35N."""
    # The numbers of the public GCJ-02 offset formula.
    shared = f"20D * sin({east} * pi() * 6D) + 20D * sin({east} * pi() * 2D)"
    north_waves = (
        f"20D * sin({north} * pi() / 1D) + 40D * sin({north} * pi() / 3D)"
        f" + 160D * sin({north} * pi() / 12D) + 320D * sin({north} * pi() / 30D)"
    )
    east_waves = (
        f"20D * sin({east} * pi() / 1D) + 40D * sin({east} * pi() / 3D)"
        f" + 150D * sin({east} * pi() / 12D) + 300D * sin({east} * pi() / 30D)"
    )
    to_north = (
        f"(-100D + 2D * {east} + 3D * {north} + 0.2D * {north} * {north} + 0.1D * {east} * {north} "
        f"+ 0.2D * sqrt(abs({east})) + ({shared} + {north_waves}) * 2D / 3D)"
    )
    to_east = (
        f"(300D + {east} + 2D * {north} + 0.1D * {east} * {east} + 0.1D * {east} * {north} "
        f"+ 0.1D * sqrt(abs({east})) + ({shared} + {east_waves}) * 2D / 3D)"
    )
    return to_north, to_east


def datum_offset_m(east: str, north: str) -> tuple[Column, Column]:
    to_north, to_east = _offset_m(east, north)
    return F.expr(to_north), F.expr(to_east)


def _offset_deg(lat: str, lng: str) -> tuple[str, str]:
    to_north, to_east = _offset_m(f"({lng} - 105D)", f"({lat} - 35D)")
    curve = f"(1D - {DATUM_E2}D * pow(sin(radians({lat})), 2))"
    return (
        f"degrees({to_north} * {curve} * sqrt({curve}) / {DATUM_A * (1 - DATUM_E2)}D)",
        f"degrees({to_east} * sqrt({curve}) / ({DATUM_A}D * cos(radians({lat}))))",
    )


def datum_offset_deg(lat: str, lng: str) -> tuple[Column, Column]:
    """The GCJ-02 offset in degrees (latitude, longitude)."""
    d_lat, d_lng = _offset_deg(lat, lng)
    return F.expr(d_lat), F.expr(d_lng)


def _shifted(lat: str, lng: str, sign: str) -> tuple[Column, Column]:
    d_lat, d_lng = _offset_deg(lat, lng)
    away = _outside(lat, lng)
    return (
        F.expr(f"CASE WHEN {away} THEN {lat} ELSE {lat} {sign} {d_lat} END"),
        F.expr(f"CASE WHEN {away} THEN {lng} ELSE {lng} {sign} {d_lng} END"),
    )


def gcj_to_wgs(lat: str, lng: str) -> tuple[Column, Column]:
    """One-step inverse: the offset at the GCJ point is taken off it."""
    return _shifted(lat, lng, "-")


def wgs_to_gcj(lat: str, lng: str) -> tuple[Column, Column]:
    return _shifted(lat, lng, "+")


def _series_c(cos_sq: str) -> str:
    return f"({WGS84_F / 16}D * {cos_sq} * (4D + {WGS84_F}D * (4D - 3D * {cos_sq})))"


def _series_ab(cos_sq: str) -> tuple[str, str]:
    u = f"({cos_sq} * {(WGS84_A**2 - WGS84_B**2) / WGS84_B**2}D)"
    return (
        f"(1D + {u} / 16384D * (4096D + {u} * (-768D + {u} * (320D - 175D * {u}))))",
        f"({u} / 1024D * (256D + {u} * (-128D + {u} * (74D - 47D * {u}))))",
    )


def _delta_sigma(b: str, sin_s: str, cos_s: str, mid: str) -> str:
    return (
        f"({b} * {sin_s} * ({mid} + {b} / 4D * ({cos_s} * (2D * {mid} * {mid} - 1D) "
        f"- {b} / 6D * {mid} * (4D * {sin_s} * {sin_s} - 3D) * (4D * {mid} * {mid} - 3D))))"
    )


def _reduced(lat: str) -> str:
    return f"atan({1 - WGS84_F}D * tan(radians({lat})))"


def with_ellipsoid_m(
    df: DataFrame, lat1: str, lng1: str, lat2: str, lng2: str, out: str, steps: int = NEAR_STEPS
) -> DataFrame:
    """Add the Vincenty distance in metres between two points of each row.

    All steps are aliases of one select; the analyzer turns aliases that use
    earlier ones into a chain of projections.
    """
    keep = [f"`{c}`" for c in df.columns]
    terms = [
        f"sin({_reduced(lat1)}) AS _s1", f"cos({_reduced(lat1)}) AS _c1",
        f"sin({_reduced(lat2)}) AS _s2", f"cos({_reduced(lat2)}) AS _c2",
        f"radians({lng2} - {lng1}) AS _dl",
    ]
    lam = "_dl"
    for step in range(steps + 1):
        along = f"(_c1 * _s2 - _s1 * _c2 * cos({lam}))"
        ss, cs, sa, ca = (f"_{n}{step}" for n in ("ss", "cs", "sa", "ca"))
        terms += [
            f"greatest(sqrt(pow(_c2 * sin({lam}), 2) + {along} * {along}), {_TINY}) AS {ss}",
            f"_s1 * _s2 + _c1 * _c2 * cos({lam}) AS {cs}",
            f"_c1 * _c2 * sin({lam}) / {ss} AS {sa}",
            f"greatest(1D - {sa} * {sa}, {_TINY}) AS {ca}",
        ]
        mid = f"({cs} - 2D * _s1 * _s2 / {ca})"
        if step == steps:
            break
        c = _series_c(ca)
        lam = f"_lam{step}"
        terms.append(
            f"_dl + (1D - {c}) * {WGS84_F}D * {sa} * (atan2({ss}, {cs}) + {c} * {ss} * "
            f"({mid} + {c} * {cs} * (2D * {mid} * {mid} - 1D))) AS {lam}"
        )
    big_a, big_b = _series_ab(ca)
    terms += [f"{mid} AS _mid", f"{big_a} AS _a", f"{big_b} AS _b", f"atan2({ss}, {cs}) AS _sigma"]
    df = df.selectExpr(*keep, *terms)
    return df.selectExpr(
        *keep,
        computed_once(f"{WGS84_B}D * _a * (_sigma - {_delta_sigma('_b', ss, cs, '_mid')})") + f" AS `{out}`",
    )


def axis_and_plane_m(lat: str) -> tuple[str, str]:
    """SQL text of a place's metres from the earth's axis and from the equator's plane, on the ellipsoid."""
    e2 = WGS84_F * (2 - WGS84_F)
    sine = f"sin(radians({lat}))"
    normal = f"({WGS84_A}D / sqrt(1D - {e2}D * {sine} * {sine}))"
    return f"({normal} * cos(radians({lat})))", f"({normal} * {1 - e2}D * {sine})"


def near_m(axis1: str, plane1: str, lng1: str, axis2: str, plane2: str, lng2: str) -> str:
    """SQL text of the ellipsoid distance of two places at most ``CHORD_REACH_M`` apart.

    The places come as ``axis_and_plane_m``, so that nothing of one place alone
    is computed per pair. A geodesic is longer than its chord c by c^3 / 24 R^2,
    28 nm at 300 m and 1 um at 1 km; R differs by half a percent between places
    and courses, which leaves 1e-8 m. Vincenty's iteration after ``NEAR_STEPS``
    is no closer to its own limit. Holds at the poles and across 180 degrees.
    """
    turn = f"(2D * sin(radians({lng2} - {lng1}) / 2D))"
    square = (
        f"(({axis2} - {axis1}) * ({axis2} - {axis1}) + ({plane2} - {plane1}) * ({plane2} - {plane1})"
        f" + {axis1} * {axis2} * {turn} * {turn})"
    )
    return f"(sqrt({square}) * (1D + {square} * {1 / (24 * CHORD_RADIUS_M**2)}D))"


def whole_mm(metres: Column) -> Column:
    """Metres, from 0 on, rounded half up to millimetres; ``round`` would go through a decimal for every row."""
    return F.floor(metres * 1000 + 0.5).cast("double") / 1000


def with_destination(
    df: DataFrame, lat: str, lng: str, bearing: str, metres: str,
    out_lat: str, out_lng: str, steps: int = FAR_STEPS,
) -> DataFrame:
    """Add the point reached from (lat, lng) on a bearing after some metres.

    Rows whose bearing or distance is NULL get NULL outputs.
    """
    keep = [f"`{c}`" for c in df.columns]
    course = ["_s1", "_c1", "_sb", "_cb"]
    df = df.selectExpr(
        *keep, f"sin({_reduced(lat)}) AS _s1", f"cos({_reduced(lat)}) AS _c1",
        f"sin(radians({bearing})) AS _sb", f"cos(radians({bearing})) AS _cb",
    )
    df = df.selectExpr(
        *keep, *course, "atan2(_s1, _c1 * _cb) AS _g1", "_c1 * _sb AS _sa", "1D - pow(_c1 * _sb, 2) AS _ca"
    )
    big_a, big_b = _series_ab("_ca")
    fixed = [*course, "_g1", "_sa", "_ca", "_base", "_b"]
    df = df.selectExpr(*keep, *fixed[:7], f"{metres} / ({WGS84_B}D * {big_a}) AS _base", f"{big_b} AS _b")
    df = df.selectExpr(*keep, *fixed, "_base AS _sig")
    for _ in range(steps):
        nxt = _delta_sigma("_b", "sin(_sig)", "cos(_sig)", "cos(2D * _g1 + _sig)")
        df = df.selectExpr(*keep, *fixed, f"_base + {nxt} AS _sig")
    c, mid = _series_c("_ca"), "cos(2D * _g1 + _sig)"
    back = "(_s1 * sin(_sig) - _c1 * cos(_sig) * _cb)"
    return df.selectExpr(
        *keep,
        f"degrees(atan2(_s1 * cos(_sig) + _c1 * sin(_sig) * _cb, "
        f"{1 - WGS84_F}D * sqrt(_sa * _sa + {back} * {back}))) AS `{out_lat}`",
        f"{lng} + degrees(atan2(sin(_sig) * _sb, _c1 * cos(_sig) - _s1 * sin(_sig) * _cb) "
        f"- (1D - {c}) * {WGS84_F}D * _sa * (_sig + {c} * sin(_sig) * "
        f"({mid} + {c} * cos(_sig) * (2D * {mid} * {mid} - 1D)))) AS `{out_lng}`",
    )
