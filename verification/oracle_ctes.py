"""Named DuckDB subqueries from which the oracle statements are assembled.

They restate each operator in plain SQL over whole tables, on purpose without
the engine's shortcuts: no cell ids, no pre-aggregation, no grids.
"""

from __future__ import annotations

import re

from curbwise.sources.demo import DEMO_SQL

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
F_ = "(1 / 298.257223563)"
A_ = "6378137.0"
B_ = f"({A_} * (1 - {F_}))"
PI = "pi()"


def offset(lat: str, lng: str) -> tuple[str, str]:
    x, y = f"(({lng}) - 105.0::DOUBLE)", f"(({lat}) - 35.0::DOUBLE)"
    common = f"20 * sin(6 * {x} * {PI}) + 20 * sin(2 * {x} * {PI})"
    north = (
        f"(-100 + 2 * {x} + 3 * {y} + 0.2::DOUBLE * {y} * {y} + 0.1::DOUBLE * {x} * {y} + 0.2::DOUBLE * sqrt(abs({x}))"
        f" + 2.0::DOUBLE / 3 * ({common} + 20 * sin({y} * {PI}) + 40 * sin({y} * {PI} / 3)"
        f" + 160 * sin({y} * {PI} / 12) + 320 * sin({y} * {PI} / 30)))"
    )
    east = (
        f"(300 + {x} + 2 * {y} + 0.1::DOUBLE * {x} * {x} + 0.1::DOUBLE * {x} * {y} + 0.1::DOUBLE * sqrt(abs({x}))"
        f" + 2.0::DOUBLE / 3 * ({common} + 20 * sin({x} * {PI}) + 40 * sin({x} * {PI} / 3)"
        f" + 150 * sin({x} * {PI} / 12) + 300 * sin({x} * {PI} / 30)))"
    )
    return north, east


def offset_deg(lat: str, lng: str) -> tuple[str, str]:
    north, east = offset(lat, lng)
    w = f"(1 - 0.00669342162296594323::DOUBLE * pow(sin(({lat}) / 180 * {PI}), 2))"
    return (
        f"({north} * 180 / (({A_} * (1 - 0.00669342162296594323::DOUBLE)) / ({w} * sqrt({w})) * {PI}))",
        f"({east} * 180 / ({A_} / sqrt({w}) * cos(({lat}) / 180 * {PI}) * {PI}))",
    )


def outside(lat: str, lng: str) -> str:
    return f"(({lng}) < 72.004 OR ({lng}) > 137.8347 OR ({lat}) < 0.8293 OR ({lat}) > 55.8271)"


def to_wgs(lat: str, lng: str) -> tuple[str, str]:
    a, b = offset_deg(lat, lng)
    o = outside(lat, lng)
    return f"CASE WHEN {o} THEN {lat} ELSE {lat} - {a} END", f"CASE WHEN {o} THEN {lng} ELSE {lng} - {b} END"


def to_gcj(lat: str, lng: str) -> tuple[str, str]:
    a, b = offset_deg(lat, lng)
    o = outside(lat, lng)
    return f"CASE WHEN {o} THEN {lat} ELSE {lat} + {a} END", f"CASE WHEN {o} THEN {lng} ELSE {lng} + {b} END"


def geohash(wlat: str, wlng: str, precision: int) -> str:
    x = f"CAST(floor(({wlng} + 180) / 360 * 1073741824) AS BIGINT)"
    y = f"CAST(floor(({wlat} + 90) / 180 * 1073741824) AS BIGINT)"
    bit = f"((CASE WHEN (5 * k + j) % 2 = 0 THEN {x} ELSE {y} END) >> (29 - (5 * k + j) // 2)) & 1"
    return (
        f"array_to_string([substr('{ALPHABET}', 1 + CAST(list_sum([({bit}) << (4 - j) for j in range(5)]) AS INT), 1)"
        f" for k in range({precision})], '')"
    )


def with_geohash(source: str, lat: str, lng: str, out: str, precision: int) -> str:
    """A subquery adding the geohash of a GCJ-02 point."""
    a, b = to_wgs(lat, lng)
    return (
        f"(SELECT * EXCLUDE (wla_, wln_), {geohash('wla_', 'wln_', precision)} AS {out}"
        f" FROM (SELECT *, {a} AS wla_, {b} AS wln_ FROM {source}))"
    )


def with_distance(source: str, lat1: str, lng1: str, lat2: str, lng2: str, out: str, rounds: int = 6) -> str:
    """A subquery adding the ellipsoid distance, iterated to convergence."""
    q = (
        f"(SELECT *, atan((1 - {F_}) * tan(radians({lat1}))) AS u1_, atan((1 - {F_}) * tan(radians({lat2}))) AS u2_,"
        f" radians({lng2} - {lng1}) AS dl_, radians({lng2} - {lng1}) AS lam_ FROM {source})"
    )
    temps = "ss_, cs_, sa_, ca_, m_, c_"
    parts = (
        "sqrt(pow(cos(u2_) * sin(lam_), 2) + pow(cos(u1_) * sin(u2_) - sin(u1_) * cos(u2_) * cos(lam_), 2)) AS ss_,"
        " sin(u1_) * sin(u2_) + cos(u1_) * cos(u2_) * cos(lam_) AS cs_,"
        " CASE WHEN ss_ = 0 THEN 0 ELSE cos(u1_) * cos(u2_) * sin(lam_) / ss_ END AS sa_,"
        " 1 - sa_ * sa_ AS ca_,"
        " CASE WHEN ca_ = 0 THEN 0 ELSE cs_ - 2 * sin(u1_) * sin(u2_) / ca_ END AS m_,"
        f" {F_} / 16 * ca_ * (4 + {F_} * (4 - 3 * ca_)) AS c_"
    )
    for _ in range(rounds):
        q = (
            f"(SELECT * EXCLUDE (lam_, {temps}), dl_ + (1 - c_) * {F_} * sa_ *"
            f" (atan2(ss_, cs_) + c_ * ss_ * (m_ + c_ * cs_ * (2 * m_ * m_ - 1))) AS lam_"
            f" FROM (SELECT *, {parts} FROM {q}))"
        )
    return (
        f"(SELECT * EXCLUDE (u1_, u2_, dl_, lam_, {temps}, uu_, aa_, bb_), {B_} * aa_ * (atan2(ss_, cs_) - bb_ * ss_ *"
        f" (m_ + bb_ / 4 * (cs_ * (2 * m_ * m_ - 1) - bb_ / 6 * m_ * (4 * ss_ * ss_ - 3) * (4 * m_ * m_ - 3)))) AS {out}"
        f" FROM (SELECT *, ca_ * ({A_} * {A_} - {B_} * {B_}) / ({B_} * {B_}) AS uu_,"
        " 1 + uu_ / 16384 * (4096 + uu_ * (-768 + uu_ * (320 - 175 * uu_))) AS aa_,"
        " uu_ / 1024 * (256 + uu_ * (-128 + uu_ * (74 - 47 * uu_))) AS bb_"
        f" FROM (SELECT *, {parts} FROM {q})))"
    )


def destination(source: str, lat: str, lng: str, bearing: str, metres: str, rounds: int = 10) -> str:
    """A subquery adding to_lat_, to_lng_: the point reached along a bearing."""
    q = (
        f"(SELECT *, atan((1 - {F_}) * tan(radians({lat}))) AS u_, radians({bearing}) AS b_,"
        " atan2(tan(u_), cos(b_)) AS g_, cos(u_) * sin(b_) AS sa_, 1 - sa_ * sa_ AS ca_,"
        f" ca_ * ({A_} * {A_} - {B_} * {B_}) / ({B_} * {B_}) AS uu_,"
        " 1 + uu_ / 16384 * (4096 + uu_ * (-768 + uu_ * (320 - 175 * uu_))) AS aa_,"
        " uu_ / 1024 * (256 + uu_ * (-128 + uu_ * (74 - 47 * uu_))) AS bb_,"
        f" {metres} / ({B_} * aa_) AS base_, {metres} / ({B_} * aa_) AS s_ FROM {source})"
    )
    for _ in range(rounds):
        q = (
            "(SELECT * EXCLUDE (s_), base_ + bb_ * sin(s_) * (cos(2 * g_ + s_) + bb_ / 4 * (cos(s_) *"
            " (2 * pow(cos(2 * g_ + s_), 2) - 1) - bb_ / 6 * cos(2 * g_ + s_) * (4 * pow(sin(s_), 2) - 3) *"
            f" (4 * pow(cos(2 * g_ + s_), 2) - 3))) AS s_ FROM {q})"
        )
    return (
        f"(SELECT * EXCLUDE (u_, b_, g_, sa_, ca_, uu_, aa_, bb_, base_, s_, c_),"
        f" degrees(atan2(sin(u_) * cos(s_) + cos(u_) * sin(s_) * cos(b_), (1 - {F_}) *"
        " sqrt(sa_ * sa_ + pow(sin(u_) * sin(s_) - cos(u_) * cos(s_) * cos(b_), 2)))) AS to_lat_,"
        f" {lng} + degrees(atan2(sin(s_) * sin(b_), cos(u_) * cos(s_) - sin(u_) * sin(s_) * cos(b_))"
        f" - (1 - c_) * {F_} * sa_ * (s_ + c_ * sin(s_) * (cos(2 * g_ + s_) + c_ * cos(s_) *"
        f" (2 * pow(cos(2 * g_ + s_), 2) - 1)))) AS to_lng_"
        f" FROM (SELECT *, {F_} / 16 * ca_ * (4 + {F_} * (4 - 3 * ca_)) AS c_ FROM {q}))"
    )


def mean6(column: str) -> str:
    """Mean of micro-degree values rounded half-up, in whole numbers."""
    return (
        f"((2 * sum(CAST(round({column} * 1000000) AS BIGINT)) + count(*)) // (2 * count(*))) / 1000000.0::DOUBLE"
    )


VALID_ORDER = (
    "status = 7 AND start_latitude > 0 AND start_longitude > 0"
    " AND expect_start_latitude > 0 AND expect_start_longitude > 0"
)
VALID_EXT = (
    "create_order_longitude > 0 AND create_order_latitude > 0 AND arrive_latitude > 0 AND arrive_longitude > 0"
)
ORDER_COLUMNS = (
    "city, service_order_id, user_id, driver_id, start_time, end_time, start_position, start_address, end_position,"
    " end_address, expect_start_latitude, expect_start_longitude, expect_end_latitude, expect_end_longitude,"
    " start_latitude, start_longitude, end_latitude, end_longitude"
)
EXT_COLUMNS = (
    "create_order_longitude, create_order_latitude, confirm_latitude, confirm_longitude, arrive_latitude, arrive_longitude"
)
TYPES = ("10", "99", "1507", "1505", "1508", "1506", "1504", "1502", "120302", "1903")
TYPE_RANK = "CASE " + " ".join(f"WHEN typecode LIKE '{t}%' THEN {i}" for i, t in enumerate(TYPES)) + " END"
STEP = (
    "CASE WHEN d_ <= 100 THEN 100 WHEN d_ <= 150 THEN 150 WHEN d_ <= 200 THEN 200"
    " WHEN d_ <= 300 THEN 300 WHEN d_ <= 500 THEN 500 WHEN d_ <= 1000 THEN 1000 END"
)
RUN = 1491000000
NOW = 1500000000


def first_removed(text: str, part: str) -> str:
    return (
        f"CASE WHEN {part} IS NULL OR {part} = '' OR strpos({text}, {part}) = 0 THEN {text}"
        f" ELSE substr({text}, 1, strpos({text}, {part}) - 1) || substr({text}, strpos({text}, {part}) + length({part})) END"
    )


def marker_trim(name: str, markers: tuple[str, ...] = ("街道", "镇", "乡")) -> str:
    cases = " ".join(f"WHEN strpos({name}, '{m}') > 1 THEN string_split({name}, '{m}')[2]" for m in markers)
    return f"CASE {cases} ELSE {name} END"


def short_address(source: str) -> str:
    """A subquery adding ``short``: the trimmed formatted address."""
    q = f"(SELECT *, formatted_address AS s0_ FROM {source})"
    for i, part in enumerate(("province", "address_city", "district", "township")):
        q = f"(SELECT *, {first_removed(f's{i}_', part)} AS s{i + 1}_ FROM {q})"
    return (
        f"(SELECT * EXCLUDE (s0_, s1_, s2_, s3_, s4_), CASE WHEN coalesce(province, address_city, district, township)"
        f" IS NULL THEN {marker_trim('formatted_address')} ELSE s4_ END AS short FROM {q})"
    )


def nearest_address(places: str) -> str:
    """A subquery (lat, lng, address, point_id): the nearest address within a kilometre of each place, by whole millimetres."""
    pairs = with_distance(
        f"(SELECT q.lat, q.lng, a.point_id, a.short, a.lat AS pla, a.lng AS pln FROM {places} q JOIN short_address_rows a"
        " ON abs(q.lat - a.lat) < 0.0101 AND abs(q.lng - a.lng) < 0.0135)",
        "lat", "lng", "pla", "pln", "m",
    )
    return (
        "(SELECT lat, lng, b.a AS address, b.i AS point_id FROM (SELECT lat, lng, min({'m': round(m, 3), 'i': point_id, 'a': short}) AS b"
        f" FROM {pairs} WHERE m <= 1000 GROUP BY lat, lng))"
    )


CTES: dict[str, str] = {
    f"fx_{name}": text.format(orders="orders", part="part", customer="customer", nation="nation")
    for name, text in DEMO_SQL.items()
}


def _box(a: str, b: str, metres: float) -> str:
    deg = metres / 100000
    return f"abs({a}lat - {b}lat) < {deg} AND abs({a}lng - {b}lng) < {deg * 2}"


CTES |= {
    "address_rows": "SELECT * RENAME (city AS address_city) FROM fx_address",
    "whole_address_rows": "SELECT * RENAME (city AS address_city) FROM fx_whole_address",
    "located_address": (
        "SELECT a.*, r.lat, r.lng FROM address_rows a JOIN fx_request r ON a.point_id = r.request_id"
    ),
    "order_latest": (
        "SELECT * EXCLUDE rk FROM (SELECT *, row_number() OVER (PARTITION BY dt, service_order_id"
        f" ORDER BY update_time DESC) AS rk FROM fx_order WHERE {VALID_ORDER}) WHERE rk = 1"
    ),
    "ext_latest": (
        "SELECT * EXCLUDE rk FROM (SELECT *, row_number() OVER (PARTITION BY dt, service_order_id"
        f" ORDER BY update_time DESC) AS rk FROM fx_order_ext WHERE {VALID_EXT}) WHERE rk = 1"
    ),
    "positions": (
        f"SELECT {ORDER_COLUMNS}, {EXT_COLUMNS}, dt FROM order_latest LEFT JOIN"
        f" (SELECT dt, service_order_id, {EXT_COLUMNS} FROM ext_latest) USING (dt, service_order_id)"
    ),
    "month_order": (
        f"SELECT * EXCLUDE rk FROM (SELECT *, row_number() OVER (PARTITION BY dt // 100, service_order_id ORDER BY dt,"
        " start_latitude, start_longitude) AS rk FROM (SELECT DISTINCT dt, " + ORDER_COLUMNS
        + f" FROM fx_order WHERE {VALID_ORDER} AND passenger_name NOT LIKE '%测试%')) WHERE rk = 1"
    ),
    "month_ext": (
        f"SELECT * EXCLUDE rk FROM (SELECT *, row_number() OVER (PARTITION BY dt // 100, service_order_id ORDER BY dt) AS rk"
        f" FROM (SELECT DISTINCT dt, dest_city, service_order_id, {EXT_COLUMNS} FROM fx_order_ext WHERE {VALID_EXT})) WHERE rk = 1"
    ),
    "month_positions": (
        f"SELECT {ORDER_COLUMNS}, {EXT_COLUMNS}, dt FROM month_order LEFT JOIN (SELECT dt // 100 AS mm, service_order_id,"
        f" {EXT_COLUMNS} FROM month_ext) e USING (service_order_id) WHERE mm IS NULL OR mm = dt // 100"
    ),
    "enc": (
        "SELECT city, exp_lat, exp_lng, exp_geohash, substr(exp_geohash, 1, 6) AS exp_rough, start_lat, start_lng,"
        " start_geohash, substr(start_geohash, 1, 6) AS start_rough FROM "
        + with_geohash(
            with_geohash(
                "(SELECT city, expect_start_latitude AS exp_lat, expect_start_longitude AS exp_lng,"
                " start_latitude AS start_lat, start_longitude AS start_lng FROM positions)",
                "exp_lat", "exp_lng", "exp_geohash", 8,
            ),
            "start_lat", "start_lng", "start_geohash", 8,
        )
    ),
    "spots": (
        "SELECT city, substr(start_geohash, 1, 6) AS rough, start_geohash AS spot, count(*) AS cnt,"
        f" {mean6('start_lat')} AS lat, {mean6('start_lng')} AS lng FROM enc GROUP BY city, start_geohash"
    ),
    "points": (
        "SELECT city, exp_geohash, substr(exp_geohash, 1, 6) AS exp_rough,"
        f" {mean6('exp_lat')} AS exp_lat, {mean6('exp_lng')} AS exp_lng FROM enc GROUP BY city, exp_geohash"
    ),
    "around": (
        "SELECT * FROM spots QUALIFY cnt >= quantile_cont(cnt, 0.75) OVER (PARTITION BY city, rough)"
    ),
    "used_spots": (
        "SELECT u.city, u.exp_geohash, s.spot, s.cnt, s.lat, s.lng FROM (SELECT DISTINCT city, exp_geohash, start_geohash"
        " FROM enc) u JOIN spots s ON u.city = s.city AND u.start_geohash = s.spot"
    ),
    "cooccur": "SELECT * FROM used_spots QUALIFY cnt >= quantile_cont(cnt, 0.75) OVER (PARTITION BY city, exp_geohash)",
    "cand": (
        "SELECT p.city, p.exp_rough, p.exp_geohash, p.exp_lat, p.exp_lng, a.spot, a.cnt, a.lat, a.lng FROM points p"
        " JOIN around a ON p.city = a.city AND p.exp_rough = a.rough"
    ),
    "cand_d": f"SELECT * FROM {with_distance('cand', 'exp_lat', 'exp_lng', 'lat', 'lng', 'dist')}",
    "stepped": (
        f"SELECT * EXCLUDE d_ FROM (SELECT *, CAST({STEP} AS INT) AS radius FROM (SELECT *, min(dist) OVER"
        " (PARTITION BY city, exp_geohash) AS d_ FROM cand_d)) WHERE dist <= radius"
    ),
    "kept": (
        "SELECT * FROM stepped WINDOW w AS (PARTITION BY city, exp_geohash) QUALIFY NOT coalesce(avg(cnt) OVER w < stddev_samp(cnt) OVER w - 1e-9, false)"
        " OR cnt >= median(cnt) OVER w"
    ),
    "marked": (
        "SELECT k.*, c.spot IS NOT NULL AS linked FROM kept k LEFT JOIN cooccur c"
        " ON k.city = c.city AND k.exp_geohash = c.exp_geohash AND k.spot = c.spot"
    ),
    "links": (
        "SELECT city, exp_geohash, spot, other, d FROM "
        + with_distance(
            "(SELECT a.city, a.exp_geohash, a.spot, b.spot AS other, a.lat AS la, a.lng AS na, b.lat AS lb, b.lng AS nb"
            " FROM kept a JOIN kept b ON a.city = b.city AND a.exp_geohash = b.exp_geohash AND a.spot <> b.spot)",
            "la", "na", "lb", "nb", "d",
        )
        + " WHERE d <= 30"
    ),
    "reach": (
        "SELECT city, exp_geohash, spot, spot AS member FROM kept UNION SELECT r.city, r.exp_geohash, r.spot, l.other"
        " FROM reach r JOIN links l ON r.city = l.city AND r.exp_geohash = l.exp_geohash AND r.member = l.spot"
    ),
    "labels": "SELECT city, exp_geohash, spot, min(member) AS cluster FROM reach GROUP BY ALL",
    "centres": (
        "SELECT city, exp_rough, exp_geohash, exp_lat, exp_lng, radius, cluster, CAST(sum(cnt) AS BIGINT) AS cnt,"
        " bool_or(linked) AS linked, CAST(sum(mla * cnt) AS DOUBLE) / 1000000 / sum(cnt) AS lat,"
        " CAST(sum(mln * cnt) AS DOUBLE) / 1000000 / sum(cnt) AS lng,"
        " ((2 * sum(mla * cnt) + sum(cnt)) // (2 * sum(cnt))) / 1000000.0::DOUBLE AS lat6,"
        " ((2 * sum(mln * cnt) + sum(cnt)) // (2 * sum(cnt))) / 1000000.0::DOUBLE AS lng6"
        " FROM (SELECT *, CAST(round(lat * 1000000) AS BIGINT) AS mla, CAST(round(lng * 1000000) AS BIGINT) AS mln"
        " FROM marked JOIN labels USING (city, exp_geohash, spot)) GROUP BY ALL"
    ),
    "placed": (
        "SELECT * EXCLUDE (full_), substr(full_, 1, 9) AS id FROM "
        + with_geohash(
            with_distance("centres", "exp_lat", "exp_lng", "lat", "lng", "dist"), "lat", "lng", "full_", 12
        )
    ),
    "scored": (
        "SELECT *, round(cnt / (max(cnt) OVER (PARTITION BY city, exp_geohash) + 3.9::DOUBLE), 6) AS score FROM placed"
    ),
    "recs": (
        "SELECT city, exp_geohash AS startPos, exp_lat, exp_lng, radius, CAST(count(*) OVER w AS INT) AS num,"
        " CAST(row_number() OVER (w ORDER BY score DESC, id) AS INT) AS rank, id, lat, lng, lat6, lng6, score, cnt AS count,"
        " CASE WHEN linked THEN 'cooccur' ELSE '' END AS ext FROM scored WINDOW w AS (PARTITION BY city, exp_geohash)"
    ),
    "places": "SELECT DISTINCT city, lat6 AS lat, lng6 AS lng FROM recs",
    "typed_poi": f"SELECT *, {TYPE_RANK} AS type_rank FROM fx_poi",
    "place_poi": (
        "SELECT * FROM "
        + with_distance(
            "(SELECT q.city, q.lat, q.lng, p.poi_id, p.name AS raw, p.typecode, p.type_rank, p.lat AS pla, p.lng AS pln"
            " FROM places q JOIN typed_poi p ON q.city = p.city AND p.type_rank IS NOT NULL"
            f" AND {_box('q.', 'p.', 300)})",
            "lat", "lng", "pla", "pln", "distance",
        )
        + " WHERE distance <= 300"
    ),
    "name_option": (
        "SELECT *, CASE WHEN distance <= 50 THEN type_rank ELSE 999 END AS pri,"
        " CASE WHEN distance <= 20 THEN raw ELSE raw || '附近' END AS shown FROM place_poi"
    ),
    "name_reserve": (
        "SELECT city, lat, lng, min({'d': distance, 'i': poi_id, 'raw': raw, 'shown': shown}) AS res FROM name_option"
        " GROUP BY ALL"
    ),
    "name_use": "SELECT city, startPos, rank, lat6 AS lat, lng6 AS lng FROM recs",
    "name_pick": (
        "SELECT DISTINCT city, startPos, 0 AS rank, CAST([] AS VARCHAR[]) AS used, '' AS name FROM recs UNION ALL"
        " SELECT city, startPos, rank, list_append(used, coalesce(best.raw, res.raw, '')), coalesce(best.shown, res.shown, '')"
        " FROM (SELECT k.city, k.startPos, u.rank, any_value(k.used) AS used, any_value(r.res) AS res,"
        " min(CASE WHEN o.raw IS NOT NULL THEN {'p': o.pri, 'd': o.distance, 'i': o.poi_id, 'raw': o.raw, 'shown': o.shown} END) AS best"
        " FROM name_pick k JOIN name_use u ON u.city = k.city AND u.startPos = k.startPos AND u.rank = k.rank + 1"
        " LEFT JOIN name_option o ON o.city = u.city AND o.lat = u.lat AND o.lng = u.lng AND o.pri < 999"
        " AND NOT list_contains(k.used, o.raw)"
        " LEFT JOIN name_reserve r ON r.city = u.city AND r.lat = u.lat AND r.lng = u.lng"
        " GROUP BY k.city, k.startPos, u.rank)"
    ),
    "short_address_rows": f"SELECT * FROM {short_address('located_address')}",
    "addressless": (
        "SELECT DISTINCT r.lat6 AS lat, r.lng6 AS lng FROM recs r JOIN name_pick n ON n.city = r.city AND n.startPos = r.startPos"
        " AND n.rank = r.rank WHERE n.name = '' UNION SELECT DISTINCT exp_lat, exp_lng FROM recs"
    ),
    "place_address": "SELECT * FROM " + nearest_address("addressless"),
    "named": (
        "SELECT r.*, coalesce(nullif(n.name, ''), coalesce(a.address, '') || '-推荐上车点') AS name,"
        " coalesce(g.address, '') AS regeo FROM recs r JOIN name_pick n"
        " ON n.city = r.city AND n.startPos = r.startPos AND n.rank = r.rank"
        " LEFT JOIN place_address a ON a.lat = r.lat6 AND a.lng = r.lng6"
        " LEFT JOIN place_address g ON g.lat = r.exp_lat AND g.lng = r.exp_lng"
    ),
    "info": (
        f"SELECT DISTINCT startPos AS geohash, city, regeo, radius, num, {RUN} AS create_time, {RUN} AS update_time FROM named"
    ),
    "detail": (
        "SELECT startPos AS exp_geohash, city, id, lat6 AS lat, lng6 AS lng, name, score, 'AC01' AS tag, 0 AS status,"
        f" CAST(count AS INT) AS count, 0 AS \"show\", 0 AS pick, ext, {RUN} AS create_time, {RUN} AS update_time FROM named"
    ),
    "request_cell": (
        "SELECT * FROM " + with_geohash("fx_request", "lat", "lng", "key", 8)
    ),
    "heat_pair": (
        "SELECT * FROM "
        + with_distance(
            "(SELECT q.request_id, q.city, q.lat AS req_lat, q.lng AS req_lng, s.spot AS geohash, s.cnt AS count,"
            " s.lat, s.lng FROM request_cell q JOIN spots s ON q.city = s.city AND substr(q.key, 1, 6) = s.rough)",
            "req_lat", "req_lng", "lat", "lng", "distance",
        )
        + " WHERE distance <= 200"
    ),
    "heat_busy": (
        "SELECT * FROM heat_pair QUALIFY count >= quantile_cont(count, 0.75) OVER (PARTITION BY request_id)"
    ),
    "heat_link": (
        "SELECT request_id, geohash, other FROM "
        + with_distance(
            "(SELECT a.request_id, a.geohash, b.geohash AS other, a.lat AS la, a.lng AS na, b.lat AS lb, b.lng AS nb"
            " FROM heat_busy a JOIN heat_busy b ON a.request_id = b.request_id AND a.geohash <> b.geohash)",
            "la", "na", "lb", "nb", "d",
        )
        + " WHERE d <= 30"
    ),
    "heat_reach": (
        "SELECT request_id, geohash, geohash AS member FROM heat_busy UNION SELECT r.request_id, r.geohash, l.other"
        " FROM heat_reach r JOIN heat_link l ON r.request_id = l.request_id AND r.member = l.geohash"
    ),
    "heat_label": "SELECT request_id, geohash, min(member) AS cluster FROM heat_reach GROUP BY ALL",
    "heat_centre": (
        "SELECT * FROM "
        + with_distance(
            "(SELECT request_id, city, req_lat, req_lng, cluster AS geohash, CAST(sum(count) AS BIGINT) AS count,"
            " CAST(sum(mla * count) AS DOUBLE) / 1000000 / sum(count) AS lat,"
            " CAST(sum(mln * count) AS DOUBLE) / 1000000 / sum(count) AS lng,"
            " ((2 * sum(mla * count) + sum(count)) // (2 * sum(count))) / 1000000.0::DOUBLE AS lat6,"
            " ((2 * sum(mln * count) + sum(count)) // (2 * sum(count))) / 1000000.0::DOUBLE AS lng6"
            " FROM (SELECT *, CAST(round(lat * 1000000) AS BIGINT) AS mla, CAST(round(lng * 1000000) AS BIGINT) AS mln"
            " FROM heat_busy JOIN heat_label USING (request_id, geohash)) GROUP BY ALL)",
            "req_lat", "req_lng", "lat", "lng", "distance",
        )
    ),
}

_NAMES = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def _needs(text: str, seen: list[str], path: tuple[str, ...] = ()) -> None:
    for name in _NAMES.findall(text):
        if name not in seen and name not in path:
            _needs(CTES[name], seen, (*path, name))
            if name not in seen:
                seen.append(name)


def statement(select: str) -> str:
    """A full query: the subqueries it names, each computed once, then ``select``."""
    order: list[str] = []
    _needs(select, order)
    if not order:
        return select
    body = ",\n".join(f"{n} AS {'' if n.endswith(('reach', 'pick')) else 'MATERIALIZED '}({CTES[n]})" for n in order)
    return f"WITH RECURSIVE {body}\n{select}"
