"""The load pipeline and the named queries written once more as plain SQL (DuckDB dialect), used only as a
correctness oracle. The fixture recipe, coercions, flags, features and rounding rule are the same
definitions as the Spark code, spelled independently in SQL."""

from __future__ import annotations

import math

from .fixed import (EXCLUDED_ZONE_IDS, EXCLUDED_ZONE_NAMES, FLAG_META, FLAG_NOTES, FLOAT_PREFIX, HARD_FLAG_TYPES, INT_PREFIX, LAT_ITERATIONS, LCC,
                    MAX_SPEED_MPH, MAX_TIP_PERCENTAGE, PAYMENT_LABELS, PEAK_HOURS, RAW_TRIP_COLUMNS)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return ", ".join(q(v) if isinstance(v, str) else str(v) for v in values)


def tofixed(x: str, k: int) -> str:
    s = f"{10 ** k}.0"
    return f"(sign({x}) * floor(abs({x}) * {s} + 0.5) / {s})"


def js_text(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL THEN 'NaN' WHEN {x} = floor({x}) AND abs({x}) < 9.007199254740992e15 "
            f"THEN CAST(CAST(floor({x}) AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END)")


def pint(c: str) -> str:
    return f"TRY_CAST(regexp_extract({c}, {q(INT_PREFIX)}, 1) AS BIGINT)"


def pfloat(c: str) -> str:
    return f"TRY_CAST(regexp_extract({c}, {q(FLOAT_PREFIX)}, 1) AS DOUBLE)"


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def xavg(c: str) -> str:
    return f"(SUM(CAST(round({c} * 10000.0) AS BIGINT)) / 10000.0 / NULLIF(COUNT({c}), 0))"


def xsum(c: str) -> str:
    return f"(SUM(CAST(round({c} * 10000.0) AS BIGINT)) / 10000.0)"


def pct(c: str, p: float) -> str:
    return tofixed(f"quantile_cont({c}, {p})", 6)


def money(c: str) -> str:
    return (f"(CASE WHEN ({c}) < 0 THEN '-' ELSE '' END || CAST(abs({c}) // 100 AS VARCHAR) || '.' || "
            f"lpad(CAST(abs({c}) % 100 AS VARCHAR), 2, '0'))")


def ts_text(secs: str) -> str:
    return f"strftime(TIMESTAMP '2019-01-01 00:00:00' + to_seconds({secs}), '%Y-%m-%d %H:%M:%S')"


def flag(cond: str, code: str, action: str, reason: str, field: str, value: str) -> str:
    return (f"CASE WHEN {cond} THEN {{'err_type': {q(code)}, 'action': {q(action)}, 'reason': {reason}, "
            f"'field_name': {q(field)}, 'orig_value': coalesce({value}, '')}} END")


RAW = f"""
li AS (
  SELECT l_orderkey AS ok, CAST(l_linenumber AS BIGINT) AS ln, l_partkey AS pk, l_suppkey AS sk,
         CAST(l_quantity AS BIGINT) AS q, l_suppkey % 4 AS g,
         CAST(floor(l_extendedprice) AS BIGINT) // 10 AS fc, CAST(round(l_discount * 100) AS BIGINT) AS dp
  FROM lineitem),
li2 AS (
  SELECT *, (ok * 37 + ln * 601 + g * 1301) % 4500 - 60 AS dur, (ok * 7919 + ln * 104729) % 2678400 AS pu,
         ok % 26 AS z, (ok * 11 + ln) % 26 AS z2, CASE WHEN pk % 401 = 0 THEN -fc ELSE fc END AS fare_c
  FROM li),
raw AS (
  SELECT ((((ok * 8 + ln) * 20000 + pk) * 1000 + sk) * 51 + q) AS row_num,
    CASE WHEN sk % 50 = 0 THEN '' ELSE CAST(1 + sk % 2 AS VARCHAR) END AS VendorID,
    CASE WHEN pk % 211 = 0 THEN 'not-a-date' ELSE {ts_text('pu')} END AS tpep_pickup_datetime,
    {ts_text('pu + dur')} AS tpep_dropoff_datetime,
    CASE WHEN q = 50 THEN '9' WHEN q = 49 THEN '0' WHEN q = 48 THEN '' ELSE CAST(1 + q % 6 AS VARCHAR) END AS passenger_count,
    CASE WHEN pk % 311 = 0 THEN 'abc' WHEN pk % 301 = 0 THEN '0' WHEN pk % 307 = 0 THEN '150.25'
         ELSE {money('pk % 1500')} END AS trip_distance,
    CASE WHEN sk = 7 THEN '99' WHEN pk % 443 = 0 THEN '' ELSE CAST(1 + ln % 6 AS VARCHAR) END AS RatecodeID,
    CASE WHEN pk % 17 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CASE WHEN z = 23 THEN '264' WHEN z = 24 THEN '265' WHEN z = 25 THEN '999' ELSE CAST(z + 1 AS VARCHAR) END AS PULocationID,
    CASE WHEN z2 = 23 THEN '264' WHEN z2 = 24 THEN '265' WHEN z2 = 25 THEN '0' ELSE CAST(z2 + 1 AS VARCHAR) END AS DOLocationID,
    CASE WHEN pk % 431 = 0 THEN '0' ELSE CAST(1 + ln % 6 AS VARCHAR) END AS payment_type,
    {money('fare_c')} AS fare_amount,
    '0.5' AS extra, '0.5' AS mta_tax,
    CASE WHEN pk % 409 = 0 THEN {money('fc * 3')} WHEN pk % 419 = 0 THEN {money('-100')}
         ELSE {money('(fc * dp) // 25')} END AS tip_amount,
    CASE WHEN pk % 23 = 0 THEN '5.76' ELSE '0' END AS tolls_amount,
    '0.3' AS improvement_surcharge,
    {money('(ok * 131 + ln * 977 + g * 3571) % 9000 - 150')} AS total_amount,
    CASE WHEN pk % 3 = 0 THEN '' ELSE '2.5' END AS congestion_surcharge
  FROM li2),
zones AS (
  SELECT CAST(CASE WHEN n_nationkey = 23 THEN 264 WHEN n_nationkey = 24 THEN 265 ELSE n_nationkey + 1 END AS INTEGER) AS id,
         CASE WHEN n_nationkey = 23 THEN 'Unknown' WHEN n_nationkey = 24 THEN 'N/A' ELSE r_name END AS borough,
         n_name AS zone_name,
         CASE WHEN n_nationkey IN (23, 24) THEN 'N/A' ELSE r_name END AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

_P = "try_strptime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S')"
_D = "try_strptime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S')"

NORM = f"""
staged AS (
  SELECT *, {_P} AS _pickup, {_D} AS _dropoff,
    {pint('passenger_count')} AS _passengers, {pfloat('trip_distance')} AS _distance,
    {pfloat('fare_amount')} AS _fare, {pfloat('tip_amount')} AS _tip, {pfloat('total_amount')} AS _total,
    {pint('RatecodeID')} AS _rate
  FROM raw),
staged2 AS (
  SELECT *, (_pickup IS NULL OR _dropoff IS NULL) AS _bad,
         (_pickup IS NOT NULL AND _dropoff IS NOT NULL AND _dropoff <= _pickup) AS _before
  FROM staged),
norm AS (
  SELECT row_num,
    {{{', '.join(f"'{c}': {c}" for c in RAW_TRIP_COLUMNS)}}} AS raw,
    CAST(NULLIF({pint('VendorID')}, 0) AS INTEGER) AS vendor,
    CASE WHEN NOT (_bad OR _before) THEN _pickup END AS pickup_time,
    CASE WHEN NOT (_bad OR _before) THEN _dropoff END AS dropoff_time,
    CAST(_passengers AS INTEGER) AS passengers,
    coalesce(_distance, 0.0) AS distance,
    CAST(_rate AS INTEGER) AS rate_id,
    NULLIF(store_and_fwd_flag, '') AS store_fwd,
    CAST(NULLIF({pint('PULocationID')}, 0) AS INTEGER) AS pickup_zone,
    CAST(NULLIF({pint('DOLocationID')}, 0) AS INTEGER) AS dropoff_zone,
    CAST(NULLIF({pint('payment_type')}, 0) AS INTEGER) AS payment_type,
    coalesce(_fare, 0.0) AS fare, coalesce({pfloat('extra')}, 0.0) AS extra, coalesce({pfloat('mta_tax')}, 0.0) AS tax,
    coalesce(_tip, 0.0) AS tip, coalesce({pfloat('tolls_amount')}, 0.0) AS tolls,
    coalesce({pfloat('improvement_surcharge')}, 0.0) AS surcharge, coalesce(_total, 0.0) AS total,
    CASE WHEN congestion_surcharge = '' THEN NULL ELSE {pfloat('congestion_surcharge')} END AS congestion,
    CASE WHEN NOT (_bad OR _before) THEN CAST(hour(_pickup) AS INTEGER) END AS hour_of_day,
    CASE WHEN NOT (_bad OR _before) THEN CAST(dayofweek(_pickup) AS INTEGER) END AS day_of_week,
    CASE WHEN NOT (_bad OR _before) THEN hour(_pickup) IN ({in_list(PEAK_HOURS)}) END AS is_peak,
    CASE WHEN _bad THEN 'BAD_DATETIME' WHEN _before THEN 'DROPOFF_BEFORE_PICKUP' END AS hard_code,
    list_filter([
      {flag('_bad', 'BAD_DATETIME', 'excluded', q('unparseable pickup or dropoff datetime'), 'tpep_pickup_datetime', 'tpep_pickup_datetime')},
      {flag('_before', 'DROPOFF_BEFORE_PICKUP', 'excluded', "'dropoff ' || tpep_dropoff_datetime || ' is not after pickup ' || tpep_pickup_datetime", 'tpep_dropoff_datetime', 'tpep_dropoff_datetime')},
      {flag('_passengers <= 0', 'ZERO_PASS', 'retained', "'passenger_count is ' || " + js_text('_passengers') + " || ' (≤ 0)'", 'passenger_count', js_text('_passengers'))},
      {flag('_passengers > 8', 'HIGH_PASS', 'retained', "'passenger_count is ' || " + js_text('_passengers') + " || ' (> 8)'", 'passenger_count', js_text('_passengers'))},
      {flag('_distance <= 0', 'ZERO_DIST', 'retained', "'trip_distance is ' || " + js_text('_distance') + " || ' (≤ 0)'", 'trip_distance', js_text('_distance'))},
      {flag('_distance > 100', 'LARGE_DIST', 'retained', "'trip_distance is ' || " + js_text('_distance') + " || ' (> 100 miles)'", 'trip_distance', js_text('_distance'))},
      {flag('_fare < 0', 'NEG_FARE', 'retained', "'fare_amount is ' || " + js_text('_fare') + " || ' (negative)'", 'fare_amount', js_text('_fare'))},
      {flag('_total < 0', 'NEG_TOTAL', 'retained', "'total_amount is ' || " + js_text('_total') + " || ' (negative)'", 'total_amount', js_text('_total'))},
      {flag('_tip < 0', 'NEG_TIP', 'retained', "'tip_amount is ' || " + js_text('_tip') + " || ' (negative)'", 'tip_amount', js_text('_tip'))},
      {flag('(_rate IS NULL OR _rate NOT IN (1, 2, 3, 4, 5, 6))', 'BAD_RATE_CODE', 'retained', "'RatecodeID ' || " + js_text('_rate') + " || ' is non-standard'", 'RatecodeID', js_text('_rate'))}
    ], lambda x: x IS NOT NULL) AS raw_flags
  FROM staged2),
first_rows AS (
  SELECT * FROM norm WHERE hard_code IS NULL
  QUALIFY row_number() OVER (PARTITION BY vendor, pickup_time, dropoff_time, pickup_zone, dropoff_zone, total
                             ORDER BY row_num) = 1),
f1 AS (
  SELECT *, CASE WHEN epoch_ms(dropoff_time) - epoch_ms(pickup_time) > 0
                 THEN {tofixed('(epoch_ms(dropoff_time) - epoch_ms(pickup_time)) / 60000', 2)} END AS duration_min
  FROM first_rows),
enriched AS (
  SELECT *,
    CASE WHEN duration_min IS NOT NULL AND duration_min <> 0 AND duration_min / 60 > 0 AND distance > 0
         THEN {tofixed('distance / (duration_min / 60)', 2)} END AS speed_mph,
    CASE WHEN duration_min IS NOT NULL AND duration_min > 0 THEN {tofixed('total / duration_min', 4)} END AS money_per_min,
    CASE WHEN fare > 0 THEN {tofixed('tip / fare * 100', 2)} END AS tip_pct,
    CASE WHEN distance > 0 THEN {tofixed('total / distance', 4)} END AS cost_per_mile
  FROM f1),
kept AS (
  SELECT *,
    list_filter([
      {flag(f'speed_mph IS NOT NULL AND speed_mph > {MAX_SPEED_MPH}', 'HIGH_SPEED', 'retained', "'speed_mph is ' || " + js_text('speed_mph') + f" || ' (> {MAX_SPEED_MPH})'", 'speed_mph', js_text('speed_mph'))},
      {flag(f'tip_pct IS NOT NULL AND tip_pct > {MAX_TIP_PERCENTAGE}', 'HIGH_TIP_PCT', 'retained', "'tip_pct is ' || " + js_text('tip_pct') + f" || ' (> {MAX_TIP_PERCENTAGE}%)'", 'tip_pct', js_text('tip_pct'))},
      {flag('distance = 0 AND fare > 0', 'ZERO_DIST_POS_FARE', 'retained', "'distance=0 but fare=' || " + js_text('fare'), 'distance', "'0'")}
    ], lambda x: x IS NOT NULL) AS post_flags,
    ((pickup_zone IS NOT NULL AND pickup_zone NOT IN (SELECT id FROM zones))
      OR (dropoff_zone IS NOT NULL AND dropoff_zone NOT IN (SELECT id FROM zones))) AS orphan
  FROM enriched),
trips AS (SELECT * FROM kept WHERE NOT orphan),
quarantine AS (SELECT * FROM kept WHERE orphan),
qflags AS (
  SELECT row_num, unnest(raw_flags) AS f FROM norm
  UNION ALL SELECT row_num, unnest(post_flags) AS f FROM kept),
aflags AS (SELECT row_num, unnest(post_flags) AS f, distance, fare, speed_mph, duration_min, tip_pct, raw FROM kept),
error_log AS (
  SELECT sha256(CAST(row_num AS VARCHAR) || '|' || f.err_type || '|quality') AS err_id, row_num, f.err_type AS err_type,
         to_json({{'action': f.action, 'reason': f.reason, 'field': f.field_name, 'original_value': f.orig_value}}) AS details,
         '{{}}' AS raw_data, TIMESTAMP '2019-02-01 00:00:00' AS created_at, 'quality' AS source
  FROM qflags
  UNION ALL
  SELECT sha256(CAST(row_num AS VARCHAR) || '|' || f.err_type || '|anomaly'), row_num, f.err_type,
         to_json({{'distance': distance, 'fare': fare, 'speed_mph': speed_mph, 'duration_min': duration_min, 'tip_pct': tip_pct}}),
         to_json(raw), TIMESTAMP '2019-02-01 00:00:00', 'anomaly'
  FROM aflags),
soft AS (SELECT * FROM error_log WHERE err_type NOT IN ({in_list(HARD_FLAG_TYPES)}))"""


def _shapes_cte() -> str:
    k = LCC
    pi2 = repr(math.pi / 2)

    def inv(xc: str, yc: str) -> tuple[str, str]:
        x = f"({xc} * {k.to_meter!r} - {k.x0!r})"
        y = f"({k.rho0!r} - ({yc} * {k.to_meter!r} - {k.y0!r}))"
        rho = f"sqrt({x} * {x} + {y} * {y})"
        theta = f"atan2({x}, {y})"
        t = f"pow({rho} / {k.aF!r}, {1.0 / k.n!r})"
        phi = f"({pi2} - 2.0 * atan({t}))"
        for _ in range(LAT_ITERATIONS):
            es = f"({k.e!r} * sin({phi}))"
            phi = f"({pi2} - 2.0 * atan({t} * pow(2.0 / (1.0 + {es}) - 1.0, {k.e / 2!r})))"
        return f"degrees({theta} / {k.n!r} + {k.lon0!r})", f"degrees({phi})"

    lon, lat = inv("p[1]", "p[2]")
    def ring_wkt(num):
        return f"'(' || array_to_string(list_transform(r, lambda p: {num('p[1]')} || ' ' || {num('p[2]')}), ', ') || ')'"
    def wkt(col, num):
        return (f"'MULTIPOLYGON(' || array_to_string(list_transform({col}, lambda poly: '(' || array_to_string("
                f"list_transform(poly, lambda r: {ring_wkt(num)}), ', ') || ')'), ', ') || ')'")
    return f"""
pt AS (
  SELECT p_partkey AS pk, 900000 + (p_partkey % 200) * 1000 AS cx, 120000 + ((p_partkey // 200) % 200) * 1000 AS cy,
         CAST(p_size AS BIGINT) * 50 + 50 AS h FROM part),
pt2 AS (
  SELECT pk, h,
    [[CAST(cx - h AS DOUBLE), CAST(cy - h AS DOUBLE)], [CAST(cx + h AS DOUBLE), CAST(cy - h AS DOUBLE)],
     [CAST(cx + h AS DOUBLE), CAST(cy + h AS DOUBLE)], [CAST(cx - h AS DOUBLE), CAST(cy + h AS DOUBLE)],
     [CAST(cx - h AS DOUBLE), CAST(cy - h AS DOUBLE)]] AS outer_ring,
    [[CAST(cx + h * 3 - 40 AS DOUBLE), CAST(cy - 40 AS DOUBLE)], [CAST(cx + h * 3 + 40 AS DOUBLE), CAST(cy - 40 AS DOUBLE)],
     [CAST(cx + h * 3 + 40 AS DOUBLE), CAST(cy + 40 AS DOUBLE)], [CAST(cx + h * 3 - 40 AS DOUBLE), CAST(cy + 40 AS DOUBLE)],
     [CAST(cx + h * 3 - 40 AS DOUBLE), CAST(cy - 40 AS DOUBLE)]] AS small_ring
  FROM pt),
feat AS (
  SELECT CAST(coalesce(NULLIF(CASE WHEN pk % 7 = 0 THEN NULL ELSE pk END, 0),
                       NULLIF(CASE WHEN pk % 7 = 0 AND pk % 2 = 0 THEN pk + 100000 END, 0), pk) AS INTEGER) AS location_id,
         CAST(h * h * 4 AS DOUBLE) AS area,
         coalesce(NULLIF(CASE WHEN pk % 11 = 0 THEN NULL ELSE CAST(h * 8 AS DOUBLE) END, 0.0), 0.0) AS len,
         CASE WHEN pk % 3 = 0 THEN [[outer_ring], [small_ring]] ELSE [[outer_ring]] END AS multi
  FROM pt2),
feat2 AS (
  SELECT *, list_transform(multi, lambda poly: list_transform(poly, lambda r: list_transform(r, lambda p: [{lon}, {lat}]))) AS web
  FROM feat),
zone_shapes AS (
  SELECT location_id, area, len, {wkt('multi', js_text)} AS geom,
         {wkt('web', lambda v: f"printf('%.7f', {v})")} AS geom_web, TRUE AS mappable, CAST(NULL AS VARCHAR) AS notes
  FROM feat2)"""


def with_ctes(select: str, shapes: bool = False) -> str:
    ctes = RAW + "," + NORM + ("," + _shapes_cte() if shapes else "")
    return "WITH " + ctes.strip() + "\n" + select.strip()
