"""Oracle SQL per registered query key (DuckDB; tables of the sf directory are pre-registered views)."""

from __future__ import annotations

from .duckdb_sql import in_list, iso, js_text, pct, q, tofixed, with_ctes, xavg, xsum
from .fixed import EXCLUDED_ZONE_IDS, EXCLUDED_ZONE_NAMES, FLAG_META, FLAG_NOTES, PAYMENT_LABELS, RAW_TRIP_COLUMNS, TRIP_COLUMNS

KNOWN_ZONE = (f"z.id NOT IN ({in_list(EXCLUDED_ZONE_IDS)}) AND z.zone_name NOT IN ({in_list(EXCLUDED_ZONE_NAMES)}) "
              f"AND z.borough NOT IN ({in_list(EXCLUDED_ZONE_NAMES)})")
KNOWN_BOROUGH = (f"z.borough IS NOT NULL AND z.borough NOT IN ({in_list(EXCLUDED_ZONE_NAMES)}) "
                 f"AND z.id NOT IN ({in_list(EXCLUDED_ZONE_IDS)})")
TRIP_SELECT = ", ".join(f"{iso(c)} AS {c}" if c in ("pickup_time", "dropoff_time") else c for c in TRIP_COLUMNS)
ERROR_SELECT = f"err_id, row_num, err_type, details, raw_data, {iso('created_at')} AS created_at, source"


def _case_map(expr: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {expr} = {q(k) if isinstance(k, str) else k} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


PAYMENT_LABEL = _case_map("payment_type", PAYMENT_LABELS, q("Unknown"))

TOP_ZONES = f"""
  SELECT z.id AS location_id, z.borough, z.zone_name, COUNT(t.row_num) AS trip_count, {xsum('t.total')} AS total_revenue,
         {xavg('t.total')} AS avg_fare, {xavg('t.tip_pct')} AS avg_tip_percentage
  FROM zones z JOIN trips t ON t.pickup_zone = z.id
  WHERE {KNOWN_ZONE}
  GROUP BY z.id, z.borough, z.zone_name
  ORDER BY trip_count DESC NULLS FIRST, location_id ASC LIMIT {{n}}"""

PROFIT_TOP = f"""
  SELECT z.id AS location_id, z.borough, z.zone_name, z.service_zone, COUNT(t.row_num) AS trip_count,
         {xavg('t.money_per_min')} AS avg_revenue_per_minute, {xavg('t.total')} AS avg_total_amount,
         {xsum('t.total')} AS total_revenue, {xavg('t.duration_min')} AS avg_duration_minutes,
         {xavg('t.speed_mph')} AS avg_speed_mph, {xavg('t.tip_pct')} AS avg_tip_percentage
  FROM zones z JOIN trips t ON t.pickup_zone = z.id
  WHERE t.money_per_min IS NOT NULL AND {KNOWN_ZONE}
  GROUP BY z.id, z.borough, z.zone_name, z.service_zone
  HAVING COUNT(t.row_num) >= 10
  ORDER BY avg_revenue_per_minute DESC NULLS FIRST, location_id ASC LIMIT {{n}}"""

TIPS_BOROUGH = f"""
  SELECT borough, trip_count, avg_tip_percentage, avg_tip_amount, total_tips, total_revenue,
         {tofixed('total_tips / NULLIF(total_revenue, 0.0) * 100', 2)} AS tips_as_pct_of_revenue, median_tip_percentage
  FROM (SELECT z.borough, COUNT(t.row_num) AS trip_count, {xavg('t.tip_pct')} AS avg_tip_percentage,
               {xavg('t.tip')} AS avg_tip_amount, {xsum('t.tip')} AS total_tips, {xsum('t.total')} AS total_revenue,
               {pct('t.tip_pct', 0.5)} AS median_tip_percentage
        FROM zones z JOIN trips t ON t.pickup_zone = z.id
        WHERE {KNOWN_BOROUGH} AND t.tip_pct IS NOT NULL
        GROUP BY z.borough)"""

TIPS_HOUR = f"""
  SELECT hour_of_day, COUNT(*) AS trip_count, {xavg('tip_pct')} AS avg_tip_percentage, {xavg('tip')} AS avg_tip_amount,
         {xsum('tip')} AS total_tips, {pct('tip_pct', 0.5)} AS median_tip_percentage
  FROM trips WHERE tip_pct IS NOT NULL GROUP BY hour_of_day"""

PAYMENT = f"""
  SELECT payment_type, COUNT(*) AS trip_count, {xavg('tip_pct')} AS avg_tip_percentage, {xavg('tip')} AS avg_tip_amount,
         {xsum('tip')} AS total_tips, MIN(tip_pct) AS min_tip_percentage, MAX(tip_pct) AS max_tip_percentage,
         {pct('tip_pct', 0.5)} AS median_tip_percentage, {pct('tip_pct', 0.9)} AS p90_tip_percentage,
         {PAYMENT_LABEL} AS payment_label
  FROM trips WHERE tip_pct IS NOT NULL AND payment_type IS NOT NULL GROUP BY payment_type"""

BY_HOUR = f"""
  SELECT hour_of_day, COUNT(*) AS trip_count, {xavg('money_per_min')} AS avg_revenue_per_minute,
         {xavg('total')} AS avg_fare, {xsum('total')} AS total_revenue, {xavg('duration_min')} AS avg_duration_minutes,
         {xavg('speed_mph')} AS avg_speed_mph
  FROM trips WHERE money_per_min IS NOT NULL GROUP BY hour_of_day"""

BY_TYPE = "SELECT err_type, COUNT(*) AS count FROM soft GROUP BY err_type"

LIST_ORDER = "ORDER BY created_at DESC NULLS FIRST, row_num DESC, err_type ASC, source ASC"
FARE_X = "CAST(CAST(json_extract_string(details, '$.fare') AS DECIMAL(18,4)) AS DOUBLE)"
DIST_X = "CAST(CAST(json_extract_string(details, '$.distance') AS DECIMAL(18,4)) AS DOUBLE)"


def _list(where: str, limit: int, offset: int) -> str:
    return (f"SELECT err_id, row_num, err_type, details, {iso('created_at')} AS created_at, {FARE_X} AS fare, "
            f"{DIST_X} AS distance FROM (SELECT * FROM soft {where} {LIST_ORDER} LIMIT {limit} OFFSET {offset})")


def _list_meta(where: str, limit: int, offset: int) -> str:
    return (f"SELECT total, CAST({limit} AS BIGINT) AS \"limit\", CAST({offset} AS BIGINT) AS \"offset\", "
            f"CAST(greatest(least(total - {offset}, {limit}), 0) AS BIGINT) AS count, "
            f"({offset} + greatest(least(total - {offset}, {limit}), 0)) < total AS has_more "
            f"FROM (SELECT COUNT(*) AS total FROM soft {where})")


def _fmt_fixed(x: str, k: int) -> str:
    return f"printf('%.{k}f', {tofixed(x, k)})"


def _fmt_num(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def _card_cash() -> str:
    return f"""SELECT MAX(CASE WHEN payment_type = 1 THEN avg_tip_percentage END) AS card_avg,
                      MAX(CASE WHEN payment_type = 2 THEN avg_tip_percentage END) AS cash_avg,
                      COUNT(CASE WHEN payment_type = 1 THEN 1 END) AS has_card,
                      COUNT(CASE WHEN payment_type = 2 THEN 1 END) AS has_cash
               FROM ({PAYMENT})"""


def _library_features() -> str:
    p = "try_strptime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S')"
    d = "try_strptime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S')"
    from .duckdb_sql import pfloat
    return f"""
  SELECT row_num, trip_distance, fare_amount, dur AS trip_duration_minutes,
    CASE WHEN dur IS NOT NULL AND dur <> 0 AND dur / 60 > 0 AND dist > 0 THEN {tofixed('dist / (dur / 60)', 2)} END AS average_speed_mph,
    CASE WHEN dur IS NOT NULL AND dur > 0 THEN {tofixed('tot / dur', 4)} END AS revenue_per_minute,
    CASE WHEN fa > 0 THEN {tofixed('tp / fa * 100', 2)} END AS tip_percentage
  FROM (SELECT row_num, trip_distance, fare_amount,
               CASE WHEN epoch_ms({d}) - epoch_ms({p}) > 0 THEN {tofixed(f'(epoch_ms({d}) - epoch_ms({p})) / 60000', 2)} END AS dur,
               coalesce({pfloat('trip_distance')}, 0.0) AS dist, coalesce({pfloat('total_amount')}, 0.0) AS tot,
               coalesce({pfloat('tip_amount')}, 0.0) AS tp, coalesce({pfloat('fare_amount')}, 0.0) AS fa
        FROM raw)"""


def _detect_expr() -> str:
    from .duckdb_sql import pfloat
    zd = (f"coalesce({pfloat('trip_distance')}, 0.0) = 0 AND coalesce({pfloat('fare_amount')}, 0.0) > 0")
    return (f"array_to_string(list_filter([CASE WHEN {zd} THEN 'zero_distance_positive_fare' END, "
            f"CASE WHEN average_speed_mph IS NOT NULL AND isfinite(average_speed_mph) AND average_speed_mph > 80 THEN 'excessive_speed' END, "
            f"CASE WHEN trip_duration_minutes IS NULL OR trip_duration_minutes <= 0 THEN 'invalid_duration' END, "
            f"CASE WHEN tip_percentage IS NOT NULL AND isfinite(tip_percentage) AND tip_percentage > 100 THEN 'excessive_tip_percentage' END], "
            f"lambda x: x IS NOT NULL), ',')")


def oracle_sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["scan_raw_trips"] = with_ctes("SELECT * FROM raw")
    s["scan_zones"] = with_ctes("SELECT * FROM zones")
    raw_cols = ", ".join(RAW_TRIP_COLUMNS)
    s["scan_trips_csv"] = with_ctes(f"SELECT CAST(row_number() OVER (ORDER BY row_num) AS BIGINT) AS row_num, {raw_cols} FROM raw")
    s["trips"] = with_ctes(f"SELECT {TRIP_SELECT} FROM trips")
    s["referential_orphans"] = with_ctes(f"SELECT {TRIP_SELECT} FROM quarantine")
    s["error_log"] = with_ctes(f"SELECT {ERROR_SELECT} FROM error_log")
    s["load_summary"] = with_ctes("""
      SELECT total_raw_rows, excluded, total_raw_rows - excluded - kept AS duplicates, flagged, kept - flagged AS clean,
             inserted, kept - inserted AS quarantined
      FROM (SELECT COUNT(*) AS total_raw_rows, COUNT(hard_code) AS excluded FROM norm),
           (SELECT COUNT(*) AS kept, COUNT(CASE WHEN len(post_flags) > 0 THEN 1 END) AS flagged,
                   COUNT(CASE WHEN NOT orphan THEN 1 END) AS inserted FROM kept)""")
    s["features"] = with_ctes("SELECT row_num, duration_min, speed_mph, money_per_min, tip_pct, cost_per_mile, "
                              "hour_of_day, day_of_week, is_peak FROM kept")
    s["compute_features"] = with_ctes(f"SELECT row_num, trip_duration_minutes, average_speed_mph, revenue_per_minute, "
                                      f"tip_percentage FROM ({_library_features()})")
    s["detect_anomalies"] = with_ctes(f"SELECT row_num, {_detect_expr()} AS anomaly_types FROM ({_library_features()})")
    fields = ("trip_distance", "fare_amount", "average_speed_mph", "trip_duration_minutes", "tip_percentage")
    only_bad = ", ".join(f"CASE WHEN types <> '' THEN {c} END AS {c}" for c in fields)
    s["partition_trips"] = with_ctes(f"SELECT row_num, CASE WHEN types <> '' THEN 'anomaly' ELSE 'clean' END AS half, NULLIF(types, '') AS anomaly_types, "
                                     f"{only_bad} FROM (SELECT *, {_detect_expr()} AS types FROM ({_library_features()}))")
    key = (f"coalesce(CAST(vendor AS VARCHAR), '') || '|' || coalesce({iso('pickup_time')}, '') || '|' || "
           f"coalesce({iso('dropoff_time')}, '') || '|' || coalesce(CAST(pickup_zone AS VARCHAR), '') || '|' || "
           f"coalesce(CAST(dropoff_zone AS VARCHAR), '') || '|' || coalesce({js_text('total')}, '')")
    s["dedup_keep_first"] = with_ctes(f"SELECT row_num, {key} AS trip_key FROM first_rows")
    s["dedup_with_count"] = with_ctes("SELECT u AS unique_count, n - u AS duplicate_count FROM "
                                      "(SELECT COUNT(*) AS n FROM norm WHERE hard_code IS NULL), "
                                      "(SELECT COUNT(*) AS u FROM first_rows)")
    s["join_zone_inner"] = with_ctes("SELECT t.row_num, t.pickup_zone, z.borough, z.zone_name "
                                     "FROM trips t JOIN zones z ON t.pickup_zone = z.id")
    s["exists_shape"] = with_ctes("SELECT z.id, EXISTS (SELECT 1 FROM zone_shapes s WHERE s.location_id = z.id "
                                  "AND s.mappable) AS has_shape FROM zones z", shapes=True)
    s["lookup_payment_label"] = with_ctes(f"SELECT payment_type, COUNT(*) AS trips, {PAYMENT_LABEL} AS payment_label "
                                          f"FROM trips GROUP BY payment_type")
    note = _case_map("err_type", FLAG_NOTES, "err_type")
    s["lookup_flag_note"] = with_ctes(f"SELECT err_type, count, {note} AS note FROM ({BY_TYPE})")
    s["agg_count_distinct"] = with_ctes(
        "SELECT * FROM (SELECT COUNT(DISTINCT pickup_zone) AS unique_pickup_zones, "
        "COUNT(DISTINCT dropoff_zone) AS unique_dropoff_zones FROM trips), "
        "(SELECT COUNT(DISTINCT row_num) AS unique_flagged_rows FROM soft)")
    from .duckdb_sql import pfloat
    v = pfloat("CAST(fare AS VARCHAR)")
    s["aggregate_groups"] = with_ctes(f"""
      SELECT group_key, CAST(COUNT(v) AS BIGINT) AS count, {tofixed(f"coalesce({xsum('v')}, 0.0)", 4)} AS sum,
             {tofixed('MIN(v)', 4)} AS min, {tofixed('MAX(v)', 4)} AS max, {tofixed(xavg('v'), 4)} AS avg
      FROM (SELECT coalesce(CAST(z.borough AS VARCHAR), 'null') AS group_key, {v.replace('fare', 't.fare')} AS v
            FROM trips t JOIN zones z ON t.pickup_zone = z.id)
      GROUP BY group_key""")
    s["group_by_key"] = with_ctes("SELECT coalesce(CAST(payment_type AS VARCHAR), 'null') AS group_key, "
                                  "COUNT(*) AS members FROM trips GROUP BY 1")
    s["stable_sort"] = with_ctes("SELECT CAST(row_number() OVER (ORDER BY fare ASC, row_num ASC) AS BIGINT) AS position, "
                                 f"{TRIP_SELECT} FROM trips")
    s["aggregate_groups_long_decimals"] = f"""
      SELECT l_returnflag AS group_key, COUNT(*) AS count, {tofixed('CAST(SUM(d) AS DOUBLE)', 4)} AS sum, {tofixed('MIN(CAST(d AS DOUBLE))', 4)} AS min,
             {tofixed('MAX(CAST(d AS DOUBLE))', 4)} AS max, {tofixed('CAST(SUM(d) AS DOUBLE) / COUNT(*)', 4)} AS avg
      FROM (SELECT l_returnflag, CAST(l_partkey AS DECIMAL(18,0)) * CAST(0.0000001 AS DECIMAL(9,7)) AS d FROM lineitem) GROUP BY l_returnflag"""
    s["scan_zones_csv"] = s["scan_zones"]
    s["scan_zone_polygons"] = with_ctes("SELECT * FROM zone_shapes", shapes=True)
    s["store_two_loads_trips"] = s["trips"]
    s["store_two_loads_error_log"] = s["error_log"]
    s["store_zones"] = s["scan_zones"]
    ranking = f"""SELECT location_id, coalesce(NULLIF(zone_name, ''), '—') AS zone_name,
                         coalesce(NULLIF(borough, ''), '—') AS borough, coalesce(avg_revenue_per_minute, 0.0) AS rev_min,
                         coalesce(avg_total_amount, 0.0) AS avg_fare, coalesce(avg_tip_percentage, 0.0) AS avg_tip,
                         CAST(coalesce(trip_count, 0) AS BIGINT) AS trips
                  FROM ({PROFIT_TOP.format(n=20)})"""
    s["sort_by_any_column"] = with_ctes(f"SELECT * REPLACE (CASE WHEN location_id % 2 = 0 THEN lower(zone_name) ELSE zone_name END AS zone_name), "
                                        f"CAST(row_number() OVER (ORDER BY lower(zone_name) DESC, location_id ASC) AS BIGINT) AS position FROM ({ranking})")
    # named queries
    s["overview_kpis"] = with_ctes(f"""
      SELECT * FROM (
        SELECT COUNT(*) AS total_trips, {tofixed(xsum('total'), 2)} AS total_revenue, {tofixed(xavg('total'), 2)} AS avg_fare,
               {tofixed(xavg('duration_min'), 2)} AS avg_duration_minutes, {tofixed(xavg('speed_mph'), 2)} AS avg_speed_mph,
               {tofixed(xavg('tip_pct'), 2)} AS avg_tip_percentage, {tofixed(xsum('tip'), 2)} AS total_tips,
               {tofixed(xavg('money_per_min'), 4)} AS avg_revenue_per_minute,
               {iso('MIN(pickup_time)')} AS earliest_trip, {iso('MAX(pickup_time)')} AS latest_trip,
               COUNT(DISTINCT pickup_zone) AS unique_pickup_zones, COUNT(DISTINCT dropoff_zone) AS unique_dropoff_zones
        FROM trips), (SELECT COUNT(DISTINCT row_num) AS flag_rows FROM soft)""")
    for unit in ("day", "hour"):
        s[f"overview_trips_over_time_{unit}"] = with_ctes(f"""
          SELECT {iso('p')} AS period, trip_count, total_revenue, avg_fare, avg_duration_minutes FROM (
            SELECT date_trunc('{unit}', pickup_time) AS p, COUNT(*) AS trip_count, {xsum('total')} AS total_revenue,
                   {xavg('total')} AS avg_fare, {xavg('duration_min')} AS avg_duration_minutes
            FROM trips GROUP BY 1)""")
    s["overview_top_zones"] = with_ctes(TOP_ZONES.format(n=20))
    s["overview_top_zones_100"] = with_ctes(TOP_ZONES.format(n=100))
    s["profitability_top_zones"] = with_ctes(PROFIT_TOP.format(n=20))
    s["profitability_by_borough"] = with_ctes(f"""
      SELECT z.borough, COUNT(t.row_num) AS trip_count, {xsum('t.total')} AS total_revenue, {xavg('t.total')} AS avg_fare,
             {xavg('t.money_per_min')} AS avg_revenue_per_minute, {xavg('t.duration_min')} AS avg_duration_minutes,
             {xavg('t.speed_mph')} AS avg_speed_mph, {xavg('t.tip_pct')} AS avg_tip_percentage,
             {pct('t.total', 0.5)} AS median_fare, {pct('t.money_per_min', 0.5)} AS median_revenue_per_minute
      FROM zones z JOIN trips t ON t.pickup_zone = z.id
      WHERE {KNOWN_BOROUGH}
      GROUP BY z.borough""")
    s["profitability_by_hour"] = with_ctes(BY_HOUR)
    s["tips_by_borough"] = with_ctes(TIPS_BOROUGH)
    s["tips_by_hour"] = with_ctes(TIPS_HOUR)
    s["tips_payment_comparison"] = with_ctes(PAYMENT)
    s["anomalies_summary"] = with_ctes(f"""
      SELECT total_error_records, unique_flagged_rows,
             CASE WHEN n > 0 THEN {tofixed('unique_flagged_rows / n * 100', 2)} ELSE 0.0 END AS flag_rate_percent
      FROM (SELECT COUNT(*) AS total_error_records, COUNT(DISTINCT row_num) AS unique_flagged_rows FROM soft),
           (SELECT COUNT(*) AS n FROM trips)""")
    s["anomalies_by_type"] = with_ctes(BY_TYPE)
    s["anomalies_summary_with_types"] = s["anomalies_summary"].replace(
        "SELECT total_error_records, unique_flagged_rows,",
        f"SELECT total_error_records, unique_flagged_rows, (SELECT string_agg(err_type || '=' || count, ',' ORDER BY count DESC, err_type DESC) FROM ({BY_TYPE})) AS by_type,", 1)
    edges = " UNION ALL ".join(f"SELECT {n} AS case_no, CAST({k} AS BIGINT) AS \"limit\", CAST(least(total, {k}) AS BIGINT) AS count FROM c"
                               for n, k in enumerate((15, 50, 50, 50, 7, 200)))
    s["clamp_limit"] = with_ctes(f"SELECT * FROM (WITH c AS (SELECT COUNT(*) AS total FROM soft) {edges})")
    s["anomalies_list"] = with_ctes(_list("", 50, 0))
    s["anomalies_list_meta"] = with_ctes(_list_meta("", 50, 0))
    s["anomalies_list_typed_page2"] = with_ctes(_list("WHERE err_type = 'HIGH_SPEED'", 50, 50))
    s["anomalies_list_typed_page2_meta"] = with_ctes(_list_meta("WHERE err_type = 'HIGH_SPEED'", 50, 50))
    s["hourly_stats"] = with_ctes(f"""
      SELECT {iso('b')} AS hour_block, hour_of_day, total_trips, avg_price, avg_tip, avg_tip_pct, avg_duration, avg_speed,
             revenue, earnings_per_min FROM (
        SELECT date_trunc('hour', pickup_time) AS b, hour_of_day, COUNT(*) AS total_trips, {xavg('total')} AS avg_price,
               {xavg('tip')} AS avg_tip, {xavg('tip_pct')} AS avg_tip_pct, {xavg('duration_min')} AS avg_duration,
               {xavg('speed_mph')} AS avg_speed, {xsum('total')} AS revenue, {xavg('money_per_min')} AS earnings_per_min
        FROM trips GROUP BY 1, 2)""")
    s["zone_stats"] = with_ctes(f"""
      SELECT z.id AS location_id, z.borough, z.zone_name, CAST(COUNT(t.row_num) AS BIGINT) AS trip_count,
             {xavg('t.total')} AS avg_fare, {xsum('t.total')} AS total_money, {xavg('t.tip_pct')} AS avg_tip_pct,
             {xavg('t.money_per_min')} AS avg_money_min,
             EXISTS (SELECT 1 FROM zone_shapes s WHERE s.location_id = z.id AND s.mappable) AS has_shape
      FROM zones z LEFT JOIN trips t ON t.pickup_zone = z.id
      GROUP BY z.id, z.borough, z.zone_name""", shapes=True)
    s["store_zone_stats"] = s["zone_stats"]
    s["zone_shapes"] = with_ctes("SELECT * FROM zone_shapes", shapes=True)
    s["client_borough_volume"] = with_ctes(f"""
      SELECT v.borough, v.trips, o.display_order FROM
        (SELECT borough, CAST(SUM(trip_count) AS BIGINT) AS trips FROM ({TOP_ZONES.format(n=100)})
         WHERE borough IS NOT NULL GROUP BY borough) v
        JOIN (SELECT borough, CAST(dense_rank() OVER (ORDER BY borough) - 1 AS INTEGER) AS display_order
              FROM (SELECT DISTINCT borough FROM zones WHERE borough IS NOT NULL)) o ON v.borough = o.borough
      WHERE v.trips > 0""")
    s["client_profit_ranking"] = with_ctes(f"SELECT *, CAST(row_number() OVER (ORDER BY rev_min DESC NULLS FIRST, "
                                           f"location_id ASC) AS BIGINT) AS rank FROM ({ranking})")
    s["client_tip_payment_split"] = with_ctes(f"""
      SELECT b.borough, {tofixed('b.avg_tip_percentage * c.card_avg / c.mid', 2)} AS card,
             {tofixed('b.avg_tip_percentage * c.cash_avg / c.mid', 2)} AS cash
      FROM ({TIPS_BOROUGH}) b,
           (SELECT card_avg, cash_avg, CASE WHEN (card_avg + cash_avg) / 2 = 0 THEN 1.0 ELSE (card_avg + cash_avg) / 2 END AS mid
            FROM (SELECT coalesce(card_avg, 0.0) AS card_avg, coalesce(cash_avg, 0.0) AS cash_avg FROM ({_card_cash()}))) c
      WHERE b.borough IS NOT NULL""")
    s["client_tip_insight"] = with_ctes(f"""
      SELECT c.card_avg, c.cash_avg, {tofixed('c.card_avg - c.cash_avg', 1)} AS premium_pp, b.top_borough,
             b.top_borough_tip_pct, h.peak_hour, h.peak_hour_label
      FROM (SELECT * FROM ({_card_cash()}) WHERE has_card > 0 AND has_cash > 0) c
      LEFT JOIN (SELECT borough AS top_borough, avg_tip_percentage AS top_borough_tip_pct FROM ({TIPS_BOROUGH})
                 ORDER BY avg_tip_percentage DESC NULLS LAST, borough DESC LIMIT 1) b ON TRUE
      LEFT JOIN (SELECT hour_of_day AS peak_hour, lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':00' AS peak_hour_label
                 FROM ({TIPS_HOUR}) ORDER BY avg_tip_percentage DESC NULLS LAST, hour_of_day DESC LIMIT 1) h ON TRUE""")
    fare = f"coalesce(fare, {FARE_X})"
    s["client_flag_table"] = with_ctes(f"""
      SELECT row_num, err_type, CASE WHEN {fare} IS NOT NULL THEN '$' || {_fmt_fixed(fare, 2)} ELSE '—' END AS fare_display,
             {note} AS note FROM ({_list('', 50, 0)})""")
    s["client_top_flag"] = with_ctes(f"SELECT err_type AS top_flag, replace(err_type, '_', ' ') AS top_flag_label "
                                     f"FROM ({BY_TYPE}) ORDER BY count DESC, err_type ASC LIMIT 1")
    meta_rows = ", ".join(f"({q(k)}, {q(l)}, {q(d)}, {q(a)})" for k, (l, d, a) in FLAG_META.items())
    s["client_flag_legend"] = with_ctes(f"""
      SELECT m.action, b.err_type, m.label, m.description, CAST(b.count AS BIGINT) AS count
      FROM ({BY_TYPE}) b JOIN (VALUES {meta_rows}) m(err_type, label, description, action) ON b.err_type = m.err_type""")
    s["client_top_zones_table"] = with_ctes(f"""
      SELECT rank, location_id, coalesce(NULLIF(zone_name, ''), '—') AS zone_name, coalesce(NULLIF(borough, ''), '—') AS borough,
             {_fmt_num('trip_count')} AS trips_text,
             CASE WHEN coalesce(avg_fare, 0.0) <> 0 THEN '$' || {_fmt_fixed('avg_fare', 2)} ELSE '—' END AS fare_text,
             CASE WHEN coalesce(avg_tip_percentage, 0.0) <> 0 THEN {_fmt_fixed('avg_tip_percentage', 1)} || '%' ELSE '—' END AS tip_text
      FROM (SELECT *, CAST(row_number() OVER (ORDER BY trip_count DESC NULLS FIRST, location_id ASC) AS BIGINT) AS rank
            FROM ({TOP_ZONES.format(n=100)})) WHERE rank <= 10""")
    s["client_kpi_cards"] = with_ctes(f"""
      SELECT {_fmt_num('total_trips')} AS total_trips_text, '$' || {_fmt_fixed('avg_fare', 2)} AS avg_fare_text,
             '$' || {_fmt_fixed('avg_revenue_per_minute', 2)} || '/min' AS rev_per_min_text,
             {_fmt_fixed('avg_speed_mph', 1)} || ' mph' AS avg_speed_text
      FROM (SELECT COUNT(*) AS total_trips, {tofixed(xavg('total'), 2)} AS avg_fare, {tofixed(xavg('speed_mph'), 2)} AS avg_speed_mph,
                   {tofixed(xavg('money_per_min'), 4)} AS avg_revenue_per_minute FROM trips)""")
    s["client_anomaly_cards"] = with_ctes(f"""
      SELECT {_fmt_num('unique_flagged_rows')} AS flagged_text, {_fmt_fixed('flag_rate_percent', 1)} || '%' AS rate_text,
             top_flag_label
      FROM (SELECT COUNT(DISTINCT row_num) AS unique_flagged_rows FROM soft),
           (SELECT CASE WHEN n > 0 THEN {tofixed('f / n * 100', 2)} ELSE 0.0 END AS flag_rate_percent
            FROM (SELECT COUNT(*) AS n FROM trips), (SELECT COUNT(DISTINCT row_num) AS f FROM soft)),
           (SELECT replace(err_type, '_', ' ') AS top_flag_label FROM ({BY_TYPE}) ORDER BY count DESC, err_type ASC LIMIT 1)""")
    s["display_formats_by_hour"] = with_ctes(f"""
      SELECT hour_of_day, lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':00' AS hour_label, {_fmt_num('trip_count')} AS trips_text,
             '$' || {_fmt_fixed('avg_fare', 2)} AS fare_text, '$' || {_fmt_fixed('avg_revenue_per_minute', 2)} || '/min' AS rpm_text,
             {_fmt_fixed('trip_count / 1000', 0)} || 'k' AS k_text
      FROM ({BY_HOUR})""")
    s["display_formats_by_day"] = with_ctes(f"""
      SELECT {iso('d')} AS period, strftime(d, '%b %-d') AS day_label, {_fmt_num('trip_count')} AS trips_text
      FROM (SELECT date_trunc('day', pickup_time) AS d, COUNT(*) AS trip_count FROM trips GROUP BY 1)""")
    s["events_json_extract"] = ("SELECT event_type, COUNT(*) AS events, "
                                "SUM(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_sum, "
                                "COUNT(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_present "
                                "FROM events GROUP BY event_type")
    s["events_by_hour"] = (f"SELECT {iso('h')} AS period, events, value_sum FROM (SELECT date_trunc('hour', ts) AS h, "
                           f"COUNT(*) AS events, CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS value_sum "
                           f"FROM events GROUP BY 1)")
    s["stream_trips"] = s["trips"]
    s["stream_hourly_stats"] = s["hourly_stats"]
    late = "hard_code IS NULL AND pickup_time < (SELECT MAX(pickup_time) FROM norm WHERE hard_code IS NULL) - INTERVAL 7 DAY"
    counters = """
      SELECT {epochs} AS epochs, {times} * raw AS total_raw_rows, {times} * bad AS excluded, {late} AS late,
             {times} * (raw - bad) - {late} - kept AS duplicates, flagged, kept - flagged AS clean, inserted, kept - inserted AS quarantined
      FROM (SELECT COUNT(*) AS raw, COUNT(hard_code) AS bad, COUNT(CASE WHEN """ + late + """ THEN 1 END) AS behind FROM norm),
           (SELECT COUNT(*) AS kept, COUNT(CASE WHEN len(post_flags) > 0 THEN 1 END) AS flagged, COUNT(CASE WHEN NOT orphan THEN 1 END) AS inserted FROM kept)"""
    s["stream_counters"] = with_ctes(counters.format(epochs=4, times=1, late=0))
    s["stream_redelivery_trips"] = s["trips"]
    s["stream_late_rows"] = with_ctes(f"SELECT row_num, {iso('pickup_time')} AS pickup_time, total FROM norm WHERE {late}")
    s["stream_redelivery_counters"] = with_ctes(counters.format(epochs=5, times=2, late="behind"))
    s["store_hourly_stats"] = s["hourly_stats"]
    s["anomalies_page_after"] = s["store_anomalies_page_after"] = with_ctes(_list("", 50, 50))
    s["store_anomalies_list"] = s["anomalies_list"]
    s["anomalies_page_after_typed"] = s["anomalies_list_typed_page2"]
    by_place = TRIP_SELECT.replace("row_num", "p.place AS row_num", 1)
    s["load_files_trips"] = with_ctes(f"SELECT {by_place} FROM trips JOIN (SELECT row_num AS numbered, CAST(row_number() OVER (ORDER BY row_num) AS BIGINT) AS place FROM raw) p ON row_num = numbered")
    s["load_files_zone_stats"] = s["zone_stats"]
    s["store_readmitted_trips"] = s["trips"]
    s["store_readmitted_quarantine"] = s["referential_orphans"]
    s["store_readmitted_zone_stats"] = s["zone_stats"]
    for key in ("profitability_by_borough", "tips_payment_comparison", "overview_kpis"):
        s[f"store_{key}"] = s[key]
    s["store_anomalies_summary"] = s["anomalies_summary_with_types"]
    s["overview_trips_over_time_meta"] = with_ctes("SELECT COUNT(DISTINCT date_trunc('hour', pickup_time)) + MAX(CASE WHEN pickup_time IS NULL THEN 1 ELSE 0 END) AS count, 'hour' AS granularity FROM trips")
    s["overview_top_zones_meta"] = with_ctes(f"SELECT COUNT(*) AS count, CAST(15 AS BIGINT) AS \"limit\" FROM ({TOP_ZONES.format(n=15)})")
    for code in FLAG_META:
        s[f"flag_{code.lower()}"] = with_ctes(f"SELECT {ERROR_SELECT} FROM error_log WHERE err_type = {q(code)}")
    return s
