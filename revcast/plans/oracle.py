"""DuckDB SQL oracles for the named queries.

Each statement recomputes a query from the raw test tables (views
``events``, ``region``, …) with plain SQL; nothing of the engine is imported:
the FIXTURES mapping, validation, dedup, chain building and scoring are
spelled out again here. Every query has an entry.
"""

from __future__ import annotations

SPLIT_AT = "TIMESTAMP '2024-01-15 00:00:00'"
COVERAGE_THRESHOLD = 0.5


def MEAN(expr: str) -> str:
    return f"round(avg({expr}), 6)"


def RMS(expr: str) -> str:
    return f"round(sqrt(avg({expr})), 6)"


def BUCKET(lead: str) -> str:
    return (
        f"CASE WHEN {lead} <= 6 THEN '00-06h' WHEN {lead} <= 12 THEN '07-12h' WHEN {lead} <= 24 THEN '13-24h' "
        f"WHEN {lead} <= 48 THEN '25-48h' WHEN {lead} <= 72 THEN '49-72h' ELSE '72h+' END"
    )


def SK(x: str) -> str:
    return f"CAST(('0x' || substr(sha256({x}), 1, 15)) AS BIGINT)"


def WIDE(x: str) -> str:
    return f"sha256({x})"


def HASH(*cols: str) -> str:
    parts = " || '|' || ".join(
        f"coalesce(CAST(CAST({c} AS DECIMAL(18,6)) AS VARCHAR), '')" for c in cols
    )
    return f"sha256({parts})"


FKEY = "source_key, city_key, issued_at, forecast_timestamp"
F_MEASURES = "temperature_2m_c, precipitation_probability_pct, wind_speed_10m_kmh"

EV = """
ev AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_id, e.event_id AS n,
         e.event_type AS kind, r.r_name AS city,
         CAST(r.r_regionkey AS DOUBLE) * 10.0 + CAST(e.user_id % 2 AS DOUBLE) * 0.25 AS latitude,
         CAST(r.r_regionkey AS DOUBLE) * 15.0 - 30.0 + CAST(e.user_id % 3 AS DOUBLE) * 0.5 AS longitude,
         CASE WHEN e.event_id % 53 = 0 THEN NULL ELSE e.value / 2 - 20 END AS temperature_2m_c,
         CAST(e.user_id % 60 AS DOUBLE) AS wind_speed_10m_kmh,
         CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS k,
         e.ts AS ingested_at, e.ts AS ts
  FROM events e JOIN region r ON r.r_regionkey = e.user_id % 5
)"""

FC_RAW = """
fc_raw AS (
  SELECT event_id, 'forecast' AS event_type, kind AS source, city, latitude, longitude,
         date_trunc('hour', ts) - to_hours(CAST(hour(ts) % 6 AS BIGINT)) AS issued_at,
         date_trunc('hour', ts) - to_hours(CAST(hour(ts) % 6 AS BIGINT))
           + to_hours(CAST(CASE WHEN n % 47 = 0 THEN -24 ELSE (n % 13) * 8 END AS BIGINT))
           AS forecast_timestamp,
         temperature_2m_c,
         CASE WHEN k = 0 THEN NULL ELSE k END AS precipitation_probability_pct,
         wind_speed_10m_kmh, ingested_at
  FROM ev WHERE kind <> 'view'
)"""

OB_RAW = """
ob_raw AS (
  SELECT event_id, 'observation' AS event_type, 'view' AS source, city, latitude, longitude,
         date_trunc('hour', ts) - to_hours(CAST(hour(ts) % 2 AS BIGINT)) AS observation_timestamp,
         temperature_2m_c, k / 10 AS precipitation_mm, wind_speed_10m_kmh, ingested_at
  FROM ev WHERE kind = 'view'
)"""

FC_NORM = """
fc_norm AS (
  SELECT event_id, event_type, lower(trim(source)) AS source, trim(city) AS city,
         latitude, longitude, issued_at, forecast_timestamp, temperature_2m_c,
         precipitation_probability_pct, wind_speed_10m_kmh, ingested_at,
         CAST(forecast_timestamp AS DATE) AS forecast_date
  FROM fc_raw
)"""

OB_NORM = """
ob_norm AS (
  SELECT event_id, event_type, lower(trim(source)) AS source, trim(city) AS city,
         latitude, longitude, observation_timestamp, temperature_2m_c,
         precipitation_mm, wind_speed_10m_kmh, ingested_at,
         CAST(observation_timestamp AS DATE) AS observation_date
  FROM ob_raw
)"""

FC_OK = """coalesce(event_id IS NOT NULL AND city IS NOT NULL AND issued_at IS NOT NULL
      AND forecast_timestamp IS NOT NULL AND forecast_timestamp >= issued_at
      AND temperature_2m_c BETWEEN -100.0 AND 70.0
      AND (precipitation_probability_pct IS NULL OR precipitation_probability_pct BETWEEN 0.0 AND 100.0), false)"""
OB_OK = """coalesce(event_id IS NOT NULL AND city IS NOT NULL AND observation_timestamp IS NOT NULL
      AND temperature_2m_c BETWEEN -100.0 AND 70.0, false)"""

FC_VALID = f"fc_valid AS (SELECT * FROM fc_norm WHERE {FC_OK})"
OB_VALID = f"ob_valid AS (SELECT * FROM ob_norm WHERE {OB_OK})"

DEDUP_ORDER = "ORDER BY ingested_at DESC, latitude DESC, longitude DESC"
FC_SILVER = f"""
fc_silver AS (SELECT * FROM fc_valid
  QUALIFY row_number() OVER (PARTITION BY event_id {DEDUP_ORDER}) = 1)"""
OB_SILVER = f"""
ob_silver AS (SELECT * FROM ob_valid
  QUALIFY row_number() OVER (PARTITION BY event_id {DEDUP_ORDER}) = 1)"""

FC_COLS = """event_id, event_type, source, city, latitude, longitude, issued_at,
  forecast_timestamp, temperature_2m_c, precipitation_probability_pct,
  wind_speed_10m_kmh"""
REDELIVERY = f"""
redelivery AS (
  SELECT {FC_COLS}, ingested_at, forecast_date FROM fc_valid
  UNION ALL
  SELECT {FC_COLS}, ingested_at + INTERVAL 1 HOUR AS ingested_at, forecast_date
  FROM fc_valid WHERE CAST(event_id AS BIGINT) % 10 = 0
)"""

OB_LATEST = """
ob_latest AS (SELECT * FROM ob_silver
  QUALIFY row_number() OVER (PARTITION BY source, city, observation_timestamp
                             ORDER BY ingested_at DESC, event_id DESC) = 1)"""

LEAD_EXACT = "(epoch(f.forecast_timestamp) - epoch(f.issued_at)) / 3600.0"
GOLD = f"""
gold AS (
  SELECT f.event_id, f.source, o.source AS observation_source, f.city, f.issued_at,
         f.forecast_timestamp,
         {LEAD_EXACT} AS lead_hours,
         {BUCKET(LEAD_EXACT)} AS lead_time_bucket,
         f.temperature_2m_c AS forecast_temperature_c,
         o.temperature_2m_c AS observed_temperature_c,
         f.temperature_2m_c - o.temperature_2m_c AS temperature_error_c,
         abs(f.temperature_2m_c - o.temperature_2m_c) AS temperature_absolute_error_c,
         (f.temperature_2m_c - o.temperature_2m_c) * (f.temperature_2m_c - o.temperature_2m_c) AS temperature_squared_error,
         f.precipitation_probability_pct, o.precipitation_mm,
         f.wind_speed_10m_kmh AS forecast_wind_kmh,
         o.wind_speed_10m_kmh AS observed_wind_kmh,
         CAST(f.forecast_timestamp AS DATE) AS target_date
  FROM fc_silver f JOIN ob_latest o
    ON o.city = f.city AND o.observation_timestamp = f.forecast_timestamp
)"""

MEASURES = f"""count(*) AS matched_forecasts,
  {MEAN('temperature_absolute_error_c')} AS temperature_mae_c,
  {RMS('temperature_squared_error')} AS temperature_rmse_c,
  {MEAN('temperature_error_c')} AS temperature_bias_c"""


def incoming(src: str, name: str = "inc") -> str:
    """Staged forecasts as revision candidates."""
    return f"""
{name} AS (
  SELECT {SK('source')} AS source_key, {SK('city')} AS city_key, issued_at,
         forecast_timestamp, {F_MEASURES}, event_id AS source_event_id,
         ingested_at AS seen_at,
         {HASH('temperature_2m_c', 'precipitation_probability_pct', 'wind_speed_10m_kmh')} AS record_hash
  FROM {src}
)"""


def chain(src: str, name: str = "fact") -> str:
    """U1 as window SQL: equal-time ties → greatest id; repeats of the
    previous hash extend the open revision; lead() closes intervals."""
    return f"""
{name}_tie AS (SELECT * FROM {src}
  QUALIFY row_number() OVER (PARTITION BY {FKEY}, seen_at ORDER BY source_event_id DESC) = 1),
{name}_mk AS (
  SELECT *, CASE WHEN lag(record_hash) OVER (PARTITION BY {FKEY} ORDER BY seen_at)
                      IS DISTINCT FROM record_hash THEN 1 ELSE 0 END AS st
  FROM {name}_tie),
{name}_rn AS (
  SELECT *, sum(st) OVER (PARTITION BY {FKEY} ORDER BY seen_at
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM {name}_mk),
{name}_ls AS (
  SELECT *, max(seen_at) OVER (PARTITION BY {FKEY}, run) AS last_seen_at FROM {name}_rn),
{name}_ch AS (
  SELECT *, lead(seen_at) OVER (PARTITION BY {FKEY} ORDER BY seen_at) AS effective_to
  FROM {name}_ls WHERE st = 1),
{name} AS (
  SELECT {WIDE("concat_ws('|', CAST(source_key AS VARCHAR), CAST(city_key AS VARCHAR), "
             "CAST(epoch_us(issued_at) AS VARCHAR), CAST(epoch_us(forecast_timestamp) AS VARCHAR), "
             "CAST(epoch_us(seen_at) AS VARCHAR))")} AS forecast_revision_key,
         {FKEY}, {F_MEASURES}, source_event_id, seen_at AS effective_from, effective_to,
         effective_to IS NULL AS is_current, record_hash, last_seen_at,
         CAST(forecast_timestamp AS DATE) AS forecast_date
  FROM {name}_ch)"""


FACT_OBS = f"""
obs_inc AS (
  SELECT {SK('source')} AS source_key, {SK('city')} AS city_key, observation_timestamp,
         temperature_2m_c, precipitation_mm, wind_speed_10m_kmh,
         event_id AS source_event_id, ingested_at
  FROM ob_silver),
fact_obs AS (
  SELECT *, CAST(observation_timestamp AS DATE) AS observation_date FROM obs_inc
  QUALIFY row_number() OVER (PARTITION BY source_key, city_key, observation_timestamp
                             ORDER BY ingested_at DESC, source_event_id DESC) = 1)"""

STAGED_NAMES = """
staged_names AS (
  SELECT city, source, latitude, longitude, ingested_at FROM fc_silver
  UNION ALL
  SELECT city, source, latitude, longitude, ingested_at FROM ob_silver)"""

DIM_CITY = f"""
dim_city AS (
  SELECT {SK('city')} AS city_key, city AS city_name,
         CAST(latitude AS DECIMAL(9,6)) AS latitude, CAST(longitude AS DECIMAL(9,6)) AS longitude
  FROM staged_names WHERE city IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY ingested_at, latitude, longitude) = 1)"""

DIM_SOURCE = f"""
dim_source AS (
  SELECT {SK('source')} AS source_key, source AS source_name
  FROM (SELECT DISTINCT source FROM staged_names WHERE source IS NOT NULL))"""

LEAD_INT = "date_diff('hour', f.issued_at, f.forecast_timestamp)"
V_ACC = f"""
v_acc AS (
  SELECT s.source_name, c.city_name, f.issued_at, f.forecast_timestamp,
         {LEAD_INT} AS lead_hours,
         f.temperature_2m_c AS forecast_temperature_c,
         o.temperature_2m_c AS observed_temperature_c,
         f.temperature_2m_c - o.temperature_2m_c AS error_c,
         abs(f.temperature_2m_c - o.temperature_2m_c) AS absolute_error_c
  FROM fact f
  JOIN fact_obs o ON o.city_key = f.city_key AND o.observation_timestamp = f.forecast_timestamp
  JOIN dim_city c ON c.city_key = f.city_key
  JOIN dim_source s ON s.source_key = f.source_key)"""


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


BASE_F = [EV, FC_RAW, FC_NORM]
BASE_O = [EV, OB_RAW, OB_NORM]
SILVER_F = BASE_F + [FC_VALID, FC_SILVER]
SILVER_O = [OB_RAW, OB_NORM, OB_VALID, OB_SILVER]
SILVER_BOTH = SILVER_F + SILVER_O
FACT = SILVER_F + [incoming("fc_silver"), chain("inc")]
WAREHOUSE = SILVER_BOTH + [incoming("fc_silver"), chain("inc"), FACT_OBS, STAGED_NAMES, DIM_CITY, DIM_SOURCE]
RED_FACT = BASE_F + [FC_VALID, REDELIVERY, incoming("redelivery"), chain("inc")]

FACT_OUT = f"""forecast_revision_key, {FKEY}, {F_MEASURES}, source_event_id, effective_from,
  effective_to, is_current, record_hash, last_seen_at, forecast_date"""

QUARANTINE_F = """concat_ws(',',
  CASE WHEN NOT coalesce(event_id IS NOT NULL, false) THEN 'event_id_present' END,
  CASE WHEN NOT coalesce(city IS NOT NULL, false) THEN 'city_present' END,
  CASE WHEN NOT coalesce(issued_at IS NOT NULL, false) THEN 'issued_at_parses' END,
  CASE WHEN NOT coalesce(forecast_timestamp IS NOT NULL, false) THEN 'forecast_timestamp_parses' END,
  CASE WHEN NOT coalesce(forecast_timestamp >= issued_at, false) THEN 'target_not_before_issue' END,
  CASE WHEN NOT coalesce(temperature_2m_c BETWEEN -100.0 AND 70.0, false) THEN 'temperature_in_range' END,
  CASE WHEN NOT coalesce(precipitation_probability_pct IS NULL OR precipitation_probability_pct BETWEEN 0.0 AND 100.0, false)
       THEN 'precipitation_probability_in_range' END)"""
QUARANTINE_O = """concat_ws(',',
  CASE WHEN NOT coalesce(event_id IS NOT NULL, false) THEN 'event_id_present' END,
  CASE WHEN NOT coalesce(city IS NOT NULL, false) THEN 'city_present' END,
  CASE WHEN NOT coalesce(observation_timestamp IS NOT NULL, false) THEN 'observation_timestamp_parses' END,
  CASE WHEN NOT coalesce(temperature_2m_c BETWEEN -100.0 AND 70.0, false) THEN 'temperature_in_range' END)"""

RULES_F = [
    ("event_id_present", "event_id IS NOT NULL"),
    ("city_present", "city IS NOT NULL"),
    ("issued_at_parses", "issued_at IS NOT NULL"),
    ("forecast_timestamp_parses", "forecast_timestamp IS NOT NULL"),
    ("target_not_before_issue", "forecast_timestamp >= issued_at"),
    ("temperature_in_range", "temperature_2m_c BETWEEN -100.0 AND 70.0"),
    ("precipitation_probability_in_range",
     "precipitation_probability_pct IS NULL OR precipitation_probability_pct BETWEEN 0.0 AND 100.0"),
]
RULES_O = [
    ("event_id_present", "event_id IS NOT NULL"),
    ("city_present", "city IS NOT NULL"),
    ("observation_timestamp_parses", "observation_timestamp IS NOT NULL"),
    ("temperature_in_range", "temperature_2m_c BETWEEN -100.0 AND 70.0"),
]


def _rule_counts(kind: str, src: str, rules) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{kind}' AS event_type, '{name}' AS rule, "
        f"count(*) FILTER (WHERE NOT coalesce({pred}, false)) AS violations FROM {src}"
        for name, pred in rules
    )


PAYLOAD_POINTS = f"""
hourly AS (SELECT * FROM fc_norm
  QUALIFY row_number() OVER (PARTITION BY source, city, issued_at, forecast_timestamp
                             ORDER BY ingested_at DESC, event_id DESC) = 1),
points AS (
  SELECT source, city, issued_at,
         first_value(latitude) OVER g AS latitude, first_value(longitude) OVER g AS longitude,
         max(ingested_at) OVER (PARTITION BY source, city, issued_at, CAST(forecast_timestamp AS DATE)) AS ingested_at,
         CAST(row_number() OVER (PARTITION BY source, city, issued_at, CAST(forecast_timestamp AS DATE)
                                 ORDER BY forecast_timestamp) - 1 AS INTEGER) AS pos,
         forecast_timestamp AS event_ts, temperature_2m_c,
         precipitation_probability_pct, CAST(NULL AS DOUBLE) AS precipitation_mm,
         wind_speed_10m_kmh
  FROM hourly
  WINDOW g AS (PARTITION BY source, city, issued_at, CAST(forecast_timestamp AS DATE)
               ORDER BY ingested_at, latitude, longitude
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def _metrics(kind: str, src: str, ok: str) -> str:
    return f"""SELECT '{kind}' AS event_type, count(*) AS input_count,
  count(*) FILTER (WHERE {ok}) AS valid_count,
  count(*) FILTER (WHERE NOT {ok}) AS invalid_count,
  count(DISTINCT CASE WHEN {ok} THEN event_id END) AS deduplicated_count
FROM {src}"""


ORACLE: dict[str, str] = {
    "fixture_forecast": W(EV, FC_RAW) + "\nSELECT * FROM fc_raw",
    "fixture_observation": W(EV, OB_RAW) + "\nSELECT * FROM ob_raw",
    "silver_valid_forecast": W(*BASE_F, FC_VALID) + "\nSELECT * FROM fc_valid",
    "silver_valid_observation": W(*BASE_O, OB_VALID) + "\nSELECT * FROM ob_valid",
    "silver_quarantine": W(EV, FC_RAW, FC_NORM, OB_RAW, OB_NORM) + f"""
SELECT event_id, event_type, source, city, forecast_timestamp AS target_timestamp,
       temperature_2m_c, ingested_at, {QUARANTINE_F} AS failed_rules
FROM fc_norm WHERE NOT {FC_OK}
UNION ALL
SELECT event_id, event_type, source, city, observation_timestamp AS target_timestamp,
       temperature_2m_c, ingested_at, {QUARANTINE_O} AS failed_rules
FROM ob_norm WHERE NOT {OB_OK}""",
    "silver_metrics": W(EV, FC_RAW, FC_NORM, OB_RAW, OB_NORM) + "\n"
    + _metrics("forecast", "fc_norm", FC_OK) + "\nUNION ALL\n" + _metrics("observation", "ob_norm", OB_OK),
    "silver_dedup": W(*BASE_F, FC_VALID, REDELIVERY) + f"""
SELECT * FROM redelivery QUALIFY row_number() OVER (PARTITION BY event_id {DEDUP_ORDER}) = 1""",
    "gold_accuracy_rows": W(*SILVER_BOTH, OB_LATEST, GOLD) + "\nSELECT * FROM gold",
    "gold_accuracy_summary": W(*SILVER_BOTH, OB_LATEST, GOLD) + f"""
SELECT city, lead_time_bucket, {MEASURES} FROM gold GROUP BY city, lead_time_bucket
ORDER BY city, lead_time_bucket""",
    "record_hash": W(*SILVER_F, incoming("fc_silver")) + "\nSELECT source_event_id, record_hash FROM inc",
    "surrogate_keys": W(*SILVER_BOTH, STAGED_NAMES, DIM_CITY, DIM_SOURCE) + """
SELECT 'city' AS dimension, city_name AS name, city_key AS surrogate_key FROM dim_city
UNION ALL
SELECT 'source' AS dimension, source_name AS name, source_key AS surrogate_key FROM dim_source""",
    "dim_city": W(*SILVER_BOTH, STAGED_NAMES, DIM_CITY) + "\nSELECT * FROM dim_city",
    "dim_source": W(*SILVER_BOTH, STAGED_NAMES, DIM_SOURCE) + "\nSELECT * FROM dim_source",
    "dim_time": W(*WAREHOUSE) + """,
stamps AS (
  SELECT issued_at AS t FROM fact UNION ALL SELECT forecast_timestamp FROM fact
  UNION ALL SELECT observation_timestamp FROM fact_obs),
hours AS (
  SELECT unnest(generate_series(date_trunc('hour', min(t)), max(t), INTERVAL 1 HOUR)) AS full_timestamp
  FROM stamps)
SELECT CAST(year(full_timestamp) AS BIGINT) * 1000000 + month(full_timestamp) * 10000
         + day(full_timestamp) * 100 + hour(full_timestamp) AS time_key,
       full_timestamp, CAST(full_timestamp AS DATE) AS calendar_date,
       CAST(year(full_timestamp) AS SMALLINT) AS year_num,
       CAST(month(full_timestamp) AS SMALLINT) AS month_num,
       CAST(day(full_timestamp) AS SMALLINT) AS day_num,
       CAST(hour(full_timestamp) AS SMALLINT) AS hour_num,
       CAST(dayofweek(full_timestamp) AS SMALLINT) AS day_of_week
FROM hours""",
    "scd2_revisions": W(*FACT) + f"\nSELECT {FACT_OUT} FROM fact",
    "scd2_apply_incremental": W(*RED_FACT) + f"\nSELECT {FACT_OUT} FROM fact",
    "observation_upsert": W(EV, *SILVER_O, FACT_OBS) + """
SELECT source_key, city_key, observation_timestamp, temperature_2m_c, precipitation_mm,
       wind_speed_10m_kmh, source_event_id, ingested_at, observation_date FROM fact_obs""",
    "v_current_forecasts": W(*WAREHOUSE) + f"""
SELECT f.forecast_revision_key, s.source_name, c.city_name, f.issued_at, f.forecast_timestamp,
       {LEAD_INT} AS lead_hours, f.temperature_2m_c, f.precipitation_probability_pct,
       f.wind_speed_10m_kmh
FROM fact f JOIN dim_city c ON c.city_key = f.city_key
JOIN dim_source s ON s.source_key = f.source_key
WHERE f.is_current""",
    "v_temperature_accuracy": W(*WAREHOUSE, V_ACC) + "\nSELECT * FROM v_acc",
    "v_accuracy_by_city_lead": W(*WAREHOUSE, V_ACC) + f"""
SELECT city_name, {BUCKET('lead_hours')} AS lead_time_bucket,
       count(*) AS sample_count, {MEAN('absolute_error_c')} AS mae_c,
       {RMS('error_c * error_c')} AS rmse_c, {MEAN('error_c')} AS bias_c
FROM v_acc GROUP BY 1, 2""",
    "accuracy_by_source": W(*SILVER_BOTH, OB_LATEST, GOLD) + f"""
SELECT source, {MEASURES} FROM gold GROUP BY source ORDER BY source""",
    "accuracy_grouping_sets": W(*SILVER_BOTH, OB_LATEST, GOLD) + f"""
SELECT city, source, lead_time_bucket,
       CAST(grouping(city, source, lead_time_bucket) AS INTEGER) AS grouping_level, {MEASURES}
FROM gold GROUP BY GROUPING SETS ((city), (source), (lead_time_bucket), (city, lead_time_bucket))""",
    "dq_duplicate_current": W(*RED_FACT) + f"""
SELECT {FKEY}, count(*) AS current_rows FROM fact WHERE is_current
GROUP BY {FKEY} HAVING count(*) > 1""",
    "dq_duplicate_current_unmerged": W(*BASE_F, FC_VALID, REDELIVERY, incoming("redelivery")) + f"""
SELECT {FKEY}, count(*) AS current_rows FROM inc GROUP BY {FKEY} HAVING count(*) > 1""",
    "dq_invalid_intervals": W(*RED_FACT) + f"""
SELECT {FACT_OUT} FROM fact WHERE effective_to IS NOT NULL AND effective_to <= effective_from""",
    "dq_target_before_issue": W(*BASE_F) + """
SELECT event_id, source, city, issued_at, forecast_timestamp FROM fc_norm
WHERE forecast_timestamp < issued_at""",
    "dq_duplicate_observations": W(EV, *SILVER_O, FACT_OBS) + """
SELECT source_key, city_key, observation_timestamp, count(*) AS cnt FROM fact_obs
GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "dq_duplicate_observations_unmerged": W(EV, *SILVER_O, FACT_OBS) + """
SELECT source_key, city_key, observation_timestamp, count(*) AS cnt FROM obs_inc
GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "dq_missing_observations": W(*WAREHOUSE) + """
SELECT count(*) AS missing_observation_count
FROM fact f
WHERE f.forecast_timestamp < (SELECT max(observation_timestamp) FROM fact_obs)
  AND NOT EXISTS (SELECT 1 FROM fact_obs o
                  WHERE o.city_key = f.city_key AND o.observation_timestamp = f.forecast_timestamp)""",
    "dq_join_coverage": W(*SILVER_BOTH) + f""",
seen AS (SELECT DISTINCT city, observation_timestamp FROM ob_silver)
SELECT count(*) AS forecast_count, count(s.city) AS matched_count,
       count(s.city) / count(*) AS coverage,
       CAST({COVERAGE_THRESHOLD} AS DOUBLE) AS threshold,
       count(s.city) / count(*) >= {COVERAGE_THRESHOLD} AS passed
FROM fc_silver f LEFT JOIN seen s
  ON s.city = f.city AND s.observation_timestamp = f.forecast_timestamp""",
    "dq_ingestion_lag": W(*SILVER_BOTH) + """,
lags AS (
  SELECT 'forecast' AS event_type, (epoch_us(ingested_at) - epoch_us(issued_at)) / 1e6 AS lag_seconds FROM fc_silver
  UNION ALL
  SELECT 'observation', (epoch_us(ingested_at) - epoch_us(observation_timestamp)) / 1e6 FROM ob_silver)
SELECT event_type, count(*) AS events, min(lag_seconds) AS min_lag_seconds,
       max(lag_seconds) AS max_lag_seconds, """ + MEAN("lag_seconds") + """ AS avg_lag_seconds
FROM lags GROUP BY event_type""",
    "dq_event_id_unique": W(*BASE_F, FC_VALID, REDELIVERY) + f""",
dedup AS (SELECT * FROM redelivery QUALIFY row_number() OVER (PARTITION BY event_id {DEDUP_ORDER}) = 1)
SELECT event_id, count(*) AS occurrences FROM dedup GROUP BY event_id HAVING count(*) > 1""",
    "dq_event_id_unique_unmerged": W(*BASE_F, FC_VALID, REDELIVERY) + """
SELECT event_id, count(*) AS occurrences FROM redelivery GROUP BY event_id HAVING count(*) > 1""",
    "dq_rule_violations": W(EV, FC_RAW, FC_NORM, OB_RAW, OB_NORM) + "\n"
    + _rule_counts("forecast", "fc_norm", RULES_F) + "\nUNION ALL\n"
    + _rule_counts("observation", "ob_norm", RULES_O),
    "hourly_explode": W(*BASE_F, PAYLOAD_POINTS) + """
SELECT source, city, latitude, longitude, issued_at, ingested_at, pos, event_ts, temperature_2m_c,
       precipitation_probability_pct, precipitation_mm, wind_speed_10m_kmh FROM points""",
    "event_split": W(*BASE_F, PAYLOAD_POINTS) + """
SELECT 'forecast' AS event_type, source, city, ingested_at, latitude, longitude, issued_at,
       event_ts AS forecast_timestamp, temperature_2m_c, precipitation_probability_pct,
       wind_speed_10m_kmh, CAST(NULL AS TIMESTAMP) AS observation_timestamp,
       CAST(NULL AS DOUBLE) AS precipitation_mm
FROM points WHERE event_ts >= issued_at
UNION ALL
SELECT 'observation', source, city, ingested_at, latitude, longitude, NULL, NULL,
       temperature_2m_c, NULL, wind_speed_10m_kmh, event_ts, precipitation_mm
FROM points WHERE NOT (event_ts >= issued_at)""",
}

ORACLE["silver_incremental_two_days"] = W(*SILVER_F) + "\nSELECT * FROM fc_silver"
ORACLE["warehouse_incremental"] = ORACLE["warehouse_from_silver"] = ORACLE["scd2_revisions"]
ORACLE["warehouse_observation_incremental"] = ORACLE["observation_upsert"]
ORACLE["gold_incremental"] = ORACLE["gold_accuracy_rows"]

ORACLE["scd2_any_order"] = ORACLE["scd2_apply_incremental"]
ORACLE["batch_rerun"] = ORACLE["silver_incremental_two_days"]
ORACLE["observation_deltas"] = ORACLE["observation_compacted"] = ORACLE["observation_upsert"]
ORACLE["gold_delta"] = ORACLE["gold_changes_net"] = ORACLE["gold_accuracy_rows"]
ORACLE["gold_delta_summary"] = ORACLE["gold_accuracy_summary"]

# What the first batch alone leaves in each table.
_FIRST = EV.replace("ON r.r_regionkey = e.user_id % 5", f"ON r.r_regionkey = e.user_id % 5\n  WHERE e.ts < {SPLIT_AT}")
ORACLE["commit_lost_writer"] = W(
    _FIRST, FC_RAW, FC_NORM, FC_VALID, FC_SILVER, *SILVER_O, OB_LATEST, GOLD, incoming("fc_valid"), chain("inc"), FACT_OBS
) + """
SELECT 'silver_forecast' AS table_name, event_id FROM fc_silver
UNION ALL SELECT 'silver_observation', event_id FROM ob_silver
UNION ALL SELECT 'fact_forecast', forecast_revision_key FROM fact
UNION ALL SELECT 'fact_observation', source_event_id FROM fact_obs
UNION ALL SELECT 'gold', event_id FROM gold"""

# Sketches are approximate: the oracle says how many events there are and that
# each quantile must lie within its rank bounds.
ORACLE["dq_lag_quantiles"] = W(*SILVER_BOTH) + """,
n AS (SELECT 'forecast' AS event_type, count(*) AS events FROM fc_silver
      UNION ALL SELECT 'observation', count(*) FROM ob_silver)
SELECT event_type, rank, events, true AS within_bounds
FROM n, (VALUES (0.5::DOUBLE), (0.9::DOUBLE), (0.99::DOUBLE)) AS r(rank)"""

ORACLE["gold_summary_stored"] = ORACLE["gold_accuracy_summary"]
ORACLE["payload_files"] = ORACLE["hourly_explode"]

ORACLE["scd2_hot_key"] = W(*BASE_F, FC_VALID, REDELIVERY) + f""",
hot AS (SELECT * REPLACE ('all' AS source, 'EVERYWHERE' AS city, {SPLIT_AT} AS issued_at,
                          {SPLIT_AT} AS forecast_timestamp) FROM redelivery),
{incoming("hot").strip()},
{chain("inc").strip()}
SELECT {FACT_OUT} FROM fact"""

ORACLE["unsupported_type"] = W(EV, FC_RAW) + """
SELECT event_id, CASE WHEN CAST(event_id AS BIGINT) % 107 = 0 THEN 'radar' ELSE event_type END AS event_type,
       CAST(event_id AS BIGINT) % 107 <> 0 AS has_content_id
FROM fc_raw"""

ISO = "'%Y-%m-%dT%H:%M:%S.%f'"

ORACLE["serialised_records"] = W(EV, FC_RAW) + f"""
SELECT city AS key, event_id, strftime(forecast_timestamp, {ISO}) AS forecast_timestamp,
       'event_id,event_type,source,city,latitude,longitude,issued_at,forecast_timestamp,temperature_2m_c,'
       || 'precipitation_probability_pct,wind_speed_10m_kmh,ingested_at' AS fields, false AS has_blanks
FROM fc_raw"""

ORACLE["city_config"] = """
SELECT r_name AS city, r_regionkey * 10.0::DOUBLE AS latitude, r_regionkey * 15.0::DOUBLE - 30.0 AS longitude,
       'Etc/GMT+' || r_regionkey AS timezone
FROM region"""

ORACLE["quarantine_stored"] = W(*BASE_F) + f"""
SELECT event_id, city, temperature_2m_c, {QUARANTINE_F} AS failed_rules, 'day' AS process_date, '2' AS batch
FROM fc_norm WHERE NOT {FC_OK} AND ingested_at >= {SPLIT_AT}"""

_COUNTS = f"""count(*) AS input_count, count(*) FILTER (WHERE {FC_OK}) AS valid_count,
  count(*) FILTER (WHERE NOT {FC_OK}) AS invalid_count,
  count(DISTINCT CASE WHEN {FC_OK} THEN event_id END) AS deduplicated_count,
  'forecast' AS event_type, 'day' AS process_date"""
ORACLE["metrics_stored"] = W(*BASE_F) + f"""
SELECT {_COUNTS}, '1' AS batch FROM fc_norm WHERE ingested_at < {SPLIT_AT} AND {FC_OK}
UNION ALL
SELECT {_COUNTS}, '2' AS batch FROM fc_norm WHERE ingested_at >= {SPLIT_AT}"""

ORACLE["dims_two_batches"] = W(*BASE_F, FC_VALID) + f"""
SELECT {SK('city')} AS city_key, city AS city_name,
       CAST(latitude AS DECIMAL(9,6)) AS latitude, CAST(longitude AS DECIMAL(9,6)) AS longitude,
       CASE WHEN city < 'B' THEN TIMESTAMP '2024-01-15 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS created_at
FROM fc_valid
QUALIFY row_number() OVER (PARTITION BY city ORDER BY ingested_at, latitude, longitude) = 1"""

ORACLE["gate_report"] = W(*BASE_F, FC_VALID, REDELIVERY, incoming("redelivery"), *SILVER_O, FACT_OBS) + f""",
n AS (
  SELECT (SELECT count(*) FROM (SELECT 1 FROM inc GROUP BY {FKEY} HAVING count(*) > 1)) AS f,
         (SELECT count(*) FROM (SELECT 1 FROM obs_inc GROUP BY source_key, city_key, observation_timestamp
                                HAVING count(*) > 1)) AS o)
SELECT gate, violations, violations = 0 AS passed FROM (
  SELECT 'one_current_row_per_key' AS gate, 0::BIGINT AS violations
  UNION ALL SELECT 'valid_intervals', 0
  UNION ALL SELECT 'one_observation_per_key', 0
  UNION ALL SELECT 'one_current_row_per_key, unmerged', f FROM n
  UNION ALL SELECT 'one_observation_per_key, unmerged', o FROM n)"""

STREAM_ROWS = f"""
recs AS (
  SELECT event_id, event_type, source, city, latitude, longitude, temperature_2m_c,
         wind_speed_10m_kmh, strftime(ingested_at, {ISO}) AS ingested_at,
         strftime(issued_at, {ISO}) AS issued_at,
         strftime(forecast_timestamp, {ISO}) AS forecast_timestamp,
         precipitation_probability_pct,
         CAST(NULL AS VARCHAR) AS observation_timestamp, CAST(NULL AS DOUBLE) AS precipitation_mm,
         ingested_at AS ts, city AS key, CAST(event_id AS BIGINT) AS n
  FROM fc_raw
  UNION ALL
  SELECT event_id, event_type, source, city, latitude, longitude, temperature_2m_c,
         wind_speed_10m_kmh, strftime(ingested_at, {ISO}), NULL, NULL, NULL,
         strftime(observation_timestamp, {ISO}), precipitation_mm, ingested_at, city, CAST(event_id AS BIGINT)
  FROM ob_raw)"""
LANDED = "n % 101 <> 0 AND n % 103 <> 0 AND n % 107 <> 0 AND n % 109 <> 0"

ORACLE["stream_bronze"] = W(EV, FC_RAW, OB_RAW, STREAM_ROWS) + f"""
SELECT event_id, source, city, latitude, longitude,
       CASE WHEN n % 113 <> 0 THEN temperature_2m_c END AS temperature_2m_c, wind_speed_10m_kmh,
       ingested_at, issued_at, forecast_timestamp, precipitation_probability_pct,
       observation_timestamp, precipitation_mm, event_type,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
FROM recs
WHERE {LANDED}"""

ORACLE["bronze_roundtrip"] = W(EV, FC_RAW, OB_RAW, STREAM_ROWS) + f"""
SELECT event_id, event_type, CASE WHEN n % 7 = 0 THEN 's1' END AS sensor,
       CASE WHEN n % 113 = 0 THEN 'mild' END AS temperature_word
FROM recs WHERE {LANDED}"""

ORACLE["bronze_scan_day"] = W(EV, FC_RAW, FC_NORM) + f""",
landed AS (SELECT *, CAST(event_id AS BIGINT) AS n FROM fc_norm)
SELECT event_id, event_type, source, city, latitude, longitude, issued_at, forecast_timestamp,
       CASE WHEN n % 113 <> 0 THEN temperature_2m_c END AS temperature_2m_c, precipitation_probability_pct,
       wind_speed_10m_kmh, ingested_at, forecast_date, n % 113 = 0 AS malformed
FROM landed
WHERE {LANDED} AND CAST(ingested_at AS DATE) = DATE '2024-01-15'"""

ORACLE["stream_dead_letter"] = W(EV, FC_RAW, OB_RAW, STREAM_ROWS) + f"""
SELECT event_id AS record_id, key,
       CASE WHEN n % 101 = 0 THEN 'bad_base64' WHEN n % 103 = 0 THEN 'bad_json'
            WHEN n % 107 = 0 THEN 'unsupported_event_type' ELSE 'bad_ingested_at' END AS error
FROM recs
WHERE NOT ({LANDED})"""

ORACLE["stream_scd2"] = ORACLE["scd2_apply_incremental"]
ORACLE["stream_upsert"] = ORACLE["observation_upsert"]
ORACLE["stream_dedup"] = ORACLE["silver_dedup"]
ORACLE["stream_dedup_late"] = ORACLE["silver_dedup"]
ORACLE["stream_dedup_state"] = ORACLE["stream_dedup_state_late"] = W(*BASE_F, FC_VALID) + """
SELECT DISTINCT event_id, event_type, source, city, latitude, longitude, issued_at, forecast_timestamp,
       temperature_2m_c, precipitation_probability_pct, wind_speed_10m_kmh, forecast_date FROM fc_valid"""

ORACLE["events_per_city"] = W(EV, FC_RAW, OB_RAW) + """
SELECT city, event_type, count(*) AS events FROM (
  SELECT city, event_type FROM fc_raw UNION ALL SELECT city, event_type FROM ob_raw)
GROUP BY city, event_type"""

ORACLE["gold_summary_report"] = ORACLE["gold_accuracy_summary"] + "\nLIMIT 200"


def _iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"


# SHA-256 of the compact JSON of the identity fields, keys sorted,
# NULLs kept. Number text agrees with Spark's for magnitudes in [1e-3, 1e7),
# which covers every measure in the test tables (D11: not in general).
_ID_F = (
    "sha256(CAST(to_json({'city': city, 'event_type': 'forecast', "
    f"'forecast_timestamp': {_iso('event_ts')}, 'issued_at': {_iso('issued_at')}, "
    "'precipitation_probability_pct': precipitation_probability_pct, 'source': source, "
    "'temperature_2m_c': temperature_2m_c, 'wind_speed_10m_kmh': wind_speed_10m_kmh}) AS VARCHAR))"
)
_ID_O = (
    "sha256(CAST(to_json({'city': city, 'event_type': 'observation', "
    f"'observation_timestamp': {_iso('event_ts')}, 'precipitation_mm': precipitation_mm, "
    "'source': source, 'temperature_2m_c': temperature_2m_c, "
    "'wind_speed_10m_kmh': wind_speed_10m_kmh}) AS VARCHAR))"
)

ORACLE["event_id"] = W(*BASE_F, PAYLOAD_POINTS) + f"""
SELECT 'forecast' AS event_type, source, city, ingested_at, latitude, longitude, issued_at,
       event_ts AS forecast_timestamp, temperature_2m_c, precipitation_probability_pct,
       wind_speed_10m_kmh, CAST(NULL AS TIMESTAMP) AS observation_timestamp,
       CAST(NULL AS DOUBLE) AS precipitation_mm, {_ID_F} AS event_id
FROM points WHERE event_ts >= issued_at
UNION ALL
SELECT 'observation', source, city, ingested_at, latitude, longitude, NULL, NULL,
       temperature_2m_c, NULL, wind_speed_10m_kmh, event_ts, precipitation_mm, {_ID_O}
FROM points WHERE NOT (event_ts >= issued_at)"""
