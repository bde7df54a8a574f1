"""DuckDB SQL for the same questions, written independently of the Spark code."""

from __future__ import annotations

from motorlytics.sources.fleet import MODEL_CLASSES, PASSENGER_MODELS
from motorlytics.sources.derived import DUCKDB, message_sql, telemetry_sql

OBD = ["rpm", "speed", "throttle_position", "coolant_temp", "battery_voltage", "maf", "fuel_level"]
GPS = ["latitude", "longitude"]
ROLLING = ["coolant_temp", "rpm", "battery_voltage", "maf", "throttle_position"]
CUTOFF = "TIMESTAMP '2024-01-01 03:36:00'"


def reasons(cls: str = "vehicle_class") -> str:
    c = f"coalesce({cls}, 'PASSENGER')"
    return f"""concat_ws('; ',
      CASE WHEN coalesce(rpm, 0) > CASE {c} WHEN 'PASSENGER' THEN 6500 ELSE 4200 END THEN 'Extreme RPM'
           WHEN coalesce(rpm, 0) < 500 AND coalesce(speed, 0) > 10 THEN 'Engine Stall Risk' END,
      CASE WHEN coalesce(coolant_temp, 90) > 115 THEN 'Overheating' END,
      CASE WHEN coalesce(battery_voltage, 14) < CASE {c} WHEN 'COMMERCIAL' THEN 22.0 ELSE 11.5 END
             THEN 'Low Voltage (Alternator Failure)'
           WHEN coalesce(battery_voltage, 14) > CASE {c} WHEN 'COMMERCIAL' THEN 30.0 ELSE 16.0 END
             THEN 'Over-voltage (Regulator Failure)' END,
      CASE WHEN coalesce(rpm, 0) > 2500 AND coalesce(maf, 0) < 2 THEN 'MAF Sensor Failure / Implausibility' END,
      CASE WHEN coalesce(throttle_position, 0) > 75 AND coalesce(speed, 0) < 5 AND coalesce(rpm, 0) > 2500
             THEN 'Transmission Slip / Stuck Throttle' END)"""


def flagged(source: str, name: str = "bronze") -> str:
    return f"""{name} AS (SELECT * EXCLUDE (fired), CAST(fired <> '' AS INTEGER) AS anomaly_flag,
      CASE fired WHEN '' THEN 'Normal' ELSE fired END AS anomaly_reason
    FROM (SELECT *, {reasons()} AS fired FROM {source}) f)"""


def silver(source: str, name: str = "silver", first: str = "NULL") -> str:
    means = ",\n".join(
        f"avg(CAST({c} AS DOUBLE)) OVER (v ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS rolling_avg_{c}" for c in ROLLING)
    return f"""{name} AS (
    SELECT * EXCLUDE (prev), CAST(sum(is_session_start) OVER (PARTITION BY vehicle_id ORDER BY timestamp, seq
          ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id
    FROM (SELECT *, CASE WHEN prev IS NULL OR epoch_us(timestamp) - epoch_us(prev) > 300000000 THEN 1 ELSE 0 END
            AS is_session_start
      FROM (SELECT *, {means},
          CAST(sum(anomaly_flag) OVER (v ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_anomaly_count,
          CAST(coolant_temp AS DOUBLE) - lag(CAST(coolant_temp AS DOUBLE), 1, {first}) OVER v AS coolant_temp_delta,
          lag(timestamp) OVER v AS prev
        FROM {source} WINDOW v AS (PARTITION BY vehicle_id ORDER BY timestamp, seq)) x) y)"""


METRICS = """metrics AS (
    SELECT vehicle_id, min(vehicle_model) AS vehicle_model, min(vehicle_class) AS vehicle_class,
      avg(CAST(coolant_temp AS DOUBLE)) AS avg_coolant_temp, CAST(max(coolant_temp) AS DOUBLE) AS max_coolant_temp,
      avg(CAST(battery_voltage AS DOUBLE)) AS avg_battery_voltage,
      CAST(min(battery_voltage) AS DOUBLE) AS min_battery_voltage,
      avg(CAST(rpm AS DOUBLE)) AS avg_rpm, avg(rolling_avg_maf) AS avg_maf,
      CAST(sum(anomaly_flag) AS BIGINT) AS total_anomaly_count, count(*) AS total_readings,
      avg(rolling_anomaly_count) AS avg_rolling_anomaly_count, max(coolant_temp_delta) AS max_coolant_temp_delta,
      count(DISTINCT session_id) AS total_sessions
    FROM silver GROUP BY ALL)"""

BREAKDOWN = """limits(vehicle_class, t_mean, t_peak, v_mean, v_slope) AS (
    VALUES ('PASSENGER', 108.0::DOUBLE, 115.0::DOUBLE, 13.2::DOUBLE, 80.0::DOUBLE),
           ('COMMERCIAL', 110.0::DOUBLE, 117.0::DOUBLE, 25.5::DOUBLE, 40.0::DOUBLE)),
  breakdown AS (
    SELECT *, round(greatest(0, least(100, 100 - anomaly_penalty - thermal_penalty - electrical_penalty
        - mechanical_penalty)), 2) AS health_score
    FROM (SELECT m.*, total_anomaly_count / total_readings AS anomaly_rate,
        least(40, pow(total_anomaly_count / total_readings, 1.2::DOUBLE) * 500) AS anomaly_penalty,
        CASE WHEN t_mean IS NULL THEN 0 ELSE least(25, pow(greatest(avg_coolant_temp - t_mean, 0), 1.8::DOUBLE) * 5
          + greatest(max_coolant_temp - t_peak, 0) * 10) END AS thermal_penalty,
        CASE WHEN v_mean IS NULL THEN 0 ELSE least(20, greatest(v_mean - avg_battery_voltage, 0) * v_slope) END
          AS electrical_penalty,
        CASE WHEN avg_rpm > 1000 THEN least(15, greatest(0.0015::DOUBLE - avg_maf / avg_rpm, 0) * 30000) ELSE 0 END
          AS mechanical_penalty
      FROM metrics m LEFT JOIN limits USING (vehicle_class)) p)"""

FEATURES = """features AS (
    SELECT vehicle_id, vehicle_class, avg_maf / (avg_rpm + 1) AS maf_rpm_ratio,
      avg_battery_voltage - min_battery_voltage AS volt_volatility, max_coolant_temp_delta, health_score,
      CASE WHEN health_score < 70 THEN 1 ELSE 0 END AS is_at_risk
    FROM breakdown)"""

PREDICTIONS = """predictions AS (
    SELECT *, 1 - 1 / (1 + volt_volatility) AS risk_probability,
      CASE WHEN 1 - 1 / (1 + volt_volatility) >= 0.5 THEN 1 ELSE 0 END AS risk_label
    FROM features)"""

_READINGS = f"telemetry AS ({telemetry_sql(DUCKDB)})"
_MESSAGES = f"{_READINGS}, messages AS ({message_sql(DUCKDB)})"


def with_(*parts: str) -> str:
    return "WITH " + ",\n  ".join(parts) + "\n"


_BRONZE = (_READINGS, flagged("telemetry"))
_SILVER = (*_BRONZE, silver("bronze"))
_GOLD = (*_SILVER, METRICS, BREAKDOWN)
_FEATURES = (*_GOLD, FEATURES)
_PREDICTIONS = (*_FEATURES, PREDICTIONS)


def _judged() -> str:
    def mistyped(path: str, name: str, allowed: str) -> str:
        return f"WHEN json_type(j, '$.{path}') NOT IN ({allowed}) THEN 'wrong_type:{name}'"

    tests = [mistyped(n, n, "'VARCHAR'") for n in ("timestamp", "vehicle_id", "vehicle_model", "vehicle_class")]
    tests += [mistyped(n, n, "'OBJECT'") for n in ("obd", "gps")]
    tests += [mistyped(f"{g}.{n}", f"{g}.{n}", "'UBIGINT', 'BIGINT', 'DOUBLE'")
              for g, names in (("obd", OBD), ("gps", GPS)) for n in names]
    texts = ", ".join(f"json_extract_string(j, '$.{n}') AS {n}" for n in ("vehicle_id", "vehicle_model", "vehicle_class"))
    numbers = ", ".join(f"CAST(json_extract_string(j, '$.{g}.{n}') AS DOUBLE) AS {n}"
                        for g, names in (("obd", OBD), ("gps", GPS)) for n in names)
    return f"""parsed AS (SELECT seq, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM messages),
  judged AS (SELECT seq, j, CASE WHEN j IS NULL THEN 'malformed_json'
      WHEN json_type(j) <> 'OBJECT' THEN 'not_an_object' {' '.join(tests)}
      WHEN json_type(j, '$.vehicle_id') IS NULL THEN 'missing_vehicle_id'
      WHEN json_type(j, '$.timestamp') IS NULL THEN 'missing_timestamp'
      WHEN TRY_CAST(replace(json_extract_string(j, '$.timestamp'), 'Z', '') AS TIMESTAMP) IS NULL
        THEN 'bad_timestamp' END AS reject_reason FROM parsed),
  good AS (SELECT seq, json_extract_string(j, '$.timestamp') AS time_text, {texts}, {numbers}
    FROM judged WHERE reject_reason IS NULL),
  typed AS (SELECT * EXCLUDE (time_text), CAST(replace(time_text, 'Z', '') AS TIMESTAMP) AS timestamp FROM good)"""


_DECODED = (_MESSAGES, _judged())
_IDS = "vehicle_id, vehicle_model, vehicle_class"
_NUMS = ", ".join(OBD + GPS)
_STORED = ("timestamp, vehicle_id, coalesce(vehicle_model, 'Unknown') AS vehicle_model, "
           "coalesce(vehicle_class, 'Unknown') AS vehicle_class, "
           + ", ".join(f"CAST(CAST({n} AS FLOAT) AS DOUBLE) AS {n}" for n in OBD) + ", latitude, longitude, "
           "anomaly_flag, anomaly_reason")
_DOUBLES = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in OBD)


def rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_FEATURE_COLUMNS = (rounded(*[f"rolling_avg_{c}" for c in ROLLING], "coolant_temp_delta")
                    + ", rolling_anomaly_count, is_session_start, session_id")
_SILVER_OUT = f"seq, timestamp, {_IDS}, {_DOUBLES}, latitude, longitude, anomaly_flag, anomaly_reason, {_FEATURE_COLUMNS}"
_METRIC_OUT = ("vehicle_id, vehicle_model, vehicle_class, max_coolant_temp, min_battery_voltage, "
    + rounded("avg_coolant_temp", "avg_battery_voltage", "avg_rpm") + ", total_anomaly_count, total_readings, "
    + rounded("avg_rolling_anomaly_count", "max_coolant_temp_delta") + ", total_sessions")
_AS_OF = "(SELECT max(timestamp) FROM silver)"
_PENALTIES = ("anomaly_penalty", "thermal_penalty", "electrical_penalty", "mechanical_penalty")
_SPLIT = """split AS (SELECT *, rn <= ceil(n * CAST(0.2 AS DOUBLE)) AS is_test FROM (SELECT *,
      row_number() OVER (PARTITION BY is_at_risk ORDER BY md5(concat('42-', vehicle_id)), vehicle_id) AS rn,
      count(*) OVER (PARTITION BY is_at_risk) AS n FROM features) r)"""

# Boosted trees, fitted here as well: 100 trees of depth 5 over bins between quantiles of the training side.
_BINNED = """known AS (SELECT *, [coalesce(maf_rpm_ratio, 0), coalesce(volt_volatility, 0), coalesce(max_coolant_temp_delta, 0),
      CASE vehicle_class WHEN 'COMMERCIAL' THEN 0 WHEN 'PASSENGER' THEN 1 ELSE 2 END] AS x FROM split),
  cuts AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS c FROM (SELECT DISTINCT f, v FROM (
      SELECT f, x[f] AS v, row_number() OVER (PARTITION BY f ORDER BY x[f]) AS rn, count(*) OVER (PARTITION BY f) AS n
      FROM known, range(1, 5) r(f) WHERE NOT is_test) s JOIN range(1, 32) q(k) ON rn = ceil(k * n / 32.0)) d),
  weights AS (SELECT CASE WHEN sum(is_at_risk) > 0 THEN count(*) FILTER (is_at_risk = 0) / sum(is_at_risk) ELSE 1 END AS scale
    FROM known WHERE NOT is_test),
  binned AS (SELECT vehicle_id, is_at_risk AS y, is_test, CASE WHEN is_at_risk = 1 THEN (SELECT scale FROM weights) ELSE 1 END AS w,
      list_transform(range(1, 5), lambda f: len(list_filter(lists[f], lambda v: v < x[f]))) AS b
    FROM known, (SELECT list(l ORDER BY f) AS lists FROM (SELECT f, list(v) AS l FROM cuts GROUP BY f) e) a)"""


def _boosted(trees: int = 100, depth: int = 5) -> str:
    levels = []
    for n in range(depth):
        levels.append(f"""s{n} AS (SELECT node, f, c, gain FROM (
        SELECT node, f, c, round(0.5 * (gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1)), 9) AS gain
        FROM (SELECT node, f, c, sum(g) FILTER (b[f] <= c) AS gl, sum(h) FILTER (b[f] <= c) AS hl,
                     sum(g) FILTER (b[f] > c) AS gr, sum(h) FILTER (b[f] > c) AS hr
              FROM r{n}, cuts WHERE level = {n} AND NOT is_test GROUP BY node, f, c) t WHERE hl >= 1 AND hr >= 1) u
      WHERE gain > 0.000001 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, c) = 1),
    r{n + 1} AS (SELECT r.* REPLACE (CASE WHEN f IS NULL THEN r.node ELSE 2 * r.node + 1 + CAST(b[f] > c AS INTEGER) END AS node,
        CASE WHEN f IS NULL THEN level ELSE level + 1 END AS level) FROM r{n} r LEFT JOIN s{n} USING (node))""")
    splits = " UNION ALL ".join(f"SELECT node, f, gain FROM s{n}" for n in range(depth))
    return f"""fit AS (SELECT 0 AS tree, vehicle_id, CAST(0 AS DOUBLE) AS margin, CAST([] AS STRUCT(node BIGINT, f BIGINT, gain DOUBLE)[]) AS splits
      FROM binned
    UNION ALL (WITH r0 AS (SELECT tree, vehicle_id, margin, is_test, b, 0 AS node, 0 AS level, w * (p - y) AS g, w * p * (1 - p) AS h
        FROM (SELECT *, 1 / (1 + exp(-margin)) AS p FROM fit JOIN binned USING (vehicle_id) WHERE tree < {trees}) p),
    {", ".join(levels)},
    leaves AS (SELECT node, -0.1 * sum(g) / (sum(h) + 1) AS step FROM r{depth} WHERE NOT is_test GROUP BY node),
    picked AS (SELECT list({{'node': node, 'f': f, 'gain': gain}}) AS splits FROM ({splits}) s)
    SELECT tree + 1, vehicle_id, margin + step, coalesce(picked.splits, []) FROM r{depth} JOIN leaves USING (node), picked))"""


_FLEET = """predictions AS (SELECT s.*, p AS risk_probability, CAST(p > 0.5 AS INTEGER) AS risk_label FROM split s JOIN (
      SELECT vehicle_id, 1 / (1 + exp(-margin)) AS p FROM fit WHERE tree = 100) f USING (vehicle_id))"""
_GAINS = """tree_splits AS (SELECT tree - 1 AS tree, unnest(splits, recursive := true) FROM (
      SELECT tree, any_value(splits) AS splits FROM fit WHERE tree > 0 GROUP BY tree) t)"""


def _fitted(*parts: str) -> str:
    return with_(*_FEATURES, _SPLIT, _BINNED, _boosted(), _FLEET, _GAINS, *parts).replace("WITH", "WITH RECURSIVE", 1)


_LIMITS = {
    "rpm": ("0", "CASE vehicle_class WHEN 'COMMERCIAL' THEN 4000 ELSE 6500 END"),
    "speed": ("0", "CASE vehicle_class WHEN 'COMMERCIAL' THEN 100 ELSE 180 END"),
    "throttle_position": ("0", "100"),
    "coolant_temp": ("40", "140"),
    "battery_voltage": ("CASE vehicle_class WHEN 'PASSENGER' THEN 10.5 ELSE 21.0 END", None),
    "maf": ("0", None),
    "fuel_level": ("0", "100"),
}


def _clip() -> tuple[str, str]:
    outs, moved = [], []
    for name, (low, high) in _LIMITS.items():
        x = f"CAST({name} AS DOUBLE)"
        y = f"greatest({x}, {low})" + ("" if high is None else "")
        y = y if high is None else f"least({y}, {high})"
        outs.append(f"round({y}, 4) AS {name}")
        moved.append(f"CAST({y} <> {x} AS INTEGER)")
    return ", ".join(outs), " + ".join(moved)


_CLIPPED, _MOVED = _clip()

_REPORT = """, pairs AS (SELECT is_at_risk AS y, risk_label AS p, count(*) AS n FROM predictions GROUP BY ALL),
  per AS (SELECT v.label, (SELECT coalesce(sum(n), 0) FROM pairs WHERE y = label AND p = label) AS hit,
      (SELECT coalesce(sum(n), 0) FROM pairs WHERE p = label) AS said,
      (SELECT coalesce(sum(n), 0) FROM pairs WHERE y = label) AS support FROM (VALUES (0), (1)) v(label)),
  scores AS (SELECT CAST(label AS VARCHAR) AS label, coalesce(hit / nullif(said, 0), 0) AS precision,
      coalesce(hit / nullif(support, 0), 0) AS recall, coalesce(2 * hit / nullif(said + support, 0), 0) AS f1,
      support, hit FROM per),
  report AS (SELECT label, precision, recall, f1, support FROM scores
    UNION ALL SELECT 'accuracy', NULL, NULL, sum(hit) / sum(support), sum(support) FROM scores
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support) FROM scores)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM report"""

_TRIPS = """SELECT vehicle_id, session_id, min(timestamp) AS started_at, max(timestamp) AS ended_at,
  count(*) AS readings, CAST(sum(anomaly_flag) AS BIGINT) AS anomalies FROM silver GROUP BY vehicle_id, session_id"""

# Windows a stream with a 10 minute watermark has closed once everything has arrived. The watermark is
# the newest event time minus the delay.
_WATERMARK = "(SELECT max(timestamp) - INTERVAL 10 MINUTE FROM bronze)"
_BUCKET = "time_bucket(INTERVAL 10 SECOND, timestamp)"

SQL: dict[str, str] = {
    "decode_json": with_(*_DECODED) + f"SELECT seq, time_text AS timestamp, {_IDS}, {_NUMS} FROM good",
    "quarantine_counts": with_(*_DECODED) + """SELECT reject_reason, count(*) AS messages FROM judged
        WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    "quarantine_messages": with_(*_DECODED) + """SELECT seq, reject_reason FROM judged WHERE reject_reason IS NOT NULL""",
    "flatten": with_(*_DECODED) + f"SELECT seq, time_text AS timestamp, {_IDS}, {_NUMS} FROM good",
    "parse_types": with_(*_DECODED) + f"SELECT seq, timestamp, {_IDS}, {_NUMS} FROM typed",
    "bronze_projection": with_(*_DECODED, flagged("typed")) + f"SELECT {_STORED} FROM bronze",
    "bronze": with_(*_DECODED, flagged("typed")) + f"SELECT seq, {_STORED} FROM bronze",
    "encode_json": with_(_READINGS) + f"SELECT vehicle_id AS key, timestamp, {_IDS}, {_DOUBLES}, latitude, longitude FROM telemetry",
    "detect_anomalies": with_(*_BRONZE) + "SELECT seq, vehicle_id, timestamp, anomaly_flag, anomaly_reason FROM bronze",
    "enrich_fleet": with_(_READINGS) + f"""SELECT seq, vehicle_id, vehicle_model, fleet_class,
        CAST(CASE fleet_class WHEN 'COMMERCIAL' THEN 650 ELSE 850 END AS DOUBLE) AS idle_rpm,
        CAST(CASE fleet_class WHEN 'COMMERCIAL' THEN 4000 ELSE 6500 END AS DOUBLE) AS max_rpm,
        CAST(CASE fleet_class WHEN 'COMMERCIAL' THEN 100 ELSE 180 END AS DOUBLE) AS max_speed,
        CAST(CASE fleet_class WHEN 'COMMERCIAL' THEN 92 ELSE 90 END AS DOUBLE) AS avg_temp,
        CAST(CASE fleet_class WHEN 'COMMERCIAL' THEN 26.5 ELSE 14.2 END AS DOUBLE) AS volt_baseline,
        CAST(CASE fleet_class WHEN 'COMMERCIAL' THEN 0.25 ELSE 0.15 END AS DOUBLE) AS maf_mult
        FROM (SELECT *, CASE WHEN nth BETWEEN {len(PASSENGER_MODELS)} AND {len(MODEL_CLASSES) - 1} THEN 'COMMERCIAL' ELSE 'PASSENGER' END AS fleet_class
          FROM (SELECT seq, vehicle_id, seq % {len(MODEL_CLASSES) + 1} AS nth,
            [{", ".join(repr(m) for m in (*MODEL_CLASSES, "Unlisted"))}][1 + seq % {len(MODEL_CLASSES) + 1}] AS vehicle_model FROM telemetry) m) t""",
    "enrich_fleet_models": with_(_READINGS) + """SELECT seq, vehicle_id, vehicle_model, fleet_class,
        CAST(CASE fleet_class WHEN 'COMMERCIAL' THEN 4000 ELSE 6500 END AS DOUBLE) AS max_rpm,
        CAST(CASE fleet_class WHEN 'COMMERCIAL' THEN 26.5 ELSE 14.2 END AS DOUBLE) AS volt_baseline
        FROM (SELECT *, CASE WHEN CAST(right(vehicle_model, 2) AS INTEGER) BETWEEN 20 AND 25 THEN 'COMMERCIAL'
              ELSE 'PASSENGER' END AS fleet_class FROM telemetry) t""",
    "clip_readings": with_(_READINGS) + f"SELECT seq, vehicle_id, timestamp, {_CLIPPED}, {_MOVED} AS out_of_bounds FROM telemetry",
    "dedupe_readings": with_(_READINGS) + """SELECT vehicle_id, timestamp, seq, CAST(rpm AS DOUBLE) AS rpm FROM (SELECT *,
        row_number() OVER (PARTITION BY vehicle_id, timestamp ORDER BY seq DESC) AS nth
        FROM (SELECT * REPLACE (date_trunc('minute', timestamp) AS timestamp) FROM telemetry) c) d WHERE nth = 1""",
    "rolling_means": with_(*_SILVER) + "SELECT seq, vehicle_id, " + rounded(*[f"rolling_avg_{c}" for c in ROLLING]) + " FROM silver",
    "rolling_anomaly_count": with_(*_SILVER) + "SELECT seq, vehicle_id, rolling_anomaly_count FROM silver",
    "coolant_delta": with_(*_SILVER) + "SELECT seq, vehicle_id, round(coolant_temp_delta, 6) AS coolant_temp_delta FROM silver",
    "coolant_delta_zero_base": with_(*_BRONZE, silver("bronze", first="0")) + """SELECT seq, vehicle_id,
        round(coolant_temp_delta, 6) AS coolant_temp_delta FROM silver""",
    "sessionize": with_(*_SILVER) + "SELECT seq, vehicle_id, timestamp, is_session_start, session_id FROM silver",
    "silver_telemetry": with_(*_SILVER) + f"SELECT {_SILVER_OUT} FROM silver",
    "silver_telemetry_in_runs": with_(*_SILVER) + f"SELECT {_SILVER_OUT} FROM silver",
    "silver_counted": with_(*_SILVER) + f"SELECT {_SILVER_OUT} FROM silver",
    "silver_incremental_slice": with_(
        *_BRONZE,
        f"slice AS (SELECT * FROM bronze WHERE timestamp > (SELECT max(timestamp) FROM bronze WHERE timestamp <= {CUTOFF}))",
        silver("slice"),
    ) + f"SELECT {_SILVER_OUT} FROM silver",
    "silver_incremental_continuous": with_(*_SILVER) + f"SELECT {_SILVER_OUT} FROM silver",
    "silver_late_arrivals": with_(*_SILVER) + f"SELECT {_SILVER_OUT} FROM silver",
    "silver_stream": with_(*_SILVER) + f"SELECT {_SILVER_OUT} FROM silver",
    "silver_upsert": with_(
        *_SILVER,
        f"fresh AS (SELECT * REPLACE ('Reviewed' AS anomaly_reason) FROM silver WHERE timestamp > {CUTOFF} - INTERVAL 1 HOUR)",
        f"stored AS (SELECT * FROM silver WHERE timestamp <= {CUTOFF})",
    ) + """SELECT seq, vehicle_id, timestamp, anomaly_reason, session_id FROM (SELECT s.* FROM stored s WHERE NOT EXISTS
        (SELECT 1 FROM fresh f WHERE f.vehicle_id = s.vehicle_id AND f.timestamp = s.timestamp)
        UNION ALL SELECT * FROM fresh) u""",
    "silver_upsert_days": with_(
        *_SILVER,
        f"fresh AS (SELECT * REPLACE ('Reviewed' AS anomaly_reason) FROM silver WHERE timestamp > {CUTOFF} - INTERVAL 1 HOUR)",
        f"stored AS (SELECT * FROM silver WHERE timestamp <= {CUTOFF})",
    ) + """SELECT seq, vehicle_id, timestamp, anomaly_reason, session_id FROM (SELECT s.* FROM stored s WHERE NOT EXISTS
        (SELECT 1 FROM fresh f WHERE f.vehicle_id = s.vehicle_id AND f.timestamp = s.timestamp)
        UNION ALL SELECT * FROM fresh) u""",
    "trips": with_(*_SILVER) + _TRIPS,
    "trips_session_window": with_(*_SILVER) + f"SELECT * EXCLUDE (session_id) FROM ({_TRIPS}) t",
    "trips_in_slices": with_(*_BRONZE, "hot AS (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 'V-HOT' ELSE vehicle_id END AS vehicle_id) FROM bronze)",
        silver("hot")) + f"SELECT * EXCLUDE (session_id) FROM ({_TRIPS}) t",
    "fleet_by_sketches": with_(*_SILVER, "newest AS (SELECT CAST(max(timestamp) AS DATE) AS d FROM silver)") + """
        SELECT 'all' AS span, count(DISTINCT vehicle_id) AS vehicles, count(*) AS readings, true AS sessions_within_error FROM silver
        UNION ALL SELECT 'last two days', count(DISTINCT vehicle_id), count(*), NULL FROM silver, newest
        WHERE CAST(timestamp AS DATE) BETWEEN d - 1 AND d""",
    "vehicle_metrics": with_(*_SILVER, METRICS) + f"SELECT {_METRIC_OUT}, round(avg_maf, 6) AS avg_maf FROM metrics",
    "health_breakdown": with_(*_GOLD) + f"SELECT vehicle_id, {rounded('anomaly_rate', *_PENALTIES)}, health_score FROM breakdown",
    "gold_vehicle_health": with_(*_GOLD) + f"SELECT {_METRIC_OUT}, round(anomaly_rate, 6) AS anomaly_rate, health_score FROM breakdown",
    "gold_stream": with_(*_GOLD) + f"SELECT {_METRIC_OUT}, round(anomaly_rate, 6) AS anomaly_rate, health_score FROM breakdown",
    "gold_from_messages": with_(*_DECODED, flagged("typed", "checked"), "bronze AS (SELECT seq, "
        + _STORED.replace("CAST(CAST(", "CAST(").replace(" AS FLOAT) AS DOUBLE)", " AS FLOAT)") + " FROM checked)",
        silver("bronze"), METRICS, BREAKDOWN)
        + f"SELECT {_METRIC_OUT}, round(anomaly_rate, 6) AS anomaly_rate, health_score FROM breakdown",
    "vehicle_features": with_(*_FEATURES) + "SELECT vehicle_id, vehicle_class, "
        + rounded("maf_rpm_ratio", "volt_volatility", "max_coolant_temp_delta") + ", health_score, is_at_risk FROM features",
    "at_risk_label": with_(*_FEATURES) + "SELECT vehicle_id, health_score, is_at_risk FROM features",
    "encode_class": with_(*_FEATURES) + """SELECT vehicle_id, vehicle_class,
        dense_rank() OVER (ORDER BY vehicle_class) - 1 AS vehicle_class_code FROM features""",
    "encode_class_known": with_(*_FEATURES) + """SELECT vehicle_id, vehicle_class, CAST(CASE vehicle_class WHEN 'COMMERCIAL' THEN 0
        WHEN 'PASSENGER' THEN 1 ELSE 2 END AS BIGINT) AS vehicle_class_code FROM features""",
    "risk_predictions": _fitted() + f"""SELECT vehicle_id, round(risk_probability, 6) AS risk_probability, risk_label,
        {CUTOFF} AS predicted_at FROM predictions""",
    "risk_tree_gains": _fitted() + """SELECT tree, count(f) AS splits, round(coalesce(sum(gain), 0), 6) AS gain, max(last) AS last_node
        FROM (SELECT tree, f, gain, 2 * node + 2 AS last FROM tree_splits UNION ALL SELECT r - 1, NULL, NULL, 0 FROM range(1, 101) t(r)) u
        GROUP BY tree""",
    "feature_importance": _fitted() + """SELECT feature, count(gain) AS splits, round(coalesce(sum(gain) / (SELECT sum(gain) FROM tree_splits), 0), 6) AS value
        FROM (VALUES (1, 'maf_rpm_ratio'), (2, 'volt_volatility'), (3, 'max_coolant_temp_delta'), (4, 'vehicle_class')) n(f, feature)
        LEFT JOIN tree_splits USING (f) GROUP BY feature""",
    "model_quality": (_fitted().replace("predictions AS (", "everyone AS (", 1) [:-1]
                      + ", predictions AS (SELECT * FROM everyone WHERE is_test)" + _REPORT),
    "model_auc": _fitted() + """SELECT round(sum(CASE WHEN p.s > n.s THEN 1.0 WHEN p.s = n.s THEN 0.5 ELSE 0 END) / count(*), 6) AS auc_roc
        FROM (SELECT round(risk_probability, 9) AS s FROM predictions WHERE is_test AND is_at_risk = 1) p,
             (SELECT round(risk_probability, 9) AS s FROM predictions WHERE is_test AND is_at_risk = 0) n""",
    "stored_predictions": _fitted() + f"""SELECT vehicle_id, round(risk_probability, 6) AS risk_probability, risk_label,
        {CUTOFF} AS predicted_at, true AS in_range, true AS label_agrees FROM predictions""",
    "kpis_on_predictions": _fitted() + """SELECT CASE risk_label WHEN 1 THEN 'At-Risk' ELSE 'Healthy' END AS label, count(*) AS vehicles
        FROM predictions GROUP BY ALL UNION ALL SELECT 'count', count(*) FILTER (risk_label = 1) FROM predictions""",
    "worst_vehicles_on_predictions": _fitted() + """SELECT vehicle_id, b.vehicle_model, b.vehicle_class, b.health_score,
        round(p.risk_probability, 6) AS risk_probability
        FROM breakdown b LEFT JOIN predictions p USING (vehicle_id) ORDER BY b.health_score, vehicle_id LIMIT 20""",
    "feature_importance_total": with_(*_FEATURES) + """SELECT CAST(4 AS BIGINT) AS features, CAST(1 AS DOUBLE) AS total
        FROM features LIMIT 1""",
    "model_quality_supports": with_(*_FEATURES, _SPLIT) + """SELECT l AS label, count(*) FILTER (
          l NOT IN ('0', '1') OR CAST(is_at_risk AS VARCHAR) = l) AS support
        FROM split, unnest(['0', '1', 'accuracy', 'macro avg', 'weighted avg']) u(l) WHERE is_test GROUP BY l""",
    "gold_zero_base": with_(*_BRONZE, silver("bronze", first="0"), METRICS, BREAKDOWN)
        + f"SELECT {_METRIC_OUT}, round(anomaly_rate, 6) AS anomaly_rate, health_score FROM breakdown",
    "stratified_split": with_(*_FEATURES, _SPLIT) + "SELECT vehicle_id, is_at_risk, is_test FROM split",
    "class_balance": with_(*_FEATURES, _SPLIT) + """SELECT count(*) FILTER (is_at_risk = 0) AS negatives,
        count(*) FILTER (is_at_risk = 1) AS positives,
        round(CASE WHEN count(*) FILTER (is_at_risk = 1) > 0
              THEN count(*) FILTER (is_at_risk = 0) / count(*) FILTER (is_at_risk = 1) ELSE 1 END, 6) AS scale_pos_weight
        FROM split WHERE NOT is_test""",
    "classification_report": with_(*_PREDICTIONS) [:-1] + _REPORT,
    "auc_roc": with_(*_PREDICTIONS) + """SELECT round(sum(CASE WHEN p.s > n.s THEN 1.0 WHEN p.s = n.s THEN 0.5 ELSE 0 END * p.c * n.c)
          / (sum(p.c * n.c)), 6) AS auc_roc
        FROM (SELECT risk_probability AS s, count(*) AS c FROM predictions WHERE is_at_risk = 1 AND risk_probability IS NOT NULL GROUP BY ALL) p,
             (SELECT risk_probability AS s, count(*) AS c FROM predictions WHERE is_at_risk = 0 AND risk_probability IS NOT NULL GROUP BY ALL) n""",
    "kpi_total_vehicles": with_(*_GOLD) + "SELECT count(DISTINCT vehicle_id) AS total_vehicles FROM breakdown",
    "kpi_anomaly_rate_live": with_(*_SILVER) + f"""SELECT round(avg(anomaly_flag) * 100, 6) AS anomaly_rate_pct FROM silver
        WHERE timestamp > {_AS_OF} - INTERVAL 5 MINUTE""",
    "kpi_at_risk_count": with_(*_FEATURES) + "SELECT count(*) AS at_risk_vehicles FROM features WHERE is_at_risk = 1",
    "kpi_status": with_(*_FEATURES) + f"""SELECT kpi, subject, round(value, 6) AS value, status FROM (
        SELECT 'anomaly_rate' AS kpi, 'fleet' AS subject, value, CASE WHEN value >= 5 THEN 'red' ELSE 'green' END AS status
        FROM (SELECT avg(anomaly_flag) * 100 AS value FROM silver WHERE timestamp > {_AS_OF} - INTERVAL 5 MINUTE) a
        UNION ALL SELECT 'at_risk_vehicles', 'fleet', value, CASE WHEN value >= 1 THEN 'red' ELSE 'green' END
        FROM (SELECT CAST(count(*) AS DOUBLE) AS value FROM features WHERE is_at_risk = 1) b
        UNION ALL SELECT 'health_score', vehicle_id, health_score, CASE WHEN health_score < 50 THEN 'red'
          WHEN health_score < 80 THEN 'orange' ELSE 'green' END FROM features) k""",
    "health_distribution": with_(*_GOLD) + """SELECT CASE WHEN health_score < 50 THEN 'Poor' WHEN health_score < 75 THEN 'Fair'
        WHEN health_score < 90 THEN 'Good' ELSE 'Excellent' END AS health_grade, count(*) AS vehicles
        FROM breakdown GROUP BY ALL""",
    "risk_distribution": with_(*_FEATURES) + """SELECT CASE is_at_risk WHEN 1 THEN 'At-Risk' ELSE 'Healthy' END AS label,
        count(*) AS vehicles FROM features GROUP BY ALL""",
    "anomaly_timeseries_10s": with_(*_SILVER) + f"""SELECT {_BUCKET} AS time, CAST(sum(anomaly_flag) AS BIGINT) AS anomalies
        FROM silver WHERE timestamp > {_AS_OF} - INTERVAL 1 HOUR GROUP BY ALL""",
    "worst_vehicles": with_(*_PREDICTIONS) + """SELECT vehicle_id, b.vehicle_model, b.vehicle_class, b.health_score,
        round(b.anomaly_rate, 6) AS anomaly_rate, round(p.risk_probability, 6) AS risk_probability
        FROM breakdown b LEFT JOIN predictions p USING (vehicle_id) ORDER BY b.health_score, vehicle_id LIMIT 20""",
    "avg_health_by_model": with_(*_GOLD) + """SELECT vehicle_model, round(avg(health_score), 6) AS avg_health
        FROM breakdown GROUP BY ALL""",
    "stream_bronze": with_(*_DECODED, flagged("typed")) + f"SELECT seq, {_STORED} FROM bronze",
    "stream_bronze_table": with_(*_DECODED, flagged("typed")) + f"SELECT seq, {_STORED} FROM bronze",
    "stream_bronze_interleaved": with_(*_DECODED, flagged("typed")) + f"""SELECT vehicle_id, date_trunc('hour', timestamp) AS hour,
        count(*) AS readings, CAST(sum(anomaly_flag) AS BIGINT) AS anomalies, max(seq) AS last_seq
        FROM (SELECT seq, {_STORED} FROM bronze) GROUP BY 1, 2""",
    "stream_quarantine": with_(*_DECODED) + """SELECT seq, reject_reason FROM judged WHERE reject_reason IS NOT NULL""",
    "stream_anomaly_series": with_(*_BRONZE) + f"""SELECT * FROM (
        SELECT {_BUCKET} AS time, CAST(sum(anomaly_flag) AS BIGINT) AS anomalies FROM bronze GROUP BY 1) w
        WHERE time + INTERVAL 10 SECOND <= {_WATERMARK}""",
    "stream_trips": with_(*_SILVER) + f"""SELECT * EXCLUDE (session_id) FROM ({_TRIPS}) t
        WHERE ended_at + INTERVAL 300 SECOND <= {_WATERMARK}""",
    "stream_anomaly_rate": with_(*_BRONZE) + f"""SELECT * FROM (
        SELECT {_BUCKET} + to_seconds(10 * k) AS as_of, round(avg(anomaly_flag) * 100, 6) AS anomaly_rate_pct
        FROM bronze, range(1, 31) r(k) GROUP BY 1) w WHERE as_of <= {_WATERMARK}""",
    "stream_dedupe": with_(_READINGS) + "SELECT DISTINCT vehicle_id, timestamp FROM telemetry",
    "stream_dedupe_hot_key": with_(_READINGS) + "SELECT DISTINCT vehicle_id, timestamp FROM telemetry",
}
