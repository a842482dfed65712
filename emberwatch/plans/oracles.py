"""The same queries as SQL over the given tables, to check results against."""

from emberwatch import constants as K
from emberwatch.plans.registry import NOW, STALE
from emberwatch.schemas import PREDICTION_COLUMNS

_NOW = f"TIMESTAMP '{NOW}'"
_ZONES = ", ".join(f"({index}, '{zone}', '{label}')" for index, (zone, label) in enumerate(K.ZONES.items()))
_COLUMNS = ", ".join(f'"{name}"' for name in PREDICTION_COLUMNS)
_TEXT = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _case(column, texts, otherwise):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in texts.items()) + f" ELSE {otherwise} END"


def _by_class(a, b, c):
    return f"CASE WHEN id % 83 = 0 THEN NULL WHEN prediction = 0 THEN {a}::DOUBLE WHEN prediction = 1 THEN {b}::DOUBLE ELSE {c}::DOUBLE END"


def _status(value):
    text = f"translate(upper(trim({value})), '- ', '__')"
    names = {status: ", ".join(f"'{x}'" for x in words) for status, words in K.WEB_STATUS_SYNONYMS.items()}
    return "CASE " + " ".join(f"WHEN {text} IN ({words}) THEN '{status}'" for status, words in names.items()) + " ELSE 'UNKNOWN' END"


def _words(fire, risk, normal):
    return f"CASE prediction WHEN 2 THEN '{fire}' WHEN 1 THEN '{risk}' ELSE '{normal}' END"


def _aged(source):
    return f"""
    SELECT * REPLACE (CASE WHEN prediction_label IN ('NORMAL', 'FIRE_RISK', 'FIRE') THEN prediction_label ELSE 'UNKNOWN' END AS prediction_label,
                      CAST(prediction AS DOUBLE) AS prediction),
           coalesce(created_at, "timestamp") AS data_time,
           date_diff('microsecond', coalesce(created_at, "timestamp"), {_NOW}) / 1e6 AS age_seconds,
           coalesce(date_diff('microsecond', coalesce(created_at, "timestamp"), {_NOW}) / 1e6 BETWEEN -60 AND {STALE}, FALSE) AS is_fresh
    FROM {source}"""


_MODULO = "id % {0} = 0"

_CTES = {
    "z": f"SELECT * FROM (VALUES {_ZONES}) AS t(zone_idx, zone, zone_label)",
    "readings": """
    SELECT e.event_id AS id, coalesce('S' || lpad(CAST(((e.user_id % 50) + 50) % 50 + 1 AS VARCHAR), 3, '0'), 'UNKNOWN') AS sensor_id,
           coalesce(z.zone, 'UNKNOWN') AS zone, e.ts AS "timestamp",
           CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE CAST(24 + e.event_id % 13 AS DOUBLE) + e.value / 8 END AS temperature,
           CASE WHEN e.value > 400 THEN CAST(20 AS DOUBLE) ELSE CAST(70 AS DOUBLE) - e.value / 8 END AS humidity,
           e.value * 2 AS smoke_ppm,
           CAST(50 + (e.event_id * 31) % 130 AS DOUBLE) + e.value * 3 AS lpg_gas_ppm,
           CAST(5 + e.event_id % 20 AS DOUBLE) + e.value / 2 AS co_gas_ppm
    FROM events e LEFT JOIN z ON z.zone_idx = ((e.user_id % 10) + 10) % 10""",
    "scored": """
    SELECT *, CASE WHEN temperature > 65.0 OR smoke_ppm > 400.0 THEN 2 WHEN temperature > 50.0 OR smoke_ppm > 200.0 THEN 1 ELSE 0 END AS prediction
    FROM readings""",
    "predictions": f"""
    SELECT *, CASE WHEN id % 89 = 0 THEN NULL WHEN prediction = 2 THEN 'FIRE' WHEN prediction = 1 THEN 'FIRE_RISK' ELSE 'NORMAL' END AS prediction_label,
           {_by_class(0.875, 0.125, 0)} AS probability_normal,
           {_by_class(0.125, 0.75, 0.25)} AS probability_risk,
           {_by_class(0, 0.125, 0.75)} AS probability_fire,
           CASE WHEN id % 101 = 0 THEN NULL ELSE "timestamp" + INTERVAL 5 SECOND END AS created_at
    FROM scored""",
    "latest": """
    SELECT p.* FROM predictions p JOIN (SELECT sensor_id, MAX(id) AS max_id FROM predictions GROUP BY sensor_id) m ON p.id = m.max_id""",
    "history": "SELECT * FROM predictions ORDER BY id DESC LIMIT 500",
    "board": _aged("latest"),
    "recent": _aged("history"),
    "raw": f"""
    SELECT id, sensor_id, prediction,
           CASE WHEN id % 59 = 0 THEN NULL ELSE zone END AS zone,
           CASE WHEN id % 61 = 0 THEN 'not a time' ELSE {_TEXT.format('"timestamp"')} END AS time_text,
           CASE WHEN id % 67 = 0 THEN 'n/a' ELSE CAST(temperature AS VARCHAR) END AS temperature,
           CASE WHEN id % 71 = 0 THEN 'NaN' ELSE CAST(humidity AS VARCHAR) END AS humidity,
           smoke_ppm, lpg_gas_ppm, co_gas_ppm,
           CASE WHEN id % 7 = 0 THEN lower(prediction_label) WHEN id % 11 = 0 THEN ' ' || prediction_label
                WHEN id % 13 = 0 THEN 'Fire-Risk' ELSE prediction_label END AS label_text,
           CASE WHEN id % 73 = 0 THEN 'none' ELSE CAST(probability_normal AS VARCHAR) END AS probability_normal,
           CASE WHEN id % 79 = 0 THEN '50' ELSE CAST(probability_risk AS VARCHAR) END AS probability_risk,
           CASE WHEN id % 79 = 0 THEN '-0.5' ELSE CAST(probability_fire AS VARCHAR) END AS probability_fire,
           CASE WHEN id % 103 = 0 THEN '' ELSE {_TEXT.format('created_at')} END AS created_text
    FROM predictions""",
    "api": f"""
    SELECT CAST(p.id AS VARCHAR) AS id, p.id AS number,
           CASE WHEN p.id % 997 = 0 THEN NULL ELSE sensor_id END AS sensor_id,
           CASE WHEN p.id % 3 = 0 THEN p.zone END AS zone,
           CASE WHEN p.id % 3 = 1 THEN z.zone_label END AS area,
           CASE WHEN p.id % 6 = 2 THEN p.zone WHEN p.id % 12 = 5 THEN 'Khu_Moi' END AS location,
           CASE WHEN p.id % 4 = 0 THEN {_words("fire alert", " Fire-Risk ", "safe")} WHEN p.id % 107 = 0 THEN '' END AS status,
           CASE WHEN p.id % 4 = 1 THEN CAST(prediction AS VARCHAR) END AS prediction_text,
           CASE WHEN p.id % 4 = 2 THEN {_words("CHÁY", "CẢNH-BÁO", "AN TOÀN")} END AS predicted_class,
           CASE WHEN p.id % 8 = 3 THEN prediction_label END AS result,
           CASE WHEN p.id % 8 = 7 THEN {_words("danger_fire", "warn", "2.0")} END AS label,
           CASE WHEN p.id % 71 = 0 THEN 1.5 ELSE probability_normal END AS p_normal,
           CASE WHEN p.id % 73 = 0 THEN NULL ELSE probability_risk END AS p_risk,
           probability_fire AS p_fire,
           CASE WHEN p.id % 103 = 0 THEN '' ELSE {_TEXT.format('created_at')} END AS created_text,
           CASE WHEN p.id % 109 = 0 THEN 'soon' ELSE {_TEXT.format('"timestamp"')} END AS time_text, temperature
    FROM predictions p JOIN z ON z.zone = p.zone""",
    "named": f"""
    SELECT a.*, coalesce(a.sensor_id, a.id, 'UNKNOWN') AS sensor,
           coalesce(a.zone, a.area, a.location, 'Chưa xác định') AS raw_zone,
           {_status("coalesce(a.status, a.prediction_text, a.predicted_class, a.result, a.label)")} AS web_status,
           TRY_CAST(nullif(coalesce(a.created_text, a.time_text), '') AS TIMESTAMP) AS record_time,
           greatest(0.0, least(100.0, p_normal * 100)) AS probability_normal,
           CASE WHEN p_risk IS NOT NULL THEN greatest(0.0, least(100.0, p_risk * 100)) END AS probability_risk,
           CASE WHEN p_fire IS NOT NULL THEN greatest(0.0, least(100.0, p_fire * 100)) END AS probability_fire
    FROM api a""",
    "records": f"""
    SELECT n.* REPLACE (CASE WHEN p_normal IS NOT NULL THEN probability_normal END AS probability_normal),
           coalesce(z.zone_label, replace(n.raw_zone, '_', ' ')) AS zone_name,
           coalesce(record_time, TIMESTAMP '1970-01-01 00:00:00') AS order_time,
           CASE WHEN record_time IS NULL THEN 'UNKNOWN'
                WHEN date_diff('microsecond', record_time, {_NOW}) / 1e6 BETWEEN -60 AND {STALE} THEN 'ONLINE' ELSE 'OFFLINE' END AS connection
    FROM named n LEFT JOIN z ON z.zone = n.raw_zone""",
    "sensors": """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY order_time DESC, number DESC) AS rn FROM records) WHERE rn = 1""",
    "abnormal": """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY sensor_id, zone ORDER BY "timestamp" DESC, id DESC) AS rn
      FROM predictions WHERE prediction IN (1, 2)) WHERE rn = 1""",
    "groups": """
    SELECT *, CASE prediction WHEN 2 THEN 'FIRE' ELSE 'FIRE_RISK' END AS severity, CASE prediction WHEN 2 THEN 0 ELSE 1 END AS severity_rank FROM abnormal""",
    "indexed": """
    SELECT *, row_number() OVER (PARTITION BY severity_rank ORDER BY md5(sensor_id || '|' || zone), sensor_id, zone) AS alert_number,
           count(*) OVER (PARTITION BY severity_rank) AS sensors FROM groups""",
    "labelled": """
    SELECT *, prediction AS label, CAST((prediction + CASE WHEN id % 10 = 0 THEN 1 ELSE 0 END) % 3 AS DOUBLE) AS guess FROM predictions""",
    "confusion": "SELECT label, guess AS prediction, count(*) AS count FROM labelled GROUP BY label, guess",
    "trend": """
    SELECT "timestamp", avg(temperature) AS temperature, avg(smoke_ppm) AS smoke FROM history GROUP BY "timestamp" """,
    "load": """
    SELECT 'S' || CAST(event_id % 50 AS VARCHAR) AS sensor_id, 'Xuong_San_Xuat' AS zone, '2026-10-17 11:00:00' AS "timestamp",
           CAST(30 + event_id % 40 AS DOUBLE) AS temperature, CAST(60 AS DOUBLE) AS humidity, CAST(50 + event_id % 500 AS DOUBLE) AS smoke_ppm,
           CAST(100 AS DOUBLE) AS lpg_gas_ppm, CAST(10 AS DOUBLE) AS co_gas_ppm FROM events""",
    "parsed": f"""
    SELECT sensor_id, zone, {_TEXT.format('"timestamp"')} AS "timestamp", temperature, humidity, smoke_ppm, lpg_gas_ppm, co_gas_ppm
    FROM readings WHERE id % 113 <> 0
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM readings WHERE id % 113 = 0""",
}

_NEEDS = {
    "readings": ["z"], "scored": ["readings"], "predictions": ["scored"], "latest": ["predictions"],
    "history": ["predictions"], "board": ["latest"], "recent": ["history"], "raw": ["predictions"],
    "api": ["predictions", "z"], "named": ["api"], "records": ["named", "z"], "sensors": ["records"],
    "abnormal": ["predictions"], "groups": ["abnormal"], "indexed": ["groups"], "labelled": ["predictions"],
    "confusion": ["labelled"], "trend": ["history"], "parsed": ["readings"],
}


def _with(body, *names):
    """``body`` with the named common tables and those they rest on, in order of definition."""
    wanted, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += _NEEDS.get(name, [])
    tables = ", ".join(f"{name} AS ({text})" for name, text in _CTES.items() if name in wanted)
    return f"WITH {tables} {body}"


def _measure(column, unit=" ppm"):
    return f"CASE WHEN {column} IS NULL THEN 'N/A' ELSE printf('%g', {column}) || '{unit}' END"


def _probability(number):
    return f"coalesce(printf('%.1f', CASE WHEN {number} BETWEEN 0 AND 1 THEN {number} * 100 ELSE {number} END) || '%', 'N/A')"


def _number(text):
    return f"CASE WHEN NOT isnan(TRY_CAST({text} AS DOUBLE)) THEN TRY_CAST({text} AS DOUBLE) END"


def _fixed(column, digits):
    return f"coalesce(printf('%.{digits}f', {column}), '{K.NO_MEASURE_TEXT}')"


def _label(text):
    return f"CASE WHEN upper({text}) IN ('NORMAL', 'FIRE_RISK', 'FIRE') THEN upper({text}) ELSE 'UNKNOWN' END"


def _missing(text):
    return f"({text} IS NULL OR lower(trim({text})) IN ('', 'none', 'null', 'nan'))"


_FRESH = f"CASE WHEN is_fresh THEN '{K.FRESH_TEXT}' ELSE '{K.STALE_TEXT}' END"
_ZONE_NAME = _case("zone", K.ZONES, "zone")
_STATUS = _case("prediction_label", K.STATUS_TEXT, "prediction_label")
_INCIDENT = _case("prediction_label", K.INCIDENT_TEXT, "prediction_label")
_SENSOR_TEXT = f"""
  'Sensor: ' || sensor_id || chr(10) || 'Khu vực: ' || zone || chr(10) || 'Thời gian: ' || {_TEXT.format('"timestamp"')} || chr(10) ||
  'Nhiệt độ: ' || {_measure("temperature", " °C")} || chr(10) || 'Khói: ' || {_measure("smoke_ppm")} || chr(10) ||
  'LPG: ' || {_measure("lpg_gas_ppm")} || chr(10) || 'CO: ' || {_measure("co_gas_ppm")} || chr(10) ||
  'Trạng thái: ' || coalesce(prediction_label, CASE prediction WHEN 2 THEN 'FIRE' WHEN 1 THEN 'FIRE_RISK' ELSE 'NORMAL' END) || chr(10) ||
  'Xác suất FIRE: ' || {_probability("probability_fire")} || chr(10) || 'Xác suất FIRE_RISK: ' || {_probability("probability_risk")}"""
_HEADER = f"""
  {_case("severity", K.ALERT_TITLE, "NULL")} || chr(10) || chr(10) || 'Phát hiện ' || CAST(sensors AS VARCHAR) || ' sensor có trạng thái ' || severity || '.' ||
  chr(10) || {_case("severity", K.ALERT_ADVICE, "NULL")} || chr(10)"""
_ALERT = 'sensor_id, zone, "timestamp", temperature, smoke_ppm, lpg_gas_ppm, co_gas_ppm, CAST(prediction AS DOUBLE) AS prediction, prediction_label'
_BOARD_COUNTS = """
  count(DISTINCT sensor_id) AS total_sensors, count(DISTINCT CASE WHEN is_fresh THEN sensor_id END) AS fresh_sensors,
  count(DISTINCT CASE WHEN NOT is_fresh THEN sensor_id END) AS stale_sensors"""
_BOARD_CLASSES = ", ".join(
    f"count(*) FILTER (WHERE is_fresh AND prediction_label = '{label}') AS {name}_count"
    for name, label in [("unknown", "UNKNOWN"), ("normal", "NORMAL"), ("risk", "FIRE_RISK"), ("fire", "FIRE")]
)
_OVERVIEW = """
  SELECT count(*) AS seen, count(*) FILTER (WHERE web_status = 'NORMAL' AND connection = 'ONLINE') AS normal,
         count(*) FILTER (WHERE web_status = 'RISK') AS risk, count(*) FILTER (WHERE web_status = 'FIRE') AS fire,
         count(*) FILTER (WHERE connection = 'ONLINE') AS online, count(*) FILTER (WHERE connection = 'OFFLINE') AS offline,
         count(*) FILTER (WHERE web_status = 'UNKNOWN') AS unknown_status, count(*) FILTER (WHERE connection = 'UNKNOWN') AS unknown_connection,
         greatest(0, 50 - count(*)) AS missing,
         count(*) FILTER (WHERE web_status = 'UNKNOWN') + count(*) FILTER (WHERE connection = 'UNKNOWN') AS unknown
  FROM sensors"""


def _headed(headings, values):
    return ", ".join(f'{value} AS "{heading}"' for heading, value in zip(headings, values, strict=True))


def _percent_rounded(column):
    return f"round_even({column} * 100 * 10, 0) / 10"


_INCIDENTS = "SELECT " + _headed(
    K.INCIDENT_HEADINGS,
    ["id", "sensor_id", _ZONE_NAME, _TEXT.format('"timestamp"'), "temperature", "smoke_ppm", "lpg_gas_ppm", "co_gas_ppm",
     _percent_rounded("probability_risk"), _percent_rounded("probability_fire"), _INCIDENT],
) + " FROM recent WHERE prediction_label IN ('FIRE', 'FIRE_RISK')"
_EXPLORED = "SELECT " + _headed(
    K.EXPLORER_HEADINGS,
    ["id", "sensor_id", _ZONE_NAME, _TEXT.format('"timestamp"'), f"coalesce({_TEXT.format('created_at')}, '{K.NO_TIME_TEXT}')", _FRESH,
     "temperature", "humidity", "smoke_ppm", "lpg_gas_ppm", "co_gas_ppm", _STATUS],
) + " FROM recent"
_READING = 'sensor_id, zone, "timestamp", temperature, humidity, smoke_ppm, lpg_gas_ppm, co_gas_ppm'
_READING_NAMES = [name.strip('" ') for name in _READING.split(",")]
_COMPLETE = " AND ".join(f'"{name}" IS NOT NULL' for name in _READING_NAMES)

ORACLES = {
    "read_predictions": _with(f"SELECT {_COLUMNS} FROM predictions", "predictions"),
    "load_frame": _with("SELECT * FROM load", "load"),
    "parse_json": _with("SELECT * FROM parsed", "parsed"),
    "validate_readings": _with(f"SELECT * FROM parsed WHERE {_COMPLETE}", "parsed"),
    "reading_quality": _with(
        f"SELECT count(*) AS readings, count(*) FILTER (WHERE {_COMPLETE}) AS complete, count(*) FILTER (WHERE NOT ({_COMPLETE})) AS rejected, "
        + ", ".join(f'count(*) FILTER (WHERE "{name}" IS NULL) AS missing_{name}' for name in _READING_NAMES) + " FROM parsed", "parsed"),
    "prediction_codes": _with(
        "SELECT id, prediction AS code, CASE prediction WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'FIRE_RISK' WHEN 2 THEN 'FIRE' ELSE 'UNKNOWN' END AS label FROM predictions",
        "predictions"),
    "prediction_table_projection": _with(
        f"SELECT {_READING}, prediction, prediction_label, probability_normal, probability_risk, probability_fire FROM predictions", "predictions"),
    "rename_display": _with('SELECT id AS "ID", sensor_id AS "Mã Sensor", zone AS "Khu Vực" FROM predictions', "predictions"),
    "alert_projection_fire": _with(f"SELECT {_ALERT}, probability_fire, probability_risk FROM abnormal WHERE prediction = 2", "abnormal"),
    "alert_projection_risk": _with(f"SELECT {_ALERT}, probability_risk, probability_fire FROM abnormal WHERE prediction = 1", "abnormal"),
    "abnormal_codes": _with("SELECT id, prediction FROM predictions WHERE prediction IN (1, 2)", "predictions"),
    "abnormal_labels": _with("SELECT id, prediction_label FROM predictions WHERE prediction_label IN ('FIRE', 'FIRE_RISK')", "predictions"),
    "by_class": _with("SELECT id, sensor_id, prediction FROM predictions WHERE prediction = 2", "predictions"),
    "add_freshness": _with(f"SELECT id, data_time, age_seconds, is_fresh FROM ({_aged('predictions')})", "predictions"),
    "fresh_split": _with("SELECT id, sensor_id, CASE WHEN is_fresh THEN 'fresh' ELSE 'stale' END AS part FROM board", "board"),
    "connection_state": _with("SELECT id, connection FROM records", "records"),
    "drop_missing_metric": _with('SELECT id, temperature FROM predictions WHERE temperature IS NOT NULL AND "timestamp" IS NOT NULL', "predictions"),
    "history_filter": _with(
        "SELECT id, sensor_id, zone, prediction_label FROM predictions WHERE prediction_label = 'FIRE_RISK' AND zone = 'Kho_Hoa_Chat'", "predictions"),
    "explorer_filter": _with(
        "SELECT id, sensor_id, zone, prediction_label FROM predictions WHERE zone = 'Phong_May' AND prediction_label = 'NORMAL' AND regexp_matches(sensor_id, 's0[0-2]', 'i')",
        "predictions"),
    "web_filter": _with(
        "SELECT id, sensor, zone_name, web_status AS status FROM records WHERE (contains(lower(sensor), 'khu') OR contains(lower(zone_name), 'khu')) AND web_status = 'NORMAL'",
        "records"),
    "web_filter_zone": _with(
        "SELECT id, sensor, zone_name, web_status AS status FROM records WHERE (contains(lower(sensor), 's01') OR contains(lower(zone_name), 's01')) AND zone_name = 'Kho Hóa Chất'",
        "records"),
    "zone_match": _with("SELECT z.zone AS zone_key, s.id, s.sensor FROM sensors s JOIN z ON s.raw_zone = z.zone OR s.zone_name = z.zone_label", "sensors", "z"),
    "latest_by_max_id": _with(f"SELECT {_COLUMNS} FROM latest", "latest"),
    "latest_by_max_id_pruned": _with(f"SELECT {_COLUMNS} FROM latest", "latest"),
    "latest_by_max_id_join": _with(f"SELECT {_COLUMNS} FROM latest", "latest"),
    "zone_board": _with(
        """SELECT z.zone_idx, z.zone, z.zone_label,
             count(DISTINCT CASE WHEN b.is_fresh THEN b.sensor_id END) AS total_sensors,
             count(*) FILTER (WHERE b.is_fresh AND b.prediction_label = 'FIRE') AS fire_sensors,
             count(*) FILTER (WHERE b.is_fresh AND b.prediction_label = 'FIRE_RISK') AS risk_sensors,
             coalesce(round(avg(CASE WHEN b.is_fresh THEN b.temperature END), 9), CASE WHEN count(CASE WHEN b.is_fresh THEN 1 END) = 0 THEN 0.0 END) AS avg_temp,
             coalesce(round(avg(CASE WHEN b.is_fresh THEN b.smoke_ppm END), 9), CASE WHEN count(CASE WHEN b.is_fresh THEN 1 END) = 0 THEN 0.0 END) AS avg_smoke,
             CASE WHEN count(b.id) = 0 THEN 'NO_DATA' WHEN count(DISTINCT CASE WHEN b.is_fresh THEN b.sensor_id END) = 0 THEN 'STALE'
                  WHEN count(*) FILTER (WHERE b.is_fresh AND b.prediction_label = 'FIRE') > 0 THEN 'FIRE'
                  WHEN count(*) FILTER (WHERE b.is_fresh AND b.prediction_label = 'FIRE_RISK') > 0 THEN 'FIRE_RISK' ELSE 'OK' END AS status
           FROM z LEFT JOIN board b ON b.zone = z.zone GROUP BY z.zone_idx, z.zone, z.zone_label""", "board", "z"),
    "web_zone_summary": _with(
        """SELECT key, label, sensors, online, risk, fire, round(CASE WHEN sensors > 0 THEN online / sensors * 100 ELSE 0.0 END, 9) AS online_percent,
             CASE WHEN fire > 0 THEN 'fire' WHEN risk > 0 THEN 'risk' ELSE 'ok' END AS severity
           FROM (SELECT z.zone AS key, z.zone_label AS label, count(s.id) AS sensors, count(*) FILTER (WHERE s.connection = 'ONLINE') AS online,
                   count(*) FILTER (WHERE s.web_status = 'RISK') AS risk, count(*) FILTER (WHERE s.web_status = 'FIRE') AS fire
                 FROM z LEFT JOIN sensors s ON s.raw_zone = z.zone OR s.zone_name = z.zone_label GROUP BY z.zone, z.zone_label)""", "sensors", "z"),
    "zone_display": _with("SELECT p.id, coalesce(z.zone_label, p.zone) AS zone_label FROM predictions p LEFT JOIN z ON z.zone = p.zone", "predictions", "z"),
    "zone_display_join": _with("SELECT p.id, coalesce(z.zone_label, p.zone) AS zone_label FROM predictions p LEFT JOIN z ON z.zone = p.zone", "predictions", "z"),
    "class_distribution": _with("SELECT label, count(*) AS count FROM labelled GROUP BY label", "labelled"),
    "confusion_matrix": _with("SELECT * FROM confusion", "confusion"),
    "class_errors": _with("SELECT * FROM confusion WHERE label <> prediction", "confusion"),
    "max_id_per_sensor": _with("SELECT sensor_id, max(id) AS max_id FROM predictions GROUP BY sensor_id", "predictions"),
    "sensor_counts": _with(f"SELECT {_BOARD_COUNTS} FROM board", "board"),
    "status_kpis": _with(
        f"""SELECT *, {", ".join(f"CASE WHEN fresh_sensors > 0 THEN round({n}_count / fresh_sensors * 100, 9) ELSE 0.0 END AS pct_{n}" for n in ("normal", "risk", "fire"))}
            FROM (SELECT count(DISTINCT CASE WHEN is_fresh THEN sensor_id END) AS fresh_sensors, {_BOARD_CLASSES} FROM board)""", "board"),
    "zone_stats": _with(
        """SELECT zone, count(DISTINCT sensor_id) AS total_sensors, count(*) FILTER (WHERE prediction_label = 'FIRE') AS fire_sensors,
             count(*) FILTER (WHERE prediction_label = 'FIRE_RISK') AS risk_sensors, round(avg(temperature), 9) AS avg_temp, round(avg(smoke_ppm), 9) AS avg_smoke
           FROM board WHERE is_fresh GROUP BY zone""", "board"),
    "metric_trend": _with(
        """SELECT "timestamp", round(avg(temperature), 9) AS value FROM (
             SELECT "timestamp", temperature FROM recent WHERE temperature IS NOT NULL ORDER BY "timestamp" DESC, id DESC LIMIT 200)
           GROUP BY "timestamp" ORDER BY "timestamp" DESC LIMIT 100""", "recent"),
    "trend_reference": _with(
        """SELECT arg_max(value, "timestamp") AS current, round(avg(value), 9) AS average, max(value) AS peak FROM (
             SELECT "timestamp", avg(smoke_ppm) AS value FROM (SELECT "timestamp", smoke_ppm FROM recent ORDER BY "timestamp" DESC, id DESC LIMIT 200)
             GROUP BY "timestamp" ORDER BY "timestamp" DESC LIMIT 100)""", "recent"),
    "alert_totals": _with(
        """SELECT (SELECT count(*) FROM board WHERE prediction_label IN ('FIRE', 'FIRE_RISK')) AS active_alerts,
             count(*) FILTER (WHERE prediction_label IN ('FIRE', 'FIRE_RISK')) AS history_events,
             count(*) FILTER (WHERE prediction_label = 'FIRE') AS fire_events, count(*) FILTER (WHERE prediction_label = 'FIRE_RISK') AS risk_events
           FROM recent""", "board", "recent"),
    "web_overview": _with(_OVERVIEW, "sensors"),
    "status_breakdown": _with(
        " UNION ALL ".join(
            f"SELECT {place} AS position, '{text}' AS label, CAST({name} AS BIGINT) AS value, round(least(100.0, {name} / 50 * 100), 9) AS percent FROM ({_OVERVIEW})"
            for place, (name, text) in enumerate(K.BREAKDOWN_GROUPS)), "sensors"),
    "mean_probabilities": _with(
        """SELECT round(avg(probability_normal), 9) AS probability_normal, round(avg(probability_risk), 9) AS probability_risk,
             round(avg(probability_fire), 9) AS probability_fire FROM sensors WHERE connection = 'ONLINE'""", "sensors"),
    "row_counts": """SELECT 'all' AS frame, count(*) AS rows FROM events UNION ALL SELECT 'train', count(*) FROM events WHERE event_id % 5 <> 0
                     UNION ALL SELECT 'test', count(*) FROM events WHERE event_id % 5 = 0""",
    "multiclass_metrics": _with(
        """SELECT round(sum(hits) / sum(actual), 9) AS accuracy,
             round(sum(actual * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(actual), 9) AS f1,
             round(sum(actual * p) / sum(actual), 9) AS precision, round(sum(actual * r) / sum(actual), 9) AS recall
           FROM (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS p, CASE WHEN actual > 0 THEN hits / actual ELSE 0 END AS r
                 FROM (SELECT k.k, (SELECT coalesce(sum(count), 0)::DOUBLE FROM confusion WHERE label = k.k) AS actual,
                         (SELECT coalesce(sum(count), 0)::DOUBLE FROM confusion WHERE prediction = k.k) AS predicted,
                         (SELECT coalesce(sum(count), 0)::DOUBLE FROM confusion WHERE label = k.k AND prediction = k.k) AS hits
                       FROM (VALUES (0), (1), (2)) AS k(k)))""", "confusion"),
    "distinct_zones": _with("SELECT DISTINCT zone_name FROM sensors", "sensors"),
    "web_alert_totals": _with(
        """SELECT count(*) FILTER (WHERE web_status IN ('RISK', 'FIRE')) AS alerts, count(*) FILTER (WHERE web_status = 'RISK') AS risk,
             count(*) FILTER (WHERE web_status = 'FIRE') AS fire FROM sensors""", "sensors"),
    "web_history_totals": _with("SELECT count(*) AS records, count(DISTINCT sensor) AS sensors, least(count(*), 500) AS shown FROM records", "records"),
    "latest_abnormal": _with(f"SELECT {_COLUMNS} FROM abnormal", "abnormal"),
    "latest_by_time": _with("SELECT id, sensor, web_status AS status, connection, record_time FROM sensors", "sensors"),
    "numbered_history": _with(
        """SELECT row_number() OVER (ORDER BY order_time DESC, number DESC) AS number, id, sensor, record_time
           FROM (SELECT * FROM records ORDER BY order_time DESC, number DESC LIMIT 500)""", "records"),
    "alert_index": _with("SELECT severity_rank, severity, sensors, alert_number, sensor_id, zone, id FROM indexed", "indexed"),
    "recent_history": _with(f"SELECT {_COLUMNS} FROM history", "history"),
    "recent_history_pruned": _with(f"SELECT {_COLUMNS} FROM history", "history"),
    "active_alerts": _with(
        """SELECT id, sensor_id, prediction_label, is_fresh, CASE prediction_label WHEN 'FIRE' THEN 0 ELSE 1 END AS status_priority
           FROM board WHERE prediction_label IN ('FIRE', 'FIRE_RISK')""", "board"),
    "tail_by_time": _with(
        'SELECT id, "timestamp", temperature FROM predictions WHERE temperature IS NOT NULL ORDER BY "timestamp" DESC, id DESC LIMIT 200', "predictions"),
    "alert_history": _with("SELECT id, sensor_id, prediction_label FROM recent WHERE prediction_label IN ('FIRE', 'FIRE_RISK')", "recent"),
    "current_status_table": _with(f"SELECT {_COLUMNS}, is_fresh FROM board", "board"),
    "explorer_page": _with(f"SELECT {_COLUMNS} FROM predictions ORDER BY id DESC LIMIT 100", "predictions"),
    "latest_record": _with(f"SELECT {_COLUMNS} FROM predictions ORDER BY id DESC LIMIT 1", "predictions"),
    "history_by_time": _with(
        "SELECT id, sensor, zone_name, web_status AS status, record_time FROM records ORDER BY order_time DESC, number DESC LIMIT 500", "records"),
    "top_alerts": _with(
        "SELECT id, sensor, web_status AS status FROM sensors WHERE web_status IN ('RISK', 'FIRE') ORDER BY order_time DESC, number DESC LIMIT 5", "sensors"),
    "web_alert_list": _with(
        "SELECT id, sensor, zone_name, web_status AS status, temperature, record_time FROM sensors WHERE web_status IN ('RISK', 'FIRE')", "sensors"),
    "compact_list": _with(
        "SELECT id, sensor, zone_name, web_status AS status, connection FROM sensors ORDER BY order_time DESC, number DESC LIMIT 6", "sensors"),
    "pick_identity": _with("SELECT id, sensor, raw_zone, zone_name FROM records", "records"),
    "normalise_label": _with(f"SELECT id, {_label('label_text')} AS label FROM raw", "raw"),
    "status_alias": _with("SELECT id, web_status AS status FROM records", "records"),
    "resolve_status": _with(
        """SELECT id, CASE WHEN upper(trim(label_text)) IN ('NORMAL', 'FIRE_RISK', 'FIRE') THEN upper(trim(label_text))
             ELSE CASE prediction WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'FIRE_RISK' WHEN 2 THEN 'FIRE' ELSE 'UNKNOWN' END END AS status FROM raw""", "raw"),
    "is_missing": _with(
        f"""SELECT id, {_missing("zone")} AS zone_missing, {_missing("temperature")} AS temperature_missing, {_missing("humidity")} AS humidity_missing,
              {_missing("probability_normal")} AS probability_normal_missing, {_missing("created_text")} AS created_at_missing FROM raw""", "raw"),
    "display_measure": _with(
        f"SELECT id, {_measure('temperature')} AS temperature, {_measure('smoke_ppm')} AS smoke_ppm, {_measure('co_gas_ppm')} AS co_gas_ppm FROM predictions", "predictions"),
    "display_measure_text": _with(
        "SELECT id, " + ", ".join(
            f"CASE WHEN {_missing(n)} THEN 'N/A' WHEN TRY_CAST({n} AS DOUBLE) IS NULL THEN {n} || ' %' ELSE printf('%g', TRY_CAST({n} AS DOUBLE)) || ' %' END AS {n}"
            for n in ("temperature", "humidity")) + " FROM raw", "raw"),
    "fixed_measure": _with(
        f"SELECT id, {_fixed('temperature', 1)} AS one, {_fixed('temperature', 0)} AS none, {_fixed('co_gas_ppm', 2)} AS two FROM predictions", "predictions"),
    "display_probability": _with(
        "SELECT id, " + ", ".join(f"{_probability(_number(n))} AS {n}" for n in ("probability_normal", "probability_risk", "probability_fire")) + " FROM raw", "raw"),
    "display_texts": _with(
        f"""SELECT id, {_STATUS} AS status, {_INCIDENT} AS incident, {_case(_status("prediction_label"), K.WEB_STATUS_TEXT, "NULL")} AS web_status, {_FRESH} AS freshness
            FROM ({_aged('predictions')})""", "predictions"),
    "parse_times": _with(
        """SELECT id, TRY_CAST(time_text AS TIMESTAMP) AS sensor_time, TRY_CAST(created_text AS TIMESTAMP) AS store_time,
             coalesce(TRY_CAST(created_text AS TIMESTAMP), TRY_CAST(time_text AS TIMESTAMP)) AS data_time FROM raw""", "raw"),
    "data_time_web": _with("SELECT id, record_time FROM records", "records"),
    "format_time": _with(f"SELECT id, coalesce({_TEXT.format('created_at')}, '{K.NO_TIME_TEXT}') AS stored FROM predictions", "predictions"),
    "to_number": _with(
        "SELECT id, " + ", ".join(f"{_number(n)} AS {n}" for n in ("temperature", "humidity", "probability_normal", "probability_fire"))
        + f", coalesce({_number('humidity')}, -1.0) AS humidity_or FROM raw", "raw"),
    "percent_clamped": _with(
        "SELECT id, " + ", ".join(
            f"CASE WHEN {_number(n)} IS NOT NULL THEN greatest(0.0, least(100.0, {_number(n)} * 100)) END AS {n}"
            for n in ("probability_normal", "probability_risk", "probability_fire")) + " FROM raw", "raw"),
    "percent_rounded": _with(f"SELECT id, {_percent_rounded('probability_risk')} AS risk, {_percent_rounded('(smoke_ppm / 7)')} AS smoke FROM predictions", "predictions"),
    "renormalise_probabilities": _with(
        f"""SELECT id, {", ".join(f"CASE WHEN n >= 0 AND r >= 0 AND f >= 0 AND n + r + f > 0 THEN round({a} / (n + r + f) * 100, 9) END AS {b}"
                for a, b in (("n", "probability_normal"), ("r", "probability_risk"), ("f", "probability_fire")))}
            FROM (SELECT id, {_number("probability_normal")} AS n, {_number("probability_risk")} AS r, {_number("probability_fire")} AS f FROM raw)""", "raw"),
    "threshold_classify": _with(
        """SELECT sensor_id, CASE WHEN temperature > 65.0 OR smoke_ppm > 400.0 THEN 'FIRE' WHEN temperature > 50.0 OR smoke_ppm > 200.0 THEN 'FIRE_RISK' ELSE 'NORMAL' END AS label,
             count(*) AS rows FROM load GROUP BY 1, 2""", "load"),
    "plant_banner": _with(
        f"""SELECT *, CASE WHEN fire_count > 0 THEN 'FIRE' WHEN risk_count > 0 THEN 'FIRE_RISK'
              WHEN fresh_sensors = 0 OR stale_sensors > 0 OR unknown_count > 0 THEN 'INSUFFICIENT' ELSE 'OK' END AS banner
            FROM (SELECT {_BOARD_COUNTS}, {_BOARD_CLASSES.replace("count(*) FILTER (WHERE is_fresh AND prediction_label = 'NORMAL') AS normal_count, ", "")} FROM board)""", "board"),
    "prepare_predictions": _with(
        f"""SELECT id, sensor_id, coalesce(zone, 'UNKNOWN') AS zone, TRY_CAST(time_text AS TIMESTAMP) AS "timestamp", {_number("temperature")} AS temperature,
              {_number("humidity")} AS humidity, smoke_ppm, lpg_gas_ppm, co_gas_ppm, CAST(prediction AS DOUBLE) AS prediction, {_label("label_text")} AS prediction_label,
              {_number("probability_normal")} AS probability_normal, {_number("probability_risk")} AS probability_risk, {_number("probability_fire")} AS probability_fire,
              TRY_CAST(created_text AS TIMESTAMP) AS created_at FROM raw""", "raw"),
    "current_board": _with(
        "SELECT " + _headed(K.BOARD_HEADINGS, [
            "sensor_id", _ZONE_NAME, f"coalesce({_TEXT.format('data_time')}, '{K.NO_TIME_TEXT}')", _FRESH,
            "temperature", "humidity", "smoke_ppm", "lpg_gas_ppm", "co_gas_ppm", _STATUS]) + " FROM board", "board"),
    "active_alert_cards": _with(
        f"""SELECT {_case("prediction_label", K.ALERT_CARD_TEXT, "NULL")} AS alert_type, {_TEXT.format("data_time")} AS time,
              CASE WHEN is_fresh THEN '{K.CARD_FRESH_TEXT}' ELSE '{K.CARD_STALE_TEXT}' END AS freshness, sensor_id, {_ZONE_NAME} AS zone_name,
              {_fixed("temperature", 1)} AS temperature, {_fixed("smoke_ppm", 0)} AS smoke_ppm, {_fixed("lpg_gas_ppm", 0)} AS lpg_gas_ppm, {_fixed("co_gas_ppm", 0)} AS co_gas_ppm
            FROM board WHERE prediction_label IN ('FIRE', 'FIRE_RISK')
            ORDER BY CASE prediction_label WHEN 'FIRE' THEN 0 ELSE 1 END, is_fresh DESC, id DESC LIMIT 4""", "board"),
    "incident_log": _with(_INCIDENTS, "recent"),
    "incident_log_filtered": _with(_INCIDENTS + " AND prediction_label = 'FIRE_RISK' AND zone = 'Khu_Kiem_Tra'", "recent"),
    "sensor_explorer": _with(_EXPLORED + " WHERE regexp_matches(sensor_id, 'S0', 'i') ORDER BY id DESC LIMIT 100", "recent"),
    "sensor_explorer_filtered": _with(
        _EXPLORED + " WHERE zone = 'Phong_May' AND prediction_label = 'NORMAL' AND regexp_matches(sensor_id, 's0[0-4]', 'i') ORDER BY id DESC LIMIT 100", "recent"),
    "latest_probabilities": _with(
        f"""SELECT id, sensor_id, {_ZONE_NAME} AS zone_name, coalesce(prediction_label, 'UNKNOWN') AS prediction_label,
              probability_normal / (probability_normal + probability_risk + probability_fire) * 100 AS pct_normal,
              probability_risk / (probability_normal + probability_risk + probability_fire) * 100 AS pct_risk,
              probability_fire / (probability_normal + probability_risk + probability_fire) * 100 AS pct_fire
            FROM predictions ORDER BY id DESC LIMIT 1""", "predictions"),
    "online_probability_table": _with(
        "SELECT sensor, zone_name, probability_normal, probability_risk, probability_fire, web_status AS status FROM sensors WHERE connection = 'ONLINE'", "sensors"),
    "alert_groups": _with("SELECT severity_rank, severity, count(*) AS sensors FROM groups GROUP BY 1, 2", "groups"),
    "alert_sensor_text": _with(f"SELECT id, {_SENSOR_TEXT} AS text FROM predictions WHERE prediction_label IN ('FIRE', 'FIRE_RISK')", "predictions"),
    "alert_header": _with(
        f"SELECT severity_rank, severity, sensors, {_HEADER} AS header FROM (SELECT severity_rank, severity, count(*) AS sensors FROM groups GROUP BY 1, 2)", "groups"),
    "alert_message": _with(
        f"""SELECT severity_rank, severity, sensors, 0::BIGINT AS block, {_HEADER} AS text FROM indexed WHERE alert_number = 1
            UNION ALL SELECT severity_rank, severity, sensors, alert_number AS block,
              {_case("severity", K.ALERT_SENSOR_TITLE, "NULL")} || CAST(alert_number AS VARCHAR) || chr(10) || {_SENSOR_TEXT} || chr(10) AS text FROM indexed""", "indexed"),
    "split_train_test": _with("SELECT id, sensor_id, CASE WHEN id % 5 = 0 THEN 'test' ELSE 'train' END AS part FROM predictions", "predictions"),
}
ORACLES |= {
    f"{name}_pruned": ORACLES[name]
    for name in ("tail_by_time", "explorer_page", "latest_record", "history_by_time", "numbered_history", "latest_abnormal")
}
ORACLES |= {
    f"metric_trend_{name}": _with(
        f"""SELECT "timestamp", round(avg({name}), 9) AS value FROM (
             SELECT "timestamp", {name} FROM recent WHERE {name} IS NOT NULL ORDER BY "timestamp" DESC, id DESC LIMIT 200)
           GROUP BY "timestamp" ORDER BY "timestamp" DESC LIMIT 100""", "recent")
    for name in K.FEATURES if name != "temperature"
}
_MEASURED = " AND ".join(f"{name} IS NOT NULL" for name in K.FEATURES)
_MODELS = [("RF", "random forest"), ("DT", "decision tree"), ("LR", "logistic regression")]
ORACLES |= {
    "model_facts": _with(
        f"""SELECT m.model, m.family, TRUE AS accurate, (SELECT count(*) FROM predictions WHERE id % 5 = 0 AND {_MEASURED}) AS tested
            FROM (VALUES {", ".join(f"('{short}{n}', '{family}')" for short, family in _MODELS for n in (1, 2, 3, 4))}) AS m(model, family)""", "predictions"),
    "score_facts": _with(
        f"SELECT id, TRUE AS sums_to_one, TRUE AS label_agrees, TRUE AS highest FROM predictions WHERE {_MEASURED}", "predictions"),
    "importance_facts": f"SELECT {len(K.FEATURES)} AS features, 1.0::DOUBLE AS total, TRUE AS valid",
    "training_quality": _with(
        f"""SELECT count(*) AS rows, count(*) FILTER (WHERE {_MEASURED}) AS used, count(*) FILTER (WHERE NOT ({_MEASURED})) AS left_out
            FROM predictions""", "predictions"),
}
ORACLES["data_check"] = _with(
    f"""SELECT id, sensor_id, zone, "timestamp", {', '.join(K.FEATURES)}, prediction_label FROM recent ORDER BY id DESC LIMIT 60""", "recent")
ORACLES |= {
    "maintained_latest_by_max_id": ORACLES["latest_by_max_id"],
    "maintained_latest_abnormal": ORACLES["latest_abnormal"],
    "maintained_latest_by_time": _with("SELECT id, sensor, record_time FROM sensors", "sensors"),
    "stored_recent_history": ORACLES["recent_history"],
    "stored_history_by_time": _with("SELECT id, sensor, record_time FROM records ORDER BY order_time DESC, number DESC LIMIT 500", "records"),
    "rising_ids": "SELECT count(*) AS rows, count(*) AS ids, TRUE AS rising FROM events",
}


def _parts_sql():
    """Lines of the messages packed one by one; ``size`` is the length of the open part, 0 if none is."""
    limit = max(K.MESSAGE_MINIMUM, K.MESSAGE_LIMIT - K.MESSAGE_RESERVE)
    prefix = K.PART_PREFIX.replace("\n", "' || chr(10) || '").replace("{n}", "' || part || '").replace("{total}", "' || parts || '")
    return f"""WITH RECURSIVE message AS ({ORACLES["alert_message"]}), blocks AS (
             SELECT severity_rank, severity, block, CASE WHEN block = sensors THEN rtrim(text, chr(10)) ELSE text END AS text FROM message
           ), split AS (
             SELECT severity_rank, severity, block, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM blocks
           ), lines AS MATERIALIZED (
             SELECT severity_rank, severity, line, length(line) AS own, row_number() OVER (PARTITION BY severity_rank ORDER BY block, place) AS number FROM split
           ), packed AS (
             SELECT severity_rank, number, own AS size, 1 AS part, own > 0 AS held FROM lines WHERE number = 1
             UNION ALL
             SELECT l.severity_rank, l.number,
                    CASE WHEN p.size > 0 AND p.size + 1 + l.own <= {limit} THEN p.size + 1 + l.own ELSE l.own END,
                    CASE WHEN p.size > 0 AND p.size + 1 + l.own > {limit} THEN p.part + 1 ELSE p.part END,
                    p.size > 0 AND p.size + 1 + l.own <= {limit} OR l.own > 0
             FROM packed p JOIN lines l ON l.severity_rank = p.severity_rank AND l.number = p.number + 1
           ), bodies AS (
             SELECT severity_rank, severity, CAST(part AS BIGINT) AS part, string_agg(line, chr(10) ORDER BY number) AS body
             FROM packed JOIN lines USING (severity_rank, number) WHERE held GROUP BY ALL
           ), counted AS (
             SELECT *, count(*) OVER (PARTITION BY severity_rank) AS parts FROM bodies
           )
           SELECT severity_rank, severity, part, parts, CASE WHEN parts > 1 THEN '{prefix}' ELSE '' END || body AS text FROM counted"""


ORACLES["alert_message_parts"] = _parts_sql()
ORACLES["alert_outbox"] = f"""SELECT place, severity_rank, part, text FROM (
  SELECT row_number() OVER (ORDER BY severity_rank, part) - 1 AS place, severity_rank, part, text FROM ({ORACLES["alert_message_parts"]})) WHERE place > 0"""
ORACLES["rolled_history_totals"] = ORACLES["web_history_totals"]
ORACLES["rolled_zone_sensors"] = _with("SELECT zone, count(*) AS records, count(DISTINCT sensor_id) AS sensors FROM predictions GROUP BY zone", "predictions")
