"""Sensor tables derived from an ``events`` table (event_id, ts, user_id, value).

They stand in for the sensor tables a plant would have; every row of ``events`` gives
one row, so work over them grows with it.
"""

from pyspark.sql import functions as F

from emberwatch.constants import ZONES
from emberwatch.functions.literals import sql_list
from emberwatch.schemas import READING_COLUMNS

_ZONE_KEYS = f"array({sql_list(ZONES)})"
_ZONE_NAMES = f"array({sql_list(ZONES.values())})"


def _time_text(column):
    return f"date_format({column}, 'yyyy-MM-dd HH:mm:ss')"


def readings(spark, folder):
    """Readings with their ``id``; the timestamp is a real one here."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.selectExpr(
        "event_id AS id",
        "coalesce(concat('S', lpad(CAST(pmod(user_id, 50) + 1 AS STRING), 3, '0')), 'UNKNOWN') AS sensor_id",
        f"coalesce({_ZONE_KEYS}[CAST(pmod(user_id, {len(ZONES)}) AS INT)], 'UNKNOWN') AS zone",
        "ts AS timestamp",
        "CASE WHEN event_id % 97 <> 0 THEN CAST(24 + event_id % 13 AS DOUBLE) + value / 8 END AS temperature",
        "CASE WHEN value > 400 THEN 20D ELSE 70D - value / 8 END AS humidity",
        "value * 2 AS smoke_ppm",
        "CAST(50 + (event_id * 31) % 130 AS DOUBLE) + value * 3 AS lpg_gas_ppm",
        "CAST(5 + event_id % 20 AS DOUBLE) + value / 2 AS co_gas_ppm",
    )


def _by_class(name, normal, risk, fire):
    """Fixed exact shares per class; every 83rd row has none."""
    share = f"CASE prediction WHEN 0 THEN {normal}D WHEN 1 THEN {risk}D ELSE {fire}D END"
    return f"CASE WHEN id % 83 <> 0 THEN {share} END AS {name}"


def predictions(spark, folder):
    """A prediction table: missing labels, store times and probabilities included."""
    scored = readings(spark, folder).selectExpr(
        "*",
        "CASE WHEN temperature > 65 OR smoke_ppm > 400 THEN 2 WHEN temperature > 50 OR smoke_ppm > 200 THEN 1 ELSE 0 END AS prediction",
    )
    return scored.selectExpr(
        "id",
        *READING_COLUMNS,
        "prediction",
        "CASE WHEN id % 89 <> 0 THEN CASE prediction WHEN 2 THEN 'FIRE' WHEN 1 THEN 'FIRE_RISK' ELSE 'NORMAL' END END AS prediction_label",
        _by_class("probability_normal", 0.875, 0.125, 0),
        _by_class("probability_risk", 0.125, 0.75, 0.25),
        _by_class("probability_fire", 0, 0.125, 0.75),
        "CASE WHEN id % 101 <> 0 THEN timestamp + INTERVAL 5 SECONDS END AS created_at",
    )


def raw_predictions(spark, folder):
    """The prediction table as untyped text, with values that cannot be read."""
    return predictions(spark, folder).selectExpr(
        "id",
        "sensor_id",
        "CASE WHEN id % 59 <> 0 THEN zone END AS zone",
        f"CASE WHEN id % 61 = 0 THEN 'not a time' ELSE {_time_text('timestamp')} END AS timestamp",
        "CASE WHEN id % 67 = 0 THEN 'n/a' ELSE CAST(temperature AS STRING) END AS temperature",
        "CASE WHEN id % 71 = 0 THEN 'NaN' ELSE CAST(humidity AS STRING) END AS humidity",
        *[f"CAST({name} AS STRING) AS {name}" for name in ("smoke_ppm", "lpg_gas_ppm", "co_gas_ppm", "prediction")],
        "CASE WHEN id % 7 = 0 THEN lower(prediction_label) WHEN id % 11 = 0 THEN ' ' || prediction_label "
        "WHEN id % 13 = 0 THEN 'Fire-Risk' ELSE prediction_label END AS prediction_label",
        "CASE WHEN id % 73 = 0 THEN 'none' ELSE CAST(probability_normal AS STRING) END AS probability_normal",
        "CASE WHEN id % 79 = 0 THEN '50' ELSE CAST(probability_risk AS STRING) END AS probability_risk",
        "CASE WHEN id % 79 = 0 THEN '-0.5' ELSE CAST(probability_fire AS STRING) END AS probability_fire",
        f"CASE WHEN id % 103 = 0 THEN '' ELSE {_time_text('created_at')} END AS created_at",
    )


def _words(fire, risk, normal):
    return f"CASE prediction WHEN 2 THEN '{fire}' WHEN 1 THEN '{risk}' ELSE '{normal}' END"


def api_records(spark, folder):
    """Web records: aliases for zone and status, numbers as text, missing parts."""
    name = f"{_ZONE_NAMES}[CAST(array_position({_ZONE_KEYS}, zone) - 1 AS INT)]"
    return predictions(spark, folder).selectExpr(
        "CAST(id AS STRING) AS id",
        "CASE WHEN id % 997 <> 0 THEN sensor_id END AS sensor_id",
        "CASE WHEN id % 3 = 0 THEN zone END AS zone",
        f"CASE WHEN id % 3 = 1 THEN {name} END AS area",
        "CASE WHEN id % 6 = 2 THEN zone WHEN id % 12 = 5 THEN 'Khu_Moi' END AS location",
        f"CASE WHEN id % 4 = 0 THEN {_words('fire alert', ' Fire-Risk ', 'safe')} WHEN id % 107 = 0 THEN '' END AS status",
        "CASE WHEN id % 4 = 1 THEN CAST(prediction AS STRING) END AS prediction",
        f"CASE WHEN id % 4 = 2 THEN {_words('CHÁY', 'CẢNH-BÁO', 'AN TOÀN')} END AS predicted_class",
        "CASE WHEN id % 8 = 3 THEN prediction_label END AS result",
        f"CASE WHEN id % 8 = 7 THEN {_words('danger_fire', 'warn', '2.0')} END AS label",
        "CASE WHEN id % 71 = 0 THEN '1.5' ELSE CAST(probability_normal AS STRING) END AS probability_normal",
        "CASE WHEN id % 73 = 0 THEN 'n/a' ELSE CAST(probability_risk AS STRING) END AS probability_risk",
        "CAST(probability_fire AS STRING) AS probability_fire",
        f"CASE WHEN id % 103 = 0 THEN '' ELSE {_time_text('created_at')} END AS created_at",
        f"CASE WHEN id % 109 = 0 THEN 'soon' ELSE {_time_text('timestamp')} END AS timestamp",
        "CAST(temperature AS STRING) AS temperature",
    )


def messages(spark, folder):
    """Readings as message bytes, some of them broken."""
    fields = ", ".join(READING_COLUMNS)
    return (
        readings(spark, folder)
        .withColumn("timestamp", F.expr(_time_text("timestamp")))
        .selectExpr("id", f"CAST(CASE WHEN id % 113 = 0 THEN 'not json' ELSE to_json(struct({fields})) END AS BINARY) AS value")
    )
