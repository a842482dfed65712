"""Schemas of the records the engine reads and writes."""

from pyspark.sql import types as T

from emberwatch.constants import FEATURES


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_MEASURES = [(name, T.DoubleType()) for name in FEATURES]
_IDENTITY = [("sensor_id", T.StringType()), ("zone", T.StringType()), ("timestamp", T.StringType())]

READING = _struct(*_IDENTITY, *_MEASURES)
READING_COLUMNS = READING.fieldNames()

TRAINING = _struct(*_IDENTITY, *_MEASURES, ("label", T.IntegerType()))

PROBABILITIES = ["probability_normal", "probability_risk", "probability_fire"]
SCORED_COLUMNS = [*READING_COLUMNS, "prediction", "prediction_label", *PROBABILITIES]
PREDICTION_COLUMNS = ["id", *SCORED_COLUMNS, "created_at"]

PREDICTION = _struct(
    ("id", T.LongType()),
    *_IDENTITY,
    *_MEASURES,
    ("prediction", T.IntegerType()),
    ("prediction_label", T.StringType()),
    *[(name, T.DoubleType()) for name in PROBABILITIES],
    ("created_at", T.TimestampNTZType()),
)

# Records of the web API: every field may be absent and may be text or number,
# so all are read as text and coerced afterwards.
RECORD_COLUMNS = [
    "id", "sensor_id", "zone", "area", "location",
    "status", "prediction", "predicted_class", "result", "label",
    *PROBABILITIES, "created_at", "timestamp",
    "temperature", "humidity", "smoke", "gas", "smoke_ppm", "lpg_gas_ppm", "co_gas_ppm",
]
RECORD = _struct(*[(name, T.StringType()) for name in RECORD_COLUMNS])
