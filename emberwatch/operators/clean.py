"""Decoding, validation and coercion of readings and predictions."""

from pyspark.sql import functions as F

from emberwatch import schemas
from emberwatch.constants import FEATURES, UNKNOWN
from emberwatch.functions.labels import normalise_label
from emberwatch.functions.numbers import to_number
from emberwatch.functions.times import as_time

_NUMERIC = [*FEATURES, "prediction", *schemas.PROBABILITIES]


def decode_value(frame, column="value"):
    """Message bytes as text."""
    return frame.select(F.col(column).cast("string").alias("json_value"))


def parse_readings(frame, column="json_value"):
    """JSON text to reading columns; what does not fit the schema becomes null.

    The record is unfolded with ``inline`` rather than by field access: filters on its
    fields would otherwise be pushed below and parse the text once for every field.
    """
    return frame.select(F.inline(F.array(F.from_json(column, schemas.READING))))


def _complete():
    condition = F.lit(True)
    for name in schemas.READING_COLUMNS:
        condition = condition & F.col(name).isNotNull()
    return condition


def validate_readings(frame):
    """Rows with all eight fields present. NaN is a present value."""
    return frame.filter(_complete())


def rejected_readings(frame):
    """The rows ``validate_readings`` leaves out."""
    return frame.filter(~_complete())


def measured():
    """All measures are numbers. A model cannot score a row with NaN."""
    condition = F.lit(True)
    for name in FEATURES:
        condition = condition & F.col(name).isNotNull() & ~F.isnan(name)
    return condition


def scorable_readings(frame):
    """Complete rows whose measures are all numbers."""
    return frame.filter(_complete() & measured())


def unscorable_readings(frame):
    """The other rows, each with its ``reason``: missing or not_a_number."""
    return frame.filter(~(_complete() & measured())).withColumn("reason", F.when(_complete(), "not_a_number").otherwise("missing"))


def reading_quality(frame):
    """One row: how many readings are complete, rejected, and missing each field."""
    return frame.agg(
        F.count("*").alias("readings"),
        F.count_if(_complete()).alias("complete"),
        F.count_if(~_complete()).alias("rejected"),
        *[F.count_if(F.col(name).isNull()).alias(f"missing_{name}") for name in schemas.READING_COLUMNS],
    )


def select_existing(frame, columns):
    """The listed columns that the frame has."""
    present = set(frame.columns)
    return frame.select(*[name for name in columns if name in present])


def rename_display(frame, headings):
    """Columns renamed by position."""
    return frame.toDF(*headings)


def _as_number(frame, name):
    if frame.schema[name].dataType.typeName() == "string":
        return to_number(F.col(name))
    return F.expr(f"nanvl(CAST({name} AS DOUBLE), NULL)")


def prepare_predictions(frame):
    """Coerce a prediction table: lenient numbers and times, known labels, no null zone."""
    present = set(frame.columns)
    changes = {name: _as_number(frame, name) for name in _NUMERIC if name in present}
    changes |= {name: as_time(frame, name) for name in ("timestamp", "created_at") if name in present}
    changes["prediction_label"] = (
        normalise_label(F.col("prediction_label")) if "prediction_label" in present else F.lit(UNKNOWN)
    )
    if "sensor_id" in present:
        changes["sensor_id"] = F.expr("CAST(sensor_id AS STRING)")
    if "zone" in present:
        changes["zone"] = F.expr(f"coalesce(CAST(zone AS STRING), '{UNKNOWN}')")
    return frame.withColumns(changes)


def prediction_projection(frame):
    """Scored readings with the raw prediction and the probability vector."""
    return frame.select(*schemas.READING_COLUMNS, "prediction", "probability")


def prediction_table_projection(frame):
    """The columns stored in the prediction table, class code as a whole number."""
    return frame.withColumn("prediction", F.col("prediction").cast("int")).select(*schemas.SCORED_COLUMNS)


def drop_missing_metric(frame, metric, time="timestamp"):
    """Rows that have both a time and the metric; NaN counts as missing."""
    return frame.dropna(subset=[time, metric])


def preview(frame, n=10):
    """The first rows, for a look at the data."""
    return frame.limit(n)
