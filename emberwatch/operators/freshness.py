"""Age of the data and the counts that depend on it."""

from pyspark.sql import functions as F

from emberwatch.constants import FIRE, FIRE_RISK, NORMAL, STALE_SECONDS, UNKNOWN
from emberwatch.functions.labels import is_fresh
from emberwatch.functions.times import age_seconds, data_time


def add_freshness(frame, now=None, stale_seconds=STALE_SECONDS):
    """Adds ``data_time``, ``age_seconds`` and ``is_fresh`` to prepared predictions.

    A frame may lack either time column, or both; then the other counts, or no row is fresh.
    """
    times = [F.col(name) if name in frame.columns else F.lit(None).cast("timestamp_ntz") for name in ("created_at", "timestamp")]
    aged = frame.withColumn("data_time", data_time(*times))
    aged = aged.withColumn("age_seconds", age_seconds(F.col("data_time"), now))
    return aged.withColumn("is_fresh", is_fresh(F.col("age_seconds"), stale_seconds))


def fresh_split(frame):
    """Fresh rows and stale rows."""
    return frame.filter("is_fresh"), frame.filter("NOT is_fresh")


def sensor_counts(latest):
    """Sensors in total, fresh, stale. ``latest`` has one row per sensor, so its rows are counted."""
    sensor = F.col("sensor_id")
    return latest.agg(
        F.count(sensor).alias("total_sensors"),
        F.count(F.when(F.col("is_fresh"), sensor)).alias("fresh_sensors"),
        F.count(F.when(~F.col("is_fresh"), sensor)).alias("stale_sensors"),
    )


def _percent(part, whole):
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def status_kpis(latest):
    """Counts per class over the fresh rows, with percentages of the fresh sensors.

    ``latest`` has one row per sensor, so its rows count its sensors.
    """

    def fresh(label):
        return F.count_if(F.col("is_fresh") & (F.col("prediction_label") == label))

    counts = latest.agg(
        F.count(F.when(F.col("is_fresh"), F.col("sensor_id"))).alias("fresh_sensors"),
        fresh(UNKNOWN).alias("unknown_count"),
        fresh(NORMAL).alias("normal_count"),
        fresh(FIRE_RISK).alias("risk_count"),
        fresh(FIRE).alias("fire_count"),
    )
    whole = F.col("fresh_sensors")
    return counts.withColumns(
        {f"pct_{name}": _percent(F.col(f"{name}_count"), whole) for name in ("normal", "risk", "fire")}
    )


def plant_banner(latest):
    """One row with the overall verdict and the counts it rests on; one row per sensor in."""
    sensor, fresh, label = F.col("sensor_id"), F.col("is_fresh"), F.col("prediction_label")
    counts = latest.agg(
        F.count(sensor).alias("total_sensors"),
        F.count(F.when(fresh, sensor)).alias("fresh_sensors"),
        F.count(F.when(~fresh, sensor)).alias("stale_sensors"),
        F.count_if(fresh & (label == UNKNOWN)).alias("unknown_count"),
        F.count_if(fresh & (label == FIRE_RISK)).alias("risk_count"),
        F.count_if(fresh & (label == FIRE)).alias("fire_count"),
    )
    unclear = (F.col("fresh_sensors") == 0) | (F.col("stale_sensors") > 0) | (F.col("unknown_count") > 0)
    banner = (
        F.when(F.col("fire_count") > 0, F.lit("FIRE"))
        .when(F.col("risk_count") > 0, F.lit("FIRE_RISK"))
        .when(unclear, F.lit("INSUFFICIENT"))
        .otherwise(F.lit("OK"))
    )
    return counts.withColumn("banner", banner)
