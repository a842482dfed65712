"""Roll-ups per zone."""

from pyspark.sql import functions as F

from emberwatch.constants import FIRE, FIRE_RISK, ZONES
from emberwatch.functions.literals import sql_list
from emberwatch.functions.places import zone_label


def zone_dimension(spark):
    """The configured zones in display order, as a literal relation."""
    values = ", ".join(f"({index}, '{zone}', '{label}')" for index, (zone, label) in enumerate(ZONES.items()))
    return spark.sql(f"SELECT * FROM VALUES {values} AS zones(zone_idx, zone, zone_label)")


def zone_stats(latest):
    """Per zone over the fresh rows: sensors, alerts and mean measures."""
    label = F.col("prediction_label")
    return (
        latest.filter("is_fresh")
        .groupBy("zone")
        .agg(
            F.count_distinct("sensor_id").alias("total_sensors"),
            F.count_if(label == FIRE).alias("fire_sensors"),
            F.count_if(label == FIRE_RISK).alias("risk_sensors"),
            F.avg("temperature").alias("avg_temp"),
            F.avg("smoke_ppm").alias("avg_smoke"),
        )
    )


def zone_status(has_rows, total, fire, risk):
    return (
        F.when(~has_rows, F.lit("NO_DATA"))
        .when(total == 0, F.lit("STALE"))
        .when(fire > 0, F.lit("FIRE"))
        .when(risk > 0, F.lit("FIRE_RISK"))
        .otherwise(F.lit("OK"))
    )


def zone_board(latest):
    """All configured zones with their fresh statistics and status; zeros where there is nothing.

    ``latest`` has one row per sensor, so sensors are counted without a distinct. Fresh and
    stale rows are counted in one grouping. Restricted to the configured zones the grouped
    side has at most one row per zone, which bounds what is broadcast.
    """
    fresh, label = F.col("is_fresh"), F.col("prediction_label")
    stats = (
        latest.filter(f"zone IN ({sql_list(ZONES)})")
        .groupBy("zone")
        .agg(
            F.count(F.when(fresh, F.col("sensor_id"))).alias("total"),
            F.count_if(fresh & (label == FIRE)).alias("fire"),
            F.count_if(fresh & (label == FIRE_RISK)).alias("risk"),
            F.avg(F.when(fresh, F.col("temperature"))).alias("temp"),
            F.avg(F.when(fresh, F.col("smoke_ppm"))).alias("smoke"),
        )
    )
    board = zone_dimension(latest.sparkSession).join(F.broadcast(stats), "zone", "left")
    total, fire, risk = (F.coalesce(F.col(name), F.lit(0)) for name in ("total", "fire", "risk"))
    no_fresh = total == 0
    return board.select(
        "zone_idx",
        "zone",
        "zone_label",
        total.alias("total_sensors"),
        fire.alias("fire_sensors"),
        risk.alias("risk_sensors"),
        F.when(no_fresh, F.lit(0.0)).otherwise(F.col("temp")).alias("avg_temp"),
        F.when(no_fresh, F.lit(0.0)).otherwise(F.col("smoke")).alias("avg_smoke"),
        zone_status(F.col("total").isNotNull(), total, fire, risk).alias("status"),
    )


def zone_display(frame, dimension=None, zone="zone"):
    """Adds ``zone_label``; with ``dimension`` (zone, zone_label) the names come from a table.

    Whether that table is broadcast is left to Spark, which knows its size.
    """
    if dimension is None:
        return frame.withColumn("zone_label", zone_label(F.col(zone)))
    names = dimension.select(F.col("zone").alias(zone), F.col("zone_label").alias("known_label"))
    joined = frame.join(names, zone, "left")
    return joined.withColumn("zone_label", F.coalesce("known_label", zone)).drop("known_label")
