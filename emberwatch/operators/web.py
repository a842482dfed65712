"""Operators over web API records, whose rules differ from the prediction table's."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch.constants import BREAKDOWN_GROUPS, HISTORY_ROWS, STALE_SECONDS, TOTAL_SENSORS, ZONES
from emberwatch.functions import numbers, places, times
from emberwatch.functions.labels import connection_state, status_alias, text_for
from emberwatch.operators.latest import latest_by_time
from emberwatch.operators.pruning import from_floor, newest_floor_by_time
from emberwatch.operators.zones import zone_dimension
from emberwatch.schemas import PROBABILITIES

_ALERTS = ["RISK", "FIRE"]


def identify(records):
    """Adds what ranking needs to raw text records: sensor, time and number."""
    c = F.col
    named = records.withColumns(
        {
            "sensor": places.record_sensor(c("sensor_id"), c("id")),
            "record_time": times.data_time_web(c("created_at"), c("timestamp")),
            "order_id": F.coalesce(numbers.web_number(c("id")), F.lit(0.0)),
        }
    )
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return named.withColumn("order_time", F.coalesce(c("record_time"), epoch))


def describe(identified, now=None, stale_seconds=STALE_SECONDS):
    """Adds zone, status, connection and percentages to identified records."""
    c = F.col
    named = identified.withColumns(
        {
            "raw_zone": places.record_zone(c("zone"), c("area"), c("location")),
            "status": status_alias(c("status"), c("prediction"), c("predicted_class"), c("result"), c("label")),
            "age_seconds": times.age_seconds(c("record_time"), now),
            **{name: numbers.percent_clamped(c(name)) for name in PROBABILITIES},
        }
    )
    return named.withColumns(
        {
            "zone_name": places.zone_label_web(c("raw_zone")),
            "connection": connection_state(c("age_seconds"), stale_seconds),
        }
    )


def prepare_records(records, now=None, stale_seconds=STALE_SECONDS):
    """Raw text records with everything the web operators use."""
    return describe(identify(records), now, stale_seconds)


def latest_sensors(records, now=None, stale_seconds=STALE_SECONDS):
    """The newest record of each sensor. Only these are described: ranking comes first."""
    return describe(latest_by_time(identify(records)), now, stale_seconds)


def web_overview(latest, total=TOTAL_SENSORS):
    """The head counts. NORMAL needs a live connection; RISK and FIRE stay visible when stale."""
    status, connection = F.col("status"), F.col("connection")
    counts = latest.agg(
        F.count("*").alias("seen"),
        F.count_if((status == "NORMAL") & (connection == "ONLINE")).alias("normal"),
        F.count_if(status == "RISK").alias("risk"),
        F.count_if(status == "FIRE").alias("fire"),
        F.count_if(connection == "ONLINE").alias("online"),
        F.count_if(connection == "OFFLINE").alias("offline"),
        F.count_if(status == "UNKNOWN").alias("unknown_status"),
        F.count_if(connection == "UNKNOWN").alias("unknown_connection"),
    )
    return counts.withColumns(
        {
            "missing": F.greatest(F.lit(0), F.lit(total) - F.col("seen")),
            "unknown": F.col("unknown_status") + F.col("unknown_connection"),
        }
    )


def status_breakdown(overview, total=TOTAL_SENSORS):
    """The overview as one row per group with its share of the configured sensors."""
    groups = F.array(
        *[
            F.struct(F.lit(place).alias("position"), F.lit(text).alias("label"), F.col(name).cast("bigint").alias("value"))
            for place, (name, text) in enumerate(BREAKDOWN_GROUPS)
        ]
    )
    rows = overview.select(F.inline(groups))
    return rows.withColumn("percent", F.least(F.lit(100.0), F.col("value") / total * 100))


def web_alerts(latest, k=None):
    """Latest records with RISK or FIRE, newest first."""
    return newest_records(latest.filter(F.col("status").isin(_ALERTS)), k)


def newest_records(latest, k=None):
    """The ``k`` newest records, or all of them, newest first."""
    ordered = latest.orderBy(F.desc("order_time"), F.desc("order_id"), F.desc("id"))
    return ordered if k is None else ordered.limit(k)


def web_alert_totals(latest):
    status = F.col("status")
    return latest.agg(
        F.count_if(status.isin(_ALERTS)).alias("alerts"),
        F.count_if(status == "RISK").alias("risk"),
        F.count_if(status == "FIRE").alias("fire"),
    )


def web_history_totals(records, shown=HISTORY_ROWS):
    counts = records.agg(F.count("*").alias("records"), F.count_distinct("sensor").alias("sensors"))
    return counts.withColumn("shown", F.least(F.col("records"), F.lit(shown)))


def history_by_time(records, n=HISTORY_ROWS, prune=False):
    """The ``n`` newest records by data time, those without a time last."""
    if prune:
        records = records.filter(from_floor(F.col("order_time"), newest_floor_by_time(records, n, "order_time")))
    return newest_records(records, n)


def numbered_history(records, n=HISTORY_ROWS, prune=False):
    """``history_by_time`` with a running number; only the ``n`` kept rows are numbered."""
    window = Window.orderBy(F.desc("order_time"), F.desc("order_id"), F.desc("id"))
    return history_by_time(records, n, prune).withColumn("number", F.row_number().over(window))


def distinct_zones(latest):
    return latest.select("zone_name").distinct().orderBy("zone_name")


def zone_match(latest):
    """Records of configured zones, with the key of the zone they belong to.

    A record belongs to a zone by its key or by its display name. The display name of a
    key is the zone's label, so comparing names alone covers both and stays an equality.
    """
    key = text_for(F.col("zone_name"), {label: zone for zone, label in ZONES.items()}, F.lit(None))
    return latest.withColumn("zone_key", key).filter(F.col("zone_key").isNotNull())


def web_zone_summary(latest):
    """Per configured zone: sensors, connected, RISK, FIRE, connected share and severity."""
    stats = (
        zone_match(latest)
        .groupBy("zone_key")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("connection") == "ONLINE").alias("n_online"),
            F.count_if(F.col("status") == "RISK").alias("n_risk"),
            F.count_if(F.col("status") == "FIRE").alias("n_fire"),
        )
    )
    zones = zone_dimension(latest.sparkSession).withColumnRenamed("zone", "zone_key")
    joined = zones.join(F.broadcast(stats), "zone_key", "left")  # at most one row per zone
    count, online, risk, fire = (F.coalesce(F.col(name), F.lit(0)) for name in ("n", "n_online", "n_risk", "n_fire"))
    return joined.select(
        F.col("zone_key").alias("key"),
        F.col("zone_label").alias("label"),
        count.alias("sensors"),
        online.alias("online"),
        risk.alias("risk"),
        fire.alias("fire"),
        F.when(count > 0, online / count * 100).otherwise(F.lit(0.0)).alias("online_percent"),
        F.when(fire > 0, F.lit("fire")).when(risk > 0, F.lit("risk")).otherwise(F.lit("ok")).alias("severity"),
    )


def mean_probabilities(latest):
    """Mean percentage per class over connected sensors; missing values are left out."""
    online = latest.filter(F.col("connection") == "ONLINE")
    return online.agg(*[F.avg(name).alias(name) for name in PROBABILITIES])


def online_probability_table(latest):
    online = latest.filter(F.col("connection") == "ONLINE")
    return online.select("sensor", "zone_name", *PROBABILITIES, "status")
