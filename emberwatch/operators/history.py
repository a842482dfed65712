"""Newest rows, alert history and ranked alerts."""

from pyspark.sql import functions as F

from emberwatch.constants import ABNORMAL_LABELS, FIRE, FIRE_RISK, HISTORY_ROWS
from emberwatch.functions.labels import board_priority, fire_first
from emberwatch.operators.pruning import from_floor, newest_floor


def recent_history(frame, n=HISTORY_ROWS, prune=False):
    """The ``n`` newest rows by id, those without an id last.

    A plain top-k sends ``n`` wide rows from every task to one; with the bound of
    ``prune`` only tasks near the top send any.
    """
    if prune:
        frame = frame.filter(from_floor(F.col("id"), newest_floor(frame, n, F.col("id"))))
    return frame.orderBy(F.desc("id")).limit(n)


def abnormal_only(frame, label="prediction_label"):
    return frame.filter(F.col(label).isin(ABNORMAL_LABELS))


def by_class(frame, code, column="prediction"):
    return frame.filter(F.col(column) == code)


def alert_history(history):
    """Abnormal rows of a history window, newest first."""
    return abnormal_only(history).orderBy(F.desc("id"))


def history_filter(frame, label=None, zone=None):
    """Rows of one label and one zone; None keeps all."""
    if label is not None:
        frame = frame.filter(F.col("prediction_label") == label)
    if zone is not None:
        frame = frame.filter(F.col("zone") == zone)
    return frame


def active_alerts(latest, k=None):
    """Latest abnormal rows: FIRE first, fresh first, newest first."""
    ranked = abnormal_only(latest).withColumn("status_priority", fire_first(F.col("prediction_label")))
    ranked = ranked.orderBy(F.asc("status_priority"), F.desc("is_fresh"), F.desc("id"))
    return ranked if k is None else ranked.limit(k)


def by_urgency(latest):
    """Latest rows: FIRE, FIRE_RISK, unclear, NORMAL, then by sensor."""
    return (
        latest.withColumn("status_priority", board_priority(F.col("prediction_label")))
        .orderBy("status_priority", "sensor_id")
        .drop("status_priority")
    )


def alert_totals(latest, history):
    """Active alerts now, and alerts within the history window."""
    now = abnormal_only(latest).agg(F.count("*").alias("active_alerts"))
    label = F.col("prediction_label")
    past = abnormal_only(history).agg(
        F.count("*").alias("history_events"),
        F.count_if(label == FIRE).alias("fire_events"),
        F.count_if(label == FIRE_RISK).alias("risk_events"),
    )
    # one row each, put together as one row
    names = ["history_events", "fire_events", "risk_events"]
    both = now.select("active_alerts", *[F.lit(0).cast("bigint").alias(name) for name in names])
    both = both.unionAll(past.select(F.lit(0).cast("bigint").alias("active_alerts"), *names))
    return both.agg(*[F.sum(name).alias(name) for name in ["active_alerts", *names]])
