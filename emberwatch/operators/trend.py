"""Trend of one measure over the newest rows."""

from pyspark.sql import functions as F

from emberwatch.constants import TREND_POINTS, TREND_ROWS
from emberwatch.functions.times import as_time
from emberwatch.operators.clean import drop_missing_metric
from emberwatch.operators.pruning import from_floor, newest_floor_by_time


def tail_by_time(frame, metric, n=TREND_ROWS, prune=False):
    """The ``n`` latest rows by time that have the metric; ids decide within a second."""
    rows = drop_missing_metric(frame, metric)
    if prune:
        time = as_time(rows, "timestamp") if rows.schema["timestamp"].dataType.typeName() == "string" else F.col("timestamp")
        rows = rows.filter(from_floor(time, newest_floor_by_time(rows, n, "timestamp")))
    return rows.orderBy(F.desc("timestamp"), F.desc("id")).limit(n)


def metric_trend(frame, metric, rows=TREND_ROWS, points=TREND_POINTS):
    """Mean of the metric per timestamp, for the last timestamps of the tail, oldest first."""
    means = tail_by_time(frame, metric, rows).groupBy("timestamp").agg(F.avg(metric).alias("value"))
    return means.orderBy(F.desc("timestamp")).limit(points).orderBy("timestamp")


def trend_reference(trend):
    """Last, mean and highest value of a trend; zeros for an empty one."""
    zero = F.lit(0.0)
    return trend.agg(
        F.coalesce(F.max_by("value", "timestamp"), zero).alias("current"),
        F.coalesce(F.avg("value"), zero).alias("average"),
        F.coalesce(F.max("value"), zero).alias("peak"),
    )
