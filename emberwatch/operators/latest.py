"""The different meanings of "latest". They are not interchangeable."""

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch.constants import ABNORMAL_CODES
from emberwatch.operators.pruning import from_floor, latest_floor, newest_floor


def max_id_per_sensor(frame):
    return frame.groupBy("sensor_id").agg(F.max("id").alias("max_id"))


#: Keys up to which the newest value of each is broadcast to thin the rows out.
BROADCAST_KEYS = 200_000


def _newest(frame, keys, column):
    """The rows with the highest ``column`` of their keys, ties included.

    A narrow aggregate finds the values, and a semi-join keeps their rows, so that wide rows
    are neither sorted nor shuffled before they are few, however long a key has been silent.
    The aggregate runs once, while the query is built: up to ``BROADCAST_KEYS`` of its rows are
    fetched and broadcast. Beyond, all rows stay, as ranking them moves fewer than a join would.
    """
    places = {name: f"newest_{place}" for place, name in enumerate([*keys, column])}
    newest = frame.groupBy(*keys).agg(F.max(column).alias(places[column]))
    newest = newest.withColumnsRenamed({name: places[name] for name in keys})
    found = newest.limit(BROADCAST_KEYS + 1).toArrow()
    if found.num_rows > BROADCAST_KEYS:
        return frame
    newest = frame.sparkSession.createDataFrame(found, newest.schema)
    same = [frame[name].eqNullSafe(newest[place]) for name, place in places.items()]
    return frame.join(F.broadcast(newest), reduce(and_, same), "left_semi")


def _first(frame, keys, order):
    """The first row per key. Tasks keep one row per key before the shuffle, so a key that
    holds a large part of the table is no heavier than any other."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return frame.withColumn("rank", rank).filter(F.col("rank") == 1).drop("rank")


def latest_by_max_id(frame, ordered=False, prune=False):
    """The row with the highest id of each sensor.

    ``prune`` adds the bound of ``pruning``.
    """
    rows = frame.filter(F.col("id").isNotNull())
    if prune:
        rows = rows.filter(F.col("id") >= latest_floor(frame, ["sensor_id"], "id"))
    newest = _first(_newest(rows, ["sensor_id"], "id"), ["sensor_id"], [F.desc("id")])
    return newest.orderBy(F.desc("id")) if ordered else newest


def latest_by_max_id_join(frame):
    """The same rows by joining the table to its highest ids; kept to check the form above."""
    ids = max_id_per_sensor(frame).select(F.col("max_id").alias("id"))
    return frame.join(ids, "id", "left_semi")


def _not_before_latest(frame, keys, column):
    """Without the rows older than the oldest of the latest rows; rows without a time stay."""
    floor = latest_floor(frame, keys, column)
    return frame.filter(from_floor(F.col(column), floor))


def latest_abnormal(frame, code="prediction", ties=("id",), prune=False):
    """Newest abnormal row per sensor and zone.

    Abnormal rows are selected before ranking: a sensor that recovered afterwards still
    counts. ``ties`` decides between rows of the same second.
    """
    abnormal = frame.filter(F.col(code).isin(ABNORMAL_CODES))
    if prune:
        abnormal = _not_before_latest(abnormal, ["sensor_id", "zone"], "timestamp")
    abnormal = _newest(abnormal, ["sensor_id", "zone"], "timestamp")
    return _first(abnormal, ["sensor_id", "zone"], [F.desc("timestamp"), *[F.desc(name) for name in ties]])


def latest_by_time(records, prune=False):
    """Newest record per sensor by data time, then id; records from ``web.identify``."""
    if prune:
        records = _not_before_latest(records, ["sensor"], "order_time")
    records = _newest(records, ["sensor"], "order_time")
    return _first(records, ["sensor"], [F.desc("order_time"), F.desc("order_id"), F.desc("id")])


def latest_record(frame, prune=False):
    """The single newest row."""
    if prune:
        frame = frame.filter(from_floor(F.col("id"), newest_floor(frame, 1, F.col("id"))))
    return frame.orderBy(F.desc("id")).limit(1)
