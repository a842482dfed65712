"""Queries over tables that are stored batch by batch, as the streams store them.

Each writes the whole derived table in batches to the shared folder, with a replay and with rows
that come late, and then asks through the table's log.
"""

from pyspark.sql import functions as F

from emberwatch.constants import HISTORY_ROWS
from emberwatch.operators import history, latest, web
from emberwatch.schemas import PREDICTION_COLUMNS
from emberwatch.sources import events
from emberwatch.sources.batches import BatchLog
from emberwatch.sources.shared import delete, new_folder
from emberwatch.sources.tables import read_predictions, with_row_ids
from emberwatch.streaming.rollups import DistinctTotals

BATCHES = 4
ROWS_PER_FILE = 20_000
#: Size of the row groups that rows lie in before they are stored as batches.
ROW_GROUP_BYTES = 8 << 20
_PLACE = "place of the batch"


def _batches(rows, number):
    """Rows in batches by rising number; every fiftieth comes one batch late.

    The rows are worked out and dealt over the batches in one pass, whatever the number of batches,
    and lie in a folder until the last batch is taken. Row groups are small there, so that all
    tasks share in a batch even where the rows of a batch come from few tasks.
    """
    spark = rows.sparkSession
    bounds = rows.agg(F.min(number).alias("low"), F.max(number).alias("high")).first()
    low, high = bounds["low"] or 0, bounds["high"] or 0
    width = (high - low) // BATCHES + 1
    place = F.least(F.lit(BATCHES - 1), F.floor((number - low) / width) + F.when(number % 50 == 0, 1).otherwise(0))
    dealt = rows.withColumn(_PLACE, F.coalesce(place, F.lit(0)).cast("int"))
    folder = new_folder(spark, "dealt")
    try:
        dealt.write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(_PLACE).parquet(folder)
        read = spark.read.schema(dealt.schema).parquet(folder)
        for batch in range(BATCHES):
            yield batch, read.filter(F.col(_PLACE) == batch).drop(_PLACE)
    finally:
        delete(spark, folder)


def _stored(spark, rows, number, name, operator=None, **zones):
    """The rows as a logged table. With ``operator``, its snapshot is made before the last two batches."""
    log = BatchLog(spark, new_folder(spark, name))
    for batch, part in _batches(rows, number):
        log.write(part, batch, "plant", **zones)
        if batch == 1:
            log.write(part, batch, "plant", **zones)  # a replay
            if operator:
                log.refresh_latest(name, operator)
    return log


def _stored_predictions(spark, folder, name, operator=None):
    rows = events.predictions(spark, folder).select(*PREDICTION_COLUMNS)
    return _stored(spark, rows, F.col("id"), name, operator)


def _by_order(rows):
    """Zones of identified web records, which carry their number and time under other names."""
    return F.col("order_id").cast("long"), F.col("order_time")


def _stored_records(spark, folder, name, operator=None):
    rows = web.identify(events.api_records(spark, folder))
    return _stored(spark, rows, F.col("order_id").cast("long"), name, operator, zones=_by_order)


def read_stored(spark, folder):
    """The prediction table as the reader gives it."""
    return read_predictions(spark, _stored_predictions(spark, folder, "predictions").path)


def _maintained(name, operator):
    return lambda spark, folder: _stored_predictions(spark, folder, name, operator).latest(name, operator)


def maintained_latest_by_time(spark, folder):
    name = "latest_by_time"
    newest = _stored_records(spark, folder, name, latest.latest_by_time).latest(name, latest.latest_by_time)
    return newest.select("id", "sensor", "record_time")


def stored_recent_history(spark, folder):
    """The newest rows by id, from the files that can hold them, after a compaction."""
    log = _stored_predictions(spark, folder, "recent_history")
    log.compact(rows_per_file=ROWS_PER_FILE)
    return history.recent_history(log.read_newest(500))


def stored_history_by_time(spark, folder):
    newest = web.history_by_time(_stored_records(spark, folder, "history_by_time").read_newest(500, "time"))
    return newest.select("id", "sensor", "record_time")


def rising_ids(spark, folder):
    """Two streams write one table in turn; their ids rise from batch to batch."""
    log = BatchLog(spark, new_folder(spark, "rising_ids"))
    rows = events.readings(spark, folder)
    for batch, part in _batches(rows, F.col("id")):
        stream, number = ("first", batch) if batch % 2 == 0 else ("second", batch // 2)
        own = part.withColumn("batch", F.lit(batch)).drop("id")
        log.write(with_row_ids(own, log.claim(stream, number)), number, stream)
    spans = log.read().groupBy("batch").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("rows"), F.count_distinct("id").alias("ids"))
    ordered = F.sort_array(F.collect_list(F.struct("batch", "low", "high")))  # one entry a batch
    spans = spans.agg(F.sum("rows").alias("rows"), F.sum("ids").alias("ids"), ordered.alias("spans"))
    return spans.select("rows", "ids", F.expr("forall(sequence(1, size(spans) - 1), k -> spans[k - 1].high < spans[k].low)").alias("rising"))


def _rolled(rows, number, name, by=()):
    """Totals of rows that came in batches, one of them twice."""
    totals = DistinctTotals(rows.sparkSession, new_folder(rows.sparkSession, "totals"), name, by)
    for batch, part in _batches(rows, number):
        for _ in range(2 if batch == 1 else 1):
            totals.add(part, batch, "plant")
    return totals.totals()


def rolled_history_totals(spark, folder):
    """The totals of the web history from roll-ups."""
    rows = web.identify(events.api_records(spark, folder))
    found = _rolled(rows, F.col("order_id").cast("long"), "sensor")
    return found.select(F.col("rows").alias("records"), F.col("names").alias("sensors"), F.least("rows", F.lit(HISTORY_ROWS).cast("long")).alias("shown"))


def rolled_zone_sensors(spark, folder):
    found = _rolled(events.predictions(spark, folder), F.col("id"), "sensor_id", ["zone"])
    return found.withColumnsRenamed({"rows": "records", "names": "sensors"})


QUERIES = {
    "read_predictions": read_stored,
    "maintained_latest_by_max_id": _maintained("latest_by_max_id", latest.latest_by_max_id),
    "maintained_latest_abnormal": _maintained("latest_abnormal", latest.latest_abnormal),
    "maintained_latest_by_time": maintained_latest_by_time,
    "stored_recent_history": stored_recent_history,
    "stored_history_by_time": stored_history_by_time,
    "rising_ids": rising_ids,
    "rolled_history_totals": rolled_history_totals,
    "rolled_zone_sensors": rolled_zone_sensors,
}
