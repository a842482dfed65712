"""The three streams: history, scores on the console, scores with alerts."""

import functools

from pyspark import StorageLevel
from pyspark.sql import functions as F

from emberwatch.constants import TRIGGER
from emberwatch.functions.times import parse_time
from emberwatch.ml.training import label_scores, score
from emberwatch.operators import alerts
from emberwatch.operators.clean import prediction_projection, scorable_readings, unscorable_readings
from emberwatch.operators.history import abnormal_only
from emberwatch.operators.latest import latest_abnormal
from emberwatch.schemas import PREDICTION_COLUMNS
from emberwatch.sources.batches import BatchLog, stream_identity
from emberwatch.sources.once import append_predictions_once
from emberwatch.sources.tables import append_predictions_jdbc, with_row_ids, write_batch
from emberwatch.streaming.outbox import Outbox


def _trigger(writer, every=None, once=False):
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def write_history_stream(readings, path, checkpoint, every=None, once=False):
    """Append parsed readings to Parquet, foldered by day so that later reads can skip days."""
    dated = readings.withColumn("date", F.to_date(parse_time(F.col("timestamp"))))
    writer = dated.writeStream.format("parquet").outputMode("append").partitionBy("date")
    return _trigger(writer.option("path", path).option("checkpointLocation", checkpoint), every, once).start()


def stream_score(model, readings):
    """Scores inside the streaming plan; nothing is kept between batches."""
    return prediction_projection(score(model, readings))


def write_console_stream(scored, checkpoint, fmt="console", name=None, every=None, once=False):
    """Show scored readings, ten per batch, not cut off."""
    writer = scored.writeStream.format(fmt).outputMode("append")
    writer = writer.option("truncate", "false").option("numRows", 10).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, every, once).start()


def write_alerts(abnormal, alerts_path, batch_id):
    """Put the alert messages of the abnormal rows of one batch into the outbox at ``alerts_path``.

    Numbering and packing go over the newest rows several times, so these are kept meanwhile.
    """
    newest = latest_abnormal(abnormal).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        message = alerts.alert_message(alerts.alert_index(alerts.alert_groups(newest)))
        Outbox(abnormal.sparkSession, alerts_path).put(alerts.alert_message_parts(message), batch_id)
    finally:
        newest.unpersist()


class FileSink:
    """Sink that stores each batch once in the logged table at ``path``, whatever is replayed."""

    def __init__(self, path):
        self.path = path

    def __call__(self, rows, batch_id):
        BatchLog(rows.sparkSession, self.path).write(rows.select(*PREDICTION_COLUMNS), batch_id)


def file_sink(path):
    return FileSink(path)


def jdbc_sink(url, table, properties=None):
    """Sink that appends to a database table, which numbers and dates the rows itself.

    A replayed batch is appended again; ``DatabaseSink`` appends it once.
    """
    def write(rows, batch_id):
        append_predictions_jdbc(rows, url, table, properties)

    return write


class DatabaseSink:
    """Sink that appends each batch to a database table once; see ``once.append_once``."""

    def __init__(self, module, connect, table):
        self.module, self.connect, self.table = module, connect, table

    def __call__(self, rows, batch_id):
        append_predictions_once(rows, self.module, self.connect, self.table, stream_identity(rows.sparkSession), batch_id)


def process_batch(batch, batch_id, model, sink, alerts_path, rejected_path=None):
    """Score one micro-batch, store it, and write the alert messages it calls for.

    Rows that cannot be scored (a field missing, or NaN) don't stop the others; they are
    written with their reason to ``rejected_path``, by default beside the alerts.

    The scored batch is kept while both outputs are made of it, so sources and model run
    once. Messages are put in the order they are to be sent: FIRE before FIRE_RISK.
    """
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rejected = unscorable_readings(batch)
        if not rejected.isEmpty():
            write_batch(rejected, rejected_path or f"{alerts_path}_rejected", batch_id)
        good = scorable_readings(batch)
        if not good.isEmpty():
            _store_scored(good, batch_id, model, sink, alerts_path)
    finally:
        batch.unpersist()


def _store_scored(batch, batch_id, model, sink, alerts_path):
    scored = label_scores(score(model, batch)).withColumn("prediction", F.col("prediction").cast("int"))
    # ids rise with the numbers that batches claim, over all streams that write the same table
    log = BatchLog(batch.sparkSession, getattr(sink, "path", f"{alerts_path}_ids"))
    rows = with_row_ids(scored, log.claim(stream_identity(batch.sparkSession), batch_id)).withColumn("created_at", F.localtimestamp())
    rows = rows.select(*PREDICTION_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sink(rows, batch_id)
        abnormal = abnormal_only(rows)
        if not abnormal.isEmpty():
            write_alerts(abnormal, alerts_path, batch_id)
    finally:
        rows.unpersist()


def run_scoring_stream(readings, model, sink, alerts_path, checkpoint, every=TRIGGER, once=False, rejected_path=None):
    """Validate, score, store and alert, batch by batch; see ``process_batch``."""
    handler = functools.partial(process_batch, model=model, sink=sink, alerts_path=alerts_path, rejected_path=rejected_path)
    writer = readings.writeStream.foreachBatch(handler).outputMode("append")
    return _trigger(writer.option("checkpointLocation", checkpoint), every, once).start()
