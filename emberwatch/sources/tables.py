"""The prediction table, as files or over JDBC."""

import itertools

from pyspark.sql import functions as F

from emberwatch import schemas
from emberwatch.sources.batches import BatchLog, batch_folder, stream_identity


def read_predictions(spark, path, fmt="parquet"):
    """The fixed columns of a prediction table stored as files; nothing else is read.

    A table that has a log is read by it, others by listing their folder.
    """
    log = BatchLog(spark, path)
    if fmt == "parquet" and log.exists():
        return log.read().select(*schemas.PREDICTION_COLUMNS)
    return spark.read.format(fmt).load(path).select(*schemas.PREDICTION_COLUMNS)


def jdbc_options(url, table, properties=None, partition=None):
    """Options of a JDBC read. ``partition`` = (column, lower, upper, number) reads in parallel.

    Without it one task reads the whole table, which only suits a small one.
    """
    options = {"url": url, "dbtable": table, **(properties or {})}
    if partition is not None:
        column, lower, upper, number = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(number),
        }
    return options


def read_predictions_jdbc(spark, url, table, properties=None, partition=None):
    """The prediction table of a database; column pruning and filters reach the database."""
    options = jdbc_options(url, table, properties, partition)
    return spark.read.format("jdbc").options(**options).load().select(*schemas.PREDICTION_COLUMNS)


def append_predictions_jdbc(frame, url, table, properties=None):
    """Append the stored columns. A replayed batch is appended again: JDBC has no batch commit.

    Use ``once.append_predictions_once`` or ``BatchLog.write`` where a batch must count once.
    """
    frame.select(*schemas.SCORED_COLUMNS).write.jdbc(url=url, table=table, mode="append", properties=properties or {})


def write_batch(frame, path, batch_id):
    """Write one micro-batch to its own folder, replacing what an earlier try left there.

    The folder depends on the stream's identity and the batch, so a replay after a lost
    driver or executor cannot duplicate rows, and a stream with a fresh checkpoint cannot
    replace what another one stored. Readers see ``stream``, ``batch_group`` and
    ``batch_id`` as partition columns.
    """
    frame.write.mode("overwrite").parquet(batch_folder(path, batch_id, stream_identity(frame.sparkSession)))


def with_row_ids(frame, number):
    """Adds ``id``: 25 bits of the batch's number, 38 of the row's place in it.

    ``BatchLog.claim`` gives numbers that rise over all streams that write a table.

    Places are dense: a task's rows follow those of the tasks before, whose numbers of rows
    are counted first, so it does not matter how a batch is dealt over tasks. ``frame`` has to
    give the same rows to the same tasks again, as a persisted batch does; else it fails
    rather than reuse a number.
    """
    if number >= 1 << 25:
        raise ValueError("number of the batch too large for row ids")
    task = F.spark_partition_id()
    counts = sorted(tuple(row) for row in frame.groupBy(task.alias("task")).count().collect())  # one row a task
    ends = list(itertools.accumulate(count for _, count in counts))
    if ends and ends[-1] > 1 << 38:
        raise ValueError("batch too large for row ids")
    places = [(number, end - count, count) for (number, count), end in zip(counts, ends)]
    offsets = frame.sparkSession.createDataFrame(places, "id_task int, id_offset long, id_count long")
    local = F.monotonically_increasing_id() - F.shiftleft(task.cast("long"), 33)
    rows = frame.select(F.struct(*frame.columns).alias("id_data"), task.alias("id_task"), local.alias("id_row"))
    joined = rows.join(F.broadcast(offsets), "id_task", "left")
    packed = F.lit(number << 38) + F.col("id_offset") + F.col("id_row")
    numbered = F.when(F.col("id_row") < F.col("id_count"), packed).otherwise(F.raise_error(F.lit("rows of a task changed while they were numbered")))
    kept = [F.col("id_data")[name].alias(name) for name in frame.columns if name.lower() != "id"]
    return joined.select(*kept, numbered.alias("id"))


def write_alert_csv(frame, path):
    """Alert log as CSV with a header and a UTF-8 byte order mark at the start of every file.

    The mark is part of the first heading, so each part file opens with it.
    """
    first, *rest = frame.columns
    frame.toDF("﻿" + first, *rest).write.mode("overwrite").option("header", True).csv(path)


def alert_csv_name(moment):
    """Dated folder name of an export."""
    return f"alerts_{moment:%Y%m%d_%H%M%S}.csv"
