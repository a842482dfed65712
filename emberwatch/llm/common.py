"""What the operators share: tables, kept intermediate results, checked broadcasts."""

import gc
import math
import tempfile
import time
import uuid

from pyspark.sql import functions as F

#: Rows of a narrow side up to which it is broadcast; above, Spark shuffles both sides.
BROADCAST_ROWS = 200_000


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark):
    """The folder that driver and executors share; one of our own only where none is set."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="emberwatch-"))
    return context.getCheckpointDir()


def kept(frame, release=False):
    """The rows of ``frame`` as a table in the shared folder. It cuts lineage, and a lost
    executor costs nothing that was kept.

    With ``release``, the shuffle files that made the table are freed now. Nothing reads
    them any more, but Spark deletes them only when the driver collects its garbage, and
    listeners hold the finished plan for a moment longer; therefore twice, with a pause.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    for _ in range(2 if release else 0):
        gc.collect()
        time.sleep(1)
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(frame.schema).parquet(path)


def sized(frame, count=None, limit=BROADCAST_ROWS):
    """With a broadcast hint if it has at most ``limit`` rows, which a count proves."""
    count = frame.count() if count is None else count
    return F.broadcast(frame) if count <= limit else frame


def free_name(frame, wish):
    """A column name that ``frame`` does not have, whatever the case of its names."""
    taken = {name.lower() for name in frame.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def parts_for(rows, rows_per_part):
    return max(1, math.ceil(rows / rows_per_part))


def as_struct(column):
    """Null-safe key of a column: equal for nulls, which plain joins would lose."""
    return F.struct(column.isNull().alias("none"), column.alias("value"))
