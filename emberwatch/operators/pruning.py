"""A first pass over the key columns that prunes the read of full rows.

Questions about the newest rows of an append-only table need a few rows out of very
many. With ``prune=True`` the operators read only the key columns first, derive the lowest
key that can still matter, and read the full rows from there: Spark evaluates the bound
as a scalar subquery before the scan and hands it to the Parquet reader, which skips the
row groups below it. Rows without a key are never cut off, so both ways return the same
rows. It pays where the newest rows lie together at the end of a large table, and costs a
second pass where they don't; the caller knows which, the size of the table does not tell.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch.functions.times import as_time

_BUCKET_BITS = 20


def latest_floor(frame, keys, order):
    """Lowest of the highest ``order`` values per key: no latest row lies below it."""
    return frame.groupBy(*keys).agg(F.max(order).alias("newest")).agg(F.min("newest")).scalar()


def newest_floor(frame, n, order, bits=_BUCKET_BITS, restore=lambda floor: floor):
    """A value at or below the ``n``-th highest whole number ``order``.

    Rows are counted per bucket of 2**bits values with map-side combine. Every counted
    bucket holds a row, so the highest ``n`` buckets hold at least the ``n`` rows wanted,
    and the running count over them touches at most ``n`` rows. ``restore`` turns the
    number back into what the table stores, so that the reader can use the bound.
    """
    bucket = F.shiftright(order.cast("bigint"), bits).alias("bucket")
    counts = frame.select(bucket).filter("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("rows"))
    top = counts.orderBy(F.desc("bucket")).limit(n)
    earlier = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    return (
        top.withColumn("before", before)
        .filter(F.col("before") < n)
        .agg(restore(F.shiftleft(F.min("bucket"), bits)))
        .scalar()
    )


_EPOCH = "1970-01-01"


def newest_floor_by_time(frame, n, name):
    """As ``newest_floor`` for the time column ``name``; buckets of 2**10 seconds.

    Times without zone are counted and restored without any zone, those with one as instants.
    """
    if frame.schema[name].dataType.typeName() == "timestamp":
        return newest_floor(frame, n, F.unix_seconds(name), 10, F.timestamp_seconds)
    epoch, time = F.lit(_EPOCH).cast("timestamp_ntz"), as_time(frame, name)
    days = F.datediff(time.cast("date"), F.lit(_EPOCH).cast("date")).cast("bigint")  # differences of times would go by the zone
    second = days * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    return newest_floor(frame, n, second, 10, lambda floor: F.timestamp_add("SECOND", floor, epoch))


def from_floor(key, floor):
    """Rows at or above the bound, and those without a key."""
    return (key >= floor) | key.isNull()
