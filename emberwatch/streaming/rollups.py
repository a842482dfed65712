"""Counts of rows and distinct names that grow batch by batch and stay exact.

Every name gets a number, once and for all. A batch is rolled up to bitmaps of the numbers it
holds, 32,768 to a bitmap; bitmaps of batches are joined by OR, so totals over any number of
batches read the roll-ups alone. Dictionary and roll-ups are logged tables: a replayed batch counts
once, wherever its first try ended.
"""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from emberwatch.sources.batches import BatchLog, stream_identity
from emberwatch.sources.tables import with_row_ids


def _no_zones(rows):
    return F.lit(None).cast("long"), F.lit(None).cast("timestamp_ntz")


class DistinctTotals:
    """Roll-ups at ``path`` of the names in one column, by the columns ``by``."""

    def __init__(self, spark, path, name="sensor", by=()):
        self.spark, self.name, self.by = spark, name, list(by)
        self.names, self.bitmaps = BatchLog(spark, f"{path}/names"), BatchLog(spark, f"{path}/bitmaps")

    def _dictionary(self):
        """Name and number; empty before the first batch."""
        if self.names.files()[0].isEmpty():
            return self.spark.createDataFrame([], "name string, id long")
        return self.names.read()

    def _learn(self, rows, batch_id, stream):
        """Numbers for names not met before. Numbers rise by batch, without gaps within one."""
        found = rows.select(F.col(self.name).cast("string").alias("name")).filter("name IS NOT NULL").distinct()
        new = found.join(self._dictionary(), "name", "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.names.write(with_row_ids(new, self.names.claim(stream, batch_id)), batch_id, stream, _no_zones)
        finally:
            new.unpersist()

    def add(self, rows, batch_id, stream=None):
        """Roll up one batch. Rows without a name count as rows only."""
        stream = stream_identity(self.spark) if stream is None else stream
        if self.bitmaps.is_stored(stream, batch_id):
            return
        if not self.names.is_stored(stream, batch_id):
            self._learn(rows, batch_id, stream)
        # one row for each name of the batch, so a frequent name is no heavier in the join
        counts = rows.groupBy(*self.by, F.col(self.name).cast("string").alias("name")).agg(F.count("*").alias("rows"))
        numbered = counts.join(self._dictionary(), "name", "left")
        bucket = F.bitmap_bucket_number("id").alias("bucket")
        rolled = numbered.groupBy(*self.by, bucket).agg(F.sum("rows").alias("rows"), F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))
        self.bitmaps.write(rolled, batch_id, stream, _no_zones)

    def totals(self, by=None):
        """Rows and distinct names over all batches, by some of the columns of the roll-ups."""
        by = self.by if by is None else list(by)
        joined = self.bitmaps.read().groupBy(*by, "bucket").agg(F.sum("rows").alias("rows"), F.bitmap_or_agg("bitmap").alias("bitmap"))
        met = F.when(F.col("bucket").isNotNull(), F.bitmap_count("bitmap")).otherwise(F.lit(0))
        return joined.groupBy(*by).agg(F.sum("rows").alias("rows"), F.sum(met).alias("names"))
