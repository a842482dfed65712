"""Alert messages in the order they are to be sent, and how far sending has come.

``send_order`` rises over batches and streams: it is made of the number that a batch claims and the
place of the message in it, FIRE before FIRE_RISK. Within a batch places have no gaps. A batch is
stored once, so a replay brings nothing new, and what is marked as sent is not pending again.
"""

from pyspark.sql import functions as F

from emberwatch.sources.batches import BatchLog, stream_identity

_PLACE_BITS = 38
_SENT = "sent"


def _zones(messages):
    return F.col("send_order"), F.lit(None).cast("timestamp_ntz")


def in_send_order(parts, number):
    """Adds ``send_order`` to the parts of the messages of one batch.

    Parts are numbered within their severity, so the counts of the severities before, one row
    each, are all that is added; no task sees all messages.
    """
    counts = parts.groupBy("severity_rank").agg(F.max("parts").alias("parts"))
    ranks = F.broadcast(counts.select(F.col("severity_rank").alias("other"), F.col("parts").alias("ahead")))
    earlier = parts.select("severity_rank").distinct().join(ranks, F.col("other") < F.col("severity_rank"), "left")
    offsets = earlier.groupBy("severity_rank").agg(F.coalesce(F.sum("ahead"), F.lit(0)).alias("offset"))
    placed = parts.join(F.broadcast(offsets), "severity_rank")
    order = F.lit(number << _PLACE_BITS) + F.col("offset") + F.col("part") - 1
    return placed.select(order.cast("long").alias("send_order"), *parts.columns)


class Outbox:
    """The messages stored at ``path``."""

    def __init__(self, spark, path):
        self.spark, self.log = spark, BatchLog(spark, path)

    def put(self, parts, batch_id, stream=None):
        """Store the messages of one batch, as rows of ``alerts.alert_message_parts``."""
        stream = stream_identity(self.spark) if stream is None else stream
        if not self.log.is_stored(stream, batch_id):
            messages = in_send_order(parts, self.log.claim(stream, batch_id))
            self.log.write(messages.orderBy("send_order"), batch_id, stream, _zones)

    def pending(self):
        """Messages that are not marked as sent; the caller sends them by rising ``send_order``."""
        sent = self.log.marked(_SENT)
        return self.log.read_range(low=sent + 1, by="id").filter(F.col("send_order") > sent)

    def mark_sent(self, send_order):
        """All messages up to this one are sent."""
        self.log.mark(_SENT, send_order)
