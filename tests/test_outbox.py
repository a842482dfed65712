"""Messages in the order they are to be sent."""

import pytest
from pyspark.sql import functions as F

from emberwatch.streaming.outbox import Outbox, in_send_order

PART = "severity_rank int, severity string, part bigint, parts bigint, text string"


def parts(spark, fire, risk, sign):
    rows = [(0, "FIRE", n, fire, f"{sign} fire {n}") for n in range(1, fire + 1)] + [(1, "FIRE_RISK", n, risk, f"{sign} risk {n}") for n in range(1, risk + 1)]
    return spark.createDataFrame(rows, PART).repartition(5)


@pytest.fixture
def outbox(spark, tmp_path):
    return Outbox(spark, str(tmp_path / "outbox"))


def texts(frame):
    return [row.text for row in sorted(frame.collect(), key=lambda row: row.send_order)]


@pytest.mark.parametrize("fire, risk", [(3, 4), (0, 2), (2, 0)])
def test_places_have_no_gaps(spark, fire, risk):
    rows = sorted(tuple(row)[:2] + (row.part,) for row in in_send_order(parts(spark, fire, risk, "a"), 5).collect())
    assert rows == [((5 << 38) + place, rank, part) for place, (rank, part) in enumerate([(0, n + 1) for n in range(fire)] + [(1, n + 1) for n in range(risk)])]


def test_a_replay_is_not_sent_twice(spark, outbox):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        outbox.put(parts(spark, 6, 9, "a"), 0, "s")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(outbox.log.read().inputFiles()) > 1  # several files, one order
    first = texts(outbox.pending())
    assert first == [f"a fire {n}" for n in range(1, 7)] + [f"a risk {n}" for n in range(1, 10)]
    half = sorted(row.send_order for row in outbox.pending().collect())[7]
    outbox.mark_sent(half)
    outbox.put(parts(spark, 6, 9, "a"), 0, "s")
    assert texts(outbox.pending()) == first[8:]
    outbox.put(parts(spark, 1, 1, "b"), 0, "fresh checkpoint")
    outbox.put(parts(spark, 1, 0, "c"), 1, "s")
    assert texts(outbox.pending()) == [*first[8:], "b fire 1", "b risk 1", "c fire 1"]
    outbox.log.fold()
    outbox.mark_sent(half - 3)  # marks never go back
    assert texts(Outbox(spark, outbox.log.path).pending()) == [*first[8:], "b fire 1", "b risk 1", "c fire 1"]
    outbox.mark_sent(outbox.pending().agg(F.max("send_order")).first()[0])
    assert texts(outbox.pending()) == []
