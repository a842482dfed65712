"""Appending each batch once to a database in a file."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from emberwatch.sources import once
from emberwatch.sources.once import Database, Staged, append_once


@pytest.fixture
def target(tmp_path):
    return {"module": "sqlite3", "connect": {"database": str(tmp_path / "plant.db"), "timeout": 120}, "table": "predictions"}


def stored(target, table="predictions"):
    with sqlite3.connect(target["connect"]["database"]) as connection:
        return sorted(connection.execute(f"SELECT * FROM {table}").fetchall(), key=str)


def frame(spark, low, high, tasks=3):
    return spark.range(low, high, 1, tasks).select("id", F.concat(F.lit("S"), "id").alias("sensor_id"), (F.col("id") / 4).alias("humidity"), F.when(F.col("id") % 3 > 0, F.col("id").cast("int")).alias("prediction"))


def test_a_replayed_batch_counts_once(spark, target):
    for batch in (0, 1, 1, 0):
        append_once(frame(spark, batch * 100, batch * 100 + 50), **target, stream="s", batch_id=batch)
    append_once(frame(spark, 900, 901), **target, stream="another", batch_id=0)
    wanted = [tuple(row) for low, high in ((0, 50), (100, 150), (900, 901)) for row in frame(spark, low, high).collect()]
    assert stored(target) == sorted(wanted, key=str)
    assert stored(target, "predictions_staged") == []
    assert stored(target, "predictions_batches") == [("another", 0), ("s", 0), ("s", 1)]


def test_a_half_written_batch_counts_once(spark, target):
    broken = frame(spark, 0, 3000).withColumn("humidity", F.when(F.col("id") == 2990, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("humidity")))
    with pytest.raises(Exception, match="lost"):
        append_once(broken, **target, stream="s", batch_id=0)
    assert stored(target) == [] and stored(target, "predictions_batches") == []
    # a driver that dies before it can abort leaves staged rows behind
    database = Database(**target, columns=["id", "sensor_id", "humidity", "prediction"])
    database.stage("dead:1", "s", 0, [[(1, "X", 0.5, None)]])
    append_once(frame(spark, 0, 3000), **target, stream="s", batch_id=0)
    assert len(stored(target)) == 3000 and stored(target, "predictions_staged") == []


def test_attempts_that_spark_does_not_name_are_not_moved(spark, target):
    append_once(frame(spark, 0, 0), **target, stream="s", batch_id=0)
    database = Database(**target, columns=["id", "sensor_id", "humidity", "prediction"])
    database.stage("run:1", "s", 1, [[(1, "A", 0.5, 1)], [(2, "A", 0.5, 1)]])
    database.stage("run:2", "s", 1, [[(1, "A", 0.5, 1)]])  # the same task, repeated and cut off
    database.commit("s", 1, [Staged("run:1", 2)])
    assert [row[0] for row in stored(target)] == [1, 2]
    database.stage("run:3", "s", 2, [[(3, "A", 0.5, 1)]])
    with pytest.raises(RuntimeError, match="1 of 2"):
        database.commit("s", 2, [Staged("run:3", 2)])
    assert [row[0] for row in stored(target)] == [1, 2] and ("s", 2) not in stored(target, "predictions_batches")
    database.abort("run")
    assert stored(target, "predictions_staged") == []


def test_what_is_not_supported_is_refused(spark, target):
    with pytest.raises(ValueError, match="kinds"):
        append_once(spark.range(1).select(F.current_timestamp().alias("t")), **target, stream="s", batch_id=0)
    with pytest.raises(ValueError, match="plain name"):
        append_once(frame(spark, 0, 1), **{**target, "table": "a; DROP"}, stream="s", batch_id=0)
    append_once(frame(spark, 0, 1), **target, stream="s", batch_id=0)
    with pytest.raises(Exception, match="only appends"):
        frame(spark, 0, 1).write.format("append_once").options(module="sqlite3", connect="{}", table="t", stream="s", batch="0").mode("overwrite").save()


def test_scored_columns(spark, target):
    from emberwatch import schemas

    row = tuple({"string": "x", "double": 0.5, "integer": 2, "long": 7}.get(field.dataType.typeName()) for field in schemas.PREDICTION)
    rows = spark.createDataFrame([row], schemas.PREDICTION)
    once.append_predictions_once(rows, **target, stream="s", batch_id=3)
    assert len(stored(target)) == 1 and len(stored(target)[0]) == len(schemas.SCORED_COLUMNS)
