"""Files, payloads and the batch table."""

import datetime
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from emberwatch import schemas
from emberwatch.operators.clean import preview
from emberwatch.plans import boards
from emberwatch.sources import events, payload, readings, tables

READING = {
    "sensor_id": "S1", "zone": "Phong_May", "timestamp": "2024-05-06 07:08:09",
    "temperature": 31.25, "humidity": 47.5, "smoke_ppm": 12.0, "lpg_gas_ppm": 7.5, "co_gas_ppm": 3.0,
}


def test_messages_from_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text(json.dumps(READING) + "\nnot json\n", encoding="utf8")
    parsed = readings.readings_of(readings.read_reading_batch(spark, "text", str(tmp_path)))
    assert [row.sensor_id for row in parsed.orderBy("sensor_id").collect()] == [None, "S1"]
    assert parsed.columns == schemas.READING_COLUMNS


def test_kafka_options():
    assert readings.kafka_options("host:9092", "topic", maxOffsetsPerTrigger="1000") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "topic", "startingOffsets": "latest", "maxOffsetsPerTrigger": "1000",
    }


def test_json_documents_over_several_lines(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(READING, indent=2), encoding="utf8")
    row = readings.read_reading_json(spark, str(tmp_path)).first()
    assert row.asDict() == READING


def test_training_csv(spark, tmp_path):
    names = [*schemas.READING_COLUMNS, "label"]
    values = [str(READING[name]) for name in schemas.READING_COLUMNS] + ["2"]
    (tmp_path / "rows.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n", encoding="utf8")
    fixed = readings.read_training_csv(spark, str(tmp_path))
    assert fixed.schema == schemas.TRAINING and fixed.first().label == 2
    inferred = readings.read_training_csv(spark, str(tmp_path), infer=True).first()
    assert (inferred.label, inferred.temperature) == (2, 31.25)


def test_load_frame(spark):
    frame = readings.range_load_frame(spark, 10_000)
    assert frame.count() == 10_000 and frame.columns == schemas.READING_COLUMNS
    row = frame.filter("sensor_id = 'S7'").orderBy("smoke_ppm", "temperature").first()
    assert (row.temperature, row.smoke_ppm) == (37.0, 57.0)
    from emberwatch.functions.labels import threshold_label

    labels = frame.groupBy(threshold_label(F.col("temperature"), F.col("smoke_ppm")).alias("label")).count().collect()
    assert {row.label: row["count"] for row in labels} == {"FIRE": 3660, "FIRE_RISK": 4750, "NORMAL": 1590}


def records(spark, *documents):
    texts = [(document if isinstance(document, str) else json.dumps(document),) for document in documents]
    return [row.sensor_id for row in payload.records_of(spark.createDataFrame(texts, "value string")).collect()]


def test_payload_shapes(spark):
    one, two = [{"sensor_id": "A", "temperature": 1}], [{"sensor_id": "B", "temperature": "x", "more": {"deep": 1}}]
    assert records(spark, one) == ["A"]
    assert records(spark, {"data": one, "sensors": two}) == ["A"]
    assert records(spark, {"sensors": two, "results": one}) == ["B"]
    assert records(spark, {"results": two}) == ["B"]
    assert records(spark, {"data": {"sensor_id": "no"}, "sensors": two}) == ["B"]
    assert records(spark, {"data": [], "sensors": two, "error": "late"}) == []
    assert records(spark, {"message": "nothing"}, "[]", "null", "7") == []
    assert records(spark, {"data": one, "error": "ignored"}) == ["A"]
    with pytest.raises(PySparkException, match="backend away"):
        records(spark, {"error": "backend away"})
    assert records(spark, {"data": "text", "error": ""}) == []


def test_payload_files_are_read_whole(spark, tmp_path):
    rows = [{"sensor_id": f"S{n}", "id": n} for n in range(300)]
    (tmp_path / "a.json").write_text(json.dumps({"data": rows}, indent=1), encoding="utf8")
    (tmp_path / "b.json").write_text(json.dumps(rows[:5]), encoding="utf8")
    frame = payload.read_api_payload(spark, str(tmp_path))
    assert frame.count() == 305 and frame.columns == schemas.RECORD_COLUMNS
    assert {row.id for row in frame.filter("sensor_id = 'S7'").collect()} == {"7"}


def test_prediction_table_round_trip(spark, folder, tmp_path):
    rows = events.predictions(spark, folder)
    tables.write_batch(rows, str(tmp_path / "table"), 3)
    tables.write_batch(rows.limit(10), str(tmp_path / "table"), 2881)
    tables.write_batch(rows, str(tmp_path / "table"), 3)
    stored = tables.read_predictions(spark, str(tmp_path / "table"))
    assert stored.columns == schemas.PREDICTION_COLUMNS
    assert stored.count() == rows.count() + 10
    assert (tmp_path / "table" / "stream=none" / "batch_group=1" / "batch_id=2881").is_dir()


def test_row_ids_grow_with_batches(spark):
    frame = spark.range(0, 100, 1, 8)
    first = [row.id for row in tables.with_row_ids(frame, 6).collect()]
    second = [row.id for row in tables.with_row_ids(frame, 7).collect()]
    assert len(set(first + second)) == 200 and max(first) < min(second)
    with pytest.raises(Exception, match="too large"):
        tables.with_row_ids(frame, 1 << 25).collect()


def test_row_ids_of_a_large_task(spark):
    rows = (1 << 24) + 5  # more than a task could number before
    frame = spark.range(0, rows, 1, 1).select(F.lit(1).alias("x")).unionAll(spark.range(0, 7, 1, 3).select(F.lit(2)))
    ids = tables.with_row_ids(frame, 3).agg(F.count("id"), F.min("id"), F.max("id")).first()
    assert tuple(ids) == (rows + 7, 3 << 38, (3 << 38) + rows + 6)
    few = tables.with_row_ids(spark.range(0, 100, 1, 9).filter("id % 20 > 3").withColumnRenamed("id", "task"), 0)
    assert few.columns == ["task", "id"] and sorted(row.id for row in few.collect()) == list(range(80))
    assert tables.with_row_ids(spark.range(0).withColumnRenamed("id", "x"), 1).count() == 0


def test_alert_csv_opens_with_a_mark(spark, folder, tmp_path):
    log = boards.incident_log(boards.recent(events.predictions(spark, folder), "2024-01-31 00:00:00"))
    tables.write_alert_csv(log, str(tmp_path / "log"))
    files = list((tmp_path / "log").glob("*.csv"))
    assert files
    for file in files:
        assert file.read_bytes().startswith("﻿ID,Sensor,Khu Vực".encode())
    assert tables.alert_csv_name(datetime.datetime(2024, 1, 2, 3, 4, 5)) == "alerts_20240102_030405.csv"


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:x", "t", {"user": "u"}, ("id", 0, 100, 4)) == {
        "url": "jdbc:x", "dbtable": "t", "user": "u",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }


def test_preview(spark):
    assert preview(spark.range(50)).count() == 10 and preview(spark.range(50), 60).count() == 50
