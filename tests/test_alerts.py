"""Alert messages: content, numbering, and exact packing across shards."""

import random

import pytest
from pyspark.sql import functions as F

from emberwatch.operators import alerts
from emberwatch.sources import events

ROW = ("unit-7", "Phong_May", "2024-02-03 04:05:06", 71.25, 512.0, 640.0, None, 2, "FIRE", 0.875, 0.125)
SCHEMA = (
    "sensor_id string, zone string, timestamp string, temperature double, smoke_ppm double, lpg_gas_ppm double,"
    " co_gas_ppm double, prediction int, prediction_label string, probability_fire double, probability_risk double"
)


def message_of(rows):
    return alerts.alert_message(alerts.alert_index(alerts.alert_groups(rows)))


def test_one_sensor(spark):
    rows = spark.createDataFrame([ROW], SCHEMA)
    parts = alerts.alert_message_parts(message_of(rows)).collect()
    assert [(row.severity_rank, row.severity, row.part, row.parts) for row in parts] == [(0, "FIRE", 1, 1)]
    assert parts[0].text == "\n".join(
        [
            "🚨🚨🚨 CẢNH BÁO CHÁY KHẨN CẤP 🚨🚨🚨", "", "Phát hiện 1 sensor có trạng thái FIRE.",
            "Hãy kiểm tra và xử lý theo quy trình an toàn của nhà máy.", "", "🔴 SENSOR FIRE #1",
            "Sensor: unit-7", "Khu vực: Phong_May", "Thời gian: 2024-02-03 04:05:06", "Nhiệt độ: 71.25 °C", "Khói: 512 ppm",
            "LPG: 640 ppm", "CO: N/A", "Trạng thái: FIRE", "Xác suất FIRE: 87.5%", "Xác suất FIRE_RISK: 12.5%",
        ]
    )


def test_numbers_are_gapless_per_severity(spark, folder):
    rows = events.predictions(spark, folder).filter("prediction > 0")
    indexed = alerts.alert_index(alerts.alert_groups(rows)).collect()
    assert len(indexed) == rows.count()
    for rank in (0, 1):
        found = sorted(row.alert_number for row in indexed if row.severity_rank == rank)
        assert found == list(range(1, len(found) + 1))
        assert {row.sensors for row in indexed if row.severity_rank == rank} == {len(found)}


def test_order_of_input_does_not_matter(spark, folder):
    rows = events.predictions(spark, folder).filter("prediction > 0").groupBy("sensor_id", "zone").agg(F.max("prediction").alias("prediction"))
    first = alerts.alert_index(alerts.alert_groups(rows)).select("sensor_id", "alert_number")
    second = alerts.alert_index(alerts.alert_groups(rows.orderBy(F.rand(3)))).select("sensor_id", "alert_number")
    assert first.exceptAll(second).isEmpty()


def blocks(spark, texts):
    """A message made of given block texts, the first being the header."""
    rows = [(0, "FIRE", len(texts) - 1, place, text) for place, text in enumerate(texts)]
    return spark.createDataFrame(rows, "severity_rank int, severity string, sensors bigint, block bigint, text string")


def packed(spark, texts, limit, shard, fan=8):
    rows = alerts.alert_message_parts(blocks(spark, texts), limit, shard, fan).orderBy("part").collect()
    assert [row.part for row in rows] == list(range(1, len(rows) + 1))
    assert {row.parts for row in rows} == {len(rows)}
    if len(rows) == 1:
        return [rows[0].text]
    for row in rows:
        assert row.text.startswith(f"📨 CẢNH BÁO PHẦN {row.part}/{len(rows)}\n\n")
    return [row.text.split("\n\n", 1)[1] for row in rows]


def check_greedy(parts, lines, limit):
    """Parts hold all lines in order, none could have taken one more, and none begins blank."""
    place = 0
    for number, part in enumerate(parts):
        assert 0 < len(part) <= limit
        while lines[place] == "":
            place += 1
        for line in part.split("\n"):
            assert lines[place] == line
            place += 1
        if number + 1 < len(parts):
            assert len(part) + 1 + len(lines[place]) > limit
    assert all(line == "" for line in lines[place:])


def test_packing_is_greedy_and_the_same_for_any_shard_size(spark):
    source = random.Random(5)
    for limit in (100, 137):
        texts = []
        for _ in range(90):
            texts.append("\n".join("x" * source.choice([0, 1, 9, 30, 70, 99, 100]) for _ in range(source.randint(1, 5))) + "\n")
        texts[-1] = "end\n"
        lines = "\n".join(texts).rstrip("\n").split("\n")
        whole = packed(spark, texts, limit, 10_000)
        check_greedy(whole, lines, limit)
        for shard, fan in ((1, 3), (7, 2), (40, 8)):
            assert packed(spark, texts, limit, shard, fan) == whole


def test_long_lines_are_cut_and_short_limits_raised(spark):
    parts = packed(spark, ["h\n", "y" * 250 + "\n", "end\n"], 10, 10_000)
    assert [len(part) for part in parts] == [2, 100, 100, 55]
    assert "".join(parts).replace("\n", "") == "h" + "y" * 250 + "end"


def test_blank_line_at_the_start_of_a_part_vanishes(spark):
    parts = packed(spark, ["a" * 100 + "\n", "b" * 5 + "\n"], 100, 10_000)
    assert parts == ["a" * 100, "b" * 5]


@pytest.mark.parametrize("shard", [2, 50_000])
def test_real_messages_keep_every_sensor(spark, folder, shard):
    rows = events.predictions(spark, folder).filter("prediction > 0").withColumn("timestamp", F.lit("2024-01-30 10:00:00"))
    message = message_of(rows)
    parts = alerts.alert_message_parts(message, shard_sensors=shard).collect()
    for rank in (0, 1):
        mine = sorted((row.part, row.text) for row in parts if row.severity_rank == rank)
        texts = [text.split("\n\n", 1)[1] if len(mine) > 1 else text for _, text in mine]
        expected = "\n".join(row.text for row in message.filter(F.col("severity_rank") == rank).orderBy("block").collect())
        check_greedy(texts, expected.rstrip("\n").split("\n"), 3440)


def test_no_rows_no_messages(spark):
    assert alerts.alert_message_parts(message_of(spark.createDataFrame([], SCHEMA))).isEmpty()
