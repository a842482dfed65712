"""Operators on hand-made rows, and properties on the given tables."""

import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from emberwatch.functions import times
from emberwatch.operators import clean, explore, freshness, history, latest, metrics, trend, web, zones
from emberwatch.operators.pruning import newest_floor
from emberwatch.plans import boards
from emberwatch.schemas import PREDICTION, RECORD_COLUMNS
from emberwatch.sources import events

NOW = datetime.datetime(2024, 1, 31)


def prediction(number, **fields):
    row = dict.fromkeys(PREDICTION.fieldNames())
    row.update(
        id=number, sensor_id="S001", zone="Phong_May", timestamp="2024-01-30 23:59:00", prediction=0,
        prediction_label="NORMAL", temperature=30.0, smoke_ppm=50.0,
    )
    row.update(fields)
    return tuple(row[name] for name in PREDICTION.fieldNames())


def table(spark, *rows):
    return spark.createDataFrame(list(rows), PREDICTION)


def ids(frame, column="id"):
    return [row[0] for row in frame.select(column).collect()]


def test_malformed_messages_are_rejected_and_counted(spark):
    good = (
        '{"sensor_id": "S1", "zone": "z", "timestamp": "2024-01-01 00:00:00", "temperature": 1, "humidity": 2,'
        ' "smoke_ppm": 3, "lpg_gas_ppm": 4, "co_gas_ppm": 5}'
    )
    texts = [good, good.replace("1,", "NaN,"), "not json", good.replace("3", '"3"'), good.replace('"zone": "z", ', ""), None]
    messages = spark.createDataFrame([(None if text is None else text.encode(),) for text in texts], "value binary")
    parsed = clean.parse_readings(clean.decode_value(messages))
    assert parsed.count() == 6
    valid = clean.validate_readings(parsed).collect()
    assert len(valid) == 2 and valid[0].temperature == 1.0 and valid[1].temperature != valid[1].temperature
    assert clean.rejected_readings(parsed).count() == 4
    quality = clean.reading_quality(parsed).first()
    assert (quality.readings, quality.complete, quality.rejected, quality.missing_zone) == (6, 2, 4, 3)


def test_nan_measure_is_missing_for_trends(spark):
    rows = table(spark, prediction(1, temperature=float("nan")), prediction(2, temperature=None), prediction(3))
    assert ids(clean.drop_missing_metric(rows, "temperature")) == [3]


def test_prepare_without_labels_and_times(spark):
    frame = spark.createDataFrame([("7", "S1", None, "x")], "id string, sensor_id string, zone string, temperature string")
    row = clean.prepare_predictions(frame).first()
    assert (row.prediction_label, row.zone, row.temperature) == ("UNKNOWN", "UNKNOWN", None)
    assert clean.select_existing(frame, ["zone", "missing", "id"]).columns == ["zone", "id"]


def test_abnormal_is_chosen_before_ranking(spark):
    early, late = "2024-01-30 10:00:00", "2024-01-30 11:00:00"
    rows = table(
        spark,
        prediction(1, sensor_id="A", timestamp=early, prediction=2),
        prediction(2, sensor_id="A", timestamp=late, prediction=0),
        prediction(3, sensor_id="B", timestamp=early, prediction=2),
        prediction(4, sensor_id="B", timestamp=late, prediction=1),
        prediction(5, sensor_id="C", timestamp=late, prediction=2),
        prediction(6, sensor_id="C", timestamp=late, prediction=1),
        prediction(7, sensor_id="C", zone="Khu_Moi", timestamp=late, prediction=1),
        prediction(8, sensor_id="D", timestamp=late, prediction=0),
    )
    assert sorted(ids(latest.latest_abnormal(rows))) == [1, 4, 6, 7]


@pytest.mark.parametrize("prune", [False, True])
def test_latest_by_id_with_and_without_bound(spark, folder, prune):
    rows = events.predictions(spark, folder)
    newest = latest.latest_by_max_id(rows, prune=prune)
    assert newest.exceptAll(latest.latest_by_max_id_join(rows)).isEmpty()
    assert newest.count() == rows.select("sensor_id").distinct().count()


def test_other_latest_rows_with_and_without_bound(spark, folder):
    rows = events.predictions(spark, folder).withColumn("timestamp", F.when(F.col("id") % 50 != 0, F.col("timestamp")))
    records = web.identify(events.api_records(spark, folder))
    for rank, frame in ((latest.latest_abnormal, rows), (latest.latest_by_time, records)):
        plain, pruned = rank(frame, prune=False), rank(frame, prune=True)
        assert sorted(ids(plain)) == sorted(ids(pruned)) and ids(plain)
    unknown = rows.withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    assert sorted(ids(latest.latest_abnormal(unknown, prune=True))) == sorted(ids(latest.latest_abnormal(unknown, prune=False)))


def test_latest_keeps_a_long_silent_sensor(spark):
    rows = table(spark, prediction(1, sensor_id="old"), *[prediction(n, sensor_id="new") for n in range(2, 50)])
    for prune in (False, True):
        assert sorted(ids(latest.latest_by_max_id(rows, prune=prune))) == [1, 49]


@pytest.mark.parametrize("n", [1, 7, 500, 5000])
def test_history_with_and_without_bound(spark, folder, n):
    rows = events.predictions(spark, folder)
    plain, pruned = history.recent_history(rows, n, prune=False), history.recent_history(rows, n, prune=True)
    assert ids(plain) == ids(pruned) and len(ids(plain)) == min(n, rows.count())
    gaps = rows.withColumn("id", F.col("id") * F.col("id") * 1000 - 5_000_000)
    assert ids(history.recent_history(gaps, n, prune=True)) == ids(history.recent_history(gaps, n, prune=False))


def test_bound_holds_for_any_bucket_width(spark, folder):
    rows = events.predictions(spark, folder)
    for bits, n in itertools.product((0, 3, 20), (1, 100)):
        kept = rows.filter(F.col("id") >= newest_floor(rows, n, F.col("id"), bits))
        assert kept.count() >= n and kept.agg(F.max("id")).first()[0] == rows.agg(F.max("id")).first()[0]
    assert rows.filter(F.col("id") >= newest_floor(rows.limit(0), 5, F.col("id"))).isEmpty()


def test_bound_reaches_the_parquet_reader(spark, folder):
    rows = events.predictions(spark, folder)
    frame = latest.latest_by_max_id(rows, prune=True)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(event_id,ScalarSubquery" in plan


def test_history_by_time_with_and_without_bound(spark, folder):
    records = web.prepare_records(events.api_records(spark, folder), NOW)
    for n in (1, 40, 5000):
        assert ids(web.history_by_time(records, n, prune=True)) == ids(web.history_by_time(records, n, prune=False))


def test_tail_with_and_without_bound(spark, folder):
    rows = events.predictions(spark, folder)
    for n in (1, 40, 5000):
        assert ids(trend.tail_by_time(rows, "temperature", n, prune=True)) == ids(trend.tail_by_time(rows, "temperature", n, prune=False))
    matching = explore.explorer_filter(rows, "Phong_May")
    assert ids(explore.explorer_page(matching, 9, prune=True)) == ids(explore.explorer_page(matching, 9, prune=False))


def test_rows_without_an_id_are_kept_by_the_bound(spark):
    rows = table(spark, prediction(1), prediction(2), prediction(3)).withColumn("id", F.when(F.col("id") < 3, F.col("id")))
    for n in (1, 2, 5):
        assert ids(history.recent_history(rows, n, prune=True)) == ids(history.recent_history(rows, n)) and len(ids(history.recent_history(rows, n))) == min(n, 3)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_bound_does_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = datetime.datetime(2024, 3, 10, 2, 30)
        rows = table(spark, prediction(1, timestamp=moment), prediction(2, timestamp=moment - datetime.timedelta(hours=5)))
        assert ids(trend.tail_by_time(rows, "temperature", 1, prune=True)) == ids(trend.tail_by_time(rows, "temperature", 1)) == [1]
        text = rows.withColumn("timestamp", F.when(F.col("id") == 1, "2024-03-10 02:30:00").otherwise("no time"))
        assert ids(trend.tail_by_time(text, "temperature", 2, prune=True)) == ids(trend.tail_by_time(text, "temperature", 2))
        parsed = spark.createDataFrame([("2024-03-10 02:30:00",)], "t string").select(times.parse_time(F.col("t")).alias("t")).first().t
        assert parsed == moment
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def fresh_table(spark, *rows):
    return freshness.add_freshness(clean.prepare_predictions(table(spark, *rows)), NOW)


def test_zone_board_states(spark):
    stale = "2024-01-30 20:00:00"
    rows = fresh_table(
        spark,
        prediction(1, sensor_id="A", zone="Phong_May", prediction_label="fire", created_at=NOW),
        prediction(2, sensor_id="B", zone="Phong_May", prediction_label="FIRE_RISK", temperature=float("nan")),
        prediction(3, sensor_id="C", zone="Khu_Bao_Tri", prediction_label="FIRE_RISK"),
        prediction(4, sensor_id="D", zone="Kho_Hoa_Chat", prediction_label="FIRE", timestamp=stale),
        prediction(5, sensor_id="E", zone="Kho_Vat_Lieu", prediction_label=None),
        prediction(6, sensor_id="F", zone="Khu_Moi", prediction_label="FIRE"),
        prediction(7, sensor_id="G", zone="Khu_Kiem_Tra", timestamp="2024-01-31 00:01:01"),
    )
    board = {row.zone: row for row in zones.zone_board(rows).collect()}
    assert len(board) == 10
    assert {zone: row.status for zone, row in board.items() if row.status != "NO_DATA"} == {
        "Phong_May": "FIRE", "Khu_Bao_Tri": "FIRE_RISK", "Kho_Hoa_Chat": "STALE", "Kho_Vat_Lieu": "OK", "Khu_Kiem_Tra": "STALE",
    }
    room = board["Phong_May"]
    assert (room.total_sensors, room.fire_sensors, room.risk_sensors, room.avg_temp) == (2, 1, 1, 30.0)
    assert (board["Kho_Hoa_Chat"].total_sensors, board["Kho_Hoa_Chat"].avg_temp) == (0, 0.0)


@pytest.mark.parametrize(
    "labels, stale, banner",
    [(["FIRE", "FIRE_RISK"], 0, "FIRE"), (["FIRE_RISK", "NORMAL"], 1, "FIRE_RISK"), (["NORMAL"], 1, "INSUFFICIENT"),
     (["NORMAL", None], 0, "INSUFFICIENT"), ([], 1, "INSUFFICIENT"), ([], 0, "INSUFFICIENT"), (["NORMAL"], 0, "OK")],
)
def test_banner(spark, labels, stale, banner):
    rows = [prediction(n, sensor_id=f"S{n}", prediction_label=label) for n, label in enumerate(labels)]
    rows += [prediction(90 + n, sensor_id=f"T{n}", prediction_label="FIRE", timestamp="2024-01-01 00:00:00") for n in range(stale)]
    assert freshness.plant_banner(fresh_table(spark, *rows)).first().banner == banner


def test_kpis_add_up(spark, folder):
    latest_rows = boards.current(events.predictions(spark, folder), NOW, 14_400)
    kpis, counts = freshness.status_kpis(latest_rows).first(), freshness.sensor_counts(latest_rows).first()
    assert kpis.unknown_count + kpis.normal_count + kpis.risk_count + kpis.fire_count == kpis.fresh_sensors == counts.fresh_sensors
    assert counts.fresh_sensors + counts.stale_sensors == counts.total_sensors
    empty = freshness.status_kpis(latest_rows.limit(0)).first()
    assert (empty.fresh_sensors, empty.pct_normal) == (0, 0.0)


def test_active_alerts_order(spark):
    stale = "2024-01-30 20:00:00"
    rows = fresh_table(
        spark,
        prediction(1, prediction_label="FIRE_RISK"),
        prediction(2, prediction_label="FIRE", timestamp=stale),
        prediction(3, prediction_label="FIRE"),
        prediction(4, prediction_label="FIRE_RISK"),
        prediction(5, prediction_label="FIRE"),
        prediction(6),
    )
    assert ids(history.active_alerts(rows)) == [5, 3, 2, 4, 1]
    assert ids(history.active_alerts(rows, 2)) == [5, 3]
    assert ids(history.by_urgency(rows), "prediction_label") == ["FIRE"] * 3 + ["FIRE_RISK"] * 2 + ["NORMAL"]


def test_trend_takes_tail_then_points(spark):
    rows = [prediction(n, timestamp=f"2024-01-30 00:{n // 2:02d}:00", temperature=float(n)) for n in range(20)]
    prepared = clean.prepare_predictions(table(spark, *rows))
    points = trend.metric_trend(prepared, "temperature", rows=7, points=3).collect()
    assert [(row.timestamp.minute, row.value) for row in points] == [(7, 14.5), (8, 16.5), (9, 18.5)]
    summary = trend.trend_reference(trend.metric_trend(prepared, "temperature", rows=7, points=3)).first()
    assert (summary.current, summary.average, summary.peak) == (18.5, 16.5, 18.5)
    assert trend.trend_reference(trend.metric_trend(prepared.limit(0), "temperature")).first().current == 0.0


def test_search_is_pattern_here_and_literal_there(spark):
    rows = table(spark, prediction(1, sensor_id="S1"), prediction(2, sensor_id="s.1"), prediction(3, sensor_id=None))
    assert ids(explore.explorer_filter(rows, text="s.1")) == [2]
    assert ids(explore.explorer_filter(rows, text="^s")) == [1, 2]
    assert ids(explore.explorer_filter(rows, text=" ")) == [1, 2, 3]
    records = spark.createDataFrame([("1", "S1"), ("2", "s.1")], "id string, sensor_id string")
    records = records.select("*", *[F.lit(None).cast("string").alias(name) for name in RECORD_COLUMNS if name not in records.columns])
    prepared = web.prepare_records(records, NOW)
    assert ids(explore.web_filter(prepared, ".")) == ["2"]
    assert ids(explore.web_filter(prepared, "chưa")) == ["1", "2"]
    row = web.web_overview(latest.latest_by_time(prepared)).first()
    assert (row.seen, row.missing, row.unknown) == (2, 48, 4)


def test_metrics_equal_the_evaluator(spark, folder):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rows = events.predictions(spark, folder).select(
        F.col("prediction").cast("double").alias("label"), ((F.col("prediction") + F.col("id") % 3) % 4).cast("double").alias("prediction")
    )
    ours = metrics.multiclass_metrics(metrics.confusion_matrix(rows)).first()
    for name, metric in [("accuracy", "accuracy"), ("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")]:
        assert ours[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(rows), abs=1e-12)


def test_zone_names_from_a_table(spark):
    rows = table(spark, prediction(1), prediction(2, zone="Khu_Moi"))
    names = {row.id: row.zone_label for row in zones.zone_display(rows, zones.zone_dimension(spark)).collect()}
    assert names == {1: "Phòng Máy", 2: "Khu_Moi"}


def test_latest_keeps_null_keys_and_ties(spark, monkeypatch):
    rows = [("A", 1, "z", 1, "2024-01-01 00:00:00"), ("A", 5, "z", 2, "2024-01-02 00:00:00"), ("A", 6, "z", 2, "2024-01-02 00:00:00")]
    rows += [(None, 2, "z", 1, None), (None, 3, None, 2, None), ("B", None, "z", 1, "2024-01-01 00:00:00")]
    frame = spark.createDataFrame(rows, "sensor_id string, id long, zone string, prediction int, time string")
    frame = frame.withColumn("timestamp", F.col("time").cast("timestamp_ntz"))
    for most in (100, 0):
        monkeypatch.setattr(latest, "BROADCAST_KEYS", most)
        assert sorted(row.id for row in latest.latest_by_max_id(frame).collect()) == [3, 6]
        assert sorted(row.id or 0 for row in latest.latest_abnormal(frame).collect()) == [0, 2, 3, 6]
