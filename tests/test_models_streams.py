"""Models, and the streams that use them."""

import json
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from emberwatch.constants import FEATURES
from emberwatch.ml import grid, training
from emberwatch.operators.metrics import confusion_matrix, multiclass_metrics
from emberwatch.plans import boards
from emberwatch.schemas import READING_COLUMNS
from emberwatch.sources import readings, tables
from emberwatch.streaming import jobs

# Means of the three classes, in feature order, and a common relative spread.
CENTRES = {0: (29, 65, 80, 140, 18), 1: (42, 52, 250, 650, 90), 2: (62, 40, 520, 800, 170)}


def sample(n, seed):
    source = random.Random(seed)
    for number in range(n):
        label = number % 3
        yield (number, *[source.gauss(mean, mean * 0.12) for mean in CENTRES[label]], label)


@pytest.fixture(scope="module")
def labelled(spark):
    names = ", ".join(f"{name} double" for name in FEATURES)
    return spark.createDataFrame(list(sample(1800, 1)), f"id bigint, {names}, label int").cache()


@pytest.fixture(scope="module")
def model(spark, labelled):
    return training.train("DT2", training.training_rows(labelled))


def test_grid_is_complete():
    settings = grid.configurations()
    assert list(settings) == [f"{family}{n}" for family in ("RF", "DT", "LR") for n in (1, 2, 3, 4)]
    assert settings["RF3"] == {"family": "random forest", "trees": 150, "depth": 10}
    forest = grid.pipeline("RF3").getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (150, 10, 42)
    assert len(grid.pipeline("LR3").getStages()) == 3 and grid.pipeline("LR3").getStages()[-1].getElasticNetParam() == 0.5
    assert grid.pipeline("DT3").getStages()[-1].getMinInstancesPerNode() == 2


def test_splits(labelled):
    train_rows, test_rows = training.split_by_key(labelled)
    assert (train_rows.count(), test_rows.count()) == (1440, 360)
    left, right = training.split_by_hash(labelled, ["id"])
    assert left.count() + right.count() == 1800 and 250 < right.count() < 470
    again = training.split_by_hash(labelled.repartition(3), ["id"])[1]
    assert again.select("id").exceptAll(right.select("id")).isEmpty()
    first, second = training.split_train_test(labelled)
    assert first.count() + second.count() == 1800


def test_leaderboard_and_choice(spark, labelled, tmp_path):
    rows = training.training_rows(labelled), training.training_rows(labelled.filter("id % 5 = 0"))
    board = training.model_leaderboard(spark, *rows, ["RF1", "DT1", "LR1"], save_to=str(tmp_path / "models"))
    found = {row.model: row for row in board.collect()}
    assert set(found) == {"RF1", "DT1", "LR1"}
    assert min(row.accuracy for row in found.values()) > 0.9
    assert found["LR1"].settings == {"iterations": "50", "regularisation": "0.1", "elastic": "0.0"}
    assert training.pick_model(board).count() == 1
    models = {name: training.load_model(str(tmp_path / "models" / name.lower())) for name in ("DT1", "RF1")}
    cells = training.confusion_of_all(models, rows[1])
    for name, model in models.items():
        own = cells.filter(F.col("model") == name).drop("model").orderBy("label", "prediction")
        assert own.collect() == training.evaluate(model, rows[1]).collect()
    assert (tmp_path / "models" / "rf1").is_dir()


def test_fits_side_by_side_are_those_alone(labelled):
    rows = training.training_rows(labelled)
    fitted = training.fit_all(["DT1", "DT2", "LR1"], rows, at_once=3)
    assert list(fitted) == ["DT1", "DT2", "LR1"]
    for name, (model, seconds) in fitted.items():
        alone = training.train(name, rows)
        assert seconds > 0 and training.evaluate(model, rows).collect() == training.evaluate(alone, rows).collect()


def test_many_rows_are_spread_evenly(spark, monkeypatch):
    """One full part and empty ones become a part for each core; few rows and more parts stay."""
    cores = spark.sparkContext.defaultParallelism
    assert cores > 1
    names = [F.rand(place).alias(name) for place, name in enumerate(FEATURES)]
    rows = spark.range(0, 4000, 1, 4).select(*names, (F.col("id") % 2).cast("int").alias("label"))
    uneven = rows.unionAll(rows.limit(0)).coalesce(1)
    assert training.spread(uneven) is uneven
    monkeypatch.setattr(training, "ROWS_PER_CORE", 4000 // cores)
    sizes = [row["count"] for row in training.spread(uneven).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == cores and max(sizes) - min(sizes) <= 1 and sum(sizes) == 4000
    assert training.spread(uneven).exceptAll(uneven).isEmpty() and uneven.exceptAll(training.spread(uneven)).isEmpty()
    many = rows.repartition(cores + 1)
    assert training.spread(many) is many

    fitted_on = []
    monkeypatch.setattr(training, "_fit", lambda name, given, invalid: fitted_on.append(given.rdd.getNumPartitions()))
    training.train("RF1", uneven)
    training.fit_all(["RF1"], training.spread(uneven))
    assert fitted_on == [cores, cores]


@pytest.mark.parametrize("parts, most", [("full", 1), ("few", 2)])
def test_forests_that_fill_the_cores_wait_for_each_other(spark, monkeypatch, parts, most):
    lock, running, seen = threading.Lock(), [], []

    def fit(name, rows, invalid):
        with lock:
            running.append(name)
            seen.append(sum(name.startswith("RF") for name in running))
        time.sleep(0.5)
        with lock:
            running.remove(name)
        return name

    monkeypatch.setattr(training, "_fit", fit)
    rows = spark.range(100).repartition(spark.sparkContext.defaultParallelism if parts == "full" else 1)
    found = training.fit_all(["RF1", "RF2", "DT1", "LR1"], rows, at_once=2)
    assert {name: model for name, (model, _) in found.items()} == {name: name for name in ("RF1", "RF2", "DT1", "LR1")}
    assert max(seen) == most


@pytest.mark.slow
def test_all_twelve(spark, labelled):
    rows = training.training_rows(labelled)
    board = training.model_leaderboard(spark, rows, rows).collect()
    assert len(board) == 12 and min(row.accuracy for row in board) > 0.9


def test_saved_model_scores_alike(spark, labelled, model, tmp_path):
    training.save_model(model, str(tmp_path / "m"))
    training.save_model(model, str(tmp_path / "m"))
    loaded = training.load_model(str(tmp_path / "m"))
    assert training.evaluate(loaded, labelled).collect() == training.evaluate(model, labelled).collect()
    weights = training.feature_importance(spark, loaded).collect()
    assert [row.feature for row in weights] == FEATURES and sum(row.importance for row in weights) == pytest.approx(1)


def test_scores_become_columns(labelled, model):
    scored = training.label_scores(training.score(model, labelled))
    sums = scored.select((F.col("probability_normal") + F.col("probability_risk") + F.col("probability_fire")).alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 1e-9).isEmpty()
    missing = scored.withColumn("probability", F.when(F.col("id") > 0, F.col("probability")))
    row = training.label_scores(missing).filter("id = 0").first()
    assert (row.probability_normal, row.probability_risk, row.probability_fire) == (0.0, 0.0, 0.0)


def test_missing_measures_fail_or_are_skipped(labelled):
    holed = labelled.withColumn("humidity", F.when(F.col("id") != 0, F.col("humidity")))
    assert grid.assembler(invalid="skip").transform(holed).count() == 1799
    with pytest.raises(Exception, match="null"):
        grid.assembler().transform(holed).collect()


def write_messages(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(row if isinstance(row, str) else json.dumps(row) for row in rows) + "\n", encoding="utf8")


def reading(sensor, label, second, zone="Phong_May"):
    values = dict(zip(FEATURES, (float(value) for value in CENTRES[label])))
    return {"sensor_id": sensor, "zone": zone, "timestamp": f"2024-01-30 10:00:{second:02d}", **values}


def stream(spark, path):
    return readings.readings_of(readings.read_reading_stream(spark, "text", str(path)))


def test_history_stream(spark, tmp_path):
    write_messages(tmp_path / "in", "a.txt", [reading("A", 0, 1), "broken"])
    out = str(tmp_path / "out")
    for _ in range(2):
        jobs.write_history_stream(stream(spark, tmp_path / "in"), out, str(tmp_path / "check"), once=True).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == 2  # parsed, not validated; and not written twice
    assert str(stored.filter("sensor_id = 'A'").first().date) == "2024-01-30"


def test_console_stream(spark, model, tmp_path):
    write_messages(tmp_path / "in", "a.txt", [reading("A", 2, 1), reading("B", 0, 1)])
    scored = jobs.stream_score(model, stream(spark, tmp_path / "in"))
    assert scored.columns == [*READING_COLUMNS, "prediction", "probability"]
    jobs.write_console_stream(scored, str(tmp_path / "check"), "memory", "scored", once=True).awaitTermination()
    assert {row.sensor_id: row.prediction for row in spark.table("scored").collect()} == {"A": 2.0, "B": 0.0}


def test_scoring_stream(spark, model, tmp_path):
    source, table, sent = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "alerts")
    sink = jobs.file_sink(table)

    def run():
        job = jobs.run_scoring_stream(stream(spark, source), model, sink, sent, str(tmp_path / "check"), once=True)
        job.awaitTermination()

    write_messages(source, "a.txt", [reading("A", 2, 1), reading("A", 0, 2), reading("B", 2, 1), reading("B", 1, 2), reading("C", 0, 1), "broken"])
    run()
    stored = tables.read_predictions(spark, table)
    assert stored.count() == 5
    assert {row.prediction_label for row in stored.collect()} == {"NORMAL", "FIRE_RISK", "FIRE"}
    messages = spark.read.parquet(sent).orderBy("severity_rank").collect()
    assert [row.severity for row in messages] == ["FIRE", "FIRE_RISK"]
    assert "Sensor: A" in messages[0].text and "Sensor: B" in messages[1].text
    assert "Sensor: B" not in messages[0].text and "Phát hiện 1 sensor" in messages[0].text

    write_messages(source, "b.txt", [reading("C", 0, 3)])
    run()
    assert tables.read_predictions(spark, table).count() == 6
    assert spark.read.parquet(sent).count() == 2  # nothing abnormal, nothing sent
    newest = boards.current(tables.read_predictions(spark, table), "2024-01-30 10:00:30").filter("sensor_id = 'C'").first()
    assert newest.timestamp.second == 3


def test_replayed_batch_counts_once(spark, model, tmp_path):
    write_messages(tmp_path / "in", "a.txt", [reading("A", 2, 1), reading("B", 1, 1)])
    batch = readings.readings_of(readings.read_reading_batch(spark, "text", str(tmp_path / "in")))
    for _ in range(2):
        jobs.process_batch(batch, 4, model, jobs.file_sink(str(tmp_path / "table")), str(tmp_path / "alerts"))
    assert tables.read_predictions(spark, str(tmp_path / "table")).count() == 2
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 2


def test_rows_that_cannot_be_scored_are_set_aside(spark, model, tmp_path):
    source, table, sent = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "alerts")
    holed = {**reading("N", 0, 1), "humidity": float("nan")}
    write_messages(source, "a.txt", [reading("A", 2, 1), holed, "broken"])
    jobs.run_scoring_stream(stream(spark, source), model, jobs.file_sink(table), sent, str(tmp_path / "check"), once=True).awaitTermination()
    assert [row.sensor_id for row in tables.read_predictions(spark, table).collect()] == ["A"]
    assert spark.read.parquet(sent).count() == 1
    assert sorted(row.reason for row in spark.read.parquet(f"{sent}_rejected").collect()) == ["missing", "not_a_number"]


def test_fresh_checkpoint_keeps_stored_rows(spark, model, tmp_path):
    """Two checkpoints in turn and a replay: rows stay, ids rise, and the latest by id are the last stored."""
    source, table = tmp_path / "in", str(tmp_path / "table")
    write_messages(source, "a.txt", [reading("A", 0, 1), reading("B", 0, 1)])
    seen = []
    for check, name, label in (("one", "b.txt", 1), ("two", "c.txt", 2), ("one", "d.txt", 0)):
        job = jobs.run_scoring_stream(stream(spark, source), model, jobs.file_sink(table), str(tmp_path / "alerts"), str(tmp_path / check), once=True)
        job.awaitTermination()
        stored = {row.id for row in tables.read_predictions(spark, table).select("id").collect()}
        fresh = stored - set(seen)
        assert fresh and (not seen or min(fresh) > max(seen))
        seen += sorted(fresh)
        newest = boards.current(tables.read_predictions(spark, table), "2024-01-30 10:00:30")
        assert {row.id for row in newest.collect()} <= fresh
        write_messages(source, name, [reading("A", label, 2), reading("B", label, 2)])
    assert len(seen) == 2 + 4 + 4

    # the last batch of the first checkpoint once more, as after a lost driver
    last = max((tmp_path / "check").parent.glob("one/commits/[0-9]*"), key=lambda path: int(path.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink()
    job = jobs.run_scoring_stream(stream(spark, source), model, jobs.file_sink(table), str(tmp_path / "alerts"), str(tmp_path / "one"), once=True)
    job.awaitTermination()
    again = [row.id for row in tables.read_predictions(spark, table).select("id").collect()]
    assert set(seen) <= set(again) and len(again) == len(set(again)) == len(seen) + 2


def test_empty_batch_writes_nothing(spark, model, tmp_path):
    empty = spark.createDataFrame([], readings.schemas.READING)
    jobs.process_batch(empty, 0, model, jobs.file_sink(str(tmp_path / "table")), str(tmp_path / "alerts"))
    assert not (tmp_path / "table").exists()


def test_confusion_of_a_perfect_model(spark):
    rows = spark.range(30).select((F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 3).cast("double").alias("prediction"))
    assert multiclass_metrics(confusion_matrix(rows)).first() == (1.0, 1.0, 1.0, 1.0)
