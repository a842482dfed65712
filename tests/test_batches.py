"""Stored batches: numbers that rise, batches that count once, files chosen by zones, snapshots."""

import os
import random

import pytest
from pyspark.sql import functions as F

from emberwatch.operators import history, latest, trend
from emberwatch.plans import stored as stored_queries
from emberwatch.sources import batches, tables
from emberwatch.sources.batches import BatchLog
from emberwatch.sources.shared import names_in, rename_once

ROW = "id long, sensor_id string, zone string, timestamp string, prediction int"


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def row(number, sensor, second=None, prediction=0):
    return (number, sensor, "Phong_May", None if second is None else f"2024-01-30 10:{second // 60:02d}:{second % 60:02d}", prediction)


def values(frame):
    return sorted((tuple(line) for line in frame.collect()), key=str)


@pytest.fixture
def log(spark, tmp_path):
    return BatchLog(spark, str(tmp_path / "table"))


def test_names_are_given_once(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).mkdir()
        (tmp_path / name / "x").write_text(name)
    assert rename_once(spark, str(tmp_path / "a"), str(tmp_path / "c"))
    assert not rename_once(spark, str(tmp_path / "b"), str(tmp_path / "c"))
    assert (tmp_path / "c" / "x").read_text() == "a" and names_in(spark, str(tmp_path / "none")) == []


def test_claims_rise_over_streams(log):
    first = log.claim("one", 0)
    second = log.claim("two", 0)
    third = log.claim("one", 1)
    assert first < second < third
    assert [log.claim("one", 0), log.claim("two", 0)] == [first, second]
    log.fold()
    assert [log.claim("one", 1), log.claim("one", 0)] == [third, first]
    assert log.claim("fresh", 0) > third


def test_a_batch_counts_once(spark, log):
    batch = rows_of(spark, row(1, "A", 1), row(2, "B", 2))
    log.write(batch, 0, "s")
    log.write(batch, 0, "s")
    assert values(log.read()) == values(batch)
    log.write(rows_of(spark, row(3, "A", 3)), 1, "s")
    log.write(rows_of(spark, row(4, "A", 4)), 1, "other")
    assert log.compact(rows_per_file=100) >= 3
    log.fold()
    for number, stream in [(0, "s"), (1, "s"), (1, "other")]:
        log.write(batch, number, stream)
    assert sorted(line.id for line in log.read().collect()) == [1, 2, 3, 4]


def test_half_written_batch_is_unseen_and_replaced(spark, log):
    log.write(rows_of(spark, row(1, "A", 1)), 0, "s")
    rows_of(spark, row(2, "A", 2), row(3, "A", 3)).write.parquet(batches.batch_folder(log.path, 1, "s"))
    assert [line.id for line in log.read().collect()] == [1]
    log.write(rows_of(spark, row(2, "A", 2)), 1, "s")
    assert sorted(line.id for line in log.read().collect()) == [1, 2]


def test_reader_goes_by_the_log(spark, log):
    from emberwatch import schemas

    log.write(spark.createDataFrame([], schemas.PREDICTION), 0, "s")
    assert log.is_stored("s", 0)
    log.write(spark.createDataFrame([(1,) + (None,) * (len(schemas.PREDICTION) - 1)], schemas.PREDICTION), 1, "s")
    assert tables.read_predictions(spark, log.path).count() == 1
    assert tables.read_predictions(spark, log.path).columns == schemas.PREDICTION_COLUMNS
    with pytest.raises(ValueError, match="no batch"):
        BatchLog(spark, log.path + "_none").read()


def stored(spark, log, rng, count=8):
    """Batches with late rows, rows without id or time, and one batch without any of these."""
    everything = []
    for batch in range(count):
        part = []
        for place in range(12):
            number = batch * 100 + place if rng.random() > 0.1 else rng.randrange(100 * count) + 50
            second = number if rng.random() > 0.15 else None
            part.append(row(None if batch == 3 and place < 4 else number * 10 + batch, f"S{rng.randrange(5)}", second, rng.randrange(3)))
        everything += part
        log.write(rows_of(spark, *part), batch, "s")
    return rows_of(spark, *everything)


@pytest.mark.parametrize("n", [1, 5, 30, 90, 200])
def test_newest_rows_come_from_few_files(spark, log, n):
    whole = stored(spark, log, random.Random(n))
    for _ in range(2):
        near = log.read_newest(n)
        ids = lambda frame: sorted((line.id for line in history.recent_history(frame, n).collect()), key=str)
        assert ids(near) == ids(whole)
        dated = whole.filter("timestamp IS NOT NULL").withColumn("m", F.lit(1.0))
        tail = lambda frame: [(line.timestamp, line.id) for line in trend.tail_by_time(frame, "m", n).collect()]
        assert tail(log.read_newest(n, "time").filter("timestamp IS NOT NULL").withColumn("m", F.lit(1.0))) == tail(dated)
        log.compact(rows_per_file=20)


def test_only_chosen_files_are_read(spark, log):
    for batch in range(6):
        log.write(rows_of(spark, *[row(batch * 10 + place, "A", batch * 10 + place) for place in range(4)]).coalesce(1), batch, "s")
    read = log.read_newest(6)
    assert len(read.inputFiles()) == 2 and all("batch_id=4" in name or "batch_id=5" in name for name in read.inputFiles())
    plan = read._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    scan = plan.collectLeaves().head() if "Adaptive" not in plan.getClass().getName() else plan.executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 2
    middle = log.read_range("2024-01-30 10:00:21", "2024-01-30 10:00:32")
    assert sorted(line.id for line in middle.collect()) == [20, 21, 22, 23, 30, 31, 32, 33]
    assert len(log.read_range(45, None, by="id").inputFiles()) == 1


def test_readers_see_old_or_new_but_not_both(spark, log, monkeypatch):
    whole = stored(spark, log, random.Random(3))
    before = log.read()
    wanted = values(whole)
    assert log.compact(rows_per_file=30) > 1
    assert values(before) == wanted == values(log.read())
    assert len(log.read().inputFiles()) < len(before.inputFiles())
    assert log.compact(rows_per_file=30) == 0 or values(log.read()) == wanted

    # one that another compaction overtakes gives up
    late = BatchLog(spark, log.path)
    files, last = late.files()
    log.compact(rows_per_file=1000)
    monkeypatch.setattr(late, "files", lambda: (files, last))
    assert late.compact(rows_per_file=1000) == 0 and values(log.read()) == wanted

    on_disk = len(before.inputFiles())
    log.fold()
    assert log.vacuum() >= on_disk and log.vacuum() == 0
    assert values(log.read()) == wanted
    log.fold()
    assert log.vacuum() == 0


def test_batches_meanwhile_do_not_stop_a_compaction(spark, log, monkeypatch):
    whole = stored(spark, log, random.Random(4), 3)
    late = BatchLog(spark, log.path)
    files, last = late.files()
    more = rows_of(spark, row(5000, "A", 1))
    log.write(more, 9, "s")
    monkeypatch.setattr(late, "files", lambda: (files, last))
    assert late.compact(rows_per_file=1000) > 1
    assert values(log.read()) == values(whole.unionAll(more))


def test_log_is_folded(spark, log, monkeypatch):
    monkeypatch.setattr(batches, "FOLD_EVERY", 4)
    for batch in range(9):
        log.claim("s", batch)
        log.write(rows_of(spark, row(batch, "A", batch)), batch, "s")
    names = names_in(spark, log.folder)
    assert sum(name.startswith("fold-") for name in names) <= 2 and len(names) < 12
    assert sorted(line.id for line in log.read().collect()) == list(range(9))
    assert log.claim("s", 9) > log.claim("s", 8) or log.is_stored("s", 8)


MEANINGS = [("by_id", latest.latest_by_max_id), ("abnormal", latest.latest_abnormal)]


@pytest.mark.parametrize("name, operator", MEANINGS)
def test_latest_is_maintained(spark, log, name, operator):
    """Over two restarts, with replays, late rows, a compaction and a sensor that went silent."""
    parts = [
        [row(1, "dead", 5, 2), row(2, "A", 6, 1), row(3, "B", 7, 0)],
        [row(10, "A", 16, 2), row(11, "B", 17, 1)],
        [row(20, "A", 12, 1), row(21, "B", 27, 2)],  # late by time, new by id
        [row(9, "C", 60, 1), row(4, "B", 70, 1)],  # late by id, new by time
    ]
    seen = []
    for batch, part in enumerate(parts):
        log = BatchLog(spark, log.path)  # a restart each time
        log.write(rows_of(spark, *part), batch, "s")
        log.write(rows_of(spark, *part), batch, "s")
        seen += part
        assert values(log.latest(name, operator)) == values(operator(rows_of(spark, *seen)))
        if batch != 1:
            log.refresh_latest(name, operator)
            assert values(log.latest(name, operator)) == values(operator(rows_of(spark, *seen)))
        if batch == 2:
            log.compact(rows_per_file=100)
            log.fold()
    assert any(line.sensor_id == "dead" for line in log.latest(name, operator).collect())


def test_latest_reads_the_snapshot_and_what_is_newer(spark, log):
    for batch in range(5):
        log.write(rows_of(spark, row(batch, f"S{batch % 2}", batch)).coalesce(1), batch, "s")
    log.refresh_latest("by_id", latest.latest_by_max_id)
    log.write(rows_of(spark, row(7, "S1", 9)).coalesce(1), 5, "s")
    files, newer, _ = log._snapshot("by_id")
    assert [os.path.dirname(line.file) for line in newer.collect()] == ["stream=s/batch_group=0/batch_id=5"]
    read = log.latest("by_id", latest.latest_by_max_id).inputFiles()
    assert sum("batch_id=" in name for name in read) == 1 and all("batch_id=5" in name or "_latest" in name for name in read)


def test_batches_are_dealt_in_one_pass(spark, tmp_path):
    """A batch reads its own rows only, not the table once more, and shares them over tasks."""
    numbers = [None, None, *range(1000), 999, 50]
    source = str(tmp_path / "source")
    spark.createDataFrame([(number, f"S{number}") for number in numbers], "id long, name string").coalesce(1).write.parquet(source)
    rows = spark.read.parquet(source)
    given = set(rows.inputFiles())
    want = lambda number: min(3, number // 250 + (number % 50 == 0)) if number is not None else 3
    folders = set()
    for batch, part in stored_queries._batches(rows, F.col("id")):
        assert part.columns == rows.columns and not given & set(part.inputFiles())
        folders |= {os.path.dirname(os.path.dirname(name.removeprefix("file://"))) for name in part.inputFiles()}
        assert values(part) == sorted(((number, f"S{number}") for number in numbers if want(number) == batch), key=str)
    assert len(folders) == 1 and not os.path.exists(folders.pop())


def test_batches_without_rows(spark):
    rows = spark.createDataFrame([(7, "A")], "id long, name string")
    assert [(batch, part.count()) for batch, part in stored_queries._batches(rows, F.col("id"))] == [(0, 1), (1, 0), (2, 0), (3, 0)]
    assert [part.collect() for _, part in stored_queries._batches(rows.limit(0), F.col("id"))] == [[], [], [], []]
