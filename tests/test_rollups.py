"""Distinct counts that grow batch by batch."""

import pytest

from emberwatch.streaming.rollups import DistinctTotals

ROW = "sensor string, zone string"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def found(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def test_totals_are_those_of_all_rows(spark, tmp_path):
    parts = [
        [("A", "x"), ("A", "x"), ("B", "y"), (None, "x")],
        [("B", "x"), ("C", None), (None, None)],
        [(None, "y")],
        [],
        [(f"S{n}", "z") for n in range(40_000)] + [("A", "z")],  # more names than a bitmap has bits
    ]
    rows = []
    for number, part in enumerate(parts):
        totals = DistinctTotals(spark, str(tmp_path / "t"), by=["zone"])
        for _ in range(2):
            totals.add(batch(spark, *part), number, "s")
        rows += part
    zones = {zone for _, zone in rows}
    wanted = [(zone, sum(z == zone for _, z in rows), len({s for s, z in rows if z == zone and s is not None})) for zone in zones]
    assert found(totals.totals()) == sorted(wanted, key=str)
    assert found(totals.totals([])) == [(len(rows), len({s for s, _ in rows if s is not None}))]
    totals.bitmaps.compact(lambda frame: _zones(), 100)
    totals.names.fold()
    totals.bitmaps.fold()
    totals.add(batch(spark, ("new", "x")), 4, "s")  # stored before
    assert found(DistinctTotals(spark, str(tmp_path / "t"), by=["zone"]).totals()) == sorted(wanted, key=str)


def _zones():
    from emberwatch.streaming.rollups import _no_zones

    return _no_zones(None)


def test_a_try_that_ended_between_the_tables_counts_once(spark, tmp_path):
    totals = DistinctTotals(spark, str(tmp_path / "t"))
    totals._learn(batch(spark, ("A", "x"), ("B", "x")), 0, "s")
    totals.add(batch(spark, ("A", "x"), ("B", "x")), 0, "s")
    totals.add(batch(spark, ("B", "x"), ("C", "x")), 0, "other checkpoint")
    assert found(totals.totals()) == [(4, 3)]
    ids = [row.id for row in totals.names.read().collect()]
    assert len(ids) == len(set(ids)) == 3


def test_nothing_is_stored_before_the_first_batch(spark, tmp_path):
    with pytest.raises(ValueError, match="no batch"):
        DistinctTotals(spark, str(tmp_path / "none")).totals()
