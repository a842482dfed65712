"""Exact removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``length`` bytes, digit by digit from the most
significant one. After each pass, groups of one leave; groups that are equal through all
digits are exactly the repeated windows. No suffix is compared beyond the threshold.

* First digit: of the ``ANCHOR`` byte strings inside a window, the one with the lowest
  hash, its anchor. Equal windows have the same anchor at the same place, so a digit that
  occurs once rules out every window around it. Neighbouring windows share their anchor: a
  *run* of suffixes, about 39 of them, moves as one row.
* Second digit: all bytes of a run. Runs equal in it repeat the first of them as a whole.
* Third digit, for the first of each different run under one anchor: the bytes which
  ``BLOCK`` neighbouring suffixes have in common. Blocks alone in it leave.
* Last digit: the whole window.

Tasks combine before the shuffle: of equal runs met in one slice of work only the earliest
goes on, so an anchor in a third of all documents reaches its group once per slice.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch.llm import hashing
from emberwatch.llm.common import kept

ANCHOR = 24
BLOCK = 8
#: Runs that a task gathers before it combines them.
RUNS = 400_000

_SIZE_BITS = 20


def _window_minimum(values, width):
    """Minimum over each ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[: len(values) - reach], values[reach:])
        reach *= 2
    if reach < width:
        gap = width - reach
        values = np.minimum(values[: len(values) - gap], values[gap:])
    return values


def _pieces(data, offsets, length):
    """Slices of at most about ``SLICE`` bytes: their bytes, the place of the first in
    ``data``, and first windows of rows in them. A long row is cut into overlapping
    slices, each of which has the windows that start in it."""
    for first, last in hashing.row_slices(offsets, hashing.SLICE // 2):
        low, high = offsets[first], offsets[last]
        if last - first == 1 and high - low > hashing.SLICE:
            for start in range(low, max(high - length + 1, low), hashing.SLICE // 2):
                end = min(start + hashing.SLICE // 2 + length - 1, high)
                yield first, start, data[start:end], np.array([0, end - start])
        else:
            yield first, low, data[low:high], offsets[first : last + 1] - low


def _runs_of(data, bounds, length):
    """Runs of windows with one anchor: row, first and last window, anchor, both digits."""
    count = len(data) - length + 1
    if count <= 0:
        return None
    sums = hashing.prefix_sums(data)
    places = np.arange(len(data) - ANCHOR + 1)
    digits = hashing.short_span_hashes(sums, places, places + ANCHOR)
    keys = (digits >> np.uint64(_SIZE_BITS) << np.uint64(_SIZE_BITS)) | places.astype(np.uint64)
    anchors = (_window_minimum(keys, length - ANCHOR + 1) & np.uint64((1 << _SIZE_BITS) - 1)).astype(np.int64)
    opens = np.zeros(len(data) + 1, np.int32)
    fits = np.diff(bounds) >= length
    np.add.at(opens, bounds[:-1][fits], 1)
    np.add.at(opens, bounds[1:][fits] - length + 1, -1)
    whole = np.cumsum(opens[:count]) > 0
    new = np.ones(count, bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (whole[1:] != whole[:-1])
    begins = bounds[:-1][fits]
    new[begins] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], count) - 1
    chosen = whole[starts]
    starts, ends = starts[chosen], ends[chosen]
    anchors = anchors[starts]
    rows = np.searchsorted(bounds, starts, "right") - 1
    return rows, starts, ends, anchors, digits[anchors], hashing.span_hashes(sums, starts, ends + length)


def _combined(parts):
    """Of equal runs all but those of the earliest place are known to be repeated."""
    digit, run, doc, tag, anchor, before, after = (np.concatenate(part) for part in zip(*parts))
    order = np.lexsort((anchor, tag, doc, before, after, run, digit))
    digit, run, doc, tag, anchor, before, after = (column[order] for column in (digit, run, doc, tag, anchor, before, after))
    new = np.ones(len(order), bool)
    new[1:] = False
    for column in (digit, run, before, after):
        new[1:] |= column[1:] != column[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    known = (doc != doc[first]) | (tag != tag[first]) | (anchor != anchor[first])
    columns = [hashing.signed(digit), hashing.signed(run), doc, tag, anchor, before, after, known]
    names = ["digit", "run", "doc", "tag", "anchor", "before", "after", "known"]
    return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names)


def _first_digits(length):
    """Runs of all texts; ``before`` and ``after`` bound a run, counted back from its anchor."""

    def rows(batches):
        parts, size = [], 0
        for batch in batches:
            ids, tags = np.asarray(batch.column("doc")), np.asarray(batch.column("tag"))
            data, offsets = hashing.column_bytes(batch.column("text"))
            for first, low, part, bounds in _pieces(data, offsets, length):
                found = _runs_of(part, bounds, length)
                if found is None:
                    continue
                row, starts, ends, anchors, digits, runs = found
                row = row + first
                place = anchors + low - offsets[row]
                parts.append((digits, runs, ids[row], tags[row], place, (anchors - starts).astype(np.int32), (anchors - ends).astype(np.int32)))
                size += len(row)
                if size > RUNS:
                    yield _combined(parts)
                    parts, size = [], 0
        if size:
            yield _combined(parts)

    return rows


def _span_hashes_of(data, starts, ends):
    """Hashes of spans in any order, from slices of the data."""
    result = np.zeros(len(starts), np.uint64)
    order = np.argsort(starts, kind="stable")
    ordered, first = starts[order], 0
    while first < len(order):
        low = ordered[first]
        last = int(np.searchsorted(ordered, low + hashing.SLICE, "right"))
        chosen = order[first:last]
        sums = hashing.prefix_sums(data[low : ends[chosen].max()])
        result[chosen] = hashing.span_hashes(sums, starts[chosen] - low, ends[chosen] - low)
        first = last
    return result


def _packed(data, places, valid):
    """Up to seven bytes in a number, the first in the lowest place; zero where not valid."""
    packed = np.zeros(len(places[0]), np.int64)
    for index, place in enumerate(places):
        byte = data[np.clip(place, 0, len(data) - 1)].astype(np.int64)
        packed |= np.where(valid[index], byte, 0) << np.int64(8 * index)
    return packed


def _third_digits(length):
    """Blocks of the runs that go on: the bytes that their suffixes share, as a hash, and the
    few bytes on either side of them, of which each suffix has some."""
    edge = BLOCK - 1

    def rows(batches):
        for batch in batches:
            data, offsets = hashing.column_bytes(batch.column("text"))
            spans = batch.column("spans")
            row = np.repeat(np.arange(batch.num_rows), spans.value_lengths().to_numpy(zero_copy_only=False))
            fields = spans.flatten()
            digit, anchor, before, after = (np.asarray(fields.field(name)) for name in ("digit", "anchor", "before", "after"))
            count = before // BLOCK - after // BLOCK + 1
            run = np.repeat(np.arange(len(row)), count)
            block = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + (after // BLOCK)[run]
            low = np.maximum(block * BLOCK, after[run]) - block * BLOCK
            high = np.minimum(block * BLOCK + edge, before[run]) - block * BLOCK
            core = anchor[run] + offsets[row[run]] - block * BLOCK
            core_end = core + length - edge
            left = _packed(data, [core - 1 - k for k in range(edge)], [k < high for k in range(edge)])
            right = _packed(data, [core_end + k for k in range(edge)], [k < edge - low for k in range(edge)])
            taken = pa.array(row[run])
            columns = [digit[run], block.astype(np.int32), low.astype(np.int32), high.astype(np.int32)]
            columns += [hashing.signed(_span_hashes_of(data, core, core_end)), left, right, anchor[run]]
            names = ["digit", "block", "low", "high", "core", "left", "right", "anchor", "doc", "tag"]
            arrays = [pa.array(column) for column in columns]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column("doc").take(taken), batch.column("tag").take(taken)], names)

    return rows


def _removed(length):
    """What is left of each text without the windows that start in its ranges."""

    def rows(batches):
        for batch in batches:
            data, offsets = hashing.column_bytes(batch.column("text"))
            ranges = batch.column("ranges")
            results = []
            for row in range(batch.num_rows):
                part = data[offsets[row] : offsets[row + 1]]
                change = np.zeros(len(part) + 1, np.int32)
                if ranges[row].is_valid:
                    found = ranges[row].values
                    np.add.at(change, np.asarray(found.field("first")), 1)
                    np.add.at(change, np.asarray(found.field("last")) + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                starts = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)
                ends = np.flatnonzero(np.diff(gone.astype(np.int8), append=0) == -1) + 1
                left = part[~gone].tobytes()
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends)]
                results.append((len(part), int(gone.sum()), len(starts), hashlib.sha256(left).hexdigest(), spans, left))
            columns = list(zip(*results)) if results else [[]] * 6
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
            arrays = [pa.array(list(column), kind) for column, kind in zip(columns, kinds)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)

    return rows


_PLACE = ["doc", "tag", "anchor"]


def _ranked(frame, group, equal):
    """Adds ``first`` (one row of each set of equals in ``group``), ``repeats`` (there is an
    earlier equal) and ``different`` (how many sets of equals the group has)."""
    frame = frame.repartition(*group)  # one exchange for both windows
    order = Window.partitionBy(*group, *equal).orderBy(*_PLACE)
    place = F.struct(*_PLACE)
    ranked = frame.withColumn("number", F.row_number().over(order)).withColumn("repeats", place != F.first(place).over(order))
    first = (F.col("number") == 1).cast("int")
    return ranked.withColumn("first", F.col("number") == 1).withColumn("different", F.sum(first).over(Window.partitionBy(*group)))


def repeated_windows(docs, length):
    """Ranges (doc, tag, first, last) of window starts that are repeated, from ``docs`` (doc, tag, text)."""
    schema = "digit long, run long, doc long, tag int, anchor long, before int, after int, known boolean"
    runs = docs.mapInArrow(_first_digits(length), schema)
    # runs known to be repeated pass by; they need no group
    runs = runs.withColumn("digit", F.when(F.col("known"), F.xxhash64(*_PLACE, "before")).otherwise(F.col("digit")))
    runs = _ranked(runs, ["digit", "known"], ["run", "before", "after"])
    gone = F.col("known") | F.col("repeats")
    runs = runs.withColumn("gone", gone).filter("gone OR first AND different > 1")
    runs = kept(runs.select("digit", *_PLACE, "before", "after", "gone"), release=True)

    spans = runs.filter("NOT gone").groupBy("doc", "tag").agg(F.collect_list(F.struct("digit", "anchor", "before", "after")).alias("spans"))
    found = docs.join(spans, ["doc", "tag"])
    schema = "digit long, block int, low int, high int, core long, left long, right long, anchor long, doc long, tag int"
    blocks = found.mapInArrow(_third_digits(length), schema)
    blocks = _ranked(blocks, ["digit", "block", "core"], ["low", "high", "left", "right"])
    blocks = blocks.filter("repeats OR first AND different > 1").drop("number", "first", "different")
    suffixes = blocks.withColumn("back", F.explode(F.when(F.col("repeats"), F.array(F.lit(-1))).otherwise(F.sequence("low", "high"))))
    mask = "(shiftleft(1L, 8 * {}) - 1)"
    suffixes = suffixes.withColumn("own_left", F.expr("CASE WHEN repeats THEN anchor ELSE left & " + mask.format("back") + " END"))
    suffixes = suffixes.withColumn("own_right", F.expr("CASE WHEN repeats THEN doc ELSE right & " + mask.format(f"({BLOCK - 1} - back)") + " END"))
    equal = Window.partitionBy("digit", "block", "core", "back", "own_left", "own_right").orderBy(*_PLACE)
    later = F.struct(*_PLACE) != F.first(F.struct(*_PLACE)).over(equal)
    suffixes = suffixes.withColumn("later", later).filter("repeats OR later")
    base = F.col("anchor") - F.col("block") * BLOCK
    high = F.when(F.col("repeats"), F.col("high")).otherwise(F.col("back"))
    low = F.when(F.col("repeats"), F.col("low")).otherwise(F.col("back"))
    last = suffixes.select("doc", "tag", (base - high).alias("first"), (base - low).alias("last"))
    whole = runs.filter("gone").select("doc", "tag", (F.col("anchor") - F.col("before")).alias("first"), (F.col("anchor") - F.col("after")).alias("last"))
    return whole.unionAll(last)


def remove_repeats(docs, length=100):
    """Removes every byte covered by a ``length``-byte string that starts earlier as well.

    Earlier: in a row with a smaller doc_id, or before it in the same text. Strings never
    cross texts and are judged on the input. Gives, for each row of ``docs`` (doc_id, text),
    doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end of each removed
    run of bytes) and kept (the remaining bytes).

    A null text is empty; texts shorter than ``length`` stay whole. A null doc_id comes
    before all others. Rows that share doc_id but not text follow the order of a hash of the
    text; rows equal in both are one document and get equal results. An empty table gives no
    rows. Other columns are ignored.
    """
    if length < ANCHOR + BLOCK:
        raise ValueError(f"length must be at least {ANCHOR + BLOCK}")
    text = F.coalesce("text", F.lit(""))
    # only where ids repeat do rows need more than their id to be told apart
    repeated = docs.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    tag = F.xxhash64(text).bitwiseAND(0x7FFFFFFF).cast("int") if repeated else F.lit(0)
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), tag.alias("tag"), text.alias("text"))
    ranges = repeated_windows(docs.select("doc", "tag", "text"), length)
    ranges = kept(ranges, release=True)  # the texts are shuffled once more; what the ranges took goes first
    ranges = ranges.groupBy("doc", "tag").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    span = "array<struct<start long, end long>>"
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans {span}, kept binary"
    return docs.join(ranges, ["doc", "tag"], "left").select("doc_id", "text", "ranges").mapInArrow(_removed(length), schema)
