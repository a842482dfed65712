"""Toxicity by a factorization machine over hashed terms.

A linear model adds the weights of terms; a factorization machine also gives every pair of
terms the product of two short vectors, so that a mild word next to a named group can count
for more than both alone. It is fitted on a bounded sample of labelled rows and then scores
every whole text.

All terms of the sample take part. What a term may weigh grows with the evidence for it (its
chi-square with the label, and how often it was seen), so that a hundred thousand rare terms
cannot learn the sample by heart, while a frequent term without a signal of its own still
has a say in pairs. One row in ``fold`` is kept from training: it says when to stop, and its
labels turn sums into shares, so that a score of 0.7 means 0.7.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from emberwatch.llm import hashing
from emberwatch.llm.common import free_name


@dataclass(frozen=True)
class Settings:
    #: Labelled rows that training takes at most, chosen by a hash.
    sample_rows: int = 12_000
    #: Places that terms are hashed to.
    hash_bits: int = 20
    #: Evidence at which a term has half its full weight, and sightings worth one unit of it.
    half_evidence: float = 30.0
    sightings: float = 30.0
    #: Documents of the sample a term must be in to have factors.
    least_seen: int = 50
    factors: int = 4
    epochs: int = 30
    batch: int = 256
    rate: float = 0.05
    decay: float = 1e-3
    #: One row in so many is kept to stop and to calibrate; epochs without gain before it stops.
    fold: int = 10
    patience: int = 3
    threshold: float = 0.7


@dataclass
class FactorizationMachine:
    """``places`` maps a hashed term to its number, -1 where it was never seen. The first
    ``len(factors)`` numbers are terms that have factors."""

    places: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    settings: Settings = field(default_factory=Settings)

    def sums(self, rows, terms, count):
        """Sums before calibration of ``count`` rows from pairs (row, term number)."""
        sums = np.full(count, self.bias)
        sums += np.bincount(rows, self.linear[terms], count)
        paired = terms < len(self.factors)
        rows, terms = rows[paired], terms[paired]
        for factor in self.factors.T:
            inner = np.bincount(rows, factor[terms], count)
            sums += 0.5 * (inner**2 - np.bincount(rows, factor[terms] ** 2, count))
        return sums

    def score_rows(self, rows, terms, count):
        """Scores of ``count`` rows from pairs (row, term number) that occur in them."""
        return _share(self.slope * self.sums(rows, terms, count) + self.offset)


def _share(sums):
    return 1 / (1 + np.exp(-np.clip(sums, -40, 40)))


def hashed_terms(column, bits, places=None):
    """(row, place) of the distinct terms of each text of a column, in slices of rows."""
    shift = np.uint64(64 - bits)
    for first, count, hashes, bounds in hashing.texts_of_words(column, terms=True):
        rows = np.repeat(np.arange(count), np.diff(bounds))
        terms = (hashes >> shift).astype(np.int64)
        if places is not None:
            terms = places[terms]
            rows, terms = rows[terms >= 0], terms[terms >= 0]
        keys = np.unique(rows << 32 | terms)
        yield first, count, keys >> 32, keys & 0xFFFFFFFF


def _term_lists(bits):
    def rows(batches):
        for batch in batches:
            for first, count, row, terms in hashed_terms(batch.column("text"), bits):
                offsets = np.searchsorted(row, np.arange(count + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(terms.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("label").slice(first, count), lists], ["label", "terms"])

    return rows


def _signal(rows, terms, labels, size, total):
    """Chi-square of each hashed term with the label."""
    toxic = labels.sum()
    seen = np.bincount(terms, minlength=size)
    hits = np.bincount(terms, labels[rows], size)
    expected = seen * toxic / max(total, 1)
    spread = expected * (1 - toxic / max(total, 1)) * (1 - np.minimum(seen / max(total, 1), 1))
    return np.where(spread > 0, (hits - expected) ** 2 / np.maximum(spread, 1e-12), 0.0)


def fit(labelled, settings=None):
    """Fits the machine on ``labelled`` (doc_id, text, label 0 or 1).

    At most ``sample_rows`` rows, those with the lowest hash of their terms, are read by the
    driver, as numbers of hashed terms. Rows without a label take no part. Without any
    labelled row, or with one label only, all scores are its smoothed share.
    """
    settings = settings or Settings()
    rows = labelled.filter("label IS NOT NULL").select("label", "text")
    rows = rows.mapInArrow(_term_lists(settings.hash_bits), "label int, terms array<int>")
    table = rows.orderBy(F.xxhash64("terms"), "label").limit(settings.sample_rows).toArrow().combine_chunks()
    labels = np.asarray(table.column("label").combine_chunks(), dtype=float) if table.num_rows else np.zeros(0)
    lists = table.column("terms").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    row = np.repeat(np.arange(len(labels), dtype=np.int32), np.asarray(lists.value_lengths(), dtype=np.int64))
    return train(row, np.asarray(lists.flatten(), dtype=np.int32), labels, settings)


def train(row, terms, labels, settings=None):
    """The machine for rows of ``labels``, given the pairs (row, hashed term), by row."""
    settings = settings or Settings()
    size, rate = 1 << settings.hash_bits, (labels.sum() + 1) / (len(labels) + 2)
    seen = np.bincount(terms, minlength=size)
    there = np.flatnonzero(seen)
    if rate in (1 / (len(labels) + 2), 1 - 1 / (len(labels) + 2)):
        there = there[:0]
    there = there[np.argsort(seen[there] < settings.least_seen, kind="stable")]
    places = np.full(size, -1, np.int32)
    places[there] = np.arange(len(there))
    start = np.random.default_rng(11).normal(0, 0.05, (int((seen[there] >= settings.least_seen).sum()), settings.factors))
    machine = FactorizationMachine(places, float(np.log(rate / (1 - rate))), np.zeros(len(there)), start, settings=settings)
    if len(there):
        offsets = np.searchsorted(row, np.arange(len(labels) + 1))
        aside = np.arange(len(labels)) % settings.fold == 0
        chosen = aside[row]
        signal = _signal(row[~chosen], terms[~chosen], labels * ~aside, size, (~aside).sum())[there]
        evidence = signal + seen[there] / settings.sightings
        _descend(machine, places[terms], offsets, labels, aside, evidence / (evidence + settings.half_evidence))
    return machine


def _of_rows(terms, offsets, picked):
    """Pairs (place among ``picked``, term) of some rows."""
    counts = offsets[picked + 1] - offsets[picked]
    at = np.repeat(offsets[picked] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    return np.repeat(np.arange(len(picked)), counts), terms[at]


def _descend(machine, terms, offsets, labels, aside, worth):
    """Logistic loss, steps scaled by past gradients and by the worth of a term, weights
    pulled towards zero. Weights are those after the epoch that did best on rows ``aside``."""
    settings = machine.settings
    past = [1e-8, np.full(machine.linear.shape, 1e-8), np.full(machine.factors.shape, 1e-8)]
    shuffle = np.random.default_rng(7)
    used, kept_rows = np.flatnonzero(~aside), np.flatnonzero(aside)
    check, least, idle = _of_rows(terms, offsets, kept_rows), np.inf, 0
    machine.factors *= worth[: len(machine.factors), None]
    best = (machine.bias, machine.linear, machine.factors)
    for _ in range(settings.epochs):
        for picked in np.array_split(shuffle.permutation(used), max(1, len(used) // settings.batch)):
            _step(machine, *_of_rows(terms, offsets, picked), labels[picked], past, worth)
        sums = machine.sums(*check, len(kept_rows))
        loss = (np.logaddexp(0, sums) - labels[kept_rows] * sums).mean()
        idle = 0 if loss < least else idle + 1
        if loss < least:
            least, best = loss, (machine.bias, machine.linear.copy(), machine.factors.copy())
        if idle == settings.patience:
            break
    machine.bias, machine.linear, machine.factors = best
    machine.slope, machine.offset = _calibration(machine.sums(*check, len(kept_rows)), labels[kept_rows])


def _step(machine, rows, own, labels, past, worth):
    settings, count = machine.settings, len(labels)
    error = (_share(machine.sums(rows, own, count)) - labels) / count
    touched, own = np.unique(own, return_inverse=True)
    slope = np.bincount(own, error[rows], len(touched)) * worth[touched] + settings.decay * machine.linear[touched] / 10
    past[0] += error.sum() ** 2
    machine.bias -= settings.rate * error.sum() / np.sqrt(past[0])
    past[1][touched] += slope**2
    machine.linear[touched] -= 4 * settings.rate * worth[touched] * slope / np.sqrt(past[1][touched])
    paired = touched[: np.searchsorted(touched, len(machine.factors))]
    rows, own = rows[own < len(paired)], own[own < len(paired)]
    for place in range(settings.factors):
        factor = machine.factors[paired, place]
        inner = np.bincount(rows, factor[own], count)
        slope = np.bincount(own, error[rows] * (inner[rows] - factor[own]), len(paired)) * worth[paired] + settings.decay * factor
        past[2][paired, place] += slope**2
        machine.factors[paired, place] -= settings.rate * worth[paired] * slope / np.sqrt(past[2][paired, place])


def _calibration(sums, labels):
    """Slope and offset that turn sums into shares: logistic regression on softened labels,
    which keeps the slope finite where sums part the labels."""
    ones = labels.sum()
    goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    weights, design = np.array([1.0, 0.0]), np.stack([sums, np.ones(len(sums))], 1)
    for _ in range(100):
        share = _share(design @ weights)
        slope = design.T @ (share - goal) + 1e-3 * (weights - [1.0, 0.0])
        bend = (design * (share * (1 - share))[:, None]).T @ design + 1e-3 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        weights = weights - move * min(1.0, 2.0 / np.abs(move).max(initial=1e-12))
    return (float(weights[0]), float(weights[1])) if weights[0] > 0 else (1.0, 0.0)


def _scorer(machine, text, drop, broadcast):
    def rows(batches):
        model = broadcast.value
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for first, count, row, terms in hashed_terms(batch.column(text), model.settings.hash_bits, model.places):
                scores[first : first + count] = model.score_rows(row, terms, count)
            arrays = batch.columns[:-1] if drop else batch.columns
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(scores)], [str(number) for number in range(len(arrays) + 1)])

    return rows


def score(docs, machine, text="text", keep=("doc_id",), name="score", decision="predicted"):
    """The columns ``keep`` of every row of ``docs``, ``score`` (0 to 1) and ``predicted``.

    Null and empty texts and those without known terms get the score of no terms, that is
    of the bias alone. Repeated rows get equal scores; an empty table gives no rows.
    ``name`` and ``decision`` name the two columns where those names are taken.
    """
    drop = text not in keep
    body = free_name(docs.select(*keep), "fm_text") if drop else text
    frame = docs.select(*keep, F.col(text).alias(body)) if drop else docs.select(*keep)
    schema = StructType([*docs.select(*keep).schema.fields, StructField(name, DoubleType())])
    broadcast = docs.sparkSession.sparkContext.broadcast(machine)
    scored = frame.mapInArrow(_scorer(machine, body, drop, broadcast), schema)
    return scored.withColumn(decision, (F.col(name) >= machine.settings.threshold).cast("int"))


def without_toxic(docs, machine):
    """The rows of ``docs`` that the machine does not predict to be toxic, unchanged."""
    name, decision = free_name(docs, "score"), free_name(docs, "predicted")
    scored = score(docs, machine, keep=tuple(docs.columns), name=name, decision=decision)
    return scored.filter(F.col(decision) == 0).select(*docs.columns)


def is_held_out(doc_id):
    """Rows whose labels are never learned: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def labelled_texts(docs, labels, settings=None):
    """(doc_id, text, label) of labelled rows that may be learned, ``sample_rows`` at most.

    Labels are chosen by the lowest hash of doc_id; of repeated labels the highest counts.
    """
    marks = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    marks = marks.filter(~is_held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit((settings or Settings()).sample_rows)
    return docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
