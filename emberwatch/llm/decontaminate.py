"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Local alignment forgives changed, added and missing words. It is made where a document holds
some seeds of the item: words or pairs of neighbouring words of it, of those that are rarest
in the corpus. Seeds are chosen so that nothing escapes that the alignment would accept: an
alignment with many pairs whole misses too few of them to miss the rarest ones, one with few
pairs needs so many words of the item that it cannot miss the rarest words. Where the line
between the two is drawn, seeds occur least often.

What is found is no copy yet where it is a phrase that the corpus has in many different
surroundings. Copies of a document do not make a phrase common: their surroundings are the same.

Test items are a stated query set: they are taken in blocks of bounded size. Each block is
given to all tasks and reads the documents twice, to count its n-grams and to find its seeds.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from emberwatch.llm import hashing
from emberwatch.llm.common import free_name, kept, sized


@dataclass(frozen=True)
class Settings:
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    #: Least share of the best possible score of the item, or
    share: float = 0.5
    #: so many points, which an unbroken copy of 25 words reaches.
    points: int = 50
    #: Shorter items need all their words, and so many points or this share, whichever is less.
    short_words: int = 8
    short_points: int = 8
    short_share: float = 0.7
    #: Still shorter ones count only as a whole line.
    line_words: int = 3
    #: A passage is a common phrase if it stands in more than so many different surroundings,
    common_contexts: int = 50
    #: and in more than this share of all documents. It counts only as a whole line,
    common_share: float = 0.001
    #: or if it is this share of an item that is not short.
    whole_share: float = 0.8
    #: Seeds of an item that a document must hold before it is aligned. Nothing escapes at any
    #: number: the more are asked for, the more of the rarest n-grams are seeds.
    least_seeds: int = 3
    #: Words on each side that make up the surroundings.
    context_words: int = 3
    #: Bytes of item texts in a block.
    block_bytes: int = 8 << 20


_FILTER_BITS = 20
_NEVER = 1 << 40
_KINDS = [
    ("doc_id", pa.int64(), "long"),
    ("text_key", pa.int64(), "long"),
    ("item_id", pa.int64(), "long"),
    ("score", pa.int32(), "int"),
    ("similarity", pa.float64(), "double"),
    ("seeds", pa.int32(), "int"),
    ("first_word", pa.int32(), "int"),
    ("last_word", pa.int32(), "int"),
    ("sure", pa.bool_(), "boolean"),
    ("phrase", pa.int64(), "long"),
    ("context", pa.int64(), "long"),
]
_RESULT = ", ".join(f"{name} {kind}" for name, _, kind in _KINDS)


class Keys:
    """Sorted hashes that can be looked up for many words at once."""

    def __init__(self, hashes):
        self.keys = np.unique(hashes)
        self.known = np.zeros(1 << _FILTER_BITS, bool)
        self.known[self.keys >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, hashes):
        """Places of ``hashes`` that are known, and the numbers of their keys."""
        at = np.flatnonzero(self.known[hashes >> np.uint64(64 - _FILTER_BITS)])
        if not len(self.keys) or not len(at):
            return at[:0], at[:0]
        number = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        real = self.keys[number] == hashes[at]
        return at[real], number[real]


class Seeds:
    """Inverted list of the seeds of all items, and how many places of seeds each needs."""

    def __init__(self, lists, needed):
        self.items, self.needed = len(lists), np.array(needed, np.int64)
        hashes = np.concatenate([*lists, np.zeros(0, np.uint64)])
        self.keys = Keys(hashes)
        entries = np.searchsorted(self.keys.keys, hashes) * self.items + np.repeat(np.arange(self.items), [len(own) for own in lists])
        entries, self.times = np.unique(entries, return_counts=True)
        self.owners = entries % self.items
        self.starts = np.searchsorted(entries // self.items, np.arange(len(self.keys.keys) + 1))

    def found(self, hashes, bounds, short):
        """For rows parted by ``bounds``: row * items + item, places of seeds found, and
        whether they are enough. A pair (``short`` of 1) must not cross from row to row."""
        size = max(len(self.keys.keys), 1)
        hits = np.unique(_in_rows(self.keys, hashes, bounds, short, size))
        row, number = hits // size, hits % size
        per = self.starts[number + 1] - self.starts[number] if len(hits) else hits
        entry = np.repeat(self.starts[number] - np.cumsum(per) + per, per) + np.arange(per.sum())
        both, place = np.unique(np.repeat(row, per) * self.items + self.owners[entry], return_inverse=True)
        places = np.bincount(place, self.times[entry], len(both)).astype(np.int64)
        return both, places, places >= self.needed[both % self.items]


def _in_rows(keys, hashes, bounds, short, size):
    """row * size + number for each place of ``hashes`` that is a key."""
    at, number = keys.find(hashes)
    row = np.searchsorted(bounds, at, "right") - 1
    inside = at + short < bounds[row + 1]
    return row[inside] * size + number[inside]


class Block:
    """Items of one block, what they need, and their seeds once the n-grams are counted."""

    def __init__(self, ids, words, settings):
        self.ids, self.words, self.settings = ids, words, settings
        self.pairs = [_pairs(item) for item in words]
        length = np.array([len(item) for item in words])
        self.best = settings.match * length
        self.short = length < settings.short_words
        short = np.minimum(settings.short_points, settings.short_share * self.best)
        needed = np.minimum(np.maximum(settings.share * self.best, np.where(self.short, short, 0)), settings.points)
        self.needed = np.ceil(needed - 1e-9).astype(np.int64)
        self.error = min(-settings.mismatch, -settings.gap, settings.match)
        self.reach = (length + (self.best - self.needed) / self.error).astype(np.int64)
        self.line_only = length < settings.line_words
        self.grams = Keys(np.concatenate([*words, *self.pairs, np.zeros(0, np.uint64)]))
        self.word_seeds = self.pair_seeds = None

    def choose_seeds(self, documents):
        """``documents`` says for each key of ``grams`` how many documents have it."""
        chosen = [self._seeds_of(item, documents) for item in range(len(self.ids))]
        self.word_seeds = Seeds([words for words, _, _, _ in chosen], [needed for _, needed, _, _ in chosen])
        self.pair_seeds = Seeds([pairs for _, _, pairs, _ in chosen], [needed for _, _, _, needed in chosen])
        self.grams = None

    def _seeds_of(self, item, documents):
        """Word seeds, how many of them have to be there, pair seeds, and how many of those."""
        words, pairs, least, size = self.words[item], self.pairs[item], self.settings.least_seeds, len(self.words[item])
        count = lambda hashes: documents[np.searchsorted(self.grams.keys, hashes)]
        word_order, pair_order = np.argsort(count(words), kind="stable"), np.argsort(count(pairs), kind="stable")
        if self.short[item]:  # all its words have to be there
            return words[word_order[:least]], min(least, size), pairs[:0], _NEVER
        word_cost = np.concatenate([[0], np.cumsum(count(words)[word_order])])
        pair_cost = np.concatenate([[0], np.cumsum(count(pairs)[pair_order])])
        choices = []
        for whole in range(1, size + 1):  # pairs from which on the pairs decide
            matched = self._fewest_words(item, whole)
            need_words = min(least, matched) if matched <= size else 0
            need_pairs = min(least, whole) if whole < size else 0
            # so many can be missed, and so many more are found
            take_words = size - matched + need_words if need_words else 0
            take_pairs = size - 1 - whole + need_pairs if need_pairs else 0
            choices.append((int(word_cost[take_words] + pair_cost[take_pairs]), take_words, need_words or _NEVER, take_pairs, need_pairs or _NEVER))
        _, take_words, need_words, take_pairs, need_pairs = min(choices)
        return words[word_order[:take_words]], need_words, pairs[pair_order[:take_pairs]], need_pairs

    def _fewest_words(self, item, whole):
        """Least matched words of an accepted alignment with fewer than ``whole`` pairs."""
        match, needed = self.settings.match, int(self.needed[item])
        least = -(-needed // match)
        rest = needed - self.error * whole
        if rest > 0:
            least = max(least, -(-rest // (match - self.error))) if match > self.error else len(self.words[item]) + 1
        return max(least, 1)

    def bound(self, words, pairs):
        """Most points of an alignment that matches at most so many words, and so many
        words together with the next."""
        return (self.settings.match - self.error) * words + self.error * (pairs + 1)

    def candidates(self, words, pairs, bounds):
        """(row, item, seeds) of rows that hold seeds enough of an item; ``bounds`` parts the rows."""
        single, pair = self.word_seeds.found(words, bounds, 0), self.pair_seeds.found(pairs, bounds, 1)
        both, place = np.unique(np.concatenate([single[0], pair[0]]), return_inverse=True)
        seeds = np.bincount(place, np.concatenate([single[1], pair[1]]), len(both)).astype(np.int64)
        enough = np.bincount(place, np.concatenate([single[2], pair[2]]), len(both)) > 0
        both, seeds = both[enough], seeds[enough]
        return zip((both // len(self.ids)).tolist(), (both % len(self.ids)).tolist(), seeds.tolist())

    def windows(self, item, words, pairs):
        """Stretches (first, last) of a document that can hold ``item``. They overlap, so
        that each passage lies in one of them."""
        reach = int(self.reach[item])
        count = max(-(-len(words) // reach) - 1, 1)
        single = _per_window(self.words[item], words, reach, count, 0)
        common = _per_window(self.pairs[item], pairs, reach, count, 1)
        for number in np.flatnonzero(self.bound(single, common) >= self.needed[item]):
            yield number * reach, min((number + 2) * reach, len(words))

    def line(self, item, words, begins):
        """Where ``item`` is a whole line of a document: place of its first word, or -1."""
        own = self.words[item]
        at = np.flatnonzero((words == own[0]) & begins[:-1])
        at = at[at + len(own) <= len(words)]
        at = at[begins[at + len(own)]]
        for place in at[words[at + len(own) - 1] == own[-1]]:
            inside = slice(place, place + len(own))
            if np.array_equal(words[inside], own) and not begins[place + 1 : place + len(own)].any():
                return int(place)
        return -1

    def best_passage(self, item, words, pairs):
        """Score, first and last word of the best accepted passage, or None."""
        if self.short[item]:
            return self._all_in_order(item, words)
        most = None
        for low, high in self.windows(item, words, pairs):
            found = align(self.words[item], words[low:high], self.settings)
            if found[0] >= self.needed[item] and (most is None or found[0] > most[0]):
                most = (found[0], low + found[1], low + found[2])
        return most

    def _all_in_order(self, item, words):
        """The same for a short item, all of whose words match: the shortest passage that
        has them in order. The latest start of each beginning of the item is carried along."""
        own, places = self.words[item], np.arange(len(words))
        start = np.where(words == own[0], places, -1)
        for word in own[1:]:
            before = np.concatenate([[-1], np.maximum.accumulate(start)[:-1]])
            start = np.where(words == word, before, -1)
        ends = np.flatnonzero(start >= 0)
        if not len(ends):
            return None
        end = int(ends[np.argmin(ends - start[ends])])
        begin = int(start[end])
        score = int(self.best[item]) + self.settings.gap * (end - begin + 1 - len(own))
        return (score, begin, end) if score >= self.needed[item] else None


def _per_window(own, hashes, reach, count, short):
    """How many places of ``own`` each of ``count`` windows of ``hashes`` has; they begin
    every ``reach`` places and are ``2 * reach - short`` long."""
    keys, times = np.unique(own, return_counts=True)
    if not len(keys):
        return np.zeros(count, np.int64)
    number = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    at = np.flatnonzero(keys[number] == hashes)
    window, inside, number = at // reach, at % reach, number[at]
    earlier = inside < reach - short
    window, number = np.concatenate([window, window[earlier] - 1]), np.concatenate([number, number[earlier]])
    real = (window >= 0) & (window < count)
    seen = np.zeros((count, len(keys)), bool)
    seen[window[real], number[real]] = True
    return seen @ times


def _pairs(words):
    return hashing.mix(hashing.mix(words[:-1]) * np.uint64(0x9E3779B97F4A7C15) + words[1:])


def _slices(column):
    """For slices of rows: first row, words of all its rows, whether a line begins there
    (one more at the end), and where the words of each row begin."""
    data, offsets = hashing.column_bytes(column)
    for first, last in hashing.row_slices(offsets):
        part, rows = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        starts, ends = hashing.word_spans(part, rows, terms=True, characters=True)
        lines = np.searchsorted(np.flatnonzero((part == 10) | (part == 13)), starts)
        bounds = np.searchsorted(starts, rows)
        begins = np.ones(len(starts) + 1, bool)
        begins[1:-1] = lines[1:] != lines[:-1]
        begins[bounds] = True
        yield first, hashing.word_hashes(part, starts, ends), begins, bounds


def align(item, passage, settings):
    """Best local alignment of two word sequences: score, first and last word in the passage.

    One row of the table per item word. Gaps along the passage are a running maximum. The
    best score is followed back to its start by carrying the start with every cell.
    """
    width = len(passage)
    steps = np.arange(width + 1) * settings.gap
    above, begun = np.zeros(width + 1, np.int64), np.arange(width + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = above[:-1] + np.where(passage == word, settings.match, settings.mismatch)
        cells, origin = np.zeros(width + 1, np.int64), np.arange(width + 1)
        down = above[1:] + settings.gap
        cells[1:], origin[1:] = np.where(diagonal >= down, diagonal, down), np.where(diagonal >= down, begun[:-1], begun[1:])
        fresh = cells <= 0
        cells[fresh] = 0
        origin[fresh] = np.arange(width + 1)[fresh]
        lifted = cells - steps
        reach = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == reach, np.arange(width + 1), 0))
        above, begun = reach + steps, origin[source]
        top = int(above.argmax())
        if above[top] > best[0]:
            best = (int(above[top]), int(begun[top]), top - 1)
    return best

def _counter(broadcast):
    """How many documents of a task have each n-gram of the items."""

    def rows(batches):
        grams = broadcast.value.grams
        size = max(len(grams.keys), 1)
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for _, words, _, bounds in _slices(batch.column("text")):
                found = [_in_rows(grams, hashes, bounds, short, size) for hashes, short in ((words, 0), (_pairs(words), 1))]
                counts += np.bincount(np.unique(np.concatenate(found)) % size, minlength=size)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], ["gram", "documents"])

    return rows


def _aligner(broadcast):
    """The best alignment of each document with each item of which it has a seed."""

    def rows(batches):
        block = broadcast.value
        for batch in batches:
            found = []
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
            for first, words, begins, bounds in _slices(batch.column("text")):
                pairs = _pairs(words)
                for row, item, seeds in block.candidates(words, pairs, bounds):
                    low, high = bounds[row], bounds[row + 1]
                    own = words[low:high]
                    passage = _passage(block, item, own, pairs[low : high - 1], begins[low : high + 1])
                    if passage:
                        score, begin, end, sure = passage
                        around = _surroundings(own, begin, end, block.settings.context_words)
                        found.append((ids[first + row], keys[first + row], block.ids[item], score, score / float(block.best[item]), seeds, begin, end, sure, *around))
            columns = list(zip(*found)) if found else [[]] * len(_KINDS)
            arrays = [pa.array([v.item() if hasattr(v, "item") else v for v in c], kind) for c, (_, kind, _) in zip(columns, _KINDS)]
            yield pa.RecordBatch.from_arrays(arrays, [name for name, _, _ in _KINDS])

    return rows


def _passage(block, item, words, pairs, begins):
    """Score, first and last word, and whether it counts even as a common phrase."""
    line = block.line(item, words, begins) if block.short[item] else -1
    if line >= 0:
        return int(block.best[item]), line, line + len(block.words[item]) - 1, True
    most = None if block.line_only[item] else block.best_passage(item, words, pairs)
    if most is None:
        return None
    return (*most, bool(not block.short[item] and most[0] >= block.settings.whole_share * block.best[item]))


def _surroundings(words, begin, end, reach):
    """Hashes of the words of a passage and of those around it."""
    outside = np.concatenate([words[max(begin - reach, 0) : begin], np.zeros(1, np.uint64), words[end + 1 : end + 1 + reach]])
    return tuple(int(hashing.signed(_sequence(part))[0]) for part in (words[begin : end + 1], outside))


def _sequence(words):
    places = np.arange(1, len(words) + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    return hashing.mix(np.atleast_1d(hashing.mix(words + hashing.mix(places)).sum(dtype=np.uint64)))


def _blocks(benchmark, settings):
    """Blocks of items, one at a time; null and empty items take no part."""
    items = kept(benchmark.select("item_id", "text").filter("text IS NOT NULL"))
    size = F.octet_length("text")
    total = items.agg(F.sum(size)).first()[0] or 0
    count = max(1, -(-total // settings.block_bytes))
    for number in range(count):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number).toArrow()
        ids, words = [], []
        for batch in part.to_batches():
            names = batch.column("item_id").to_pylist()
            for first, rows, hashes, bounds in hashing.texts_of_words(batch.column("text"), terms=True, characters=True):
                for row in range(rows):
                    if bounds[row + 1] > bounds[row]:
                        ids.append(names[first + row])
                        words.append(hashes[bounds[row] : bounds[row + 1]])
        if ids:
            yield Block(ids, words, settings)


def _alignments(docs, block):
    """Stored alignments of one block. Only one block is broadcast at a time."""
    context = docs.sparkSession.sparkContext
    counted = context.broadcast(block)
    grams = docs.select("text").mapInArrow(_counter(counted), "gram long, documents long")
    # one row for each n-gram of the block at most
    table = grams.groupBy("gram").agg(F.sum("documents").alias("documents")).toArrow()
    documents = np.zeros(len(block.grams.keys), np.int64)
    documents[table.column("gram").to_numpy()] = table.column("documents").to_numpy()
    counted.destroy()
    block.choose_seeds(documents)
    shared = context.broadcast(block)
    found = kept(docs.mapInArrow(_aligner(shared), _RESULT))
    shared.destroy()
    return found


def contaminated(docs, benchmark, settings=None):
    """One row per document and test item that it contains, edited or not.

    ``docs`` (doc_id, text), ``benchmark`` (item_id, text). Gives doc_id, text_key (a hash
    of the text, to find the row again), item_id, score, similarity (score against that of
    the whole item), seeds (seeds of the item in the document), first_word and last_word of
    the passage. Case and punctuation do not count; characters of scripts without spaces
    count as words. Items of one or two words count where they are a whole line, items of
    up to seven where all their words stand in order, longer ones by their score; a common
    phrase counts as a whole line or nearly whole item only. Null and empty texts and items
    hold nothing; repeated rows and items each give a row; empty tables give no rows; other
    columns are ignored.
    """
    settings = settings or Settings()
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = spark.createDataFrame([], _RESULT)
    for block in _blocks(benchmark, settings):
        found = found.unionAll(_alignments(docs, block))
    limit = max(settings.common_contexts, settings.common_share * docs.count())
    phrases = found.filter("NOT sure").select("phrase", "context").distinct().groupBy("phrase").count()
    common = kept(phrases.filter(F.col("count") > limit).select("phrase", F.lit(False).alias("sure")))
    return found.join(sized(common), ["phrase", "sure"], "left_anti").drop("sure", "phrase", "context")


def without_contaminated(docs, benchmark, settings=None):
    """The rows of ``docs`` that hold no test item, unchanged."""
    found = kept(contaminated(docs, benchmark, settings).select(F.col("doc_id").alias("bad_id"), "text_key").distinct())
    key = free_name(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(found["bad_id"]) & (keyed[key] == found["text_key"])
    return keyed.join(sized(found), same, "left_anti").select(*docs.columns)
