"""Near-duplicate documents by a size-aware, heavy-light set similarity join.

Documents are sets of word shingles; two are linked if their Jaccard similarity reaches a
threshold. Equal sets are one class; everything below works on classes.

Sets up to a boundary size are *light*. A pair of sizes (s, t) needs an overlap c(s, t), so
light sets emit all their subsets of exactly that size: sharing one proves the link, and no
set has to be looked at again. Larger sets are *heavy*. They scan inverted lists: under any
fixed order of shingles, linked sets share a shingle among their first few, so only these
are posted. The boundary is the size at which the subsets of all light sets, counted from
the histogram of sizes, and the scanning of the other lists cost least together.

Order of shingles: rare ones first, so that what is special to a document stands before
what it shares with many. It decides the cost only; results do not depend on it.

No list is expanded into all its pairs. Members are first verified against two hubs per
list; this connects groups of copies with as many pairs as members. Only members of one
list that still lie in different components are then paired, if sizes and places in the
order leave enough overlap possible, and verified. No link that connects anything is lost.
"""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from emberwatch.llm import hashing
from emberwatch.llm.common import kept, parts_for, sized
from emberwatch.llm.components import components

#: Shingles in more documents than this are moved to the end of the order.
FREQUENT = 8
#: Most of them that are moved, the more frequent first. Bounds the broadcast.
FREQUENT_KEPT = 1 << 19
#: Largest set that can be light: larger ones would emit more than this many subsets.
SUBSETS = 4096
#: Cost of a posting in an inverted list, with the verification that follows, in subsets.
POSTING_COST = 9
BINS = 32
#: Shingles that a task counts before it hands the counts on, and those of a range of the hash space.
BLOCK = 1 << 21
#: Ranges of the hash space at least, so that small tables are dealt over many tasks too.
RANGES = 1 << 10
#: First bits of a hash by which most shingles are known not to be frequent.
FIRST_BITS = 22
#: Rows or shingles that a task hands on at once.
_ROWS_AT_ONCE = 1 << 17


def overlap(s, t, threshold):
    """Smallest overlap with which sets of these sizes reach the threshold."""
    return math.ceil(threshold * (s + t) / (1 + threshold))


def prefix_length(size, threshold):
    return size - math.ceil(threshold * size) + 1


def prefix_lengths(sizes, threshold):
    """``prefix_length`` of many sizes."""
    p, q = threshold.numerator, threshold.denominator
    return sizes - (p * sizes + q - 1) // q + 1


def partner_sizes(size, threshold):
    return range(math.ceil(threshold * size), math.floor(size / threshold) + 1)


def subset_count(size, threshold, top=None):
    """Subsets that a light set of this size emits, with partners up to size ``top``."""
    sizes = [t for t in partner_sizes(size, threshold) if top is None or t <= top]
    return sum(math.comb(size, overlap(size, t, threshold)) for t in sizes)


def light_boundary(histogram, threshold):
    """Size up to which enumerating subsets costs less than scanning lists.

    ``histogram``: classes per set size, for the sizes that could be light.
    """
    sizes = []
    while subset_count(len(sizes) + 1, threshold) <= SUBSETS:
        sizes.append(len(sizes) + 1)
    costs = {}
    for top in [0, *sizes]:
        light = sum(histogram.get(s, 0) * subset_count(s, threshold, top) for s in sizes if s <= top)
        posted = [s for s in sizes if s > top or s >= threshold * top]
        costs[top] = light + sum(histogram.get(s, 0) * prefix_length(s, threshold) * POSTING_COST for s in posted)
    return min(costs, key=lambda top: (costs[top], top))


# --- sets from texts


def shingle_sets(words, bounds, width):
    """Sets of the hashed shingles of texts, one after another, and their bounds.

    ``bounds`` are those of the texts in ``words``. Each set is in ascending order. A text
    of fewer words than ``width`` is one shingle.
    """
    counts = np.diff(bounds)
    ends = np.cumsum(np.where(counts > width, counts - width + 1, np.minimum(counts, 1)))
    starts = np.concatenate([[0], ends[:-1]])
    at = np.arange(ends[-1]) + np.repeat(bounds[:-1] - starts, ends - starts)
    sizes = np.repeat(np.minimum(counts, width), ends - starts)
    hashes = sizes.astype(np.uint64)
    some_short = bool((sizes < width).any())
    for place in range(width):
        following = words[np.minimum(at + place, len(words) - 1)] if some_short else words[at + place]
        longer = hashing.mix(hashes * np.uint64(0x9E3779B97F4A7C15) + following)
        hashes = np.where(place < sizes, longer, hashes) if some_short else longer
    for low, high in zip(starts.tolist(), ends.tolist()):
        hashes[low:high].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[starts[ends > starts]] = True
    kept_before = np.concatenate([[0], np.cumsum(new)])
    return hashes[new], kept_before[np.concatenate([[0], ends])]


def _sets(batch, width):
    """For slices of rows: the rows with words, their sets one after another, and the bounds of these."""
    for first, _, words, bounds in hashing.texts_of_words(batch.column("text"), hashed=hashing.quick_word_hashes):
        if len(words):
            hashes, bounds = shingle_sets(words, bounds, width)
            filled = np.flatnonzero(np.diff(bounds))
            yield first + filled, hashes, np.append(bounds[filled], bounds[-1])


def _class_keys(hashes, bounds):
    """96 bits that name each set."""
    first = hashing.mix(np.add.reduceat(hashes, bounds[:-1]))
    second = hashing.mix(np.add.reduceat(hashes * (hashes | np.uint64(1)), bounds[:-1]) ^ first)
    first, second = (part.astype(">u8").view(np.uint8).reshape(-1, 8) for part in (first, second))
    names = np.concatenate([first, second[:, :4]], axis=1).tobytes()
    return [names[at : at + 12] for at in range(0, len(names), 12)]


def _bins(hashes, bounds):
    """Shingles of each set per bin of the hash space, modulo 256."""
    sets = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) * BINS
    bins = sets + ((hashes >> np.uint64(20)) % np.uint64(BINS)).astype(np.int64)
    counts = np.bincount(bins, minlength=BINS * (len(bounds) - 1)).astype(np.uint8).tobytes()
    return [counts[at : at + BINS] for at in range(0, len(counts), BINS)]


def _describe(width):
    def rows(batches):
        for batch in batches:
            count = batch.num_rows
            sizes, keys, bins = np.zeros(count, np.int64), [None] * count, [None] * count
            for filled, hashes, bounds in _sets(batch, width):
                sizes[filled] = np.diff(bounds)
                for row, key, counted in zip(filled.tolist(), _class_keys(hashes, bounds), _bins(hashes, bounds)):
                    keys[row], bins[row] = key, counted
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes), pa.array(keys, pa.binary()), pa.array(bins, pa.binary())],
                ["doc_id", "text_key", "size", "cls", "bins"],
            )

    return rows


def _range_width(ranges):
    """Width of equal ranges of 64-bit hashes."""
    return ((1 << 64) - 1) // ranges + 1


def _block_rows(hashes, ranges):
    """Counts of ``hashes``, a row for each range of the hash space."""
    values, counts = np.unique(hashes, return_counts=True)
    owner = (values // np.uint64(_range_width(ranges))).astype(np.int64)
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    ends = np.append(starts[1:], len(values)).tolist()
    blocks = [(pa.py_buffer(part), size) for part, size in ((values, 8), (counts.astype(np.uint32), 4))]
    shingles, times = ([buffer[size * low : size * high].to_pybytes() for low, high in zip(starts.tolist(), ends)] for buffer, size in blocks)
    return pa.RecordBatch.from_arrays(
        [pa.array(owner[starts].astype(np.int32)), pa.array(shingles, pa.binary()), pa.array(times, pa.binary())],
        ["part", "shingles", "times"],
    )


def _counted(width, ranges):
    def rows(batches):
        found, size = [], 0
        for batch in batches:
            for _, hashes, _ in _sets(batch, width):
                found.append(hashes)
                size += len(hashes)
                if size > BLOCK:
                    yield _block_rows(np.concatenate(found), ranges)
                    found, size = [], 0
        if size:
            yield _block_rows(np.concatenate(found), ranges)

    return rows


def _often(table):
    """Shingles of one range that are in more than ``FREQUENT`` documents."""
    values = np.frombuffer(b"".join(table.column("shingles").to_pylist()), np.uint64)
    times = np.frombuffer(b"".join(table.column("times").to_pylist()), np.uint32)
    order = np.argsort(values)
    values, times = values[order], times[order].astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    totals = np.add.reduceat(times, starts)
    often = totals > FREQUENT
    return pa.table({"shingle": pa.array(hashing.signed(values[starts[often]])), "count": pa.array(totals[often])})


def often_counted(docs, width, total):
    """(shingle, count) of all shingles in more than ``FREQUENT`` documents.

    A row of the shuffle holds the counts that a task has in one range of the hash space, as
    bytes. There are as many ranges as ``total``, the sum of all set sizes, asks for, so that a range
    fits a task whatever the size of the table; a shingle comes once from a block, however common.
    """
    ranges = max(RANGES, parts_for(total, BLOCK))
    blocks = docs.select("text").mapInArrow(_counted(width, ranges), "part int, shingles binary, times binary")
    return blocks.groupBy("part").applyInArrow(_often, "shingle long, count long")


def among(frequent):
    """A test which hashes are in ``frequent`` (sorted). Most are ruled out by their first bits."""
    shift = np.uint64(64 - FIRST_BITS)
    seen = np.zeros(1 << FIRST_BITS, bool)
    seen[frequent >> shift] = True

    def test(hashes):
        found = seen[hashes >> shift]
        maybe = np.flatnonzero(found)
        if len(maybe):
            values = hashes[maybe]
            place = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
            found[maybe] = frequent[place] == values
        return found

    return test


def first_in_order(hashes, bounds, lengths, is_frequent):
    """The first ``lengths`` of each set, in the order that all sets share: frequent shingles
    last, and ascending. Returns places in ``hashes``, sets, and places in their order."""
    sets = np.repeat(np.arange(len(lengths)), np.diff(bounds))
    rare = ~is_frequent(hashes)
    rare_before = np.concatenate([[0], np.cumsum(rare)])
    rares = np.diff(rare_before[bounds])
    rare_place = rare_before[:-1] - rare_before[bounds[:-1]][sets]
    place = np.where(rare, rare_place, rares[sets] + np.arange(len(hashes)) - bounds[:-1][sets] - rare_place)
    chosen = np.flatnonzero(place < lengths[sets])
    return chosen, sets[chosen], place[chosen]


def frequent_shingles(counts):
    """The most frequent of ``counts`` (shingle, count), at most ``FREQUENT_KEPT`` of them."""
    level = F.floor(F.log2("count") * 8).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("shingles")).collect()
    least, total = 1 << 30, 0
    for row in sorted(levels, key=lambda row: -row["level"]):
        total += row["shingles"]
        if total > FREQUENT_KEPT:
            break
        least = row["level"]
    chosen = counts.filter(level >= least).select("shingle").toArrow().column("shingle")
    return np.sort(chosen.to_numpy().astype(np.int64).view(np.uint64))


def _subset_keys(hashes, low_size, high_size, threshold):
    """Keys of all subsets of the overlap that sizes (low, high) need."""
    size, need = len(hashes), overlap(low_size, high_size, threshold)
    second = hashing.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    totals = [(part.sum(dtype=np.uint64), np.zeros(1, np.uint64), part) for part in (hashes, second)]
    last = np.full(1, -1)
    gone = [total[1] for total in totals]
    for _ in range(size - need):  # leave out one more element, in ascending order
        taken = [(index, np.arange(start + 1, size)) for index, start in enumerate(last)]
        parents = np.concatenate([np.full(len(new), index) for index, new in taken])
        last = np.concatenate([new for _, new in taken])
        gone = [gone[k][parents] + totals[k][2][last] for k in range(2)]
    tag = np.uint64(low_size * 1000 + high_size)
    return hashing.mix((totals[0][0] - gone[0]) ^ hashing.mix((totals[1][0] - gone[1]) + tag))


def _post(width, threshold, boundary, frequent):
    """Postings (key, cls, size, place, leads): subsets of light sets, first shingles of others.

    ``place`` is that of the shingle in its set. ``leads`` is null in inverted lists; in
    lists of subsets it marks the smaller size of the pair, whose members are linked with
    all others of the list.
    """

    def rows(batches):
        is_frequent = among(frequent.value if hasattr(frequent, "value") else frequent)
        for batch in batches:
            parts, total = [], 0

            def flush():
                names = pa.array([name for part in parts for name in part[1]], pa.binary())
                offsets = np.cumsum([0, *(len(part[1]) for part in parts)])
                owners = np.concatenate([part[2] + offset for part, offset in zip(parts, offsets)])
                keys, sizes, places = (np.concatenate([part[k] for part in parts]) for k in (0, 3, 4))
                leads = [pa.nulls(len(part[0]), pa.bool_()) if part[5] is None else pa.array(part[5]) for part in parts]
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashing.signed(keys)),
                        names.take(pa.array(owners)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(places.astype(np.int32)),
                        pa.concat_arrays(leads),
                    ],
                    ["key", "cls", "size", "place", "leads"],
                )

            for _, hashes, bounds in _sets(batch, width):
                sizes, names = np.diff(bounds), _class_keys(hashes, bounds)
                posts = (sizes > boundary) | (sizes * threshold.denominator >= threshold.numerator * boundary)
                lengths = np.zeros(len(sizes), np.int64)
                lengths[posts] = prefix_lengths(sizes[posts], threshold)
                chosen, owners, places = first_in_order(hashes, bounds, lengths, is_frequent)
                parts.append((hashes[chosen], names, owners, sizes[owners], places, None))
                total += len(chosen)
                for row in np.flatnonzero(sizes <= boundary).tolist():
                    size, items = int(sizes[row]), hashes[bounds[row] : bounds[row + 1]]
                    for other in partner_sizes(size, threshold):
                        if other <= boundary:
                            low, high = min(size, other), max(size, other)
                            keys = _subset_keys(items, low, high, threshold)
                            count = len(keys)
                            ones = np.zeros(count, np.int64)
                            parts.append((keys, names[row : row + 1], ones, ones + size, np.arange(count), np.full(count, size == low)))
                            total += count
                if total > _ROWS_AT_ONCE:
                    yield flush()
                    parts, total = [], 0
            if total:
                yield flush()

    return rows


def _set_rows(keys, sets):
    offsets = np.concatenate([[0], np.cumsum([len(part) for part in sets])]).astype(np.int32)
    values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), values], ["cls", "items"])


def _wanted_sets(width):
    def rows(batches):
        for batch in batches:
            keys, sets, total = [], [], 0
            for _, hashes, bounds in _sets(batch, width):
                keys.extend(_class_keys(hashes, bounds))
                sets.extend(np.split(hashing.signed(hashes), bounds[1:-1]))
                total += len(hashes)
                if total > _ROWS_AT_ONCE:
                    yield _set_rows(keys, sets)
                    keys, sets, total = [], [], 0
            if keys:
                yield _set_rows(keys, sets)

    return rows


# --- candidates and links


def _bins_apart(first, second):
    """Pairs whose bins already differ by more than the threshold allows are no links."""

    def rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(-1, BINS) for n in (first, second))
            apart = (one - two).astype(np.int16)
            apart = np.minimum(apart, 256 - apart).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), batch.column("need"), pa.array(apart.astype(np.int64)), batch.column("total")],
                ["a", "b", "need", "apart", "total"],
            )

    return rows


def _verified(pairs, classes, docs, width, threshold):
    """Those of ``pairs`` (a, b) that are links.

    Bin counts rule out most pairs that share only a few shingles; the rest are decided on
    the whole sets, which are made again from one text of each class.
    """
    ratio = Fraction(threshold)
    facts = classes.select("cls", "size", "bins")
    a, b = (facts.toDF(name, f"{name}_size", f"{name}_bins") for name in ("a", "b"))
    total = F.col("a_size") + F.col("b_size")
    # smallest overlap: p * total / (p + q), rounded up, for the threshold p / q
    p, q = ratio.numerator, ratio.denominator
    need = F.expr(f"({p} * (a_size + b_size) + {p + q - 1}) div {p + q}")
    near = (
        pairs.join(a, "a").join(b, "b")
        .filter(F.lit(q) * F.least("a_size", "b_size") >= F.lit(p) * F.greatest("a_size", "b_size"))
        .select("a", "b", "a_bins", "b_bins", need.alias("need"), total.alias("total"))
        .mapInArrow(_bins_apart("a_bins", "b_bins"), "a binary, b binary, need long, apart long, total long")
        .filter("apart <= total - 2 * need")
        .select("a", "b", "need")
    )
    near = kept(near, release=True)
    wanted = near.select(F.col("a").alias("cls")).unionAll(near.select(F.col("b").alias("cls"))).distinct()
    ids = kept(classes.join(wanted, "cls", "left_semi").select(F.col("doc_id").alias("id")))
    texts = docs.join(sized(ids), docs["doc_id"].eqNullSafe(F.col("id")), "left_semi")
    # doc ids can repeat, and so can classes then: one set of each class is enough
    sets = texts.mapInArrow(_wanted_sets(width), "cls binary, items array<long>").join(wanted, "cls", "left_semi")
    sets = kept(sets.groupBy("cls").agg(F.first("items").alias("items")), release=True)
    # members first: a hub with many members then makes a large partition, which Spark splits
    with_b = near.join(sets.select(F.col("cls").alias("b"), F.col("items").alias("b_items")), "b")
    both = with_b.join(sets.select(F.col("cls").alias("a"), F.col("items").alias("a_items")), "a")
    return both.filter(F.size(F.array_intersect("a_items", "b_items")) >= F.col("need")).select("a", "b")


def _as_pairs(frame, one, two):
    """Distinct pairs of different classes, lower one second: hubs come first as ``a``."""
    return frame.select(F.col(one).alias("a"), F.col(two).alias("b")).filter("a != b").distinct()


def jaccard_links(docs, width=5, threshold=Fraction(4, 5)):
    """Classes of equal sets, and enough links between them to give all components.

    Returns ``described`` (doc_id, text_key, size, cls; null cls for documents without words),
    ``classes`` (cls, size, bins, doc_id: its smallest) and ``links`` (a, b), every one of
    which reaches the threshold exactly. Links that connect nothing new may be missing.
    """
    threshold = Fraction(threshold)
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    described = kept(docs.mapInArrow(_describe(width), "doc_id long, text_key long, size long, cls binary, bins binary"))
    full = described.filter("cls IS NOT NULL")
    classes = kept(full.groupBy("cls").agg(F.max("size").alias("size"), F.max("bins").alias("bins"), F.min("doc_id").alias("doc_id")))
    spark = docs.sparkSession

    total = full.agg(F.sum("size")).first()[0] or 0
    frequent = frequent_shingles(kept(often_counted(docs, width, total), release=True))
    histogram = {row["size"]: row["count"] for row in classes.filter(F.col("size") <= 128).groupBy("size").count().collect()}
    boundary = light_boundary(histogram, threshold)

    frequent = spark.sparkContext.broadcast(frequent)
    postings = docs.mapInArrow(_post(width, threshold, boundary, frequent), "key long, cls binary, size long, place int, leads boolean").distinct()
    postings = postings.withColumn("subsets", F.col("leads").isNotNull())
    lists = postings.groupBy("key", "subsets").count().filter("count > 1").drop("count")
    members = kept(postings.join(lists, ["key", "subsets"], "left_semi"), release=True)
    # hubs are those with the fewest rare shingles of their own before the common one
    lead = F.when(F.coalesce("leads", F.lit(True)), F.struct(F.col("place"), F.col("cls")))
    far = F.when(F.coalesce("leads", F.lit(True)), F.struct(-F.col("place"), F.col("cls")))
    hubs = members.groupBy("key", "subsets").agg(F.min(lead).alias("low"), F.max(far).alias("high"))
    hubs = hubs.filter("low IS NOT NULL").select("key", "subsets", F.col("low.cls").alias("low"), F.col("high.cls").alias("high"))
    members = kept(members.join(hubs, ["key", "subsets"]), release=True)

    sure = _as_pairs(members.filter("subsets"), "low", "cls")
    scanned = members.filter("NOT subsets").select("key", "cls", "size", "place", "low", "high")
    tried = _as_pairs(scanned, "low", "cls").unionAll(_as_pairs(scanned, "high", "cls"))
    tried = tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = kept(sure.unionAll(_verified(tried, classes, docs, width, threshold)), release=True)

    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    places = scanned.join(roots, scanned["cls"] == roots["node"], "left").select(
        "key", "cls", "size", "place", "low", "high", F.coalesce("root", "cls").alias("root")
    )
    # lists whose members all lie in one component have nothing more to give
    spread = places.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("other")).filter("one != other")
    open_lists = kept(places.join(spread.select("key"), "key", "left_semi"))
    rest = _open_pairs(open_lists, threshold)
    return described, classes, kept(links.unionAll(_verified(rest, classes, docs, width, threshold)))


def _open_pairs(lists, threshold):
    """Pairs of one list in different components that can still be links.

    The first shingle that two linked sets share leaves room for their overlap behind it in
    both. For the smaller set this holds within a shorter prefix, whatever the partner.
    """
    p, q = threshold.numerator, threshold.denominator
    need = f"({p} * (l_size + r_size) + {p + q - 1}) div {p + q}"
    own = f"size - ({2 * p} * size + {p + q - 1}) div {p + q}"
    small = lists.filter(f"place <= {own}").select("key", *[F.col(name).alias(f"l_{name}") for name in lists.columns[1:]])
    large = lists.select("key", *[F.col(name).alias(f"r_{name}") for name in lists.columns[1:]])
    fits = F.expr(
        f"l_root != r_root AND (l_size < r_size OR l_size = r_size AND l_cls < r_cls) AND {q} * l_size >= {p} * r_size"
        f" AND least(l_size - l_place, r_size - r_place) >= {need}"
        " AND l_cls NOT IN (r_low, r_high) AND r_cls NOT IN (l_low, l_high)"
    )
    pairs = small.join(large.withColumnRenamed("key", "r_key"), (F.col("key") == F.col("r_key")) & fits)
    return pairs.select(F.greatest("l_cls", "r_cls").alias("a"), F.least("l_cls", "r_cls").alias("b")).distinct()


def _with_roots(docs, width, threshold):
    """``described``, and for every class its root, the lowest class of its component."""
    described, classes, links = jaccard_links(docs, width, threshold)
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    placed = classes.join(roots, classes["cls"] == roots["node"], "left")
    return described, kept(placed.select("cls", "doc_id", F.coalesce("root", "cls").alias("root")))


def near_duplicate_components(docs, width=5, threshold=Fraction(4, 5)):
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links reach. Null and empty texts and those
    without words have no shingles and stay alone. A text of fewer words than ``width`` is
    one shingle. Repeated rows are linked with each other, and each gives a row. Of a null
    doc_id nothing is known but its links: it never becomes the smallest of others.
    An empty table gives no rows; other columns are ignored.
    """
    described, placed = _with_roots(docs, width, threshold)
    lowest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(lowest, "root").select("cls", "component_id")
    return described.join(named, "cls", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def without_near_duplicates(docs, width=5, threshold=Fraction(4, 5)):
    """One row of ``docs`` of each component, unchanged: that with the smallest doc_id.

    Of rows that share it, that with the lowest hash of the text stays, and of equal texts
    the row that is smallest in all columns. Rows without words all stay.
    """
    described, placed = _with_roots(docs, width, threshold)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    keys = described.join(placed.select("cls", "root"), "cls")
    best = keys.groupBy("root").agg(F.min(key).alias("best")).select("best.doc_id", "best.text_key", F.lit(True).alias("single"))
    bare = described.filter("cls IS NULL").select("doc_id", "text_key", F.lit(False).alias("single")).distinct()
    chosen = best.unionAll(bare).select(F.col("doc_id").alias("best_id"), F.col("text_key").alias("best_key"), "single")
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), "doc_id", F.xxhash64("text").alias("text_key"))
    chosen = kept(chosen)
    same = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("text_key") == F.col("best_key"))
    rows = rows.join(sized(chosen), same)
    repeated = described.filter("cls IS NOT NULL").groupBy("doc_id", "text_key").count().filter("count > 1")
    if not repeated.isEmpty():
        singles = rows.filter("single").groupBy("doc_id", "text_key").agg(F.min("row").alias("row"))
        rows = singles.select("row").unionAll(rows.filter("NOT single").select("row"))
    return rows.select("row.*")
