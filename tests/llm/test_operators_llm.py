"""The operators against brute force and on awkward rows."""

import hashlib
import os
import re
import time
import zlib
from collections import Counter
from fractions import Fraction

import compare
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from emberwatch.llm import chat, decontaminate, hashing, jaccard_join, language, mixing, nearest, pii, sharding, suffix_dedup, toxicity
from emberwatch.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, key string, score string"
LONG = " ".join(f"word{n * n % 977}" for n in range(400))
AWKWARD = [
    (5, LONG, "en", "a", "x", "y"),
    (1, LONG, "en", "a", "x", "y"),
    (1, LONG, "en", "a", "x", "y"),
    (2, LONG + " more", "en", None, None, None),
    (3, None, None, None, None, None),
    (4, "", "en", "b", "x", "y"),
    (6, "one two", "en", "b", "x", "y"),
    (7, "One  Two", "en", "b", "x", "y"),
    (None, "three words only", "en", "b", "x", "y"),
    (8, "é" * 300 + " " + "=" * 3000, "de", "c", "x", "y"),
    (9, "x" * 300_000, "de", "c", "x", "y"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def small(folder):
    return folder


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width):
    found = words(text)
    size = min(width, len(found))
    return frozenset(tuple(found[k : k + size]) for k in range(len(found) - size + 1)) if found else frozenset()


def brute_components(rows, width, threshold):
    sets = [(doc_id, shingles(text, width)) for doc_id, text in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and len(a & b) >= threshold * len(a | b):
                root[find(i)] = find(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            lowest[find(i)] = min(doc_id, lowest.get(find(i), doc_id))
    return sorted(((d, len(s), lowest.get(find(i))) for i, (d, s) in enumerate(sets)), key=str)


@pytest.mark.parametrize("width, threshold", [(3, Fraction(9, 10)), (5, Fraction(4, 5))])
def test_jaccard_components(spark, small, awkward, width, threshold):
    rng = np.random.default_rng(3)
    base = [f"w{n}" for n in range(60)]
    near = []
    for n in range(80):  # copies with up to five changes, cut to different lengths: light and heavy sets
        copy = list(base[: int(rng.integers(4, 61))])
        for _ in range(int(rng.integers(0, 3))):
            copy[int(rng.integers(len(copy)))] = f"v{rng.integers(1000)}"
        near.append((1000 + n, " ".join(copy)))
    frame = awkward.select("doc_id", "text").unionAll(spark.createDataFrame(near, "doc_id long, text string"))
    rows = [tuple(row) for row in frame.collect()]
    got = jaccard_join.near_duplicate_components(frame, width, threshold).collect()
    assert sorted((tuple(row) for row in got), key=str) == brute_components(rows, width, threshold)


def alike_words():
    """Two words of 1,024 letters, different in every letter, that agree in any sum of
    letters times powers of an odd base modulo 2**64."""
    turns = [bin(place).count("1") % 2 for place in range(1024)]
    return tuple("".join("ab"[turn ^ other] for turn in turns) for other in (0, 1))


def test_span_hashes_tell_alike_words_apart():
    one, other = (np.frombuffer(word.encode(), np.uint8) for word in alike_words())
    data = np.concatenate([one, other, one])
    sums = hashing.prefix_sums(data)
    starts = np.array([0, 1024, 2048])
    short = hashing.short_span_hashes(sums, starts, starts + 1024)
    assert short[0] == short[1] == short[2]
    sound = hashing.span_hashes(sums, starts, starts + 1024)
    assert sound[0] == sound[2] != sound[1]
    hashes = hashing.word_hashes(data, starts, starts + 1024)
    assert hashes[0] == hashes[2] != hashes[1]


def test_span_hashes_do_not_depend_on_the_place(monkeypatch):
    monkeypatch.setattr(hashing, "_SUMMED", 1000)
    span = np.random.default_rng(4).integers(0, 256, 1500).astype(np.uint8)
    data = np.concatenate([span[:7], span, span[:901], span])
    sums = hashing.prefix_sums(data)
    got = hashing.span_hashes(sums, np.array([7, 2408, 0]), np.array([1507, 3908, 1500]))
    assert got[0] == got[1] != got[2]
    power, total = 1, 0
    for byte in data[:2600]:
        total, power = (total + (int(byte) + 1) * power) % hashing.PRIME, power * hashing.ROOT % hashing.PRIME
    assert int(sums[1][2600]) % hashing.PRIME == total


def test_alike_words_are_different_texts(spark):
    one, other = alike_words()
    rows = [(1, one), (2, other), (3, f"{one} x y z"), (4, f"{other} x y z"), (5, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.near_duplicate_components(docs, 3, Fraction(9, 10)).collect()
    assert sorted((row.doc_id, row.component_id) for row in got) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 2)]
    cut = {row.doc_id: row.n_removed for row in suffix_dedup.remove_repeats(docs, length=1024).collect()}
    assert cut == {1: 0, 2: 0, 3: 1024, 4: 1024, 5: 1024}
    items = spark.createDataFrame([(1, one)], "item_id long, text string")
    assert sorted(row.doc_id for row in decontaminate.without_contaminated(docs, items).collect()) == [2, 3, 4, 5]
    places = [set(terms.tolist()) for _, _, _, terms in toxicity.hashed_terms(pa.array([one]), 20)]
    assert places != [set(terms.tolist()) for _, _, _, terms in toxicity.hashed_terms(pa.array([other]), 20)]


def made_sets(texts, width):
    """(row, set) of all texts with words, as tasks make them."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    for rows, hashes, bounds in jaccard_join._sets(batch, width):
        for row, low, high in zip(rows.tolist(), bounds, bounds[1:]):
            yield row, hashes[low:high]


def counted_texts():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 12, size)) for size in rng.integers(0, 30, 200)]
    return [None, "", " ", "One", "one two", "x" * 5000, *texts, "x" * 5000, "y " * 40]


def test_sets_of_many_texts_are_those_of_each_text():
    texts = counted_texts()
    names = {}
    for width in (1, 3, 5):
        made = dict(made_sets(texts, width))
        assert sorted(made) == [row for row, text in enumerate(texts) if words(text)]
        for row, hashes in made.items():
            expected = shingles(texts[row], width)
            assert len(hashes) == len(expected) and (np.diff(hashes.astype(object)) > 0).all()
            assert names.setdefault(expected, hashes.tolist()) == hashes.tolist()
    assert len({tuple(hashes) for hashes in names.values()}) == len(names)


def test_shingle_counts_leave_a_task_as_few_rows(monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 500)
    texts, width, ranges = counted_texts() * 3, 3, 8
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    blocks = list(jaccard_join._counted(width, ranges)(iter([batch.slice(0, 100), batch.slice(100)])))
    total = sum(len(hashes) for _, hashes in made_sets(texts, width))
    rows = pa.Table.from_batches(blocks)
    assert 1 < len(blocks) and rows.num_rows <= ranges * len(blocks) < total / 20
    expected = Counter(value for _, hashes in made_sets(texts, width) for value in hashes.tolist())
    got = {}
    for part in set(rows.column("part").to_pylist()):
        for row in jaccard_join._often(rows.filter(pc.equal(rows.column("part"), part))).to_pylist():
            got[row["shingle"] % 2**64] = row["count"]
    assert got == {value: count for value, count in expected.items() if count > jaccard_join.FREQUENT}


def test_counts_of_frequent_shingles(spark):
    texts = counted_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    expected = Counter(value for _, hashes in made_sets(texts, 1) for value in hashes.tolist())
    got = {row["shingle"] % 2**64: row["count"] for row in jaccard_join.often_counted(docs, 1, 2000).collect()}
    assert len(got) and got == {value: count for value, count in expected.items() if count > jaccard_join.FREQUENT}
    assert jaccard_join.often_counted(docs.filter("doc_id < 0"), 1, 0).count() == 0


def test_first_shingles_are_rare_ones_first():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 2**64, size, np.uint64)) for size in (1, 40, 7, 300)]
    hashes, bounds = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    frequent = np.sort(np.concatenate([rng.choice(hashes, 150, replace=False), rng.integers(0, 2**64, 500, np.uint64)]))
    lengths = jaccard_join.prefix_lengths(np.diff(bounds), Fraction(9, 10))
    assert lengths.tolist() == [jaccard_join.prefix_length(len(part), Fraction(9, 10)) for part in sets]
    for known in (frequent, frequent[:0]):
        chosen, owners, places = jaccard_join.first_in_order(hashes, bounds, lengths, jaccard_join.among(known))
        often = set(known.tolist())
        for number, part in enumerate(sets):
            mine = owners == number
            got = [hashes[at] for _, at in sorted(zip(places[mine], chosen[mine]))]
            assert sorted(places[mine]) == list(range(lengths[number]))
            assert got == sorted(part.tolist(), key=lambda value: (value in often, value))[: lengths[number]]


def test_short_words_need_one_sum(monkeypatch):
    data = np.frombuffer(b"one two One " + b"z" * 100 + b" two", np.uint8)
    starts, ends = hashing.word_spans(data, np.array([0, len(data)]))
    long = []
    monkeypatch.setattr(hashing, "span_hashes", lambda sums, low, high, f=hashing.span_hashes: long.extend(high - low) or f(sums, low, high))
    one, two, other, _, again = hashing.quick_word_hashes(data, starts, ends)
    assert one == other != two == again and long == [100]
    # the texts known to agree whatever the base: halves swapped again and again, here as long as a short word can be
    codes = [int(code) for code in hashing.CODES[0]]
    shared = max(((a - b) & -(a - b)).bit_length() - 1 for k, a in enumerate(codes) for b in codes[:k])
    halvings = [(hashing.BASE ** (1 << k) - 1) for k in range((hashing.SHORT - 1).bit_length())]
    assert shared + sum((value & -value).bit_length() - 1 for value in halvings) < 64


def test_subset_sizes_and_boundary():
    assert [jaccard_join.overlap(s, s, Fraction(9, 10)) for s in (1, 9, 18, 19, 38)] == [1, 9, 18, 18, 36]
    assert jaccard_join.light_boundary({}, Fraction(9, 10)) == 0
    assert jaccard_join.light_boundary({5: 100}, Fraction(9, 10)) >= 5
    assert jaccard_join.light_boundary({40: 100}, Fraction(9, 10)) < 40


def test_one_of_each_group_stays(awkward, empty):
    left = jaccard_join.without_near_duplicates(awkward)
    assert left.columns == awkward.columns
    assert sorted(row.doc_id for row in left.collect() if row.doc_id is not None) == [1, 3, 4, 6, 8, 9]
    assert jaccard_join.without_near_duplicates(empty).count() == 0


def brute_removed(rows, length):
    seen, result = set(), {}
    for doc_id, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = True
            seen.add(window)
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        result[doc_id] = (len(data), int(gone.sum()), runs, hashlib.sha256(left).hexdigest())
    return result


def test_suffix_dedup(spark, small, awkward):
    unique = awkward.dropDuplicates(["doc_id"]).filter("doc_id IS NULL OR doc_id != 9")
    docs = unique.select("doc_id", "text").unionAll(table(spark, small, "documents").limit(60).select(F.col("doc_id") + 100, "text"))
    docs = docs.unionAll(spark.createDataFrame([(9, "ab" * 600)], "doc_id long, text string"))
    rows = [tuple(row) for row in docs.collect()]
    expected = brute_removed(rows, 100)
    got = suffix_dedup.remove_repeats(docs, 100).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected


def test_suffix_dedup_of_repeated_rows(awkward, empty):
    got = [row for row in suffix_dedup.remove_repeats(awkward).collect() if row.doc_id == 1]
    assert len(got) == 2 and all(row.n_removed == 0 for row in got)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_decontamination(spark, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()
    edited = item[:5] + ["other"] + item[6:9] + item[10:]
    other = [f"clean{n}" for n in range(60)]
    rows = [(1, " ".join(other[:20] + edited + other[20:])), (2, " ".join(other)), (3, None), (4, ""), (5, " ".join(item).upper() + "!"), (5, " ".join(item))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "too short"), (None, "")], "item_id long, text string")
    got = decontaminate.contaminated(docs, items).collect()
    assert sorted((row.doc_id, row.item_id) for row in got) == [(1, 7), (5, 7), (5, 7)]
    first = next(row for row in got if row.doc_id == 1)
    assert (first.first_word, first.last_word) == (20, 36) and 0.5 < first.similarity < 1
    assert sorted(row.doc_id for row in decontaminate.without_contaminated(docs, items).collect()) == [2, 3, 4]
    assert decontaminate.contaminated(empty, items).count() == 0 and decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_decontamination_of_short_and_unspaced_items(spark):
    chinese, thai = "地球到月球的平均距离是多少公里？", "กรุงเทพมหานครเป็นเมืองหลวง"
    items = spark.createDataFrame([(1, chinese), (2, thai), (3, "Quick brown fox"), (4, "xylophone"), (5, "p q r s")], "item_id long, text string")
    texts = [f"前言。{chinese}后记", "问题：地球到月球的平均距离大约是多少公里", f"x {thai} y", "the quick, brown FOX runs", "a xylophone", "quick brown dog", "月亮很远", "p q x x r s", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontaminate.contaminated(docs, items).collect()
    assert sorted((row.doc_id, row.item_id) for row in got) == [(0, 1), (1, 1), (2, 2), (3, 3), (7, 5)]  # a lone common word is no copy
    assert {row.doc_id for row in decontaminate.without_contaminated(docs, items).collect()} == {4, 5, 6, 8}


def test_decontamination_leaves_common_phrases_alone(spark):
    items = spark.createDataFrame(
        [(1, "Yes"), (2, "What is the capital?"), (3, "Which of the following is a prime number?"), (4, "xylophone")], "item_id long, text string"
    )
    texts = ["The answer is yes.", "What is the best way?", "nothing here", "so\nYES!\nno", "Yes", "xylophone", "What then is the capital now", "the capital is what"]
    common = [f"a{n} b{n} c{n} which of the following options d{n} e{n} f{n}" for n in range(60)]
    leaked = [f"g{n} which of the following is a prime number h{n}" for n in range(60)]
    edited = ["same page says which of the following is some other number in all its copies"] * 60
    docs = spark.createDataFrame(list(enumerate(texts + common + leaked + edited)), "doc_id long, text string")
    got = sorted((row.doc_id, row.item_id) for row in decontaminate.contaminated(docs, items).collect())
    assert got == [(3, 1), (4, 1), (5, 4), (6, 2)] + [(n, 3) for n in range(68, 188)]
    kept = {row.doc_id for row in decontaminate.without_contaminated(docs, items).collect()}
    assert kept == {0, 1, 2, 7} | set(range(8, 68))
    few = docs.filter("doc_id < 3")
    assert decontaminate.without_contaminated(few, items).count() == 3


def test_seeds_let_nothing_accepted_escape():
    rng = np.random.default_rng(11)
    for match, mismatch, gap in ((2, -1, -1), (1, -1, -2), (3, -1, -2), (2, -3, -2)):
        settings = decontaminate.Settings(match=match, mismatch=mismatch, gap=gap, points=25 * match)
        items = [rng.integers(0, 40, int(rng.integers(8, 70))).astype(np.uint64) for _ in range(12)]
        items = [decontaminate.hashing.mix(item) for item in items]
        block = decontaminate.Block(list(range(len(items))), items, settings)
        block.choose_seeds(rng.integers(0, 100, len(block.grams.keys)))
        for _ in range(300):
            item = int(rng.integers(len(items)))
            change = rng.random()
            text = [word for word in items[item] if rng.random() > change / 3]
            for place in sorted(rng.integers(0, len(text) + 1, int(change * len(items[item]))))[::-1]:
                text.insert(int(place), np.uint64(rng.integers(1, 1 << 60)))
            text = np.array(text, np.uint64)
            if decontaminate.align(items[item], text, settings)[0] < block.needed[item]:
                continue
            pairs = decontaminate._pairs(text)
            assert item in {found[1] for found in block.candidates(text, pairs, np.array([0, len(text)]))}
            assert block.best_passage(item, text, pairs) is not None


def test_decontamination_finds_what_the_alignment_accepts(spark):
    rng = np.random.default_rng(9)
    vocabulary = [f"w{n}" for n in range(60)]  # so few words that every pair is common
    pick = lambda count: [vocabulary[int(n)] for n in rng.integers(0, 60, count)]
    items = [pick(size) for size in (8, 8, 15, 15, 30, 70)]
    texts = []
    for n in range(240):
        copy = [(pick(1)[0] if rng.random() < 0.3 else word) for word in items[n % 6]]
        texts.append(pick(int(rng.integers(0, 120))) + copy + pick(int(rng.integers(0, 120))))
    texts.append([word for pair in zip(items[2], ["new"] * 15) for word in pair])  # no two words together
    docs = spark.createDataFrame([(n, " ".join(text)) for n, text in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(item)) for n, item in enumerate(items)], "item_id long, text string")
    settings, number = decontaminate.Settings(), {word: n for n, word in enumerate([*vocabulary, "new"])}
    expected = {}
    for n, text in enumerate(texts):
        for k, item in enumerate(items):
            score = decontaminate.align(np.array([number[w] for w in item]), np.array([number[w] for w in text]), settings)[0]
            if score >= min(len(item), 50):
                expected[n, k] = score
    assert {(row.doc_id, row.item_id): row.score for row in decontaminate.contaminated(docs, bench).collect()} == expected
    assert (240, 2) in expected


def test_alignment_against_the_plain_table():
    rng, settings = np.random.default_rng(5), decontaminate.Settings()
    for _ in range(50):
        item, passage = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 20))
        cells = np.zeros((len(item) + 1, len(passage) + 1), int)
        for i in range(1, len(item) + 1):
            for j in range(1, len(passage) + 1):
                step = settings.match if item[i - 1] == passage[j - 1] else settings.mismatch
                cells[i, j] = max(0, cells[i - 1, j - 1] + step, cells[i - 1, j] + settings.gap, cells[i, j - 1] + settings.gap)
        assert decontaminate.align(item, passage, settings)[0] == cells.max()


def test_nearest_recall_and_awkward_vectors(spark, small):
    frame = table(spark, small, "embeddings").select("vec_id", "embedding")
    bad = [(100_001, None), (100_002, [0.0] * 64), (100_003, [float("nan")] * 64), (100_050, [1.0]), (None, [1.0] * 64), (100_004, [None] * 64)]
    got = nearest.nearest(frame.unionAll(spark.createDataFrame(bad, frame.schema))).collect()
    rows = frame.toPandas()
    data = np.stack(rows.embedding).astype(float)
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    hits = total = 0
    for place in np.flatnonzero(rows.vec_id % 50 == 0):
        cosines = data @ data[place]
        cosines[place] = -2
        best = set(rows.vec_id.to_numpy()[np.argsort(-cosines)[:5]])
        own = [row for row in got if row.query_id == rows.vec_id[place]]
        assert [row.rank for row in sorted(own, key=lambda row: -row.score)] == [1, 2, 3, 4, 5]
        hits, total = hits + len(best & {row.vec_id for row in own}), total + 5
    assert hits / total >= 0.9
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(row) for row in nearest.nearest(few).orderBy("rank").collect()] == [(0, 1, 2, 1.0), (0, 2, 1, -1.0)]
    assert nearest.nearest(few.limit(0)).count() == 0


def test_nearest_with_extreme_and_short_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 2e-200]), (2, [5e-324, 0.0]), (3, [-1.7e308, 1.7e308]), (4, [3.0]), (50, [0.0, 7.0])]
    got = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    angle = {0: (1, 1), 1: (1, 2), 2: (1, 0), 3: (-1, 1), 4: (1, 0), 50: (0, 1)}
    unit = {number: np.array(way) / np.linalg.norm(way) for number, way in angle.items()}
    for query in (0, 50):
        own = sorted((row for row in got if row.query_id == query), key=lambda row: row.rank)
        assert {row.vec_id for row in own} == set(unit) - {query} and [-row.score for row in own] == sorted(-row.score for row in own)
        assert all(abs(row.score - unit[query] @ unit[row.vec_id]) < 1e-12 for row in own)


def test_chat_rows(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "a b", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (2, 0, None, "x"), (None, None, "", "y"), (3, 0, "system", "z")]
    got = chat.perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(row.conv_id, row.perspective) for row in got} == {(1, "a_b"), (1, "bob"), (2, "unknown"), (None, "unknown")}
    for conv, who in {(row.conv_id, row.perspective) for row in got}:
        own = sorted((row for row in got if (row.conv_id, row.perspective) == (conv, who)), key=lambda row: row.position)
        whole = "".join(row.piece for row in own)
        assert [row.position for row in own] == list(range(len(own)))
        for row in own:
            assert whole[row.start : row.end] == row.piece
            assert (row.learn_start is not None) == (row.speaker == who)
            if row.learn_start is not None:
                assert whole[row.learn_start : row.learn_end] + "\n" == row.piece.split("\n", 1)[1]


def test_text_of_pages_in_one_pass():
    plain = re.compile(r"<!--.*?-->|<(script|style|nav)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)
    rng = np.random.default_rng(6)
    signs = ["<", ">", "<!--", "-->", "<script>", "</script >", "<STYLE a='>'>", "</style>", "<nav", "</nav>", "x", " y ", "<p>", "</scripts>", "<br/"]
    for _ in range(3000):
        html = "".join(rng.choice(signs, size=rng.integers(0, 14)))
        assert language.text_of(html) == plain.sub(" ", html), html
    began = time.perf_counter()
    for sign in ("<", "<!--", "<script>", "<nav", "</style ", "<style>x</style"):
        language.text_of(sign * (1_000_000 // len(sign)))
    assert time.perf_counter() - began < 12  # 1 MB each


def test_language_evidence(spark):
    docs = spark.createDataFrame([("the cat and the dog with that thing", "en"), ("der hund und die katze mit dem ding", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    pages = [(1, "http://a.example.de/x", "<html lang=de><p>und die katze mit dem hund</p>"), (2, "http://b.example.com", "<p>and the dog with that cat</p>")]
    pages += [(3, "http://a.example.de/y", None), (4, None, None), (5, "no address", ""), (5, "no address", "")] + [(n, "http://a.example.de/", "<p>die katze und der hund</p>") for n in range(10, 20)]
    got = language.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()
    assert len(got) == len(pages)
    lang = {row.page_id: row.lang for row in got}
    assert (lang[1], lang[2], lang[3], lang[15]) == ("de", "en", "de", "de") and lang[4] in ("de", "en")
    assert all(0 < row.probability <= 1 for row in got)
    assert language.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs.limit(0)).filter("lang IS NOT NULL").count() == 0


def test_pages_without_text_are_no_votes(spark):
    docs = spark.createDataFrame([("the cat and the dog with that thing", "en"), ("der hund und die katze mit dem ding", "de")], "text string, lang string")
    empty_html = [None, "", "<html lang=en><img src=x></html>", "<p>1 2 3</p>"]
    pages = [(n, "http://hot.example.com/", empty_html[n % 4]) for n in range(400)] + [(1000 + n, "http://hot.example.com/", "<p>the dog and the cat</p>") for n in range(4)]
    pages += [(2000, "http://hot.example.com/", "<p>a b</p>")] + [(3000 + n, "http://x.example.org/", "<html lang=de><p>und die katze mit dem hund</p>") for n in range(5)]
    got = {row.page_id: row for row in language.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()}
    assert len(got) == len(pages) and all(got[n].text_lang is None and got[n].lang == "en" for n in range(400))
    assert got[1000].text_lang == got[1000].lang == got[2000].lang == "en" and got[3000].lang == "de"
    alone = language.identify(spark.createDataFrame(pages[400:], "page_id long, url string, html string"), docs).collect()
    for row in alone:  # the empty pages change nothing for the others
        assert (row.lang, round(row.probability, 9)) == (got[row.page_id].lang, round(got[row.page_id].probability, 9))


def test_declared_behind_long_attributes(spark):
    docs = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")], "text string, lang string")
    html = [f'<HTML data-x="{"y " * 30_000}" lang="DE-at"><p>', '<html data-x="<html" lang=de>', "<html class=ie><html lang=de>", "<html " * 5_000, "<html><p lang=de>"]
    got = language.identify(spark.createDataFrame([(n, None, text) for n, text in enumerate(html)], "page_id long, url string, html string"), docs).collect()
    assert {row.page_id: row.declared for row in got} == {0: "de", 1: "de", 2: "de", 3: "", 4: ""}


def test_toxicity_learns_a_pair(spark, empty):
    rng = np.random.default_rng(2)
    rows = []
    for n in range(3000):  # harmless alone, toxic together
        a, b = (int(x) for x in rng.random(2) < 0.5)
        text = " ".join([f"f{rng.integers(50)}" for _ in range(8)] + ["mild"] * a + ["group"] * b)
        rows.append((n, text, int(a and b)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, label int")
    machine = toxicity.fit(frame)
    scored = toxicity.score(frame, machine, keep=("doc_id", "label")).toPandas()
    assert ((scored.score >= 0.5) == (scored.label == 1)).mean() > 0.97
    assert toxicity.score(empty, machine).count() == 0
    assert toxicity.fit(frame.limit(0)).score_rows(np.zeros(0, int), np.zeros(0, int), 1)[0] == 0.5


def labelled_pairs(toxic, count=3000):
    """Rows of fillers in which two words stand at random; ``toxic`` decides by both."""
    rng = np.random.default_rng(2)
    marks = rng.random((count, 2)) < 0.5
    texts = [" ".join([f"f{rng.integers(50)}" for _ in range(8)] + ["mild"] * a + ["group"] * b) for a, b in marks.tolist()]
    return texts, np.array([float(toxic(a, b)) for a, b in marks.tolist()])


def trained(texts, labels, settings=None):
    found = [(rows + first, terms) for first, _, rows, terms in toxicity.hashed_terms(pa.array(texts), 20)]
    rows, terms = (np.concatenate(part).astype(np.int32) for part in zip(*found))
    machine = toxicity.train(rows, terms, labels, settings)
    return machine, rows, machine.places[terms]


def test_toxicity_learns_a_pair_without_signal_of_its_words():
    texts, labels = labelled_pairs(lambda a, b: a != b)
    machine, rows, terms = trained(texts, labels)
    scores = machine.score_rows(rows, terms, len(texts))
    assert ((scores >= 0.5) == (labels == 1)).mean() > 0.97


def test_toxicity_scores_against_plain_sums():
    texts, labels = labelled_pairs(lambda a, b: a and b)
    machine, rows, terms = trained(texts, labels, toxicity.Settings(least_seen=1000))
    assert 0 < len(machine.factors) < len(machine.linear)
    scores = machine.score_rows(rows, terms, len(texts))
    for row in range(0, 3000, 100):
        own = terms[rows == row]
        vectors = [machine.factors[t] for t in own if t < len(machine.factors)]
        total = machine.bias + sum(machine.linear[t] for t in own)
        total += sum(float(a @ b) for k, a in enumerate(vectors) for b in vectors[:k])
        assert abs(scores[row] - 1 / (1 + np.exp(-machine.slope * total - machine.offset))) < 1e-9


def test_toxicity_scores_are_shares():
    rng = np.random.default_rng(6)
    texts, sure = labelled_pairs(lambda a, b: a and b, 12_000)  # a fold of 1,000: shares are known to about 0.03
    labels = np.where(rng.random(len(sure)) < 0.2, 1 - sure, sure)  # one label in five is wrong
    machine, _, _ = trained(texts[:10_000], labels[:10_000])
    _, count, rows, terms = next(toxicity.hashed_terms(pa.array(texts[10_000:]), 20, machine.places))
    scores = machine.score_rows(rows, terms, count)
    for group in (scores >= 0.5, scores < 0.5):  # on rows never trained on
        assert group.sum() > 100 and abs(scores[group].mean() - labels[10_000:][group].mean()) < 0.08
    assert trained(texts[:3000], np.ones(3000))[0].score_rows(np.zeros(0, int), np.zeros(0, int), 1)[0] == pytest.approx(3001 / 3002)


def test_toxicity_columns(spark, awkward, small):
    docs = table(spark, small, "documents")
    machine = toxicity.fit(toxicity.labelled_texts(docs, table(spark, small, "labels")))
    left = toxicity.without_toxic(awkward, machine)
    assert left.columns == awkward.columns and left.count() == len(AWKWARD)
    got = contract.queries()["op6_toxicity"](spark, small).collect()
    assert len(got) == docs.count()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) and row.predicted == (row.score >= 0.7) for row in got)


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def is_personal(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_personal_data(spark, small, awkward):
    texts = ["a@b.c_x@d.e 1.2.3.4.5 0001.2.3.255 1.2.3.256", "x" * 500 + "@" + "y.z" * 20, "+1 (377) 555-0271 +++1-2-3-4-5-6-7-8-9-10"]
    texts += ["4111 1111 1111 1111 4111-1111-1111-1111", "1" * 6000 + " " + "1 " * 3000, "é@é.com ü 4111111111111111", "1.2.3.4 " * 500, "a@b.c@d.e-@f.g 😀 a@b.co"]
    # the plain patterns would take hours over the longest text
    docs = awkward.filter("doc_id IS NULL OR doc_id != 9").select("doc_id", "text").unionAll(spark.createDataFrame(list(enumerate(texts, 50)), "doc_id long, text string"))
    docs = docs.unionAll(table(spark, small, "documents").select(F.col("doc_id") + 1000, "text"))
    texts = {row.doc_id: row.text or "" for row in docs.collect()}
    for row in pii.digest(pii.find_personal_data(docs)).collect():
        spans = {kind: [m.span() for m in re.finditer(pattern, texts[row.doc_id]) if is_personal(kind, m[0])] for kind, pattern in PLAIN}
        base = ",".join(f"{kind}:{start}:{end}" for kind, found in spans.items() for start, end in found)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(len(found) for found in spans.values())
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and row.spans.startswith(base)


def test_account_numbers_and_context(spark):
    docs = spark.createDataFrame([("iban DE89 3704 0044 0532 0130 00 x", 1), ("DE89 3704 0044 0532 0130 01", 2)], "text string, pii int")
    rows = pii.find_personal_data(docs).orderBy("pii").collect()
    assert rows[0][-1][0].kind == "iban" and (rows[0][-1][0].start, rows[0][-1][0].end, rows[0][-1][0].score) == (5, 32, 1.0)
    assert rows[1][-1] == []
    assert pii.redact(docs).orderBy("pii").first().text == "iban <iban> x"


def test_account_numbers_before_other_tokens(spark):
    es, be, de = "ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00"
    texts = {f"{es} BIC": [es], "ES9121000418450200051332 12.50": ["ES9121000418450200051332"], "BE68539007547034 EUR": ["BE68539007547034"]}
    texts |= {f"{be} {de}": [be, de], f"{de} {be} 1234 5678 😀 {es}": [de, be, es], f"ES91 2100 0418 4502 0005 {be}": [be], f"{be}X": [], f"{be[:-1]}5 EUR": []}
    texts |= {f"{be} " * 150: [be] * 150, f"AB12 CD34 {be} your bank": [be]}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find_personal_data(docs).collect():
        assert [row.text[s.start : s.end] for s in row.pii if s.kind == "iban"] == texts[row.text], row.text
        assert all(s.score == (1.0 if "bank" in row.text else 0.9) for s in row.pii if s.kind == "iban")


def test_mixing(awkward, empty, spark):
    got = mixing.mix(awkward).toPandas()
    assert len(got) == len(AWKWARD) and (got.taken <= 2 * got["size"]).all()
    for _, part in got.groupby("source", dropna=False):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 1 and part["size"].sum() == part.source_size.iloc[0]
    assert mixing.mix(empty).count() == 0
    used = mixing.mixed_documents(awkward)
    assert used.columns == awkward.columns and used.count() == got.copies.sum()
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 1000), (None, 0)], "source string, source_size long")
    targets = {row.source: row.target for row in mixing.source_targets(sizes).collect()}
    assert targets["a"] == 200 and targets[None] == 0 and sum(targets.values()) == pytest.approx(3150)


def test_sharding(awkward, empty, spark):
    rows = awkward.unionAll(spark.createDataFrame([(100 + n, "same text" if n % 3 else f"text {n}", *[None] * 4) for n in range(900)], awkward.schema))
    rows = rows.filter("doc_id IS NULL OR doc_id != 9")
    got = sharding.shard_rows(rows, 8).collect()
    assert len(got) == rows.count()
    sizes, slots = np.zeros(8), {}
    for row in got:
        sizes[row.shard] += len((row.text or "").encode()) + 1
        slots.setdefault(row.shard, []).append(row.slot)
    largest = max(len((row.text or "").encode()) + 1 for row in got)
    assert np.abs(sizes - sizes.mean()).max() <= largest
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert sharding.shard_rows(empty, 8).count() == 0
    rough = sharding.shard_rows(rows, 4, tolerance=0.5).groupBy("shard").count().collect()
    assert sum(row["count"] for row in rough) == rows.count()


def test_sharding_parts_equal_rows(spark):
    rows = [(n, "different " * (n % 7) + str(n), "a", n, 0.5) for n in range(3000)] + [(9, "equal row", "b", 1, 0.5)] * 1500
    rows += [(None, None, "c", n % 3, None) for n in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sort_key string, `sort.size` long, slot double").repartition(7)
    got = sharding.shard_rows(docs, 16).collect()
    assert got[0].__fields__ == ["doc_id", "text", "sort_key", "sort.size", "shard", "slot"]
    assert sorted(map(repr, (tuple(row)[:4] for row in got))) == sorted(map(repr, (row[:4] for row in rows)))
    hashed = lambda value: hashlib.md5(("" if value is None else str(value)).encode()).hexdigest()[:12]
    bytes_of = lambda text: len((text or "").encode()) + 1
    order = sorted((hashed(row[1]) + hashed(row[0]), bytes_of(row[1])) for row in rows)
    total, before, expected, slots = sum(size for _, size in order), 0, [], {}
    for key, size in order:
        shard = sum(16 * before >= total * number for number in range(1, 16))
        slots[shard] = slots.get(shard, -1) + 1
        expected.append((key, shard, slots[shard]))
        before += size
    assert sorted((hashed(row.text) + hashed(row.doc_id), row.shard, row.slot) for row in got) == sorted(expected)
    same = spark.createDataFrame([(1, "x" * 9)] * 50_001, "doc_id long, text string")
    counts = {row.shard: (row.n, row.low, row.high) for row in sharding.shard_rows(same, 4).groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high")).collect()}
    assert sorted(n for n, _, _ in counts.values()) == [12500, 12500, 12500, 12501] and all((low, high) == (0, n - 1) for n, low, high in counts.values())


def test_pipeline_stages(spark, small, awkward):
    import corpus_pipeline

    docs = awkward
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == awkward.columns
    assert {row.doc_id for row in docs.collect()} <= {row[0] for row in AWKWARD}
    assert len(corpus_pipeline.STAGES) == 5 and os.path.exists(corpus_pipeline.__file__)


def test_queries_match_sql(spark, small):
    from emberwatch.llm.registry import ORACLES, QUERIES

    with compare.database(small) as connection:
        for name, sql in ORACLES.items():
            assert compare.difference(QUERIES[name](spark, small), connection, sql) is None, name
