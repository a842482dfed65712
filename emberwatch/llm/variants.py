"""Spelling variants of words by pivotal grams.

Bigrams are ordered from rare to frequent. A word's prefix are its three rarest bigrams, and its
pivots two of them that share no letter, with the least total frequency (dynamic programming
over places). One edit spoils one of two disjoint bigrams at most. So if two words are one edit
apart, a pivot of the one whose prefix ends earlier in the order stands in the other's prefix,
at the same place or, where lengths differ, one further. The edit lies left or right of it, and
there in the nearer or the farther half; all else is equal. The key of the join holds the bigram,
its place and what is equal, so few pairs come out that are no variants. Each pair is verified by
its edit distance.
"""

import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from emberwatch.llm.common import kept

#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000
#: Characters from which the words of one text are counted one by one instead of listed.
LONG_TEXT = 1 << 20
#: Bigrams of the letters that words are made of: 26 and 64 letters, squared.
GRAMS = 90 * 90
_LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))


def count_words(docs, least=5, noise=97, text="text", key="doc_id"):
    """Every distinct word of ``docs`` and its occurrences: word, n.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. With
    ``noise``, a run of which the CRC of ``<key>:<run>`` is divisible by it loses the letter at
    that CRC modulo its length. Words of fewer than ``least`` letters are left out. A null text
    has no words, a null key is written as empty text; rows with equal keys count one by one.
    """

    def run(batches):
        counts = Counter()
        pattern = re.compile(f"[a-z\\u00C0-\\u00FF]{{{max(least, 1)},}}")
        for batch in batches:
            for name, written in zip(batch.column(0), batch.column(1), strict=True):
                if not written.is_valid:
                    continue
                lower = written.as_buffer().to_pybytes().translate(_LOWER).decode()
                found = pattern.findall(lower) if len(lower) < LONG_TEXT else (match[0] for match in pattern.finditer(lower))
                start = zlib.crc32(f"{name.as_py() if name.is_valid else ''}:".encode())
                for word, times in Counter(found).items():
                    if noise:
                        code = zlib.crc32(word.encode(), start)
                        if code % noise == 0:
                            at = code % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                    counts[word] += times
                if len(counts) > COUNTED:
                    yield from _counted(counts)
                    counts.clear()
        yield from _counted(counts)

    columns = docs.select(F.col(f"`{key}`").cast("string").alias("name"), F.col(f"`{text}`").alias("written"))
    return columns.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts):
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def gram_ranks(words):
    """Rank of each bigram of ``words`` (word), rarest first. There are at most ``GRAMS``."""
    grams = words.select(F.explode(F.expr("transform(sequence(1, length(word) - 1), at -> substr(word, at, 2))")).alias("gram"))
    rows = grams.groupBy("gram").agg(F.count("*").alias("words")).limit(GRAMS + 1).collect()
    if len(rows) > GRAMS:
        raise ValueError("words have letters beyond A-Z, a-z and U+00C0 to U+00FF")
    rows = sorted(rows, key=lambda row: (row["words"], row["gram"]))
    return {row["gram"]: (rank, row["words"]) for rank, row in enumerate(rows)}


def prefix_and_pivots(word, ranks):
    """Places of the bigrams in the prefix, the rank at which it ends, and places of two pivots.

    The prefix holds every place of a bigram that ranks no later than the third rarest, so that
    it does not depend on how equal bigrams are told apart. Two of three places are always
    apart; of all such pairs in the prefix, the pivots are the one with the least frequency.
    """
    own = [ranks[word[at : at + 2]] for at in range(len(word) - 1)]
    last = sorted(rank for rank, _ in own)[2]
    prefix = [at for at, (rank, _) in enumerate(own) if rank <= last]
    one = two = None  # the cheapest choice of one place, and of two that are apart, up to here
    behind = 0  # places up to here are more than one before the current one
    for at in prefix:
        while prefix[behind] < at - 1:
            cost = own[prefix[behind]][1]
            one = min(one or (cost, prefix[behind]), (cost, prefix[behind]))
            behind += 1
        if one and (two is None or one[0] + own[at][1] < two[0]):
            two = one[0] + own[at][1], one[1], at
    return prefix, last, two[1:]


def _equal_parts(word, at, size):
    """What ``word`` has in common with one of ``size`` letters, one edit apart, that has the
    bigram of place ``at`` too; one part for each place where the edit can lie.

    ``at`` counts in the word of ``size`` letters. Its letters right of the bigram are halved,
    and those left of it; ``word`` itself may have one letter more or less, on the side of the
    edit. A part without letters for an edit is left out.
    """
    own = at + len(word) - size  # place of the bigram in word if the edit lies left of it
    cut = at + 2 + (size - at - 2) // 2
    if max(size, len(word)) > at + 2:
        yield f"1{word[:cut]}"
        if cut > at + 2:
            yield f"2{word[: at + 2]}|{word[len(word) - (size - cut) :]}"
    if max(at, own) > 0:
        cut = at // 2
        if cut:
            yield f"3{word[len(word) - (size - cut) :]}"
        yield f"4{word[:cut]}|{word[own:]}"


def _keyed(words, ranks, probes):
    """Join keys of the words: of their prefixes, or with ``probes`` of their pivots."""

    def keys(word):
        prefix, last, pivots = prefix_and_pivots(word, ranks)
        for at in pivots if probes else prefix:
            for longer in (-1, 0, 1) if probes else (0,):
                size = len(word) + longer
                for shift in {0, longer}:
                    # the edit is right of the bigram where it stands still, left where it moves
                    place = at + shift
                    if place < 0 or place + 2 > size:
                        continue
                    for part in _equal_parts(word, place, size):
                        if longer == 0 or (part[0] in "12") == (shift == 0):
                            yield last, f"{size}:{place}:{part}"

    def run(batches):
        for batch in batches:
            for low in range(0, len(batch), 2000):
                rows, lasts, texts = [], [], []
                for row, word in enumerate(batch.column("word").slice(low, 2000).to_pylist(), low):
                    for last, text in keys(word):
                        rows.append(row)
                        lasts.append(last)
                        texts.append(text)
                own = batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(lasts, pa.int32()), pa.array(texts, pa.string())], ["word", "n", "last", "key"])

    made = words.select("word", "n").mapInArrow(run, "word string, n long, last int, key string")
    return made.withColumn("key", F.xxhash64("key"))


def _shuffled(frame):
    """Both sides of a join with ``frame`` are shuffled and sorted, neither is ever broadcast. Spark
    sizes what is made of words by the few compressed bytes of their file: 805 MB of keys as 5 MB."""
    return frame.hint("merge")


def near_pairs(words):
    """All pairs of ``words`` (word, n; words of four letters and more, each once) that are one
    inserted, deleted or replaced letter apart, in both directions: word, n, near, near_n. A
    pair can come more than once."""
    ranks = gram_ranks(words)
    index = _keyed(words, ranks, probes=False).select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("last").alias("near_last"))
    probes = _keyed(words, ranks, probes=True)
    ahead = (probes["last"] <= index["near_last"]) & (probes["word"] != index["near"])
    met = probes.join(_shuffled(index), (probes["key"] == index["key"]) & ahead)
    met = met.filter(F.levenshtein("word", "near", 1) == 1)
    ways = F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return met.select(F.explode(ways).alias("way")).select("way.*")


def roots(forms, most):
    """Where each word's chain of forms ends: word, root. ``forms`` has word and form.

    A form occurs at least twice as often as its word, and ``most`` is the largest count: chains
    have at most log2(most) links, of which each round halves what is left.
    """
    found = kept(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    for _ in range(math.ceil(math.log2(max(2.0, math.log2(max(most, 2))))) + 1):
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = found.join(_shuffled(onward), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        found = kept(moved)
        if found.filter("moved").isEmpty():
            break
    return found.select("word", "root")


def group_variants(words):
    """Each word of ``words`` (word, n) with the near word it may be a slip of.

    Gives word, n, n_near (words one edit away), form (the most frequent near word, ties to the
    smallest, if it occurs at least twice as often; else null), form_n (its count) and root (the
    end of the chain of forms; the word itself without one). An empty table gives no rows.
    """
    pairs = near_pairs(words).unionByName(words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")))
    once = pairs.repartition("word").groupBy("word", "near").agg(F.first("n").alias("n"), F.first("near_n").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("rank"), "near")))
    grouped = once.groupBy("word").agg(F.first("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    takes = -F.col("best.rank") >= 2 * F.col("n")
    form, form_n = F.when(takes, F.col("best.near")), F.when(takes, -F.col("best.rank"))
    grouped = kept(grouped.select("word", "n", "n_near", form.alias("form"), form_n.alias("form_n")))
    ends = roots(grouped.filter("form IS NOT NULL"), words.agg(F.max("n")).first()[0] or 0)
    return grouped.join(_shuffled(ends), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs, least=5, times=3, noise=97, text="text", key="doc_id"):
    """The spelling variants among the words of ``docs`` that have at least ``least`` letters
    (four or more) and occur at least ``times`` times; see ``count_words`` and
    ``group_variants``."""
    if least < 4:
        raise ValueError("words need four letters to have two pivots")
    return group_variants(kept(count_words(docs, least, noise, text, key).filter(F.col("n") >= times)))
