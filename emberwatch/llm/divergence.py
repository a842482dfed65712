"""Divergence of sources from each other, by term.

Terms are counted in tasks by packing: a short term becomes one or two 64-bit words in byte
order, the words are sorted by radix and runs of equal ones are counted. Long terms are sorted
as bytes, in buckets of one length each. Spark adds up the counts of all tasks.

Shares of terms are whole numbers of billionths, so results do not depend on any order. Pairs of
sources are compared in blocks: a block holds the terms of one hash bucket and the sources of two
tiles, and gives a sum for each pair of its sources; terms that no source of the block has are
added afterwards, since they all have the same share.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch.llm.common import BROADCAST_ROWS, kept
from emberwatch.llm.hashing import column_bytes, row_slices

#: Bytes of text whose terms are sorted together.
SLICE = 1 << 21
#: Terms, and sources of a tile, that a block holds about.
TERMS, TILE = 2048, 128
UNIT = 1_000_000_000
SMOOTH = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True


def _spans(data, offsets):
    """Starts and ends of the terms of texts that stand one behind another."""
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.append(False, inside)[:-1] & ~edge[:-1]
    after = np.append(inside, False)[1:] & ~edge[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def _packed(data, starts, sizes, word):
    """Bytes ``8 * word`` to ``8 * word + 7`` of each term as a number in byte order."""
    packed = np.zeros(len(starts), np.uint64)
    last = max(len(data) - 1, 0)
    for place in range(8 * word, 8 * word + 8):
        byte = data[np.minimum(starts + place, last)].astype(np.uint64)
        packed = packed << np.uint64(8) | np.where(place < sizes, byte, np.uint64(0))
    return packed


def radix_order(words):
    """The order of rows by their 64-bit words, the first word counting most; equal rows stay.

    Digits of 16 bits are sorted from the last to the first; a stable sort of such digits is a
    counting sort in numpy. Digits that are equal in all rows are passed over.
    """
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(new, groups, docs):
    """First place, count and documents of each run of one term in one group; rows are in the
    order of terms, groups and documents."""
    new = new | np.append(True, groups[1:] != groups[:-1])[: len(new)]
    firsts = np.flatnonzero(new)
    fresh = new | np.append(True, docs[1:] != docs[:-1])[: len(new)]
    return firsts, np.diff(np.append(firsts, len(new))), np.add.reduceat(fresh.astype(np.int64), firsts)


def _texts(data, starts, sizes):
    """The terms at these places as an Arrow column."""
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[at].tobytes()))


def term_runs(data, offsets, groups):
    """Terms of texts, which stand sorted by group: parts (term column, group, n, docs).

    Gives one part for terms of 8 bytes at most, one up to 16, and one for each longer length.
    """
    starts, ends = _spans(data, offsets)
    sizes = ends - starts
    docs = np.searchsorted(offsets, starts, "right") - 1
    for word in (1, 2):
        rows = np.flatnonzero((sizes > 8 * word - 8) & (sizes <= 8 * word))
        if len(rows):
            words = [_packed(data, starts[rows], sizes[rows], place) for place in range(word)]
            order = radix_order(words)
            rows = rows[order]
            new = np.zeros(len(rows), bool)
            new[0] = True
            for column in words:
                column = column[order]
                new[1:] |= column[1:] != column[:-1]
            yield _part(data, starts, sizes, docs, groups, rows, new)
    long = np.flatnonzero(sizes > 16)
    for size in np.unique(sizes[long]).tolist():
        rows = long[sizes[long] == size]
        values = np.lib.stride_tricks.sliding_window_view(data, size)[starts[rows]].view(f"S{size}").ravel()
        order = np.argsort(values, kind="stable")
        values, rows = values[order], rows[order]
        yield _part(data, starts, sizes, docs, groups, rows, np.append(True, values[1:] != values[:-1]))


def _part(data, starts, sizes, docs, groups, rows, new):
    firsts, counts, met = _runs(new, groups[docs[rows]], docs[rows])
    rows = rows[firsts]
    return _texts(data, starts[rows], sizes[rows]), groups[docs[rows]], counts, met


def count_terms(docs, text="text", lang="lang", source="source"):
    """Occurrences and documents of each term in each group: lang, source, term, n, docs.

    Terms are maximal runs of A-Z, a-z and characters beyond ASCII with A-Z in lower case. Null
    texts, languages and sources count as ''. Rows are documents of their own, equal or not.
    """

    def run(batches):
        for batch in batches:
            langs, sources = (batch.column(place).fill_null("") for place in (0, 1))
            data, offsets = column_bytes(batch.column(2))
            names = pa.StructArray.from_arrays([langs, sources], ["lang", "source"])
            code, known = pd.factorize(np.array([f"{len(row['lang'])}:{row['lang']}{row['source']}" for row in names.to_pylist()], object))
            first = np.unique(code, return_index=True)[1]
            for low, high in row_slices(offsets, SLICE):
                # texts of a group stand together, so that its runs do
                rows = low + np.argsort(code[low:high], kind="stable")
                parts = [data[offsets[row] : offsets[row + 1]] for row in rows]
                bounds = np.append(0, np.cumsum([len(part) for part in parts]))
                lower = _LOWER[np.concatenate(parts)]
                for terms, groups, counts, met in term_runs(lower, bounds, code[rows]):
                    at = pa.array(first[groups])
                    yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), terms, pa.array(counts, pa.int64()), pa.array(met, pa.int64())], ["lang", "source", "term", "n", "docs"])

    columns = docs.select(*[F.col(f"`{name}`").cast("string").alias(wish) for name, wish in ((lang, "lang"), (source, "source"), (text, "text"))])
    return columns.mapInArrow(run, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count, total, terms):
    """SQL of a share: 1 + floor(UNIT * (count + SMOOTH) / (total + SMOOTH * terms)).

    The long division takes steps of a thousand, so nothing overflows below 9e15 terms. Where
    there are no terms there is nothing to share, which gives 1.
    """
    whole = f"({total} + {SMOOTH} * {terms})"
    result, rest = f"(({count} + {SMOOTH}) div {whole})", f"(({count} + {SMOOTH}) % {whole})"
    for _ in range(3):
        result, rest = f"({result} * 1000 + ({rest} * 1000) div {whole})", f"(({rest} * 1000) % {whole})"
    return F.expr(f"CASE WHEN {whole} > 0 THEN 1 + {result} ELSE 1 END")


def _compare_block(rows):
    """Sums of differences between the sources of one block: source, item, value, terms."""
    heads = rows[rows["term"].isna()].drop_duplicates("source").sort_values(["tile", "source"])
    counted = rows[rows["term"].notna()]
    place = pd.Series(np.arange(len(heads)), index=heads["source"])
    code, terms = pd.factorize(counted["term"])
    rest = heads["p"].to_numpy()
    shares = np.repeat(rest[:, None], len(terms), 1)
    shares[place[counted["source"]].to_numpy(), code] = counted["p"].to_numpy()
    low, high = rows["low"].iloc[0], rows["high"].iloc[0]
    tile, names = heads["tile"].to_numpy(), heads["source"].to_numpy()
    found = []
    for at in np.flatnonzero(tile == low):
        others = np.arange(at + 1, len(heads)) if low == high else np.flatnonzero(tile == high)
        values = np.abs(shares[others] - shares[at]).sum(1)
        found.append(pd.DataFrame({"source": names[at], "item": names[others], "value": values, "apart": np.abs(rest[others] - rest[at])}))
    made = pd.concat(found)
    return made.assign(lang=rows["lang"].iloc[0], terms=len(terms))[["lang", "source", "item", "value", "terms", "apart"]]


def audit(docs, least=30, top=50, text="text", lang="lang", source="source"):
    """How the groups (lang, source) of ``docs`` differ: lang, source, part, item, value, rank.

    A language keeps the terms that at least ``least`` of its documents hold. Part ``pair`` has
    every other source of the language with the sum of the differences of their shares of all
    kept terms; part ``term`` has the ``top`` terms of which the group has a larger share than
    its language, with the difference. Ranks go by falling value, then by item.

    Every group that occurs takes part, with or without terms. Null texts, languages and sources
    count as ''. Repeated rows count one by one; an empty table gives no rows. Other columns do
    not matter.
    """
    blank = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(wish) for name, wish in ((lang, "lang"), (source, "source"))]
    counts = kept(count_terms(docs, text, lang, source))
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs"))
    terms = terms.filter(F.col("lang_docs") >= least).drop("lang_docs")
    counts = kept(counts.drop("docs").join(terms, ["lang", "term"]))

    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = counts.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    groups = docs.select(*blank).distinct().join(sums, ["lang", "source"], "left").join(sizes, ["lang"], "left").na.fill(0, ["total", "terms", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = kept(groups.withColumn("tile", F.floor(number / TILE).cast("int")).withColumn("last_tile", F.max("tile").over(Window.partitionBy("lang"))))
    known = F.broadcast(groups) if groups.count() <= BROADCAST_ROWS else groups
    own = counts.join(known, ["lang", "source"]).withColumn("p", _share("n", "total", "terms"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ahead = own.withColumn("value", F.col("p") - _share("lang_n", "lang_total", "terms")).filter("value > 0")
    by_term = ahead.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", F.row_number().over(order.orderBy(F.desc("value"), "term")).alias("rank"))
    by_term = by_term.filter(F.col("rank") <= top)

    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / TERMS)).cast("int")
    heads = groups.withColumn("p", _share("0", "total", "terms")).withColumn("term", F.lit(None).cast("string"))
    heads = heads.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    parts = own.withColumn("block", F.pmod(F.xxhash64("term"), blocks).cast("int"))
    columns = ["lang", "source", "term", "p", "tile", "block", "last_tile"]
    rows = heads.select(columns).unionByName(parts.select(columns))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last_tile"))))
    rows = rows.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other")).drop("other", "last_tile")
    sums = rows.groupBy("lang", "block", "low", "high").applyInPandas(_compare_block, "lang string, source string, item string, value long, terms long, apart long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("met"), F.first("apart").alias("apart"))
    languages = known.select("lang", "terms").distinct()
    sums = sums.join(languages, "lang").withColumn("value", F.col("value") + (F.col("terms") - F.col("met")) * F.col("apart"))
    ways = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    pairs = sums.select("lang", "value", F.explode(ways).alias("way")).select("lang", "way.source", "way.item", "value")
    by_pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return by_pair.unionByName(by_term)
