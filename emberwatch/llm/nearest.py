"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: several rotations, learned on a bounded sample so that
rounding to signs loses little (iterative quantization), give ``d`` bits each. A code is
split into substrings and each substring is indexed. If two codes differ in at most r bits,
they differ in at most r // m bits in one of their m substrings; probing all values that
near to a query's substrings therefore retrieves every code within the radius. What is
found within the radius is ranked by the cosine of the original vectors.

The index is cut into blocks of rows and the queries into blocks of queries; each pair of
blocks meets in one task of bounded size, and the best of all blocks are merged. Queries
that find fewer neighbours than asked for go on with twice the radius.
"""

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch.llm.common import kept, parts_for


@dataclass(frozen=True)
class Settings:
    neighbours: int = 5
    #: Bits of a code at least; whole rotations are taken.
    bits: int = 256
    substring: int = 16
    #: Vectors on which rotations and radius are learned at most.
    sample_rows: int = 4096
    iterations: int = 15
    #: Share of the sample's true neighbours that the radius covers. The whole table is
    #: denser than the sample, so its neighbours are nearer and more of them are covered.
    coverage: float = 0.97
    #: Numbers in a block of rows, and queries in a block.
    block_numbers: int = 1 << 20
    block_queries: int = 2048


def usable(frame, vec_id="vec_id", vector="embedding"):
    """(vec_id, vector) as doubles, without vectors that have no direction: null, zero, or
    with null or non-finite parts. Shorter vectors are filled up with zeros, which leaves every
    cosine as it is."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = frame.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(finite & F.exists("vector", lambda x: x != 0))
    size = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    filled = F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(size) - F.size("vector")))
    return rows.withColumn("vector", F.when(F.size("vector") < size, filled).otherwise(F.col("vector"))), size


def _scaled(vectors):
    """Each vector times a power of two, its largest part between a half and one: squares of very
    large or small parts stay in range, and the cosine is the same to the last bit."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _unit(vectors):
    vectors = _scaled(vectors)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def learn_rotations(sample, settings):
    """Centre, and rotations side by side, each (d, d), for at least ``bits`` bits."""
    centre = sample.mean(axis=0)
    data = sample - centre
    size = data.shape[1]
    rotations = []
    for number in range(-(-settings.bits // size)):
        turn, _ = np.linalg.qr(np.random.default_rng(number).normal(size=(size, size)))
        for _ in range(settings.iterations):
            signs = np.where(data @ turn > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(data.T @ signs)
            turn = left @ right
        rotations.append(turn)
    return centre, np.concatenate(rotations, axis=1)


def encode(units, model, settings):
    """Codes as rows of substrings."""
    centre, rotation = model
    bits = (units - centre) @ rotation > 0
    width = settings.substring
    spare = -bits.shape[1] % width
    bits = np.concatenate([bits, np.zeros((len(bits), spare), bool)], axis=1)
    return (bits.reshape(len(bits), -1, width) @ (1 << np.arange(width))).astype(np.uint16 if width <= 16 else np.uint32)


_BIT_COUNTS = np.array([bin(value).count("1") for value in range(1 << 16)], np.uint8)


def distances(code, codes):
    return _BIT_COUNTS[code ^ codes].sum(axis=-1, dtype=np.int64)


def learn_radius(sample, model, settings):
    """Radius that covers the given share of the nearest neighbours within the sample."""
    codes = encode(sample, model, settings)
    chosen = np.arange(0, len(sample), max(1, len(sample) // 256))
    near = []
    for row in chosen:
        cosines = sample @ sample[row]
        cosines[row] = -2
        top = np.argsort(-cosines)[: settings.neighbours]
        near.extend(distances(codes[row], codes[top]))
    return int(np.quantile(near, settings.coverage)) if len(sample) > 1 else settings.bits


def _masks(width, radius):
    """All changes of at most ``radius`` bits of a substring."""
    masks = [np.zeros(1, np.int64)]
    for count in range(1, min(radius, width) + 1):
        masks.append(np.array([sum(1 << bit for bit in bits) for bits in combinations(range(width), count)], np.int64))
    return np.concatenate(masks)


class BlockIndex:
    """The substrings of a block of codes, each sorted by value."""

    def __init__(self, codes, width):
        self.codes, self.width = codes, width
        self.orders = [np.argsort(column, kind="stable") for column in codes.T]
        self.offsets = [np.concatenate([[0], np.cumsum(np.bincount(column, minlength=1 << width))]) for column in codes.T]

    def within(self, code, radius):
        """Rows whose codes differ from ``code`` in at most ``radius`` bits."""
        count = self.codes.shape[1]
        per, extra = divmod(radius, count)
        found = np.zeros(len(self.codes), bool)
        for number in range(count):
            reach = per if number <= extra else per - 1
            if reach < 0:
                continue
            if reach >= self.width:
                found[:] = True
                break
            values = _mask_table(self.width, reach) ^ int(code[number])
            low, high = self.offsets[number][values], self.offsets[number][values + 1]
            sizes = high - low
            total = sizes.sum()
            if total:
                at = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(total)
                found[self.orders[number][at]] = True
        rows = np.flatnonzero(found)
        return rows[distances(code, self.codes[rows]) <= radius]


_tables = {}


def _mask_table(width, radius):
    if (width, radius) not in _tables:
        _tables[width, radius] = _masks(width, radius)
    return _tables[width, radius]


def _search(model, settings):
    def blocks(rows, queries):
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        vectors = _scaled(np.stack(rows["vector"].to_numpy()))
        ids = rows["vec_id"].to_numpy()
        norms = np.linalg.norm(vectors, axis=1)
        index = BlockIndex(encode(_unit(vectors), model, settings), settings.substring)
        targets = _scaled(np.stack(queries["vector"].to_numpy()))
        codes = encode(_unit(targets), model, settings)
        parts = []
        for number, (query, radius) in enumerate(zip(queries["vec_id"], queries["radius"])):
            near = index.within(codes[number], int(radius))
            near = near[ids[near] != query]
            scores = vectors[near] @ targets[number] / (norms[near] * np.linalg.norm(targets[number]))
            top = np.lexsort((ids[near], -scores))[: settings.neighbours]
            parts.append(pd.DataFrame({"query_id": query, "vec_id": ids[near[top]], "score": scores[top]}))
        return pd.concat(parts)

    return blocks


def _rounds(rows, queries, model, settings, row_blocks):
    """Best of every block for each query: (query_id, vec_id, score)."""
    query_blocks = parts_for(queries.count(), settings.block_queries)
    own = F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks)).cast("int")
    other = F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")
    left = rows.withColumn("row_block", own).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = queries.withColumn("query_block", other).withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    both = left.groupBy("row_block", "query_block").cogroup(right.groupBy("row_block", "query_block"))
    return both.applyInPandas(_search(model, settings), "query_id long, vec_id long, score double")


def _ranked(found, neighbours):
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours)


def nearest(frame, is_query=None, settings=None):
    """(query_id, rank, vec_id, score) of the nearest found for each query, by cosine.

    ``frame`` (vec_id, embedding); ``is_query`` says which rows ask, by default those whose
    vec_id is divisible by 50, against all rows but themselves. A query finds all others if
    there are fewer than asked for. Rows that share a vec_id are each found; among queries
    the row with the smallest vector asks. Vectors without direction and null ids take no
    part (see ``usable``), other columns neither. An empty table gives no rows.
    """
    settings = settings or Settings()
    rows, size = usable(frame)
    rows = kept(rows)
    is_query = F.col("vec_id") % 50 == 0 if is_query is None else is_query
    queries = kept(rows.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(settings.sample_rows).toPandas()
    if not len(sample):
        return frame.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    units = _unit(np.stack(sample["vector"].to_numpy()))
    model = learn_rotations(units, settings)
    radius = learn_radius(units, model, settings)
    total = rows.count()
    row_blocks = parts_for(total, max(1024, settings.block_numbers // size))
    bits = encode(units[:1], model, settings).shape[1] * settings.substring

    asking = queries.withColumn("radius", F.lit(radius))
    result = None
    while True:
        ranked = kept(_ranked(_rounds(rows, asking, model, settings, row_blocks), settings.neighbours))
        result = ranked if result is None else result.join(asking, result["query_id"] == asking["vec_id"], "left_anti").unionAll(ranked)
        # queries that found too few ask again, with twice the radius
        counts = ranked.groupBy("query_id").count()
        short = asking.join(counts, asking["vec_id"] == counts["query_id"], "left")
        short = short.filter((F.coalesce("count", F.lit(0)) < min(settings.neighbours, total - 1)) & (F.col("radius") < bits))
        asking = kept(short.select("vec_id", "vector", F.least(F.col("radius") * 2 + 1, F.lit(bits)).alias("radius")))
        if asking.isEmpty():
            return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
