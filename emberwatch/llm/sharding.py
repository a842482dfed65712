"""Shards of nearly equal bytes by a histogram sort.

Rows are ordered by a key: hash of the text, then hash of the id, so equal texts stand side
by side and only the few groups at a boundary are split. Boundaries are found by probes:
every round sums, over all partitions, the bytes in 4096 ranges of each interval that still
holds a boundary, and keeps the one range around it. When the boundaries meet the tolerance,
rows are exchanged once, into buckets of their shard; a row's slot is the rows before its
bucket and those before it within.

A boundary may fall between rows of one key, equal in text and id. Rows of such keys, and of
keys that many rows have, are counted instead of sorted: equal rows become one row with a
number of copies, get their range of places, and are written out again in many tasks.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch.llm.common import kept, sized

_BITS = 12
_DIGITS = 3  # hexadecimal digits of a probe
_HALF = 12  # hexadecimal digits of the hash of the text, and of that of the id
_SPREAD = 4096  # groups in which the different rows of one key are put in order
_COPIES = 10_000  # copies of a row that are written together


def byte_size(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def sort_key(text, *more):
    """24 hexadecimal digits: 12 from the text, 12 from what tells equal texts apart."""
    written = [F.coalesce(column.cast("string"), F.lit("")) for column in more]
    own = F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, _HALF)
    return F.concat(own, F.substring(F.md5(F.concat_ws(":", *written)), 1, _HALF))


def find_splitters(rows, shards, tolerance=0.0, size="size", key="key"):
    """Where each shard but the first begins, as (key prefix, rows of just that key before it).

    ``rows`` (key, size) is a table that is read once per round. A boundary is refined until
    the bytes between its probes are at most ``tolerance`` of a shard, or all digits of the
    key are used; then it may part the rows of one key, which are equal in size. Rows at or
    after a prefix belong to the later shard.
    """
    total = rows.agg(F.sum(size)).first()[0] or 0
    allowed = tolerance * total / shards
    # boundary: (number, known prefix, bytes before all keys with that prefix)
    open_ones = [(number, "", 0) for number in range(1, shards)] if total else []
    done = [None] * len(open_ones)
    for depth in range(0, 2 * _HALF, _DIGITS):
        prefixes = sorted({entry[1] for place, entry in enumerate(open_ones) if done[place] is None})
        if not prefixes:
            break
        within = rows if not depth else rows.filter(F.substring(key, 1, depth).isin(prefixes))
        ranges = within.groupBy(F.substring(key, 1, depth + _DIGITS).alias("range")).agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))
        table = sorted(ranges.collect(), key=lambda row: row["range"])  # at most 4096 per open boundary
        last_round = depth + _DIGITS >= 2 * _HALF
        for place, (number, prefix, before) in enumerate(open_ones):
            if done[place] is not None:
                continue
            reached = before
            for row in table:
                if not row["range"].startswith(prefix):
                    continue
                # a row goes to the later shard if what stands before it reaches the target
                missing = total * number - shards * reached
                if missing <= 0:
                    done[place] = (row["range"], 0)
                    break
                if shards * row["bytes"] > missing and row["rows"] > 1 and row["bytes"] > allowed:
                    if not last_round:
                        open_ones[place] = (number, row["range"], reached)
                        break
                    earlier = -(-missing * row["rows"] // (shards * row["bytes"]))
                    if earlier < row["rows"]:
                        done[place] = (row["range"], earlier)
                        break
                reached += row["bytes"]
            else:
                done[place] = (_after(prefix), 0)
    return done


def _after(prefix):
    """A key above all keys that start with ``prefix``."""
    return prefix + "g"


def shard_of(key, splitters, number=None):
    """How many boundaries stand before a row: prefixes compare like the keys they start.
    ``number`` is the row's place among those of its key, where a boundary parts them."""
    after = lambda prefix, skip: (key > prefix) | (key == prefix) & (number >= skip)
    return sum(((key >= prefix if number is None else after(prefix, skip)).cast("int") for prefix, skip in splitters), F.lit(0))


def _placed(inner, shards, tolerance):
    """``inner`` (row struct, key, size) as the columns of ``row``, shard and slot."""
    narrow = kept(inner.select("key", "size"))
    splitters = find_splitters(narrow, shards, tolerance)
    limit = max(narrow.count() // 1024, 1000)
    start = F.substring("key", 1, _DIGITS)
    heavy = [row["range"] for row in narrow.groupBy(start.alias("range")).count().filter(F.col("count") > limit).collect()]  # 1024 at most
    cut = sorted({prefix for prefix, skip in splitters if skip})
    counted = {}
    if heavy or cut:
        keys = narrow.filter(start.isin(heavy) | F.col("key").isin(cut)).groupBy("key").count()
        counted = dict(keys.filter((F.col("count") > limit) | F.col("key").isin(cut)).collect())  # 1024 and the shards at most
    is_counted = F.col("key").isin(list(counted)) if counted else F.lit(False)

    # buckets: ranges of the key; where one range holds much, single texts and parts of them,
    # and what lies between counted keys
    beside = {}
    for key in sorted(counted):
        beside.setdefault(key[: _HALF + _DIGITS], []).append(key)
    parted = set(heavy) | {key[:_DIGITS] for key in counted}
    text = F.substring("key", 1, _HALF + _DIGITS)
    bucket = start
    if parted:
        bucket = F.when(start.isin(sorted(parted)), text).otherwise(start)
    if beside:
        lists = F.create_map(*[part for prefix, keys in beside.items() for part in (F.lit(prefix), F.array(*map(F.lit, keys)))])
        lower = F.size(F.filter(lists[text], lambda other: other < F.col("key")))
        bucket = F.when(text.isin(list(beside)), F.concat(text, F.lpad((2 * lower).cast("string"), 5, "0"))).otherwise(bucket)

    plain = narrow.filter(~is_counted).groupBy(shard_of(F.col("key"), splitters).alias("shard"), bucket.alias("bucket")).agg(F.count("*").alias("rows"))
    pieces = []
    for key, rows in counted.items():
        prefix = key[: _HALF + _DIGITS]
        name = f"{prefix}{2 * beside[prefix].index(key) + 1:05d}"
        first = sum(key > other or key == other and not skip for other, skip in splitters)
        edges = [0, *sorted(skip for other, skip in splitters if other == key and skip), rows]
        pieces += [(first + place, name, high - low, key, low) for place, (low, high) in enumerate(zip(edges, edges[1:])) if high > low]
    pieces = inner.sparkSession.createDataFrame(pieces, "shard int, bucket string, rows long, key string, low long")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept(
        plain.unionByName(pieces, allowMissingColumns=True).withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("long"))
    )

    rows = inner.filter(~is_counted).withColumn("shard", shard_of(F.col("key"), splitters)).withColumn("bucket", bucket)
    # the one exchange of whole rows
    number = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("key")) - 1
    plain_starts = starts.filter("key IS NULL").select("shard", "bucket", "start")
    rows = rows.withColumn("number", number).join(sized(plain_starts), ["shard", "bucket"])
    placed = rows.select("row", "shard", (F.col("start") + F.col("number")).cast("long").alias("slot"))
    if counted:
        placed = placed.unionByName(_counted_rows(inner.filter(is_counted), starts.filter("key IS NOT NULL"), splitters))
    return placed.select("row.*", F.col("shard").cast("int").alias("shard"), "slot")


def _counted_rows(inner, starts, splitters):
    """Shard and slot of the rows of counted keys. Equal rows cannot be told apart, so they
    are one row with a number of copies until their places are known."""
    spread = F.pmod(F.xxhash64("row"), F.lit(_SPREAD))
    equal = kept(inner.groupBy("key", "row").agg(F.count("*").alias("copies")).withColumn("spread", spread))
    groups = equal.groupBy("key", "spread").agg(F.sum("copies").alias("rows"))
    earlier = Window.partitionBy("key").orderBy("spread").rowsBetween(Window.unboundedPreceding, -1)
    groups = kept(groups.select("key", "spread", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("group_start")))
    within = Window.partitionBy("key", "spread").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    equal = equal.withColumn("inside", F.coalesce(F.sum("copies").over(within), F.lit(0))).join(sized(groups), ["key", "spread"])
    equal = equal.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(_COPIES).cast("long"))))
    equal = equal.repartition("key", "spread", "inside", "chunk")
    last = F.least(F.col("chunk") + _COPIES, F.col("copies")) - 1
    copies = equal.withColumn("copy", F.explode(F.sequence("chunk", last)))
    copies = copies.withColumn("number", F.col("group_start") + F.col("inside") + F.col("copy"))
    copies = copies.withColumn("shard", shard_of(F.col("key"), splitters, F.col("number")))
    copies = copies.join(sized(starts.select("key", "shard", "low", "start")), ["key", "shard"])
    return copies.select("row", "shard", (F.col("start") + F.col("number") - F.col("low")).cast("long").alias("slot"))


def _others(rows, *gone):
    """All columns but those to be replaced, in one struct: inner names cannot clash with them."""
    names = {"shard", "slot", *(name.lower() for name in gone)}
    return F.struct(*[rows[f"`{name}`"] for name in rows.columns if name.lower() not in names]).alias("row")


def shard_keyed(rows, key, size, shards=16, tolerance=0.0):
    """Adds ``shard`` and ``slot`` to ``rows``, which have the columns ``key`` and ``size``.

    Rows of equal key are of equal size. The key column goes.
    """
    return _placed(rows.select(_others(rows, key), F.col(key).alias("key"), F.col(size).alias("size")), shards, tolerance)


def shard_rows(docs, shards=16, tolerance=0.0, text="text", tie="doc_id"):
    """Adds ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0) to every row.

    The size of a row is the bytes of its text (null: none) plus 1. Shards differ in bytes
    by one row at most, plus the tolerance. Equal texts stand together unless a boundary
    cuts their group. Rows with equal text and ``tie`` stand together too, in no stated
    order, and a boundary can part them. A null tie counts as empty text. An empty table
    gives no rows. Columns named shard or slot are replaced; columns of type map are not
    taken where a boundary falls between equal rows.
    """
    key, size = sort_key(F.col(text), F.col(tie)), byte_size(F.col(text))
    return _placed(docs.select(_others(docs), key.alias("key"), size.alias("size")), shards, tolerance)
