"""Mixing sources to target weights.

Every source gets a budget of words. Its documents stand in the order of a hash-random key;
running totals of their sizes say which of them lie inside the budget. A budget above the
size of its source takes all documents once or more and the rest from the front again.

Running totals are distributed: documents fall into buckets by the leading bits of their
key, bucket totals are added up over the few buckets of a source, and only within a bucket
rows are added one by one. A source with a third of all rows is thus cut into 1024 parts.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch.llm.common import kept, sized

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_REPEATS = 2.0
WORDS = r"[^\x20\x09-\x0D]+"
_KEY_BITS = 60
_BUCKET_BITS = 10


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def random_key(*columns, seed="mix"):
    """60 bits from a hash that SQL engines share."""
    parts = [F.coalesce(column.cast("string"), F.lit("")) for column in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts)), 1, 15), 16, 10).cast("long")


def source_targets(sources, weights=WEIGHTS, share=SHARE, most=MOST_REPEATS):
    """Adds ``target`` to ``sources`` (source, source_size), one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and get ``share`` of all
    sizes by weight. None gets more than ``most`` times its size; what that leaves over goes
    to the others by weight. Sources that reach their limit are those with the lowest limit
    per weight, so one pass over them in that order gives the level of all others.
    """
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    rows = rows.withColumn("level", (total - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))) / F.sum("weight").over(onward))
    rows = rows.withColumn("place", F.row_number().over(by_ratio))
    free = F.when(F.col("limit") > F.col("level") * F.col("weight"), F.struct("place", "level"))
    level = F.min(free).over(Window.partitionBy())["level"]
    target = F.least("limit", F.coalesce(level * F.col("weight"), F.col("limit")))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs, weights=WEIGHTS, share=SHARE, most=MOST_REPEATS, seed="mix", carry=False):
    """What the mix takes of each row of ``docs`` (doc_id, text, source).

    Gives doc_id, text_key (a hash of the text), source, size (words), source_size, target,
    taken (words, repeats counted), copies (how often the document is used, a started one
    counting from half of its words on) and part (where its source ends, the words that the
    last, cut copy has; else null). Of every source exactly its target, rounded, is taken.
    With ``carry``, ``row`` holds all columns of the document as well.

    Null texts have no words. Documents without words take nothing; they are used as often
    as those around them. Rows with equal doc_id and text stand side by side in the order
    and are counted one by one. A null source is a source. An empty table gives no rows.
    """
    size, key = word_count(F.col("text")).alias("size"), random_key(F.col("doc_id"), seed=seed).alias("key")
    row = [F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")] if carry else []
    rows = kept(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "source", size, key, *row))
    bucket = F.shiftright("key", _KEY_BITS - _BUCKET_BITS).alias("bucket")
    buckets = kept(rows.groupBy("source", bucket).agg(F.sum("size").alias("words"), F.count("*").alias("rows")))
    sources = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sources, weights, share, most)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words", "rows")
    same = starts["source"].eqNullSafe(targets["source"])
    starts = kept(starts.join(sized(targets), same).drop(targets["source"]))
    places = rows.withColumn("bucket", bucket)
    same = places["source"].eqNullSafe(starts["source"]) & (places["bucket"] == starts["bucket"])
    placed = places.join(sized(starts), same).drop(starts["source"], starts["bucket"])
    before = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    placed = placed.withColumn("at", at).withColumn("budget", budget)
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    placed = placed.withColumn("whole", whole.cast("long"))
    rest = F.col("budget") - F.col("whole") * F.col("source_size") - F.col("at")
    placed = placed.withColumn("rest", F.greatest(F.lit(0), F.least(rest, F.col("size"))))
    started = (F.when(F.col("size") > 0, F.col("rest") * 2 >= F.col("size")).otherwise(rest > 0)).cast("long")
    cut = F.when((F.col("rest") > 0) & (F.col("rest") < F.col("size")), F.col("rest"))
    return placed.select(
        "doc_id",
        "text_key",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("whole") * F.col("size") + F.col("rest")).alias("taken"),
        (F.col("whole") + started).alias("copies"),
        cut.alias("part"),
        *[F.col("row") for _ in row],
    )


def mixed_documents(docs, **options):
    """The rows of ``docs`` as the mix uses them, whole: as often as ``copies`` says."""
    mixed = mix(docs, carry=True, **options).filter("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
