"""From abnormal rows to alert messages.

A message is a header and one block per sensor, in order. Messages may be long, so they
are never gathered into one row: the blocks stay rows, and only the parts that are sent,
which have a size limit, become text of their own.
"""

from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch import constants as K
from emberwatch.functions import display
from emberwatch.functions.labels import resolve_status
from emberwatch.operators import parts
from emberwatch.operators.parts import compose_shards, enter_shards, pack_fragments, trace_lengths
from emberwatch.sources.shared import new_folder

# Sent along with the tasks, so that executors do not need this package installed.
cloudpickle.register_pickle_by_value(parts)

# Blocks numbered per bucket of this many hash digits: at most 16**3 counts per severity.
_HASH_DIGITS = 3
# Sensors whose blocks are packed by one task; about 15 MB of text.
SHARD_SENSORS = 50_000
# Shards whose results one task composes: at most one run for each length a part may have.
FAN = 8
_RUNS = "severity_rank int, shard bigint, entry int, leaves int, closed bigint"
_STARTS = "severity_rank int, shard bigint, entry int, part bigint, parts bigint"

_MEASURES = ["temperature", "smoke_ppm", "lpg_gas_ppm", "co_gas_ppm"]
_SEVERITY = {2: K.FIRE, 1: K.FIRE_RISK}


def alert_projection(abnormal, code):
    """The alert columns of one class, its own probability first."""
    own, other = ("probability_fire", "probability_risk") if code == 2 else ("probability_risk", "probability_fire")
    return abnormal.filter(F.col("prediction") == code).select(
        "sensor_id", "zone", "timestamp", *_MEASURES,
        F.col("prediction").cast("double").alias("prediction"), "prediction_label", own, other,
    )


def alert_groups(abnormal, code="prediction"):
    """Abnormal rows with ``severity`` and ``severity_rank``: FIRE is 0, FIRE_RISK is 1."""
    severity = F.when(F.col(code) == 2, F.lit(K.FIRE)).otherwise(F.lit(K.FIRE_RISK))
    rows = abnormal.filter(F.col(code).isin([*_SEVERITY])).withColumn("severity", severity)
    return rows.withColumn("severity_rank", F.when(F.col("severity") == K.FIRE, 0).otherwise(1))


def alert_group_sizes(groups):
    return groups.groupBy("severity_rank", "severity").agg(F.count("*").alias("sensors"))


def alert_index(groups):
    """Adds ``alert_number``, 1.. within each severity, and ``sensors``, its size.

    Numbers follow a hash of sensor and zone: the order carries no meaning, but it is the
    same on every run. Rows are numbered per hash bucket and shifted by the counts of the
    buckets before, so no task has to hold a whole severity.
    """
    names = [F.coalesce(F.col(name), F.lit("")) for name in ("sensor_id", "zone")]
    hashed = groups.withColumn("hash", F.md5(F.concat_ws("|", *names)))
    hashed = hashed.withColumn("bucket", F.substring("hash", 1, _HASH_DIGITS))
    counts = hashed.groupBy("severity_rank", "bucket").agg(F.count("*").alias("n"))
    severity = Window.partitionBy("severity_rank")
    earlier = severity.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "severity_rank",
        "bucket",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.sum("n").over(severity).alias("sensors"),
    )
    within = Window.partitionBy("severity_rank", "bucket").orderBy("hash", "sensor_id", "zone")
    numbered = hashed.withColumn("place", F.row_number().over(within))
    # Two severities and 16**3 buckets bound the side that is broadcast.
    joined = numbered.join(F.broadcast(offsets), ["severity_rank", "bucket"])
    return joined.withColumn("alert_number", F.col("offset") + F.col("place")).drop("hash", "bucket", "place", "offset")


def _or_not_available(name):
    return F.coalesce(F.col(name).cast("string"), F.lit(K.NOT_AVAILABLE))


def alert_sensor_text():
    """The text block of one sensor, as a column over alert rows."""
    c = F.col
    shown = {
        **{name: _or_not_available(name) for name in ("sensor_id", "zone", "timestamp")},
        "temperature": display.display_measure(c("temperature"), K.UNIT_TEMPERATURE),
        **{name: display.display_measure(c(name), K.UNIT_PPM) for name in _MEASURES[1:]},
        "status": resolve_status(c("prediction_label"), c("prediction")),
        "probability_fire": display.display_probability(c("probability_fire")),
        "probability_risk": display.display_probability(c("probability_risk")),
    }
    return F.concat_ws("\n", *[F.concat(F.lit(text), shown[name]) for name, text in K.ALERT_FIELDS.items()])


def _per_severity(texts):
    return F.when(F.col("severity") == K.FIRE, F.lit(texts[K.FIRE])).otherwise(F.lit(texts[K.FIRE_RISK]))


def alert_header():
    """Severity title, number of sensors and advice, as a column over numbered alert rows."""
    before, after = K.ALERT_FOUND.split("{n}")
    ending = F.replace(F.lit(after), F.lit("{severity}"), F.col("severity"))
    found = F.concat(F.lit(before), F.col("sensors").cast("string"), ending)
    return F.concat_ws("\n", _per_severity(K.ALERT_TITLE), F.lit(""), found, _per_severity(K.ALERT_ADVICE), F.lit(""))


def alert_message(indexed):
    """The messages as rows: per severity block 0 is the header, block n the n-th sensor.

    The text of a message is its blocks joined by line breaks.
    """
    number = F.col("alert_number")
    title = F.concat(_per_severity(K.ALERT_SENSOR_TITLE), number.cast("string"))
    written = indexed.withColumns(
        {"block_text": F.concat_ws("\n", title, alert_sensor_text(), F.lit("")), "header_text": alert_header()}
    )
    block = F.struct(number.alias("block"), F.col("block_text").alias("text"))
    header = F.struct(F.lit(0).cast("bigint").alias("block"), F.col("header_text").alias("text"))
    blocks = F.when(number == 1, F.array(header, block)).otherwise(F.array(block))
    return written.select("severity_rank", "severity", "sensors", F.inline(blocks))


def alert_message_parts(message, max_length=K.MESSAGE_LIMIT - K.MESSAGE_RESERVE, shard_sensors=SHARD_SENSORS, fan=FAN):
    """The messages cut into parts of at most ``max_length`` characters, as they are sent.

    Lines are packed greedily, and where a part ends depends on all lines before. That is
    solved exactly in three steps: every shard of blocks works out, for each length the
    open part may have when the shard begins, how it ends; these results are composed up a
    tree of ``fan`` shards a node, and the lengths that the shards really begin with are handed
    down again; then all shards pack their lines. Only parts that cross a shard border are put
    together afterwards. No task holds the results of more than ``fan`` shards. The results of
    the first step are stored in the shared folder.
    """
    limit = max(K.MESSAGE_MINIMUM, int(max_length))
    last = F.col("block") == F.col("sensors")
    blocks = message.select(
        "severity_rank",
        "block",
        F.when(last, F.rtrim(F.col("text"), F.lit("\n"))).otherwise(F.col("text")).alias("text"),
        F.floor(F.greatest(F.col("block") - 1, F.lit(0)) / shard_sensors).cast("bigint").alias("shard"),
    )
    sharded = blocks.groupBy("severity_rank", "shard")
    traced = sharded.applyInPandas(lambda key, rows: trace_lengths(key, rows, limit), _RUNS)
    starts = _shard_starts(traced, fan)
    fragments = sharded.cogroup(starts.groupBy("severity_rank", "shard")).applyInPandas(
        lambda key, rows, start: pack_fragments(key, rows, start, limit),
        "severity_rank int, part bigint, parts bigint, shard bigint, text string",
    )
    pieces = F.array_sort(F.collect_list(F.struct("shard", "text")))  # of one part, so limited in size
    bodies = fragments.groupBy("severity_rank", "part", "parts").agg(
        F.array_join(F.transform(pieces, lambda piece: piece["text"]), "").alias("body")
    )
    before, between, after = _split_prefix()
    prefix = F.concat(F.lit(before), F.col("part").cast("string"), F.lit(between), F.col("parts").cast("string"), F.lit(after))
    return bodies.select(
        "severity_rank",
        F.when(F.col("severity_rank") == 0, F.lit(K.FIRE)).otherwise(F.lit(K.FIRE_RISK)).alias("severity"),
        "part",
        "parts",
        F.concat(F.when(F.col("parts") > 1, prefix).otherwise(F.lit("")), F.col("body")).alias("text"),
    )


def _shard_starts(traced, fan):
    """How each shard begins, from the runs of all: up the tree level by level, and down again."""
    path = new_folder(traced.sparkSession, "alert-runs")
    traced.write.parquet(path)
    level = traced.sparkSession.read.schema(_RUNS).parquet(path)
    shards = (level.agg(F.max("shard")).first()[0] or 0) + 1
    levels = [level]
    while shards > fan:
        shards = -(-shards // fan)
        level = level.groupBy("severity_rank", F.floor(F.col("shard") / fan).alias("node")).applyInPandas(compose_shards, _RUNS)
        levels.append(level)
    starts = None
    for level in reversed(levels):
        node = F.floor(F.col("shard") / fan).alias("node")
        grouped = level.groupBy("severity_rank", node)
        if starts is None:
            starts = grouped.applyInPandas(lambda key, runs: enter_shards(key, runs, runs.iloc[:0]), _STARTS)
        else:
            above = starts.groupBy("severity_rank", F.col("shard").alias("node"))
            starts = grouped.cogroup(above).applyInPandas(enter_shards, _STARTS)
    return starts


def _split_prefix():
    before, rest = K.PART_PREFIX.split("{n}")
    between, after = rest.split("{total}")
    return before, between, after


