"""A table of stored batches with a log beside it.

The log is a folder of numbered entries. An entry is a small Parquet table that is written under
another name and gets its number by a rename that fails if the number is taken, so that two
writers never share one and readers see whole entries only. It says

* ``claim``: which number a batch may build its row ids on. Numbers rise over all streams and
  checkpoints that write the table; a batch that is tried again finds its claim.
* ``add``, ``remove``: which files the table has, with the lowest and highest id and time of
  each. Readers choose files by these and never list folders, so a compaction, which removes
  files and adds others in one entry, is seen as a whole or not at all.
* ``latest``: a snapshot of the latest rows of a stated meaning, and up to which entry it goes.
* ``gone``: which of the removed files are deleted.
* ``mark``: how far a reader has come.
* ``done``: which batch is stored.

A fold repeats in one table all that still counts, so that readers need not go further back.

Every entry is read with Spark; only the numbers are listed on the driver.
"""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch.functions.times import as_time
from emberwatch.sources.shared import delete, names_in, rename_once

#: Entries after which a writer folds the log.
FOLD_EVERY = 100
#: Rows that a compacted file has about.
ROWS_PER_FILE = 5_000_000
# A day of batches at the usual trigger; keeps the number of folders per level moderate.
BATCHES_PER_GROUP = 2880

_ACTION = (
    "kind string, file string, stream string, batch long, name string, upto long, rows long, "
    "low_id long, high_id long, null_ids long, low_time timestamp_ntz, high_time timestamp_ntz, null_times long"
)
_COLUMNS = [field.split()[0] for field in _ACTION.split(", ")]


def stream_identity(spark):
    """Identity of the streaming query that handles a batch; it lives in its checkpoint.

    A restarted query keeps it, one with a fresh checkpoint gets another. Outside a stream
    it is ``none``.
    """
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def batch_folder(path, batch_id, stream="none"):
    return f"{path}/stream={stream}/batch_group={batch_id // BATCHES_PER_GROUP}/batch_id={batch_id}"


def zones_of(frame, id_column=None, time_column=None):
    """The whole-number id and the time without zone of a table's rows, for its zone map."""
    return (
        F.col("id").cast("long") if id_column is None else id_column,
        as_time(frame, "timestamp") if time_column is None else time_column,
    )


class BatchLog:
    """The log of the table at ``path``."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path.rstrip("/")
        self.folder = f"{self.path}/_log"

    # -- entries

    def _numbers(self):
        """Number of the last fold (-1 if none) and those of the entries behind it."""
        names = names_in(self.spark, self.folder)
        fold = max((int(name[5:]) for name in names if name.startswith("fold-")), default=-1)
        return fold, sorted(number for number in (int(name[6:]) for name in names if name.startswith("entry-")) if number > fold)

    def last(self):
        """Number of the last entry, -1 if there is none."""
        fold, entries = self._numbers()
        return max(entries, default=fold)

    def exists(self):
        return self.last() >= 0

    def actions(self):
        """All actions that count, each with the number of its ``entry``, and the last number."""
        fold, entries = self._numbers()
        paths = [f"{self.folder}/entry-{number:012d}" for number in entries]
        paths += [f"{self.folder}/fold-{fold:012d}"] if fold >= 0 else []
        if not paths:
            return self.spark.createDataFrame([], f"{_ACTION}, entry long"), -1
        read = self.spark.read.schema(f"{_ACTION}, entry long").parquet(*paths)
        number = F.regexp_extract("_metadata.file_path", r"/(?:entry|fold)-(\d{12})/[^/]*$", 1).cast("long")
        return read.withColumn("entry", F.coalesce("entry", number)), max(entries, default=fold)

    def _append(self, rows, since=None):
        """Write an entry under the next free number, which is returned.

        With ``since``, gives None and writes nothing if an entry behind that number takes files
        away: the entry at hand was made from a table that is not there any more.
        """
        waiting = f"{self.folder}/waiting-{uuid.uuid4().hex}"
        known = [name for name in _COLUMNS if name in rows.columns]
        missing = [F.lit(None).cast(kind.split()[1]).alias(kind.split()[0]) for kind in _ACTION.split(", ") if kind.split()[0] not in known]
        rows.select(*known, *missing).coalesce(1).write.parquet(waiting)
        number = (self.last() if since is None else since) + 1
        while not rename_once(self.spark, waiting, f"{self.folder}/entry-{number:012d}"):
            if since is not None:
                actions, last = self.actions()
                if not actions.filter((F.col("kind") == "remove") & (F.col("entry") > since)).isEmpty():
                    delete(self.spark, waiting)
                    return None
                number = last
            number += 1
        if number % FOLD_EVERY == FOLD_EVERY - 1:
            self.fold()
        return number

    def _one(self, **values):
        names = ", ".join(field for field in _ACTION.split(", ") if field.split()[0] in values)
        return self.spark.createDataFrame([tuple(values[field.split()[0]] for field in names.split(", "))], names)

    def fold(self):
        """Repeat what counts in one table and clean up what the fold before this one replaced."""
        actions, last = self.actions()
        earlier, _ = self._numbers()
        done = actions.filter("kind = 'done'")
        claims = actions.filter("kind = 'claim'").join(done.select("stream", "batch"), ["stream", "batch"], "left_anti")
        newest = Window.partitionBy("name").orderBy(F.desc("entry"))
        snapshots = actions.filter("kind = 'latest'").withColumn("place", F.row_number().over(newest)).filter("place = 1").drop("place")
        marks = actions.filter("kind = 'mark'").groupBy("kind", "name").agg(F.max("upto").alias("upto"), F.max("entry").alias("entry"))
        whole = _live(actions).unionByName(marks, True).unionByName(snapshots, True).unionByName(claims, True).unionByName(done, True).unionByName(_replaced(actions), True)
        waiting = f"{self.folder}/waiting-{uuid.uuid4().hex}"
        whole.select(*_COLUMNS, "entry").write.parquet(waiting)
        if not rename_once(self.spark, waiting, f"{self.folder}/fold-{last:012d}"):
            delete(self.spark, waiting)
            return
        # whoever reads now may still need the last fold and the entries behind it, no older ones
        for name in names_in(self.spark, self.folder):
            kind, _, number = name.partition("-")
            if kind == "entry" and int(number) <= earlier or kind == "fold" and int(number) < earlier:
                delete(self.spark, f"{self.folder}/{name}")

    # -- what the entries say

    def files(self):
        """The files of the table with their zones, and the last entry this goes by."""
        actions, last = self.actions()
        return _live(actions), last

    def claim(self, stream, batch_id):
        """The number of a batch, higher than all that were claimed before; the same if asked again."""
        actions, _ = self.actions()
        own = actions.filter((F.col("kind") == "claim") & (F.col("stream") == stream) & (F.col("batch") == batch_id))
        number = own.agg(F.min("entry")).first()[0]
        return self._append(self._one(kind="claim", stream=stream, batch=batch_id)) if number is None else number

    def is_stored(self, stream, batch_id):
        actions, _ = self.actions()
        same = (F.col("kind") == "done") & (F.col("stream") == stream) & (F.col("batch") == batch_id)
        return not actions.filter(same).isEmpty()

    def mark(self, name, upto):
        """Note how far a reader has come, for instance with sending; a mark never goes back."""
        self._append(self._one(kind="mark", name=name, upto=upto))

    def marked(self, name):
        """How far that reader has come; -1 before its first mark."""
        actions, _ = self.actions()
        upto = actions.filter((F.col("kind") == "mark") & (F.col("name") == name)).agg(F.max("upto")).first()[0]
        return -1 if upto is None else upto

    # -- writing

    def write(self, frame, batch_id, stream=None, zones=zones_of):
        """Store one batch; a batch that is stored already stays as it is.

        What a try that did not come to its log entry has left is replaced; no reader has seen
        it. ``zones`` gives the id and time columns of a table whose columns are others.
        """
        stream = stream_identity(self.spark) if stream is None else stream
        if self.is_stored(stream, batch_id):
            return
        folder = batch_folder(self.path, batch_id, stream)
        frame.write.mode("overwrite").parquet(folder)
        done = self._one(kind="done", stream=stream, batch=batch_id)
        self._append(self._zones(folder, zones).unionByName(done, allowMissingColumns=True))

    def _zones(self, folder, zones):
        """An action ``add`` for each file of a folder."""
        rows = self.spark.read.parquet(folder)
        number, time = zones(rows)
        own = rows.select(F.col("_metadata.file_name").alias("name"), number.alias("id"), time.alias("time"))
        parts = own.groupBy("name").agg(
            F.count("*").alias("rows"),
            F.min("id").alias("low_id"), F.max("id").alias("high_id"), F.count_if(F.col("id").isNull()).alias("null_ids"),
            F.min("time").alias("low_time"), F.max("time").alias("high_time"), F.count_if(F.col("time").isNull()).alias("null_times"),
        )
        place = F.concat(F.lit(folder.removeprefix(f"{self.path}/") + "/"), F.col("name"))
        return parts.select(F.lit("add").alias("kind"), place.alias("file"), *parts.columns[1:])

    def compact(self, zones=zones_of, rows_per_file=None):
        """Put files of fewer than half of ``rows_per_file`` rows together, in the order of ids.

        One entry takes the old files away and adds the new ones. The old ones stay on disk for
        those who read them, until ``vacuum``. Null ids come first. Gives the number of files
        that were replaced; a compaction that another one has overtaken gives 0.
        """
        goal = rows_per_file or ROWS_PER_FILE
        files, last = self.files()
        small = files.filter(F.col("rows") * 2 <= goal)
        known = small.agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.max("upto").alias("upto")).first()
        if known["files"] < 2:
            return 0
        rows = self.read(small)
        folder = f"{self.path}/_compacted/{uuid.uuid4().hex}"
        number, _ = zones(rows)
        parts = -(-known["rows"] // goal)
        rows.withColumn("order of ids", number).repartitionByRange(parts, F.asc_nulls_first("order of ids")).sortWithinPartitions("order of ids").drop("order of ids").write.parquet(folder)
        added = self._zones(folder, zones).withColumn("upto", F.lit(known["upto"]))
        removed = small.select(F.lit("remove").alias("kind"), "file", F.lit(last).cast("long").alias("upto"))
        if self._append(added.unionByName(removed, allowMissingColumns=True), since=last) is None:
            delete(self.spark, folder)
            return 0
        return known["files"]

    def vacuum(self, upto=None):
        """Delete the files that compactions up to an entry, by default the last fold, have
        replaced. Who began to read before that compaction must be done. Gives their number."""
        upto = self._numbers()[0] if upto is None else upto
        actions, _ = self.actions()
        gone = _replaced(actions).filter(F.col("entry") <= upto).select("file")
        names = [row["file"] for row in gone.collect()]
        for name in names:
            delete(self.spark, f"{self.path}/{name}")
        if names:
            self._append(self.spark.createDataFrame([("gone", name) for name in names], "kind string, file string"))
        return len(names)

    # -- reading

    def read(self, files=None):
        """The rows of the given files, by default of all that the table has."""
        files = self.files()[0] if files is None else files
        paths = [f"{self.path}/{row['file']}" for row in files.select("file").collect()]
        if not paths:
            raise ValueError(f"no batch is stored at {self.path}")
        return self.spark.read.parquet(*paths)

    def newest_files(self, n, by="id"):
        """The files that can hold the ``n`` rows of the highest ``by``: ``id`` or ``time``.

        Files are added up from the highest lower bound on until they hold ``n`` rows with a
        value. No row that counts lies below the lowest of their bounds. Rows without a value
        come last; they count only if all others are fewer than ``n``.
        """
        files, _ = self.files()
        low, high, null = f"low_{by}", f"high_{by}", f"null_{by}s"
        valued = F.col("rows") - F.col(null)
        before = Window.orderBy(F.desc_nulls_last(low)).rowsBetween(Window.unboundedPreceding, -1)
        held = files.withColumn("before", F.coalesce(F.sum(valued).over(before), F.lit(0)))
        bound = held.filter(F.col(low).isNotNull() & (F.col("before") < n)).agg(F.min(low).alias("bound"))
        total = files.agg(F.coalesce(F.sum(valued), F.lit(0)).alias("total"))
        chosen = files.join(F.broadcast(bound)).join(F.broadcast(total))
        return chosen.filter((F.col(high) >= F.col("bound")) | ((F.col("total") < n) & (F.col(null) > 0)))

    def read_newest(self, n, by="id"):
        """Rows of the files that can hold the ``n`` newest; an operator over them gives what it
        would give over the table."""
        return self.read(self.newest_files(n, by))

    def read_range(self, low=None, high=None, by="time"):
        """Rows of the files that can hold rows from ``low`` to ``high``; null bounds are open."""
        files, _ = self.files()
        if low is not None:
            files = files.filter(F.col(f"high_{by}") >= F.lit(low))
        if high is not None:
            files = files.filter(F.col(f"low_{by}") <= F.lit(high))
        if files.isEmpty():
            return self.read().limit(0)
        return self.read(files)

    # -- latest rows

    def _snapshot(self, name):
        """Path and mark of the last snapshot, and the files it does not cover."""
        actions, last = self.actions()
        row = actions.filter((F.col("kind") == "latest") & (F.col("name") == name)).orderBy(F.desc("entry")).select("file", "upto").first()
        file, mark = (row["file"], row["upto"]) if row else (None, -1)
        return file, _live(actions).filter(F.col("upto") > mark), last

    def _latest(self, name, operator):
        file, newer, last = self._snapshot(name)
        parts = [self.spark.read.parquet(f"{self.path}/{file}")] if file else []
        if not parts or not newer.isEmpty():
            parts.append(self.read(newer))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return operator(rows), last

    def latest(self, name, operator):
        """``operator`` over the table, from its snapshot and what was stored since.

        The operator picks rows and gives the same for a table and for its own result put
        together with the rows it has not seen, as all meanings of "latest" do. Late rows are
        compared like any others, and keys that went silent live on in the snapshot.
        """
        return self._latest(name, operator)[0]

    def refresh_latest(self, name, operator):
        """Store a new snapshot; without one, ``latest`` reads the whole table."""
        rows, last = self._latest(name, operator)
        file = f"_latest/{name}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{file}")
        self._append(self._one(kind="latest", name=name, file=file, upto=last))


def _live(actions):
    """The files of a table: added and not removed, each with the entry up to which it goes."""
    removed = actions.filter("kind = 'remove'").select("file")
    added = actions.filter("kind = 'add'").withColumn("upto", F.coalesce("upto", "entry"))
    return added.join(removed, "file", "left_anti")


def _replaced(actions):
    """Files that were removed from the table and are still on disk."""
    return actions.filter("kind = 'remove'").join(actions.filter("kind = 'gone'").select("file"), "file", "left_anti")
