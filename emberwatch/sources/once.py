"""Append to a database table so that every batch counts once.

Tasks stage their rows under the name of their attempt. When all tasks are through, the driver
moves the staged rows of the attempts that Spark names into the table and notes the batch, in one
transaction. A batch that is noted already is staged and thrown away: it was committed before the
stream could mark it. What tasks that failed or were repeated have staged is never moved.

Any database with a DB-API driver that executors have will do. Beside ``table`` there are
``table_staged`` and ``table_batches``; ``create_tables`` makes them.
"""

import importlib
import json
import re
import uuid
from contextlib import closing
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from emberwatch import schemas

#: Rows sent to the database at once.
CHUNK = 1000
_TYPES = {"string": "TEXT", "double": "DOUBLE PRECISION", "integer": "INTEGER", "long": "BIGINT"}
_MARKS = {"qmark": "?", "format": "%s", "pyformat": "%s"}


def _checked(name):
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_.]*", name):
        raise ValueError(f"not a plain name: {name!r}")
    return name


@dataclass
class Staged(WriterCommitMessage):
    """What one task has staged."""

    attempt: str
    rows: int


class Database:
    """A driver module, how to connect with it, and the statements for one table."""

    def __init__(self, module, connect, table, columns):
        self.module, self.arguments = module, connect
        self.table, self.columns = _checked(table), [_checked(name) for name in columns]

    def connect(self):
        return closing(importlib.import_module(self.module).connect(**self.arguments))

    @property
    def mark(self):
        style = importlib.import_module(self.module).paramstyle
        if style not in _MARKS:
            raise ValueError(f"parameters of the style {style} are not supported")
        return _MARKS[style]

    @property
    def taken(self):
        """The error for a row that is there already."""
        return importlib.import_module(self.module).IntegrityError

    def create_tables(self, kinds):
        """The table and its two companions, where they are missing."""
        declared = ", ".join(f"{name} {_TYPES[kind]}" for name, kind in zip(self.columns, kinds, strict=True))
        with self.connect() as connection:
            cursor = connection.cursor()
            cursor.execute(f"CREATE TABLE IF NOT EXISTS {self.table} ({declared})")
            cursor.execute(f"CREATE TABLE IF NOT EXISTS {self.table}_staged (attempt VARCHAR(80), stream VARCHAR(80), batch BIGINT, {declared})")
            cursor.execute(f"CREATE TABLE IF NOT EXISTS {self.table}_batches (stream VARCHAR(80), batch BIGINT, PRIMARY KEY (stream, batch))")
            connection.commit()

    def stage(self, attempt, stream, batch, chunks):
        """Stage lists of rows; gives how many rows there were."""
        columns = ["attempt", "stream", "batch", *self.columns]
        statement = f"INSERT INTO {self.table}_staged ({', '.join(columns)}) VALUES ({', '.join([self.mark] * len(columns))})"
        count = 0
        with self.connect() as connection:
            for rows in chunks:
                connection.cursor().executemany(statement, [(attempt, stream, batch, *row) for row in rows])
                connection.commit()
                count += len(rows)
        return count

    def commit(self, stream, batch, staged):
        """Move what was staged into the table unless the batch was committed before."""
        columns = ", ".join(self.columns)
        move = f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {self.table}_staged WHERE attempt = {self.mark}"
        with self.connect() as connection:
            cursor = connection.cursor()
            try:
                cursor.execute(f"INSERT INTO {self.table}_batches (stream, batch) VALUES ({self.mark}, {self.mark})", (stream, batch))
            except self.taken:
                connection.rollback()
            else:
                for part in staged:
                    cursor.execute(move, (part.attempt,))
                    if cursor.rowcount != part.rows:
                        connection.rollback()
                        raise RuntimeError(f"{cursor.rowcount} of {part.rows} staged rows are there")
                connection.commit()
            connection.cursor().execute(f"DELETE FROM {self.table}_staged WHERE stream = {self.mark} AND batch = {self.mark}", (stream, batch))
            connection.commit()

    def abort(self, run):
        """Throw away what one try of a batch has staged."""
        with self.connect() as connection:
            connection.cursor().execute(f"DELETE FROM {self.table}_staged WHERE attempt LIKE {self.mark}", (f"{run}:%",))
            connection.commit()


class AppendOnce(DataSource):
    """The sink ``append_once``; see ``append_once`` for its options."""

    @classmethod
    def name(cls):
        return "append_once"

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("append_once only appends")
        database = Database(self.options["module"], json.loads(self.options["connect"]), self.options["table"], schema.fieldNames())
        return _Writer(database, self.options["stream"], int(self.options["batch"]))


class _Writer(DataSourceArrowWriter):
    def __init__(self, database, stream, batch):
        self.database, self.stream, self.batch = database, stream, batch
        self.run = uuid.uuid4().hex

    def write(self, iterator):
        attempt = f"{self.run}:{TaskContext.get().taskAttemptId()}"
        chunks = (
            list(zip(*[column.to_pylist() for column in part.columns], strict=True))
            for batch in iterator
            for part in (batch.slice(low, CHUNK) for low in range(0, len(batch), CHUNK))
        )
        return Staged(attempt, self.database.stage(attempt, self.stream, self.batch, chunks))

    def commit(self, messages):
        self.database.commit(self.stream, self.batch, [message for message in messages if message])

    def abort(self, messages):
        self.database.abort(self.run)


def append_once(frame, module, connect, table, stream, batch_id):
    """Append ``frame`` to ``table`` unless that batch of that stream is there already.

    ``module`` is a DB-API driver such as ``sqlite3`` or ``pymysql``, ``connect`` the arguments of
    its ``connect`` (they have to go into JSON). Text, whole and double columns are supported.
    """
    kinds = [field.dataType.typeName() for field in frame.schema]
    if set(kinds) - set(_TYPES):
        raise ValueError(f"columns of the kinds {sorted(set(kinds) - set(_TYPES))} are not supported")
    Database(module, connect, table, frame.columns).create_tables(kinds)
    frame.sparkSession.dataSource.register(AppendOnce)
    options = {"module": module, "connect": json.dumps(connect), "table": table, "stream": stream, "batch": str(batch_id)}
    frame.write.format("append_once").options(**options).mode("append").save()


def append_predictions_once(frame, module, connect, table, stream, batch_id):
    """Append the stored columns of scored rows once for each batch."""
    append_once(frame.select(*schemas.SCORED_COLUMNS), module, connect, table, stream, batch_id)
