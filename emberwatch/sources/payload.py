"""Payloads of the web API."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberwatch.schemas import RECORD

_RECORDS = T.ArrayType(RECORD)
_WRAPPED = ["data", "sensors", "results"]


def read_api_payload(spark, path):
    """Records of payload documents, one document per file."""
    return records_of(spark.read.text(path, wholetext=True))


def records_of(payloads, column="value"):
    """Records of payload texts.

    A payload is an array of records, or an object holding one under ``data``, ``sensors``
    or ``results``; the first of these that is an array counts, even if empty. An object
    with none of them and an ``error`` fails the query; other payloads have no records.
    """
    text = F.col(column)
    bare = F.when(F.ltrim(text).startswith("["), F.from_json(text, _RECORDS))
    # Each field is taken as text first, so that one of another shape cannot spoil its siblings.
    fields = {name: F.get_json_object(text, f"$.{name}") for name in [*_WRAPPED, "error"]}
    arrays = [
        F.when(F.ltrim(fields[name]).startswith("["), F.from_json(fields[name], _RECORDS)) for name in _WRAPPED
    ]
    found = F.coalesce(bare, *arrays)
    failed = found.isNull() & (F.coalesce(fields["error"], F.lit("")) != "")
    checked = F.when(failed, F.raise_error(fields["error"])).otherwise(found)
    return payloads.select(F.explode(checked).alias("record")).select("record.*")
