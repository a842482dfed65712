"""Fixed values as literal expressions, each sent to Spark in one piece."""

from pyspark.sql import functions as F


def sql_literal(value):
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def sql_list(values):
    return ", ".join(sql_literal(value) for value in values)


def literal_map(mapping):
    return F.expr(f"map({sql_list(item for pair in mapping.items() for item in pair)})")


def literal_array(values):
    return F.expr(f"array({sql_list(values)})")

