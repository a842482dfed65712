"""Session settings."""

from pyspark.sql import SparkSession


def build_session(app_name="emberwatch", master=None, settings=None):
    """Session with the settings the operators assume.

    The time zone is UTC because readings carry naive local time. Sizes such as the
    number of shuffle partitions are left to the cluster; pass them in ``settings``.
    Generated methods above 8000 bytes are never compiled by the JVM; with the limit set
    to that, Spark uses its split form for the few very wide projections instead.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
