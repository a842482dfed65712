"""A folder that the driver and all executors share, and steps in it that happen once."""

import tempfile
import uuid


def shared_folder(spark):
    """The checkpoint folder of the session. Only a local session gets one of its own."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        wanted = spark.conf.get("spark.checkpoint.dir", None)
        if not wanted and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(wanted or tempfile.mkdtemp(prefix="emberwatch-"))
    return context.getCheckpointDir()


def new_folder(spark, name):
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _hadoop_path(spark, path):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark, path):
    """Names in a folder; none if there is no such folder."""
    folder = _hadoop_path(spark, path)
    system = _file_system(spark, folder)
    return [status.getPath().getName() for status in system.listStatus(folder)] if system.exists(folder) else []


def rename_once(spark, source, target):
    """Give a folder its final name, unless that name is taken; says whether it was given."""
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    target = _hadoop_path(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(_hadoop_path(spark, source), target, options)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def delete(spark, path):
    folder = _hadoop_path(spark, path)
    _file_system(spark, folder).delete(folder, True)
