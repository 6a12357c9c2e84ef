"""A fresh folder for written tables."""

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="wicketflow-")


def _is_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def base_folder(setting: str | None, master: str) -> str:
    """The folder the cluster names; a machine's own one only where driver and executors are one process.

    Elsewhere each executor would write to its own disk and a later read would miss those files.
    """
    if setting:
        return setting.rstrip("/")
    if _is_one_machine(master):
        return _local_folder()
    raise ValueError(f"set {_SETTING} to a folder that all executors of {master} share")


def shared_folder(spark: SparkSession) -> str:
    """A new name in the shared folder; what is written there goes when the session ends."""
    base = base_folder(spark.conf.get(_SETTING, None), spark.sparkContext.master)
    own = f"{base}/{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{own}/data"


def stage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What follows starts from the stored files: it survives lost executors, is not computed again
    for every use, and is planned with the true size.
    """
    folder = shared_folder(spark)
    df.write.parquet(folder)
    return spark.read.parquet(folder)
