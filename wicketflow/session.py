"""Session settings for local runs; a cluster brings its own session."""

import os
from pathlib import Path

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it was not shipped with the job (`--py-files`)."""
    root, setting = str(Path(__file__).parents[1]), spark.sparkContext.environment
    if root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        setting.setdefault("PYTHONPATH", root)


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wicketflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
