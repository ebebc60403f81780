"""Schedule files below `version=<name>/`, every column text, selected by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwind.sources.records import SCHEDULE_FILES


def version_paths(spark: SparkSession, root: str, file: str) -> list[str]:
    """Paths of one file, a few per year."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/version=*/{file}.txt")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    return sorted(status.getPath().toString() for status in found or [])


def read_versioned(spark: SparkSession, root: str, file: str) -> DataFrame:
    """Named columns of one file in all versions, plus the version taken from the path.

    Spark takes the header of one file for all files of a scan and binds the others by position.
    Column order differs between versions, so each version is a scan of its own.
    """
    paths = version_paths(spark, root, file)
    if not paths:
        raise FileNotFoundError(f"no version=*/{file}.txt below {root}")
    version = F.regexp_extract(F.col("_metadata.file_path"), "version=([^/]+)/", 1)
    scans = [
        spark.read.option("header", True)
        .csv(path)
        .select(*SCHEDULE_FILES[file], version.alias("gtfs_version"))
        for path in paths
    ]
    return reduce(DataFrame.unionByName, scans)
