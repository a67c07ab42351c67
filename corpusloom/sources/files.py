"""JSON lines, Parquet and several-file scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_tolerant(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Malformed lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def scan_counting(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Malformed lines are kept in ``_corrupt_record``, all else null."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)


def scan_strict(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """A malformed line fails the job when it is read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def with_file_source(df: DataFrame, suffix: str = "_extracted") -> DataFrame:
    """Adds ``file_source``: the file's stem without the suffix."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)
    return df.withColumn("file_source", F.regexp_replace(stem, f"{suffix}$", ""))


def scan_splits(spark: SparkSession, folder: str, splits: tuple[str, ...] = ("train", "validation", "test")) -> DataFrame:
    """Parquet files of the splits in one table; missing columns are null."""
    out = None
    for s in splits:
        part = spark.read.parquet(f"{folder}/{s}.parquet")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
