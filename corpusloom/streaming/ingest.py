"""Incremental ingest: streaming twins of the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.text import crawl_url


def read_stream(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """New Parquet files of a table, some at a time; the path is a folder or one file."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{path}*")


def dedup_stream(stream: DataFrame, url: str = "url", ts: str | None = None, late: str = "7 days") -> DataFrame:
    """The first row of each address; with an event time, state is kept only as long as rows may be late."""
    keyed = stream.withColumn("_url", crawl_url(F.col(url)))
    if ts is None:
        return keyed.dropDuplicates(["_url"])
    return keyed.withWatermark(ts, late).dropDuplicatesWithinWatermark(["_url"])


def daily_stream(stream: DataFrame, ts: str, hit: Column, late: str = "1 day") -> DataFrame:
    """(day, n, hits) by event time."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    counts = timed.groupBy(F.window(ts, "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("hits"))
    return counts.select(F.to_date("w.start").alias("day"), "n", "hits")


def run_available(df: DataFrame, table: str, mode: str = "append") -> StreamingQuery:
    """All data there is now, into a table in memory."""
    query = df.writeStream.outputMode(mode).format("memory").queryName(table).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def resume(stream: DataFrame, done_path: str, key: str, work: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Work on the rows whose key is not yet in ``done_path``, and append the results there."""

    def batch(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        try:
            done = spark.read.parquet(done_path).select(key).distinct()
            rows = rows.join(done, key, "left_anti")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
        work(rows).write.mode("append").parquet(done_path)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
