"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.shipping import ship

#: Rows of an Arrow batch: whole texts are handed to Python, so a batch stays at a few MB.
BATCH_ROWS = 256


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in small Arrow batches, by rows and by bytes, and send this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a temporary folder if all runs on one machine, else an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def hidden(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns renamed own_0, own_1, ... so that no name of theirs can clash, and the new name of each."""
    names = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def shown(names: dict[str, str], without: Iterable[str] = ()) -> list[Column]:
    """The columns of ``hidden`` under their own names, but for those that the names ``without`` replace."""
    replaced = {c.lower() for c in without}
    return [F.col(own).alias(c) for c, own in names.items() if c.lower() not in replaced]


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder; a lost executor loses nothing of it.

    The folder is the session's ``spark.checkpoint.dir``.  Only where that is unset, as in
    tests on one machine, a temporary folder is used.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """df as a table of the shared folder, deleted at the end of the block: nothing may read it after that."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Have the files of shuffles that no table needs any more deleted.

    The engine deletes them once the driver's collector finds their tables gone, which by itself may take
    half an hour; tables that are still named keep theirs.
    """
    gc.collect()
    spark._jvm.System.gc()


#: A key is hot if it has more than one in so many of the rows; then there are at most as many hot keys.
HOT_SHARE = 4096
#: Fewer rows of a key are never hot.
HOT_LEAST = 64


def keyed_join(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join of rows with one row a key; ``count`` says how many of the ``total`` rows have the key.

    The table must be materialised, and rows cheap to make twice.  Hot keys, at most HOT_SHARE, are broadcast, so their rows stay where
    they are; the rest is joined by key.
    """
    least = max(HOT_LEAST, total // HOT_SHARE)
    hot = table.filter(F.col(count) > least)
    if hot.isEmpty():
        return rows.join(table, keys)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(table.filter(F.col(count) <= least), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(cold)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def id_as_text(col: str) -> Column:
    """Ids go through Python as text: pandas would turn null or very large ones into floats."""
    return F.col(col).cast("string").alias("_id")


def id_restored(df: DataFrame, like: DataFrame, col: str) -> DataFrame:
    kind = like.schema[col].dataType
    return df.select(F.col("_id").cast(kind).alias(col), *[c for c in df.columns if c != "_id"])


def fold(modulus: int, col: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def global_rank(df: DataFrame, group: list[str], order: list[str], carry: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Number rows from 0 within ``group`` by ``order`` without gathering a group in one task.

    The rows are range-partitioned and sorted by (group, order) and written once to the
    checkpoint folder with their place in their partition.  The start of each (partition, group)
    run is then a prefix sum over one row for each run: at most partitions + groups rows.
    Returns (df with ``_rank``, run table).  Ties in ``order`` get arbitrary but fixed ranks.
    """
    from pyspark.sql import Window

    keys = [*group, *order]
    placed = materialize(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    )
    placed = placed.withColumn("_part", F.shiftright("_at", 33).cast("int"))
    runs = placed.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    same = F.col("p._part") == F.col("r._part")
    for g in group:
        same = same & F.col(f"p.{g}").eqNullSafe(F.col(f"r.{g}"))
    ranked = (
        placed.alias("p")
        .join(F.broadcast(runs.alias("r")), same)
        .select("p.*", (F.col("r._before") + F.col("p._at") - F.col("r._first")).alias("_rank"))
        .drop("_at", "_part")
    )
    return ranked, runs
