"""A training corpus from ``documents``: five stages, each reread from Parquet by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import linededup, packing, pii, simhash, toxicity
from corpusloom.llm.common import read, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go."""
    return toxicity.reject(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sources share go from all documents but one."""
    return linededup.remove_boilerplate(docs).drop("n_removed")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: SimHash candidates, then all others; five-word shingles, similarity 0.8 or more."""
    return simhash.deduplicate(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs, pii.train(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token pieces with their sequences and offsets."""
    import public_tokenizers as P

    return packing.pack_documents(docs, P.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: Learnt scores, fingerprints and tokens cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; their tables are written to the shared folder, where only the last one stays."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            place = spark._jvm.org.apache.hadoop.fs.Path(before)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        before = path
    return docs
