"""All queries by name, and the SQL that they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import curation, evaluation, extras, ingest

MODULES = (ingest, curation, evaluation, extras)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.S.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["surviving_articles"](spark, sf_dir)
