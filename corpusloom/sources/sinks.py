"""Exports: JSON lines, CSV, Parquet, rejects and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

# The leading columns of an export, in order.
LEADING = (
    "id", "source", "url", "title", "sapo", "body_preview", "publish_date", "crawl_timestamp", "quality_score", "final_label", "severity", "confidence", "rubric_total", "status",
    "model_a_label", "model_a_confidence", "model_a_rubric_scores", "model_b_label", "model_b_confidence", "model_b_rubric_scores", "human_label", "human_verified", "reviewer_id", "split",
)


def ordered(df: DataFrame) -> DataFrame:
    """Known columns first, the others after them."""
    return df.select(*[c for c in LEADING if c in df.columns], *[c for c in df.columns if c not in LEADING])


def finite(df: DataFrame) -> DataFrame:
    """NaN becomes null in all float columns."""
    return df.withColumns({f.name: F.nanvl(f.name, F.lit(None).cast(f.dataType)) for f in df.schema if f.dataType.typeName() in ("double", "float")})


def flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for CSV."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (ArrayType, MapType, StructType))]
    return df.withColumns({c: F.to_json(c) for c in nested})


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_splits(df: DataFrame, folder: str) -> list[str]:
    """train, validation and test in three formats; an empty split is left out."""
    written = []
    data = finite(ordered(df))
    for s in ("train", "validation", "test"):
        part = data.filter(F.col("split") == s)
        if part.limit(1).count():
            write_jsonl(part, f"{folder}/{s}.jsonl")
            flat(part).write.mode("overwrite").option("header", True).csv(f"{folder}/{s}.csv")
            part.write.mode("overwrite").parquet(f"{folder}/{s}.parquet")
            written.append(s)
    return written


def divide(df: DataFrame, accepted: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and the rest with null judged as failing."""
    good = F.coalesce(accepted, F.lit(False))
    return df.filter(good), df.filter(~good)


def append_events(events: DataFrame, path: str) -> None:
    """Add rows to an append-only log of a session; readers take the last event of a record."""
    write_jsonl(events, path, mode="append")


def report(df: DataFrame) -> str:
    """The one row of an aggregate as JSON."""
    return df.toJSON().first()


def card(title: str, facts: dict[str, object], sections: dict[str, str]) -> str:
    """A Markdown page of facts and sections."""
    table = "\n".join(["| fact | value |", "|---|---|", *(f"| {k} | {v} |" for k, v in facts.items())])
    return "\n\n".join([f"# {title}", table, *(f"## {k}\n\n{v}" for k, v in sections.items())]) + "\n"
