"""Data tests: each suite is one pass over the data, then a row for each test."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    failures: Column  # an aggregate; 0 passes
    critical: bool = False


REQUIRED = ("id", "source", "url", "title", "final_label")


def pending(df: DataFrame) -> Column:
    return F.coalesce((F.col("status") == "review") & F.col("final_label").isNull(), F.lit(False))


def _share_outside(column: str, values: list, low: float, high: float) -> Column:
    total = F.count(column)
    outside = F.lit(0)
    for v in values:
        n = F.count_if(F.col(column) == v)
        outside = outside + F.when((n > 0) & ~(n / total).between(low, high), 1).otherwise(0)
    return outside


def data_checks(df: DataFrame, sources: list[str], now: str) -> list[Check]:
    """The ten tests; ``now`` is fixed by the caller so that a rerun says the same."""
    live = ~pending(df)
    label = F.col("final_label")
    missing = F.lit(0)
    for c in REQUIRED:
        missing = missing + F.count_if(live & F.col(c).isNull())
    ts = F.col("published")
    bad_time = ts.isNull() | (ts > F.lit(now).cast("timestamp")) | (ts < F.lit("2020-01-01").cast("timestamp"))
    return [
        Check("url_uniqueness", F.count(F.lit(1)) - F.count_distinct(F.coalesce(F.col("url"), F.lit("\0"))), True),
        Check("label_validity", F.count_if(live & ~F.coalesce(label.isin(0, 1), F.lit(False))), True),
        Check("no_nulls", missing, True),
        Check("quality", F.count_if(F.coalesce(F.col("quality_score") < 4, F.lit(False)))),
        Check("source_share", _share_outside("source", sources, 0.08, 0.20)),
        Check("class_share", _share_outside("final_label", [0, 1], 0.45, 0.55)),
        Check("confidence_range", F.count_if(~F.col("confidence").between(0, 1))),
        Check("utf8", F.count_if(~F.is_valid_utf8(F.col("title")))),
        Check("timestamps", F.count_if(bad_time)),
        Check("preview_length", F.count_if(F.length(F.coalesce("preview", F.lit(""))) < 50)),
    ]


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(test, critical, failures, passed, status) from one aggregation."""
    row = df.agg(*[c.failures.cast("long").alias(c.name) for c in checks])
    rows = F.array(*[F.struct(F.lit(c.name).alias("test"), F.lit(c.critical).alias("critical"), F.col(c.name).alias("failures")) for c in checks])
    long = row.select(F.inline(rows))
    passed = F.col("failures") == 0
    status = F.when(passed, "PASS").when(F.col("critical"), "FAIL (CRITICAL)").otherwise("WARN")
    return long.select("test", "critical", "failures", passed.alias("passed"), status.alias("status"))


def export_allowed(results: DataFrame) -> bool:
    return results.filter("critical and not passed").limit(1).count() == 0


def merged_checks(with_decisions: bool = True) -> list[Check]:
    """The gate before export; without a decisions file the last two pass."""
    scores = F.col("rubric_total")
    lone = lambda hit: hit if with_decisions else F.lit(0)
    filled = F.col("url").isNotNull() & (F.col("url") != "")
    return [
        Check("titles", F.count_if(F.coalesce(F.col("title"), F.lit("")) == ""), True),
        Check("serializable", F.count_if(F.to_json(F.struct("id", "title")).isNull()), True),
        Check("url_duplicates", F.count_if(filled) - F.count_distinct(F.when(filled, F.col("url"))), True),
        Check("labels", F.count_if(F.col("final_label").isNotNull() & ~F.col("final_label").isin(0, 1)), True),
        Check("rubric", F.count_if(scores.isNotNull() & ~scores.between(-1, 8)), True),
        Check("severity", F.count_if(~F.coalesce(F.col("severity").between(0, 3), F.lit(False))), True),
        Check("confidence", F.count_if(F.col("confidence").isNotNull() & ~F.col("confidence").between(0, 1)), True),
        Check("human_verified", F.count_if(F.coalesce((F.col("review_status") == "human_reviewed") & ~F.col("human_verified"), F.lit(False))), True),
        Check("pending", lone(F.count_if(F.col("review_status") == "pending")), True),
        Check("reviewer", lone(F.count_if((F.col("review_status") == "human_reviewed") & F.col("reviewer_id").isNull())), True),
    ]


def violations() -> Column:
    """Codes of what is wrong with a record of the extraction stage."""
    rules = {
        "id": F.col("id").isNull(),
        "title": F.coalesce(F.col("title"), F.lit("")) == "",
        "body_text": F.length(F.coalesce("body", F.lit(""))) < 150,
        "body_preview": F.length(F.coalesce("preview", F.lit(""))) > 510,
    }
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))


def record_errors() -> Column:
    """Codes of what is wrong with a merged record; a null severity passes here."""
    rules = {
        "missing_id": F.col("id").isNull(),
        "missing_title": F.coalesce(F.col("title"), F.lit("")) == "",
        "bad_label": F.col("final_label").isNotNull() & ~F.col("final_label").isin(0, 1),
        "bad_severity": F.col("severity").isNotNull() & ~F.col("severity").between(0, 3),
        "bad_confidence": F.col("confidence").isNotNull() & ~F.col("confidence").between(0, 1),
    }
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
