"""Joining raters' results and human decisions, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.scoring import total, vote


def annotate(records: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """records with both raters' results (id, label, scores, severity, confidence) and the vote.

    A missing result is a null label, which sends the record to review.
    """
    named = lambda df, p: df.select("id", *[F.col(c).alias(f"{p}_{c}") for c in ("label", "scores", "severity", "confidence")])
    joined = records.join(named(a, "a"), "id", "left").join(named(b, "b"), "id", "left")
    side = lambda p: {c: F.col(f"{p}_{c}") for c in ("label", "scores", "severity", "confidence")}
    return joined.withColumns(vote(side("a"), side("b")))


def last_decisions(decisions: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One decision for each record: the last by a total order."""
    newest = Window.partitionBy(key).orderBy(*order)
    return decisions.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def merge(accepted: DataFrame, queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """Accepted rows, then the queue with human decisions; undecided rows are pending.

    decisions: record_id, reviewer_id, human_label, human_scores, human_severity; one row a record.
    Confidence and status stay as they were.
    """
    auto = accepted.withColumns({"review_status": F.lit("auto_accepted"), "human_verified": F.lit(False), "human_label": F.lit(None).cast("int"), "reviewer_id": F.lit(None).cast("string")})
    joined = queue.filter(F.coalesce("title", F.lit("")) != "").join(decisions, F.col("id") == F.col("record_id"), "left")
    hit = F.col("record_id").isNotNull()
    done = joined.withColumns({
        "review_status": F.when(hit, "human_reviewed").otherwise("pending"),
        "human_verified": hit,
        "final_label": F.when(hit, F.col("human_label")).otherwise(F.col("final_label")),
        "rubric_total": F.when(hit, total(F.col("human_scores"))).otherwise(F.col("rubric_total")),
        "severity": F.when(hit, F.col("human_severity")).otherwise(F.col("severity")),
    })
    return auto.unionByName(done.drop("record_id", "human_scores", "human_severity"), allowMissingColumns=True)


def sample_errors(reviewed: DataFrame) -> DataFrame:
    """Of the reviewed quality sample: how many labels differ from the stored one; null counts as different."""
    apart = ~F.col("human_label").eqNullSafe(F.col("stored_label"))
    rows = reviewed.filter("qa_sample and human_label is not null")
    return rows.agg(F.count(F.lit(1)).alias("reviewed"), F.count_if(apart).alias("mismatched"), F.round(F.coalesce(F.try_divide(F.count_if(apart) * 100.0, F.count(F.lit(1))), F.lit(0.0)), 2).alias("error_percent"))


def human_agreement(reviewed: DataFrame, model: str) -> DataFrame:
    """Human labels against a model's: agreement, severities, and mean confidence when right and wrong."""
    same = F.col("human_label") == F.col(f"{model}_label")
    return reviewed.filter(F.col("human_label").isNotNull() & F.col(f"{model}_label").isNotNull()).agg(
        F.count_if(same).alias("agree"),
        F.count_if(~same).alias("disagree"),
        *[F.count_if(F.col("human_severity") == s).alias(f"severity_{s}") for s in range(4)],
        F.round(F.avg(F.when(same, F.col(f"{model}_confidence"))), 6).alias("confidence_right"),
        F.round(F.avg(F.when(~same, F.col(f"{model}_confidence"))), 6).alias("confidence_wrong"),
    )


def not_done(records: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    return records.join(done.select(key).distinct(), key, "left_anti")


def newer_than(entries: DataFrame, modified: str, last_check: Column) -> DataFrame:
    """Entries changed after the last check; without either time they stay."""
    return entries.filter(~F.coalesce(F.col(modified) <= last_check, F.lit(False)))
