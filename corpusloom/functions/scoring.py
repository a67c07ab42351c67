"""Quality checks, votes, tiers and buckets, Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, tokens

# Words that a title of an article does not contain.
TITLE_BLACKLIST = ("home", "search", "results", "loading", "category", "tag", "archive", "page", "index", "trang chủ", "kết quả tìm kiếm", "danh mục", "thẻ")
THRESHOLD = 4


def _given(x: Column) -> Column:
    return strip(F.coalesce(x, F.lit("")))


def quality_checks(title: Column, lead: Column, body: Column) -> dict[str, Column]:
    t, s, b = _given(title), _given(lead), _given(body)
    words = F.slice(tokens(F.lower(F.coalesce(body, F.lit("")))), F.lit(1), F.lit(200))
    return {
        "valid_title": (F.length(t) >= 5) & ~F.lower(t).rlike("|".join(TITLE_BLACKLIST)),
        "valid_sapo": (F.length(s) >= 30) & (F.lower(s) != F.lower(t)),
        "valid_body_preview": F.length(b) >= 200,
        "sufficient_length": F.length(b) >= 500,
        "non_aggregation": F.regexp_count(F.left(F.coalesce(body, F.lit("")), F.lit(1000)), F.lit(r"https?://\S+")) <= 5,
        "low_repetition": F.coalesce(F.try_divide(F.size(F.array_distinct(words)), F.size(words)) >= 0.4, F.lit(False)),
    }


def quality_score(checks: dict[str, Column]) -> Column:
    """Passed checks, but 0 without a valid title and lead."""
    total = F.lit(0)
    for c in checks.values():
        total = total + c.cast("int")
    return F.when(checks["valid_title"] & checks["valid_sapo"], total).otherwise(0)


def length_penalty(a: Column, b: Column) -> Column:
    """0.8 for lengths over 1.5 apart, times 0.9 if just one is a question; 1 if one is empty."""
    ratio = F.try_divide(F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b)))
    asks = F.endswith(F.btrim(a), F.lit("?")) != F.endswith(F.btrim(b), F.lit("?"))
    both = F.when(ratio > 1.5, 0.8).otherwise(1.0) * F.when(asks, 0.9).otherwise(1.0)
    return F.when((F.coalesce(F.length(a), F.lit(0)) == 0) | (F.coalesce(F.length(b), F.lit(0)) == 0), 1.0).otherwise(both)


def total(scores: Column) -> Column:
    return F.aggregate(scores, F.lit(0), lambda a, x: a + x)


def vote(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """final_label, status, confidence, rubric_total, severity from two raters.

    Each rater has label, scores, severity and confidence.  Agreement is decided on the labels
    that the scores imply; halves round to even.
    """
    missing = a["label"].isNull() | b["label"].isNull()
    ta, tb = total(a["scores"]), total(b["scores"])
    rubric = F.bround((ta + tb) / 2).cast("int")
    agree = (ta >= 4) == (tb >= 4)
    mean = (a["confidence"] + b["confidence"]) / 2 + F.when(agree, 0.10).otherwise(-0.10)
    unclear = ~agree | ta.isin(3, 4) | tb.isin(3, 4)
    severity = F.greatest(F.coalesce(a["severity"], F.lit(0)), F.coalesce(b["severity"], F.lit(0)))
    return {
        "final_label": F.when(~missing, (rubric > 3).cast("int")),
        "status": F.when(missing | unclear, "review").otherwise("accepted"),
        "confidence": F.when(missing, 0.5).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean))),
        "rubric_total": F.when(missing, -1).otherwise(rubric),
        "severity": F.when(~missing, severity),
    }


def severity_of(scores: Column) -> Column:
    t = total(scores)
    return F.when((t == 8) | (F.get(scores, 3) == 2), 3).when(t <= 3, 0).when(t <= 5, 1).otherwise(2)


def difficulty(label_a: Column, label_b: Column, conf_a: Column, conf_b: Column, rubric: Column) -> Column:
    easy = (label_a == label_b) & (conf_a >= 0.7) & (conf_b >= 0.7) & (rubric != 4)
    hard = ((conf_a < 0.5) & (conf_b < 0.5)) | (rubric == 4)
    return F.when(label_a.isNull() | label_b.isNull(), "hard").when(easy, "easy").when(hard, "hard").otherwise("medium")


def confidence_level(c: Column) -> Column:
    """Buckets closed on the right: to .60, .75, .90 and 1.01."""
    return F.when(c < 0, "unknown").when(c <= 0.60, "low").when(c <= 0.75, "medium").when(c <= 0.90, "high").when(c <= 1.01, "very_high").otherwise("unknown")


def label_name(label: Column) -> Column:
    return F.when(label == 1, "clickbait").when(label == 0, "non_clickbait")


def effective(*candidates: Column) -> Column:
    """The first that is not null, as a number; if it is none, null."""
    return F.coalesce(*[c.cast("string") for c in candidates]).try_cast("double").try_cast("int")


def interpretation(kappa: Column) -> Column:
    out = F.when(kappa.isNull(), F.lit(None).cast("string"))
    for least, name in ((0.80, "Almost Perfect"), (0.60, "Substantial"), (0.40, "Moderate"), (0.20, "Fair"), (0.0, "Slight")):
        out = out.when(kappa >= least, name)
    return out.otherwise("Poor")
