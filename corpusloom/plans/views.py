"""The driver's tables as articles, ratings, decisions and events.

The same derivations are given for Spark and, as common table expressions, for the comparison
SQL; they only shape test inputs and hold no logic of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.scoring import quality_checks, quality_score
from corpusloom.functions.text import truncate
from corpusloom.operators import review

DAY0 = "2024-01-01 00:00:00"
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS id", "source", "lang", r"get(split(text, '\n', -1), 0) AS title", r"get(split(text, '\n', -1), 1) AS lead", "text AS body",
        "concat('https://', source, '.example.com/', lang, '/', doc_id % 700, '.html') AS url",
        f"CASE WHEN doc_id % 23 <> 0 THEN timestamp_ntz'{DAY0}' + make_dt_interval(CAST(doc_id * 7919 % 90 AS INT)) END AS published",
    )


ARTICLES = f"""articles AS (SELECT doc_id AS id, source, lang, string_split(text, chr(10))[1] AS title, string_split(text, chr(10))[2] AS lead, text AS body,
  'https://' || source || '.example.com/' || lang || '/' || CAST(doc_id % 700 AS VARCHAR) || '.html' AS url,
  CASE WHEN doc_id % 23 <> 0 THEN TIMESTAMP '{DAY0}' + to_days(CAST(doc_id * 7919 % 90 AS INTEGER)) END AS published FROM documents)"""


def _ratings(div: str, array: str, integer: str) -> list[str]:
    d = lambda a, b: f"({a} {div} {b})"
    last = f"({d('doc_id', 27)} + toxic) % 3"
    lists = {
        "a": [f"doc_id % 3", f"{d('doc_id', 3)} % 3", f"{d('doc_id', 9)} % 3", last],
        "b": [f"(doc_id + {d('doc_id % 5', 4)}) % 3", f"{d('doc_id', 3)} % 3", f"({d('doc_id', 9)} + {d('doc_id % 7', 6)}) % 3", last],
    }
    scores = {k: array.format(", ".join(f"CAST({x} AS {integer})" for x in v)) for k, v in lists.items()}
    return [
        "doc_id AS id", "quality", "toxic",
        f"CASE WHEN doc_id % 17 <> 0 THEN CAST(toxic AS {integer}) END AS a_label", f"{scores['a']} AS a_scores", f"CAST(doc_id % 4 AS {integer}) AS a_severity", "CAST(doc_id * 7 % 101 AS DOUBLE) / 100 AS a_confidence",
        f"CASE WHEN doc_id % 19 <> 0 THEN CAST(1 - quality AS {integer}) END AS b_label", f"{scores['b']} AS b_scores", f"CAST({d('doc_id', 4)} % 4 AS {integer}) AS b_severity", "CAST(doc_id * 13 % 101 AS DOUBLE) / 100 AS b_confidence",
    ]


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").selectExpr(*_ratings("div", "array({})", "int"))


RATINGS = f"ratings AS (SELECT {', '.join(_ratings('//', '[{}]', 'INTEGER'))} FROM labels)"


def rater(df: DataFrame, name: str) -> DataFrame:
    return df.select("id", *[F.col(f"{name}_{c}").alias(c) for c in ("label", "scores", "severity", "confidence")])


def scored(df: DataFrame) -> DataFrame:
    checks = quality_checks(F.col("title"), F.col("lead"), F.col("body"))
    return df.withColumns(checks | {"quality_score": quality_score(checks)})


def voted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled articles with both raters' results, the vote and the quality score."""
    raw = ratings(spark, sf_dir)
    records = articles(spark, sf_dir).join(raw.select("id", "quality", "toxic"), "id")
    named = scored(records).withColumn("preview", truncate(F.col("body")))
    return review.annotate(named, rater(raw, "a"), rater(raw, "b"))


_BLACK = "home|search|results|loading|category|tag|archive|page|index|trang chủ|kết quả tìm kiếm|danh mục|thẻ"


def _stripped(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{SPACE}+|{SPACE}+$', '', 'g')"


SCORED = f"""words AS (SELECT id, list_filter(regexp_split_to_array(lower(coalesce(body, '')), '{SPACE}+'), lambda w: w <> '')[1:200] AS ws FROM articles),
checks AS (SELECT a.*, length({_stripped('title')}) >= 5 AND NOT regexp_matches(lower({_stripped('title')}), '{_BLACK}') AS valid_title,
  length({_stripped('lead')}) >= 30 AND lower({_stripped('lead')}) <> lower({_stripped('title')}) AS valid_sapo,
  length({_stripped('body')}) >= 200 AS valid_body_preview, length({_stripped('body')}) >= 500 AS sufficient_length,
  len(regexp_extract_all(coalesce(body, '')[1:1000], 'https?://\\S+')) <= 5 AS non_aggregation,
  coalesce(len(ws) > 0 AND len(list_distinct(ws)) / CAST(len(ws) AS DOUBLE) >= 0.4, false) AS low_repetition
  FROM articles a JOIN words w ON a.id = w.id),
scored AS (SELECT *, CASE WHEN valid_title AND valid_sapo THEN CAST(valid_title AS INT) + CAST(valid_sapo AS INT) + CAST(valid_body_preview AS INT) + CAST(sufficient_length AS INT)
  + CAST(non_aggregation AS INT) + CAST(low_repetition AS INT) ELSE 0 END AS quality_score FROM checks)"""

VOTE = """sums AS (SELECT *, CAST(list_sum(a_scores) AS INT) AS ta, CAST(list_sum(b_scores) AS INT) AS tb, a_label IS NULL OR b_label IS NULL AS miss FROM ratings),
votes AS (SELECT *, CASE WHEN miss THEN -1 ELSE CAST(round_even((ta + tb) / 2.0, 0) AS INT) END AS rubric_total,
  CASE WHEN miss THEN NULL WHEN round_even((ta + tb) / 2.0, 0) > 3 THEN 1 ELSE 0 END AS final_label,
  CASE WHEN miss OR (ta >= 4) <> (tb >= 4) OR ta IN (3, 4) OR tb IN (3, 4) THEN 'review' ELSE 'accepted' END AS status,
  CASE WHEN miss THEN 0.5 ELSE greatest(0.0, least(1.0, (a_confidence + b_confidence) / 2 + CASE WHEN (ta >= 4) = (tb >= 4) THEN 0.1 ELSE -0.1 END)) END AS confidence,
  CASE WHEN miss THEN NULL ELSE greatest(a_severity, b_severity) END AS severity FROM sums)"""

VOTED = f"{ARTICLES}, {RATINGS}, {SCORED}, {VOTE}, voted AS (SELECT s.*, v.* EXCLUDE (id) FROM scored s JOIN votes v ON s.id = v.id)"


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two decisions for each rated record whose id three does not divide; the second counts."""
    return ratings(spark, sf_dir).filter("id % 3 <> 0").selectExpr(
        "id AS record_id", "explode(sequence(1, 2)) AS seq", "concat('r', id % 3) AS reviewer_id", "CAST((id + seq) % 2 AS INT) AS human_label", "a_scores AS human_scores", "CAST((id + seq) % 4 AS INT) AS human_severity"
    )


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = voted(spark, sf_dir)
    last = review.last_decisions(decisions(spark, sf_dir), "record_id", [F.col("seq").desc()]).drop("seq")
    return review.merge(rows.filter("status = 'accepted'"), rows.filter("status = 'review'"), last)


MERGED = f"""{VOTED}, decided AS (SELECT id AS record_id, 'r' || CAST(id % 3 AS VARCHAR) AS reviewer_id, CAST((id + 2) % 2 AS INT) AS human_label, ta AS human_total, CAST((id + 2) % 4 AS INT) AS human_severity FROM votes WHERE id % 3 <> 0),
merged AS (SELECT v.* EXCLUDE (final_label, rubric_total, severity), final_label, rubric_total, severity, 'auto_accepted' AS review_status, false AS human_verified, NULL AS human_label, NULL AS reviewer_id FROM voted v WHERE status = 'accepted'
  UNION ALL SELECT v.* EXCLUDE (final_label, rubric_total, severity), CASE WHEN record_id IS NOT NULL THEN d.human_label ELSE final_label END, CASE WHEN record_id IS NOT NULL THEN human_total ELSE rubric_total END,
  CASE WHEN record_id IS NOT NULL THEN human_severity ELSE severity END, CASE WHEN record_id IS NOT NULL THEN 'human_reviewed' ELSE 'pending' END, record_id IS NOT NULL, d.human_label, d.reviewer_id
  FROM voted v LEFT JOIN decided d ON v.id = d.record_id WHERE status = 'review' AND coalesce(title, '') <> '')"""
