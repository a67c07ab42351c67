"""Queries of agreement, profiles, gates, classifiers and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import scoring
from corpusloom.functions import text as t
from corpusloom.operators import agreement, dedup, gates, ml, profile, sampling
from corpusloom.streaming import ingest as stream

from . import views as v

Q = {}
S = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql is not None:
            S[f.__name__] = sql
        return f

    return add


VT = f"WITH {v.VOTED}"
MG = f"WITH {v.MERGED}"


def _cohen(rows: str, a: str, b: str, by: str = "") -> str:
    """Counts, then kappa and AC1, for each value of ``by``."""
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return f"""cells AS (SELECT {key}count(*) FILTER ({both}) AS n, {", ".join(f"count(*) FILTER ({a} = {i} AND {b} = {j}) AS n{i}{j}" for i in (0, 1) for j in (0, 1))} FROM {rows} {group}),
rates AS (SELECT *, (n10 + n11) / CAST(n AS DOUBLE) AS pa, (n01 + n11) / CAST(n AS DOUBLE) AS pb, (n00 + n11) / CAST(n AS DOUBLE) AS po FROM cells),
chance AS (SELECT *, pa * pb + (1 - pa) * (1 - pb) AS pe, (pa + pb) * (1 - (pa + pb) / 2) AS ce FROM rates),
kappas AS (SELECT {key}n, n00, n01, n10, n11, round(CASE WHEN n < 2 THEN 0 ELSE po END, 6) AS observed, round(CASE WHEN n < 2 THEN 0 ELSE pe END, 6) AS expected,
  round(CASE WHEN n < 2 THEN 0 WHEN pa IN (0, 1) OR pb IN (0, 1) THEN NULL ELSE (po - pe) / (1 - pe) END, 6) AS kappa, round(CASE WHEN n = 0 THEN 0 WHEN ce = 1 THEN 0 ELSE (po - ce) / (1 - ce) END, 6) AS ac1 FROM chance)"""


@query(f"{VT}, {_cohen('voted', 'a_label', 'b_label')} SELECT n, n00, n01, n10, n11, observed, expected, kappa FROM kappas")
def cohen_kappa(spark, d):
    return agreement.cohen(v.voted(spark, d), "a_label", "b_label").drop("ac1")


@query("SELECT page_id, CASE WHEN k >= 0.8 THEN 'Almost Perfect' WHEN k >= 0.6 THEN 'Substantial' WHEN k >= 0.4 THEN 'Moderate' WHEN k >= 0.2 THEN 'Fair' WHEN k >= 0 THEN 'Slight' ELSE 'Poor' END AS words FROM (SELECT page_id, CAST(page_id % 12 AS DOUBLE) / 10 - CAST(0.1 AS DOUBLE) AS k FROM pages)")
def kappa_interpretation(spark, d):
    k = (F.col("page_id") % 12).cast("double") / 10 - F.lit(0.1)
    return v.table(spark, d, "pages").select("page_id", scoring.interpretation(k).alias("words"))


@query(f"{VT}, {_cohen('voted', 'a_label', 'b_label')} SELECT n, ac1 FROM kappas")
def gwet_ac1(spark, d):
    return agreement.cohen(v.voted(spark, d), "a_label", "b_label").select("n", "ac1")


@query(f"""{MG}, r AS (SELECT list_filter([a_label, b_label, CASE WHEN review_status = 'human_reviewed' THEN human_label END], lambda x: x IS NOT NULL) AS rs FROM merged),
i AS (SELECT CAST(len(rs) AS DOUBLE) AS m, CAST(list_sum(rs) AS DOUBLE) AS n1 FROM r WHERE len(rs) >= 2),
s AS (SELECT count(*) AS items, sum(((m - n1) * n1 + n1 * (m - n1)) / (m - 1)) AS d, sum(m) AS t, sum(n1) AS o FROM i)
SELECT items, round(CASE WHEN items = 0 THEN 0 WHEN o = 0 OR o = t THEN CASE WHEN d = 0 THEN 1 ELSE 0 END ELSE 1 - (d / t) / (2 * o * (t - o) / (t * (t - 1))) END, 6) AS alpha FROM s""")
def krippendorff_alpha(spark, d):
    third = F.when(F.col("review_status") == "human_reviewed", F.col("human_label"))
    return agreement.krippendorff(v.merged(spark, d).withColumn("third", third), ["a_label", "b_label", "third"])


@query(f"""{MG}, r AS (SELECT CAST(a_label + b_label + human_label AS DOUBLE) AS n1 FROM merged WHERE review_status = 'human_reviewed' AND a_label + b_label + human_label IS NOT NULL),
s AS (SELECT count(*) AS items, avg((n1 * n1 + (3 - n1) * (3 - n1) - 3) / 6) AS p, sum(n1) / (3 * count(*)) AS q FROM r)
SELECT items, round(CASE WHEN items >= 10 THEN (p - (q * q + (1 - q) * (1 - q))) / (1 - (q * q + (1 - q) * (1 - q))) END, 6) AS kappa FROM s""")
def fleiss_kappa(spark, d):
    return agreement.fleiss(v.merged(spark, d).filter("review_status = 'human_reviewed'"), ["a_label", "b_label", "human_label"])


@query(f"{VT}, {_cohen('voted', 'a_label', 'b_label', 'source')} SELECT source, n, kappa, ac1 FROM kappas")
def kappa_by_source(spark, d):
    return agreement.cohen(v.voted(spark, d), "a_label", "b_label", ["source"]).select("source", "n", "kappa", "ac1")


@query(f"{VT}, {_cohen('voted', 'a_label', 'b_label', 'final_label')} SELECT final_label, n, kappa FROM kappas")
def kappa_by_class(spark, d):
    return agreement.cohen(v.voted(spark, d), "a_label", "b_label", ["final_label"]).select("final_label", "n", "kappa")


_LEVEL = "CASE WHEN confidence < 0 THEN 'unknown' WHEN confidence <= 0.6 THEN 'low' WHEN confidence <= 0.75 THEN 'medium' WHEN confidence <= 0.9 THEN 'high' WHEN confidence <= 1.01 THEN 'very_high' ELSE 'unknown' END"


@query(f"{VT}, lv AS (SELECT *, {_LEVEL} AS level FROM voted), {_cohen('lv', 'a_label', 'b_label', 'level')} SELECT level, n, kappa FROM kappas")
def kappa_by_confidence(spark, d):
    rows = v.voted(spark, d).withColumn("level", scoring.confidence_level(F.col("confidence")))
    return agreement.cohen(rows, "a_label", "b_label", ["level"]).select("level", "n", "kappa")


@query(f"""{MG} SELECT count(*) FILTER (a_label IS NOT NULL AND b_label IS NOT NULL) AS rated, count(*) FILTER (a_label <> b_label) AS disagreements,
round(count(*) FILTER (a_label <> b_label) / CAST(count(*) FILTER (a_label IS NOT NULL AND b_label IS NOT NULL) AS DOUBLE), 6) AS rate, count(*) FILTER (a_label <> b_label AND reviewer_id IS NOT NULL) AS resolved,
count(*) FILTER (a_label <> b_label AND a_label <> final_label AND b_label <> final_label) AS both_wrong FROM merged""")
def disagreements(spark, d):
    return agreement.disagreements(v.merged(spark, d), "a_label", "b_label", "final_label", F.col("reviewer_id").isNotNull())


@query(f"{VT} SELECT id, a_label, b_label FROM voted WHERE a_label <> b_label ORDER BY id LIMIT 20")
def disagreement_samples(spark, d):
    return agreement.disagreement_samples(v.voted(spark, d), "a_label", "b_label").select("id", "a_label", "b_label")


@query(f"{MG}, r AS (SELECT * FROM merged WHERE review_status = 'human_reviewed'), {_cohen('r', 'human_label', 'a_label')} SELECT n, kappa, ac1 FROM kappas")
def human_vs_model(spark, d):
    return agreement.cohen(v.merged(spark, d).filter("review_status = 'human_reviewed'"), "human_label", "a_label").select("n", "kappa", "ac1")


@query()
def kappa_bootstrap(spark, d):
    return agreement.bootstrap(v.voted(spark, d), "a_label", "b_label")


@query("SELECT event_type AS value, count(*) AS n, round(count(*) / CAST((SELECT count(event_type) FROM events) AS DOUBLE), 6) AS share FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def value_counts(spark, d):
    return profile.value_counts(v.table(spark, d, "events"), "event_type")


@query("SELECT toxic AS value, count(*) AS n, round(count(*) / CAST((SELECT count(toxic) FROM labels) AS DOUBLE), 6) AS share FROM labels WHERE toxic IS NOT NULL GROUP BY 1")
def class_balance(spark, d):
    return profile.value_counts(v.table(spark, d, "labels"), "toxic")


@query(f"{VT} SELECT source, count(*) AS n, count(*) FILTER (final_label = 1) AS positive, count(*) FILTER (final_label = 0) AS negative, round(avg(quality_score), 2) AS mean_quality FROM voted WHERE source IS NOT NULL GROUP BY source")
def source_metadata(spark, d):
    return profile.by_source(v.voted(spark, d), "final_label", "quality_score")


@query(f"""{MG} SELECT count(*) AS total, count(*) FILTER (final_label = 1) AS clickbait, count(*) FILTER (final_label = 0) AS non_clickbait, count(*) FILTER (status = 'review') AS review, count(*) FILTER (status = 'accepted') AS accepted,
count(*) FILTER (human_verified) AS human_verified, round(avg(quality_score), 6) AS quality_mean, min(quality_score) AS quality_min, max(quality_score) AS quality_max, round(avg(confidence), 6) AS confidence_mean, min(confidence) AS confidence_min, max(confidence) AS confidence_max FROM merged""")
def dataset_statistics(spark, d):
    return profile.dataset_statistics(v.merged(spark, d))


@query("SELECT count(l_quantity) AS n, round(avg(CAST(l_quantity AS DOUBLE)), 6) AS q_mean, round(stddev_samp(CAST(l_quantity AS DOUBLE)), 6) AS q_std, min(CAST(l_quantity AS DOUBLE)) AS q_min, max(CAST(l_quantity AS DOUBLE)) AS q_max FROM lineitem")
def confidence_stats(spark, d):
    return profile.statistics(v.table(spark, d, "lineitem").withColumn("x", F.col("l_quantity").cast("double")), "x", "q")


@query(f"WITH {v.ARTICLES} SELECT count(*) AS total, min(strftime(published, '%Y-%m-%d')) AS first_crawl, max(strftime(published, '%Y-%m-%d')) AS last_crawl, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM articles")
def dataset_metadata(spark, d):
    return profile.metadata(v.articles(spark, d).withColumn("crawled", F.date_format("published", "yyyy-MM-dd")))


@query(f"{VT} SELECT source, count(*) AS n, round(avg(CAST(coalesce(a_label <> b_label, false) AS INT)), 6) AS rate FROM voted GROUP BY source")
def rate_by_group(spark, d):
    return profile.rate_by(v.voted(spark, d), "source", F.coalesce(F.col("a_label") != F.col("b_label"), F.lit(False)))


@query(f"{VT} SELECT source, count(*) FILTER (status = 'accepted') AS status_accepted, count(*) FILTER (status = 'review') AS status_review FROM voted GROUP BY source")
def crosstab_counts(spark, d):
    return profile.crosstab(v.voted(spark, d), "source", "status", ["accepted", "review"])


@query(f"{VT}, c AS (SELECT source, count(*) FILTER (final_label = 0) AS a, count(*) FILTER (final_label = 1) AS b FROM voted GROUP BY source) SELECT source, round(CASE WHEN a + b > 0 THEN a * 100.0 / (a + b) END, 6) AS final_label_0, round(CASE WHEN a + b > 0 THEN b * 100.0 / (a + b) END, 6) AS final_label_1 FROM c")
def crosstab_pct(spark, d):
    return profile.crosstab_percent(v.voted(spark, d), "source", "final_label", [0, 1])


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (event_type = 'click') AS hits, round(avg(CAST(event_type = 'click' AS INT)) * 100, 6) AS percent FROM events WHERE ts IS NOT NULL GROUP BY 1")
def daily_trend(spark, d):
    return profile.daily_trend(v.table(spark, d, "events"), "ts", F.col("event_type") == "click")


@query(f"WITH {v.RATINGS} SELECT least(CAST(floor(a_confidence / (CAST(1.0 AS DOUBLE) / 30)) AS INT), 29) AS bin, count(*) AS n FROM ratings WHERE a_confidence BETWEEN 0 AND 1 GROUP BY 1")
def histogram(spark, d):
    return profile.histogram(v.ratings(spark, d), "a_confidence", 0.0, 1.0, 30)


@query(f"""{VT}, g AS (SELECT CAST(range AS INT) AS bin FROM range(10)), c AS (SELECT g.bin, count(v.id) AS n, avg(CASE WHEN v.id IS NOT NULL THEN CAST(final_label = CAST(confidence > 0.5 AS INT) AS INT) END) AS a
FROM g LEFT JOIN voted v ON v.final_label IS NOT NULL AND confidence >= g.bin / CAST(10 AS DOUBLE) AND confidence < (g.bin + 1) / CAST(10 AS DOUBLE) GROUP BY g.bin) SELECT bin, n, round(a, 6) AS accuracy FROM c""")
def calibration(spark, d):
    return profile.calibration(v.voted(spark, d), "confidence", "final_label")


@query(f"{VT}, g AS (SELECT CAST(a.range AS INT) AS gold, CAST(b.range AS INT) AS predicted FROM range(2) a, range(2) b) SELECT g.gold, g.predicted, count(v.id) AS n FROM g LEFT JOIN voted v ON v.final_label = g.gold AND v.a_label = g.predicted GROUP BY 1, 2")
def confusion_matrix(spark, d):
    return profile.confusion(v.voted(spark, d), "final_label", "a_label")


@query("SELECT lang, count(n_chars) AS n, round(quantile_cont(n_chars, 0.25), 4) AS q25, round(quantile_cont(n_chars, 0.5), 4) AS q50, round(quantile_cont(n_chars, 0.75), 4) AS q75 FROM documents GROUP BY lang")
def length_quantiles(spark, d):
    return profile.quantiles(v.table(spark, d, "documents"), "lang", "n_chars")


@query(f"""{VT}, m AS (SELECT final_label AS label, avg(CAST(contains(body, '?') AS INT)) * 100 AS asks, avg(CAST(contains(body, '!') AS INT)) * 100 AS shouts, avg(CAST(contains(body, '...') AS INT)) * 100 AS trails FROM voted WHERE final_label IS NOT NULL GROUP BY 1)
SELECT label, unnest(['asks', 'shouts', 'trails']) AS marker, round(unnest([asks, shouts, trails]), 6) AS percent FROM m""")
def marker_rates(spark, d):
    flags = {n: F.contains("body", F.lit(x)) for n, x in (("asks", "?"), ("shouts", "!"), ("trails", "..."))}
    return profile.marker_rates(v.voted(spark, d), "final_label", flags)


@query(f"WITH {v.RATINGS}, u AS (SELECT 'a' AS rater, unnest([1, 2, 3, 4]) AS criterion, unnest(a_scores) AS s FROM ratings UNION ALL SELECT 'b', unnest([1, 2, 3, 4]), unnest(b_scores) FROM ratings) SELECT rater, criterion, round(avg(s), 6) AS mean FROM u GROUP BY 1, 2")
def rubric_means(spark, d):
    return profile.rubric_means(v.ratings(spark, d), {"a": "a_scores", "b": "b_scores"})


@query(f"{VT} SELECT count(*) AS n, round(avg(CAST(final_label = 1 AS INT)) * 100, 6) AS clickbait_percent, round(avg(quality_score), 6) AS mean_quality, round(avg(confidence), 6) AS mean_confidence FROM voted")
def key_metrics(spark, d):
    return profile.key_metrics(v.voted(spark, d))


_SOURCES = [f"src{i}" for i in range(20)]


@query(f"""{VT}, s AS (SELECT count(*) FILTER (c > 0 AND NOT c / CAST(n AS DOUBLE) BETWEEN 0.08 AND 0.2) AS f FROM (SELECT source, count(*) AS c, (SELECT count(source) FROM voted) AS n FROM voted WHERE source IS NOT NULL GROUP BY source)),
l AS (SELECT count(*) FILTER (NOT c / CAST(n AS DOUBLE) BETWEEN 0.45 AND 0.55) AS f FROM (SELECT final_label, count(*) AS c, (SELECT count(final_label) FROM voted) AS n FROM voted WHERE final_label IS NOT NULL GROUP BY 1)),
f AS (SELECT ['url_uniqueness', 'label_validity', 'no_nulls', 'quality', 'source_share', 'class_share', 'confidence_range', 'utf8', 'timestamps', 'preview_length'] AS names, [count(*) - count(DISTINCT url), 0,
count(*) FILTER (final_label IS NOT NULL AND title IS NULL), count(*) FILTER (quality_score < 4), (SELECT f FROM s), (SELECT f FROM l), 0, 0, count(*) FILTER (published IS NULL), count(*) FILTER (length(coalesce(body, '')) < 50)] AS ns FROM voted),
u AS (SELECT unnest(names) AS test, unnest([true, true, true, false, false, false, false, false, false, false]) AS critical, unnest(ns) AS failures FROM f)
SELECT test, critical, failures, failures = 0 AS passed, CASE WHEN failures = 0 THEN 'PASS' WHEN critical THEN 'FAIL (CRITICAL)' ELSE 'WARN' END AS status FROM u""")
def data_tests(spark, d):
    return gates.run_checks(v.voted(spark, d), gates.data_checks(v.voted(spark, d), _SOURCES, "2026-01-01"))


@query("SELECT toxic AS prediction FROM labels GROUP BY toxic ORDER BY count(*) DESC, toxic LIMIT 1")
def majority_baseline(spark, d):
    return ml.majority(v.table(spark, d, "labels"), "toxic")


@query("SELECT toxic, count(*) AS n, round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT toxic) FROM labels) * CAST(count(*) AS DOUBLE)), 6) AS weight FROM labels GROUP BY toxic")
def class_weights(spark, d):
    return ml.class_weights(v.table(spark, d, "labels"), "toxic")


def _report_sql() -> str:
    div = lambda a, b: f"coalesce(({a}) / nullif(CAST({b} AS DOUBLE), 0), 0)"
    parts = []
    for k in (0, 1):
        p, r = div(f"c{k}{k}", f"(c0{k} + c1{k})"), div(f"c{k}{k}", f"(c{k}0 + c{k}1)")
        parts.append(f"{p} AS p{k}, {r} AS r{k}, {div(f'2 * {p} * {r}', f'({p} + {r})')} AS f{k}, c{k}0 + c{k}1 AS s{k}")
    out = ["round((c00 + c11) / CAST(n AS DOUBLE), 6) AS accuracy"]
    for k in (0, 1):
        out.append(f"round(p{k}, 6) AS precision_{k}, round(r{k}, 6) AS recall_{k}, round(f{k}, 6) AS f1_{k}, s{k} AS support_{k}")
    for m, x in (("precision", "p"), ("recall", "r"), ("f1", "f")):
        out.append(f"round(({x}0 + {x}1) / 2, 6) AS macro_{m}, round(({x}0 * s0 + {x}1 * s1) / n, 6) AS weighted_{m}")
    cells = ", ".join(f"count(*) FILTER (toxic = {i} AND 1 - quality = {j}) AS c{i}{j}" for i in (0, 1) for j in (0, 1))
    return f"WITH c AS (SELECT {cells} FROM labels), m AS (SELECT *, c00 + c01 + c10 + c11 AS n, {', '.join(parts)} FROM c) SELECT {', '.join(out)} FROM m"


@query(_report_sql())
def classification_report(spark, d):
    return ml.report(v.table(spark, d, "labels").select(F.col("toxic").alias("label"), (1 - F.col("quality")).alias("prediction")))


def _judged(kind: str, rows):
    """Folds 0 to 3 train with C = 1, fold 4 is judged; ``ml.tune`` chooses C where the time for its fits is there."""
    rows = dedup.checkpointed(rows)
    model = ml.fit(kind, rows.filter("fold < 4"))
    return ml.report(model.transform(rows.filter("fold = 4")).select("label", "prediction")).select("accuracy", "macro_f1", "support_0", "support_1")


def _text_model(spark, d, kind: str):
    docs = v.articles(spark, d).select("id", t.combined(F.col("title"), F.col("lead")).alias("text"))
    labels = v.table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    rows = dedup.checkpointed(sampling.folds(docs.join(labels, "id"), "label"))
    words = ml.vocabulary(rows.filter("fold < 4").select("id", "text"))
    return _judged(kind, ml.text_features(rows.select("id", "text"), words).join(rows.select("id", "label", "fold"), "id"))


@query()
def tfidf_logreg(spark, d):
    return _text_model(spark, d, "logistic")


@query()
def tfidf_svm(spark, d):
    return _text_model(spark, d, "svm")


@query()
def embedding_logreg(spark, d):
    vectors = v.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", (F.col("label") >= 5).cast("int").alias("label"))
    return _judged("logistic", sampling.folds(ml.array_features(vectors, "embedding"), "label"))


@query()
def embedding_svm(spark, d):
    vectors = v.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", (F.col("label") >= 5).cast("int").alias("label"))
    return _judged("svm", sampling.folds(ml.array_features(vectors, "embedding"), "label"))


@query(f"{VT} SELECT CASE WHEN a_label = 1 THEN 'false_positive' ELSE 'false_negative' END AS error, id FROM (SELECT id, a_label, row_number() OVER (PARTITION BY a_label ORDER BY id) AS n FROM voted WHERE a_label <> final_label) WHERE n <= 5")
def error_samples(spark, d):
    rows = v.voted(spark, d).select("id", F.col("final_label").alias("label"), F.col("a_label").alias("prediction"))
    return ml.error_samples(rows).select("error", "id")


@query("SELECT count(DISTINCT regexp_replace(trim(url), '/+$', '')) AS n FROM pages")
def stream_dedup(spark, d):
    pages = stream.dedup_stream(stream.read_stream(spark, f"{d}/pages.parquet").select("url"))
    stream.run_available(pages, "stream_dedup_out").stop()
    return spark.table("stream_dedup_out").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (event_type = 'click') AS hits FROM events GROUP BY 1")
def stream_daily_trend(spark, d):
    events = stream.read_stream(spark, f"{d}/events.parquet").select("ts", "event_type")
    stream.run_available(stream.daily_stream(events, "ts", F.col("event_type") == "click"), "stream_daily_out", "complete").stop()
    return spark.table("stream_daily_out")
