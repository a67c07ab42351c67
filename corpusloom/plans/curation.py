"""Queries of deduplication, sampling, annotation, review and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import llm_json, scoring
from corpusloom.functions import text as t
from corpusloom.operators import dedup, gates, review, sampling

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


A = f"WITH {v.ARTICLES}"
SQUEEZE = r"regexp_replace(regexp_replace(regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}_]', ' ', 'g'), ' +', ' ', 'g'), '^" + v.SPACE.replace("{", "{{").replace("}", "}}") + "+|" + v.SPACE.replace("{", "{{").replace("}", "}}") + "+$', '', 'g')"
ORDER = "length(coalesce(body, '')) DESC, published DESC NULLS LAST, id"
EXACT = f"""keyed AS (SELECT *, {SQUEEZE.format('title')} AS kt, {SQUEEZE.format('lead')} AS kl FROM {{0}}),
masked AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY {ORDER}) = 1 AND row_number() OVER (PARTITION BY kt, kl ORDER BY {ORDER}) = 1 AS kept FROM keyed)"""


@query(f"{A} SELECT id, md5({SQUEEZE.format('body')}) AS h FROM articles")
def normalize_key(spark, d):
    return v.articles(spark, d).select("id", F.md5(t.dedup_key(F.col("body")).cast("binary")).alias("h"))


@query(f"{A}, {EXACT.replace('{0}', 'articles')} SELECT id, kept FROM masked")
def exact_dedup(spark, d):
    return dedup.exact_masks(v.articles(spark, d)).select("id", "kept")


@query(f"{A}, {EXACT.replace('{0}', 'articles')} SELECT source, count(*) AS removed FROM masked WHERE NOT kept GROUP BY source")
def dedup_removed_by_source(spark, d):
    return dedup.removed_by(v.articles(spark, d))


@query(f"{A}, {v.SCORED}, p AS (SELECT * FROM scored WHERE quality_score >= 4), {EXACT.replace('{0}', 'p')} SELECT source, count(*) AS n, round(avg(quality_score), 2) AS mean_quality FROM masked WHERE kept GROUP BY source")
def surviving_articles(spark, d):
    passed = v.scored(v.articles(spark, d)).filter(F.col("quality_score") >= scoring.THRESHOLD)
    return dedup.exact_masks(passed).filter("kept").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("quality_score"), 2).alias("mean_quality"))


def _tfidf(rows: str, sublinear: bool = False, top: int | None = None) -> str:
    tf = "1 + ln(tf)" if sublinear else "tf"
    limit = f"ORDER BY total DESC, term LIMIT {top}" if top else ""
    return rf"""x AS ({rows}), w AS (SELECT id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') AS ws FROM x),
g AS (SELECT id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term FROM w),
c AS (SELECT id, term, count(*) AS tf FROM g GROUP BY id, term), f AS (SELECT term, count(*) AS df, sum(tf) AS total FROM c GROUP BY term {limit}),
r AS (SELECT c.id, c.term, ({tf}) * (ln((1 + (SELECT count(*) FROM x)) / CAST(1 + f.df AS DOUBLE)) + 1) AS w FROM c JOIN f ON c.term = f.term),
n AS (SELECT id, sqrt(sum(w * w)) AS norm FROM r GROUP BY id), weights AS (SELECT r.id, r.term, r.w / n.norm AS weight FROM r JOIN n ON r.id = n.id)"""


_TITLES = "SELECT id, title AS text FROM articles"


@query(f"{A}, {_tfidf(_TITLES)} SELECT id, count(*) AS terms, round(max(weight), 6) AS top_weight, round(sum(weight), 6) AS total_weight FROM weights GROUP BY id")
def tfidf_weights(spark, d):
    w = dedup.tfidf(v.articles(spark, d).select("id", F.col("title").alias("text")))
    return w.groupBy("id").agg(F.count(F.lit(1)).alias("terms"), F.round(F.max("weight"), 6).alias("top_weight"), F.round(F.sum("weight"), 6).alias("total_weight"))


@query(f"{A}, {_tfidf(_TITLES, True, 10_000)} SELECT term, count(*) AS n, round(sum(weight), 6) AS total_weight FROM weights GROUP BY term")
def tfidf_topk_vocab(spark, d):
    w = dedup.tfidf(v.articles(spark, d).select("id", F.col("title").alias("text")), sublinear=True, top=10_000)
    return w.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("weight"), 6).alias("total_weight"))


@query(f"{A}, {_tfidf(_TITLES)} SELECT a.id AS a, b.id AS b, round(sum(a.weight * b.weight), 6) AS lexical FROM weights a JOIN weights b ON a.term = b.term AND a.id < b.id GROUP BY 1, 2 HAVING sum(a.weight * b.weight) >= 2.0 / 3")
def lexical_pairs(spark, d):
    titles = v.articles(spark, d).select("id", F.col("title").alias("text"))
    return dedup.lexical_pairs_of(titles, 2 / 3).select("a", "b", F.round("lexical", 6).alias("lexical"))


_DOT = "list_sum(list_transform(range(1, len({0}) + 1), lambda i: CAST({0}[i] AS DOUBLE) * CAST({1}[i] AS DOUBLE)))"


@query(f"""WITH u AS (SELECT vec_id AS id, embedding AS e, sqrt({_DOT.format('embedding', 'embedding')}) AS n FROM embeddings)
SELECT x.id AS a, y.id AS b, round({_DOT.format('x.e', 'y.e')} / (x.n * y.n), 6) AS cosine FROM u x JOIN u y ON x.id < y.id WHERE {_DOT.format('x.e', 'y.e')} / (x.n * y.n) >= 0.35""")
def cosine_pairs(spark, d):
    vectors = v.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return dedup.cosine_pairs(vectors, 0.35).select("a", "b", F.round("cosine", 6).alias("cosine"))


_ASKS = "(CASE WHEN {0} % 3 = 0 THEN {1} || '?' ELSE {1} END)"
_PENALTY = "CASE WHEN coalesce(length({0}), 0) = 0 OR coalesce(length({1}), 0) = 0 THEN 1.0 ELSE (CASE WHEN greatest(length({0}), length({1})) / CAST(least(length({0}), length({1})) AS DOUBLE) > 1.5 THEN CAST(0.8 AS DOUBLE) ELSE 1.0 END) * (CASE WHEN ends_with(trim({0}), '?') <> ends_with(trim({1}), '?') THEN CAST(0.9 AS DOUBLE) ELSE 1.0 END) END"


@query(f"{A}, p AS (SELECT id, {_ASKS.format('id', 'title')} AS x, lead AS y FROM articles) SELECT id, round({_PENALTY.format('x', 'y')}, 6) AS penalty FROM p")
def structure_penalty(spark, d):
    asks = F.when(F.col("id") % 3 == 0, F.concat("title", F.lit("?"))).otherwise(F.col("title"))
    return v.articles(spark, d).select("id", F.round(scoring.length_penalty(asks, F.col("lead")), 6).alias("penalty"))


#: A text's vector: of the whole table, the one that the text's hash picks, so equal texts have equal vectors.
_VEC = "CAST('0x' || left(md5(coalesce({0}, '')), 8) AS BIGINT) % (SELECT max(vec_id) + 1 FROM embeddings)"
_HYBRID = f"""{_tfidf(_TITLES)}, vec AS (SELECT vec_id AS id, embedding AS e, sqrt({_DOT.format('embedding', 'embedding')}) AS n FROM embeddings),
tp AS (SELECT a.id AS a, b.id AS b, sum(a.weight * b.weight) AS lex FROM weights a JOIN weights b ON a.term = b.term AND a.id < b.id GROUP BY 1, 2 HAVING sum(a.weight * b.weight) >= 2.0 / 3),
{_tfidf('SELECT id, lead AS text FROM articles').replace('x AS (', 'x2 AS (', 1).replace('FROM x)', 'FROM x2)').replace('w AS (SELECT id, regexp', 'w2 AS (SELECT id, regexp').replace('FROM w)', 'FROM w2)').replace('g AS (', 'g2 AS (').replace('FROM g ', 'FROM g2 ').replace(' c AS (', ' c2 AS (').replace(chr(10) + 'c AS (', chr(10) + 'c2 AS (').replace('f AS (SELECT term', 'f2 AS (SELECT term').replace('FROM c GROUP', 'FROM c2 GROUP').replace('r AS (SELECT c.id', 'r2 AS (SELECT c.id').replace('FROM c JOIN f ON', 'FROM c2 c JOIN f2 f ON').replace('n AS (SELECT id, sqrt', 'n2 AS (SELECT id, sqrt').replace('FROM r GROUP', 'FROM r2 GROUP').replace('weights AS (', 'weights2 AS (').replace('FROM r JOIN n ON', 'FROM r2 r JOIN n2 n ON')},
lp AS (SELECT tp.a, tp.b, sum(p.weight * q.weight) AS llex FROM tp JOIN weights2 p ON p.id = tp.a JOIN weights2 q ON q.id = tp.b AND p.term = q.term GROUP BY 1, 2),
base AS (SELECT tp.a, tp.b, x.title AS ta, y.title AS tb, x.lead AS la, y.lead AS lb, 0.7 * {_DOT.format('u.e', 'z.e')} / (u.n * z.n) + 0.3 * tp.lex AS t0, 0.7 * {_DOT.format('ul.e', 'zl.e')} / (ul.n * zl.n) + 0.3 * coalesce(lp.llex, 0) AS l0
  FROM tp LEFT JOIN lp ON tp.a = lp.a AND tp.b = lp.b JOIN articles x ON x.id = tp.a JOIN articles y ON y.id = tp.b JOIN vec u ON u.id = {_VEC.format('x.title')} JOIN vec z ON z.id = {_VEC.format('y.title')} JOIN vec ul ON ul.id = {_VEC.format('x.lead')} JOIN vec zl ON zl.id = {_VEC.format('y.lead')}),
pen AS (SELECT a, b, t0 * {_PENALTY.format('ta', 'tb')} AS ts, l0 * {_PENALTY.format('la', 'lb')} AS ls, t0 FROM base WHERE t0 >= 0.9),
hp AS (SELECT a, b, 0.6 * ts + 0.4 * ls AS sim FROM pen WHERE NOT (ts >= 0.95 AND ls < 0.75) AND ts >= 0.9 AND ls >= 0.85),
acts AS (SELECT a, b, sim, CASE WHEN sim >= 0.97 THEN 'auto_remove' WHEN sim >= 0.92 THEN 'probable_dup' WHEN sim >= 0.85 THEN 'review_candidate' END AS action FROM hp WHERE sim >= 0.85)"""


def _hybrid(spark, d):
    a = v.articles(spark, d)
    vec = v.table(spark, d, "embeddings")
    many = vec.agg(F.max("vec_id")).first()[0] + 1
    pick = lambda c: F.conv(F.left(F.md5(F.coalesce(c, F.lit("")).cast("binary")), F.lit(8)), 16, 10).cast("long") % many
    keyed = a.select("id", "title", "lead", pick(F.col("title")).alias("title_k"), pick(F.col("lead")).alias("lead_k"))
    return keyed, vec.select(F.col("vec_id").alias("id"), "embedding")


@query(f"{A}, {_HYBRID} SELECT a, b, round(sim, 6) AS similarity, action FROM acts")
def hybrid_pairs(spark, d):
    return dedup.hybrid_pairs(*_hybrid(spark, d)).select("a", "b", F.round("similarity", 6).alias("similarity"), "action")


@query()
def greedy_resolve(spark, d):
    members, pairs = dedup.hybrid_classes(*_hybrid(spark, d))
    return dedup.resolve_classes(v.articles(spark, d), members, dedup.checkpointed(pairs)).select("id")


@query(f"{A} SELECT id, source FROM (SELECT id, source, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id) AS n FROM articles) WHERE n <= 10")
def stratified_sample(spark, d):
    return sampling.per_stratum(v.articles(spark, d), ["source"], 10).select("id", "source")


VT = f"WITH {v.VOTED}"


@query(f"""{VT}, k AS (SELECT CASE WHEN count(*) = 0 THEN 0 ELSE greatest(1, count(*) * 5 // 100) END AS k FROM voted WHERE status = 'accepted'),
c AS (SELECT id, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id) AS n FROM voted WHERE status = 'accepted')
SELECT v.id, coalesce(c.n <= (SELECT k FROM k), false) AS qa_sample, CASE WHEN c.n <= (SELECT k FROM k) THEN 'review' ELSE v.status END AS status FROM voted v LEFT JOIN c ON v.id = c.id""")
def qa_sample(spark, d):
    return sampling.quality_sample(v.voted(spark, d).select("id", "status")).select("id", "qa_sample", "status")


@query(f"{A} SELECT coalesce(date_diff('second', min(published), max(published)) // 86400 > 60, false) AS usable, date_diff('second', min(published), max(published)) // 86400 AS span_days FROM articles")
def date_usability(spark, d):
    return sampling.dates_usable(v.articles(spark, d))


_SPLIT = """p AS (SELECT id, source, final_label, row_number() OVER (PARTITION BY source, final_label ORDER BY {0}) AS n, count(*) OVER (PARTITION BY source, final_label) AS c FROM voted),
parts AS (SELECT id, source, final_label, CASE WHEN n <= {1} THEN '{2}' WHEN n <= {3} THEN '{4}' ELSE '{5}' END AS split FROM p)"""
TEMPORAL = _SPLIT.format("published NULLS LAST, id", "c - 2 * (c * 15 // 100)", "train", "c - c * 15 // 100", "validation", "test")
RANDOM = _SPLIT.format("md5(CAST(id AS VARCHAR) || ':42'), id", "c * 15 // 100", "validation", "2 * (c * 15 // 100)", "test", "train")
STRATA = ["source", "final_label"]


@query(f"{VT}, {TEMPORAL} SELECT id, split FROM parts")
def temporal_split(spark, d):
    return sampling.temporal_split(v.voted(spark, d), STRATA).select("id", "split")


@query(f"{VT}, {RANDOM} SELECT id, split FROM parts")
def random_split(spark, d):
    return sampling.random_split(v.voted(spark, d), STRATA).select("id", "split")


@query("SELECT doc_id AS id, toxic, CAST((row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels")
def kfold(spark, d):
    return sampling.folds(v.table(spark, d, "labels").select(F.col("doc_id").alias("id"), "toxic"), "toxic")


@query("SELECT * FROM (VALUES ('train', 'validation', CAST(0 AS BIGINT)), ('train', 'test', 0), ('validation', 'test', 0)) AS t(left_split, right_split, shared)")
def split_disjoint(spark, d):
    return sampling.overlaps(sampling.temporal_split(v.voted(spark, d), STRATA))


_RATE = "avg(CAST(final_label AS DOUBLE)) FILTER (split = '{0}')"


@query(f"{VT}, {TEMPORAL} SELECT " + ", ".join([f"count(*) FILTER (split = '{s}') AS {s}_size, count(*) FILTER (split = '{s}' AND final_label = 1) AS {s}_positive, round({_RATE.format(s)}, 6) AS {s}_rate" for s in sampling.SPLITS]) + f", round(abs({_RATE.format('train')} - {_RATE.format('test')}), 6) AS drift, abs({_RATE.format('train')} - {_RATE.format('test')}) > 0.05 AS drift_warning FROM parts")
def split_stats(spark, d):
    return sampling.split_stats(sampling.temporal_split(v.voted(spark, d), STRATA))


TEMPLATE = 'Title: "{title}" Lead: "{sapo}"'


@query(f"{A} SELECT id, md5(replace(replace('{TEMPLATE}', '{{title}}', replace(coalesce(title, ''), '\"', '''')), '{{sapo}}', replace(coalesce(lead, ''), '\"', ''''))) AS h FROM articles")
def prompt_build(spark, d):
    return v.articles(spark, d).select("id", F.md5(t.prompt(TEMPLATE, F.col("title"), F.col("lead")).cast("binary")).alias("h"))


_ANSWER = """CASE id % 4 WHEN 0 THEN '<think>{{"x": 1}}</think>ok {{"label": "' || {q} || '", "confidence": 1.5, "rubric_scores": [1, "2", 9, null], "severity": "2", "reason": "a"}} end'
 WHEN 1 THEN '{{"confidence": "0.25", "rubric_scores": [0, 0, 0, 0], "thought_process": {{"label": ' || {q} || ', "rubric_scores": [2, 1, 0, 1], "severity": 7, "reason": "in"}}}}'
 WHEN 2 THEN '{{"label": null, "rubric_scores": [1, 2], "confidence": "x"}}' ELSE 'no answer' END"""


def _answers(spark, d):
    return v.table(spark, d, "labels").select(F.col("doc_id").alias("id"), "quality").select("id", F.expr(_ANSWER.format(q="cast(quality as string)")).alias("answer"))


_ANS = f"WITH ans AS (SELECT id, {_ANSWER.format(q='CAST(quality AS VARCHAR)')} AS answer FROM (SELECT doc_id AS id, quality FROM labels))"


@query(_ANS + r" SELECT id, regexp_extract(regexp_replace(answer, '(?s)<think>.*?</think>', '', 'g'), '(?s)\{.*\}', 0) AS part FROM ans")
def llm_json_extract(spark, d):
    return _answers(spark, d).select("id", llm_json.json_part(F.col("answer")).alias("part"))


@query(_ANS + """, q AS (SELECT a.id, l.quality AS q FROM ans a JOIN labels l ON a.id = l.doc_id)
SELECT id, CASE id % 4 WHEN 0 THEN CAST(q AS INT) WHEN 1 THEN CAST(q AS INT) END AS label, CASE id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.25 ELSE 0.0 END AS confidence,
  CASE id % 4 WHEN 0 THEN '1,2,2,0' WHEN 1 THEN '2,1,0,1' ELSE '0,0,0,0' END AS scores, CASE id % 4 WHEN 0 THEN 2 WHEN 1 THEN 7 ELSE 0 END AS severity,
  CASE id % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'in' WHEN 2 THEN '' ELSE 'Error: no JSON in the answer' END AS reason FROM q""")
def llm_normalize(spark, d):
    r = _answers(spark, d).select("id", llm_json.answer_or_failure(F.col("answer")).alias("r"))
    return r.select("id", "r.label", "r.confidence", F.array_join("r.rubric_scores", ",").alias("scores"), "r.severity", "r.reason")


@query("SELECT doc_id AS id FROM labels WHERE doc_id % 4 < 2")
def retry_cache(spark, d):
    r = _answers(spark, d).select("id", llm_json.answer_or_failure(F.col("answer")).alias("r"))
    return r.filter(llm_json.worth_keeping(F.col("r"))).select("id")


@query(f"{VT} SELECT id, final_label, status, round(confidence, 6) AS confidence, rubric_total, severity FROM voted")
def rubric_vote(spark, d):
    return v.voted(spark, d).select("id", "final_label", "status", F.round("confidence", 6).alias("confidence"), "rubric_total", "severity")


@query(f"WITH {v.RATINGS}, {v.VOTE} SELECT id, CASE WHEN ta = 8 OR a_scores[4] = 2 THEN 3 WHEN ta <= 3 THEN 0 WHEN ta <= 5 THEN 1 ELSE 2 END AS severity FROM sums")
def severity_rule(spark, d):
    return v.ratings(spark, d).select("id", scoring.severity_of(F.col("a_scores")).alias("severity"))


_TIER = "CASE WHEN a_label IS NULL OR b_label IS NULL THEN 'hard' WHEN a_label = b_label AND a_confidence >= 0.7 AND b_confidence >= 0.7 AND rubric_total <> 4 THEN 'easy' WHEN a_confidence < 0.5 AND b_confidence < 0.5 OR rubric_total = 4 THEN 'hard' ELSE 'medium' END"


def _tiers(spark, d):
    tier = scoring.difficulty(*[F.col(c) for c in ("a_label", "b_label", "a_confidence", "b_confidence", "rubric_total")])
    return v.voted(spark, d).withColumn("tier", tier)


@query(f"{VT} SELECT id, {_TIER} AS tier FROM voted")
def difficulty_tier(spark, d):
    return _tiers(spark, d).select("id", "tier")


@query(f"{VT} SELECT id, source, row_number() OVER (PARTITION BY source ORDER BY id) - 1 AS place FROM voted WHERE status = 'review'")
def review_order(spark, d):
    from pyspark.sql import Window

    queue = v.voted(spark, d).filter("status = 'review'")
    return queue.select("id", "source", (F.row_number().over(Window.partitionBy("source").orderBy("id")) - 1).cast("long").alias("place"))


@query(f"{VT}, x AS (SELECT {_TIER} AS value FROM voted) SELECT value, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM x) AS DOUBLE), 6) AS share FROM x GROUP BY value")
def difficulty_distribution(spark, d):
    from corpusloom.operators import profile

    return profile.value_counts(_tiers(spark, d), "tier")


@query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role) AS n FROM conversations) WHERE n = 1")
def last_decision(spark, d):
    return review.last_decisions(v.table(spark, d, "conversations"), "conv_id", [F.col("turn").desc(), F.col("role")]).select("conv_id", "turn", "role")


MG = f"WITH {v.MERGED}"


@query(f"{MG} SELECT id, final_label, rubric_total, severity, status, review_status, human_verified, human_label, reviewer_id FROM merged")
def merge_review(spark, d):
    return v.merged(spark, d).select("id", "final_label", "rubric_total", "severity", "status", "review_status", "human_verified", "human_label", "reviewer_id")


@query(f"{MG} SELECT id, coalesce(human_label, final_label, a_label, b_label) AS label FROM merged")
def effective_label(spark, d):
    return v.merged(spark, d).select("id", scoring.effective(*[F.col(c) for c in ("human_label", "final_label", "a_label", "b_label")]).alias("label"))


@query(f"{MG} SELECT id, CASE WHEN coalesce(title, '') = '' THEN 'missing_title' ELSE '' END AS errors FROM merged")
def validation_errors(spark, d):
    return v.merged(spark, d).select("id", F.array_join(gates.record_errors(), ",").alias("errors"))


@query(f"{MG}, r AS (SELECT m.human_label, s.final_label AS stored FROM merged m JOIN votes s ON m.id = s.id WHERE m.id % 5 = 0 AND m.human_label IS NOT NULL) SELECT count(*) AS reviewed, count(*) FILTER (human_label IS DISTINCT FROM stored) AS mismatched, round(count(*) FILTER (human_label IS DISTINCT FROM stored) * 100.0 / count(*), 2) AS error_percent FROM r")
def qa_error_rate(spark, d):
    stored = v.voted(spark, d).select("id", F.col("final_label").alias("stored_label"))
    return review.sample_errors(v.merged(spark, d).join(stored, "id").withColumn("qa_sample", F.col("id") % 5 == 0))


@query(f"""{MG} SELECT count(*) FILTER (human_label = a_label) AS agree, count(*) FILTER (human_label <> a_label) AS disagree, {", ".join(f"count(*) FILTER (severity = {s}) AS severity_{s}" for s in range(4))},
round(avg(a_confidence) FILTER (human_label = a_label), 6) AS confidence_right, round(avg(a_confidence) FILTER (human_label <> a_label), 6) AS confidence_wrong FROM merged WHERE human_label IS NOT NULL AND a_label IS NOT NULL""")
def review_agreement(spark, d):
    return review.human_agreement(v.merged(spark, d).withColumn("human_severity", F.col("severity")), "a")


@query(f"""{MG}, f AS (SELECT ['titles', 'serializable', 'url_duplicates', 'labels', 'rubric', 'severity', 'confidence', 'human_verified', 'pending', 'reviewer'] AS names,
[count(*) FILTER (coalesce(title, '') = ''), 0, count(url) - count(DISTINCT url), 0, 0, count(*) FILTER (severity IS NULL), 0, 0, count(*) FILTER (review_status = 'pending'), 0] AS ns FROM merged),
u AS (SELECT unnest(names) AS test, unnest(ns) AS failures FROM f) SELECT test, true AS critical, failures, failures = 0 AS passed, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL (CRITICAL)' END AS status FROM u""")
def quality_gate(spark, d):
    return gates.run_checks(v.merged(spark, d), gates.merged_checks())


@query(f"{A} SELECT id, CAST(year(published) AS INT) AS y, CAST(month(published) AS INT) AS m, CAST(isodow(published) - 1 AS INT) AS dow FROM articles")
def date_parts(spark, d):
    return v.articles(spark, d).select("id", F.year("published").alias("y"), F.month("published").alias("m"), F.weekday("published").alias("dow"))


@query(f"WITH {v.RATINGS} SELECT id, CASE WHEN c < 0 THEN 'unknown' WHEN c <= 0.6 THEN 'low' WHEN c <= 0.75 THEN 'medium' WHEN c <= 0.9 THEN 'high' WHEN c <= 1.01 THEN 'very_high' ELSE 'unknown' END AS bucket FROM (SELECT id, a_confidence AS c FROM ratings)")
def confidence_bucket(spark, d):
    return v.ratings(spark, d).select("id", scoring.confidence_level(F.col("a_confidence")).alias("bucket"))


@query(f"{A} SELECT id, length(title) AS title_len, length(lead) AS lead_len, length(body) AS body_len, len(list_filter(regexp_split_to_array(title, '{v.SPACE}+'), lambda w: w <> '')) AS title_words, len(list_filter(regexp_split_to_array(body, '{v.SPACE}+'), lambda w: w <> '')) AS body_words FROM articles")
def text_stats(spark, d):
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(t.tokens(F.col(c)))).cast("long")
    return v.articles(spark, d).select("id", *[F.length(c).cast("long").alias(f"{c}_len") for c in ("title", "lead", "body")], size("title").alias("title_words"), size("body").alias("body_words"))


@query(f"{A} SELECT id, contains(body, '?') AS asks, contains(body, '!') AS shouts, contains(body, '...') AS trails FROM articles")
def punctuation_flags(spark, d):
    return v.articles(spark, d).select("id", *[F.contains("body", F.lit(x)).alias(n) for n, x in (("asks", "?"), ("shouts", "!"), ("trails", "..."))])


@query(f"{A} SELECT id, CAST(len(regexp_extract_all(lower('SỐC bí mật sốc ' || title || ' ' || body), '{'|'.join(t.SENSATIONAL)}')) AS INT) AS n FROM articles")
def keyword_count(spark, d):
    title = F.lower(F.concat(F.lit("SỐC bí mật sốc "), "title", F.lit(" "), "body"))
    return v.articles(spark, d).select("id", F.regexp_count(title, F.lit("|".join(t.SENSATIONAL))).alias("n"))


@query(f"WITH {v.RATINGS} SELECT id, CAST(list_sum(a_scores) AS INT) AS total, a_scores[1] AS c1, a_scores[4] AS c4, CAST(NULL AS INT) AS c5 FROM ratings")
def rubric_features(spark, d):
    s = F.from_json(F.to_json("a_scores"), "array<int>")
    return v.ratings(spark, d).select("id", scoring.total(s).alias("total"), *[F.get(s, i).alias(f"c{i + 1}") for i in (0, 3, 4)])


@query(f"WITH {v.RATINGS} SELECT id, coalesce(a_label = b_label, false) AS agree, a_severity - b_severity AS delta FROM ratings")
def agreement_flags(spark, d):
    return v.ratings(spark, d).select("id", F.coalesce(F.col("a_label") == F.col("b_label"), F.lit(False)).alias("agree"), (F.col("a_severity") - F.col("b_severity")).alias("delta"))


@query("SELECT n_name, coalesce(CASE WHEN r_regionkey < 3 THEN r_name END, 'other') AS category FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def category_lookup(spark, d):
    known = v.table(spark, d, "region").filter("r_regionkey < 3")
    return v.table(spark, d, "nation").join(F.broadcast(known), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_name", F.coalesce("r_name", F.lit("other")).alias("category"))


@query(f"WITH {v.RATINGS} SELECT id, CASE WHEN a_label = 1 THEN 'clickbait' WHEN a_label = 0 THEN 'non_clickbait' END AS name FROM ratings")
def label_names(spark, d):
    return v.ratings(spark, d).select("id", scoring.label_name(F.col("a_label")).alias("name"))
