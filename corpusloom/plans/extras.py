"""Queries of the smaller operators: keys, contracts, gates and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.operators import agreement, gates, review
from corpusloom.sources import registry, sinks

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
VT = f"WITH {v.VOTED}"


@query(f"{A} SELECT id, md5(trim(coalesce(title, '') || ' ' || coalesce(lead, ''))) AS h FROM articles")
def text_combined(spark, d):
    return v.articles(spark, d).select("id", F.md5(t.combined(F.col("title"), F.col("lead")).cast("binary")).alias("h"))


@query(f"{A} SELECT md5(CAST(count(*) AS VARCHAR) || coalesce(min_by(title, id), '') || coalesce(max_by(title, id), '')) AS h FROM articles")
def texts_hash(spark, d):
    return v.articles(spark, d).select("id", F.col("title").alias("text")).agg(t.texts_hash("id", "text").alias("h"))


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN '2024-03-04 05:06:07' WHEN 1 THEN '2024-03-04 00:00:00' WHEN 2 THEN '2024-03-04 03:06:07' END AS ts FROM pages""")
def w3c_dates(spark, d):
    raw = F.expr("CASE page_id % 4 WHEN 0 THEN '2024-03-04T05:06:07Z' WHEN 1 THEN '2024-03-04' WHEN 2 THEN '2024-03-04T05:06:07+02:00' ELSE 'soon' END")
    utc = F.to_utc_timestamp(t.timestamp_of(raw), F.current_timezone())
    return v.table(spark, d, "pages").select("page_id", F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("SELECT 'id,source,url,title,final_label,lang' AS columns")
def column_order(spark, d):
    rows = v.articles(spark, d).withColumn("final_label", F.lit(1)).select("lang", "final_label", "title", "url", "source", "id")
    return spark.createDataFrame([(",".join(sinks.ordered(rows).columns),)], "columns string")


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events")
def value_clean(spark, d):
    events = v.table(spark, d, "events")
    odd = F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return sinks.finite(events.select("event_id", odd.alias("value")))


@query(f"{A}, l AS (SELECT source, lang, count(*) AS n FROM articles GROUP BY 1, 2) SELECT source, lang, n FROM l ORDER BY n DESC NULLS LAST, source, lang LIMIT 20")
def top_sources(spark, d):
    counts = v.articles(spark, d).groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc_nulls_last(), "source", "lang").limit(20)


@query("SELECT count(*) FILTER (url NOT IN (SELECT url FROM pages WHERE page_id % 2 = 0)) AS fresh FROM (SELECT DISTINCT url FROM pages)")
def url_difference(spark, d):
    urls = v.table(spark, d, "pages").select("page_id", "url")
    seen = urls.filter("page_id % 2 = 0").select("url")
    return review.not_done(urls.select("url").distinct(), seen, "url").agg(F.count(F.lit(1)).alias("fresh"))


@query(f"{VT} SELECT id FROM voted WHERE NOT (status = 'review' AND final_label IS NULL)")
def pending_exclusion(spark, d):
    return v.voted(spark, d).filter(~gates.pending(v.voted(spark, d))).select("id")


@query(f"{A} SELECT id FROM articles WHERE coalesce(CASE WHEN id % 7 <> 0 THEN title END, '') <> ''")
def title_skip(spark, d):
    rows = v.articles(spark, d).withColumn("title", F.when(F.col("id") % 7 != 0, F.col("title")))
    return rows.filter(F.coalesce("title", F.lit("")) != "").select("id")


@query(f"{VT}, c AS (SELECT count(*) FILTER (a_label = 1 AND b_label = 1) AS n11, count(*) FILTER (a_label = 0 AND b_label = 0) AS n00, count(*) FILTER (a_label = 1 AND b_label = 0) AS n10, count(*) FILTER (a_label = 0 AND b_label = 1) AS n01 FROM voted), "
       "p AS (SELECT (n11 + n00) / CAST(n11 + n00 + n10 + n01 AS DOUBLE) AS po, (n10 + n11) / CAST(n11 + n00 + n10 + n01 AS DOUBLE) AS pa, (n01 + n11) / CAST(n11 + n00 + n10 + n01 AS DOUBLE) AS pb FROM c) "
       "SELECT (po - (pa * pb + (1 - pa) * (1 - pb))) / (1 - (pa * pb + (1 - pa) * (1 - pb))) >= 0.6 AS passed FROM p")
def kappa_gate(spark, d):
    return agreement.cohen(v.voted(spark, d), "a_label", "b_label").select(agreement.gate(F.col("kappa")).alias("passed"))


@query("SELECT range AS i, round(exp(-0.5 * pow((0.5 - 4 * ((0.6 - 0.4) / 3.92) + range * (8 * ((0.6 - 0.4) / 3.92) / 199) - 0.5) / ((0.6 - 0.4) / 3.92), 2)), 6) AS y FROM range(200)")
def bootstrap_density(spark, d):
    return spark.range(1).select(F.posexplode(agreement.density(0.4, 0.6, 0.5)).alias("i", "p")).select(F.col("i").cast("long").alias("i"), F.round("p.y", 6).alias("y"))


@query("SELECT vec_id AS id, vec_id % 2 = 0 AS hit FROM embeddings")
def embedding_cache(spark, d):
    rows = v.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"))
    cache = rows.filter("id % 2 = 0").withColumn("hit", F.lit(True))
    return rows.join(cache, "id", "left").select("id", F.coalesce("hit", F.lit(False)).alias("hit"))


@query(f"{A} SELECT id, CASE id % 4 WHEN 0 THEN 'formal_news' WHEN 1 THEN 'entertainment' WHEN 2 THEN 'entertainment' ELSE 'unknown' END AS crawl, CASE id % 4 WHEN 0 THEN 'mainstream' WHEN 1 THEN 'entertainment' WHEN 2 THEN 'mainstream' ELSE 'other' END AS feature FROM articles")
def source_categories(spark, d):
    name = F.expr("CASE id % 4 WHEN 0 THEN 'tuoitre' WHEN 1 THEN 'kenh14' WHEN 2 THEN 'soha' ELSE 'elsewhere' END")
    return v.articles(spark, d).select("id", registry.crawl_category(name).alias("crawl"), registry.feature_category(name).alias("feature"))
