"""Queries against their SQL in DuckDB, on rows that the small tables do not have."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from corpusloom.plans import catalog


def assert_equals_sql(spark, folder, name, **tables):
    con = duckdb.connect()
    for table, rows in tables.items():
        path = f"{folder}/{table}.parquet"
        pq.write_table(pa.Table.from_pylist(rows), path)
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    df = catalog.queries()[name](spark, str(folder))
    found = con.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    wanted = sorted(found.fetchall(), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == wanted
    return wanted


def page(n, title, paragraph="A paragraph that is long enough to be the lead of its page."):
    return {"page_id": n, "url": f"https://x.example/{n}", "html": f"<title>{title}</title><h1>{title}</h1><p>{paragraph}</p>" + "<p>Another paragraph of more than twenty characters.</p>" * 6}


def test_html_title_keeps_an_entity_that_was_cut(spark, tmp_path):
    rows = [page(n, t) for n, t in enumerate(["Title cut at &amp;&amp", "Title cut at &amp;&amp", "Tom &amp; Jerry &quot;now&quot;", "Plain title of a page", "Title &copy cut &ampx"])]
    got = assert_equals_sql(spark, tmp_path, "html_title", pages=rows)
    assert (1, "Title cut at &&amp") in got and (2, 'Tom & Jerry "now"') in got


def test_assemble_record_keeps_mail_addresses_and_cut_entities(spark, tmp_path):
    rows = [page(1, "Title cut at &amp;&amp"), page(2, "Write to us", "Questions go to name.14@mail2.example.com or to 'A &amp; B' next door."), page(3, "Plain title of a page")]
    assert len(assert_equals_sql(spark, tmp_path, "assemble_record", pages=rows)) == 3


def repeated_documents(n=240):
    """Few titles and leads, each in many documents, with near copies, and documents without a lead or a word."""
    long = "common words of a title that many documents share with others"
    titles = [long, long + " here", long + " There!", "another thing altogether in seven words", "--- !", ""]
    leads = ["the lead of the first kind has quite a few words too", "the lead of the first kind has quite some words too", "an unlike one", "?"]
    return [{"doc_id": i, "source": "s", "lang": "en", "text": titles[i % 6] + ("\n" + leads[i % 4] if i % 5 else "")} for i in range(n)]


def nearby_vectors(n=12):
    return [{"vec_id": i, "embedding": [1.0, 0.1 * (i // 3), 0.05 * (i % 3) if i % 4 else -3.0]} for i in range(n)]


def test_lexical_pairs_compare_repeated_titles_once(spark, tmp_path, monkeypatch):
    from corpusloom.operators import dedup

    asked = []
    kept = dedup.products
    monkeypatch.setattr(dedup, "products", lambda pairs, *rest: asked.append(pairs.count()) or kept(pairs, *rest))
    monkeypatch.setattr(dedup, "CHUNK", 7)
    assert len(assert_equals_sql(spark, tmp_path, "lexical_pairs", documents=repeated_documents())) > 5000
    assert len(asked) == 1 and asked[0] <= 6


def test_hybrid_pairs_compare_repeated_articles_once(spark, tmp_path, monkeypatch):
    from corpusloom.operators import dedup

    asked = []
    kept = dedup.products
    monkeypatch.setattr(dedup, "products", lambda pairs, *rest: asked.append(pairs.count()) or kept(pairs, *rest))
    assert len(assert_equals_sql(spark, tmp_path, "hybrid_pairs", documents=repeated_documents(), embeddings=nearby_vectors())) > 500
    assert max(asked) <= 24 * 25


def test_greedy_resolve_on_classes_equals_the_scan_of_all_pairs(spark, tmp_path):
    from corpusloom.operators import dedup
    from corpusloom.plans import curation, views

    for table, rows in (("documents", repeated_documents()), ("embeddings", nearby_vectors())):
        pq.write_table(pa.Table.from_pylist(rows), f"{tmp_path}/{table}.parquet")
    pairs = curation.Q["hybrid_pairs"](spark, str(tmp_path)).collect()
    removed = set()
    for a, b in sorted((r.a, r.b) for r in pairs if r.action == "auto_remove"):
        if a not in removed:
            removed.add(b)
    got = [r.id for r in curation.Q["greedy_resolve"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(set(range(240)) - removed) and removed
    members, classes = dedup.hybrid_classes(*curation._hybrid(spark, str(tmp_path)))
    assert classes.count() < len(pairs) / 10 and views.articles(spark, str(tmp_path)).count() == 240


def test_a_lexical_candidate_is_met_once(spark, monkeypatch):
    from corpusloom.operators import dedup

    asked = []
    kept = dedup.products
    monkeypatch.setattr(dedup, "products", lambda pairs, *rest: asked.append((pairs.count(), pairs.distinct().count())) or kept(pairs, *rest))
    texts = [(i, f"{w} rare words that only near copies of one text share with {i % 2}x") for i, w in enumerate(["aa", "bb", "cc", "dd"] * 3)]
    weights = dedup.tfidf(spark.createDataFrame(texts, "id long, text string"))
    assert dedup.lexical_pairs(weights, 2 / 3).count() == asked[0][0] == asked[0][1] == 30
