"""Operators on fixtures with known outcomes."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import agreement, dedup, gates, ml, profile, review, sampling
from corpusloom.sources import feeds, files, models, sinks

RATED = "item int, a int, b int"


def grid(spark, n11, n10, n01, n00):
    cells = [(1, 1, n11), (1, 0, n10), (0, 1, n01), (0, 0, n00)]
    df = spark.createDataFrame(cells, "a int, b int, n int").filter("n > 0")
    return df.select("a", "b", F.explode(F.sequence(F.lit(1), "n")).alias("item"))


def test_published_agreement(spark):
    r = agreement.cohen(grid(spark, 530, 16, 3916, 1533), "a", "b").first()
    assert r.n == 5995
    assert (round(r.kappa, 4), round(r.observed, 4), round(r.expected, 4), round(r.ac1, 3)) == (0.0598, 0.3441, 0.3024, -0.276)
    b = agreement.bootstrap(grid(spark, 530, 16, 3916, 1533), "a", "b", rounds=200).first()
    assert b.low < b.kappa < b.high and b.high - b.low < 0.02


@pytest.mark.parametrize("cells,ac1", [((5, 0, 0, 5), 1.0), ((0, 0, 10, 0), -1.0), ((5, 0, 1, 4), None)])
def test_ac1(spark, cells, ac1):
    got = agreement.cohen(grid(spark, *cells), "a", "b").first().ac1
    assert got == ac1 if ac1 is not None else got > 0.75


def test_degenerate_and_small(spark):
    assert agreement.cohen(grid(spark, 5, 0, 5, 0), "a", "b").first().kappa is None
    assert agreement.cohen(grid(spark, 1, 0, 0, 0), "a", "b").first().kappa == 0.0


def test_alpha(spark):
    same = spark.createDataFrame([(1, 1), (0, 0), (1, 1), (0, 0)], "a int, b int")
    assert agreement.krippendorff(same, ["a", "b"]).first().alpha == 1.0
    holes = spark.createDataFrame([(1, None, 1), (0, 0, None), (1, 0, 1), (None, None, 1), (0, 1, 0)], "a int, b int, c int")
    assert -1 <= agreement.krippendorff(holes, ["a", "b", "c"]).first().alpha <= 1


def test_split_sizes_of_the_published_corpus(spark):
    strata = [(534, 466), (502, 498), (2, 998), (356, 644), (49, 951), (45, 955)]
    rows = [(s, y, n) for s, (p, q) in enumerate(strata) for y, n in ((1, p), (0, q))]
    df = spark.createDataFrame(rows, "source int, final_label int, n int").select("source", "final_label", F.explode(F.sequence(F.lit(1), "n")).alias("k"))
    df = df.select("source", "final_label", (F.col("source") * 10_000 + F.col("final_label") * 5_000 + F.col("k")).alias("id"), F.timestamp_seconds(F.col("k").cast("long") * 86400).alias("published"))
    out = sampling.temporal_split(df, ["source", "final_label"])
    r = sampling.split_stats(out).first()
    assert (r.train_size, r.validation_size, r.test_size, r.validation_positive, r.test_positive) == (4212, 894, 894, 221, 221)
    assert not r.drift_warning and all(x.shared == 0 for x in sampling.overlaps(out).collect())


def test_undated_rows_are_tested_and_small_strata_train(spark):
    rows = [(i, "s", 1, None if i == 0 else f"2024-01-{i:02d}") for i in range(10)] + [(100 + i, None, 0, "2024-02-01") for i in range(6)]
    df = spark.createDataFrame(rows, "id int, source string, final_label int, d string").withColumn("published", F.col("d").cast("timestamp"))
    got = {r.id: r.split for r in sampling.temporal_split(df, ["source", "final_label"]).collect()}
    assert got[0] == "test" and {got[100 + i] for i in range(6)} == {"train"} and len(got) == 16


def test_quality_sample_size(spark):
    df = spark.range(2138).withColumn("status", F.lit("accepted"))
    assert sampling.quality_sample(df).filter("qa_sample").count() == 106
    assert sampling.quality_sample(df.withColumn("status", F.lit("review"))).filter("qa_sample").count() == 0


def test_majority_report(spark):
    df = spark.range(894).select((F.col("id") < 221).cast("int").alias("label"), F.lit(0).alias("prediction"))
    r = ml.report(df).first()
    assert (round(r.accuracy, 6), round(r.macro_f1, 6), r.f1_1) == (0.752796, 0.429483, 0.0)


def test_exact_masks_are_independent(spark):
    rows = [(1, "u", "T one", "l", "x" * 9), (2, "u", "T two", "l", "x" * 5), (3, "v", "t TWO!", "L", "x"), (4, None, "a", "a", "y"), (5, None, "b", "b", "y")]
    df = spark.createDataFrame(rows, "id int, url string, title string, lead string, body string").withColumn("published", F.lit(None).cast("timestamp"))
    assert sorted(r.id for r in dedup.exact_masks(df).filter("kept").collect()) == [1, 4]


def test_greedy_equals_the_sequential_scan(spark):
    draw = random.Random(20)
    edges, n = set(), 40
    while len(edges) < 60:
        i, j = draw.randrange(n), draw.randrange(n)
        if i < j:
            edges.add((i, j))
    remover = {}
    for i in range(n):
        if i not in remover:
            for a, b in sorted(edges):
                if a == i and b not in remover:
                    remover[b] = i
    got = {r.node: r.remover for r in dedup.greedy_removed(spark.createDataFrame(sorted(edges), "i int, j int")).collect()}
    assert got == remover
    chain = dedup.greedy_removed(spark.createDataFrame([(1, 2), (2, 3)], "i int, j int")).collect()
    assert [(r.node, r.remover) for r in chain] == [(2, 1)]


def test_lexical_pairs_lose_nothing(spark):
    draw = random.Random(21)
    texts = [" ".join(draw.choice(["aa", "bb", "cc", "dd", "ee", "ff"]) for _ in range(4)) for _ in range(60)]
    weights = dedup.tfidf(spark.createDataFrame(list(enumerate(texts)), "id int, text string"))
    vectors = {}
    for r in weights.collect():
        vectors.setdefault(r.id, {})[r.term] = r.weight
    wanted = {(a, b) for a in vectors for b in vectors if a < b and sum(w * vectors[b].get(k, 0) for k, w in vectors[a].items()) >= 2 / 3 + 1e-9}
    assert wanted <= {(r.a, r.b) for r in dedup.lexical_pairs(weights, 2 / 3).collect()}


def test_last_decision_wins_and_undecided_stay_pending(spark):
    schema = "id string, title string, final_label int, rubric_total int, severity int, status string, confidence double"
    accepted = spark.createDataFrame([("a", "t", 1, 6, 1, "accepted", 0.9)], schema)
    queue = spark.createDataFrame([("b", "t", 0, 3, 0, "review", 0.5), ("c", "t", None, -1, None, "review", 0.5), ("d", None, 0, 1, 0, "review", 0.5)], schema)
    decided = spark.createDataFrame([("b", 1, "r", 0, [0, 0, 0, 1], 0), ("b", 2, "r", 1, [2, 2, 1, 0], 2)], "record_id string, seq int, reviewer_id string, human_label int, human_scores array<int>, human_severity int")
    last = review.last_decisions(decided, "record_id", [F.col("seq").desc()]).drop("seq")
    got = {r.id: r for r in review.merge(accepted, queue, last).collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["b"].final_label, got["b"].rubric_total, got["b"].severity, got["b"].review_status, got["b"].confidence) == (1, 5, 2, "human_reviewed", 0.5)
    assert got["c"].review_status == "pending" and got["a"].review_status == "auto_accepted"


def test_gate_needs_a_severity_but_the_record_check_does_not(spark):
    df = spark.createDataFrame([("a", "t", "u", 1, None, 0.5, 3, "auto_accepted", False, None)], "id string, title string, url string, final_label int, severity int, confidence double, rubric_total int, review_status string, human_verified boolean, reviewer_id string")
    failed = [r.test for r in gates.run_checks(df, gates.merged_checks()).collect() if not r.passed]
    assert failed == ["severity"]
    assert df.select(gates.record_errors().alias("e")).first().e == []


def test_calibration_leaves_out_one(spark):
    df = spark.createDataFrame([(1.0, 1), (0.95, 1), (0.05, 0), (0.3, 1)], "c double, y int")
    got = {r.bin: (r.n, r.accuracy) for r in profile.calibration(df, "c", "y").collect()}
    assert got[9] == (1, 1.0) and got[0] == (1, 1.0) and got[3] == (1, 0.0) and got[5] == (0, None)


RSS = b"""<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><item><title>A</title><link>https://x/1</link><pubDate>Tue, 02 Jan 2024 03:04:05 +0000</pubDate></item>
<item><title>no link</title></item><item><link>https://x/2</link><dc:date>2024-01-02</dc:date></item></channel></rss>"""


def test_feeds_and_sitemaps(spark, tmp_path):
    (tmp_path / "f.rss").write_bytes(RSS)
    leaf, index = tmp_path / "leaf.xml", tmp_path / "index.xml"
    leaf.write_text('<urlset xmlns="http://s"><url><loc>https://x/a</loc><lastmod>2024-01-02</lastmod></url><url><loc>https://x/b</loc></url></urlset>')
    index.write_text(f'<sitemapindex xmlns="http://s"><sitemap><loc>{leaf}</loc></sitemap></sitemapindex>')
    feeds.register(spark)
    rows = spark.read.format("rss").load(str(tmp_path / "f.rss")).collect()
    assert [(r.url, r.published) for r in rows] == [("https://x/1", "2024-01-02T03:04:05+00:00"), ("https://x/2", "2024-01-02T00:00:00+00:00")]
    got = spark.read.format("sitemap").load(str(index)).collect()
    assert [(r.url, r.lastmod) for r in got] == [("https://x/a", "2024-01-02T00:00:00+00:00"), ("https://x/b", None)]
    loop = lambda u: b"<sitemapindex><sitemap><loc>again</loc></sitemap></sitemapindex>"
    assert feeds.sitemap_urls("again", load=loop) == []


def test_fetch_retries_only_what_can_recover():
    import urllib.error

    waits, calls = [], []

    def opener(url):
        calls.append(url)
        raise urllib.error.HTTPError(url, 503 if "503" in url else 404, "", None, None)

    assert feeds.fetch("http://x/503", wait=waits.append, opener=opener) is None and waits == [1.0, 2.0] and len(calls) == 3
    assert feeds.fetch("http://x/404", wait=waits.append, opener=opener) is None and len(calls) == 4


def test_scans_and_sinks(spark, tmp_path):
    (tmp_path / "s1_extracted.jsonl").write_text('{"id": "a", "n": 1}\nnot json\n\n{"id": "b", "n": 2}\n')
    path = str(tmp_path / "*.jsonl")
    assert sorted(r.id for r in files.scan_tolerant(spark, path, "id string, n int").collect()) == ["a", "b"]
    counted = files.scan_counting(spark, path, "id string, n int").cache()
    assert counted.filter("_corrupt_record is not null").count() == 1
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ"):
        files.scan_strict(spark, path, "id string, n int").collect()
    assert {r.file_source for r in files.with_file_source(files.scan_tolerant(spark, path, "id string, n int")).collect()} == {"s1"}
    df = spark.createDataFrame([("a", "train", [1], float("nan")), ("b", "test", None, 1.0)], "id string, split string, s array<int>, x double")
    assert sinks.write_splits(df, str(tmp_path / "out")) == ["train", "test"]
    assert '"x":null' in next((tmp_path / "out/train.jsonl").glob("part*")).read_text()
    assert files.scan_splits(spark, str(tmp_path / "out"), ("train", "test")).count() == 2
    good, bad = sinks.divide(df, F.col("x") > 0.5)
    assert good.count() + bad.count() == 2


def test_models_are_injected(spark):
    texts = spark.createDataFrame([(1, "a"), (2, "bb")], "id int, text string")
    cache = spark.createDataFrame([(1, [9.0])], "id int, embedding array<float>")
    got = {r.id: r.embedding for r in models.embed(texts, lambda: lambda xs: [[float(len(x))] for x in xs], cache).collect()}
    assert got == {1: [9.0], 2: [2.0]}

    def broken():
        def call(p):
            if p == "x":
                raise RuntimeError
            return p.upper()

        return call

    asked = models.ask(spark.createDataFrame([(1, "x"), (2, "y")], "id int, prompt string"), broken)
    assert {r.id: r.answer for r in asked.collect()} == {1: None, 2: "Y"}
