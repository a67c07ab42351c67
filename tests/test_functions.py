"""Column functions against the expected values of the fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import llm_json, scoring
from corpusloom.functions import text as t


def one(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(make(*[F.col(c) for c in df.columns]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "given,wanted",
    [
        (None, None), ("á", "á"), ("A &amp; B &quot;c&quot;", 'A & B "c"'), (" a \n\t b c ", "a b c"), ("“a” ‘b’ – — …�", "\"a\" 'b' - - ..."),
        ("a​b﻿", "ab"), ("TiÃªng", "Tiêng"), ("", ""), ("x​ ", "x"),
    ],
)
def test_clean(spark, given, wanted):
    assert one(spark, t.clean, given) == wanted


@pytest.mark.parametrize("given,wanted", [(None, None), ("abc", "abc"), ("abcdefghijkl", "abcdefghij...")])
def test_truncate(spark, given, wanted):
    assert one(spark, lambda x: t.truncate(x, 10), given) == wanted


@pytest.mark.parametrize(
    "html,wanted",
    [
        ("<h1 class='a'>The <b>first</b> title</h1><title>Other title</title>", "The first title"),
        ('<meta property="og:title" content="From the graph">', "From the graph"),
        ("<title>A longer title - Site</title>", "A longer title"),
        ("<h1>abc</h1><title>Fallback title | Site</title>", "Fallback title"),
        ("<p>nothing</p>", None),
    ],
)
def test_html_title(spark, html, wanted):
    assert one(spark, t.html_title, html) == wanted


@pytest.mark.parametrize("url,keep", [("https://x.vn/a.html", True), ("https://x.vn/VIDEO/a", False), ("https://x.vn/a#comment", True), ("https://x.vn/a?page=2", False), ("", False), (None, False), ("https://x.vn/rss-feed", False), ("https://x.vn/category/", False)])
def test_keep_url(spark, url, keep):
    assert one(spark, t.keep_url, url) is keep


def test_urls_and_ids(spark):
    assert one(spark, t.crawl_url, " https://X.vn/a// ") == "https://X.vn/a"
    assert one(spark, t.crawl_url, None) == ""
    assert one(spark, t.canonical_url, "HTTPS://X.VN/Path#top") == "https://x.vn/Path"
    assert one(spark, t.article_id, "s", "https://x.vn/a/").startswith("s_")
    assert one(spark, t.feed_type, "https://x.vn/rss/the-thao-12.rss") == "the-thao"


def test_dates(spark):
    stamp = lambda x: one(spark, lambda c: t.timestamp_of(c).cast("string"), x)
    assert stamp("1620000000000") == "2021-05-03 00:00:00"
    assert stamp("2024-01-02T03:04:05+00:00") == "2024-01-02 03:04:05"
    assert stamp("soon") is None and stamp(None) is None


CHECKS = ("valid_title", "valid_sapo", "valid_body_preview", "sufficient_length", "non_aggregation", "low_repetition")
BODY = " ".join(f"word{i}" for i in range(120))


@pytest.mark.parametrize(
    "title,lead,body,score",
    [
        ("A proper headline", "A lead that is certainly longer than thirty characters", BODY, 6),
        ("Abcd", "A lead that is certainly longer than thirty characters", BODY, 0),
        ("", "A lead that is certainly longer than thirty characters", BODY, 0),
        ("A proper headline", "", BODY, 0),
        ("A proper headline", "A lead that is certainly longer than thirty characters", "", 3),
        ("The title that is as long as any lead", "the title that is as long as any lead", BODY, 0),
        ("Our homeland today", "A lead that is certainly longer than thirty characters", BODY, 0),
    ],
)
def test_quality(spark, title, lead, body, score):
    assert one(spark, lambda a, b, c: scoring.quality_score(scoring.quality_checks(a, b, c)), title, lead, body) == score


@pytest.mark.parametrize("a,b,wanted", [("same text", "same text", 1.0), ("short", "much longer text here", 0.8), ("is it so?", "is it so.", 0.9), ("ok?", "much longer text here", 0.72), ("", "x", 1.0), (None, "x", 1.0)])
def test_length_penalty(spark, a, b, wanted):
    assert one(spark, scoring.length_penalty, a, b) == pytest.approx(wanted)


def test_vote(spark):
    rows = spark.createDataFrame(
        [([1, 1, 1, 0], 0.8, 0, 1, [2, 1, 1, 0], 0.9, 1, 1), ([2, 1, 0, 0], 0.9, 0, 1, [2, 0, 0, 0], 0.9, 0, 0), ([2, 2, 2, 1], 1.0, 2, 0, [2, 2, 2, 1], 0.95, 3, 1), ([0, 0, 0, 0], 0.5, 0, None, [0, 0, 0, 0], 0.5, 0, 0)],
        "sa array<int>, ca double, va int, la int, sb array<int>, cb double, vb int, lb int",
    )
    side = lambda x: {"label": F.col(f"l{x}"), "scores": F.col(f"s{x}"), "confidence": F.col(f"c{x}"), "severity": F.col(f"v{x}")}
    got = [r.asDict() for r in rows.select(*[c.alias(n) for n, c in scoring.vote(side("a"), side("b")).items()]).collect()]
    assert (got[0]["final_label"], got[0]["status"], got[0]["rubric_total"], got[0]["severity"]) == (1, "review", 4, 1)
    assert got[0]["confidence"] == pytest.approx(0.75)
    assert got[1]["rubric_total"] == 2 and got[1]["final_label"] == 0 and got[1]["status"] == "review"
    assert got[2]["status"] == "accepted" and got[2]["confidence"] == 1.0
    assert got[3]["final_label"] is None and got[3]["rubric_total"] == -1 and got[3]["confidence"] == 0.5


def test_confidence_levels_are_closed_on_the_right(spark):
    got = spark.createDataFrame([(x,) for x in (0.0, 0.60, 0.61, 0.75, 0.90, 1.0, -0.1, None)], "c double").select(scoring.confidence_level(F.col("c")).alias("x")).collect()
    assert [r.x for r in got] == ["low", "low", "medium", "medium", "high", "very_high", "unknown", "unknown"]


def test_answers_are_found_repaired_and_clamped(spark):
    broken = '{\n"label": 1,\n"reason": "he said "no" twice"\n}'
    texts = ["<think>{}</think> so: " + json.dumps({"label": "3", "confidence": 2, "rubric_scores": [1, 1, 5, "x"], "reason": "r"}), broken, "nothing", None]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, a string").select("i", llm_json.answer_or_failure(F.col("a")).alias("r")).orderBy("i").collect()
    assert (got[0].r.label, got[0].r.confidence, got[0].r.rubric_scores) == (1, 1.0, [1, 1, 2, 0])
    assert got[1].r.label == 1 and "'no'" in got[1].r.reason
    assert got[2].r.label is None and got[2].r.reason.startswith("Error:") and got[3].r.reason.startswith("Error:")
