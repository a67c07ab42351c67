"""Record types of the stages, as Spark schemas; each stage adds to the one before."""

from __future__ import annotations

RAW = (
    "id string, source string, url string, title string, sapo string, publish_date string, crawl_timestamp string, crawl_method string, "
    "rss_feed string, feed_type string, source_category string"
)
FILTERED = f"{RAW}, body_text string, body_preview string, extraction_success boolean"
CHECKS = "struct<valid_title:boolean,valid_sapo:boolean,valid_body_preview:boolean,sufficient_length:boolean,non_aggregation:boolean,low_repetition:boolean>"
VALIDATED = f"{FILTERED}, quality_score int, quality_breakdown {CHECKS}"
_RATER = "{0}_label int, {0}_confidence double, {0}_rubric_scores array<int>, {0}_severity int, {0}_reason string, {0}_thought_process map<string,string>"
ANNOTATED = f"{VALIDATED}, {_RATER.format('model_a')}, {_RATER.format('model_b')}, rubric_total int, final_label int, severity int, confidence double, status string, qa_sample boolean"
DECISION = (
    "record_id string, reviewer_id string, human_label int, human_rubric_scores array<int>, human_severity int, human_notes string, "
    "review_timestamp string, duration_seconds double"
)
MERGED = (
    f"{ANNOTATED}, human_label int, human_rubric_scores array<int>, human_severity int, human_notes string, human_verified boolean, "
    "review_status string, review_timestamp string, reviewer_id string, qa_mismatch boolean"
)
FINAL = f"{MERGED}, split string"
PAIR = "keep_id string, remove_id string, similarity double, action string"
TEST_RESULT = "test string, passed boolean, critical boolean, message string, status string"
EVENT = "session string, at string, event string, record_id string, payload string"
