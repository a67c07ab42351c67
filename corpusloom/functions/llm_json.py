"""Answers of language models: finding the JSON in them and bringing it to one shape."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

TEXTS = "struct<label:string,confidence:string,severity:string,reason:string,rubric_scores:array<string>"
ANSWER = TEXTS + ",thought_process:" + TEXTS + ">>"
# Keys whose texts may hold stray quotes.
TEXT_KEYS = ("c1_sensationalism_analysis", "c2_information_gap_analysis", "c3_syntactic_framing_analysis", "c4_incongruence_analysis", "reason", "external_reasoning")


def json_part(answer: Column) -> Column:
    """From the first { to the last } after thinking is taken out; '' if there is none."""
    return F.regexp_extract(F.regexp_replace(answer, r"(?s)<think>.*?</think>", ""), r"(?s)\{.*\}", 0)


def _repair(text: str) -> str | None:
    def fixed(line: str) -> str:
        m = re.match(r'^(\s*"(?:%s)"\s*:\s*")(.*)("\s*,?\s*)$' % "|".join(TEXT_KEYS), line)
        return m[1] + m[2].replace('"', "'") + m[3] if m else line

    again = "\n".join(map(fixed, text.split("\n")))
    try:
        json.loads(again)
    except ValueError:
        return None
    return again


@F.pandas_udf(StringType())
def _repaired(texts: pd.Series) -> pd.Series:
    return texts.map(_repair, na_action="ignore")


def parsed(answer: Column) -> Column:
    """The answer's JSON text, repaired where it had to be; null if there is none."""
    part = F.nullif(json_part(answer), F.lit(""))
    good = F.get_json_object(part, "$").isNotNull()
    return F.when(good, part).otherwise(_repaired(F.when(~good, part)))


def normalized(text: Column) -> Column:
    """struct of label, confidence, rubric_scores, severity and reason; fields missing at the top come from thought_process."""
    x = F.from_json(text, ANSWER)
    inner = x["thought_process"]

    def pick(name: str) -> Column:
        return F.coalesce(x[name], inner[name])

    empty = x["rubric_scores"].isNull() | (x["rubric_scores"] == F.array(*[F.lit("0")] * 4))
    raw = F.when(empty, F.coalesce(inner["rubric_scores"], x["rubric_scores"])).otherwise(x["rubric_scores"])
    zeros = F.array(*[F.lit(0)] * 4)
    scores = F.transform(raw, lambda s: F.greatest(F.lit(0), F.least(F.lit(2), F.coalesce(s.try_cast("int"), F.lit(0)))))
    confidence = F.coalesce(pick("confidence").try_cast("double"), F.lit(0.0))
    label = pick("label").try_cast("int")
    return F.struct(
        F.when(label.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(1), label))).alias("label"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence)).alias("confidence"),
        F.coalesce(F.when(F.size(scores) == 4, scores), zeros).alias("rubric_scores"),
        F.coalesce(pick("severity").try_cast("int"), F.lit(0)).alias("severity"),
        F.coalesce(pick("reason"), F.lit("")).alias("reason"),
    )


def failure(reason: Column) -> Column:
    return F.struct(
        F.lit(None).cast("int").alias("label"),
        F.lit(0.0).alias("confidence"),
        F.array(*[F.lit(0)] * 4).alias("rubric_scores"),
        F.lit(0).alias("severity"),
        F.concat(F.lit("Error: "), reason).alias("reason"),
    )


def answer_or_failure(answer: Column) -> Column:
    text = parsed(answer)
    return F.when(text.isNotNull(), normalized(text)).otherwise(failure(F.lit("no JSON in the answer")))


def worth_keeping(result: Column) -> Column:
    """False for cached results that have to be asked again."""
    return result["label"].isNotNull() & ~F.coalesce(F.contains(result["reason"], F.lit("Error:")), F.lit(False))
