"""Quality rules: a threshold table compiled into one projection of native expressions.

``measures`` adds the counts of a text, ``compile_rules`` turns a table of (name, numerator,
denominator, least, most) into boolean columns, and ``apply_rules`` evaluates both in the scan's
own stage: no shuffle, no user function.

A null text has no words and no lines.  Repeated rows and null ids are judged each by itself; an
empty table gives an empty one, and a very long text is judged as a whole.  A ratio over
zero counts as 0.  Extra columns are kept; one of the name of a measure or a rule is replaced.
Windows of words are compared by a 64-bit hash within their document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hidden, shown, text_or_empty

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")
PUNCTUATION = ".,;:!?\"'()"
WINDOW = 8
#: Frequent function words of the four languages.
STOP_WORDS = tuple(
    sorted(
        set(
            "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were"
            " le la les de des du un une et est en que qui dans par pour au sur pas plus ce il elle ne se"
            " el los las y del una es por con no para su al lo como más pero sus"
            " der die das und ist von zu den mit sich auf für nicht ein eine als auch dem im werden".split()
        )
    )
)


@dataclass(frozen=True)
class Rule:
    """``least`` <= top / bottom <= ``most``; bottom None compares the count itself."""

    name: str
    top: str
    bottom: str | None
    least: float | None = None
    most: float | None = None


#: Length, symbol, stop-word and line ratios.
RULES = (
    Rule("length_ok", "n_words", None, least=20),
    Rule("word_length_ok", "word_chars", "n_words", least=2, most=20),
    Rule("symbols_ok", "n_symbols", "n_words", most=0.25),
    Rule("stop_words_ok", "n_stop_words", "n_words", least=0.02),
    Rule("lines_ok", "n_dup_lines", "n_lines", most=0.5),
    Rule("repeats_ok", "n_repeat_words", "n_words", most=0.3),
)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measures(docs: DataFrame, text_col: str = "text", replaced: tuple[str, ...] = ()) -> DataFrame:
    """Adds the MEASURES; columns of their names, or of the names ``replaced``, go.

    Arrays stand in projections of their own and are used more than once in the next, so that
    the optimizer keeps them and no lambda works them out again for each element.
    """
    text = F.col("_q_text")
    out, names = hidden(docs)
    keep = out.columns
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: _without(x, SPACE) != "")
    out = out.withColumn("_q_text", text_or_empty(names[text_col]))
    out = out.select(
        *keep,
        words.alias("_q_words"),
        F.length(_without(text, SPACE)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("_q_lines"),
    )
    n = F.size("_q_words")
    hashes = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_q_words", i, WINDOW))))
    counts = [F.col("word_chars"), F.col("n_symbols")]
    stop = F.filter("_q_words", lambda w: F.btrim(F.lower(w), F.lit(PUNCTUATION)).isin(*STOP_WORDS))
    out = out.select(
        *keep,
        *counts,
        n.cast("long").alias("n_words"),
        F.size("_q_lines").cast("long").alias("n_lines"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("n_dup_lines"),
        F.size(stop).cast("long").alias("n_stop_words"),
        hashes.alias("_q_hash"),
    )
    counts += [F.col(c) for c in ("n_words", "n_lines", "n_dup_lines", "n_stop_words")]
    again = F.size(F.array_distinct("_q_hash")) < F.size("_q_hash")
    placed = F.transform("_q_hash", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.select(*keep, *counts, F.when(again, F.sort_array(placed)).alias("_q_sorted"))
    at = F.col("_q_sorted")
    twice = F.filter(at, lambda s, i: F.coalesce(F.get(at, i - 1)["h"] == s["h"], F.lit(False)) | F.coalesce(F.get(at, i + 1)["h"] == s["h"], F.lit(False)))
    out = out.select(*keep, *counts, F.sort_array(F.transform(twice, lambda s: s["i"])).alias("_q_at"))
    at = F.col("_q_at")
    covered = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))
    return out.select(*shown(names, (*MEASURES, *replaced)), *counts, total.cast("long").alias("n_repeat_words"))


def compile_rules(rules: tuple[Rule, ...]) -> dict[str, Column]:
    """A boolean column for each rule of the table."""
    compiled = {}
    for r in rules:
        value = F.col(r.top).cast("double")
        if r.bottom is not None:
            value = F.coalesce(F.try_divide(value, F.col(r.bottom).cast("double")), F.lit(0.0))
        passed = F.lit(True)
        if r.least is not None:
            passed = passed & (value >= r.least)
        if r.most is not None:
            passed = passed & (value <= r.most)
        compiled[r.name] = passed
    return compiled


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Adds the measures, a column for each rule, and ``passed``."""
    columns = compile_rules(rules)
    measured = measures(docs, text_col, (*columns, "passed"))
    passed = F.lit(True)
    for c in columns.values():
        passed = passed & c
    return measured.select("*", *[c.alias(n) for n, c in columns.items()], passed.alias("passed"))
