"""Language identification, words first, with backoff to shorter character n-grams.

Training counts every word of every text with a language, by language.  The model has a fixed size, of
which every language has an equal share, so a frequent one cannot crowd out a rare one: the most
frequent words of each, and its most frequent character n-grams of up to ``LONGEST`` letters ("^" and
"$" mark a word's ends), up to ``words`` and ``grams`` in all.  Of those that tie for the last places of a
share none is kept.  They keep their log frequency in each language; the counts behind it cover all texts.

A known word scores its log frequency in each language.  An unseen word is read at each of its
letters by the longest known n-gram that starts there, falling back to shorter ones, and
scores their mean.  The language of the text is the one with the largest sum over all words.

A text that is null or has no letter is ``und`` with score 0, as is every text if there is nothing
to learn from.  A word without a known n-gram adds nothing.  Ties go to the language that sorts
first.  Null texts and null languages teach nothing; repeated rows count each time, and are
answered each by itself, as are null ids.  A very long text is read whole.  Columns other than those named are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_as_text, id_restored, materialize, small_batches

WORDS = 60_000
GRAMS = 60_000
LONGEST = 5
SMOOTHING = 0.5
#: Unseen words whose scores a worker remembers.
CACHED = 1 << 17


@dataclass
class Model:
    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray

    def backoff(self, word: str) -> list[int]:
        """The longest known n-gram at each letter; letters without one are left out."""
        marked, known, found = f"^{word}$", self.grams, []
        for at in range(len(marked)):
            for size in range(min(LONGEST, len(marked) - at), 0, -1):
                k = known.get(marked[at : at + size])
                if k is not None:
                    found.append(k)
                    break
        return found

    def scores(self, words: str, unseen: dict[str, list[int]]) -> np.ndarray | None:
        """Of lower-case words, separated by spaces, by language; None without a word."""
        found = Counter(words.split())
        if not found or not self.languages:
            return None
        ids, times, grams, shares = [], [], [], []
        for word, n in found.items():
            k = self.words.get(word)
            if k is not None:
                ids.append(k)
                times.append(n)
                continue
            own = unseen.get(word)
            if own is None:
                if len(unseen) >= CACHED:
                    unseen.clear()
                own = unseen[word] = self.backoff(word)
            if own:
                grams += own
                shares += [n / len(own)] * len(own)
        total = np.zeros(len(self.languages))
        if ids:
            total += np.asarray(times, float) @ self.word_scores[ids]
        if grams:
            total += np.asarray(shares) @ self.gram_scores[grams]
        return total

    def predict(self, words: str, unseen: dict[str, list[int]]) -> tuple[str, float]:
        total = self.scores(words, unseen)
        if total is None:
            return "und", 0.0
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def words_of(text_col: str) -> Column:
    """Runs of letters in lower case, separated by spaces; training and scoring both read these."""
    return F.btrim(F.regexp_replace(F.lower(F.col(text_col)), "[^\\p{L}]+", " "))


def _most_frequent(counts: DataFrame, key: str, share: int) -> DataFrame:
    """Keys that are among the ``share`` most frequent of some language.

    How many keys have which count is summed up first; a running sum over these few rows
    gives the least count that each language keeps.
    """
    levels = counts.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("c"))
    down = Window.partitionBy("lang").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    least = levels.withColumn("all", F.sum("c").over(down)).filter(F.col("all") <= share).groupBy("lang").agg(F.min("n").alias("least"))
    return counts.join(F.broadcast(least), "lang").filter("n >= least").select(key).distinct()


def _table(counts: DataFrame, key: str, size: int, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """The most frequent keys, and their centred log frequency in each language."""
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    of_lang = np.array([totals.get(x, 0) for x in languages], float)
    share = max(1, size // max(1, len(languages)))
    kept = counts.join(F.broadcast(_most_frequent(counts, key, share)), key).select(key, "lang", "n").toArrow()  # size x languages rows at most
    place = {x: i for i, x in enumerate(languages)}
    keys = {k: i for i, k in enumerate(sorted(set(kept.column(key).to_pylist())))}
    n = np.zeros((len(keys), len(languages)))
    for k, x, c in zip(kept.column(key).to_pylist(), kept.column("lang").to_pylist(), kept.column("n").to_pylist(), strict=True):
        n[keys[k], place[x]] = c
    logs = np.log(n + SMOOTHING) - np.log(of_lang + SMOOTHING * max(1, len(keys)))
    return keys, logs - logs.mean(1, keepdims=True) if len(keys) else logs


def train(docs: DataFrame, words: int = WORDS, grams: int = GRAMS, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all rows of docs that have a text and a language."""
    text = words_of(text_col)
    told = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    spoken = told.select(F.col(lang_col).alias("lang"), F.explode_outer(F.split(text, " ")).alias("w")).filter("w <> ''")
    counts = materialize(spoken.groupBy("w", "lang").agg(F.count(F.lit(1)).alias("n")))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    marked = F.concat(F.lit("^"), F.col("w"), F.lit("$"))

    def of_size(k: int) -> Column:
        """N-grams of k letters; a shorter word has none."""
        starts = F.sequence(F.lit(1), F.length(marked) - (k - 1))
        return F.when(F.length(marked) >= k, F.transform(starts, lambda i: F.substr(marked, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))

    # Outer, as an inner explode makes the optimizer infer a filter that builds every n-gram again.
    gram_counts = materialize(counts.select("lang", "n", F.explode_outer(F.concat(*map(of_size, range(1, LONGEST + 1)))).alias("g")).groupBy("g", "lang").agg(F.sum("n").alias("n")))
    return Model(languages, *_table(counts, "w", words, languages), *_table(gram_counts, "g", grams, languages))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score); the score is the posterior of the language under equal priors."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # of fixed size

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, unseen = shared.value, {}
        for frame in frames:
            got = [own.predict(t, unseen) for t in frame["_text"]]
            yield pd.DataFrame({"_id": frame["_id"], "lang_pred": [x for x, _ in got], "score": [s for _, s in got]})

    out = docs.select(id_as_text(id_col), F.coalesce(words_of(text_col), F.lit("")).alias("_text")).mapInPandas(run, "_id string, lang_pred string, score double")
    return id_restored(out, docs, id_col)
