"""Baseline classifiers and their reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Model
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import checkpointed, terms

DIGITS = 6
#: Terms of a vocabulary.
TERMS = 10_000


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * n)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()  # one row for each class
    return counts.withColumn("weight", F.round(F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n")), DIGITS))


def majority(train: DataFrame, label: str = "label") -> DataFrame:
    """One row: the most frequent label, the smaller one of a tie."""
    return train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), label).limit(1).select(F.col(label).alias("prediction"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, and precision, recall, F1 and support of each class, macro and weighted; 0 where undefined."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    counts = df.agg(*[F.count_if((y == i) & (p == j)).alias(f"c{i}{j}") for i in (0, 1) for j in (0, 1)])
    n = F.col("c00") + F.col("c01") + F.col("c10") + F.col("c11")
    out = {"accuracy": _ratio(F.col("c00") + F.col("c11"), n)}
    for k in (0, 1):
        hit, support = F.col(f"c{k}{k}"), F.col(f"c{k}0") + F.col(f"c{k}1")
        precision, recall = _ratio(hit, F.col(f"c0{k}") + F.col(f"c1{k}")), _ratio(hit, support)
        out |= {f"precision_{k}": precision, f"recall_{k}": recall, f"f1_{k}": _ratio(2 * precision * recall, precision + recall), f"support_{k}": support}
    for m in ("precision", "recall", "f1"):
        out[f"macro_{m}"] = (out[f"{m}_0"] + out[f"{m}_1"]) / 2
        out[f"weighted_{m}"] = _ratio(out[f"{m}_0"] * out["support_0"] + out[f"{m}_1"] * out["support_1"], n)
    return counts.select(*[(c if k.startswith("support") else F.round(c, DIGITS)).alias(k) for k, c in out.items()])


def weighted(df: DataFrame, label: str = "label") -> DataFrame:
    return df.join(F.broadcast(class_weights(df, label).select(label, "weight")), label)


def _term_counts(texts: DataFrame) -> DataFrame:
    return texts.select("id", F.explode_outer(terms(F.col("text"))).alias("term")).filter("term is not null").groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(texts: DataFrame, top: int = TERMS) -> DataFrame:
    """(term, k, idf) of the ``top`` most frequent terms of the texts (id, text)."""
    seen = _term_counts(texts).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    n = texts.count()
    best = seen.orderBy(F.col("total").desc(), "term").limit(top)
    idf = F.log(F.lit(1.0 + n) / (1 + F.col("df"))) + 1
    return checkpointed(best.select("term", (F.row_number().over(Window.orderBy("term")) - 1).alias("k"), idf.alias("idf")))  # at most ``top`` rows


def text_features(texts: DataFrame, words: DataFrame, top: int = TERMS) -> DataFrame:
    """(id, features): sublinear TF-IDF of texts (id, text) over a vocabulary, as sparse unit vectors."""
    raw = _term_counts(texts).join(F.broadcast(words), "term").select("id", "k", ((1 + F.log("tf")) * F.col("idf")).alias("w"))
    rows = raw.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("k", "w"))).alias("kw"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    rows = texts.select("id").join(rows, "id", "left")
    vector = F.udf(lambda kw, norm: SparseVector(top, [x["k"] for x in kw or []], [x["w"] / norm for x in kw or []]), VectorUDT())
    return rows.select("id", vector("kw", "norm").alias("features"))


def array_features(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.transform(column, lambda x: x.cast("double"))))


def fit(kind: str, train: DataFrame, c: float = 1.0) -> Model:
    """Balanced logistic regression or linear support vectors; train has features and label."""
    rows = weighted(train).select(F.col("label").cast("double").alias("label"), "features", "weight").persist()
    try:
        strength = 1.0 / (c * max(1, rows.count()))
        made = LogisticRegression(weightCol="weight", regParam=strength, maxIter=1000) if kind == "logistic" else LinearSVC(weightCol="weight", regParam=strength, maxIter=2000)
        return made.fit(rows)
    finally:
        rows.unpersist()


def macro_f1(df: DataFrame) -> float:
    return report(df).first()["macro_f1"]


def tune(kind: str, train: DataFrame, candidates: Iterable[float] = (0.01, 0.1, 1.0, 10.0), k: int = 5) -> tuple[float, float]:
    """The best C by mean macro F1 over the folds in column ``fold``, and that mean."""
    train = train.cache()
    try:
        scored = []
        for c in candidates:
            means = [macro_f1(fit(kind, train.filter(F.col("fold") != f), c).transform(train.filter(F.col("fold") == f))) for f in range(k)]
            scored.append((sum(means) / k, -c))
        best = max(scored)
        return -best[1], best[0]
    finally:
        train.unpersist()


def error_samples(df: DataFrame, k: int = 5) -> DataFrame:
    """Up to k false positives and k false negatives, by id."""
    kind = F.when((F.col("prediction") == 1) & (F.col("label") == 0), "false_positive").when((F.col("prediction") == 0) & (F.col("label") == 1), "false_negative")
    wrong = df.withColumn("error", kind).filter("error is not null")
    return wrong.withColumn("_n", F.row_number().over(Window.partitionBy("error").orderBy("id"))).filter(F.col("_n") <= k).drop("_n")
