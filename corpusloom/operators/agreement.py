"""Agreement between raters: every statistic is one aggregation of counts and then arithmetic."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.scoring import interpretation

DIGITS = 6


def _counts(a: str, b: str) -> dict[str, Column]:
    x, y = F.col(a), F.col(b)
    both = x.isNotNull() & y.isNotNull()
    cells = {"n": F.count_if(both)}
    for i in (0, 1):
        for j in (0, 1):
            cells[f"n{i}{j}"] = F.count_if(both & (x == i) & (y == j))
    return cells


def _kappa() -> dict[str, Column]:
    n = F.col("n").cast("double")
    pa, pb = (F.col("n10") + F.col("n11")) / n, (F.col("n01") + F.col("n11")) / n
    observed = (F.col("n00") + F.col("n11")) / n
    expected = pa * pb + (1 - pa) * (1 - pb)
    constant = (pa % 1 == 0) | (pb % 1 == 0)
    return {"observed": observed, "expected": expected, "constant": constant, "kappa": F.try_divide(observed - expected, 1 - expected), "pi": (pa + pb) / 2}


def cohen(df: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """Rows with both labels: n, observed, expected, kappa (0 for n < 2, null for a constant rater) and AC1."""
    grouped = df.groupBy(*(by or [])).agg(*[c.alias(k) for k, c in _counts(a, b).items()])
    k = _kappa()
    few = F.col("n") < 2
    chance = 2 * k["pi"] * (1 - k["pi"])
    kappa = F.when(few, 0.0).when(k["constant"], F.lit(None).cast("double")).otherwise(k["kappa"])
    ac1 = F.when(F.col("n") == 0, 0.0).otherwise(F.coalesce(F.try_divide(k["observed"] - chance, 1 - chance), F.lit(0.0)))
    safe = {x: F.when(few, 0.0).otherwise(k[x]) for x in ("observed", "expected")}
    return grouped.select(*(by or []), "n", "n00", "n01", "n10", "n11", F.round(safe["observed"], DIGITS).alias("observed"), F.round(safe["expected"], DIGITS).alias("expected"), F.round(kappa, DIGITS).alias("kappa"), F.round(ac1, DIGITS).alias("ac1"))


def with_interpretation(df: DataFrame) -> DataFrame:
    return df.withColumn("interpretation", F.coalesce(interpretation(F.col("kappa")), F.lit("N/A (degenerate)")))


def bootstrap(df: DataFrame, a: str, b: str, rounds: int = 1000, seed: int = 42) -> DataFrame:
    """One row: kappa and its 95 % percentile interval.

    Kappa depends on four counts only, so a resample of the rows is a multinomial draw of the counts.
    """
    row = cohen(df, a, b).first()
    cells, n = [row["n00"], row["n01"], row["n10"], row["n11"]], row["n"]
    spark = df.sparkSession
    if n < 2 or row["kappa"] is None:
        return spark.createDataFrame([(row["kappa"], None, None)], "kappa double, low double, high double")
    draw = random.Random(seed)
    values = []
    for _ in range(rounds):
        left, rest, got = n, n, []
        for c in cells[:-1]:
            p = c / rest if rest else 0.0
            x = draw.binomialvariate(left, min(1.0, p))
            got.append(x)
            left, rest = left - x, rest - c
        n00, n01, n10, n11 = *got, left
        pa, pb, po = (n10 + n11) / n, (n01 + n11) / n, (n00 + n11) / n
        pe = pa * pb + (1 - pa) * (1 - pb)
        if pe < 1:
            values.append((po - pe) / (1 - pe))
    drawn = spark.createDataFrame([(v,) for v in values], "k double")
    return drawn.agg(F.lit(row["kappa"]).alias("kappa"), F.expr("percentile(k, 0.025)").alias("low"), F.expr("percentile(k, 0.975)").alias("high"))


def krippendorff(df: DataFrame, raters: list[str]) -> DataFrame:
    """Nominal alpha over items with two or more ratings of 0 or 1."""
    ratings = F.array_compact(F.array(*[F.col(r).cast("int") for r in raters]))
    items = df.select(F.size(ratings).alias("m"), F.size(F.filter(ratings, lambda x: x == 1)).alias("n1")).filter("m >= 2")
    n1, n0 = F.col("n1").cast("double"), (F.col("m") - F.col("n1")).cast("double")
    s = items.agg(F.sum((n0 * (F.col("m") - n0) + n1 * (F.col("m") - n1)) / (F.col("m") - 1)).alias("d"), F.sum("m").cast("double").alias("total"), F.sum(n1).alias("ones"), F.count(F.lit(1)).alias("items"))
    total, ones = F.col("total"), F.col("ones")
    zeros = total - ones
    observed = F.col("d") / total
    expected = F.try_divide(ones * (total - ones) + zeros * (total - zeros), total * (total - 1))
    alpha = F.when(F.col("items") == 0, 0.0).when(expected == 0, F.when(observed == 0, 1.0).otherwise(0.0)).otherwise(1 - observed / expected)
    return s.select("items", F.round(alpha, DIGITS).alias("alpha"))


def fleiss(df: DataFrame, raters: list[str], least: int = 10) -> DataFrame:
    """Kappa of three raters over the rows that all rated; null for fewer than ``least``."""
    ones = sum((F.col(r).cast("int") for r in raters), F.lit(0))
    k = len(raters)
    rows = df.select(ones.alias("n1")).filter("n1 is not null")
    n1 = F.col("n1").cast("double")
    s = rows.agg(F.count(F.lit(1)).alias("items"), F.avg((n1 * n1 + (k - n1) * (k - n1) - k) / (k * (k - 1))).alias("p"), (F.sum(n1) / (k * F.count(F.lit(1)))).alias("share"))
    chance = F.col("share") * F.col("share") + (1 - F.col("share")) * (1 - F.col("share"))
    return s.select("items", F.round(F.when(F.col("items") >= least, F.try_divide(F.col("p") - chance, 1 - chance)), DIGITS).alias("kappa"))


def disagreements(df: DataFrame, a: str, b: str, gold: str, resolved: Column) -> DataFrame:
    """One row: rated by both, disagreeing, their share, resolved ones, and those where both miss the gold label."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    apart = both & (F.col(a) != F.col(b))
    wrong = F.coalesce((F.col(a) != F.col(gold)) & (F.col(b) != F.col(gold)), F.lit(False))
    return df.agg(
        F.count_if(both).alias("rated"),
        F.count_if(apart).alias("disagreements"),
        F.round(F.coalesce(F.try_divide(F.count_if(apart), F.count_if(both)), F.lit(0.0)), DIGITS).alias("rate"),
        F.count_if(apart & resolved).alias("resolved"),
        F.count_if(apart & wrong).alias("both_wrong"),
    )


def disagreement_samples(df: DataFrame, a: str, b: str, k: int = 20) -> DataFrame:
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).orderBy("id").limit(k)


def gate(kappa: Column, least: float = 0.60) -> Column:
    """Whether kappa is high enough; null where it is undefined."""
    return kappa >= least


def density(low: float, high: float, mean: float, points: int = 200) -> Column:
    """Array of (x, y) of the normal curve that has this 95 % interval."""
    width = max((high - low) / 3.92, 1e-9)
    at = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(mean - 4 * width) + i * (8 * width / (points - 1)))
    return F.transform(at, lambda x: F.struct(x.alias("x"), F.exp(-0.5 * F.pow((x - mean) / width, F.lit(2.0))).alias("y")))
