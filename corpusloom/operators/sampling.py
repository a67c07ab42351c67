"""Samples, quotas, folds and splits with a replayable order: md5 of the id and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("train", "validation", "test")


def shuffled(id_col: str = "id", seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")).cast("binary"))


def _place(df: DataFrame, strata: list[str], *order: Column) -> DataFrame:
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(*strata).orderBy(*order)))


def per_stratum(df: DataFrame, strata: list[str], n: int, order: list[Column] | None = None) -> DataFrame:
    """Up to n rows of each stratum, by hash order or a given one."""
    return _place(df, strata, *(order or [shuffled(), F.col("id")])).filter(F.col("_place") <= n).drop("_place")


def quality_sample(df: DataFrame, share_percent: int = 5) -> DataFrame:
    """Flags max(1, share) of the accepted rows as ``qa_sample`` and sends them to review.

    The number is one scalar; the chosen ids are the smallest hashes (a sort with a limit).
    """
    accepted = df.filter("status = 'accepted'")
    n = accepted.count()
    k = max(1, n * share_percent // 100) if n else 0
    chosen = accepted.orderBy(shuffled(), "id").limit(k).select("id", F.lit(True).alias("_qa"))
    out = df.join(chosen, "id", "left")
    qa = F.coalesce("_qa", F.lit(False))
    return out.withColumns({"qa_sample": qa, "status": F.when(qa, "review").otherwise(F.col("status"))}).drop("_qa")


def dates_usable(df: DataFrame, column: str = "published", days: int = 60) -> DataFrame:
    """One row: whether the dates span more than ``days``."""
    span = F.floor((F.unix_timestamp(F.max(column)) - F.unix_timestamp(F.min(column))) / 86400)
    return df.agg(F.coalesce(span > days, F.lit(False)).alias("usable"), span.alias("span_days"))


def _split(df: DataFrame, strata: list[str], order: list[Column], sequence: tuple[str, str, str]) -> DataFrame:
    placed = _place(df, strata, *order).withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy(*strata)))
    part = F.expr("_size * 15 div 100")
    sizes = {"train": F.col("_size") - 2 * part, "validation": part, "test": part}
    first, second, third = sequence
    split = F.when(F.col("_place") <= sizes[first], first).when(F.col("_place") <= sizes[first] + sizes[second], second).otherwise(third)
    return placed.withColumn("split", split).drop("_place", "_size")


def temporal_split(df: DataFrame, strata: list[str], date: str = "published") -> DataFrame:
    """Per stratum the oldest rows train, then validation, the latest and undated test; 15 % floors; null strata count."""
    return _split(df, strata, [F.col(date).asc_nulls_last(), F.col("id")], ("train", "validation", "test"))


def random_split(df: DataFrame, strata: list[str], seed: int = 42) -> DataFrame:
    return _split(df, strata, [shuffled(seed=seed), F.col("id")], ("validation", "test", "train"))


def split(df: DataFrame, strata: list[str], date: str = "published") -> DataFrame:
    """By time if the dates are usable, else at random."""
    usable = dates_usable(df, date).first()["usable"]
    return temporal_split(df, strata, date) if usable else random_split(df, strata)


def folds(df: DataFrame, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold``: labels spread evenly over k folds."""
    return _place(df, [label], shuffled(seed=seed), F.col("id")).withColumn("fold", (F.col("_place") - 1) % k).drop("_place")


def quota(first: DataFrame, second: DataFrame, key: list[str], order: list[Column], enough: int, wanted: int, most: int) -> DataFrame:
    """Rows of ``first``; keys with fewer than ``enough`` are filled from ``second`` up to ``wanted``; at most ``most`` a key."""
    have = first.groupBy(*key).agg(F.count(F.lit(1)).alias("_have"))
    fresh = second.join(first.select("id"), "id", "left_anti").join(have, key, "left")
    have_n = F.coalesce("_have", F.lit(0))
    fresh = _place(fresh, key, *order).filter((have_n < enough) & (F.col("_place") <= wanted - have_n)).drop("_place", "_have")
    both = first.withColumn("_from", F.lit(0)).unionByName(fresh.withColumn("_from", F.lit(1)))
    return _place(both, key, F.col("_from"), *order).filter(F.col("_place") <= most).drop("_place", "_from")


def overlaps(df: DataFrame) -> DataFrame:
    """(left, right, shared): ids that two splits share, for each pair of splits."""
    pairs = [("train", "validation"), ("train", "test"), ("validation", "test")]
    per_id = df.groupBy("id").agg(F.collect_set("split").alias("s"))
    shared = per_id.agg(*[F.count_if(F.array_contains("s", a) & F.array_contains("s", b)).alias(f"{a}_{b}") for a, b in pairs])
    return shared.select(F.inline(F.array(*[F.struct(F.lit(a).alias("left_split"), F.lit(b).alias("right_split"), F.col(f"{a}_{b}").alias("shared")) for a, b in pairs])))


def split_stats(df: DataFrame, label: str = "final_label", threshold: float = 0.05) -> DataFrame:
    """One row: sizes, positives and rates by split, drift of train against test, and a warning."""
    rate = {s: F.avg(F.when(F.col("split") == s, F.col(label).cast("double"))) for s in SPLITS}
    drift = F.abs(rate["train"] - rate["test"])
    return df.agg(
        *[F.count_if(F.col("split") == s).alias(f"{s}_size") for s in SPLITS],
        *[F.count_if((F.col("split") == s) & (F.col(label) == 1)).alias(f"{s}_positive") for s in SPLITS],
        *[F.round(rate[s], 6).alias(f"{s}_rate") for s in SPLITS],
        F.round(drift, 6).alias("drift"),
        (drift > threshold).alias("drift_warning"),
    )
