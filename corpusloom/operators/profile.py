"""Profiles: counts, shares, cross tables, histograms, trends and curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 6


def share(hit: Column) -> Column:
    return F.round(F.avg(hit.cast("double")), DIGITS)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share) over the rows that have a value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row for each value
    return counts.withColumn("share", F.round(F.col("n") / total, DIGITS))


def by_source(df: DataFrame, label: str, quality: str) -> DataFrame:
    """Rows, positives, negatives and mean quality of each source; rows without one are left out."""
    return df.filter("source is not null").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("positive"), F.count_if(F.col(label) == 0).alias("negative"), F.round(F.avg(quality), 2).alias("mean_quality")
    )


def statistics(df: DataFrame, column: str, prefix: str) -> DataFrame:
    x = F.col(column)
    return df.agg(F.count(x).alias("n"), F.round(F.avg(x), DIGITS).alias(f"{prefix}_mean"), F.round(F.stddev_samp(x), DIGITS).alias(f"{prefix}_std"), F.min(x).alias(f"{prefix}_min"), F.max(x).alias(f"{prefix}_max"))


def dataset_statistics(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("final_label") == 1).alias("clickbait"),
        F.count_if(F.col("final_label") == 0).alias("non_clickbait"),
        F.count_if(F.col("status") == "review").alias("review"),
        F.count_if(F.col("status") == "accepted").alias("accepted"),
        F.count_if(F.coalesce(F.col("human_verified"), F.lit(False))).alias("human_verified"),
        F.round(F.avg("quality_score"), DIGITS).alias("quality_mean"),
        F.min("quality_score").alias("quality_min"),
        F.max("quality_score").alias("quality_max"),
        F.round(F.avg("confidence"), DIGITS).alias("confidence_mean"),
        F.min("confidence").alias("confidence_min"),
        F.max("confidence").alias("confidence_max"),
    )


def metadata(df: DataFrame, crawled: str = "crawled") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.min(crawled).alias("first_crawl"), F.max(crawled).alias("last_crawl"), F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"))


def rate_by(df: DataFrame, key: str, hit: Column) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), share(hit).alias("rate"))


def crosstab(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(f"{column}_{v}") for v in values])


def crosstab_percent(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    table = crosstab(df, row, column, values)
    total = sum((F.col(f"{column}_{v}") for v in values), F.lit(0))
    return table.select(row, *[F.round(F.try_divide(F.col(f"{column}_{v}") * 100.0, total), DIGITS).alias(f"{column}_{v}") for v in values])


def daily_trend(df: DataFrame, ts: str, hit: Column) -> DataFrame:
    """Per day: rows, hits, and the percentage of hits."""
    return df.filter(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("hits"), F.round(F.avg(hit.cast("double")) * 100, DIGITS).alias("percent"))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n): equal widths, the last bin closed; values outside are left out."""
    x = F.col(column).cast("double")
    place = F.least(F.floor((x - low) / ((high - low) / bins)).cast("int"), F.lit(bins - 1))
    return df.filter((x >= low) & (x <= high)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def calibration(df: DataFrame, confidence: str, label: str) -> DataFrame:
    """Ten bins [lo, hi): how often the label equals confidence > .5; 1.0 is in no bin, empty bins are null."""
    c = F.col(confidence)
    place = F.lit(None).cast("int")
    for i in range(10):
        place = F.coalesce(place, F.when((c >= i / 10) & (c < (i + 1) / 10), i))
    right = (F.col(label) == (c > 0.5).cast("int")).cast("double")
    found = df.filter(F.col(label).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(right), DIGITS).alias("accuracy"))
    grid = df.sparkSession.range(10).select(F.col("id").cast("int").alias("bin"))
    return grid.join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "accuracy")


def confusion(df: DataFrame, gold: str, predicted: str) -> DataFrame:
    """All four cells, rows without either left out."""
    cells = df.filter(F.col(gold).isNotNull() & F.col(predicted).isNotNull()).groupBy(F.col(gold).cast("int").alias("gold"), F.col(predicted).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    two = df.sparkSession.range(4).select((F.col("id") / 2).cast("int").alias("gold"), (F.col("id") % 2).cast("int").alias("predicted"))
    return two.join(cells, ["gold", "predicted"], "left").select("gold", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def quantiles(df: DataFrame, key: str, column: str) -> DataFrame:
    q = F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.groupBy(key).agg(F.count(column).alias("n"), q.alias("_q")).select(key, "n", *[F.round(F.get("_q", i), 4).alias(name) for i, name in enumerate(("q25", "q50", "q75"))])


def marker_rates(df: DataFrame, label: str, flags: dict[str, Column]) -> DataFrame:
    """(label, marker, percent) in long form."""
    rates = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(*[(F.avg(c.cast("double")) * 100).alias(n) for n, c in flags.items()])
    return rates.unpivot("label", list(flags), "marker", "percent").withColumn("percent", F.round("percent", DIGITS))


def rubric_means(df: DataFrame, scores: dict[str, str]) -> DataFrame:
    """(rater, criterion, mean) of four criteria; 0 where no rater scored."""
    long = None
    for rater, column in scores.items():
        part = df.select(F.lit(rater).alias("rater"), F.posexplode_outer(column).alias("c", "v"))
        long = part if long is None else long.unionByName(part)
    return long.filter("c is not null").groupBy("rater", (F.col("c") + 1).alias("criterion")).agg(F.round(F.coalesce(F.avg("v"), F.lit(0.0)), DIGITS).alias("mean"))


def key_metrics(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("final_label") == 1).cast("double")) * 100, DIGITS).alias("clickbait_percent"), F.round(F.avg("quality_score"), DIGITS).alias("mean_quality"), F.round(F.avg("confidence"), DIGITS).alias("mean_confidence"))


def survival(df: DataFrame, passed: Column, key: str = "source") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(passed).alias("passed"), F.round(F.coalesce(F.try_divide(F.count_if(passed) * 100.0, F.count(F.lit(1))), F.lit(0.0)), DIGITS).alias("percent"))


def manifest(df: DataFrame, progress: str = "feeds") -> DataFrame:
    """Feeds and articles of each source from a map of feed to count."""
    return df.select("source", F.explode_outer(progress).alias("feed", "articles")).groupBy("source").agg(F.count("feed").alias("feeds"), F.coalesce(F.sum("articles"), F.lit(0)).alias("articles"))
