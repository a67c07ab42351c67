"""Cross-site line removal by distinct-site spread, in native expressions only.

A line is known by a 128-bit hash, a site by a 64-bit hash.  The texts are split once: the lines of
every document, each once, go to the checkpoint folder as (id, hashes, site).  HyperLogLog sketches
of the sites on which a line stands are merged by aggregation, so a line that millions of
documents share is summed before the shuffle; a line that is seen on one site only needs no sketch.
A line whose estimate is clear of the threshold by ``MARGIN`` is decided by it; the others
get an exact count of distinct sites.  Lines that enough sites share are boilerplate: they are
removed from every document but the one with the smallest id, so a text that was copied over
many sites is not lost everywhere.

A line of ``short`` or more characters that are not white space needs ``min_sites`` sites, a shorter one, which may recur by
chance, ``short_sites``.  Lines without such a character are never removed.

Lines meet the keys that they share by a broadcast of the keys if these are at most ``SENT``, else by
a join on key and salt: the keys are copied under every salt and the lines dealt over the salts by
document, so no line, however common, comes to one task.

A null text stays null, an empty one empty; a null site is no site.  If all lines of a text go, its
text is empty and the row stays.  Rows with equal ids are treated as one document; a null id counts
as the largest.  All columns are kept, whatever their names; ``n_chars`` is set to the new length.
An empty table gives an empty one, a very long text is split like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hidden, materialize, shown

MIN_SITES = 5
SHORT = 20
SHORT_SITES = 10
WHITE = " \t\x0b\x0c\r"
#: Sketch of 2^12 registers: standard error below 2 %, exact for small spreads.
REGISTERS = 12
MARGIN = 0.1
#: Keys (32 bytes each) that may be sent to all executors.
SENT = 500_000
SALTS = 64
#: Keys of one document are compared one by one up to a BUCKETS-th of so many, else dealt into buckets.
FEW, BUCKETS = 64, 256


def line_key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def solid(line: Column) -> Column:
    """Characters that are not white space."""
    return F.length(F.translate(line, WHITE, ""))


def lines_of(docs: DataFrame, min_sites: int, short_sites: int, short: int) -> DataFrame:
    """(id, a, b, site, need) for each different line of docs (id, text, site)."""
    lines = F.array_distinct(F.split("text", "\n", -1))
    # Outer, as an inner explode makes the optimizer infer a filter that splits every text again.
    each = docs.select("id", F.when(F.col("site").isNotNull(), F.xxhash64("site")).alias("site"), F.explode_outer(lines).alias("line"))
    each = each.select("id", "site", "line", solid(F.col("line")).alias("n")).filter("n > 0")
    need = F.when(F.col("n") >= short, min_sites).otherwise(short_sites)
    return each.select("id", line_key(F.col("line")).alias("k"), "site", need.alias("need")).select("id", "k.a", "k.b", "site", "need")


def meet(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """lines joined with keys (a, b, ...), which are materialised, on the key."""
    if keys.count() <= SENT:
        return lines.join(F.broadcast(keys), ["a", "b"])
    salted = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return lines.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["a", "b", "salt"]).drop("salt")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, short_sites: int = SHORT_SITES) -> DataFrame:
    """(a, b, owner): the keys of the lines on enough sites, and the smallest id that has them."""
    spread = lines.groupBy("a", "b").agg(F.min("id").alias("owner"), F.min("site").alias("x"), F.max("site").alias("y"), F.max("need").alias("need"))
    shared = spread.filter((F.col("x") != F.col("y")) | ((F.col("need") <= 1) & F.col("x").isNotNull()))
    shared = materialize(shared.select("a", "b", "owner"))
    sketches = meet(lines, shared.select("a", "b")).groupBy("a", "b").agg(F.hll_sketch_agg("site", F.lit(REGISTERS)).alias("s"), F.max("need").alias("need"))
    judged = materialize(sketches.select("a", "b", F.hll_sketch_estimate("s").alias("e"), "need").filter(F.col("e") >= F.col("need") * (1 - MARGIN)))
    clear = judged.filter(F.col("e") > F.col("need") * (1 + MARGIN)).select("a", "b")
    near = materialize(judged.filter(F.col("e") <= F.col("need") * (1 + MARGIN)).select("a", "b"))
    exact = meet(lines, near).groupBy("a", "b").agg(F.count_distinct("site").alias("sites"), F.max("need").alias("need")).filter("sites >= need").select("a", "b")
    return shared.join(clear.unionByName(exact), ["a", "b"])


def remove_boilerplate(
    docs: DataFrame, min_sites: int = MIN_SITES, short_sites: int = SHORT_SITES, short: int = SHORT, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source"
) -> DataFrame:
    """docs with the new text, and ``n_removed``: lines taken out (a column of that name is replaced)."""
    own, names = hidden(docs)
    key, text = names[id_col], F.col(names[text_col])
    lines = materialize(lines_of(own.select(F.col(key).alias("id"), text.alias("text"), F.col(names[site_col]).alias("site")), min_sites, short_sites, short))
    common = materialize(boilerplate(lines, min_sites, short_sites))
    hits = meet(lines, common).filter(~F.col("id").eqNullSafe(F.col("owner"))).groupBy("id").agg(F.collect_set(F.struct("a", "b")).alias("keys"))
    dealt = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.filter("keys", lambda x: F.pmod(x["a"], F.lit(BUCKETS)) == i))
    hits = hits.select("id", F.when(F.size("keys") <= FEW, F.array("keys")).otherwise(dealt).alias("buckets"))
    joined = own.join(hits, F.col(key).eqNullSafe(F.col("id")), "left")

    def stays(line: Column) -> Column:
        of_line = line_key(line)
        return ~F.array_contains(F.get("buckets", F.pmod(of_line["a"], F.size("buckets")).cast("int")), of_line)

    kept = F.when(F.col("buckets").isNotNull(), F.filter(F.split(text, "\n", -1), stays))
    joined = joined.select(*own.columns, kept.alias("kept"))
    new = F.when(F.col("kept").isNull(), text).otherwise(F.array_join("kept", "\n"))
    gone = F.when(F.col("kept").isNull(), 0).otherwise(F.size(F.split(text, "\n", -1)) - F.size("kept"))
    out = joined.select(*[new.alias(c) if c == names[text_col] else F.col(c) for c in own.columns], gone.cast("long").alias("n_removed"))
    if "n_chars" in names:
        out = out.withColumn(names["n_chars"], F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*shown(names, ("n_removed",)), "n_removed")
