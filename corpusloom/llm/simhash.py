"""SimHash near-duplicate search with covering locality-sensitive hashing.

A text is lower-cased (A-Z), cut into words at ASCII white space, and each run of ``shingle``
words is hashed by XXH64.  A bit of the fingerprint is 1 if it is set in over half of the hashes.

Search for pairs within ``radius`` r bits: every bit position gets a nonzero vector of r + 1 bits;
table v (any nonzero vector) keeps the positions whose vector has odd parity with v.  For the at
most r positions in which a pair differs there are r equations in r + 1 unknowns, so some table
keeps none of them, and the pair shares that table's key: no pair within the radius is lost.
There are 2^(r+1) - 1 tables.

A bucket of up to ``BUCKET`` different fingerprints is compared pair by pair.  A fuller one is
not: two of its members within r bits (r even) have a common point within r/2 bits of both,
and all that lie around one point are within r bits of each other.  So each member is
listed under the points around it that its table allows, and is tied to the smallest of a point:
work stays in proportion to the rows, and no connection is lost.

Only different fingerprints are compared; equal ones are one class, named by its smallest id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hidden, id_as_text, id_restored, keyed_join, materialize, release, shown, small_batches, stored, text_or_empty
from .components import components

SEED = 42
BITS = 64
BUCKET = 16
#: Near-copy removal: one document of so many, and so many shingles at most, tell which shingles are common.
SAMPLE, RANKED = 16, 100_000
#: Each round compares so many times more members of a bucket with the rest.
ROUND = 8
#: Up to so many ids or first members are sent to the rows; for more, both are dealt out by key.
SENT = 20_000
#: Up to so many shared shingles, or ids of documents, are.
SENT_KEYS = 1_000_000
#: Members of a bucket are ranked in so many parts, of which the best so many meet.
SALTS, LEADERS = 64, 64
#: Of products of a similarity and a count.
SLACK = 1e-9
#: Shingles whose bits are counted at once.
SLICE = 1 << 15


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def hashes(text: str, shingle: int) -> np.ndarray:
    """Of the shingles in order, repeats included; a shorter text is one shingle, an empty one none."""
    import xxhash

    words = text.encode("utf-8").lower().split()
    if len(words) < shingle:
        grams = iter([b" ".join(words)] if words else [])
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), "<u8")


def fingerprint(text: str, shingle: int) -> int:
    """As a signed 64-bit integer."""
    return majority(hashes(text, shingle))


def majority(hashed: np.ndarray) -> int:
    """The bits that over half of the hashes have, as a signed 64-bit integer; 0 for none."""
    if not len(hashed):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashed), SLICE):
        part = hashed[at : at + SLICE]
        counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    packed = np.packbits(counts * 2 > len(hashed), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint long).  Null texts and texts without a word have fingerprint 0."""
    small_batches(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"_id": frame["_id"], "fingerprint": [fingerprint(t, shingle) for t in frame["_text"]]})

    out = docs.select(id_as_text(id_col), text_or_empty(text_col).alias("_text")).mapInPandas(run, "_id string, fingerprint long")
    return id_restored(out, docs, id_col)


def covering_masks(radius: int) -> list[int]:
    """For each table, the bits that it keeps."""
    vectors = [i % ((1 << (radius + 1)) - 1) + 1 for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (vectors[i] & v).bit_count() % 2) for v in range(1, 1 << (radius + 1))]


def _pairs(grouped: DataFrame, members: str, radius: int) -> DataFrame:
    """Different fingerprints of a group within the radius, smaller first."""
    left = grouped.select(F.posexplode(members).alias("_i", "x"), F.col(members))
    near = F.filter(F.expr(f"slice({members}, _i + 2, size({members}))"), lambda y: F.bit_count(y["fp"].bitwiseXOR(F.col("x.fp"))) <= radius)
    return left.select("x", F.explode(near).alias("y")).select(F.col("x.fp").alias("fp_a"), F.col("y.fp").alias("fp_b"), F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))


def links(classes: DataFrame, radius: int = 2, every: bool = False) -> DataFrame:
    """Pairs of classes (fp, rep) within the radius: (fp_a, fp_b, a, b).

    With ``every``, all of them.  Else a full bucket gives, for each point, the pairs of the
    smallest fingerprint around it with the others: they reach the same components, and their
    number stays in proportion to the classes.
    """
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even")
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for t, m in enumerate(masks)])
    placed = materialize(classes.select("fp", "rep", F.explode(tables).alias("_b")).select("_b.t", "_b.k", "fp", "rep"))
    full = materialize(placed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"))
    placed = materialize(keyed_join(placed, full, ["t", "k"], "c", placed.count()))
    one = F.struct("fp", "rep").alias("m")
    small = placed.filter(F.col("c") <= BUCKET).groupBy("t", "k").agg(F.sort_array(F.collect_list(one)).alias("ms"))
    found = _pairs(small, "ms", radius)
    large = placed.filter(F.col("c") > BUCKET)

    def around(mask: int) -> Column:
        free = [i for i in range(BITS) if not mask >> i & 1]
        moves = [0, *(sum(1 << i for i in c) for n in range(1, radius // 2 + 1) for c in combinations(free, n))]
        return F.array(*[F.lit(_signed(m)) for m in moves])

    moves = F.element_at(F.array(*[around(m) for m in masks]), F.col("t") + 1)
    points = large.select("t", "fp", "rep", F.explode(moves).alias("d")).select("t", F.col("fp").bitwiseXOR(F.col("d")).alias("k"), "fp", "rep")
    if every:
        balls = points.groupBy("t", "k").agg(F.sort_array(F.collect_list(one)).alias("ms")).filter("size(ms) > 1")
        return found.unionByName(_pairs(balls, "ms", radius)).distinct()
    lowest = points.groupBy("t", "k").agg(F.min(one).alias("y"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    tied = points.join(lowest, ["t", "k"]).filter("rep <> y.rep").select(F.col("y.fp").alias("fp_a"), F.col("fp").alias("fp_b"), F.col("y.rep").alias("a"), F.col("rep").alias("b")).distinct()
    return found.unionByName(tied).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id): the smallest id reachable over links, itself included.

    Every row is returned, repeated rows too.  A null id belongs to its class but names none.
    An empty table gives an empty one; a very long text is read whole.  Columns other than the id and the
    text are ignored, whatever their names.
    """
    prints = materialize(fingerprints(docs, shingle, id_col, text_col).toDF("id", "fingerprint"))
    classes = materialize(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("c")))
    roots = components(links(classes, radius), "a", "b")
    of = classes.join(roots, F.col("rep") == F.col("node"), "left").select(F.col("fp").alias("fingerprint"), F.coalesce("root", "rep").alias("component_id"), "c")
    out = keyed_join(prints, materialize(of), ["fingerprint"], "c", prints.count())
    return out.select(F.col("id").alias(id_col), "fingerprint", "component_id")


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(n, h): the different word shingles of the documents ``wanted`` (n); an id with several texts has several rows."""
    small_batches(docs.sparkSession)
    few = F.broadcast(wanted) if wanted.count() <= SENT_KEYS else wanted
    texts = docs.select(F.col(id_col).alias("n"), text_or_empty(text_col).alias("_text")).join(few, "n", "left_semi")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"_id": frame["_id"], "h": [np.unique(hashes(t, words)).view("<i8") for t in frame["_text"]]})

    sets = id_restored(texts.select(id_as_text("n"), "_text").mapInPandas(run, "_id string, h array<long>"), docs, id_col)
    return sets.select(F.col(id_col).alias("n"), "h")


def similar(found: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of which ``sets`` (n, h) have a Jaccard similarity of ``least`` or more."""
    both = found.join(sets.select(F.col("n").alias("a"), F.col("h").alias("x")), "a").join(sets.select(F.col("n").alias("b"), F.col("h").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(shared >= least * (F.size("x") + F.size("y") - shared) - SLACK).select("a", "b").distinct()


def common_shingles(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a sample have, ascending, and in how many; it serves to order shingles only."""
    small_batches(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"h": [np.unique(hashes(t, words)).view("<i8") for t in frame["_text"]]})

    sample = docs.filter(F.pmod(F.xxhash64(id_col), F.lit(SAMPLE)) == 0).select(text_or_empty(text_col).alias("_text"))
    seen = sample.mapInPandas(run, "h array<long>").select(F.explode("h").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    rows = seen.orderBy(F.desc("c"), "h").limit(RANKED).toArrow()
    h, c = (rows.column(k).to_numpy() for k in ("h", "c"))
    order = np.argsort(h)
    return h[order], c[order]


def _placed(posts: DataFrame) -> DataFrame:
    """Adds ``k``, the place of a post in its bucket from 0: those of the greatest weight first.

    The best of each salt are ranked against each other, the others behind them by their rank within
    their salt, so a full bucket is sorted by many tasks; places are all different, and exact for
    the first LEADERS.
    """
    best = [F.desc("w"), F.xxhash64("id"), "id", "n", "at"]
    salted = posts.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(SALTS)).cast("int"))
    salted = materialize(salted.withColumn("r", F.row_number().over(Window.partitionBy("h", "salt").orderBy(*best))))
    first = salted.filter(F.col("r") <= LEADERS).withColumn("k", F.row_number().over(Window.partitionBy("h").orderBy(*best)) - 1)
    rest = salted.filter(F.col("r") > LEADERS).withColumn("k", F.col("r") * SALTS + F.col("salt"))
    return first.unionByName(rest).drop("salt", "r")


def _lowered(links: DataFrame) -> DataFrame:
    """(node, root) with the smallest node within three links: enough to tell most that are connected."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).select("node", F.least("node", "root").alias("root"))
    for _ in range(2):
        theirs = both.join(roots, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("r"))
        roots = roots.join(theirs, F.col("node") == F.col("a")).select("node", F.least("root", "r").alias("root"))
    return materialize(roots)


def near_fingerprints(prints: DataFrame, radius: int) -> DataFrame:
    """(a, b) with a < b of (id, fp): ids tied by equal fingerprints or by ``links`` of classes within the radius."""
    groups = materialize(prints.groupBy("fp").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("c")))
    equal = keyed_join(prints, groups, ["fp"], "c", prints.count()).select(F.col("rep").alias("a"), F.col("id").alias("b"))
    ties = links(groups.select("fp", "rep"), radius).select("a", "b").unionByName(equal)
    return materialize(ties.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())


def joined_roots(posts: DataFrame, least: float, sets_of: Callable[[DataFrame], DataFrame], first: DataFrame | None = None) -> DataFrame | None:
    """(node, root) of the components of all pairs with a Jaccard similarity of ``least`` or more.

    ``posts`` (h, id, n, at) lists each set under the shingles of its prefix: its size, and the place
    of the shingle in the common order; ``sets_of`` gives the whole sets (n, h) of ids (n).  In rounds, the first members of each bucket are compared with
    all later members that are not seen to be connected to them, and then leave the bucket.  A bucket
    is done when its members are seen to be connected.  So each pair of a bucket is either compared or known to
    be connected, and a group of near copies costs pairs in proportion to its members.  Members go by
    how many others share their prefix, so that the middle of a group comes first.  The first round compares the
    candidates ``first`` (a, b) too.  None without links.
    """
    often = materialize(posts.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"))
    rows, shared = often.agg(F.sum("c"), F.count(F.lit(1))).first()
    # Most shingles are in one set only: their posts go where they are made, if the others' keys can be sent there.
    posts = posts.join(F.broadcast(often), "h") if shared <= SENT_KEYS else keyed_join(posts, often, ["h"], "c", rows)
    posts = materialize(posts.distinct())
    release(posts.sparkSession)
    weight = posts.groupBy("id").agg(F.sum("c").alias("w"))
    placed = materialize(_placed(posts.join(weight, "id")).select("h", "id", "n", "at", "k"))
    release(posts.sparkSession)
    live = placed.withColumn("root", F.col("id"))
    tried = links = every = None
    last = 1
    while True:
        # Both sides of these joins are tables, so a hot bucket is split where the engine deals skewed joins anew.
        mixed = materialize(live.groupBy("h").agg(F.min("root").alias("l"), F.max("root").alias("m")).filter("l <> m").select("h"))
        live = materialize(live.join(mixed, "h", "left_semi"))
        leaders = live.filter(F.col("k") < last)
        many = leaders.count()
        if not many and live.isEmpty():
            return None if links is None else components(links, "a", "b")
        p, q = (F.broadcast(leaders) if many <= SENT else leaders).alias("p"), live.alias("q")
        # The first common shingle of a similar pair leaves room for the shared shingles that they need.
        room = F.least(F.col("p.n") - F.col("p.at"), F.col("q.n") - F.col("q.at"))
        fits = (1 + least) * room >= least * (F.col("p.n") + F.col("q.n")) - SLACK
        pairs = q.join(p, (F.col("p.h") == F.col("q.h")) & (F.col("p.k") < F.col("q.k")) & (F.col("p.root") != F.col("q.root")) & fits)
        pairs = pairs.select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b"))
        pairs = (pairs if tried is not None or first is None else pairs.unionByName(first)).distinct()
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        live = live.filter(F.col("k") >= last)
        last = (last + 1) * ROUND
        tried = pairs if tried is None else tried.unionByName(pairs)
        wanted = pairs.select(F.col("a").alias("n")).unionByName(pairs.select(F.col("b").alias("n"))).distinct()
        wanted = materialize(wanted)
        # Whole sets are the widest rows here: made anew for the ids of a round, if these can be sent to the texts, else once for all.
        if every is None and wanted.count() > SENT_KEYS:
            every = materialize(sets_of(placed.select(F.col("id").alias("n")).distinct()))
        with stored(sets_of(wanted) if every is None else every.join(wanted, "n", "left_semi")) as sets:
            good = materialize(similar(pairs, sets, least))
        release(good.sparkSession)
        if good.isEmpty():
            continue
        links = good if links is None else links.unionByName(good)
        live = live.drop("root").join(_lowered(links), F.col("id") == F.col("node"), "left").select("h", "id", "n", "at", "k", F.coalesce("root", "id").alias("root"))


def deduplicate(docs: DataFrame, words: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """docs with one document, that of the smallest id, for each group of near copies.

    Documents are linked if they share ``least`` of their different ``words``-word shingles (Jaccard); groups
    are the connected components of all such links.  Candidates come from the fingerprints first: documents within ``radius`` bits, by
    the tables of ``links``.  Fingerprints alone lose such pairs, so the rest is found exactly: with the shingles of every
    document in one common order, rare ones first, two similar documents have a shingle in common among the
    first n - ceil(least n) + 1 of their n.  The order comes from a sample; it changes the work, not the result.
    Documents with equal sets of shingles are one class, compared by its smallest id.
    Texts without a word are one class.  All columns are kept, whatever their names.  Rows with a null id
    stay; rows that repeat an id are one document and stay or go together.  A very long text is compared as a
    whole; an empty table gives an empty one.
    """
    import math

    hid, names = hidden(docs)
    key = names[id_col]
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    common, often = common_shingles(known, words, "id", "text")
    small_batches(docs.sparkSession)

    def row(text: str) -> tuple:
        import xxhash

        hashed = hashes(text, words)
        own = np.unique(hashed).view("<i8")
        key = xxhash.xxh3_128_digest(own.tobytes())
        first = len(own) - math.ceil(least * len(own) - SLACK) + 1 if len(own) else 0
        count = np.zeros(len(own), np.int64)
        if len(common):
            at = np.minimum(np.searchsorted(common, own), len(common) - 1)
            count = np.where(common[at] == own, often[at], 0)
        return key, majority(hashed), len(own), own[np.lexsort((own, count))[:first]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = pd.DataFrame([row(t) for t in frame["_text"]], columns=["_key", "fp", "_n", "_first"])
            out.insert(0, "_id", frame["_id"].to_numpy())
            yield out

    prints = known.select(id_as_text("id"), text_or_empty("text").alias("_text")).mapInPandas(run, "_id string, _key binary, fp long, _n int, _first array<long>")
    prints = materialize(id_restored(prints, known, "id"))
    classes = materialize(prints.groupBy("_key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("c")))
    # Copies are not compared: they are left out where they stand, if they are few enough to be sent there.
    copies = keyed_join(prints.select("id", "_key"), classes.filter("c > 1"), ["_key"], "c", prints.count()).filter("id <> rep")
    copies = materialize(copies.select("_key", "id").distinct())
    own = prints.join(F.broadcast(copies) if copies.count() <= SENT_KEYS else copies, ["_key", "id"], "left_anti")
    posts = own.select("id", F.col("_n").alias("n"), F.posexplode("_first").alias("at", "h"))
    tied = near_fingerprints(own.select("id", "fp"), radius)
    release(docs.sparkSession)
    roots = joined_roots(posts, least, lambda wanted: shingle_sets(known, wanted, words, "id", "text"), tied)
    of = classes.withColumn("_keep", F.col("rep")) if roots is None else classes.join(roots, F.col("rep") == F.col("node"), "left").withColumn("_keep", F.coalesce("root", "rep"))
    kept = keyed_join(prints.select("id", "_key"), materialize(of.select("_key", "_keep", "c")), ["_key"], "c", prints.count())
    gone = kept.filter(F.col("id") != F.col("_keep")).select(F.col("id").alias("_gone")).distinct()
    return hid.join(gone, F.col(key) == F.col("_gone"), "left_anti").select(*shown(names))
