"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs (lines).  Every paragraph is hashed to one wide
vector and the document's fingerprint is the sum of these vectors:

- ``EXACT`` lanes modulo 2^64 from a 512-bit hash of the paragraph: equal multisets, and no
  others in practice, have equal lanes, in whatever order the paragraphs stand;
- ``SKETCH`` lanes modulo 2^32: each run of three words adds +1 or -1 to one lane, both hashed,
  so that the cosine of two sums estimates how much of the texts is common.  A text has fewer than
  2^31 bytes, so no lane of a text wraps.

Sums can be added and subtracted: inserting or deleting a paragraph adds or subtracts its vector.

Null texts count as empty; the empty text is one empty paragraph.  Texts without a word are alike.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_as_text, id_restored, small_batches, text_or_empty

EXACT = 8
SKETCH = 256
SEED = 7
#: Bytes of text in a range of ids, and how many ranges there are at most.
RANGE_BYTES = 16 << 20
MOST_RANGES = 50_000


class Fingerprint:
    """A sum of paragraph vectors."""

    __slots__ = ("exact", "sketch")

    def __init__(self, exact: np.ndarray | None = None, sketch: np.ndarray | None = None) -> None:
        self.exact = np.zeros(EXACT, np.uint64) if exact is None else exact
        self.sketch = np.zeros(SKETCH, np.int32) if sketch is None else sketch

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        return cls.of_paragraphs(text.split("\n"))

    @classmethod
    def of_paragraphs(cls, paragraphs: list[str]) -> Fingerprint:
        import xxhash

        digests, hashes = [], []
        for paragraph in paragraphs:
            raw = paragraph.encode("utf-8")
            digests.append(hashlib.blake2b(raw, digest_size=8 * EXACT).digest())
            words = [b"", b"", *raw.split()]
            hashes.extend(xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in zip(words, words[1:], words[2:], strict=False))
        exact = np.frombuffer(b"".join(digests), "<u8").reshape(-1, EXACT).sum(0, dtype=np.uint64)
        h = np.array(hashes, np.uint64)
        signs = np.where(h >> np.uint64(63), 1.0, -1.0)
        sums = np.bincount((h % np.uint64(SKETCH)).astype(np.int64), signs, SKETCH).astype(np.int64)
        return cls(exact, sums.astype(np.int32))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.sketch + other.sketch)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.sketch - other.sketch)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and bool((self.exact == other.exact).all()) and bool((self.sketch == other.sketch).all())

    __hash__ = None

    def hex(self) -> str:
        return self.exact.astype("<u8").tobytes().hex() + self.sketch.astype("<i4").tobytes().hex()

    def likeness(self, other: Fingerprint) -> float:
        """Cosine of the sketches, from 0 to 1; 1 for equal fingerprints and for two without a word."""
        if self == other or not (self.sketch.any() or other.sketch.any()):
            return 1.0
        a, b = self.sketch.astype(float), other.sketch.astype(float)
        norm = float(np.sqrt((a @ a) * (b @ b)))
        return min(1.0, max(0.0, float(a @ b) / norm)) if norm else 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next document."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint hex)."""
    small_batches(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"_id": frame["_id"], "fingerprint": [Fingerprint.of(t).hex() for t in frame["_text"]]})

    out = docs.select(id_as_text(id_col), text_or_empty(text_col).alias("_text")).mapInPandas(run, "_id string, fingerprint string")
    return id_restored(out, docs, id_col)


def _order(key: int | str | None, text_hash: int) -> tuple:
    """Sorts like (id with nulls first, hash)."""
    return (0, 0, text_hash) if key is None else (1, key, text_hash)


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit with the next document by ascending id.

    Each row needs the text after it in the order of ids.  Texts are dealt once into ranges of
    (id, hash of the text), about ``RANGE_BYTES`` each, the first text of a range is also dealt to the range
    before it, and each range is then read in order, one row at a time.  The first row follows the last.  Of an edit only
    the paragraphs from the cut on are hashed again: their old vectors are subtracted and the new ones
    added.  Whole numbers are ordered as such, other ids as text.  Null ids come first; rows with equal
    ids are ordered by the hash of their text, so many of them make several ranges.  Columns other than the
    id and the text are ignored, whatever their names.  An empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    whole_numbers = docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long")
    key = F.col(id_col).cast("long" if whole_numbers else "string").alias("_key")
    whole = docs.select(key, id_as_text(id_col), text_or_empty(text_col).alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    size = whole.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    parts = min(MOST_RANGES, 1 + size // RANGE_BYTES)
    sorted_keys = whole.select("_key", "_hash").repartitionByRange(parts, "_key", "_hash").withColumn("_part", F.spark_partition_id())
    lowest = sorted_keys.groupBy("_part").agg(F.min(F.struct("_key", "_hash")).alias("m")).collect()  # a row for each range
    bounds = sorted(_order(r["m"]["_key"], r["m"]["_hash"]) for r in lowest)
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("long")
    def placed(keys: pd.Series, hashes: pd.Series) -> pd.Series:
        """Twice the range, plus one for rows that open it."""
        places = []
        for k, h in zip(keys, hashes, strict=True):
            own = _order(None if k is None else int(k) if whole_numbers else k, int(h))
            at = max(0, bisect.bisect_right(shared.value, own) - 1)
            places.append(2 * at + (shared.value[at] == own))
        return pd.Series(places, dtype="int64")

    place = placed(F.col("_key").cast("string"), "_hash")
    own = whole.select("*", place.alias("_place")).select("*", F.shiftright("_place", 1).cast("int").alias("_range"), F.lit(0).alias("_extra"))
    opening = own.filter(F.col("_place") % 2 == 1).groupBy("_range").agg(F.min(F.struct("_text", "_id")).alias("m"))
    before = F.pmod(F.col("_range") - 1, F.lit(max(1, len(bounds)))).cast("int")
    nexts = opening.select(F.lit(None).cast(own.schema["_key"].dataType).alias("_key"), "m._id", "m._text", F.lit(0).cast("long").alias("_hash"), before.alias("_range"), F.lit(1).alias("_extra"))
    dealt = own.drop("_place").unionByName(nexts).repartitionById(max(1, len(bounds)), F.col("_range"))
    dealt = dealt.sortWithinPartitions("_range", "_extra", F.col("_key").asc_nulls_first(), "_hash", "_text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple | None = None
        for frame in frames:
            rows = []
            for i, text, place, extra in zip(frame["_id"], frame["_text"], frame["_range"], frame["_extra"], strict=True):
                own = Fingerprint.of(text)
                if held is not None and held[2] == place:
                    rows.append(compare(*held[:2], held[3], text, own))
                held = (i, text, place, own) if not extra else None
            if rows:
                yield pd.DataFrame(rows, columns=["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def compare(i: str, text: str, own: Fingerprint, following: str, theirs: Fingerprint) -> tuple:
        new = edited(text, following)
        same = text.rfind("\n", 0, len(text) - len(text) // 4) + 1  # paragraphs before this stay
        changed = own - Fingerprint.of(text[same:]) + Fingerprint.of(new[same:])
        digest = hashlib.sha256(new.encode("utf-8")).hexdigest()
        return i, len(text), digest, own.hex(), changed.hex(), own.likeness(changed), own.likeness(theirs)

    out = dealt.mapInPandas(run, "_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return id_restored(out, docs, id_col)
