"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

Documents are encoded by the ``tokenizers`` library and end with the id 0; longer ones than a
sequence are cut, the remainder first.  Pieces are range-sorted by length and ranked within their
length.  Packing works on runs: all pieces of one length that are left, as an interval of
ranks, and all sequences that were made alike, as an interval of sequences with one gap.

A round is one sweep over the runs, sorted by size, largest first; a Spark job does ``ROUNDS`` of
them and writes the runs to the checkpoint folder.  The sweep finds the successor of every run of pieces: the smallest gap that holds it and that no longer piece took in
this sweep.  Where pieces compete for a gap, rank decides: the longest first, then the lowest
rank.  A gap takes one piece a round, or up to half of what fits if pieces are that small.  Gaps are updated,
and the next round starts from them.  Pieces over half a sequence go first, then those over
a quarter, then all.  What finds no gap opens new sequences: one for each piece over half a
sequence, else as many as their tokens fill.  A distributed join by length and rank carries the
matches back to the rows.  There are at most as many runs of pieces as a sequence has tokens,
however many rows, and a round adds at most as many matches as it has runs.

Null texts count as empty: the piece is the single id 0.  Repeated rows, repeated ids and null ids
are packed each by itself; which of several pieces alike in length goes where is arbitrary but
fixed.  A very long text is cut like any other.  Columns other than the id and the text are
ignored, whatever their names.  An empty table gives an empty one.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_rank, id_as_text, id_restored, materialize, small_batches, text_or_empty

CAPACITY = 2048
END = 0
#: Kinds of bytes: a space; other white space of one byte; letters (ASCII, and Latin ones of the lead bytes C3 to C8); digits;
#: signs of ASCII; then what is not cut into words here: apostrophes, white space of several bytes, all the rest.
BLANK, WHITE, LETTER, DIGIT, SIGN, APOSTROPHE, WIDE, OTHER = range(8)
WORDS = (LETTER, DIGIT, SIGN)
#: What the tokenizer's pattern counts as white space of several bytes: the bytes after each lead byte.
WIDE_SPACES: dict[int, list[bytes]] = {}
for _code in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
    WIDE_SPACES.setdefault(chr(_code).encode()[0], []).append(chr(_code).encode()[1:])
#: The pre-tokenizer whose words the cuts find.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
#: Chunks whose ids a worker remembers.
REMEMBERED = 1 << 18
#: Bytes of text that are cut at a time.
BLOCK = 1 << 22
#: The byte between words that go to the model together: no UTF-8 text has it.
BETWEEN = 0xFF
#: Pieces longer than these parts of a sequence are placed before the shorter ones.
CLASSES = (0.5, 0.25, 0.0)
#: Rounds of a job.
ROUNDS = 8


def byte_letters() -> np.ndarray:
    """The character that byte-level models have for each byte; a line feed, which they have for none, for ``BETWEEN``."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hid = iter(range(256, 512))
    return np.array([b if b in shown else next(hid) for b in range(255)] + [10], "<u4")


def byte_kinds() -> np.ndarray:
    def kind(b: int) -> int:
        c = chr(b)
        if b >= 0x7F or b < 9 or 13 < b < 32:
            return LETTER if 0xC3 <= b <= 0xC8 else OTHER
        return BLANK if c == " " else WHITE if b < 32 else LETTER if c.isalpha() else DIGIT if c.isdigit() else APOSTROPHE if c == "'" else SIGN

    return np.array([kind(b) for b in range(256)], np.uint8)


def pair_cuts() -> tuple[np.ndarray, np.ndarray]:
    """For 8 * the kind of a byte + that of the next one: whether the text is cut between them; whether it is if no white space follows."""
    white = (BLANK, WHITE, WIDE)
    always, before_last = np.zeros(64, bool), np.zeros(64, bool)
    for a in range(8):
        for b in range(8):
            starts_run = a not in white and b in white
            after_run = a == WHITE and b not in white
            words = a in WORDS and b in WORDS and a != b or a in (LETTER, DIGIT) and b == APOSTROPHE
            always[8 * a + b] = starts_run or after_run or words
            before_last[8 * a + b] = a in white and b in (BLANK, WHITE)
    return always, before_last


KINDS = byte_kinds()
CUT, CUT_BEFORE_LAST = pair_cuts()


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; all bytes of a character have the same."""
    out = KINDS[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))
    lead = lead[lead + 1 < len(data)]
    follows = data[lead + 1]
    out[lead + 1] = LETTER
    sign = lead[(data[lead] == 0xC3) & ((follows == 0x97) | (follows == 0xB7))]  # the signs of multiplication and division
    out[sign] = out[sign + 1] = OTHER
    for first, rests in WIDE_SPACES.items():
        lead = np.flatnonzero(data == first)
        more = len(rests[0])
        lead = lead[lead + more < len(data)]
        for rest in rests if len(lead) else ():
            at = lead[np.logical_and.reduce([data[lead + 1 + i] == c for i, c in enumerate(rest)])]
            for i in range(more + 1):
                out[at + i] = WIDE
    return out


def cuts(kind: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the chunks of texts start, given the kinds of their bytes and where texts start.

    The tokenizer's pattern starts a word at each of these places, whatever comes before: where a run of
    white space starts, before its last character if more follows in the text, and after that unless it is a space, which belongs to
    what follows; between letters, digits and signs, and before an apostrophe after letters or digits.
    """
    pair = (kind[:-1] << 3) | kind[1:]
    out = np.zeros(len(kind) + 1, bool)
    out[1:-1] = CUT[pair]
    new = np.zeros(len(kind) + 1, bool)
    new[starts] = new[-1] = True
    last = np.flatnonzero(CUT_BEFORE_LAST[pair]) + 1
    last = last[~new[last + 1]]
    after = kind[last + 1]
    out[last[(after != BLANK) & (after != WHITE) & (after != WIDE)]] = True
    return np.flatnonzero((out | new)[:-1])


class Encoder:
    """Ids of texts by the ``tokenizers`` library, with the ids of frequent chunks remembered.

    Texts are cut where the tokenizer's pattern always starts a new word (``cuts``), so the ids of the chunks joined are the ids of
    the text.  Each different chunk of a block is encoded once.  Those that are one word of the pattern go to the library's model,
    all new ones of a block in one call; the others (apostrophes, other scripts) go through the whole tokenizer.  Texts with an
    added token's content are encoded in one go, and so are all texts if the tokenizer has another pre-tokenizer or a normalizer.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        made_of = json.loads(self.tokenizer.to_str())
        self.by_words = not any(made_of[k] for k in ("normalizer", "truncation", "padding")) and BYTE_LEVEL.items() <= (made_of["pre_tokenizer"] or {}).items()
        #: The model alone: words in the letters of byte-level models, between line feeds.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        #: Bytes of each token.
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.known: dict[bytes, bytes] = {}
        #: Marks, by hash, of what has come before.
        self.met = bytearray(1 << 23)

    def plain(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of the pattern, by the model: the sizes of the tokens tell where a word ends."""
        if not words:
            return []
        shown = self.letters[np.frombuffer(bytes([BETWEEN]).join(words), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.asarray(self.model.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
        reached = np.cumsum(self.sizes[ids])
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        last = np.searchsorted(reached, ends)
        if not len(ids) or reached[-1] != ends[-1] or (reached[last] != ends).any():
            return self.plain([w.decode() for w in words])  # a model whose tokens are not the bytes of the word
        raw, to = ids.tobytes(), (4 * (last + 1)).tolist()
        return [raw[a:b] for a, b in zip([0, *to], to)]

    def remember(self, chunk: bytes, ids: bytes) -> None:
        """Short ones that come in a second block (or seem to): most come only once, and would fill the memory."""
        if len(self.known) < REMEMBERED and len(chunk) <= 32:
            at = hash(chunk) & (len(self.met) - 1)
            if self.met[at]:
                self.known[chunk] = ids
            else:
                self.met[at] = 1

    def block(self, data: np.ndarray, starts: np.ndarray, final: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where chunks start and the last one ends, ids, how many of them before each of these places).

        If more of the data follows, the chunks end where the last cut is sure.
        """
        if self.by_words:
            kind = kinds(data)
            at = cuts(kind, starts)
            if not final:  # what follows the last bytes is not seen
                at = at[at < len(data) - 8]
        else:
            kind, at = np.full(len(data), OTHER, np.uint8), np.unique(starts)
        if final:
            at = np.append(at, len(data))
        many = len(at) - 1
        if many < 1:
            return at, np.empty(0, "<u4"), np.zeros(len(at), np.int64)
        chunks = pa.Array.from_buffers(pa.binary(), many, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        which, different = chunks.indices.to_numpy(), chunks.dictionary.to_pylist()
        odd = np.empty(len(different), bool)
        odd[which] = np.maximum.reduceat(kind[: at[-1]], at[:-1]) >= APOSTROPHE
        held = list(map(self.known.get, different))
        new = [i for i, ids in enumerate(held) if ids is None]
        simple, others = [i for i in new if not odd[i]], [i for i in new if odd[i]]
        made = self.words([different[i] for i in simple]) + self.plain([different[i].decode() for i in others])
        for i, ids in zip(simple + others, made, strict=True):
            held[i] = ids
            self.remember(different[i], ids)
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        first = np.cumsum(sizes) - sizes
        each = sizes[which]
        before = np.concatenate([[0], np.cumsum(each)])
        ids = np.frombuffer(b"".join(held), "<u4")[np.repeat(first[which] - before[:-1], each) + np.arange(before[-1])]
        return at, ids, before

    def joined(self, data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where those of each text start and the last end), given the texts joined and where each starts and the last ends."""
        raw = np.frombuffer(data, np.uint8)
        bounds, parts, low, total, length = np.zeros(len(starts), np.int64), [], 0, 0, BLOCK
        while low < len(raw):
            high = min(low + length, len(raw))
            own = starts[np.searchsorted(starts, low) : np.searchsorted(starts, high)] - low
            at, ids, before = self.block(raw[low:high], np.append(0, own), high == len(raw))
            if len(at) < 2:  # no cut in the block
                length *= 2
                continue
            i, j = np.searchsorted(starts, [low, low + at[-1]])
            bounds[i:j] = total + before[np.searchsorted(at, starts[i:j] - low)]
            parts.append(ids)
            total += len(ids)
            low, length = low + int(at[-1]), BLOCK
        bounds[np.searchsorted(starts, len(raw)) :] = total
        return np.concatenate(parts) if parts else np.empty(0, "<u4"), bounds

    def encode_joined(self, data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``joined``, for texts that may have an added token's content."""
        if not any(a in data for a in self.added):
            return self.joined(data, starts)
        texts = [data[a:b] for a, b in zip(starts.tolist(), starts[1:].tolist())]
        whole = [any(a in t for a in self.added) for t in texts]
        entire = iter(self.plain([t.decode() for t, w in zip(texts, whole, strict=True) if w]))
        rest = [b"" if w else t for t, w in zip(texts, whole, strict=True)]
        ids, at = self.joined(b"".join(rest), np.cumsum([0, *map(len, rest)]))
        out = [np.frombuffer(next(entire), "<u4") if w else ids[a:b] for w, a, b in zip(whole, at, at[1:])]
        return np.concatenate(out), np.cumsum([0, *map(len, out)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        raw = [t.encode() for t in texts]
        ids, at = self.encode_joined(b"".join(raw), np.cumsum([0, *map(len, raw)]))
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:])]


@functools.cache
def encoder(path: str) -> Encoder:
    """Once for each worker."""
    return Encoder(path)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than a sequence."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32)."""
    small_batches(docs.sparkSession)
    end = np.asarray([END], "<u4").tobytes()
    kind = pa.schema([("_id", pa.string()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def rows(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        texts = table["_text"].cast(pa.large_binary()).combine_chunks()
        starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        data = held.slice(starts[0], starts[-1] - starts[0]).to_pybytes() if held else b""
        ids, at = encoder(tokenizer_path).encode_joined(data, starts - starts[0])
        out = []
        for i, a, b in zip(table["_id"].to_pylist(), at.tolist(), at[1:].tolist(), strict=False):
            own = ids[a:b].tobytes() + end
            out.extend((i, k, low, n, zlib.crc32(own[4 * low : 4 * (low + n)])) for k, (low, n) in enumerate(cut(len(own) // 4, capacity)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kind, strict=True)], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= BLOCK:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)

    out = docs.select(id_as_text(id_col), text_or_empty(text_col).alias("_text")).mapInArrow(run, "_id string, piece int, start long, length long, ids_crc32 long")
    return id_restored(out, docs, id_col)


#: Runs by kind: PIECES of length ``size`` with ranks ``low`` to below ``high``; sequences ``low``
#: to below ``high`` with a GAP of ``size``; a MATCH of pieces of length ``size`` and ranks ``low`` to
#: below ``high``, ``each`` to a sequence, from ``sequence`` on, at ``offset``; ``low`` sequences OPENED.
PIECES, GAP, MATCH, OPENED = range(4)
RUN = "kind int, size long, low long, high long, each long, sequence long, offset long"
COLUMNS = ["kind", "size", "low", "high", "each", "sequence", "offset"]


def sweep(runs: list[tuple[int, ...]], capacity: int) -> list[tuple[int, ...]]:
    """One round over (kind, size, low, high, ...) of pieces, gaps and the count of opened sequences."""
    pieces_left = [(r[1], r[2], r[3]) for r in runs if r[0] == PIECES]
    gaps = [(r[1], r[2], r[3]) for r in runs if r[0] == GAP]
    opened = sum(r[2] for r in runs if r[0] == OPENED)
    least = next((c * capacity for c in CLASSES if any(size > c * capacity for size, _, _ in pieces_left)), 0)
    order = sorted([(-size, 0, low, high) for size, low, high in gaps] + [(-size, 1, low, high) for size, low, high in pieces_left if size > least])
    out = [(PIECES, size, low, high, 0, 0, 0) for size, low, high in pieces_left if size <= least]
    free: list[tuple[int, int, int]] = []  # smallest gap last
    waiting: list[tuple[int, int]] = []
    matched = 0
    for negative, kind, low, high in order:
        size = -negative
        if kind == 0:
            free.append((size, low, high))
            continue
        while low < high and free:
            gap, first, last = free.pop()
            each = min(high - low, max(1, gap // (2 * size)))
            many = min(last - first, (high - low) // each)
            out.append((MATCH, size, low, low + many * each, each, first, capacity - gap))
            if gap > each * size:
                out.append((GAP, gap - each * size, first, first + many, 0, 0, 0))
            if first + many < last:
                free.append((gap, first + many, last))
            low += many * each
            matched += many * each
        if low < high:
            out.append((PIECES, size, low, high, 0, 0, 0))
            waiting.append((size, high - low))
    out.extend((GAP, *f, 0, 0, 0) for f in free)
    if waiting and not matched:
        large = sum(n for size, n in waiting if 2 * size > capacity)
        new = large or -(-sum(size * n for size, n in waiting) // capacity)
        out.append((GAP, capacity, opened, opened + new, 0, 0, 0))
        opened += new
    out.append((OPENED, 0, opened, 0, 0, 0, 0))
    return out


def match(runs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Matches of all runs of pieces (RUN rows of kind PIECES), by rounds until no piece is left."""

    def rounds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [tuple(r) for frame in frames for r in frame.to_numpy().tolist()]
        for _ in range(ROUNDS):
            if any(r[0] == PIECES for r in rows):
                rows = [r for r in rows if r[0] == MATCH] + sweep(rows, capacity)
        yield pd.DataFrame(rows, columns=COLUMNS)

    state = materialize(runs.select(*COLUMNS).coalesce(1))
    while not state.filter(F.col("kind") == PIECES).isEmpty():
        state = materialize(state.sortWithinPartitions(F.desc("size"), "kind", "low").mapInPandas(rounds, RUN))
    return state.filter(F.col("kind") == MATCH)


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """Adds sequence_id and offset to (id, piece, start, length, ids_crc32)."""
    small_batches(cut_pieces.sparkSession)
    held = materialize(cut_pieces.withColumn("_own", -1 - F.monotonically_increasing_id()))
    whole = held.filter(F.col("length") == capacity).select(*cut_pieces.columns, F.col("_own").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    ranked, placed = global_rank(held.filter(F.col("length") < capacity).drop("_own"), ["length"], ["ids_crc32", id_col, "piece"])
    none = F.lit(0).cast("long")
    runs = placed.groupBy("length").agg(F.sum("_n").alias("n")).select(F.lit(PIECES).alias("kind"), F.col("length").alias("size"), none.alias("low"), F.col("n").alias("high"), *[none.alias(c) for c in COLUMNS[4:]])
    table = match(runs, capacity).select(F.col("size").alias("l"), *COLUMNS[2:])
    meets = (F.col("length") == F.col("l")) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    nth = F.col("_rank") - F.col("low")
    # The table has at most as many rows as runs were swept: its size follows from the capacity.
    found = ranked.join(F.broadcast(table), meets).select(
        *cut_pieces.columns,
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("offset") + F.pmod(nth, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )
    return found.unionByName(whole)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row."""
    return pack(pieces(docs, tokenizer_path, capacity, id_col, text_col), capacity, id_col)
