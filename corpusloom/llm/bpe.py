"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of up to ``chunk_chars`` code points is one chunk and is encoded where it stands.
A longer text is cut into chunks that overlap by ``overlap_chars``; the chunks are dealt over
the cluster and pre-tokenised in parallel, each from its own start.  Two neighbours are stitched
at the first pre-token boundary that both have inside the overlap: the pattern looks only
forward, so from a common boundary on both would cut alike.  A match that touches the end of a
chunk is not trusted, as the text that follows could have changed it.  Where the overlap has no
common boundary (a run of thousands of letters), chunks are added to the text from the last trusted boundary
on, and whenever that has doubled it is pre-tokenised again: work stays in proportion to the text.  The stitched
runs of pre-tokens are dealt over the cluster again, encoded by rank in parallel, and their ids joined.

Decoding joins the raw bytes of the ids.

Null texts count as empty and give no ids.  Repeated rows and repeated ids each give their own
row.  Columns other than the id and the text are ignored, whatever their names.  An empty table gives
an empty one.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_as_text, id_restored, small_batches, text_or_empty

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 10


@functools.cache
def encoding(ranks_path: str, pattern: str):
    """The tokenizer, once for each worker."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def matcher(pattern: str):
    import regex

    return regex.compile(pattern)


@functools.cache
def token_bytes(ranks_path: str, pattern: str) -> list[bytes]:
    """Raw bytes by id; an id without a token gives none."""
    enc = encoding(ranks_path, pattern)
    table = [b""] * (enc.max_token_value + 1)
    for token, rank in enc._mergeable_ranks.items():
        table[rank] = token
    return table


def boundaries(pattern: str, text: str) -> list[int]:
    """Starts of the pre-tokens of a text, then its length."""
    return [m.start() for m in matcher(pattern).finditer(text)] + [len(text)]


def chunks_of(text: str, chunk_chars: int, overlap_chars: int) -> Iterator[tuple[int, str]]:
    for start in range(0, max(1, len(text)), chunk_chars):
        yield start, text[start : start + chunk_chars + overlap_chars]


def stitch(pattern: str, chunks: Iterable[tuple[int, str, list[int]]]) -> Iterator[list[str]]:
    """Runs of pre-tokens of the whole text, from (start, text, boundaries inside the chunk) in order."""
    at, text, cuts = 0, "", [0]  # what is not given out yet, and its boundaries as far as it was scanned
    scanned = 0
    for start, new, bounds in chunks:
        if not text:
            at, text, cuts, scanned = start, new, bounds, len(new)
            continue
        theirs = {start + b for b in bounds[:-1]}
        # The last boundary is the end of what was scanned: the text behind it may change it.
        common = next((c for c in cuts[:-1] if at + c >= start and at + c in theirs), None) if scanned == len(text) else None
        if common is not None:
            done = [c for c in cuts if c <= common]
            yield [text[a:b] for a, b in zip(done, done[1:], strict=False)]
            skip = at + common - start
            at, text, cuts = at + common, new[skip:], [b - skip for b in bounds if b >= skip]
            scanned = len(text)
            continue
        text += new[at + len(text) - start :]
        if len(text) >= 2 * scanned:
            cuts, scanned = boundaries(pattern, text), len(text)
            done = cuts[:-1]  # the last pre-token may go on
            yield [text[a:b] for a, b in zip(done, done[1:], strict=False)]
            at, text, cuts = at + done[-1], text[done[-1] :], [0, len(text) - done[-1]]
            scanned = len(text)
    cuts = cuts if scanned == len(text) else boundaries(pattern, text)
    yield [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """(id, n_tokens, ids): ids as little-endian unsigned 32-bit integers in a binary."""
    small_batches(docs.sparkSession)
    whole = docs.select(id_as_text(id_col), text_or_empty(text_col).alias("_text"))
    short = whole.filter(F.length("_text") <= chunk_chars)
    long = whole.filter(F.length("_text") > chunk_chars).withColumn("_row", F.monotonically_increasing_id())

    def encode_short(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(ranks_path, pattern)
        for frame in frames:
            ids = [np.asarray(enc.encode_ordinary(t), "<u4") for t in frame["_text"]]
            yield pd.DataFrame({"_id": frame["_id"], "n_tokens": [len(x) for x in ids], "ids": [x.tobytes() for x in ids]})

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i, row, text in zip(frame["_id"], frame["_row"], frame["_text"], strict=True):
                parts = list(chunks_of(text, chunk_chars, overlap_chars))
                yield pd.DataFrame({"_id": [i] * len(parts), "_row": row, "_start": [s for s, _ in parts], "_chunk": [t for _, t in parts]})

    def pretokenise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["_cuts"] = [np.asarray(boundaries(pattern, t), "<u4").tobytes() for t in frame["_chunk"]]
            yield frame

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_start")
        parts = ((s, t, np.frombuffer(c, "<u4").tolist()) for s, t, c in zip(frame["_start"], frame["_chunk"], frame["_cuts"], strict=True))
        runs = [run for run in stitch(pattern, parts) if run]
        lengths = [np.array([len(p) for p in run], "<u4").tobytes() for run in runs]
        return pd.DataFrame({"_id": [frame["_id"].iloc[0]] * len(runs), "_row": frame["_row"].iloc[0], "_part": range(len(runs)), "_run": ["".join(run) for run in runs], "_lengths": lengths})

    def encode_runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(ranks_path, pattern)
        piece = functools.lru_cache(1 << 16)(enc._encode_single_piece)
        for frame in frames:
            found = []
            for text, lengths in zip(frame["_run"], frame["_lengths"], strict=True):
                ends = np.cumsum(np.frombuffer(lengths, "<u4"), dtype=np.int64).tolist()
                ids = [i for a, b in zip([0, *ends], ends, strict=False) for i in piece(text[a:b])]
                found.append(np.asarray(ids, "<u4").tobytes())
            yield pd.DataFrame({"_id": frame["_id"], "_row": frame["_row"], "_part": frame["_part"], "ids": found})

    def whole_ids(frame: pd.DataFrame) -> pd.DataFrame:
        ids = b"".join(frame.sort_values("_part")["ids"])
        return pd.DataFrame({"_id": frame["_id"].iloc[:1], "n_tokens": [len(ids) // 4], "ids": [ids]})

    out = "_id string, n_tokens long, ids binary"
    chunked = long.mapInPandas(cut, "_id string, _row long, _start long, _chunk string")
    dealt = chunked.repartition("_row", "_start").mapInPandas(pretokenise, "_id string, _row long, _start long, _chunk string, _cuts binary")
    runs = dealt.groupBy("_row").applyInPandas(join, "_id string, _row long, _part long, _run string, _lengths binary")
    encoded = runs.repartition("_row", "_part").mapInPandas(encode_runs, "_id string, _row long, _part long, ids binary")
    joined = encoded.groupBy("_row").applyInPandas(whole_ids, out)
    return id_restored(short.mapInPandas(encode_short, out).unionByName(joined), docs, id_col)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds ``decoded``: the raw bytes of the ids, joined.  Null ids give null."""
    small_batches(encoded.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary"

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = token_bytes(ranks_path, pattern)
        for frame in frames:
            frame["decoded"] = [None if x is None else b"".join([table[i] for i in np.frombuffer(x, "<u4").tolist()]) for x in frame["ids"]]
            yield frame

    return encoded.mapInPandas(decode, schema)
