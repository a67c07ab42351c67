"""Operators that read texts, held against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bpe, fingerprint, language, linededup, packing, pii, quality, toxicity

RANKS = P.path("byte_bpe_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "a", "it's  we'll\n\n\tend  ", "x" * 900, "1" * 700 + " " * 300 + "é" * 200, "日本語 テキスト " * 40, "<|endoftext|> is text", "a\u0000b", "🙂🙃 " * 50,
    "The quick brown fox. " * 60, "same", "same", "word " * 400, "\n" * 120 + "x",
]


def frame(spark, texts, extra=True):
    rows = [(i, t, "en", "s", 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumn("ids", F.lit("clash")).withColumn("score", F.lit("clash")) if extra else df


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (40, 5), (1 << 15, 1 << 10)])
def test_bpe_equals_the_library_and_decodes(spark, chunk, overlap):
    enc = bpe.encoding(RANKS, P.PATTERN)
    got = bpe.decode_documents(bpe.encode_documents(frame(spark, ODD), RANKS, P.PATTERN, chunk_chars=chunk, overlap_chars=overlap), RANKS, P.PATTERN).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(ODD)))
    for r in got:
        text = ODD[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()


def test_stitching_is_linear_and_gives_the_pre_tokens_of_the_text(monkeypatch):
    draw = random.Random(25)
    scanned = []
    plain = bpe.boundaries
    monkeypatch.setattr(bpe, "boundaries", lambda pattern, text: scanned.append(len(text)) or plain(pattern, text))
    texts = ["x" * 6000, "x" * 3000 + " y" * 500 + "z" * 2000, " " * 2500 + "a", "".join(draw.choice(["ab", " ", "\n", "1", "!", "é" * 70]) for _ in range(2000))]
    for text in texts:
        chunks = [(at, part, plain(P.PATTERN, part)) for at, part in bpe.chunks_of(text, 64, 16)]
        scanned.clear()
        got = [p for run in bpe.stitch(P.PATTERN, chunks) for p in run]
        assert got == [m for m in bpe.matcher(P.PATTERN).findall(text)]
        assert sum(scanned) <= 4 * len(text)


def test_bpe_encodes_a_text_of_several_real_chunks(spark):
    text = ("Some words, 12 numbers and é. " * 4000) + "q" * 5000
    df = spark.createDataFrame([(1, text), (1, text), (None, text[::-1])], "doc_id long, text string")
    enc = bpe.encoding(RANKS, P.PATTERN)
    got = bpe.encode_documents(df, RANKS, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r.ids)) for r in got) == sorted((i, np.asarray(enc.encode_ordinary(t), "<u4").tobytes()) for i, t in [(1, text), (1, text), (0, text[::-1])])


def test_bpe_keeps_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "c" * 100), (1 << 60, "d")], "doc_id long, text string")
    got = bpe.encode_documents(df, RANKS, P.PATTERN, chunk_chars=32, overlap_chars=8)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect())[-1][0] == 1 << 60
    assert got.count() == 3
    assert bpe.encode_documents(df.limit(0), RANKS, P.PATTERN).count() == 0


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, at = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            at.update(p + k for p in places for k in range(8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(at)


def test_quality_measures_equal_plain_counts(spark):
    draw = random.Random(1)
    texts = [*ODD, *[" ".join(draw.choice("abc") for _ in range(draw.randrange(60))) for _ in range(40)], "a\nb\na\n \n\na", "#*$ %&|<>"]
    df = frame(spark, texts).withColumn("n_words", F.lit("clash"))
    for r in quality.apply_rules(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_measures(texts[r.doc_id] or "")
    assert quality.apply_rules(df.limit(0)).count() == 0


def best_fit_decreasing(sizes, capacity):
    gaps = []
    for size in sorted(sizes, reverse=True):
        fits = [g for g in gaps if g >= size]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - size)
    return len(gaps)


def rounds_piece_by_piece(sizes, capacity):
    """Fills of all sequences: the rounds of the docstring over single pieces and single gaps."""
    left, gaps, total = sorted(sizes, reverse=True), [], 0
    while left:
        least = next((c * capacity for c in packing.CLASSES if left[0] > c * capacity))
        now, later = [x for x in left if x > least], [x for x in left if x <= least]
        free, after, waiting = sorted(gaps), [], []
        at = 0
        while at < len(now):
            size = now[at]
            k = next((i for i, g in enumerate(free) if g >= size), None)
            if k is None:
                waiting.append(size)
                at += 1
                continue
            gap = free.pop(k)
            each = min(max(1, gap // (2 * size)), now[at:].count(size))
            after.append(gap - each * size)
            at += each
        gaps = [g for g in free + after if g]
        if len(waiting) == len(now):
            new = sum(2 * x > capacity for x in waiting) or -(-sum(waiting) // capacity)
            gaps += [capacity] * new
            total += new
        left = sorted(waiting + later, reverse=True)
    return total


def packed_sequences(matches, capacity):
    """{sequence: parts}, after a look that parts neither overlap nor leave a hole."""
    parts = {}
    for _, size, low, high, each, sequence, offset in matches:
        for rank in range(low, high):
            nth = rank - low
            parts.setdefault(sequence + nth // each, []).append((offset + nth % each * size, size, rank))
    for own in parts.values():
        at = 0
        for offset, size, _ in sorted(own):
            assert offset == at
            at += size
        assert at <= capacity
    return parts


def test_packing_rounds_equal_the_rounds_piece_by_piece():
    draw = random.Random(2)
    for n in range(60):
        capacity = draw.choice([10, 50, 200])
        counts = {draw.randrange(1, capacity): draw.randrange(1, 30) for _ in range(draw.randrange(1, 12 + n))}
        state, rounds = [(packing.PIECES, size, 0, many, 0, 0, 0) for size, many in counts.items()], 0
        done = []
        while any(r[0] == packing.PIECES for r in state):
            state = packing.sweep(state, capacity)
            done += [r for r in state if r[0] == packing.MATCH]
            rounds += 1
        parts = packed_sequences(done, capacity)
        sizes = [size for size, many in counts.items() for _ in range(many)]
        assert sorted((size, rank) for own in parts.values() for _, size, rank in own) == sorted((size, rank) for size, many in counts.items() for rank in range(many))
        assert len(parts) <= rounds_piece_by_piece(sizes, capacity)
        assert len(parts) <= 1.03 * best_fit_decreasing(sizes, capacity) + 2


def test_packing_rounds_in_spark(spark):
    draw = random.Random(21)
    sizes = [draw.randrange(1, 64) for _ in range(900)]
    rows = [(None if i % 7 == 0 else i % 500, 0, 0, n, draw.randrange(9)) for i, n in enumerate(sizes)] + [(1, 1, 3, 64, 5)] * 3
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(df, 64).collect()
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted((r[0] or -1, *r[1:]) for r in rows)
    parts = {}
    for r in got:
        parts.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in parts.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 64
    assert len(parts) <= 1.02 * (3 + best_fit_decreasing(sizes, 64))


def test_remembered_chunks_give_the_ids_of_the_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    enc = packing.Encoder(JSON)
    some = [chr(c) for c in [*range(0x3000 + 0x100), *range(0xD7F0, 0xD800), *range(0xE000, 0xE010), 0xFEFF, 0xFF10, 0x1D7CE, 0x1F642, 0x10FFFF]]
    texts = [f"a{c}{c} b {c}1 {c}  {c} ' {c}\n{c}" for c in some] + [x or "" for x in ODD] + ["a<|endoftext|>b  c", "\x1c \x1d  x\xa0  y \u3000 z"]
    for _ in range(2):
        assert enc.encode(texts) == [np.asarray(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]


def test_packing_encodes_new_words_without_the_whole_tokenizer(monkeypatch):
    import random
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    some = random.Random(5)
    parts = ["ab", "Zz", "é", "ß", "ſ", "ñ", "0", "19", ",", "***", "<|", "|>", '"', "_", "{", "-"]
    plain = [some.choice(["", " ", "\n", "  x "]) + " ".join("".join(some.choices(parts, k=9)) for _ in range(9)) for _ in range(300)]
    enc = packing.Encoder(JSON)
    sent, through = [], enc.plain
    monkeypatch.setattr(enc, "plain", lambda texts: sent.extend(texts) or through(texts))
    expected = [np.asarray(e.ids, "<u4").tobytes() for e in t.encode_batch(plain, add_special_tokens=False)]
    assert enc.encode(plain) == expected == enc.encode(plain)
    assert all(c.startswith("  ") for c in sent)
    # What the words here are not cut for: apostrophes, marks, other letters and numbers, wide white space, added tokens.
    odd = ["don't 'tis '' a'sb 'll1 \"'s", "n\u0303a a\u0303", "日本1 ⅷ² ªº µ ×÷", "a\r\n b \t c\x1cd \u3000e", "x<|endoftext|>y z", "<|endoftext|", "", "é" * 5000]
    assert enc.encode(odd) == [np.asarray(e.ids, "<u4").tobytes() for e in t.encode_batch(odd, add_special_tokens=False)]


def test_packing_sends_a_block_of_new_words_to_the_model_at_once(monkeypatch):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    enc = packing.Encoder(JSON)
    sent, calls, through, by_model = [], [], enc.plain, enc.words
    monkeypatch.setattr(enc, "plain", lambda texts: sent.extend(texts) or through(texts))
    monkeypatch.setattr(enc, "words", lambda words: calls.append(words) or by_model(words))
    texts = [f"new{i}word\tthen  é{i % 7}\r\n\n *** end{i}, \n" for i in range(100)]
    assert enc.encode(texts) == [np.asarray(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert sent == [] and len(calls) == 1 and len(calls[0]) == len(set(calls[0]))


@pytest.mark.parametrize("block", [16, 61, 1 << 22])
def test_packing_blocks_give_the_ids_of_the_library(monkeypatch, block):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "BLOCK", block)
    t = Tokenizer.from_file(JSON)
    enc, some = packing.Encoder(JSON), random.Random(block)
    parts = [*"   \n\n\t\r\v''abzZ019,.*<|>_-\x00\x1c\x7f\x85\xa0\u2003\u3000\u200béß×÷ñſɏɐ日п²ªµ\u0303😀ア", "'s", "'ll", "<|endoftext|>"]
    for _ in range(30):
        texts = ["".join(some.choices(parts, k=some.randrange(40))) for _ in range(50)]
        assert enc.encode(texts) == [np.asarray(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode([]) == [] and enc.encode(["", ""]) == [b"", b""]


def test_packing_encodes_by_other_tokenizers_in_one_go(tmp_path):
    from tokenizers import Tokenizer, normalizers

    t = Tokenizer.from_file(JSON)
    t.normalizer = normalizers.Replace("  b", "c")
    t.save(str(tmp_path / "other.json"))
    texts = ["a  b", "", "xé  b's a<|endoftext|>  b", "a"]
    assert packing.Encoder(str(tmp_path / "other.json")).encode(texts) == [np.asarray(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]


def test_packing_covers_every_token(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    texts = [*ODD, ODD[8], "<|endoftext|>", "x y " * 9000]
    got = packing.pack_documents(frame(spark, texts), JSON, capacity=64).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts))) and sum(p.length for p in parts) == len(ids)
        assert all(p.length == 64 for p in parts[1:])
        for p in parts:
            assert p.ids_crc32 == zlib.crc32(np.asarray(ids[p.start : p.start + p.length], "<u4").tobytes())
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64
    assert packing.pack_documents(frame(spark, ODD).limit(0), JSON).count() == 0


def test_fingerprints_are_homomorphic_and_order_free():
    of = fingerprint.Fingerprint.of
    a, b, c = "one two three\nfour five", "four five\none two three", "one two three\nfour five\nsix"
    assert of(a) == of(b) and of(a).hex() == of(b).hex() and of(a) != of(c)
    assert of(a) + of("six") == of(c) and of(c) - of("six") == of(a)
    assert of("a\na") != of("a") and of("").likeness(of("")) == 1.0 and of("").likeness(of("x")) == 0.0


def plain_lanes(text):
    """Lanes by the definition, with Python's own numbers."""
    import xxhash

    exact, sketch = [0] * 8, [0] * 256
    for line in text.split("\n"):
        digest = hashlib.blake2b(line.encode(), digest_size=64).digest()
        exact = [(x + int.from_bytes(digest[8 * i : 8 * i + 8], "little")) % 2**64 for i, x in enumerate(exact)]
        words = [b"", b"", *line.encode().split()]
        for i in range(len(words) - 2):
            h = xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 7)
            sketch[h % 256] += 1 if h >> 63 else -1
    return exact, sketch


def plain_likeness(a, b):
    (x, u), (y, v) = plain_lanes(a), plain_lanes(b)
    if (x, u) == (y, v) or not (any(u) or any(v)):
        return 1.0
    norm = (sum(i * i for i in u) * sum(i * i for i in v)) ** 0.5
    return max(0.0, sum(i * j for i, j in zip(u, v, strict=True)) / norm) if norm else 0.0


def plain_hex(text):
    exact, sketch = plain_lanes(text)
    return b"".join(x.to_bytes(8, "little") for x in exact).hex() + b"".join((x % 2**32).to_bytes(4, "little") for x in sketch).hex()


def test_likeness_holds_for_any_count_of_a_word():
    of = fingerprint.Fingerprint.of
    for n in (32768, 40000, 65536):
        a, b = of("a b c\n" * n), of("a b c\n" * (n - 1))
        assert a.likeness(b) == pytest.approx(1.0) and a != b
    assert of(" ").likeness(of("\n\n")) == 1.0 and of(" ").likeness(of("x")) == 0.0


@pytest.mark.parametrize("bytes_a_range", [200, 16 << 20])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_edits_equal_plain_python_for_any_ids(spark, monkeypatch, kind, bytes_a_range):
    monkeypatch.setattr(fingerprint, "RANGE_BYTES", bytes_a_range)
    draw = random.Random(18)
    ids = draw.sample(range(10**9), 60)
    rows = [(i if kind == "long" else f"é{i}", draw.choice(["", None, f"one two three {i}\nfour {i}", "same\ntext", "word " * draw.randrange(200)])) for i in ids]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string").withColumn("_key", F.lit("clash")).withColumn("m", F.lit("clash"))
    order = sorted(rows)
    got = {r.doc_id: r for r in fingerprint.compare_with_edits(df).collect()}
    assert len(got) == len(rows)
    for at, (i, text) in enumerate(order):
        text, following = text or "", order[(at + 1) % len(order)][1] or ""
        k = len(text) // 4
        new = text[: len(text) - k] + following[:k]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == plain_hex(text) and r.edited_fingerprint == plain_hex(new)
        assert r.near_edited == pytest.approx(plain_likeness(text, new)) and r.near_next == pytest.approx(plain_likeness(text, following))
    # Null and repeated ids: every row has its own, and follows in the order of ids.
    many = [(None, f"null {i}") for i in range(40)] + [(rows[0][0], f"again {i}") for i in range(40)]
    found = fingerprint.compare_with_edits(spark.createDataFrame(rows[1:] + many, f"doc_id {kind}, text string")).collect()
    assert len(found) == 139 and sum(r.doc_id is None for r in found) == 40
    assert sorted(r.fingerprint for r in found) == sorted(plain_hex(t or "") for _, t in rows[1:] + many)


def test_edits_are_taken_from_the_next_document(spark):
    texts = [t for t in ODD] + ["line %d\nwith words of its own %d" % (i, i) for i in range(30)]
    got = {r.doc_id: r for r in fingerprint.compare_with_edits(frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        text, following = text or "", texts[(i + 1) % len(texts)] or ""
        new = fingerprint.edited(text, following)
        own, changed = fingerprint.Fingerprint.of(text), fingerprint.Fingerprint.of(new)
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == own.hex() and r.edited_fingerprint == changed.hex()
        assert r.near_edited == pytest.approx(own.likeness(changed)) and r.near_next == pytest.approx(own.likeness(fingerprint.Fingerprint.of(following)))
    one = fingerprint.compare_with_edits(frame(spark, ["abcd"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abca").hexdigest()
    assert fingerprint.compare_with_edits(frame(spark, ["a"]).limit(0)).count() == 0


def brute_lines(rows, sites, short_sites, short):
    spread, owner = {}, {}
    for i, text, site in rows:
        for line in set((text or "").split("\n")):
            if line.strip(" \t\x0b\x0c\r"):
                spread.setdefault(line, set()).update({site} - {None})
                owner[line] = min(owner.get(line, i), i)
    common = {x for x, found in spread.items() if len(found) >= (sites if len(re.sub(r"[ \t\x0b\x0c\r]", "", x)) >= short else short_sites)}
    kept = {i: [x for x in (text or "").split("\n") if x not in common or owner[x] == i] for i, text, _ in rows}
    return {i: (text if text is None else "\n".join(kept[i]), (text or "").count("\n") + 1 - len(kept[i])) for i, text, _ in rows}


@pytest.mark.parametrize("sent", [0, 500_000])
@pytest.mark.parametrize("sites", [2, 4, 40])
def test_line_dedup_equals_exact_spread(spark, monkeypatch, sites, sent):
    monkeypatch.setattr(linededup, "SENT", sent)
    draw = random.Random(3)
    pool = [f"shared line number {i} of many words" for i in range(12)] + ["short one", "", "   ", "\t", "共有の行" * 6]
    rows = [(i, "\n".join(draw.choice(pool) if draw.random() < 0.7 else f"own words of the document {i}" for _ in range(6)), draw.choice([None, *[f"s{k}" for k in range(60)]])) for i in range(150)]
    many = [f"line {n} that long documents share" for n in range(150)]
    rows += [(150, None, "s1"), (151, "", "s1"), *[(152 + k, "\n".join(many * 2 + [f"own {k}"]), f"s{k}") for k in range(45)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text").cast("long"))
    for clash in ("k", "id", "_id", "site", "N_REMOVED", "own_0", "buckets", "kept"):
        df = df.withColumn(clash, F.lit("clash"))
    found = linededup.remove_boilerplate(df, sites, 2 * sites)
    assert found.columns == [*(c for c in df.columns if c != "N_REMOVED"), "n_removed"]
    wanted = brute_lines(rows, sites, 2 * sites, linededup.SHORT)
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.text, r.n_removed) == wanted[r.doc_id]
        assert r.n_chars == (None if r.text is None else len(r.text)) and r.k == r.own_0 == "clash"
    assert linededup.remove_boilerplate(df.limit(0)).count() == 0


def test_line_dedup_takes_repeated_and_null_ids_as_documents(spark):
    line = "a line that every site of this table has"
    rows = [(1, line, "a"), (1, line, "b"), (2, f"{line}\nown", "c"), (None, line, "d"), (None, "own", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r.doc_id or 0, r.source, r.text) for r in linededup.remove_boilerplate(df, 4).collect()))
    assert got == [(0, "d", ""), (0, "e", "own"), (1, "a", line), (1, "b", line), (2, "c", "own")]


def test_language_backs_off_for_unseen_words(spark):
    teach = [("the cat and the dog sat there " * 3, "en"), ("le chat et le chien aimaient " * 3, "fr"), (None, "en"), ("words", None)] * 3
    model = language.train(spark.createDataFrame(teach, "text string, lang string"))
    assert model.languages == ["en", "fr"]
    texts = ["the dog", "le chien", "cats sat", "chiens aimaient", None, "", "123 !!", "le"]
    got = {r.doc_id: r for r in language.identify(frame(spark, texts), model).collect()}
    assert [got[i].lang_pred for i in range(8)] == ["en", "fr", "en", "fr", "und", "und", "und", "fr"]
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = language.train(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in language.identify(frame(spark, texts), nothing).collect()} == {"und"}


def plain_language(teach, texts, words, grams):
    """Training and scores by the docstring, with plain counters."""
    from collections import Counter

    split = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    languages = sorted({x for t, x in teach if t is not None and x is not None and split(t)})
    by_word = {x: Counter(w for t, y in teach if y == x and t is not None for w in split(t)) for x in languages}
    by_gram = {x: Counter() for x in languages}
    for x in languages:
        for w, n in by_word[x].items():
            m = f"^{w}$"
            for k in range(1, 6):
                for i in range(len(m) - k + 1):
                    by_gram[x][m[i : i + k]] += n

    def table(counts, size):
        share = size // len(languages)
        kept = set()
        for x in languages:
            for w, n in counts[x].items():
                if sum(c >= n for c in counts[x].values()) <= share:
                    kept.add(w)
        logs = {w: np.log([counts[x][w] + 0.5 for x in languages]) - np.log([sum(counts[x].values()) + 0.5 * len(kept) for x in languages]) for w in kept}
        return {w: v - v.mean() for w, v in logs.items()}

    known, pieces = table(by_word, words), table(by_gram, grams)
    out = []
    for t in texts:
        found = split(t or "")
        total = np.zeros(len(languages))
        for w in found:
            if w in known:
                total += known[w]
                continue
            m, own = f"^{w}$", []
            for i in range(len(m)):
                fits = [m[i : i + k] for k in range(5, 0, -1) if len(m) >= i + k and m[i : i + k] in pieces]
                own += [pieces[fits[0]]] if fits else []
            if own:
                total += np.mean(own, axis=0)
        best = int(total.argmax())
        out.append((languages[best], 1 / np.exp(total - total[best]).sum()) if found else ("und", 0.0))
    return out


@pytest.mark.parametrize("words,grams", [(10_000, 10_000), (30, 60), (3, 3)])
def test_language_equals_plain_counters(spark, words, grams):
    draw = random.Random(23)
    pools = {x: ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 9))) for _ in range(30)] for x, letters in (("aa", "abcdé"), ("bb", "bcdef"), ("cc", "xyzß"))}
    pools["aa"] += pools["bb"][:10]
    some = lambda x, n: " ".join(draw.choice(pools[x]) for _ in range(n))
    teach = [(some(x, 12) + "! 7", x) for x in pools for _ in range(30 if x != "cc" else 2)] + [(None, "aa"), ("lost", None), ("", "bb"), ("123", "dd")]
    texts = [some(draw.choice(list(pools)), draw.randrange(1, 9)) + draw.choice(["", " unseenword", " dcbae", " 77"]) for _ in range(60)] + ["qqqq", None, "", "42", "same", "same", "É" * 40000]
    model = language.train(spark.createDataFrame(teach, "text string, lang string"), words, grams)
    got = {r.doc_id: r for r in language.identify(frame(spark, texts).withColumn("_text", F.lit("clash")), model).collect()}
    for i, (name, score) in enumerate(plain_language(teach, texts, words, grams)):
        assert got[i].lang_pred == name and got[i].score == pytest.approx(score)
    assert language.identify(frame(spark, texts).limit(0), model).count() == 0


def test_a_rare_language_keeps_its_words(spark):
    draw = random.Random(24)
    common = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    rare = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(40)]
    teach = [(" ".join(draw.choice(common) for _ in range(30)), "en") for _ in range(600)] + [(" ".join(draw.choice(rare) for _ in range(30)), "xx") for _ in range(6)]
    model = language.train(spark.createDataFrame(teach, "text string, lang string"), words=200, grams=200)
    texts = [" ".join(draw.sample(rare, 8)) for _ in range(30)]
    assert {r.lang_pred for r in language.identify(frame(spark, texts), model).collect()} == {"xx"}


def test_language_holds_out_well(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from corpusloom.llm.queries import op9_language

    found = op9_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").filter("held_out and lang is not null")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_toxicity_learns_from_bags_and_finds_the_sentence(spark):
    draw = random.Random(4)
    plain = [f"w{i}" for i in range(60)]
    bags, labels = [], []
    for i in range(300):
        y = i % 3 == 0
        sentences = [" ".join(draw.choice(plain) for _ in range(6)) for _ in range(5)]
        if y:
            sentences[draw.randrange(5)] += " " + draw.choice(["vile", "awful"])
        bags.append(". ".join(sentences))
        labels.append((i, int(y)))
    docs = frame(spark, bags, extra=False)
    model = toxicity.train(docs, spark.createDataFrame([*labels, (9999, 1), (5, None)], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(frame(spark, ["w1 w2. You vile w3! w4", "w1 w2 w3", None, "", "unknown words. " * 800]), model).collect()}
    assert got[0].score >= 0.5 and [(s.start, s.end) for s in got[0].offending] == [(6, 18)]
    assert all(got[i].score < 0.5 for i in (1, 2, 3, 4)) and got[2].score == 0 and got[3].score == 0
    assert toxicity.reject(frame(spark, ["vile", "w1", None]), model).count() == 2
    empty = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(docs, empty).collect()} == {0.0}


def plain_score(model, text):
    """The docstring's noisy-or, one sentence at a time."""
    bags = [set(re.findall(r"[^\W_]+", s)) for s in re.split(r"[.!?\n]", text.lower())]
    bags = [b for b in bags if b]
    clean = 1.0
    for bag in bags:
        z = model.bias - np.log(len(bags)) + sum(model.weights.get(f, 0.0) for w in bag for f in [w, *("^" + w[:k] for k in (5, 6, 7) if len(w) > k)])
        clean *= 1 - 1 / (1 + np.exp(-z))
    return 1 - clean if bags else 0.0


def test_toxicity_scores_are_the_plain_noisy_or(spark):
    draw = random.Random(20)
    weights = {w: draw.uniform(-3, 5) for w in ["vile", "awful", "^terri", "^terrib", "good", "é"]}
    model = toxicity.Model(-1.5, weights)
    pool = [*weights, "terrible", "terribly", "plain", "É", ".", "!", "\n", "?!", "_", "1"]
    texts = [" ".join(draw.choice(pool) for _ in range(draw.randrange(40))) for _ in range(150)] + [None, "", "...", "vile " * 30000, "same", "same"]
    df = frame(spark, texts).withColumn("_id", F.lit("clash")).withColumn("offending", F.lit("clash"))
    for r in toxicity.score(df, model).collect():
        assert r.score == pytest.approx(plain_score(model, texts[r.doc_id] or ""), abs=1e-9)
    kept = {r.doc_id for r in toxicity.reject(df, model).collect()}
    assert kept == {i for i, t in enumerate(texts) if plain_score(model, t or "") < 0.5}
    assert toxicity.reject(df, model).columns == df.columns and toxicity.reject(df.limit(0), model).count() == 0


def test_toxicity_gradient_is_that_of_the_plain_loss():
    draw = random.Random(22)
    words = [f"word{i}" for i in range(12)]
    bags = [(int(i % 3 == 0), [draw.sample(words, draw.randrange(1, 5)) for _ in range(draw.randrange(0, 4))]) for i in range(40)]
    data, index = toxicity.flat(bags)
    theta = np.array([draw.uniform(-1, 1) for _ in index] + [-1.0])

    def plain(theta):
        model = toxicity.Model(theta[-1], {w: theta[i] for w, i in index.items()})
        used = [(y, ". ".join(" ".join(s) for s in bag)) for y, bag in bags if bag]
        toxic = sum(y for y, _ in used)
        logs = [-np.log(plain_score(model, t)) * 0.5 / toxic if y else -np.log(1 - plain_score(model, t)) * 0.5 / (len(used) - toxic) for y, t in used]
        return sum(logs) + toxicity.PENALTY / 2 * (theta[:-1] ** 2).sum()

    value, grad = data.loss(theta)
    assert value == pytest.approx(plain(theta))
    for i in [*range(0, len(theta), 5), len(theta) - 1]:
        step = np.zeros_like(theta)
        step[i] = 1e-5
        assert grad[i] == pytest.approx((plain(theta + step) - plain(theta - step)) / 2e-5, abs=1e-6)


def test_toxicity_training_takes_a_bounded_sample(spark):
    rows = [(i, f"{'vile' if i % 2 else 'kind'} words number {i}. more", i % 2) for i in range(60)] + [(3, "vile again", 1), (None, "vile", 1), (99, None, 1), (100, "", 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, per_class=20, characters=1000)
    assert model.weights["vile"] > 0 > model.weights.get("kind", -1)
    assert toxicity.train(docs, labels, characters=10).weights == {}
    assert toxicity.train(docs.limit(0), labels).weights == {}


def test_toxicity_holds_out_well(spark):
    from corpusloom.llm.queries import op5_toxicity

    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    got = op5_toxicity(spark, "/root/testdata/sf0.01").filter("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r.score for r in got if r.toxic], [r.score for r in got if not r.toxic]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.8 and np.mean([s >= 0.5 for s in clean]) < 0.05


STRICT = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def luhn(digits):
    return sum(int(x) if i % 2 == 0 else int(x) * 2 - 9 * (int(x) > 4) for i, x in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    return [(k, m.start(), m.end()) for k, p, good in STRICT for m in re.finditer(p, text) if good(m[0])]


def pii_texts():
    draw = random.Random(5)
    bits = ["a.b@c.de", "x@y", "a@b.c_d@e.f", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "001.002.003.004", "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111  11111111", "+1 (555) 123-4567", "+12", "++1 234 567 890", "é🙂", "word", "\n", "0000000000000000", "..@..", "@a.b", "9" * 30]
    texts = [draw.choice(["", " "]).join(draw.choice(bits) for _ in range(draw.randrange(1, 12))) for _ in range(250)]
    return [*texts, None, "", "a@b.co " * 700, "1" * 5000, "a" * 5000 + "@", "1 2 3 " * 1500]


def test_pii_base_spans_equal_the_plain_patterns(spark):
    texts = pii_texts()
    df = frame(spark, texts).withColumn("spans", F.lit("clash"))
    for clash in ("_base", "_t", "_found", "_m_at", "_s", "own_1", "half"):
        df = df.withColumn(clash, F.lit("clash"))
    model = pii.train(df)
    for r in pii.find(df, model).collect():
        wanted = brute_spans(texts[r.doc_id] or "")
        assert [(x.kind, x.start, x.end) for x in r.base_spans] == wanted
        assert set(wanted) <= {(x.kind, x.start, x.end) for x in r.spans}
    assert pii.find(df.limit(0), pii.train(df.limit(0))).count() == 0


def test_added_spans_are_personal_data(spark):
    """Planted texts: spelt-out addresses, odd groupings of cards and phones after a hint, and numbers that are none of these."""
    draw = random.Random(19)

    def card(sep):
        digits = [draw.randrange(10) for _ in range(15)]
        digits[0] = 4
        check = next(c for c in range(10) if luhn("".join(map(str, [*digits, c]))))
        text = "".join(map(str, [*digits, check]))
        return sep.join(text[i : i + 4] for i in range(0, 16, 4))

    number = lambda: f"555 {draw.randrange(100, 1000)} {draw.randrange(1000, 10000)}"
    good = {
        "email": lambda k: f"write to u{k} (at) host{k}.org today",
        "card": lambda k: f"my card {card('. ')} is lost",
        "phone": lambda k: f"please call {number()} now",
    }
    texts, truth = [], {}
    for k in range(1200):
        texts.append([f"write to u{k}@host{k}.org today", f"please call +1 {number()} now", f"my card {card(' ')} is lost", f"order {draw.randrange(10**15, 10**16)} of {number()} parts", "v " + ".".join(str(draw.randrange(1, 999)) for _ in range(5))][k % 5])
    for k in range(60):
        kind = ["email", "card", "phone"][k % 3]
        truth[len(texts)] = kind
        texts.append(good[kind](k))
    df = frame(spark, texts, extra=False)
    added = [(r.doc_id, x.kind) for r in pii.find(df, pii.train(df)).collect() for x in set(map(tuple, r.spans)) - set(map(tuple, r.base_spans)) for x in [pii_span(x)]]
    right = [a for a in added if truth.get(a[0]) == a[1]]
    assert len(added) >= 20 and len(right) >= 0.9 * len(added)


def pii_span(x):
    from collections import namedtuple

    return namedtuple("Span", "kind start end")(*x)


def test_pii_redaction_leaves_no_base_span(spark):
    texts = pii_texts()
    df = frame(spark, texts, extra=False)
    model = pii.Model()
    for r in pii.redact(df, model).collect():
        text = texts[r.doc_id]
        if text is None:
            assert r.text is None
            continue
        cuts = []
        for k, a, b in sorted(brute_spans(text), key=lambda x: (x[1], x[2], x[0])):
            if cuts and a < cuts[-1][1]:
                cuts[-1][1] = max(cuts[-1][1], b)
            else:
                cuts.append([a, b, k])
        wanted, at = "", 0
        for a, b, k in cuts:
            wanted += text[at:a] + f"[{k.upper()}]"
            at = b
        assert r.text == wanted + text[at:] and r.n_chars == len(r.text)


def test_boosting_and_its_column_agree(spark):
    draw = random.Random(6)
    counts = {b: (draw.randrange(50), draw.randrange(50) * (b >> 1 & 1)) for b in draw.sample(range(4096), 200)}
    model = pii.calibrate(pii.boost(counts), counts, precision=0.5)
    rows = spark.createDataFrame([(b,) for b in counts], "bits int").select("bits", model.compiled()(F.col("bits")).alias("s")).collect()
    assert all(abs(r.s - model.score(r.bits)) < 1e-9 for r in rows)
    assert np.mean([model.score(b) for b in counts if b >> 1 & 1]) > np.mean([model.score(b) for b in counts if not b >> 1 & 1])
