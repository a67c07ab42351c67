"""SimHash links, components, sharding and the pipeline."""

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import sharding, simhash
from corpusloom.llm.components import components


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components_equal_union_find(spark, shape):
    draw = random.Random(7)
    pairs = {"chain": [(i, i + 1) for i in range(60)], "star": [(50, i) for i in range(50)] + [(0, i) for i in range(60, 300)], "random": [(draw.randrange(80), draw.randrange(80)) for _ in range(60)], "none": []}[shape]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs + ([(1, None)] if pairs else []), "a long, b long"), "a", "b").collect()}
    linked = {x for p in pairs for x in p if p[0] != p[1]}
    assert got == {n: r for n, r in union(pairs, linked).items()}


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    draw = random.Random(8)
    for _ in range(3000):
        changed = sum(1 << i for i in draw.sample(range(64), radius))
        assert any(not changed & m for m in masks)


@pytest.mark.parametrize("radius", [2, 4])
def test_links_equal_all_pairs_even_in_full_buckets(spark, radius):
    draw = random.Random(9)
    prints = set()
    for size in (60, 3, 2):
        base = draw.getrandbits(64)
        prints |= {base ^ sum(1 << i for i in draw.sample(range(64), draw.randrange(0, 4))) for _ in range(size)}
    prints |= {draw.getrandbits(64) for _ in range(50)}
    signed = sorted(simhash._signed(p) for p in prints)
    classes = spark.createDataFrame([(p, i) for i, p in enumerate(signed)], "fp long, rep long")
    got = {(r.a, r.b) for r in simhash.links(classes, radius, every=True).collect()}
    wanted = {(i, j) for (i, x), (j, y) in itertools.combinations(enumerate(signed), 2) if ((x ^ y) & (2**64 - 1)).bit_count() <= radius}
    assert {tuple(sorted(p)) for p in got} == wanted
    tied = {tuple(sorted((r.a, r.b))) for r in simhash.links(classes, radius).collect()}
    assert tied <= wanted and union(tied, range(len(signed))) == union(wanted, range(len(signed)))


def plain_fingerprint(text, k):
    import re

    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashed = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashed) > len(hashed))


def test_near_duplicates_equal_brute_force(spark):
    draw = random.Random(10)
    words = [draw.choice("ÀBCDEfghij") + str(i) for i in range(300)]
    texts = [None, "", " \n", "One", "one", "two words", "İstanbul ß"]
    for _ in range(25):
        base = [draw.choice(words) for _ in range(80)]
        texts += [" ".join(base), " ".join(base), "  ".join([*base[:-1], "end"]), " ".join(base * 6 + ["tail"])]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("clash"))
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    prints = [plain_fingerprint(t or "", 3) for t in texts]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if (prints[i] ^ prints[j]).bit_count() <= 2]
    wanted = union(pairs, range(len(texts)))
    for i in range(len(texts)):
        assert got[i].fingerprint & (2**64 - 1) == prints[i] and got[i].component_id == wanted[i]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_deduplicate_keeps_one_of_each_group_and_clean_documents(spark):
    draw = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    rows, groups = [], 40
    for g in range(groups):
        base = [draw.choice(words) for _ in range(200)]
        near = [*base]
        near[draw.randrange(200)] = "changed"
        rows += [(3 * g, " ".join(base)), (3 * g + 1, " ".join(base)), (3 * g + 2, " ".join(near))]
    df = spark.createDataFrame([*rows, (None, "null id")], "doc_id long, text string").withColumn("a", F.lit("clash"))
    kept = sorted(r.doc_id for r in simhash.deduplicate(df).filter("doc_id is not null").collect())
    assert {k // 3 for k in kept} == set(range(groups)) and all(3 * g in kept for g in range(groups))
    assert len(kept) <= 1.15 * groups
    assert simhash.deduplicate(df).filter("doc_id is null").count() == 1


def brute_force(rows, least=0.8):
    """What stays of rows (id, text): the smallest id of each component of the pairs at ``least`` or more."""
    sets = {}
    for i, text in rows:
        words = text.lower().split()
        sets[i] = {" ".join(words[at : at + 5]) for at in range(max(1, len(words) - 4))}
    pairs = [(i, j) for i, j in itertools.combinations(sets, 2) if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) - 1e-9]
    return sorted(i for i, root in union(pairs, sets).items() if i == root)


def edited(draw, base, n):
    out = [*base]
    for at in draw.sample(range(len(base)), n):
        out[at] = f"x{draw.randrange(10**9)}"
    return " ".join(out)


def test_deduplicate_connects_spokes_by_their_hub(spark):
    draw = random.Random(14)
    base = [f"w{draw.randrange(500)}" for _ in range(200)]
    # Copies with four words changed reach 0.8 with the hub only, not with each other.
    rows = [(i, edited(draw, base, 4)) for i in range(300)] + [(300, " ".join(base))] + [(301 + i, edited(draw, base, 12)) for i in range(20)]
    wanted = brute_force(rows)
    assert len(brute_force(rows[:300])) > 200 and len(wanted) == 21
    kept = sorted(r.doc_id for r in simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == wanted


def test_deduplicate_equals_brute_force(spark):
    draw = random.Random(15)
    rows = []
    for size in [*range(1, 12), 30, 60, 100, 200, 300] * 3:
        base = [f"w{draw.randrange(300)}" for _ in range(size)]
        rows += [edited(draw, base, n) for n in sorted({0, *(draw.randrange(0, 2 + size // 25) for _ in range(4))})]
        rows += [" ".join([*base, *base[: size // 5]]), " ".join(base[size // 6 :])]
    rows = list(enumerate([*rows, *rows[:20], "", " "]))
    draw.shuffle(rows)
    kept = sorted(r.doc_id for r in simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == brute_force(rows)


def cheapest(blocks, capacity, spare):
    """Fewest bytes to move, by trying every choice of larger shards; block rows are equal in size."""
    best = None
    for bigger in itertools.combinations(sorted(capacity), spare):
        cost = 0
        for s, own in blocks.items():
            left = max(0, sum(n for n, _ in own) - capacity.get(s, 0) - (s in bigger))
            for n, size in own:
                k = min(n, left)
                cost += k * size / n
                left -= k
        best = cost if best is None else min(best, cost)
    return best


def test_flow_moves_the_fewest_bytes():
    draw = random.Random(12)
    for _ in range(60):
        shards = draw.randrange(1, 6)
        blocks = {s: [(n, n * size) for size in (1, 3, 9) if (n := draw.randrange(0, 6))] for s in range(shards)}
        total = sum(n for own in blocks.values() for n, _ in own)
        least, spare = divmod(total, shards)
        moves = sharding.plan(blocks, dict.fromkeys(range(shards), least), spare)
        cost, sent = 0.0, {}
        for m in moves:
            sent[m.source] = sent.get(m.source, 0) + m.rows
        for s, left in sent.items():
            for n, size in blocks[s]:
                k = min(n, left)
                cost += k * size / n
                left -= k
        assert cost == pytest.approx(cheapest(blocks, dict.fromkeys(range(shards), least), spare))
    with pytest.raises(ValueError, match="smaller"):
        sharding.plan({0: [(5, 5)]}, {0: 1, 1: 1})


def test_reshard_is_even_and_gapless(spark):
    draw = random.Random(13)
    rows = [(i, draw.choice([None, "", "é" * draw.randrange(90), "same"])) for i in range(700)] + [(None, "x"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("clash")).withColumn("shard", F.lit("clash"))
    placed, moves = sharding.reshard(df, 7)
    got = placed.collect()
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert len(got) == len(rows) and set(by_shard) == set(range(7))
    assert all(sorted(x) == list(range(len(x))) for x in by_shard.values())
    sizes = sorted(map(len, by_shard.values()))
    assert sizes[-1] - sizes[0] <= 1
    texts = dict(rows)
    for r in got:
        if r.doc_id is not None:
            raw = (texts[r.doc_id] or "").encode()
            assert r["size"] == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
    assert sum(r.shard != r.old_shard for r in got) == sum(m.rows for m in moves)
    none, no_moves = sharding.reshard(df.limit(0), 7)
    assert none.count() == 0 and no_moves == []


def test_only_touched_shards_are_written(spark, tmp_path):
    rows = [(i, f"text {i}", 0 if i < 30 else 1 + i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, old int")
    path = str(tmp_path / "shards")
    df.withColumn("shard", F.col("old")).withColumn("slot", F.lit(0)).drop("old").write.partitionBy("shard").parquet(path)
    placed, moves = sharding.reshard(df, 4, old_shard="old")
    touched = sharding.rewrite_files(df.drop("old"), placed, moves, path)
    assert 0 in touched
    stored = spark.read.parquet(path)
    assert stored.count() == 60 and {r["count"] for r in stored.groupBy("shard").count().collect()} == {15}
    assert sharding.rewrite_files(df, placed, [], path) == []


@pytest.mark.parametrize("before,after", [(4, 2), (2, 4), (3, 3), (5, 1)])
def test_rewritten_files_hold_every_row_once(spark, tmp_path, before, after):
    draw = random.Random(before)
    rows = [(i, "x" * draw.randrange(200), draw.randrange(before) if i % 3 else 0) for i in range(90)]
    path = str(tmp_path / "shards")
    spark.createDataFrame(rows, "doc_id long, text string, shard int").withColumn("slot", F.lit(0).cast("long")).write.partitionBy("shard").parquet(path)
    stored = spark.read.parquet(path).withColumn("old", F.col("shard"))  # read from the path that is rewritten
    placed, moves = sharding.reshard(stored, after, old_shard="old")
    wanted = {r.doc_id: (r.shard, r.slot) for r in placed.collect()}
    touched = sharding.rewrite_files(stored, placed, moves, path, files=3)
    assert set(touched) == {s for m in moves for s in (m.source, m.target)}
    got = spark.read.parquet(path).collect()
    texts = {i: t for i, t, _ in rows}
    assert sorted((r.doc_id, r.text) for r in got) == sorted(texts.items())
    assert {r.shard for r in got} == set(range(after))
    assert all((r.shard, r.slot) == wanted[r.doc_id] for r in got if r.shard in touched)
    assert [p.name for p in (tmp_path / "shards").iterdir() if p.name.startswith(("_new", "_old"))] == []


def test_reshard_moves_the_fewest_bytes_of_rows_unlike_in_size(spark):
    draw = random.Random(17)
    for shards in (2, 3, 5):
        rows = [(i, "x" * int(2 ** draw.uniform(0, 11)), min(draw.randrange(shards + 1), draw.randrange(shards + 1))) for i in range(67)]
        placed, _ = sharding.reshard(spark.createDataFrame(rows, "doc_id long, text string, old int"), shards, old_shard="old")
        cost = sum(r["size"] for r in placed.collect() if r.shard != r.old_shard)
        sizes = {s: sorted(len(t) + 16 for _, t, o in rows if o == s) for s in range(shards + 1)}
        least, spare = divmod(len(rows), shards)
        best = min(
            sum(sum(own[: max(0, len(own) - (0 if s == shards else least + (s in bigger)))]) for s, own in sizes.items())
            for bigger in itertools.combinations(range(shards), spare)
        )
        assert cost == best


def test_queries_return_their_contracts(spark, sf_dir):
    from corpusloom.llm import queries

    wanted = {
        "op2_simhash": {"doc_id", "fingerprint", "component_id"},
        "op4_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
        "op5_toxicity": {"doc_id", "held_out", "score", "predicted"},
        "op6_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
        "op10_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    }
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name, columns in wanted.items():
        df = queries.queries()[name](spark, sf_dir)
        assert columns <= set(df.columns)
        assert df.select("doc_id").distinct().count() == n


def test_pipeline_packs_what_it_keeps(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "pii", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
    packed = corpus_pipeline.run(spark, sf_dir)
    kept = packed.select("doc_id").distinct().count()
    assert 0.6 * docs.count() < kept <= docs.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_near_copies_are_looked_for_by_fingerprints_first(spark, monkeypatch):
    import corpus_pipeline
    from corpusloom.llm import simhash

    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base), " ".join(base[:-1] + ["x"]), " ".join(f"v{i}" for i in range(200)), " ".join([*base, *base])]
    prints = [simhash.fingerprint(t, 5) for t in texts]
    near = {(i, j) for i in range(4) for j in range(i) if ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= 2}
    near = {(b, a) for a, b in near}
    assert near
    tied, asked = [], []
    links, similar = simhash.links, simhash.similar
    monkeypatch.setattr(simhash, "links", lambda *a, **k: tied.append(1) or links(*a, **k))
    monkeypatch.setattr(simhash, "similar", lambda found, *rest: asked.extend((r.a, r.b) for r in found.collect()) or similar(found, *rest))
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2] and tied and near <= set(asked)
