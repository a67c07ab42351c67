"""Resharding by minimum-cost flow.

Old shard sizes and new capacities make a flow network: each shard may keep rows at no cost, or
send blocks of rows, smallest rows first, through a hub to shards with room, at the block's mean
bytes for each row.  The solver sends the fewest bytes that reach the capacities.  The network
has one node for each shard and up to three arcs: the rows that a shard must give, the one more that it
may have to give, and the rest; so the mean is exact where the flow has a choice.

Rows are then ranked by size within their shard (a range sort, no shard in one task); the first
ranks of a shard with a surplus move, as the flow says, and every slot follows from a rank.
Only shards that give or take rows need their files written again.
"""

from __future__ import annotations

import uuid
from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, global_rank, text_or_empty

OVERHEAD = 16


class Network:
    """Minimum-cost flow by successive shortest paths over integer capacities."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[float] = []

    def arc(self, a: int, b: int, room: int, cost: float = 0.0) -> int:
        for node, end, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[node].append(len(self.to))
            self.to.append(end)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def flow(self, arc: int) -> int:
        return self.room[arc ^ 1]

    def solve(self, source: int, sink: int) -> int:
        total = 0
        while True:
            far = [float("inf")] * len(self.out)
            came = [-1] * len(self.out)
            far[source] = 0.0
            todo, waiting = deque([source]), {source}
            while todo:
                a = todo.popleft()
                waiting.discard(a)
                for e in self.out[a]:
                    b = self.to[e]
                    if self.room[e] and far[a] + self.cost[e] < far[b] - 1e-9:
                        far[b], came[b] = far[a] + self.cost[e], e
                        if b not in waiting:
                            waiting.add(b)
                            todo.append(b)
            if came[sink] < 0:
                return total
            path, node = [], sink
            while node != source:
                path.append(came[node])
                node = self.to[came[node] ^ 1]
            step = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= step
                self.room[e ^ 1] += step
            total += step


@dataclass(frozen=True)
class Transfer:
    source: int
    target: int
    rows: int


def plan(blocks: dict[int, list[tuple[int, int]]], capacity: dict[int, int], spare: int = 0) -> list[Transfer]:
    """Transfers that move the fewest bytes.

    blocks: for each old shard its (rows, bytes) blocks, smallest rows first.  capacity: rows of
    each new shard; ``spare`` shards may take one row more, the flow chooses which.  A shard that
    is missing in capacity is emptied.  Raises ValueError if the rows do not fit.
    """
    shards = sorted({*blocks, *capacity})
    count = len(shards)
    source, hub, extra, sink = 2 * count, 2 * count + 1, 2 * count + 2, 2 * count + 3
    net = Network(2 * count + 4)
    sent: dict[int, list[int]] = {}
    taken: dict[int, int] = {}
    rows = 0
    for k, shard in enumerate(shards):
        own = blocks.get(shard, [])
        held = sum(n for n, _ in own)
        rows += held
        net.arc(source, k, held)
        net.arc(k, count + k, held)
        sent[shard] = [net.arc(k, hub, n, size / n) for n, size in own if n]
        taken[shard] = net.arc(hub, count + k, rows + sum(capacity.values()))
        net.arc(count + k, sink, capacity.get(shard, 0))
        if spare and shard in capacity:
            net.arc(count + k, extra, 1)
    net.arc(extra, sink, spare)
    if net.solve(source, sink) < rows:
        raise ValueError("the capacities are smaller than the rows")
    gives = [[s, sum(net.flow(e) for e in sent[s])] for s in shards]
    takes = [[s, net.flow(taken[s])] for s in shards]
    for g, t in zip(gives, takes, strict=True):  # through the hub and back is staying
        same = min(g[1], t[1])
        g[1] -= same
        t[1] -= same
    moves: list[Transfer] = []
    takes = [t for t in takes if t[1]]
    for shard, left in gives:
        while left:
            n = min(left, takes[0][1])
            moves.append(Transfer(shard, takes[0][0], n))
            left -= n
            takes[0][1] -= n
            if not takes[0][1]:
                takes.pop(0)
    return moves


def reshard(docs: DataFrame, shards: int, old_shard: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[Transfer]]:
    """Spread rows so that shard counts are at most one apart, moving the fewest bytes.

    Returns (id, size, text_crc32, old_shard, shard, slot) and the transfers.  ``old_shard``
    names a column with the present shard (null: shard 0; shards beyond the new ones are
    emptied); without it the rows are taken to lie by the crc32 of their id.  A null text has no
    bytes; a very long one is a large row like others.  An empty table has no shards.  Columns other
    than the id, the text and ``old_shard`` are ignored, whatever their names.  Repeated rows are placed each by itself; slots of rows
    alike in shard, size, text and id are dealt in any order.
    """
    size = (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + OVERHEAD).cast("long")
    crc = F.crc32(text_or_empty(text_col).cast("binary"))
    old = fold(shards, id_col) if old_shard is None else F.coalesce(F.col(old_shard), F.lit(0))
    rows = docs.select(F.col(id_col).alias("_id"), size.alias("size"), crc.alias("text_crc32"), old.cast("int").alias("old_shard"))
    ranked, runs = global_rank(rows, ["old_shard"], ["size", "text_crc32", "_id"])
    spark = docs.sparkSession
    held = {r["old_shard"]: r["n"] for r in runs.groupBy("old_shard").agg(F.sum("_n").alias("n")).collect()}  # a row for each shard
    held = dict.fromkeys(range(shards), 0) | held
    least, spare = divmod(sum(held.values()), shards)
    # A shard gives its smallest rows: those that it gives in any case, then the one that it may keep as a spare.
    surely = {s: max(0, n - least - 1) if s < shards else n for s, n in held.items()}
    bound = spark.createDataFrame(sorted(surely.items()), "s int, sure long")
    part = F.least(F.greatest(F.col("_rank") - F.col("sure") + 1, F.lit(0)), F.lit(2))
    by_part = ranked.join(F.broadcast(bound), F.col("old_shard") == F.col("s")).groupBy("old_shard", part.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
    blocks: dict[int, list[tuple[int, int]]] = {s: [] for s in held}
    for r in sorted(by_part.collect()):  # three rows for each shard at most
        blocks[r["old_shard"]].append((r["n"], r["b"]))
    moves = plan(blocks, dict.fromkeys(range(shards), least), spare)
    gone = {s: sum(m.rows for m in moves if m.source == s) for s in held}
    filled = {s: held[s] - gone[s] for s in range(shards)}
    legs, start = [], dict.fromkeys(held, 0)
    for m in moves:
        legs.append((m.source, start[m.source], start[m.source] + m.rows, m.target, filled[m.target]))
        start[m.source] += m.rows
        filled[m.target] += m.rows
    table = spark.createDataFrame(legs, "f int, lo long, hi long, target int, base long")
    leaves = spark.createDataFrame(sorted(gone.items()), "g int, gone long")
    moved = (F.col("old_shard") == F.col("f")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    placed = ranked.join(F.broadcast(leaves), F.col("old_shard") == F.col("g")).join(F.broadcast(table), moved, "left")
    slot = F.when(F.col("target").isNull(), F.col("_rank") - F.col("gone")).otherwise(F.col("base") + F.col("_rank") - F.col("lo"))
    out = placed.select(F.col("_id").alias(id_col), "size", "text_crc32", "old_shard", F.coalesce("target", "old_shard").alias("shard"), slot.alias("slot"))
    return out, moves


def rewrite_files(docs: DataFrame, placement: DataFrame, moves: list[Transfer], path: str, id_col: str = "doc_id", files: int | None = None) -> list[int]:
    """Write the shards that give or take rows as ``path``/shard=N, and leave the others' files.

    docs and placement are joined by id, which must be unique.  Rows are dealt over ``files`` tasks by
    ranges of shard and slot, so a large shard is written by several.  The new files are written
    beside the old ones first; then each shard is exchanged by renaming, and the files of an emptied
    shard go.  So docs may be read from the same path, but must be read anew afterwards.  Returns
    the shards that were exchanged.
    """
    touched = sorted({s for m in moves for s in (m.source, m.target)})
    if not touched:
        return []
    spark = docs.sparkSession
    where = placement.filter(F.col("shard").isin(touched)).select(id_col, "shard", "slot")
    held = docs.drop("shard", "slot")
    parts = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = held.join(where, id_col).repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot")
    mark = uuid.uuid4().hex
    new, old = f"{path}/_new-{mark}", f"{path}/_old-{mark}"
    ordered.write.partitionBy("shard").parquet(new)
    place = spark._jvm.org.apache.hadoop.fs.Path
    store = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(place(old))

    def move(a: str, b: str) -> None:
        if store.exists(place(a)) and not store.rename(place(a), place(b)):
            raise OSError(f"{a} could not be renamed to {b}")

    for shard in touched:
        move(f"{path}/shard={shard}", f"{old}/shard={shard}")
        move(f"{new}/shard={shard}", f"{path}/shard={shard}")
    for folder in (new, old):
        store.delete(place(folder), True)
    spark.catalog.refreshByPath(path)
    return touched
