"""Personal data by candidate gradient boosting, in native expressions only.

1. Strict patterns with validators (octets, Luhn, digit counts) give base spans: they always stay.
2. High-recall generators propose spans that may overlap each other and the base: addresses
   with a spelt-out at or dot, digits in any grouping, colon groups.
3. Each candidate has twelve yes/no features of its format and context, none of which shows what the
   validator of its kind looks at: the form of an address without its spellings, the eight groups of a long ip,
   the check digit of a card, the plus sign of a phone.  The validator's word is the label.
   Candidates of all documents are counted by feature pattern and label, which makes at most
   2^12 rows; boosted trees of depth two are fitted to the patterns of one half of the documents,
   and for each kind a threshold is set on the other half for a wanted precision.
4. The trees are compiled into one column expression.  A candidate that touches no base span is
   added if it reaches the threshold of its kind and is not refuted: addresses, ips and cards must pass
   their validator once separators and spellings are removed; a phone need only have 8 to 15
   digits, as it is the plus sign that it lacks.

Positions are code points from 0, ends exclusive.  Null texts count as empty; repeated rows are
searched each by itself; null ids are one id; other columns are kept, whatever their names, but for
``base_spans`` and ``spans``.  Without candidates, or with too few to set a threshold, no span is added.
An empty table gives an empty one.

Positions of matches come from splitting the text at the pattern and summing lengths, in blocks,
so the work stays near linear for a text with very many matches.  The patterns are possessive:
the engine neither recurses nor backtracks over long runs.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hidden, shown, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Matches of the strict patterns, leftmost and without overlap.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of candidates: anything around an at sign, digits in any grouping, colon groups.
LOOSE = {
    "at": r"(?:\G|(?<![^\s@<>()\[\]\",;]))[^\s@<>()\[\]\",;]++\x20?(?:@|\(at\)|\[at\])\x20?[^\s@<>()\[\]\",;]++(?:\x20?(?:\(dot\)|\[dot\])\x20?[^\s@<>()\[\]\",;]++)*+",
    "digits": r"[+(]?[0-9][0-9\x20().-]{5,30}[0-9]",
    "colons": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}",
}
NEEDS = {"email": "@", "phone": "[+]", "ip": "[0-9][.][0-9]", "card": "[0-9]", "at": r"@|[(\[]at[)\]]", "digits": "[0-9]", "colons": ":"}
HINT = r"(?i)(mail|tel|phone|call|fax|card|visa|contact|\bip\b|host)[^\p{L}]*$"
BLOCK = 256
ROUNDS = 40
RATE = 0.3
PRECISION = 0.9
#: Fewest held-out candidates behind a threshold.
LEAST = 20


def _only_digits(x: Column) -> Column:
    return F.translate(x, "+ ().-", "")


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int") <= 255, F.ltrim(p, F.lit("0")) == ""))
    digits = _only_digits(x)
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda a, v: a + v)


def _block_sums(lengths: Column) -> Column:
    blocks = F.sequence(F.lit(0), F.floor(F.size(lengths) / BLOCK).cast("int"))
    return F.transform(blocks, lambda b: _sum(F.slice(lengths, b * BLOCK + 1, BLOCK)))


def _strict_spans(kind: str, number: int) -> Column:
    matches = F.filter(f"_m_{kind}", lambda m: _valid(kind, m["x"]))
    return F.transform(matches, lambda m: F.struct(F.lit(number).alias("k"), m["s"].alias("s"), m["e"].alias("e")))


ADDRESS = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"
LONG_IP = r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$"


def _sure(kind: str, x: Column) -> Column:
    """What the validator says of a candidate without its separators and spellings."""
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(x, r"\x20?(?:@|\(at\)|\[at\])\x20?", "@"), r"\x20?(?:\(dot\)|\[dot\])\x20?", ".")
        return F.regexp_replace(plain, r"[.]+$", "").rlike(ADDRESS)
    if kind == "ip":
        return x.rlike(LONG_IP)
    return _valid(kind, x) & (x.startswith("+") if kind == "phone" else F.lit(True))


def locate(docs: DataFrame, patterns: dict[str, str], text_col: str) -> DataFrame:
    """Adds for each pattern a column _m_<name>: array of (s, e, x, before, after).

    Every array is used more than once by the projection after it, so that the optimizer does not
    move its making into a lambda.
    """
    keep = docs.columns
    none = F.array().cast("array<string>")
    step = docs.select(
        *keep,
        *[F.when(F.col(text_col).rlike(NEEDS[n]), F.regexp_extract_all(text_col, F.lit(p), 0)).otherwise(none).alias(f"_f_{n}") for n, p in patterns.items()],
    )
    step = step.select("*", *[F.when(F.size(f"_f_{n}") > 0, F.split(text_col, p, -1)).otherwise(none).alias(f"_p_{n}") for n, p in patterns.items()])
    step = step.select("*", *[F.zip_with(f"_p_{n}", f"_f_{n}", lambda p, f: F.length(p) + F.coalesce(F.length(f), F.lit(0))).alias(f"_l_{n}") for n in patterns])
    step = step.select("*", *[_block_sums(F.col(f"_l_{n}")).alias(f"_b_{n}") for n in patterns])

    def spans(n: str) -> Column:
        found, parts, lengths, blocks = (F.col(f"_{c}_{n}") for c in "fplb")

        def place(x: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            start = _sum(F.slice(blocks, F.lit(1), block)) + _sum(F.slice(lengths, block * BLOCK + 1, F.pmod(i, F.lit(BLOCK)))) + F.length(F.get(parts, i))
            return F.struct(start.alias("s"), (start + F.length(x)).alias("e"), x.alias("x"), F.right(F.get(parts, i), F.lit(16)).alias("before"), F.left(F.get(parts, i + 1), F.lit(1)).alias("after"))

        return F.when(F.size(blocks) >= 0, F.transform(found, place)).alias(f"_m_{n}")

    return step.select(*keep, *[spans(n) for n in patterns])


def with_candidates(text: DataFrame) -> DataFrame:
    """Of docs with hidden names and ``_t``: also ``_base`` (k, s, e) in order of kind and start, and ``_found`` (k, s, e, bits, sure, free)."""
    keep = [c for c in text.columns if c != "_t"]
    found = locate(text, STRICT | LOOSE, "_t")
    base = F.concat(*[_strict_spans(k, i) for i, k in enumerate(KINDS)])
    found = found.select(*keep, base.alias("_base"), *[f"_m_{n}" for n in (*LOOSE, "phone", "card")])

    def candidate(m: Column, number: int) -> Column:
        x, kind = m["x"], KINDS[number]
        digits = F.length(_only_digits(x))
        glued = r"^[\p{L}\p{N}]$"
        yes = [
            F.lit(number % 2 == 1), F.lit(number >= 2), digits.between(10, 13), digits >= 16, x.contains("("), x.contains("-"), x.contains(" "), x.contains("."),
            m["before"].rlike(HINT), F.right(m["before"], F.lit(1)).rlike(glued), m["after"].rlike(glued), F.left(_only_digits(x), F.lit(1)).isin("3", "4", "5", "6"),
        ]
        bits = F.lit(0)
        for i, c in enumerate(yes):
            bits = bits + F.when(c, 1 << i).otherwise(0)
        free = ~F.exists("_base", lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"]))
        return F.struct(F.lit(number).alias("k"), m["s"].alias("s"), m["e"].alias("e"), bits.alias("bits"), _sure(kind, x).alias("sure"), free.alias("free"), digits.alias("digits"))

    def of(name: str, number: int, least: int = 0, most: int = 0) -> Column:
        some = F.filter(f"_m_{name}", lambda m: F.length(_only_digits(m["x"])).between(least, most)) if most else F.col(f"_m_{name}")
        return F.transform(some, lambda m: candidate(m, number))

    arrays = [of("at", 0), of("colons", 1), of("phone", 3), of("digits", 3, 7, 12), of("digits", 2, 13, 19), of("card", 3, 7, 12), of("card", 2, 13, 19)]
    return found.select(*keep, "_base", F.array_distinct(F.concat(*arrays)).alias("_found"))


@dataclass(frozen=True)
class Tree:
    """Depth two: ``first`` decides between two second features; leaves by (first, second)."""

    first: int
    second: tuple[int, int]
    leaves: tuple[tuple[float, float], tuple[float, float]]

    def value(self, bits: int) -> float:
        a = bits >> self.first & 1
        return self.leaves[a][bits >> self.second[a] & 1]


@dataclass(frozen=True)
class Model:
    start: float = 0.0
    trees: tuple[Tree, ...] = ()
    #: For each kind.
    thresholds: tuple[float, ...] = (math.inf,) * len(KINDS)

    def score(self, bits: int) -> float:
        return self.start + sum(t.value(bits) for t in self.trees)

    def compiled(self) -> Callable[[Column], Column]:
        def on(bits: Column, i: int) -> Column:
            return bits.bitwiseAND(F.lit(1 << i)) != 0

        def evaluate(bits: Column) -> Column:
            total = F.lit(self.start)
            for t in self.trees:
                low, high = (F.when(on(bits, s), F.lit(leaf[1])).otherwise(F.lit(leaf[0])) for s, leaf in zip(t.second, t.leaves, strict=True))
                total = total + F.when(on(bits, t.first), high).otherwise(low)
            return total

        return evaluate


FEATURES = 12


def boost(counts: dict[int, tuple[int, int]], rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """Trees from {bits: (not sure, sure)} by second-order boosting of the log loss."""
    total, sure = sum(n + p for n, p in counts.values()), sum(p for _, p in counts.values())
    if not total:
        return Model()
    start = math.log((sure + 0.5) / (total - sure + 0.5))
    score = dict.fromkeys(counts, start)
    trees: list[Tree] = []
    for _ in range(rounds):
        slopes = {}
        for bits, (n, p) in counts.items():
            q = 1 / (1 + math.exp(-score[bits]))
            slopes[bits] = (p - (n + p) * q, (n + p) * q * (1 - q))

        def sums(rows: list[int], i: int, slopes: dict = slopes) -> list[list[float]]:
            out = [[0.0, 0.0], [0.0, 0.0]]
            for b in rows:
                side = out[b >> i & 1]
                side[0] += slopes[b][0]
                side[1] += slopes[b][1]
            return out

        gain = lambda s: sum(g * g / (h + 1.0) for g, h in s)
        first = max(range(FEATURES), key=lambda i: gain(sums(list(counts), i)))
        second, leaves = [], []
        for side in (0, 1):
            rows = [b for b in counts if b >> first & 1 == side]
            i = max(range(FEATURES), key=lambda j: gain(sums(rows, j)))
            second.append(i)
            leaves.append(tuple(rate * g / (h + 1.0) for g, h in sums(rows, i)))
        tree = Tree(first, tuple(second), tuple(leaves))
        trees.append(tree)
        for b in counts:
            score[b] += tree.value(b)
    return Model(start, tuple(trees))


def calibrate(model: Model, counts: dict[int, tuple[int, int]], precision: float = PRECISION) -> Model:
    """For each kind the lowest threshold with the wanted precision among held-out candidates."""
    chosen = []
    for kind in range(len(KINDS)):
        best, sure, total = math.inf, 0, 0
        by_score: dict[float, list[int]] = {}
        for bits, (n, p) in counts.items():
            if bits % len(KINDS) == kind:
                both = by_score.setdefault(model.score(bits), [0, 0])
                both[0] += n
                both[1] += p
        for value in sorted(by_score, reverse=True):
            n, p = by_score[value]
            sure, total = sure + p, total + n + p
            # Each score by itself must be as good: a sure pattern must not carry a doubtful one along.
            if p < precision * (n + p):
                break
            if total >= LEAST:
                best = value
        chosen.append(best - 1e-9)
    return Model(model.start, model.trees, tuple(chosen))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Counts over all candidates of docs; at most 2^12 patterns for each half reach the driver."""
    half = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 2
    narrow = with_candidates(docs.select(half.alias("half"), text_or_empty(text_col).alias("_t")))
    # Outer, as an inner explode makes the optimizer infer a filter that repeats the whole search.
    each = narrow.select("half", F.explode_outer("_found").alias("c")).filter("c is not null").groupBy("half", "c.bits").agg(F.count_if("c.sure").alias("p"), F.count(F.lit(1)).alias("n"))
    halves: list[dict[int, tuple[int, int]]] = [{}, {}]
    for r in sorted(each.collect()):
        halves[r["half"]][r["bits"]] = (r["n"] - r["p"], r["p"])
    return calibrate(boost(halves[1]), halves[0])


def _spans(docs: DataFrame, model: Model, text_col: str) -> tuple[DataFrame, dict[str, str]]:
    """Hidden columns with ``_base`` and ``_all`` (k, s, e), and the hidden names."""
    own, names = hidden(docs)
    evaluate = model.compiled()
    found = with_candidates(own.select("*", text_or_empty(names[text_col]).alias("_t")))
    if any(map(math.isfinite, model.thresholds)):
        least = F.array(*[F.lit(t if math.isfinite(t) else 1e300) for t in model.thresholds])
        usable = lambda c: F.when(c["k"] == KINDS.index("phone"), c["digits"].between(8, 15)).otherwise(c["sure"])
        chosen = F.filter("_found", lambda c: c["free"] & usable(c) & (evaluate(c["bits"]) >= F.get(least, c["k"])))
        added = F.transform(chosen, lambda c: F.struct(c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e")))
    else:
        added = F.array().cast("array<struct<k:int,s:int,e:int>>")
    return found.select(*own.columns, F.sort_array("_base").alias("_base"), F.sort_array(F.array_distinct(F.concat(F.col("_base"), added))).alias("_all")), names


def _named(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.transform(spans, lambda x: F.struct(F.get(kinds, x["k"]).alias("kind"), x["s"].alias("start"), x["e"].alias("end")))


def find(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with ``base_spans`` and ``spans``: arrays of (kind, start, end) by kind as listed, then start."""
    found, names = _spans(docs, model, text_col)
    return found.select(*shown(names, ("base_spans", "spans")), _named("_base").alias("base_spans"), _named("_all").alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in brackets; overlapping spans become one.

    A null text stays null; ``n_chars``, where there is one, follows the new text.
    """
    found, names = _spans(docs, model, text_col)
    keep = list(names.values())
    found = found.select(*keep, F.sort_array(F.transform(_named("_all"), lambda x: F.struct(x["start"].alias("s"), x["end"].alias("e"), x["kind"].alias("k")))).alias("_s"))
    text = F.col(names[text_col])
    last = lambda a: F.element_at(a, -1)
    one = "array<struct<s:int,e:int,k:string>>"
    merged = F.aggregate(
        "_s",
        F.array().cast(one),
        lambda a, x: F.when(
            (F.size(a) > 0) & (x["s"] < F.get(a, F.size(a) - 1)["e"]),
            F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(last(a)["s"].alias("s"), F.greatest(last(a)["e"], x["e"]).alias("e"), last(a)["k"].alias("k")))),
        ).otherwise(F.concat(a, F.array(x))),
    )
    found = found.select(*keep, F.when(F.size("_s") > 0, merged).alias("_u"))
    u = F.col("_u")
    pieces = F.transform(u, lambda x, i: F.concat(F.substr(text, F.coalesce(F.get(u, i - 1)["e"], F.lit(0)) + 1, x["s"] - F.coalesce(F.get(u, i - 1)["e"], F.lit(0))), F.lit("["), F.upper(x["k"]), F.lit("]")))
    rest = F.substr(text, last(u)["e"] + 1, F.length(text))
    new = F.when(u.isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), rest))
    out = found.select(*[new.alias(c) if c == names[text_col] else F.col(c) for c in keep])
    if "n_chars" in names:
        out = out.withColumn(names["n_chars"], F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*shown(names))
