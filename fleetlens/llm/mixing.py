"""Mixing sources to target weights, in fixed-length blocks.

Every source's documents are laid end to end, in id order, and cut into blocks
of ``block`` words. The mix is a sequence of slots, one block each, dealt to
output shards of ``slots_per_shard``. The counts of each source in each shard
are drawn multinomially given the sources' totals: a shard's path through a
binary tree of shards splits the totals by seeded draws, so any shard finds its
own counts and first slot ranks alone, in logarithmic time, and a rerun draws
the same. (Free multinomial draws would push a source that is capped at twice
its size above the cap.) The j-th slot of a source takes a block by a
pseudorandom permutation of the source's block indexes, a new one for each
pass over the source, so no block is taken a second time before all were taken
once. Slots and documents then meet in a join on (source, block).

Positions come from sums over ranges of 2^10 ids, and a hot source's work is
spread over its ranges and blocks. Rows of one repeated id, or without an id,
share a range; the sums of a source's blocks of 2^20 ids are ordered in one
window, which ids sparser than that fill with one number for each row.

Targets: the total is ``share`` of all words; source weights repeat in code
point order of the names, null last; a target stops at ``cap`` times its
source's size and the excess goes to the rest by weight until none is above.

Rows: null text has size 0 and takes nothing; a null source is a source of its
own; repeated ids are laid out one after another; an empty table gives an empty
result. Sources are a dimension: one row for each reaches the driver.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, frugal, n_words, pick, written

WORD_RE = re.compile(WORD)


@dataclass(frozen=True)
class Params:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    cap: float = 2.0
    block: int = 64
    slots_per_shard: int = 4096
    seed: int = 2024


def targets(sizes: list[int], p: Params) -> list[float]:
    """Water-filled targets of the sources, given in weight order."""
    n = len(sizes)
    weight = [p.weights[i % len(p.weights)] for i in range(n)]
    limit = [p.cap * s for s in sizes]
    open_, out, left = set(range(n)), [0.0] * n, p.share * sum(sizes)
    while open_:
        unit = left / sum(weight[i] for i in open_)
        over = [i for i in open_ if weight[i] * unit > limit[i]]
        if not over:
            for i in open_:
                out[i] = weight[i] * unit
            break
        for i in over:
            out[i] = limit[i]
            left -= limit[i]
            open_.discard(i)
        left = max(left, 0.0)
    return out


LARGEST_DRAW = 10**9 - 1  # rows that the library's hypergeometric sampler takes


def _log_growth(a: int, d: int) -> float:
    """log((a + d)! / a!) - d log(max(a, 1)), without cancellation."""
    if a < 10_000 or a + d < 10_000:
        return math.lgamma(a + d + 1) - math.lgamma(a + 1) - d * math.log(max(a, 1))
    x = math.log1p(d / a)
    return (a + d + 0.5) * x - d + 1 / (12 * (a + d)) - 1 / (12 * a)


def drawn(good: int, bad: int, want: int, rng: np.random.Generator, largest: int = LARGEST_DRAW) -> int:
    """A hypergeometric draw of any size: how many of ``want`` rows taken
    without replacement from ``good + bad`` are good.

    The library's sampler stops at 10^9 rows. Beyond, the same law is sampled
    by ratio of uniforms: a point of the enclosing rectangle is accepted where
    it lies under the mass function, whose ratio to its peak is computed from
    differences of log factorials.
    """
    low, high = max(0, want - bad), min(good, want)
    if low == high:
        return low
    if good + bad <= largest:
        return int(rng.hypergeometric(good, bad, want))
    total = good + bad
    share = good / total
    mean = want * share
    spread = math.sqrt(mean * (1 - share) * ((total - want) / max(total - 1, 1)) + 0.5)
    peak = min(max((good + 1) * (want + 1) // (total + 2), low), high)
    cells = (peak, good - peak, want - peak, bad - want + peak)
    slope = math.log(max(cells[0], 1) * max(cells[3], 1)) - math.log(max(cells[1], 1) * max(cells[2], 1))
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    while True:
        u, v = rng.random(2).tolist()
        if u == 0.0:
            continue
        k = math.floor(mean + 0.5 + width * (v - 0.5) / u)
        if not low <= k <= high:
            continue
        d = k - peak
        grown = _log_growth(cells[0], d) + _log_growth(cells[1], -d) + _log_growth(cells[2], -d) + _log_growth(cells[3], d)
        if 2 * math.log(u) <= -grown - d * slope:
            return k


def split_counts(counts: np.ndarray, left: int, rng: np.random.Generator) -> np.ndarray:
    """How many of ``left`` draws without replacement fall to each source."""
    out = np.zeros_like(counts)
    total, want = int(counts.sum()), int(left)
    for i, c in enumerate(counts.tolist()):
        total -= c
        if want <= 0:
            break
        out[i] = drawn(c, total, want, rng)
        want -= int(out[i])
    return out


def shard_draw(shard: int, shards: int, slots: int, counts: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(first slot rank, count) of every source in one shard."""
    lo, hi = 0, shards
    first = np.zeros_like(counts)
    node = counts.copy()
    while hi - lo > 1:
        mid = (lo + hi) // 2
        in_left = min(slots, mid * p.slots_per_shard) - min(slots, lo * p.slots_per_shard)
        left = split_counts(node, in_left, np.random.default_rng([p.seed, lo, hi]))
        if shard < mid:
            hi, node = mid, left
        else:
            lo, first, node = mid, first + left, node - left
    return first, node


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(size): a four-round Feistel network
    on the smallest even-bit square that holds it, walked until inside."""
    if size <= 1:
        return index.copy()
    half = max(1, (int(size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(1, 1 << 62, size=4).astype(np.uint64)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            x = out[todo]
            a, b = x >> np.uint64(half), x & mask
            for k in keys:
                f = (b + k) * np.uint64(0x9E3779B97F4A7C15)
                f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                a, b = b, a ^ ((f >> np.uint64(32)) & mask)
            x = (a << np.uint64(half)) | b
            out[todo] = x
            todo = todo[x >= np.uint64(size)]
    return out.astype(np.int64)


@dataclass(frozen=True)
class Plan:
    """What the driver knows of the mix: a few numbers for each source."""

    names: list  # str or None
    sizes: list[int]
    targets: list[float]
    blocks: list[int]
    slots: list[int]

    @property
    def total_slots(self) -> int:
        return sum(self.slots)


def plan(sized: DataFrame, p: Params) -> Plan:
    """``sized``: (source, size). One row for each source comes back."""
    got = {r["source"]: int(r["n"] or 0) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    names = sorted((s for s in got if s is not None), key=lambda s: s.encode("utf-8", "surrogatepass"))
    names += [None] if None in got else []
    sizes = [got[s] for s in names]
    goal = targets(sizes, p)
    blocks = [-(-n // p.block) for n in sizes]
    # Slots whose expected words are the target, and never over cap passes.
    slots = [
        min(int(p.cap * b), round(t * b / n)) if n else 0
        for n, t, b in zip(sizes, goal, blocks)
    ]
    return Plan(names, sizes, goal, blocks, slots)


def _by_source(pl: Plan, values: list) -> Column:
    """A per-source constant as an expression of the ``src`` ordinal."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("src") + 1)


def positioned(sized: DataFrame, pl: Plan) -> DataFrame:
    """Adds ``src`` (ordinal) and ``start``, the words of the same source
    before the row in id order.

    Ids are cut into ranges of 2^10 (a bound on a window's rows while ids are
    distinct); a running sum within (source, range) is added to the sum of the
    ranges before, itself summed over blocks of 2^10 ranges.
    """
    if not pl.names:
        return sized.select("*", F.lit(0).alias("src"), F.lit(0).cast("long").alias("start"))
    named = {s: i for i, s in enumerate(pl.names) if s is not None}
    nulls = F.lit(len(pl.names) - 1)
    src = nulls
    if named:
        src = F.coalesce(F.create_map(*[F.lit(x) for kv in named.items() for x in kv])[F.col("source")], nulls)
    rows = sized.withColumn("src", src).withColumn(
        "r1", F.coalesce(F.shiftright("doc_id", 10), F.lit(-(1 << 62)))
    ).withColumn("r2", F.shiftright("r1", 10))
    order = [F.col("doc_id").asc_nulls_first(), "size", "dk", "nth"]
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    own = F.coalesce(F.sum("size").over(before(Window.partitionBy("src", "r2", "r1").orderBy(*order))), zero)
    r1 = rows.groupBy("src", "r2", "r1").agg(F.sum("size").alias("n1"))
    r2 = r1.groupBy("src", "r2").agg(F.sum("n1").alias("n2"))
    r2 = r2.select("src", "r2", F.coalesce(F.sum("n2").over(before(Window.partitionBy("src").orderBy("r2"))), zero).alias("s2"))
    r1 = r1.select(
        "src", "r2", "r1",
        F.coalesce(F.sum("n1").over(before(Window.partitionBy("src", "r2").orderBy("r1"))), zero).alias("s1"),
    )
    starts = written(r1.join(r2, ["src", "r2"]).select("src", "r1", (F.col("s1") + F.col("s2")).alias("s")), "starts")
    return (
        rows.withColumn("own", own).join(starts, ["src", "r1"])
        .withColumn("start", F.col("own") + F.col("s")).drop("own", "s", "r1", "r2")
    )


def draws(spark, pl: Plan, p: Params) -> DataFrame:
    """(src, block, pass, shard): the mix's slots, one row each; a shard's rows
    are made by the task that holds the shard."""
    shards = -(-pl.total_slots // p.slots_per_shard)
    counts = np.array(pl.slots, np.int64)
    slots, blocks = pl.total_slots, pl.blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                first, n = shard_draw(shard, shards, slots, counts, p)
                cells: list[list[np.ndarray]] = [[], [], []]
                for s in np.flatnonzero(n).tolist():
                    j = np.arange(first[s], first[s] + n[s])
                    turn, at = j // blocks[s], j % blocks[s]
                    got = np.empty_like(at)
                    for e in np.unique(turn).tolist():
                        m = turn == e
                        got[m] = permuted(at[m], blocks[s], hash_key(p.seed, s, e))
                    for cell, v in zip(cells, (np.full(len(j), s), got, turn)):
                        cell.append(v)
                if cells[0]:
                    src, block, turn = (np.concatenate(c) for c in cells)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(src.astype(np.int32)),
                            pa.array(block.astype(np.int64)),
                            pa.array(turn.astype(np.int32)),
                            pa.array(np.full(len(src), shard, np.int64)),
                        ],
                        names=["src", "block", "pass", "shard"],
                    )

    parts = max(1, min(shards, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, shards, 1, parts).mapInArrow(frugal(run), "src int, block long, pass int, shard long")


def hash_key(seed: int, source: int, turn: int) -> int:
    return (seed * 1_000_003 + source) * 1_000_003 + turn


def overlaps(rows: DataFrame, p: Params) -> DataFrame:
    """One row for each block a document touches: word range [from, to)."""
    first, end = F.col("start"), F.col("start") + F.col("size")
    touched = rows.filter("size > 0").select(
        "*", F.explode(F.sequence(F.floor(first / p.block), F.floor((end - 1) / p.block))).alias("block")
    )
    lo = F.greatest(F.col("block") * p.block, F.col("start")) - F.col("start")
    hi = F.least((F.col("block") + 1) * p.block, F.col("start") + F.col("size")) - F.col("start")
    return touched.select("dk", "nth", "src", "block", lo.alias("from"), hi.alias("to"))


def _row_keys(df: DataFrame, dk: str, nth: str) -> DataFrame:
    """Adds ``dk``, a hash of id and text, and ``nth``, a number among rows
    that agree in both: together they tell rows apart."""
    keyed = df.withColumn(dk, F.xxhash64(F.lit(1), df["doc_id"], df["text"]))
    return keyed.withColumn(nth, F.row_number().over(Window.partitionBy(dk).orderBy(df["source"].asc_nulls_first())))


def _sized(df: DataFrame) -> DataFrame:
    docs = pick(df, doc_id="doc_id", text="text", source="source")
    thin = docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64(F.lit(1), "doc_id", "text").alias("dk")
    )
    nth = F.row_number().over(Window.partitionBy("dk").orderBy(F.col("source").asc_nulls_first()))
    return thin.withColumn("nth", nth)


def mixed(df: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame, Plan]:
    """(documents with dk, nth, size and src; taken pieces (dk, nth, pass,
    from, to); the plan)."""
    sized = written(_sized(df), "sized")
    pl = plan(sized, p)
    rows = written(positioned(sized, pl), "positioned")
    use = draws(df.sparkSession, pl, p)
    # Slots are made from a short list of shard numbers, so the planner takes
    # them for a small table: without the hint it would broadcast them all.
    slots = use.select("src", "block", "pass").hint("merge")
    pieces = overlaps(rows, p).join(slots, ["src", "block"])
    return rows, pieces, pl


def taken_words(df: DataFrame, p: Params = Params()) -> DataFrame:
    """The contract's columns: one row per row of ``df``."""
    rows, pieces, pl = mixed(df, p)
    sums = pieces.groupBy("dk", "nth").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    zero = F.lit(0).cast("long")
    out = rows.join(sums, ["dk", "nth"], "left")
    if not pl.names:
        return out.select("doc_id", "size", zero.alias("source_size"), F.lit(0.0).alias("target"), zero.alias("taken"))
    return out.select(
        "doc_id",
        "size",
        _by_source(pl, pl.sizes).cast("long").alias("source_size"),
        _by_source(pl, [float(t) for t in pl.targets]).alias("target"),
        F.coalesce("taken", zero).alias("taken"),
    )


def mixed_documents(df: DataFrame, p: Params = Params()) -> DataFrame:
    """The mix as rows of ``df``'s columns: for every pass over a source, each
    document cut to the words that its taken blocks hold (white space between
    them kept, a whole document verbatim); ``n_chars``, where there is one,
    follows. A document no block of which was taken does not appear."""
    _, pieces, _ = mixed(df, p)
    dk, nth, turn, spans_name = (fresh(df, x) for x in ("_dk", "_nth", "_pass", "_spans"))
    spans = pieces.groupBy("dk", "nth", "pass").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias(spans_name))
    spans = spans.withColumnsRenamed({"dk": dk, "nth": nth, "pass": turn})
    names = df.columns
    joined = _row_keys(df, dk, nth).join(spans, [dk, nth]).select(*names, spans_name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [
                cut_words(t, [(s["from"], s["to"]) for s in spans])
                for t, spans in zip(b.column("text").to_pylist(), b.column(spans_name).to_pylist())
            ]
            cols = {c: b.column(c) for c in names}
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([len(t) for t in texts], pa.int64()).cast(cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    return joined.mapInArrow(frugal(run), df.schema)


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The words [from, to) of the sorted spans; touching spans are one."""
    merged: list[list[int]] = []
    for a, b in spans:
        if merged and merged[-1][1] == a:
            merged[-1][1] = b
        else:
            merged.append([a, b])
    at = [m.span() for m in WORD_RE.finditer(text)]
    if merged == [[0, len(at)]]:
        return text
    return "\n".join(text[at[a][0] : at[b - 1][1]] for a, b in merged)
