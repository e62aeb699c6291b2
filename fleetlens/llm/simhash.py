"""SimHash near-duplicates through pigeonhole blocks.

A 64-bit fingerprint is cut into six blocks. Two fingerprints that differ in
at most three bits agree on at least three whole blocks, so each of the 20
choices of three blocks is a join key: close pairs meet under one of them.
Distinct fingerprints, not documents, are joined: copies cost nothing.

A bucket of over ``Params.bucket`` fingerprints is cut again by the same
principle on its free bits, under keys that leave at most 15 bits free, so no
bucket of the final pass holds more than 2^15 values however skewed the data.
Within a bucket every pair's Hamming distance is verified, and only a spanning
set of links leaves it.

Rows: null text counts as empty (fingerprint zero, linked like any other); a
null id keeps its row but is nobody's component id; repeated rows share a
component; an empty table gives an empty result; extra input columns are not
read by the digest and pass through ``keep_one`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, frugal, pick, written
from .components import connected_components


@dataclass(frozen=True)
class Params:
    shingle: int = 3
    max_bits: int = 3
    seed: int = 42
    bucket: int = 2048
    blocks: int = 6
    fine_blocks: int = 7


FP = "_simhash"
CHUNK = 1 << 16  # shingles hashed at a time


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of the lower-cased (A-Z) word shingles."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    k = min(shingle, len(words))
    start, end = (end - size)[: len(words) - k + 1], end[k - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(start), CHUNK):
        spans = zip(start[at : at + CHUNK].tolist(), end[at : at + CHUNK].tolist())
        h = np.array([digest(joined[x:y], seed) for x, y in spans], np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * ones > len(start), bitorder="little").view("<u8")[0]
    return int(np.uint64(value).astype(np.int64))


def _fingerprints(p: Params, text_col: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, p.shingle, p.seed) for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(fps, pa.int64())], names=[*b.schema.names, name]
            )

    return run


def with_fingerprint(df: DataFrame, p: Params = Params(), text_col: str = "text", name: str = FP) -> DataFrame:
    """``df`` with the fingerprint as column ``name``, which it must not have."""
    from pyspark.sql.types import LongType, StructType

    schema = StructType([*df.schema.fields]).add(name, LongType())
    return df.mapInArrow(frugal(_fingerprints(p, text_col, name)), schema)


def block_masks(bits: list[int], blocks: int, fixed: int) -> list[int]:
    """Masks of every choice of ``fixed`` of ``blocks`` near-equal blocks."""
    parts = [[int(b) for b in x] for x in np.array_split(np.array(bits), blocks)]
    return [sum(1 << b for part in chosen for b in part) for chosen in combinations(parts, fixed)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    """A row for each fingerprint and mask: mask number ``t``, masked value ``v``."""
    cells = F.array(*[F.lit(_signed(m)) for m in masks])
    rows = fps.select("fp", F.posexplode(cells).alias("t", "mask"))
    return rows.select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("v"))


def _rekeyed(large: DataFrame, masks: list[int], p: Params) -> DataFrame:
    """Rows of large buckets (fp, t) under the finer masks of their bucket:
    the same cut, over the bits that mask ``t`` leaves free."""
    fine = []
    for m in masks:
        free = [b for b in range(64) if not m >> b & 1]
        finer = block_masks(free, p.fine_blocks, p.fine_blocks - p.max_bits)
        fine.append(F.array(*[F.lit(_signed(x | m)) for x in finer]))
    own = F.element_at(F.array(*fine), F.col("t") + 1)
    rows = large.select("fp", F.col("t").alias("t0"), F.posexplode(own).alias("t", "mask"))
    return rows.select("fp", "t0", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("v"))


def _near(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, root) for the values of a bucket that link to another one.

    All pairs are compared, in blocks of rows; labels spread until stable.
    """
    n, rows = len(values), max(1, (1 << 22) // max(len(values), 1))
    label = np.arange(n)
    while True:
        new = label.copy()
        for at in range(0, n, rows):
            close = np.bitwise_count(values[at : at + rows, None] ^ values[None, :]) <= max_bits
            low = np.where(close, label[None, :], n).min(axis=1)
            new[at : at + rows] = np.minimum(new[at : at + rows], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = label != np.arange(n)
    return values[linked], values[label[linked]]


def _runs(p: Params, keys: list[str]):
    """Sorted (keys..., fp) rows -> links within each run of equal keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(block: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero((block[1:, :-1] != block[:-1, :-1]).any(axis=1)) + 1
            a, b = [], []
            for part in np.split(block[:, -1], cut):
                if len(part) > 1:
                    x, y = _near(part.view(np.uint64), p.max_bits)
                    a.append(x)
                    b.append(y)
            join = lambda xs: np.concatenate(xs).view(np.int64) if xs else np.empty(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(join(a)), pa.array(join(b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.asarray(batch.column(c).cast(pa.int64())) for c in [*keys, "fp"]]
            block = np.column_stack(cols)
            if held:
                block = np.concatenate([*held, block])
            # the last run may go on in the next batch; a run is bounded (see module)
            last = (block[:, :-1] != block[-1, :-1]).any(axis=1)
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            if cut:
                yield links(block[:cut])
            held = [block[cut:]]
        if held:
            yield links(held[0])

    return run


def _linked(members: DataFrame, keys: list[str], p: Params) -> DataFrame:
    sorted_runs = members.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys, "fp")
    return sorted_runs.mapInArrow(frugal(_runs(p, keys)), "a long, b long")


def links(fps: DataFrame, p: Params = Params()) -> DataFrame:
    """Links (a, b) that span the classes of distinct fingerprints ``fp``
    under "at most ``max_bits`` bits differ". Exact."""
    fixed = p.blocks - p.max_bits
    masks = block_masks(list(range(64)), p.blocks, fixed)
    keyed = _keyed(fps, masks)
    sizes = written(
        keyed.groupBy("t", "v")
        .agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
        .filter("n > 1"),
        "buckets",
    )
    pairs = (
        sizes.filter("n = 2")
        .filter(F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) <= p.max_bits)
        .select(F.col("hi").alias("a"), F.col("lo").alias("b"))
    )
    members = keyed.join(sizes.filter("n > 2").select("t", "v", "n"), ["t", "v"])
    small = _linked(members.filter(F.col("n") <= p.bucket), ["t", "v"], p)
    large = _linked(_rekeyed(members.filter(F.col("n") > p.bucket), masks, p), ["t0", "t", "v"], p)
    return pairs.union(small).union(large)


def _rooted(docs: DataFrame, p: Params) -> DataFrame:
    """fp, n, low, root, linked: each fingerprint of ``docs`` (doc_id, fp) with
    its rows, its smallest id and the smallest fingerprint it links to."""
    own = written(docs.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "fingerprints")
    comp = connected_components(links(own.select("fp"), p))
    return own.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "n", "low", F.coalesce("component", "fp").alias("root"), F.col("component").isNotNull().alias("linked")
    )


def classes(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(fp, component_id) for the fingerprints of ``docs`` (doc_id, fp) that
    several documents share or that link to others."""
    joined = _rooted(docs, p)
    lows = joined.filter("linked").groupBy("root").agg(F.min("low").alias("root_low"))
    return written(
        joined.filter("linked OR n > 1")
        .join(lows, "root", "left")
        .select("fp", F.coalesce("root_low", "low").alias("component_id")),
        "classes",
    )


def near_duplicates(df: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: one row per input row."""
    docs = pick(df, doc_id="doc_id", text="text")
    fps = written(with_fingerprint(docs, p).select("doc_id", F.col(FP).alias("fp")), "simhash")
    named = fps.join(classes(fps, p), "fp", "left")
    return named.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_one(df: DataFrame, p: Params = Params()) -> DataFrame:
    """``df`` with one row of each class: that with the smallest doc_id (equal
    ids: the smallest fingerprint's; no id at all: likewise). A class is known
    by its root fingerprint: rows of one id or without an id are not alike."""
    own = fresh(df, FP)
    thin = with_fingerprint(pick(df, doc_id="doc_id", text="text"), p).select("doc_id", F.col(FP).alias("fp"))
    rooted = _rooted(written(thin, "simhash"), p)
    first = F.min(F.struct(F.col("low").isNull().alias("none"), "low", "fp")).alias("first")
    stay_id, stay_fp = fresh(df, "_stay_id"), fresh(df, "_stay_fp")
    stay = rooted.groupBy("root").agg(first).select(F.col("first.low").alias(stay_id), F.col("first.fp").alias(stay_fp))
    stay = written(stay, "stay")
    # Fingerprints are made again beside the rows: a table of whole rows would
    # take the corpus's size on disk once more.
    marked = with_fingerprint(df, p, name=own)
    hit = marked["doc_id"].eqNullSafe(stay[stay_id]) & (marked[own] == stay[stay_fp])
    return marked.join(stay, hit, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
