"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

A document is the set of its distinct 3-word shingles (64-bit hashes); two
documents link when ``100 * intersection >= percent * union``. The join is
exact: no link between different sets is lost.

1. Bands. Sets are put into bands of sizes; a band also takes the larger sets
   that a set of its own can still link to, so both ends of a link share the
   band of the smaller one.
2. Tiles. Linked sets of a band differ in at most D shingles. Each set is cut
   by hash into D + 1 parts, and one part at least is the same in both. Sets of
   one band that agree on a part form a bucket; buckets with the same members
   are looked at once; buckets of over ``block`` sets are cut into blocks, and
   every two blocks form a tile of their own, so no task holds a hot bucket.
   Parts of one shingle or none say little: in sets of few parts they are
   joined to each part of a second cut, which shares a part for the same reason.
3. Bitmaps. Every set carries a bitmap in which each shingle flips one bit.
   The bits in which two bitmaps differ are never more than the shingles in
   which the sets differ, so their count bounds the overlap from above. Within
   a tile a walk over pairs that pass the bound gives a forest of them.
4. Exact intersection of sorted arrays decides the pairs of the forest. Where
   one fails, the pairs of its bucket that pass the bound and lie in different
   classes are decided, too. What passes is a link; components are classes.

Equal sets meet by their hash and are never paired. Sets are told apart by 64
bits. Of a set only its keys are stored; the few sets that share a bucket are
made again from their texts.

Rows: null text counts as empty; an empty set is linked with nothing, its
component is its own id; rows equal in text share a class, whatever their ids;
a null id takes no part in the minimum (a class without any id has a null
component); very long texts are treated like others; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_filter, discard, in_filter, pick, written
from .components import connected_components

U = np.uint64
C1, C2, C3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93)
LARGEST = 1 << 40  # shingles of a set


@dataclass(frozen=True)
class Params:
    shingle: int = 3
    percent: int = 90
    step: float = 1.25  # ratio of neighbouring bands' sizes
    block: int = 512  # sets of a block
    weak: int = 1  # parts of so few shingles are cut a second time ...
    weak_parts: int = 64  # ... in sets of at most so many parts
    slice: int = 1 << 18  # shingles handled at a time
    filter_bits: int = 26  # log2 of the bits of the filter of candidates


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Bands:
    """Band j: own sizes from ``low[j]`` to below ``low[j + 1]``, members up to
    ``high[j]``, ``parts[j]`` parts, bitmaps of ``words[j]`` words."""

    def __init__(self, p: Params):
        low = [1]
        while low[-1] < LARGEST:
            low.append(max(low[-1] + 1, int(low[-1] * p.step)))
        self.low = np.array(low, np.int64)
        top = self.low[1:] - 1
        self.high = 100 * top // p.percent
        most = (100 - p.percent) * (top + self.high) // (100 + p.percent)
        self.parts = most + 1
        self.words = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(6 * most, 1) / 64)).clip(0, 16).astype(np.int64))

    def of(self, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, their band) for every band a set can have a partner in."""
        home = np.searchsorted(self.low, sizes, side="right") - 1
        for back in range(len(self.low)):
            band = home - back
            fits = (band >= 0) & (sizes > 0)
            fits[fits] = sizes[fits] <= self.high[band[fits]]
            if not fits.any():
                return
            at = np.flatnonzero(fits)
            at = at[self.parts[band[at]] > 1]  # one part: only equal sets could link
            yield at, band[at]


def shingle_set(text: str | None, k: int = 3) -> np.ndarray:
    """Sorted distinct shingle hashes of the words, A-Z lower-cased; of fewer
    than ``k`` words the whole sequence as one."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, U)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), U, len(words))
    n = min(k, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - n + 1, U(n))
        for i in range(n):
            h = _mix(h * C1 + w[i : len(w) - n + 1 + i])
    return np.unique(h)


def _set_rows(p: Params):
    """A row for each document; the keys of its buckets stand in the first row
    of a task that has the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(p), set()
        for b in batches:
            sids, sizes, fresh, sets = [], [], [], []
            for text in b.column("text").to_pylist():
                h = shingle_set(text, p.shingle)
                sid = set_id(h) if len(h) else None
                sids.append(sid)
                sizes.append(len(h))
                if sid not in seen and len(h):
                    fresh.append(len(sids) - 1)
                    sets.append(h)
                seen.add(sid)
            for lo, hi in _slices(np.array(sizes, np.int64), p.slice):
                own = [(i, h) for i, h in zip(fresh, sets) if lo <= i < hi]
                keys = _key_lists([h for _, h in own], bands, p)
                column: list = [None] * (hi - lo)
                for (i, _), k in zip(own, keys):
                    column[i - lo] = k if len(k) else None
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(lo, hi - lo), b.column("dk").slice(lo, hi - lo),
                        pa.array(sids[lo:hi], pa.int64()), pa.array(sizes[lo:hi], pa.int64()),
                        pa.array(column, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "dk", "sid", "n", "keys"],
                )

    return run


def set_id(h: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63)


def _key_lists(sets: list[np.ndarray], bands: Bands, p: Params) -> list[np.ndarray]:
    """The keys of each set; a key's low byte is its band."""
    if not sets:
        return []
    keys, rows = [], []
    for key, row, band in bucket_keys(np.concatenate(sets), np.array([len(h) for h in sets]), bands, p):
        keys.append((key & ~U(0xFF)) | band.astype(U))
        rows.append(row)
    if not keys:
        return [np.empty(0, np.int64)] * len(sets)
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    ends = np.cumsum(np.bincount(row, minlength=len(sets)))[:-1]
    return np.split(np.concatenate(keys)[order].view(np.int64), ends)


def _slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` shingles."""
    total, at = np.cumsum(sizes), 0
    while at < len(sizes):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield at, to
        at = to


def _cut(h: np.ndarray, row: np.ndarray, parts: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash sums and counts of the parts of all rows, row after row. ``row``:
    the row of each hash; ``parts``: parts of each row."""
    u = _mix(h ^ (U(seed) * C3))
    part = ((u >> U(32)) * parts[row].astype(U)) >> U(32)
    seg = np.concatenate([[0], np.cumsum(parts)[:-1]])[row] + part.astype(np.int64)
    total = int(parts.sum())
    sums = np.zeros(total, U)
    np.add.at(sums, seg, _mix(h + C2))
    return sums, np.bincount(seg, minlength=total)


def _number(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number within the row) of the parts of all rows."""
    row = np.repeat(np.arange(len(parts)), parts)
    return row, np.arange(len(row)) - np.concatenate([[0], np.cumsum(parts)[:-1]])[row]


def bucket_keys(h: np.ndarray, sizes: np.ndarray, bands: Bands, p: Params) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, row, band) of every bucket of the sets; ``h``: their hashes."""
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    for at, band in bands.of(sizes):
        if not len(at):
            continue
        place = np.full(len(sizes), -1)
        place[at] = np.arange(len(at))
        own = place[row_of]
        hs, own = h[own >= 0], own[own >= 0]
        parts = bands.parts[band]
        with np.errstate(over="ignore"):
            sums, counts = _cut(hs, own, parts, 1)
            row, number = _number(parts)
            key = _mix(_mix(sums + U(1) * C1 + number.astype(U)) + (band[row] + 1).astype(U) * C2)
            weak = (counts <= p.weak) & (parts[row] <= p.weak_parts)
            yield key[~weak], at[row[~weak]], band[row[~weak]]
            if weak.any():
                again = np.flatnonzero(np.bincount(row[weak], minlength=len(at)))
                new = np.full(len(at), -1)
                new[again] = np.arange(len(again))
                some = new[own] >= 0
                sums2, _ = _cut(hs[some], new[own[some]], parts[again], 2)
                first = np.concatenate([[0], np.cumsum(parts[again])[:-1]])
                w = np.flatnonzero(weak)
                many = parts[row[w]]
                src, inner = _number(many)
                second = sums2[first[new[row[w]]][src] + inner]
                finer = _mix(_mix(key[w][src] + second * C3) + inner.astype(U) * C1)
                yield finer, at[row[w]][src], band[row[w]][src]


def bitmap(h: np.ndarray, words: int) -> np.ndarray:
    """``words`` words in which every hash flips one bit."""
    bits = np.bincount((_mix(h ^ C2) >> U(8)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little")


def _candidate_rows(p: Params, shared):
    """(sid, n, hashes) of the texts whose ``dk`` may be in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(shared.value, U)
        for b in batches:
            at = np.flatnonzero(in_filter(words, b.column("dk").to_numpy().view(U), p.filter_bits))
            sets = [shingle_set(t, p.shingle) for t in b.column("text").take(pa.array(at)).to_pylist()]
            sets = [h for h in sets if len(h)]
            for lo, hi in _slices(np.array([len(h) for h in sets], np.int64), p.slice):
                own = sets[lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_id(h) for h in own], pa.int64()), pa.array([len(h) for h in own], pa.int64()),
                        pa.array([h.tobytes() for h in own], pa.binary()),
                    ],
                    names=["sid", "n", "hashes"],
                )

    return run


def _bitmap_rows(p: Params):
    """Rows (sid, n, hashes) -> (sid, band, n, bits), one for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(p)
        for b in batches:
            sizes, sid = b.column("n").to_numpy(), b.column("sid").to_numpy()
            hashes = b.column("hashes")
            for at, band in bands.of(sizes):
                bits = [
                    bitmap(np.frombuffer(hashes[i].as_buffer(), U), int(bands.words[j])).tobytes()
                    for i, j in zip(at.tolist(), band.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sid[at]), pa.array(band.astype(np.int16)), pa.array(sizes[at]), pa.array(bits, pa.binary())],
                    names=["sid", "band", "n", "bits"],
                )

    return run


def _passes(differ, n, m, percent: int):
    """Whether sets of ``n`` and ``m`` shingles that differ in ``differ`` or
    more can link."""
    return (100 + percent) * np.maximum(differ, abs(n - m)) <= (100 - percent) * (n + m)


def forest(sid: list[int], n: list[int], bits: list[bytes], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that pass the bound."""
    if len(sid) == 2:
        differ = (int.from_bytes(bits[0]) ^ int.from_bytes(bits[1])).bit_count()
        return [(sid[0], sid[1])] if _passes(differ, n[0], n[1], percent) else []
    sizes, maps = np.array(n), np.frombuffer(b"".join(bits), U).reshape(len(bits), -1)
    left, out = np.arange(len(sid)), []
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            i = todo.pop()
            differ = np.bitwise_count(maps[left] ^ maps[i]).sum(axis=1, dtype=np.int64)
            near = _passes(differ, sizes[i], sizes[left], percent)
            met = left[near].tolist()
            out += [(sid[i], sid[j]) for j in met]
            todo += met
            left = left[~near]
    return out


def across(sid: list[int], n: list[int], bits: list[bytes], label: list[int], percent: int) -> list[tuple[int, int]]:
    """The pairs of different labels that pass the bound."""
    sizes, labels = np.array(n), np.array(label)
    maps, out = np.frombuffer(b"".join(bits), U).reshape(len(bits), -1), []
    for i in range(len(sid) - 1):
        rest = np.flatnonzero(labels[i + 1 :] != labels[i]) + i + 1
        differ = np.bitwise_count(maps[rest] ^ maps[i]).sum(axis=1, dtype=np.int64)
        out += [(sid[i], sid[j]) for j in rest[_passes(differ, sizes[i], sizes[rest], percent)].tolist()]
    return out


TILE = ["key", "ti", "tj"]


def _tile_pairs(p: Params, labelled: bool):
    """Rows sorted by tile -> (key, a, b) pairs of each tile, a < b."""
    fields = ["sid", "n", "bits", *(["label"] if labelled else [])]
    pairs = across if labelled else forest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, [[] for _ in fields]

        def found() -> list[tuple[int, int, int]]:
            if len(held[0]) < 2:
                return []
            return [(now[0], min(a, b), max(a, b)) for a, b in pairs(*held, p.percent)]

        for b in batches:
            out = []
            names = zip(*(b.column(c).to_pylist() for c in TILE))
            for tile, *row in zip(names, *(b.column(c).to_pylist() for c in fields)):
                if tile != now:
                    out += found()
                    now, held = tile, [[] for _ in fields]
                for column, value in zip(held, row):
                    column.append(value)
            yield _pair_batch(out)
        yield _pair_batch(found())

    return run


def _pair_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "a", "b"])


def _tiles(rows: DataFrame, p: Params, labelled: bool = False) -> DataFrame:
    """Pairs of the buckets in ``rows`` (key, many: sets of the bucket, sid, n,
    bits[, label]), block by block where a bucket has several."""
    cut = rows.withColumn("blocks", F.ceil(F.col("many") / p.block).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    dealt = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select(
        "key", F.least("own", "other").alias("ti"), F.greatest("own", "other").alias("tj"), "sid", "n", "bits",
        *(["label"] if labelled else []),
    )
    sorted_tiles = dealt.repartition(*TILE).sortWithinPartitions(*TILE, "sid")
    return sorted_tiles.mapInArrow(_tile_pairs(p, labelled), "key long, a long, b long")


def _verified(p: Params):
    """Rows (a, b, x, y: hashes) -> (a, b, linked) by exact intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(b.column("x"), b.column("y")):
                s, t = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.concatenate([s, t])
                both.sort(kind="stable")  # two sorted runs: a merge
                common = int((both[1:] == both[:-1]).sum())
                linked.append(100 * common >= p.percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return run


def _decided(pairs: DataFrame, sets: DataFrame, p: Params, name: str) -> DataFrame:
    """(a, b, linked) for distinct ``pairs``."""
    x = sets.select(F.col("sid").alias("a"), F.col("hashes").alias("x"))
    y = sets.select(F.col("sid").alias("b"), F.col("hashes").alias("y"))
    return written(pairs.join(x, "a").join(y, "b").mapInArrow(_verified(p), "a long, b long, linked boolean"), name)


def set_links(docs: DataFrame, sets: DataFrame, p: Params = Params()) -> DataFrame:
    """Links (a, b) that span the classes of the sets of ``docs`` (text, dk: a
    hash of the row) under the threshold. Exact. ``sets`` has a row (dk, sid,
    keys) for each set at least; rows of one sid are equal."""
    spark = docs.sparkSession
    keys = sets.select("sid", F.explode("keys").alias("key"))
    lo_hi = keys.groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"))
    shared = written(lo_hi.filter("lo <> hi").select("key"), "shared")
    members = written(keys.join(shared, "key").distinct(), "members")
    # 40 bits of hash a member: sums of 2^23 members fit; a larger bucket stands for itself.
    sign = F.try_sum(F.shiftrightunsigned(F.xxhash64("sid"), 24)).alias("sign")
    alike = members.groupBy("key").agg(F.count("*").alias("many"), F.min("sid").alias("lo"), F.max("sid").alias("hi"), sign)
    alike = alike.withColumn("alone", F.when(F.col("sign").isNull(), F.col("key"))).withColumn("band", F.expr("key & 255"))
    buckets = written(
        alike.groupBy("band", "many", "lo", "hi", "sign", "alone").agg(F.min("key").alias("key")).select("key", "many"), "buckets"
    )
    inside = written(members.join(buckets, "key"), "inside")
    discard(shared, members, buckets)
    # Sets of buckets are made again from their texts; the filter spares the
    # other texts, the join decides.
    wanted = written(inside.select("sid").distinct(), "wanted")
    homes = sets.join(wanted, "sid").groupBy("sid").agg(F.min("dk").alias("key"))
    words = spark.sparkContext.broadcast(bit_filter(homes.select("key"), p.filter_bits))  # 2^filter_bits bits
    made = docs.select("text", "dk").mapInArrow(_candidate_rows(p, words), "sid long, n long, hashes binary")
    candidates = written(made.join(wanted, "sid", "left_semi").dropDuplicates(["sid"]), "candidates")
    bits = candidates.mapInArrow(_bitmap_rows(p), "sid long, band short, n long, bits binary")
    placed = inside.withColumn("band", F.expr("cast(key & 255 AS short)"))
    rows = placed.join(bits, ["sid", "band"]).select("key", "many", "sid", "n", "bits")
    pairs = written(_tiles(rows, p), "pairs")
    decided = _decided(pairs.select("a", "b").distinct(), candidates, p, "decided")
    links = decided.filter("linked").select("a", "b")
    failed = decided.filter("NOT linked").select("a", "b")
    if failed.isEmpty():
        return links
    # Where a pair of the forest fails, its bucket's other pairs across classes decide.
    label = connected_components(links).select(F.col("node").alias("sid"), F.col("component").alias("label"))
    open_keys = pairs.join(failed, ["a", "b"], "left_semi").select("key").distinct()
    again = rows.join(open_keys, "key", "left_semi").join(label, "sid", "left")
    again = again.withColumn("label", F.coalesce("label", "sid"))
    more = _tiles(again, p, labelled=True).select("a", "b").distinct().join(failed, ["a", "b"], "left_anti")
    return links.union(_decided(more, candidates, p, "decided").filter("linked").select("a", "b"))


def jaccard_classes(df: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row."""
    docs = pick(df, doc_id="doc_id", text="text")
    kind = dict(docs.dtypes)["doc_id"]
    docs = docs.withColumn("dk", F.xxhash64("text"))
    sets = written(
        docs.mapInArrow(_set_rows(p), f"doc_id {kind}, dk long, sid long, n long, keys array<long>"), "sets"
    )
    comp = connected_components(set_links(docs, sets.filter("keys IS NOT NULL"), p))
    named = sets.select("doc_id", "n", "sid").join(comp.withColumnRenamed("node", "sid"), "sid", "left")
    named = named.withColumn("root", F.coalesce("component", "sid"))
    lows = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("low"))
    return named.join(lows, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id")
    )
