"""Repeated passages across documents, by MinHash banding of paragraphs.

Paragraphs. Every line is compared whole with every other line, whatever its
length. In addition lines are cut where the words themselves say so (a local
minimum of a hash of three words within ``radius`` words), so a passage pasted
into the middle of a line is cut at the same places in every document; these
fragments are short and match where the words are the same. Lines are compared
with lines, fragments with fragments; both are called paragraphs below. Words
are lower-cased, shingles have five words.

1. Every paragraph gets a text hash and ``bands`` MinHash values, one a band:
   two paragraphs of Jaccard 0.8 share a band with probability
   1 - 0.2^bands (0.992 for three). The minimum and maximum of each bucket,
   first of a batch, packed by range of buckets, then of all, tell which buckets
   hold two texts or two documents.
2. The keys of those buckets, as a filter of fixed size, let a second pass
   over the texts write only paragraphs that can matter, with their shingles.
   The filter saves work and decides nothing: what it lets through in vain
   belongs to no bucket and is dropped with the classes.
3. Distinct texts of a bucket are joined by prefix filtering on their rarest
   shingles, with an exact Jaccard check; no pair within one component is
   looked at twice and only links leave the bucket.
4. Components of the links are classes. A class that lies in two documents or
   more is repeated; its first occurrence (smallest id, then place) stays. Of
   fragments it is the first outside the lines that go; a line that stays loses
   only stretches of ``min_words`` words.
5. Neighbouring repeated paragraphs of a document form a passage; passages of
   at least ``min_words`` words are results.

Rows: null text counts as empty; rows equal in id and text count as one
document; rows that share an id but not the text are different documents; a
null id sorts first; very long texts are cut like others; an empty table gives
an empty result; other columns pass through ``without_repeats`` untouched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, fresh, frugal, pick, written
from .components import connected_components

U = np.uint64
TOP = U(0xFFFFFFFFFFFFFFFF)
BASE, BASE_INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
LINE = U(0xC2B2AE3D27D4EB4F)
GROUP = 1 << 19  # characters of the texts that are cut together
PARTS = 8  # ranges of buckets that a shuffle partition holds, one after another


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 3
    radius: int = 4
    longest: int = 64  # words of a fragment
    min_words: int = 25
    filter_bits: int = 27  # log2 of the bits of the bucket filter
    seed: int = 97


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


# Fixed values of XXH64.
X1, X2, X3, X4, X5 = map(U, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << U(bits)) | (x >> U(64 - bits))


def word_hashes(text: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 of the words ``text[start : start + size]``, all words of a length
    at once; at least 7 bytes follow the last word."""
    import xxhash

    eight = np.ndarray(max(0, len(text) - 7), "<u8", text, strides=(1,))  # from each byte on
    length = np.minimum(size, 32).astype(np.uint8)  # 32: longer, too
    order = np.argsort(length, kind="stable")
    ends = np.searchsorted(length[order], np.arange(32, dtype=np.uint8), "right")
    out = np.empty(len(start), U)
    for n in range(1, 32):
        words = order[ends[n - 1] : ends[n]]
        at, left = start[words], n
        h = np.full(len(words), X5 + U(n))
        while left >= 8 and len(words):
            h ^= _turned(eight[at] * X2, 31) * X1
            h = _turned(h, 27) * X1 + X4
            at, left = at + 8, left - 8
        rest = eight[at] if left else h
        if left >= 4:
            h ^= (rest & U(0xFFFFFFFF)) * X1
            h = _turned(h, 23) * X2 + X3
            rest, left = rest >> U(32), left - 4
        for i in range(left):
            h ^= (rest >> U(8 * i) & U(255)) * X5
            h = _turned(h, 11) * X1
        h = (h ^ (h >> U(33))) * X2
        h = (h ^ (h >> U(29))) * X3
        out[words] = h ^ (h >> U(32))
    for i in order[ends[31] :].tolist():
        out[i] = xxhash.xxh64_intdigest(text[start[i] : start[i] + size[i]])
    return out


class Cutter:
    """Cuts texts into paragraphs and hashes them."""

    def __init__(self, p: Params):
        self.p = p
        keys = np.random.default_rng(p.seed).integers(1, 1 << 63, size=p.bands, dtype=np.int64)
        self.keys = keys.astype(U)
        self.pow = self.inv = np.ones(1, U)

    def _powers(self, n: int) -> None:
        if len(self.pow) < n:
            size = max(n, 2 * len(self.pow))
            with np.errstate(over="ignore"):
                self.pow = np.cumprod(np.concatenate([[U(1)], np.full(size, U(BASE))]))
                self.inv = np.cumprod(np.concatenate([[U(1)], np.full(size, U(BASE_INV))]))

    def cut(self, text: str | None) -> tuple:
        """The fragments of a text, as in :meth:`both`."""
        return self.both(text)[0]

    def both(self, text: str | None) -> tuple[tuple, tuple]:
        """The fragments of a text and its lines: each (first words and the
        end, text hashes, band values (units, bands), shingle hashes by word
        with TOP where a shingle would leave its unit)."""
        got = self.many([text or ""])
        return tuple((np.append(u.start, got.n), u.th, u.bands, u.sh) for u in (got.fragments, got.lines))

    def many(self, texts: list[str]) -> Cut:
        """The fragments and lines of texts, cut together: their words stand
        one after another, and no unit reaches over the end of a text."""
        low = [text.lower().encode("utf-8", "surrogatepass") for text in texts]
        joined = b"\n".join([*low, bytes(8)])
        c = np.frombuffer(joined, np.uint8, len(joined) - 8)
        word = np.zeros(len(c) + 1, bool)  # one place before each byte
        word[1:] = (c != 32) & ((c < 9) | (c > 13))
        turn = np.flatnonzero(word[1:] != word[:-1])
        start, size = turn[::2], turn[1::2] - turn[::2]
        # words before the end of each line and of each text
        ends = np.append(0, np.searchsorted(start, np.flatnonzero(c == 10)))
        n, k, r = len(start), self.p.shingle, self.p.radius
        w = word_hashes(joined, start, size)
        size = np.diff(np.searchsorted(start, np.cumsum([len(x) + 1 for x in low])), prepend=0)
        base = np.cumsum(size) - size
        doc = np.repeat(np.arange(len(texts)), size)
        if not n:
            none = Units(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U), np.empty((0, self.p.bands), U), w)
            return Cut(0, base, doc, none, none)
        self._powers(n + 1)
        with np.errstate(over="ignore"):
            first = np.zeros(n + 1, bool)
            first[ends] = True
            lines = np.flatnonzero(first[:n])
            own = base[size > 0]  # first words of texts
            g, one, two = w.copy(), w * U(0xD6E8FEB86659FD93), w * U(0xA5A3D2B1C4E6F789)
            one[own[1:] - 1] = 0
            two[own[1:] - 1] = 0
            two[np.maximum(own[1:] - 2, 0)] = 0
            g[1:] += one[:-1]
            g[2:] += two[:-2]
            g = _mix(g)
            low = np.ones(n, bool)
            for d in range(1, r + 1):
                low[d:] &= g[d:] < g[:-d]
                low[:-d] &= g[:-d] < g[d:]
            edge = np.arange(n) - base[doc]
            low &= (edge >= r) & (edge < size[doc] - r)
            s = np.flatnonzero(first[:n] | low)
            e = np.append(s[1:], n)
            wide = np.flatnonzero(e - s > self.p.longest)
            if len(wide):
                s = np.union1d(s, np.concatenate([np.arange(x, z, self.p.longest) for x, z in zip(s[wide].tolist(), e[wide].tolist())]))
            total = np.concatenate([[U(0)], np.cumsum(w * self.inv[:n])])
            sh = np.full(n, TOP)
            if n >= k:
                h = np.zeros(n - k + 1, U)
                for d in range(k):
                    h = h * U(BASE) + w[d : n - k + 1 + d]
                sh[: n - k + 1] = np.minimum(_mix(h), TOP - U(1))
            mixed = [_mix(sh ^ key) for key in self.keys]
            hashed = lambda at, kind: self._hashed(at, n, total, sh, mixed, kind)
            return Cut(n, base, doc, hashed(s, U(0)), hashed(lines, LINE))

    def _hashed(
        self, s: np.ndarray, n: int, total: np.ndarray, sh: np.ndarray, mixed: list[np.ndarray], kind: np.uint64
    ) -> Units:
        """Units that start at ``s``; ``kind`` keeps the hashes of lines and of
        fragments apart. ``mixed``: the shingles under each band's key."""
        k, e = self.p.shingle, np.append(s[1:], n)
        size, sh = e - s, sh.copy()
        th = _mix((total[e] - total[s]) * self.pow[e] + size.astype(U) + kind)
        top = np.zeros(n, bool)  # shingles that would leave their unit
        for d in range(1, k):
            top[e[size > d] - d] = True
        sh[top] = TOP
        short = s[size < k]
        sh[short] = np.minimum(th[size < k], TOP - U(1))
        bands = np.empty((len(s), self.p.bands), U)
        for i, key in enumerate(self.keys):
            v = mixed[i].copy()
            v[short] = _mix(sh[short] ^ key)
            v[top] = TOP
            low_v = np.minimum.reduceat(v, s)
            bands[:, i] = _mix(low_v + U(i) + kind)
        return Units(s, e, th, bands, sh)


@dataclass
class Units:
    """Units of one kind: first words and ends, hashes, bands; shingles by word."""

    start: np.ndarray
    end: np.ndarray
    th: np.ndarray
    bands: np.ndarray
    sh: np.ndarray


@dataclass
class Cut:
    """Texts cut together: words in all, first word of each text, the text of
    each word, and both kinds of units."""

    n: int
    base: np.ndarray
    doc: np.ndarray
    fragments: Units
    lines: Units


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``GROUP`` characters, one text at least."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= GROUP:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


PACKED = "part int, bh binary, member binary"


def _lowest_and_highest(bh: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each bucket once, ascending, with its smallest and largest member."""
    if not len(bh):
        return bh, member, member
    order = np.argsort(bh)
    bh, member = bh[order], member[order]
    at = np.flatnonzero(np.append(True, bh[1:] != bh[:-1]))
    return bh[at], np.minimum.reduceat(member, at), np.maximum.reduceat(member, at)


def _band_rows(p: Params, parts: int):
    """Per batch: (bucket, member) for the smallest member of each bucket and,
    where another, the largest, packed by range of buckets (``parts`` of them).
    A member is the text; in the first band it is the text in its document, so
    a text that has a second document makes two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(p)
        for b in batches:
            ths, bands, dks = [np.empty(0, U)], [np.empty((0, p.bands), U)], [np.empty(0, np.int64)]
            texts, all_dk = b.column("text").to_pylist(), b.column("dk").to_numpy()
            for lo, hi in _groups(texts):
                cut = cutter.many([t or "" for t in texts[lo:hi]])
                for u in (cut.fragments, cut.lines):
                    ths.append(u.th)
                    bands.append(u.bands)
                    dks.append(all_dk[lo:hi][cut.doc[u.start]])
            th, dk, bd = np.concatenate(ths).view(np.int64), np.concatenate(dks), np.concatenate(bands)
            del texts, ths, dks, bands
            order = np.argsort(th)
            of_text, home = th[order], dk[order]
            new = np.append(True, of_text[1:] != of_text[:-1])[: len(order)]
            group = np.cumsum(new) - 1
            # one more document a text is enough
            other = np.flatnonzero(home != home[new][group])
            other = other[np.append(True, group[other][1:] != group[other][:-1])[: len(other)]]
            one, placed = order[new], order[np.append(np.flatnonzero(new), other)]
            del order, of_text, home, new, group, other
            bucket = [bd[placed, 0], *(bd[one, i] for i in range(1, p.bands))]
            with np.errstate(over="ignore"):
                placed = _mix(th[placed].view(U) + _mix(dk[placed].view(U) ^ LINE)).view(np.int64)
            member = np.concatenate([placed, *(th[one] for _ in range(1, p.bands))])
            bucket = np.concatenate(bucket)
            del th, dk, bd, one, placed
            bh, lo, hi = _lowest_and_highest(bucket, member)
            two = np.flatnonzero(lo != hi)
            bh, member = np.insert(bh, two + 1, bh[two]), np.insert(lo, two + 1, hi[two])
            del bucket, lo, hi
            part = ((bh >> U(32)) * U(parts) >> U(32)).astype(np.int32)
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else part
            offsets = pa.py_buffer((8 * np.append(at, len(part))).astype(np.int32))
            packed = [pa.Array.from_buffers(pa.binary(), len(at), [None, offsets, pa.py_buffer(x)]) for x in (bh, member)]
            yield pa.RecordBatch.from_arrays([pa.array(part[at]), *packed], names=["part", "bh", "member"])

    return run


def _shared_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows in order of their parts -> the buckets of two members or
    more. One part is held at a time."""

    def shared(held: list[tuple]) -> pa.RecordBatch:
        bh, member = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*held), (U, np.int64)))
        bh, lo, hi = _lowest_and_highest(bh, member)
        return pa.RecordBatch.from_arrays([pa.array(bh[lo != hi].view(np.int64))], names=["bh"])

    now, held = None, []
    for b in batches:
        for part, *row in zip(*(b.column(c).to_pylist() for c in ("part", "bh", "member"))):
            if part != now:
                if held:
                    yield shared(held)
                now, held = part, []
            held.append(row)
    if held:
        yield shared(held)


def _filter_words(keys: DataFrame, bits: int) -> bytes:
    """A two-hash Bloom filter of column ``bh``: 2^bits bits whatever the
    number of keys, so both the collected rows and the broadcast are bounded."""
    mask = (1 << bits) - 1
    at = F.explode(F.array(F.col("bh").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("bh", 32).bitwiseAND(F.lit(mask))))
    words = keys.select(at.alias("bit")).groupBy(F.shiftright("bit", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("v")
    )
    got = words.toArrow()
    out = np.zeros(max(1, 1 << (bits - 6)), np.int64)
    out[got.column("w").to_numpy()] = got.column("v").to_numpy()
    return out.tobytes()


def _in_filter(words: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    mask = U((1 << bits) - 1)
    hit = np.ones(keys.shape, bool)
    for at in (keys & mask, (keys >> U(32)) & mask):
        hit &= (words[at >> U(6)] >> (at & U(63))) & U(1) == 1
    return hit


UNITS = (
    "doc_id long, dk long, line boolean, ord int, until int, from_char int, to_char int, "
    "from_word int, n_words int, th long, shingles array<long>"
)


def _unit_rows(p: Params, shared):
    """Paragraphs in a bucket of the filter, with places and shingles. ``ord``
    and ``until`` number fragments: a line goes over several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, words = Cutter(p), np.frombuffer(shared.value, U)
        for b in batches:
            texts, ids, dks = b.column("text").to_pylist(), b.column("doc_id"), b.column("dk").to_numpy()
            for lo, hi in _groups(texts):
                cut = cutter.many([t or "" for t in texts[lo:hi]])
                spans: dict[int, np.ndarray] = {}
                for line, u in enumerate((cut.fragments, cut.lines)):
                    hit = np.flatnonzero(_in_filter(words, u.bands, p.filter_bits).any(axis=1))
                    if len(hit):
                        yield _unit_batch(cut, u, bool(line), hit, spans, texts[lo:hi], ids.slice(lo, hi - lo), dks[lo:hi])

    return run


def _own_buckets(p: Params):
    """Rows (th, line, shingles) -> (th, bh) for every band, as the cutter
    makes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Cutter(p).keys
        for b in batches:
            lists = b.column("shingles")
            size = lists.value_lengths().to_numpy()
            sh = lists.flatten().to_numpy().view(U)
            if not len(size):
                continue
            start = np.cumsum(size) - size
            kind = np.where(b.column("line").to_numpy(zero_copy_only=False), LINE, U(0))
            with np.errstate(over="ignore"):
                bands = [_mix(np.minimum.reduceat(_mix(sh ^ key), start) + U(i) + kind) for i, key in enumerate(keys)]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([b.column("th")] * len(keys)), pa.array(np.concatenate(bands).view(np.int64))], names=["th", "bh"]
            )

    return run


def word_spans(text: str) -> np.ndarray:
    """(words, 2) character spans of the words of a text."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    word = np.zeros(len(c) + 2, np.int8)
    word[1:-1] = (c != 32) & ((c < 9) | (c > 13))
    turn = np.diff(word)
    return np.column_stack([np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)])


def _unit_batch(
    cut: Cut, u: Units, line: bool, hit: np.ndarray, spans: dict, texts: list, ids: pa.Array, dks: np.ndarray
) -> pa.RecordBatch:
    """Rows of the units ``hit``. ``spans``: character spans of the words of
    texts that have been looked at."""
    start, end = u.start[hit], u.end[hit]
    doc = cut.doc[start]
    # fragments before the unit, less those before its text
    place = lambda at: np.searchsorted(cut.fragments.start, at)
    before = place(cut.base[doc])
    turn = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    for d in doc[turn].tolist():
        if d not in spans:
            spans[d] = word_spans(texts[d])
    first, last = start - cut.base[doc], end - 1 - cut.base[doc]
    chars = np.empty((len(hit), 2), np.int64)
    for x, z in zip(turn.tolist(), np.append(turn[1:], len(hit)).tolist()):
        at = spans[int(doc[x])]
        chars[x:z, 0], chars[x:z, 1] = at[first[x:z], 0], at[last[x:z], 1]
    size = end - start
    unit = np.repeat(np.arange(len(hit)), size)
    sh = u.sh[np.repeat(start, size) + np.arange(len(unit)) - np.repeat(np.cumsum(size) - size, size)]
    unit, sh = unit[sh != TOP], sh[sh != TOP]
    order = np.lexsort((sh, unit))
    unit, sh = unit[order], sh[order]
    new = np.ones(len(sh), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (sh[1:] != sh[:-1])
    ends = np.concatenate([[0], np.cumsum(np.bincount(unit[new], minlength=len(hit)))])
    lists = lambda values, offsets: pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))
    small = lambda x: pa.array(x.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(doc)), pa.array(dks[doc]), pa.array(np.full(len(hit), line)),
            small(place(start) - before), small(place(end) - before),
            small(chars[:, 0]), small(chars[:, 1]), small(first), small(size), pa.array(u.th[hit].view(np.int64)),
            lists(sh[new], ends),
        ],
        names=[c.split()[0] for c in UNITS.split(", ")],
    )


def similar(ids: list[int], sets: list[frozenset], t: float) -> list[tuple[int, int]]:
    """Links that span the classes of "Jaccard at least t", by prefix filter:
    such sets share one of their rarest |x| - ceil(t |x|) + 1 elements."""
    if len(ids) == 2:
        x, y = sorted(sets, key=len)
        both = len(x & y) if len(x) >= t * len(y) else 0
        return [(ids[1], ids[0])] if both >= t * (len(x) + len(y) - both) - 1e-9 else []
    often = Counter(e for s in sets for e in s)
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    index: dict[int, list[int]] = {}
    out = []
    for i in sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i])):
        x = sets[i]
        rare = sorted(x, key=lambda e: (often[e], e))
        head = rare[: len(x) - int(np.ceil(t * len(x) - 1e-9)) + 1]
        met: set[int] = set()
        for e in head:
            for j in index.get(e, ()):
                if j in met or find(i) == find(j):
                    continue
                met.add(j)
                y = sets[j]
                if len(y) < t * len(x):
                    continue
                both = len(x & y)
                if both >= t * (len(x) + len(y) - both) - 1e-9:
                    root[find(i)] = find(j)
                    out.append((ids[i], ids[j]))
            index.setdefault(e, []).append(i)
    return out


def _bucket_links(p: Params):
    """Rows sorted by bucket -> links of each bucket's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets = None, [], []
        for b in batches:
            links: list[tuple[int, int]] = []
            lists = b.column("shingles")
            size = lists.value_lengths().to_numpy()
            flat, ends = lists.flatten().to_pylist(), np.cumsum(size)
            for bh, th, x, z in zip(b.column("bh").to_pylist(), b.column("th").to_pylist(), (ends - size).tolist(), ends.tolist()):
                if bh != now:
                    if len(ids) > 1:
                        links += similar(ids, sets, p.similarity)
                    now, ids, sets = bh, [], []
                ids.append(th)
                sets.append(frozenset(flat[x:z]))
            yield _links(links)
        if len(ids) > 1:
            yield _links(similar(ids, sets, p.similarity))

    return run


def _links(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _doc_key(id_col: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(3), id_col, text)


def _repeated(df: DataFrame, p: Params) -> DataFrame:
    """Lines and fragments of classes that lie in two documents or more:
    doc_id, dk, line, ord, until, from_char, to_char, from_word, n_words,
    class, keep (its first occurrence)."""
    spark = df.sparkSession
    docs = pick(df, doc_id="doc_id", text="text").withColumn("dk", _doc_key(F.col("doc_id"), F.col("text")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select("text", "dk").mapInArrow(frugal(_band_rows(p, n * PARTS)), PACKED)
    buckets = written(
        packed.repartitionById(n, (F.col("part") / PARTS).cast("int")).sortWithinPartitions("part")
        .mapInArrow(frugal(_shared_buckets), "bh long"),
        "buckets",
    )
    shared = spark.sparkContext.broadcast(_filter_words(buckets, p.filter_bits))  # 2^filter_bits bits
    units = written(docs.mapInArrow(frugal(_unit_rows(p, shared)), UNITS), "units")
    place = F.struct("doc_id", "dk", "ord")
    texts = written(
        units.groupBy("th").agg(
            F.first("line").alias("line"), F.first("shingles").alias("shingles"),
            F.min("dk").alias("d0"), F.max("dk").alias("d1"), F.min(place).alias("first"),
        ),
        "texts",
    )
    places = written(units.drop("shingles"), "places")
    discard(units)
    # Shingles travel once for each text, and only to texts that have company.
    own = texts.select("th", "line", "shingles").mapInArrow(frugal(_own_buckets(p)), "th long, bh long")
    shared_by = written(own.join(buckets, "bh"), "members")
    company = shared_by.groupBy("bh").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).filter("lo <> hi").select("bh")
    members = shared_by.join(company, "bh").join(texts.select("th", "shingles"), "th")
    links = members.repartition("bh").sortWithinPartitions("bh", "th").mapInArrow(frugal(_bucket_links(p)), "a long, b long")
    comp = connected_components(links)
    named = texts.select("th", "d0", "d1", "first").join(comp.withColumnRenamed("node", "th"), "th", "left")
    named = named.withColumn("class", F.coalesce("component", "th"))
    kinds = named.groupBy("class").agg(F.min("d0").alias("lo"), F.max("d1").alias("hi"), F.min("first").alias("first"))
    classes = written(
        named.select("th", "class").join(kinds.filter("lo <> hi").select("class", "first"), "class"), "classes"
    )
    discard(texts, shared_by, buckets)
    return places.join(classes, "th").withColumn(
        "keep", F.col("first").eqNullSafe(place)
    ).drop("th", "first")


def repeated_paragraphs(df: DataFrame, p: Params = Params()) -> DataFrame:
    """Fragments of classes that lie in two documents or more: doc_id, dk,
    ord, from_char, to_char, n_words, class, keep (its first occurrence)."""
    return _repeated(df, p).filter("NOT line").drop("line", "until", "from_word")


def passages(df: DataFrame, p: Params = Params()) -> DataFrame:
    """One row for each repeated passage of a document: doc_id, dk, passage
    (its first paragraph), from_char, to_char, n_words, removed_words, cuts
    (character spans to remove, they may overlap), component_id (the class of
    its first paragraph)."""
    hit = written(_repeated(df, p).repartition("dk").dropDuplicates(["dk", "line", "ord"]), "repeated")
    lines, fragments = hit.filter("line"), hit.filter("NOT line")
    # Fragments in lines that go are part of them; of the others the first of a
    # class stays. A line that stays loses only whole passages, no odd words.
    over = lines.select("dk", F.explode(F.expr("sequence(ord, until - 1)")).alias("ord"), F.col("keep").alias("stays"))
    alone = fragments.drop("keep").join(over.hint("merge"), ["dk", "ord"], "left").filter("stays IS NULL OR stays")
    place = F.struct("doc_id", "dk", "ord")
    firsts = alone.groupBy("class").agg(F.min(place).alias("first"))
    alone = alone.join(firsts.hint("merge"), "class").withColumn("keep", F.col("first").eqNullSafe(place))
    alone = alone.withColumn("run", F.col("ord") - F.row_number().over(Window.partitionBy("dk", "keep").orderBy("ord")))
    run_words = F.sum("n_words").over(Window.partitionBy("dk", "keep", "run"))
    odd = F.coalesce("stays", F.lit(False)) & (run_words < p.min_words)
    alone = alone.withColumn("keep", F.col("keep") | odd).drop("first", "stays", "run")
    both = lines.unionByName(alone)
    to_word = F.col("from_word") + F.col("n_words")
    home = Window.partitionBy("dk").orderBy("ord", F.desc("until"), "line")
    before = home.rowsBetween(Window.unboundedPreceding, -1)
    out = ~F.col("keep")
    marked = both.withColumns(
        {
            "starts": (F.col("ord") > F.coalesce(F.max("until").over(before), F.lit(-1))).cast("int"),
            "own": F.when(out, F.greatest(F.lit(0), to_word - F.greatest("from_word", F.coalesce(F.max(F.when(out, to_word)).over(before), F.lit(0))))).otherwise(0),
        }
    )
    isle = marked.withColumn("isle", F.sum("starts").over(home.rowsBetween(Window.unboundedPreceding, 0)))
    cut = F.when(out, F.struct("from_char", "to_char"))
    return (
        isle.groupBy("dk", "isle")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.min("ord").alias("passage"),
            F.min("from_char").alias("from_char"),
            F.max("to_char").alias("to_char"),
            (F.max(to_word) - F.min("from_word")).cast("long").alias("n_words"),
            F.sum("own").cast("long").alias("removed_words"),
            F.sort_array(F.collect_list(cut)).alias("cuts"),
            F.min_by("class", F.struct("ord", -F.col("until"))).alias("component_id"),
        )
        .filter(F.col("n_words") >= p.min_words)
        .drop("isle")
    )


def passage_rows(df: DataFrame, p: Params = Params()) -> DataFrame:
    """The query's columns, one row for each repeated passage."""
    return passages(df, p).select(
        "doc_id", "passage", "from_char", "to_char", "n_words", "removed_words",
        (F.col("removed_words") > 0).alias("removed"), "component_id",
    )


def without_repeats(df: DataFrame, p: Params = Params()) -> DataFrame:
    """``df`` with repeated passages cut out of ``text`` except at their first
    occurrence; ``n_chars``, where there is one, follows."""
    dk, cuts_name = fresh(df, "_dk"), fresh(df, "_cuts")
    spans = written(
        passages(df, p).filter("removed_words > 0").groupBy("dk")
        .agg(F.flatten(F.collect_list("cuts")).alias(cuts_name)), "spans",
    )
    marked = df.withColumn(dk, _doc_key(df["doc_id"], df["text"]))
    joined = marked.join(spans.withColumnRenamed("dk", dk), dk, "left").drop(dk)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            for i, cuts in enumerate(b.column(cuts_name).to_pylist()):
                if cuts:
                    texts[i] = cut_out(texts[i], [(c["from_char"], c["to_char"]) for c in cuts])
            cols = {c: b.column(c) for c in names}
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                sizes = [len(t) if t is not None else None for t in texts]
                cols["n_chars"] = pa.array(sizes, pa.int64()).cast(cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    return joined.select(*names, cuts_name).mapInArrow(frugal(run), df.schema)


def cut_out(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans, which may overlap; what stood between
    neighbours goes too if it is white space only."""
    out, at = [], 0
    for a, b in sorted(spans):
        between = text[at:a]
        if between.strip() or not out:
            out.append(between)
        at = max(at, b)
    out.append(text[at:])
    return "".join(out)
