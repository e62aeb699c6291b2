"""Documents scored by cross-entropy difference of two bigram models.

The target model is counted over the caller's target rows, the background model
over all rows. Both share one vocabulary (every word, or the ``vocab`` most
frequent where a caller asks for that, the rest one unknown token), one order and
one smoothing, so a difference between them comes from the counts alone. A
document's score is the mean over its tokens of target loss minus background
loss, in nats: negative means closer to the target.

Every word and bigram of every row counts and scores; the model is never held in
one place, it grows with the input as tables do:

1. Texts are cut into chunks of ``chunk`` tokens. A chunk is one row: its
   documents as word numbers, packed, and the 64-bit hashes of the words.
2. A chunk sends its distinct bigrams (80 bits of the words' hashes, counts) as
   one packed row for each bucket, a range of keys; a bucket has about as many
   entries at every size. A bucket sums over the chunks and answers each, in its
   order. A key has one entry a chunk at most, so the most frequent word is no
   larger a group than others.
3. Words go the same way, with the distinct bigrams each begins, taken from the
   lowest chunk that has the bigram.
4. Each chunk adds up its documents' losses from the answers.

Smoothing: absolute discounting of bigrams, interpolated with add-one unigrams.

``train`` gives the same model as one object in memory, for small inputs or with
bounds (``vocab``, ``bigrams``) that a caller sets; the query does not use it.

Rows: a text without a word (null, empty) has no tokens and null scores; with no
target row the target model is uniform over the vocabulary; repeated rows count
and are scored each; a null id keeps its row and is no target; an empty table
gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, free_shuffles, frugal, pick, written

WORD_RE = re.compile(WORD)


@dataclass(frozen=True)
class Params:
    vocab: int | None = None  # words, if not all
    bigrams: int | None = None  # of a model that ``train`` holds in memory, if not all
    discount: float = 0.75
    chunk: int = 2_000_000  # tokens numbered together


@dataclass
class Model:
    """Log probabilities of both models; index 0 target, 1 background."""

    index: dict[str, int]
    keys: np.ndarray  # kept bigrams, sorted: context * width + word
    bigram: np.ndarray  # (2, kept)
    unigram: np.ndarray  # (2, width)
    left: np.ndarray  # (2, width): log mass a context leaves to unigrams

    @property
    def unknown(self) -> int:
        return len(self.index)

    @property
    def width(self) -> int:  # words, unknown, start of text
        return len(self.index) + 2


def tokens(text: str | None) -> list[str]:
    return WORD_RE.findall(text.lower()) if text else []


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def flush() -> pa.RecordBatch:
        words = list(seen)
        out = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([seen[w] for w in words], pa.int64())], names=["word", "n"]
        )
        seen.clear()
        return out

    for b in batches:
        for at in range(0, b.num_rows, 500):
            for text in b.column("text").slice(at, 500).to_pylist():
                seen.update(tokens(text))
            if len(seen) > 400_000:
                yield flush()
    yield flush()


def vocabulary(docs: DataFrame, p: Params) -> dict[str, int]:
    """The most frequent words of all rows (ties by code point), numbered; all
    of them if ``p.vocab`` is None."""
    counts = docs.select("text").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word")
    top = top if p.vocab is None else top.limit(p.vocab)
    return {r["word"]: i for i, r in enumerate(top.collect())}


def _pairs(text: str | None, index: dict[str, int]) -> np.ndarray:
    """Keys of a text's bigrams, the first with the start of the text."""
    unk, width = len(index), len(index) + 2
    ids = np.fromiter((index.get(w, unk) for w in tokens(text)), np.int64)
    if not len(ids):
        return ids
    return np.concatenate([[unk + 1], ids[:-1]]) * width + ids


def _count_pairs(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        held: tuple[list, list] = ([], [])
        size = 0

        def flush() -> pa.RecordBatch:
            empty = np.empty(0, np.int64)
            (k0, n0), (k1, n1) = (
                np.unique(np.concatenate(h) if h else empty, return_counts=True) for h in held
            )
            keys = np.union1d(k0, k1)
            cell = np.zeros((2, len(keys)), np.int64)
            cell[0, np.searchsorted(keys, k0)] = n0
            cell[1, np.searchsorted(keys, k1)] = n1
            for h in held:
                h.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(cell[1]), pa.array(cell[0] + cell[1])], names=["key", "target", "background"])

        for b in batches:
            for text, is_target in zip(b.column("text").to_pylist(), b.column("is_target").to_pylist()):
                keys = _pairs(text, index)
                held[bool(is_target)].append(keys)
                size += len(keys)
                if size > 6_000_000:
                    yield flush()
                    size = 0
        yield flush()

    return run


def train(docs: DataFrame, p: Params = Params(), index: dict[str, int] | None = None) -> Model:
    """``docs`` (text, is_target); ``index``: their vocabulary, if known."""
    index = vocabulary(docs, p) if index is None else index
    width = len(index) + 2
    shared = docs.sparkSession.sparkContext.broadcast(index)  # as small as the caller's model
    pairs = written(
        docs.select("text", "is_target").mapInArrow(_count_pairs(shared), "key long, target long, background long")
        .groupBy("key").agg(F.sum("target").alias("target"), F.sum("background").alias("background")),
        "bigrams",
    )
    contexts = pairs.groupBy(F.expr(f"key div {width}").alias("h")).agg(F.sum("target").alias("t"), F.sum("background").alias("b"))
    words = pairs.groupBy((F.col("key") % width).alias("w")).agg(F.sum("target").alias("t"), F.sum("background").alias("b"))
    by_context, by_word = np.zeros((2, width)), np.zeros((2, width))
    for r in contexts.collect():
        by_context[:, r["h"]] = r["t"], r["b"]
    for r in words.collect():
        by_word[:, r["w"]] = r["t"], r["b"]
    # The smallest count whose bigrams are within the caller's bound, if any:
    # from the counts' own histogram.
    sizes = pairs.groupBy(F.least("background", F.lit(100_000)).alias("n")).agg(F.count("*").alias("m")).collect()
    least, room = 1, p.bigrams
    for r in sorted(sizes, key=lambda r: -r["n"]) if room is not None else ():
        room -= r["m"]
        if room < 0:
            least = r["n"] + 1
            break
    kept = pairs.filter(F.col("background") >= least).toArrow()
    key = kept.column("key").to_numpy()
    order = np.argsort(key)
    key = key[order]
    n = np.stack([kept.column(c).to_numpy()[order] for c in ("target", "background")]).astype(float)
    return _smoothed(index, key, n, by_context, by_word, p)


def _smoothed(index, key, n, by_context, by_word, p: Params) -> Model:
    width = len(index) + 2
    h, w = key // width, key % width
    # add-one over the words and the unknown token
    unigram = (by_word[:, : width - 1] + 1) / (by_word.sum(axis=1, keepdims=True) + width - 1)
    unigram = np.column_stack([unigram, np.ones(2)])
    cut = np.minimum(n, p.discount)
    total = np.maximum(by_context, 1e-300)
    left = np.ones((2, width))
    for m in range(2):
        held = np.bincount(h, (n - cut)[m], minlength=width)
        left[m] = np.where(by_context[m] > 0, 1 - held / total[m], 1.0)
    left = np.maximum(left, 1e-9)
    prob = (n - cut) / total[:, h] + left[:, h] * unigram[:, w]
    return Model(index, key, np.log(prob).astype(np.float32), np.log(unigram), np.log(left))


def losses(text: str | None, model: Model) -> tuple[int, float, float]:
    """(tokens, target loss, background loss), sums in nats."""
    keys = _pairs(text, model.index)
    if not len(keys):
        return 0, 0.0, 0.0
    h, w = keys // model.width, keys % model.width
    logp = model.left[:, h] + model.unigram[:, w]
    if len(model.keys):
        at = np.minimum(np.searchsorted(model.keys, keys), len(model.keys) - 1)
        hit = model.keys[at] == keys
        logp[:, hit] = model.bigram[:, at[hit]]
    t, b = -logp.sum(axis=1)
    return len(keys), float(t), float(b)


CHUNK = "chunk long, tokens long, target long, doc_ids array<long>, sizes array<int>, good array<boolean>, words binary, ids binary"
SUMS = "chunk long, bucket int, entries long, blob binary"
BUCKET = 500_000  # a chunk's words or bigrams summed together, at most about


def _word_hash(word: str | None) -> int:
    """Signed 64-bit hash; None is the start of a text (a blank is no word), ""
    the unknown token."""
    import xxhash

    raw = b" " if word is None else word.encode("utf-8", "surrogatepass")
    h = xxhash.xxh64_intdigest(raw)
    return h - (1 << 64) if h >> 63 else h


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit values, compressed byte plane by byte plane."""
    raw = b"".join(np.ascontiguousarray(c.astype("<i8", copy=False).view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes, columns: int) -> np.ndarray:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0]


def _chunk_rows(shared, size_limit: int):
    """Per chunk one row: its documents' words as numbers, and the hashes of
    the words in the order of their numbers (0 is the start of a text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value if shared else None
        task, seq, size = TaskContext.get().partitionId(), 0, 0
        index: defaultdict = defaultdict()
        index.default_factory = index.__len__
        held: list[tuple] = []

        def flush(chunk: int) -> pa.RecordBatch:
            sizes = [len(ids) for _, ids, _ in held]
            row = {
                "chunk": chunk, "tokens": sum(sizes), "target": sum(n for n, (_, _, g) in zip(sizes, held) if g),
                "doc_ids": [i for i, _, _ in held], "sizes": sizes, "good": [g for _, _, g in held],
                "words": _pack(np.fromiter(map(_word_hash, index), np.int64, len(index))),
                "ids": _pack(np.concatenate([ids for _, ids, _ in held])),
            }
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for doc_id, text, good in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "is_target"))):
                words = tokens(text)
                if known is not None:
                    words = [x if x in known else "" for x in words]
                if not index:
                    index[None]  # the start of a text is number 0
                held.append((doc_id, np.fromiter(map(index.__getitem__, words), np.int32, len(words)), bool(good)))
                size += len(words) + 1
                if size >= size_limit:
                    yield flush(task << 32 | seq)
                    held.clear()
                    index.clear()
                    seq, size = seq + 1, 0
        if held:
            yield flush(task << 32 | seq)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(CHUNK))
    return run


class _Chunk:
    """A chunk's row taken apart: its words (hash ``x``) and its distinct
    bigrams (word numbers ``h``, ``w``; ``n`` target and background counts)."""

    def __init__(self, row: dict):
        self.sizes = np.array(row["sizes"], np.int64)
        self.of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.good = np.array(row["good"], bool)[self.of]
        self.x = _unpack(row["words"], 1)[0].view(np.uint64)
        self.w = _unpack(row["ids"], 1)[0]
        self.h = np.zeros_like(self.w)  # 0: the start of a text
        self.h[1:] = self.w[:-1]
        self.h[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = 0
        width = len(self.x)
        keys, self.at = np.unique(self.h * width + self.w, return_inverse=True)
        self.lh, self.lw = keys // width, keys % width
        self.n = np.stack([np.bincount(self.at[c], minlength=len(keys)) for c in (self.good, slice(None))])

    def bigram_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """80 bits of each bigram, from the hashes of its words."""
        a, b = self.x[self.lh], self.x[self.lw]
        return _mixed(a * np.uint64(0x9E3779B97F4A7C15) + b), _mixed(a + b * np.uint64(0xC2B2AE3D27D4EB4F)) & np.uint64(0xFFFF)

    def word_counts(self) -> np.ndarray:
        """Target and background counts of each word, then as a context."""
        every, width = slice(None), len(self.x)
        return np.stack([np.bincount(ids[c], minlength=width) for ids in (self.w, self.h) for c in (self.good, every)])


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _entries(chunk: int, buckets: int, key: np.ndarray, low: np.ndarray, *values: np.ndarray) -> list[dict]:
    """A chunk's entries, by key, as one packed row a bucket (a range of keys)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    cut = np.searchsorted((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
    columns = [low[order].astype(np.int64), *(v[order] for v in values)]
    return [
        {"chunk": chunk, "bucket": i, "entries": z - a, "blob": _pack(np.diff(key[a:z], prepend=np.uint64(0)).view(np.int64), *(c[a:z] for c in columns))}
        for i, (a, z) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if z > a
    ]


def _summed(values: int, floats: int = 0):
    """Rows of one bucket -> for each the sums over all chunks, in its order, and
    whether it is the first with the key (``entries``: how many are). The last
    ``floats`` of the ``values`` columns are doubles."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        got = [_unpack(b, 2 + values) for b in rows.column("blob").to_pylist()]
        key = np.concatenate([np.cumsum(g[0].view(np.uint64), dtype=np.uint64) for g in got])
        low, *cells = np.concatenate([g[1:] for g in got], axis=1)
        order = np.lexsort((low, key))
        k, o = key[order], low[order]
        first = np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])
        start, group = np.flatnonzero(first), np.cumsum(first) - 1
        out = np.empty((1 + values, len(key)), np.int64)
        out[0, order] = first
        for i, c in enumerate(cells):
            c = np.ascontiguousarray(c).view(np.float64) if i >= values - floats else c
            out[1 + i, order] = np.add.reduceat(c[order], start)[group].view(np.int64)
        ends = np.cumsum([g.shape[1] for g in got])
        parts = [out[:, z - g.shape[1] : z] for g, z in zip(got, ends.tolist())]
        return pa.table(
            {
                "chunk": rows.column("chunk"), "bucket": rows.column("bucket"),
                "entries": pa.array([int(x[0].sum()) for x in parts], pa.int64()), "blob": pa.array([_pack(*x) for x in parts], pa.binary()),
            }
        )

    return run


def _aligned(answers: pa.Table, values: int, key: np.ndarray) -> np.ndarray:
    """The answers to a chunk's :func:`_entries`, in the order of ``key``: first
    with the key or not, then the sums."""
    out = np.empty((1 + values, len(key)), np.int64)
    if len(key):
        got = [_unpack(b, 1 + values) for b in answers.sort_by("bucket").column("blob").to_pylist()]
        out[:, np.argsort(key, kind="stable")] = np.concatenate(got, axis=1)
    return out


def _rows(rows: list[dict]) -> pa.Table:
    kinds = (("chunk", pa.int64()), ("bucket", pa.int32()), ("entries", pa.int64()), ("blob", pa.binary()))
    return pa.Table.from_pylist(rows, pa.schema(kinds))


def _asked_bigrams(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                c = _Chunk(row)
                yield from _rows(_entries(row["chunk"], buckets, *c.bigram_keys(), *c.n)).to_batches()

    return run


def _asked_words(p: Params, buckets: int):
    """A chunk and its bigrams' sums -> its words' counts, and what each word
    loses to discounting over the bigrams that no lower chunk has."""

    def run(chunk: pa.Table, bigrams: pa.Table) -> pa.Table:
        (row,) = chunk.to_pylist()
        c = _Chunk(row)
        first, *sums = _aligned(bigrams, 2, c.bigram_keys()[0])
        lost = [np.bincount(c.lh, np.where(first == 1, np.minimum(s, p.discount), 0.0), len(c.x)).view(np.int64) for s in sums]
        return _rows(_entries(row["chunk"], buckets, c.x, np.zeros(len(c.x), np.int64), *c.word_counts(), *lost))

    return run


OUT = "doc_id long, n_tokens long, target_loss double, background_loss double, ce_difference double"


def _chunk_losses(p: Params, total: np.ndarray, words: int):
    """A chunk and the sums of its bigrams and words -> losses of its documents.
    ``total``: tokens of both models; ``words``: of the vocabulary with the
    unknown token."""

    def run(chunk: pa.Table, sums: pa.Table) -> pa.Table:
        (row,) = chunk.to_pylist()
        c = _Chunk(row)
        of_kind = lambda kind: sums.filter(pa.compute.equal(sums.column("kind"), kind))
        n = _aligned(of_kind(0), 2, c.bigram_keys()[0])[1:].astype(float)
        word = _aligned(of_kind(1), 6, c.x)[1:]
        uni = (word[:2] + 1) / (total[:, None] + words)
        ctx = np.maximum(word[2:4], 1e-300)
        lost = np.ascontiguousarray(word[4:]).view(np.float64)
        left = np.maximum(np.where(word[2:4] > 0, lost / ctx, 1.0), 1e-9)
        loss = -np.log((n - np.minimum(n, p.discount)) / ctx[:, c.lh] + left[:, c.lh] * uni[:, c.lw])
        empty = c.sizes == 0
        mean = [np.bincount(c.of, loss[m][c.at], len(c.sizes)) / np.maximum(c.sizes, 1) for m in range(2)]
        cells = [pa.array(x, pa.float64(), mask=empty) for x in (*mean, mean[0] - mean[1])]
        return pa.Table.from_arrays(
            [pa.array(row["doc_ids"], pa.int64()), pa.array(c.sizes), *cells], names=[x.split()[0] for x in OUT.split(", ")]
        )

    return run


def score_by_tables(marked: DataFrame, p: Params, index: dict[str, int] | None = None) -> DataFrame:
    """Scores of ``marked`` (doc_id, text, is_target) under the models of all
    its words and bigrams; ``index``: the vocabulary, if it is not every word."""
    shared = marked.sparkSession.sparkContext.broadcast(frozenset(index)) if index is not None else None
    chunks = written(marked.select("doc_id", "text", "is_target").mapInArrow(frugal(_chunk_rows(shared, p.chunk)), CHUNK), "chunks")
    seen = chunks.agg(F.sum("tokens").alias("b"), F.sum("target").alias("t")).first()
    free_shuffles(marked.sparkSession, 1)  # the joined texts
    buckets = 1 + (seen["b"] or 0) // BUCKET
    asked = chunks.select("chunk", "sizes", "good", "words", "ids")
    bigrams = written(
        asked.mapInArrow(frugal(_asked_bigrams(buckets)), SUMS).groupBy("bucket").applyInArrow(_summed(2), SUMS), "bigrams"
    )
    free_shuffles(marked.sparkSession, 1)  # the chunks' own counts
    words = written(
        asked.groupBy("chunk").cogroup(bigrams.groupBy("chunk")).applyInArrow(_asked_words(p, buckets), SUMS)
        .groupBy("bucket").applyInArrow(_summed(6, 2), SUMS),
        "words",
    )
    n = words.agg(F.sum("entries").alias("n")).first()["n"] or 1  # with the start of a text
    free_shuffles(marked.sparkSession, 1)  # what the words were made of
    size = 1 + (n - 1 if index is None else len(index))  # and the unknown token
    total = np.array([seen["t"] or 0, seen["b"] or 0], float)
    sums = bigrams.withColumn("kind", F.lit(0)).union(words.withColumn("kind", F.lit(1)))
    return chunks.drop("tokens", "target").groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(_chunk_losses(p, total, size), OUT)


def cross_entropy_difference(documents: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """Scores of all documents; the target rows are those labelled of good
    quality. One row per row of ``documents``."""
    docs = pick(documents, doc_id="doc_id", text="text")
    good = pick(labels, doc_id="doc_id", quality="quality").filter("quality = 1 AND doc_id IS NOT NULL")
    # Labels grow with the documents: one join strategy at every size, not a
    # broadcast that stops fitting.
    target = good.select("doc_id", F.lit(True).alias("is_target")).distinct().hint("merge")
    marked = docs.join(target, "doc_id", "left")
    return score_by_tables(marked, p, None if p.vocab is None else vocabulary(docs, p))
