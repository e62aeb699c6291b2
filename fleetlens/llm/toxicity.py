"""Toxicity by weak supervision.

Many voters look at a text: word lists, patterns around them, words mined from
the labelled rows, and voters for the clean class. A generative model (expectation
maximisation over a latent class) estimates how often each voter fires in
either class, with the given labels as one more, fallible voter. Correlations
of voters within a class are estimated from its residuals, and votes of
correlated voters are damped so that copies of one signal do not count twice.
Its posteriors are the soft labels of a logistic regression over the voters'
measurements, which then scores every text.

The classifier is fitted on a sample of at most about ``sample`` labelled rows,
chosen by a hash of the id among the rows the caller offers; scoring reads whole
texts and nothing but texts.

Rows: a null or empty text is scored like any other (no voter for toxicity
fires); with fewer than ``min_class`` labelled rows of a class the word lists
alone decide; repeated rows are scored one by one; a null id keeps its row; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, pick, written

# Word lists, one voter each (fixed values).
LEXICON: dict[str, tuple[str, ...]] = {
    "wits": ("idiot", "idiots", "idiotic", "stupid", "moron", "morons", "moronic", "dumb", "dumbass", "imbecile", "fool", "clown"),
    "worth": ("loser", "losers", "worthless", "pathetic", "useless", "failure", "trash", "garbage", "scum", "vermin"),
    "disgust": ("disgusting", "filthy", "ugly", "gross", "vile", "nasty", "sickening", "repulsive"),
    "threat": ("kill", "murder", "strangle", "shoot", "destroy", "hurt"),
    "profanity": ("damn", "crap", "hell", "shit", "fuck", "fucking", "bitch", "bastard", "asshole", "piss"),
    "hate": ("hate", "despise", "loathe", "subhuman", "savages", "degenerate", "degenerates", "freak", "freaks"),
}
SECOND_PERSON = {"you", "your", "yours", "youre", "yourself"}
STEMS = (4, 5, 6, 7, 8)  # letters of a mined stem
WORD_RE = re.compile(r"[^\W\d_]+")
PATTERNS = ("two_hits", "dense", "near_you", "shouting", "exclaiming", "no_hit", "one_hit_in_many", "no_hit_long")
DENSE = ("hits", "distinct", "per_hundred", "mined_hits", "log_words", "caps", "exclaims")


@dataclass(frozen=True)
class Params:
    sample: int = 20_000
    mined: int = 48
    min_docs: int = 5
    min_class: int = 5  # labelled rows of each class below which only the lists count
    z: float = 6.0
    rounds: int = 40
    l2: float = 1.0
    seed: int = 5


@dataclass
class Model:
    mined: tuple[str, ...]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # bias last
    fire: np.ndarray | None = None  # (2, voters): firing rate by class
    correlation: np.ndarray | None = None


def voters(mined: tuple[str, ...]) -> list[str]:
    return [*LEXICON, *(f"mined:{w}" for w in mined), *PATTERNS]


class Lookup:
    """word -> voters of its lists and mined stems; remembers words it saw."""

    def __init__(self, mined: tuple[str, ...], memo: int = 400_000):
        self.memo, self.seen = memo, {}
        self.words: dict[str, tuple[int, ...]] = {}
        for i, words in enumerate(LEXICON.values()):
            for w in words:
                self.words[w] = (*self.words.get(w, ()), i)
        self.stems: dict[str, int] = {}
        for i, token in enumerate(mined):
            if token[0] == "=":
                self.words[token[1:]] = (*self.words.get(token[1:], ()), len(LEXICON) + i)
            else:
                self.stems[token[1:]] = len(LEXICON) + i

    def __getitem__(self, word: str) -> tuple[int, ...]:
        got = self.seen.get(word)
        if got is None:
            stems = (self.stems.get(word[:k]) for k in STEMS if len(word) > k)
            got = (*self.words.get(word, ()), *(v for v in stems if v is not None))
            if len(self.seen) >= self.memo:
                self.seen.clear()
            self.seen[word] = got
        return got


def tokens(word: str) -> list[str]:
    """What is mined of a word: itself (=) and its stems (^)."""
    return ["=" + word, *("^" + word[:k] for k in STEMS if len(word) > k)]


def measure(text: str | None, lookup: Lookup, n_mined: int) -> list[float]:
    """One number for each voter (1 if it fires), then the dense features."""
    text = text or ""
    words = WORD_RE.findall(text.lower())
    n = len(words)
    known = {w: v for w in set(words) if (v := lookup[w])}
    hit_at = [i for i, w in enumerate(words) if w in known] if known else []
    lists = len(LEXICON) + n_mined
    fired = [0.0] * lists
    mined_hits = 0
    for i in hit_at:
        for v in known[words[i]]:
            fired[v] = 1.0
            mined_hits += v >= len(LEXICON)
    hits, distinct = len(hit_at), len({words[i] for i in hit_at})
    near_you = any(w in SECOND_PERSON for i in hit_at for w in words[max(0, i - 3) : i + 4])
    upper = sum(map(str.isupper, text.split()))
    caps = upper / n if n else 0.0
    exclaims = text.count("!") / n if n else 0.0
    fired += [
        float(hits >= 2),
        float(hits > 0 and hits * 50 >= n),
        float(near_you),
        float(hits > 0 and caps > 0.3),
        float(hits > 0 and exclaims > 0.1),
        float(hits == 0),
        float(hits == 1 and n >= 200),
        float(hits == 0 and n >= 200),
    ]
    per_hundred = 100 * hits / n if n else 0.0
    dense = [math.log1p(hits), math.log1p(distinct), math.log1p(per_hundred), math.log1p(mined_hits), math.log1p(n), caps, min(exclaims, 2.0)]
    return fired + dense


def _mine(sample: DataFrame, p: Params) -> tuple[str, ...]:
    """Words and stems whose document frequency in the toxic class is far
    above chance, best first; none that a better stem covers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(seen)
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[1] for k in keys], pa.string()), pa.array([k[0] for k in keys], pa.int32()), pa.array([seen[k] for k in keys], pa.int64())],
                names=["token", "y", "n"],
            )
            seen.clear()
            return out

        for b in batches:
            for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                found = {t for w in set(WORD_RE.findall((text or "").lower())) for t in tokens(w)}
                seen.update((int(y > 0), t) for t in found)
                if len(seen) > 300_000:
                    yield flush()
        yield flush()

    n = {r["y"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return ()
    sums = sample.select("text", "toxic").mapInArrow(frugal(count), "token string, y int, n long").groupBy("token").agg(
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("c"),
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("t"),
    )
    rate = (F.col("c") + F.col("t")) / (n0 + n1)
    expected = rate * n1
    spread = F.sqrt(expected * (1 - rate) * (n0 / (n0 + n1)) + 0.25)
    scored = sums.withColumn("z", F.round((F.col("t") - expected) / spread, 6)).filter(
        (F.col("t") >= p.min_docs) & (F.col("z") >= p.z) & (F.col("t") > F.col("c"))
    )
    best = scored.orderBy(F.desc("z"), F.desc(F.length("token")), "token").collect()  # tokens of the bounded sample
    chosen: dict[str, int] = {}
    for token, t in ((r["token"], r["t"]) for r in best):
        covering = {f"^{token[1 : k + 1]}" for k in STEMS} | {token}
        same = any(c[1:].startswith(token[1:]) and 5 * n >= 4 * t for c, n in chosen.items())
        if len(chosen) < p.mined and not same and not any(c in chosen for c in covering):
            chosen[token] = t
    return tuple(chosen)


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of class 1, firing rates (2, voters + 1), correlations).

    The last voter is the given label. Log-odds of voters are damped by the
    sum of their positive correlations with others within a class.
    """
    v = np.column_stack([votes, labels]).astype(float)
    n, m = v.shape
    # The start: labels right nine times in ten.
    post = np.where(labels > 0, 0.9, 0.1 * labels.mean())
    damp, corr = np.ones(m), np.eye(m)
    for turn in range(rounds):
        fire = np.empty((2, m))
        resid = np.zeros((m, m))
        var = np.zeros(m)
        for y, w in ((1, post), (0, 1 - post)):
            fire[y] = (w @ v + 0.5) / (w.sum() + 1.0)
            if turn % 10 == 9 or turn == rounds - 1:
                d = (v - fire[y]) * np.sqrt(w)[:, None]
                resid += d.T @ d
                var += (d * d).sum(axis=0)
        if var.any():
            corr = resid / np.sqrt(np.outer(var, var) + 1e-12)
            np.fill_diagonal(corr, 1.0)
            damp = 1.0 / np.clip(corr[:-1, :-1], 0, None).sum(axis=1)
            damp = np.append(damp, 1.0)
        prior = np.clip(post.mean(), 1e-4, 1 - 1e-4)
        odds = np.log(prior / (1 - prior)) + (
            v * (damp * np.log(fire[1] / fire[0])) + (1 - v) * (damp * np.log((1 - fire[1]) / (1 - fire[0])))
        ).sum(axis=1)
        post = 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))
    return post, fire, corr


def fit_linear(x: np.ndarray, soft: np.ndarray, l2: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression on soft labels by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.full(len(w), l2)
    ridge[-1] = 1e-6
    for _ in range(50):
        q = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (q - soft) + ridge * w
        hess = (z * np.maximum(q * (1 - q), 1e-6)[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def _measured(mined: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(mined)
        for b in batches:
            rows = [measure(t, lookup, len(mined)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), b.column("toxic")], names=["x", "toxic"]
            )

    return run


def lexicon_only() -> Model:
    """Without labels: toxic from two hits, or one in few words."""
    names = [*voters(()), *DENSE]
    w = np.zeros(len(names) + 1)
    w[names.index("hits")], w[names.index("per_hundred")], w[-1] = 2.0, 1.0, -3.0
    return Model((), np.zeros(len(names)), np.ones(len(names)), w)


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """``docs`` (doc_id, text), ``labels`` (doc_id, toxic): rows allowed for training."""
    spark = docs.sparkSession
    given = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").dropDuplicates(["doc_id", "toxic"])
    full = 1 << 30
    share = min(full, int(full * p.sample / max(1, given.count())) + 1)
    ids = given.filter(F.pmod(F.xxhash64(F.lit(p.seed), "doc_id"), F.lit(full)) < share)
    # At most about p.sample rows of two numbers: a bounded broadcast.
    rows = docs.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id", "toxic", "text"])
    sample = written(rows.select("text", F.col("toxic").cast("int").alias("toxic")), "toxic-sample")
    mined = _mine(sample, p)
    got = sample.mapInArrow(frugal(_measured(mined)), "x array<double>, toxic int").toArrow()
    y = got.column("toxic").to_numpy().astype(float) > 0
    if min(y.sum(), (~y).sum()) < p.min_class:
        return lexicon_only()
    x = np.stack(got.column("x").to_numpy(zero_copy_only=False))
    order = np.lexsort(x.T)  # the same sums whatever order the rows came in
    x, y = x[order], y[order].astype(float)
    m = len(voters(mined))
    post, fire, corr = label_model(x[:, :m], y, p.rounds)
    mean, scale, w = fit_linear(x, post, p.l2)
    return Model(mined, mean, scale, w, fire, corr)


def score(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """``docs`` columns ``keep`` with the score of the whole text as ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        lookup = Lookup(m.mined)
        for b in batches:
            texts = b.column("text").to_pylist()
            x = np.array([measure(t, lookup, len(m.mined)) for t in texts]).reshape(len(texts), len(m.mean))
            z = (x - m.mean) / m.scale @ m.weights[:-1] + m.weights[-1]
            s = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(s)], names=[*keep, name])

    fields = ", ".join(f"`{c}` {t}" for c, t in docs.select(keep).dtypes)
    return docs.mapInArrow(frugal(run), f"{fields}, {name} double")


def detect(documents: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.3, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from rows not held out."""
    docs = pick(documents, doc_id="doc_id", text="text")
    known = pick(labels, doc_id="doc_id", toxic="toxic").filter(~held_out)
    model = train(docs, known, p)
    scored = score(docs.withColumn("held_out", held_out), model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
