"""Language identification by words first, then shorter and shorter n-grams.

A word of the model scores its log frequency in each language. A word the
model does not know is covered from left to right by the longest character
n-gram the model knows (five characters down to one, with word boundaries),
each scored by its log frequency in each language.

The model is a classifier fitted on a sample of labelled rows of at most
about ``docs_per_lang`` documents a language, chosen by a hash of id and text;
a language's repeated rows count once. Its size is bounded by ``words`` and
``grams`` entries for each language. Prediction reads whole texts and nothing
but texts.

Rows: a null text, or one without a letter, is ``und`` with score 0; with no
labelled row at all every text is ``und``; rows with null or repeated ids are
each predicted. Ties go to the language that comes first by code point. An
empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick

LETTERS = re.compile(r"[^\W\d_]+")
MAX_GRAM = 5
UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    docs_per_lang: int = 3000
    least: int = 1  # occurrences from which a word or n-gram is learnt
    smoothing: float = 0.5
    memo: int = 300_000  # unknown words whose scores a task remembers
    seed: int = 11


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int] = field(default_factory=dict)
    word_scores: np.ndarray | None = None
    grams: dict[str, int] = field(default_factory=dict)
    gram_scores: np.ndarray | None = None


def bounded_sample(df: DataFrame, lang: str, keys: list[str], p: Params) -> DataFrame:
    """About ``docs_per_lang`` rows of each language by hash; equal rows once."""
    sizes = {r[0]: r[1] for r in df.groupBy(lang).count().collect()}
    if not sizes:
        return df.limit(0)
    full = 1 << 30
    share = F.create_map(
        *[F.lit(x) for k, n in sizes.items() for x in (k, min(full, int(full * p.docs_per_lang / n) + 1))]
    )
    h = F.xxhash64(F.lit(p.seed), *keys)
    return df.filter(F.pmod(h, F.lit(full)) < share[F.col(lang)]).dropDuplicates([lang, *keys])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by (lang, kind, gram); kind 0 holds words, 1 to 5 n-grams."""
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        keys = list(counts)
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([k[2] for k in keys], pa.string()),
                pa.array([counts[k] for k in keys], pa.int64()),
            ],
            names=["lang", "kind", "gram", "n"],
        )
        counts.clear()
        return out

    for batch in batches:
        by_lang: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_lang.setdefault(lang, Counter()).update(LETTERS.findall((text or "").lower()))
        for lang, words in by_lang.items():
            for w, n in words.items():
                counts[lang, 0, w] += n
                s = f"_{w}_"
                for k in range(1, MAX_GRAM + 1):
                    for i in range(len(s) - k + 1):
                        counts[lang, k, s[i : i + k]] += n
        if len(counts) > 500_000:
            yield flush()
    yield flush()


def train(labelled: DataFrame, p: Params = Params()) -> Model:
    """Fit on ``labelled`` (columns doc_id, text, lang; null langs unused)."""
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    sample = bounded_sample(rows, "lang", ["doc_id", "text"], p).select("lang", "text")
    counts = (
        sample.mapInArrow(_count_grams, "lang string, kind int, gram string, n long")
        .groupBy("lang", "kind", "gram")
        .agg(F.sum("n").alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("lang", "kind"))
    kept = counts.withColumn("total", total).filter(F.col("n") >= p.least)
    # No more than the words and n-grams of the sample, whose size is bounded.
    found = kept.toArrow().to_pydict()
    langs = sorted(set(found["lang"]))
    model = Model(langs)
    at = {lang: i for i, lang in enumerate(langs)}
    totals: dict[tuple[int, int], int] = {}
    tables: tuple[dict, dict] = ({}, {})
    for lang, kind, gram, n, tot in zip(*(found[c] for c in ("lang", "kind", "gram", "n", "total"))):
        totals[at[lang], kind] = tot
        tables[kind > 0].setdefault(gram, {})[at[lang]] = n
    model.words, model.word_scores = _scores(tables[0], totals, len(langs), p, word=True)
    model.grams, model.gram_scores = _scores(tables[1], totals, len(langs), p, word=False)
    return model


def _scores(grams: dict, totals: dict, n_langs: int, p: Params, word: bool) -> tuple[dict, np.ndarray]:
    index, scores = {}, np.zeros((len(grams), n_langs))
    sizes = Counter(0 if word else len(g) for g in grams)
    for i, (g, by_lang) in enumerate(grams.items()):
        index[g] = i
        kind = 0 if word else len(g)
        for j in range(n_langs):
            n = by_lang.get(j, 0) + p.smoothing
            scores[i, j] = math.log(n / (totals.get((j, kind), 0) + p.smoothing * sizes[kind]))
    return index, scores


def _backoff(word: str, model: Model) -> np.ndarray:
    """Mean over the n-grams that cover ``word``, longest known ones first."""
    s, i, hits = f"_{word}_", 0, []
    grams = model.grams
    while i < len(s):
        for k in range(min(MAX_GRAM, len(s) - i), 0, -1):
            at = grams.get(s[i : i + k])
            if at is not None:
                hits.append(at)
                i += max(1, k - 1)
                break
        else:
            i += 1
    if not hits:
        return np.zeros(len(model.langs))
    return model.gram_scores[hits].mean(axis=0)


def _predictor(shared, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        langs, known, table = model.langs, model.words, model.word_scores
        memo: dict[str, np.ndarray] = {}
        for batch in batches:
            preds, scores = [], []
            for text in batch.column("text").to_pylist():
                words = LETTERS.findall(text.lower()) if text and langs else ()
                # the pattern also takes numerals such as ², which are no letters
                if not any(c.isalpha() for w in words for c in w):
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                ids, new = [], []
                for w in words:
                    at = known.get(w)
                    if at is None:
                        new.append(w)
                    else:
                        ids.append(at)
                total = table[ids].sum(axis=0) if ids else np.zeros(len(langs))
                for w, n in Counter(new).items():
                    got = memo.get(w)
                    if got is None:
                        if len(memo) >= p.memo:
                            memo.clear()
                        got = memo[w] = _backoff(w, model)
                    total = total + n * got
                mean = total / len(words) * min(len(words), 20)
                e = np.exp(mean - mean.max())
                best = int(total.argmax())
                preds.append(langs[best])
                scores.append(float(e[best] / e.sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                names=[*(c for c in batch.schema.names if c != "text"), "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, model: Model, held_out: Column | None = None, p: Params = Params()) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # size bound: see Params
    cols = ["doc_id"]
    if held_out is not None:
        docs, cols = docs.withColumn("held_out", held_out), ["doc_id", "held_out"]
    fields = ", ".join(f"{c} {t}" for c, t in docs.select(cols).dtypes)
    return docs.select(*cols, "text").mapInArrow(
        _predictor(shared, p), f"{fields}, lang_pred string, score double"
    )


def identify(df: DataFrame, is_held_out: Column, p: Params = Params()) -> DataFrame:
    """Train on the rows of ``df`` that are not held out, predict all rows."""
    docs = pick(df, doc_id="doc_id", text="text", lang="lang")
    model = train(docs.filter(~is_held_out), p)
    return predict(docs.select("doc_id", "text"), model, is_held_out, p)
