"""Fill-in-middle transformation over whole lines, by word-parallel select.

A text is cut into lines (units, each with its ``\\n``) and rearranged as prefix,
suffix and middle behind sentinels. The cuts are found without looking at
single characters: the UTF-8 bytes of a whole Arrow batch are viewed as 64-bit
words, the bytes that end a unit are marked in every word by arithmetic alone,
``bitwise_count`` gives the marks of each word and their running sum the marks
before it. The k-th unit end is then a binary search for its word and a select
of the remaining marks within that word. The same ranks over the bytes that
start a code point give lengths in code points.

The random choices are fixed by ``Params.seed`` and the document id alone:
h1 to h4 are the first four groups of eight hex digits of
sha256("seed:doc_id").

Rows: null text counts as empty; a text without characters has no unit and
stays plain; a text that holds a sentinel stays plain; a null id is the empty
string in the hash; rows that repeat are transformed alike; long texts take no
other way; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick

U = np.uint64
LOW7 = U(0x7F7F7F7F7F7F7F7F)
HIGH = U(0x8080808080808080)
ONE = U(1)
NEWLINES = U(0x0A0A0A0A0A0A0A0A)


@dataclass(frozen=True)
class Params:
    seed: int = 7
    rate: int = 100  # of 100 texts, so many are transformed
    spm: int = 50  # of 100 transformed ones, so many are in suffix-prefix-middle order
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def line_ends(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is ``\\n``. No carry leaves a byte."""
    x = words ^ NEWLINES
    return ~(((x & LOW7) + LOW7) | x) & HIGH


def char_starts(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that starts a code point (not 10xxxxxx)."""
    return (~words | (words << ONE)) & HIGH


class Marks:
    """Rank and select over one marked bit in each byte."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before byte ``at``."""
        word, inside = at >> 3, (at & 7).astype(U)
        below = (ONE << (inside << U(3))) - ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte of the k-th mark, counted from 1: the running sums give its
        word, clearing lower marks one by one its place there."""
        word = np.searchsorted(self.before, k, side="left") - 1
        left = k - self.before[word]
        bits = self.marks[word].copy()
        for _ in range(7):
            more = left > 1
            if not more.any():
                break
            bits[more] &= bits[more] - ONE
            left = left - more
        lowest = bits & (~bits + ONE)
        return (word << 3) + (np.bitwise_count(lowest - ONE) >> 3)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes padded to whole words, with one word to spare; offsets)."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(ends[-1] - ends[0])
    raw = np.zeros((size // 8 + 2) * 8, np.uint8)
    if size:
        raw[:size] = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return raw, ends - ends[0]


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """h1 to h4 of a document."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = hashlib.sha256(text.encode()).digest()
    return tuple(int.from_bytes(h[i : i + 4], "big") for i in (0, 4, 8, 12))


def cuts(column: pa.Array, ids: list, p: Params) -> dict[str, np.ndarray]:
    """For every text: its bytes' range, units ``n``, the bytes where prefix
    and middle end, and the code points of both."""
    raw, ends = _bytes_of(column)
    words = raw.view("<u8")
    units, chars = Marks(line_ends(words)), Marks(char_starts(words))
    start, end = ends[:-1], ends[1:]
    first = units.rank(start)
    closed = units.rank(end) - first
    open_end = (end > start) & (raw[np.maximum(end - 1, 0)] != 0x0A)
    n = closed + open_end
    h = np.array([draws(i, p.seed) for i in ids], np.int64).reshape(-1, 4)
    a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)

    def after(k: np.ndarray) -> np.ndarray:
        """The byte after the k-th unit; an open last unit ends with the text."""
        at = np.where(k > closed, end, start)
        inner = (k > 0) & (k <= closed)
        at[inner] = units.select((first + k)[inner]) + 1
        return at

    p_end, m_end = after(np.minimum(a, b)), after(np.maximum(a, b))
    chars_at = [chars.rank(x) for x in (start, p_end, m_end)]
    return {
        "raw": raw, "start": start, "end": end, "n": n, "p_end": p_end, "m_end": m_end, "h3": h[:, 2], "h4": h[:, 3],
        "prefix_chars": chars_at[1] - chars_at[0], "middle_chars": chars_at[2] - chars_at[1],
    }


def arrange(form: str, prefix: bytes, middle: bytes, suffix: bytes, p: Params) -> bytes:
    P, S, M = (x.encode() for x in (p.prefix, p.suffix, p.middle))
    if form == "plain":
        return prefix + middle + suffix
    return P + prefix + S + suffix + M + middle if form == "psm" else S + suffix + P + prefix + M + middle


def restore(output: bytes, form: str, p: Params = Params()) -> bytes:
    """The text, from output and form alone."""
    if form == "plain":
        return output
    P, S, M = (x.encode() for x in (p.prefix, p.suffix, p.middle))
    lead, second = (P, S) if form == "psm" else (S, P)
    if not output.startswith(lead):
        raise ValueError(f"{form} output without its first sentinel")
    one, rest = output[len(lead) :].split(second, 1)
    two, middle = rest.split(M, 1)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string"


def _transformed(p: Params):
    marks = [x.encode() for x in (p.prefix, p.suffix, p.middle)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            c = cuts(batch.column("text"), ids, p)
            raw = c["raw"].tobytes()
            forms, outputs, restored = [], [], []
            for s, pe, me, e, h3, h4 in zip(*(c[k].tolist() for k in ("start", "p_end", "m_end", "end", "h3", "h4"))):
                text = raw[s:e]
                plain = s == e or h3 % 100 >= p.rate or any(m in text for m in marks)
                form = "plain" if plain else "spm" if h4 % 100 < p.spm else "psm"
                out = arrange(form, raw[s:pe], raw[pe:me], raw[me:e], p)
                forms.append(form)
                outputs.append(out)
                restored.append(restore(out, form, p))
            plain = np.array([f == "plain" for f in forms], bool)
            strings = [pa.array(x, pa.binary()).view(pa.string()) for x in (outputs, restored)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(c["n"], pa.int64()), pa.array(forms, pa.string()),
                    pa.array(c["prefix_chars"], pa.int64(), mask=plain), pa.array(c["middle_chars"], pa.int64(), mask=plain),
                    *strings,
                ],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return run


def fill_in_middle(df: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, restored (the text
    rebuilt from output and form): one row per input row."""
    docs = pick(df, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(_transformed(p), SCHEMA)


def fill_in_middle_digest(df: DataFrame, p: Params = Params()) -> DataFrame:
    """The query's columns: SHA-256 of output and restored text."""
    return fill_in_middle(df, p).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode("restored", "UTF-8"), 256).alias("restored_sha256"),
    )
