"""SentencePiece models on the Tokenizers library.

The model file's protobuf is parsed here (wire format, the few fields needed);
from it the normaliser, the metaspace marker, the unigram scores or the merges
of a BPE model, and byte fallback are rebuilt as a Tokenizers pipeline.
``verify=True`` encodes every text with SentencePiece itself as well and reports
whether the ids are the same.

Normalised texts are cut before each run of markers. That is exact because no
piece of the model has a marker after another character (checked on loading).
A task encodes each distinct word once, with the library's model alone (no
pipeline around each word), and compares words in batches. It remembers up to
``memo`` of them, so memory stays bounded for texts of any length.

Two segmentations of exactly equal unigram score are a tie, which SentencePiece
and the library may break differently; ``verify`` reports such a text.

Rows: null text gives null ids and counts, an empty text an empty list;
strings that look like control pieces (``<s>``) are ordinary text; repeated
rows are encoded one by one, rows without an id too; an empty table gives an
empty result; other input columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import frugal, give_back, pick

MARK = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Spec:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True
    suffix_marker: bool = False  # white space marked behind a word

    @property
    def unk_id(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) pairs of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = value = 0
        while True:
            b = buf[at]
            at += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7

    while at < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            yield tag >> 3, buf[at : at + n]
            at += n
        elif kind == 2:
            n = varint()
            yield tag >> 3, buf[at : at + n]
            at += n
        else:
            raise ValueError(f"wire type {kind}")


def parse(model: bytes) -> Spec:
    spec = Spec()
    for number, value in fields(model):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            spec.pieces.append((piece, score, kind))
        elif number == 2:
            got = dict(fields(value))
            spec.model_type = got.get(3, UNIGRAM)
            spec.byte_fallback = bool(got.get(35, 0))
            spec.suffix_marker = bool(got.get(24, 0))
        elif number == 3:
            got = dict(fields(value))
            spec.charsmap = got.get(2, b"")
            spec.add_dummy_prefix = bool(got.get(3, 1))
            spec.remove_extra_whitespaces = bool(got.get(4, 1))
            spec.escape_whitespaces = bool(got.get(5, 1))
    return spec


def merges(spec: Spec) -> list[tuple[str, str]]:
    """Every way to make a piece of two others, best piece first."""
    usable = {p: s for p, s, kind in spec.pieces if kind in (NORMAL, USER)}
    found = [
        (-score, k, piece[:k], piece[k:])
        for piece, score in usable.items()
        for k in range(1, len(piece))
        if piece[:k] in usable and piece[k:] in usable
    ]
    return [(a, b) for _, _, a, b in sorted(found)]


def build(spec: Spec):
    """The Tokenizers pipeline of a model, and one for its single words."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if any(kind == UNUSED for *_, kind in spec.pieces) or not spec.escape_whitespaces:
        raise ValueError("unsupported model: unused pieces or unescaped white space")
    if spec.suffix_marker or any(kind == USER for *_, kind in spec.pieces):
        raise ValueError("unsupported model: markers behind words or user-defined pieces")
    if any(re.search(f"[^{MARK}]{MARK}", p) for p, _, kind in spec.pieces if kind in (NORMAL, USER)):
        raise ValueError("unsupported model: a piece has a marker after another character")
    unk = spec.pieces[spec.unk_id][0]
    if spec.model_type == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(spec.pieces)}
        model = models.BPE(
            vocab, merges(spec), cache_capacity=0, unk_token=unk, fuse_unk=True, byte_fallback=spec.byte_fallback
        )
    elif spec.model_type == UNIGRAM:
        model = models.Unigram(
            [(p, s) for p, s, _ in spec.pieces], unk_id=spec.unk_id, byte_fallback=spec.byte_fallback
        )
    else:
        raise ValueError(f"unsupported model type {spec.model_type}")
    words = Tokenizer(model)  # takes single normalised words
    if spec.model_type == UNIGRAM:
        # The library would match the names of control and byte pieces in a
        # text. Here they have names no text holds and a neutral score, and
        # Codec replaces unknown characters by their bytes.
        hidden = [(p, s) if kind in (NORMAL, USER) else (f"\0\0{i}\0", 0.0) for i, (p, s, kind) in enumerate(spec.pieces)]
        words = Tokenizer(models.Unigram(hidden, unk_id=spec.unk_id, byte_fallback=False))
    whole = Tokenizer(model)
    steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    steps.append(normalizers.Replace(" ", MARK))
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    whole.normalizer = normalizers.Sequence(steps)
    whole.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    parts = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if spec.add_dummy_prefix:
        parts.append(decoders.Strip(" ", 1, 0))
    whole.decoder = decoders.Sequence(parts)
    return whole, words


class Codec:
    """Encodes and decodes lists of texts with one model.

    With ``exact``, a SentencePiece processor of the same model, every word is
    also encoded by SentencePiece when it is learnt. Pieces never reach over the
    marker that begins a word (checked by ``build``), so a text whose words
    agree agrees as a whole. ``exact_batch`` encodes a list of texts with it in
    one call (if not given: one by one).
    """

    def __init__(
        self,
        model: bytes,
        memo: int = 400_000,
        long_word: int = 200,
        exact=None,
        exact_batch: Callable[[list[str]], list[list[int]]] | None = None,
    ):
        self.exact, self.wrong = exact, set()  # normalised words that SentencePiece encodes otherwise
        self.exact_batch = exact_batch or (lambda texts: [exact.encode(t, num_threads=1) for t in texts])
        self.spec, self.limit, self.long_word = parse(model), memo, long_word
        self.pipeline, self.by_word = build(self.spec)
        # Only markers replaced: done here, without the library's alignments.
        self.plain = not self.spec.charsmap and not self.spec.remove_extra_whitespaces
        self.word = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.memo: dict[str, bytes] = {}  # ids as C ints
        self.after_space: dict[str, bytes] = {}
        self.byte_id = {int(p[3:-1], 16): i for i, (p, _, kind) in enumerate(self.spec.pieces) if kind == BYTE}
        self.raw = [
            bytes([int(p[3:-1], 16)]) if kind == BYTE else p.replace(MARK, " ").encode()
            for p, _, kind in self.spec.pieces
        ]

    def normalise(self, text: str) -> str:
        if not self.plain:
            return self.pipeline.normalizer.normalize_str(text)
        text = text.replace(" ", MARK)
        return MARK + text if text and self.spec.add_dummy_prefix else text

    def _with_bytes(self, word: str) -> list[int]:
        """Ids of a word with its unknown stretches as bytes."""
        e = self.by_word.encode(word, add_special_tokens=False)
        out: list[int] = []
        for i, (a, b) in zip(e.ids, e.offsets):
            out += [self.byte_id[x] for x in word[a:b].encode()] if i == self.spec.unk_id else [i]
        return out

    def _words(self, text: str) -> tuple[dict[str, bytes], list[str]]:
        """The text's words, and the memo they belong to: words that follow
        a single space, without their marker, or normalised words."""
        single = self.plain and self.spec.add_dummy_prefix and text[:1] not in ("", " ")
        if single and "  " not in text and MARK not in text:
            return self.after_space, text.split(" ")
        return self.memo, self.word.findall(self.normalise(text))

    def _learn(self, memo: dict[str, bytes], mark: str, words: set[str]) -> list[str]:
        """Encode new words; those too long to remember are returned."""
        new, cut = list(words), self.by_word.model.tokenize
        for at in range(0, len(new), 4096):
            part = [mark + w for w in new[at : at + 4096]]
            found = [[t.id for t in cut(m)] for m in part]
            if self.byte_id:
                unk = self.spec.unk_id
                found = [self._with_bytes(m) if unk in ids else ids for m, ids in zip(part, found)]
            if self.exact is not None:
                self.wrong.update(m for m, ids, true in zip(part, found, self._exact_ids(part)) if ids != true)
            memo.update(zip(new[at : at + 4096], [array("i", ids).tobytes() for ids in found]))
        return [w for w in new if len(w) > self.long_word]

    def _exact_ids(self, words: list[str]) -> list[list[int]]:
        """SentencePiece's ids of normalised words, by the texts they stand for."""
        texts = [w.replace(MARK, " ") for w in words]
        if not self.spec.add_dummy_prefix:
            return self.exact_batch(texts)
        found = self.exact_batch([t[1:] if t[:1] == " " else t for t in texts])
        if MARK in words:  # an empty text gets no marker: look behind a word
            behind, word = self.exact_batch(["a ", "a"])
            found[words.index(MARK)] = behind[len(word) :]
        return found

    def agrees(self, texts: list[str]) -> list[bool]:
        """Whether SentencePiece gives the ids that :meth:`encode` gave."""
        if not self.plain:  # its normaliser may join what it finds: whole texts
            return [self.exact.encode(t, num_threads=1) == x.tolist() for t, x in zip(texts, self.encode(texts))]
        if not self.wrong:
            return [True] * len(texts)
        return [not any((MARK if m is self.after_space else "") + w in self.wrong for w in words) for m, words in map(self._words, texts)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.memo) + len(self.after_space) > self.limit:
            self.memo, self.after_space = {}, {}
        split = [self._words(t) for t in texts]
        long = []
        for memo, mark in ((self.memo, ""), (self.after_space, MARK)):
            new = {w for m, words in split if m is memo for w in words if w not in memo}
            long += [(memo, w) for w in self._learn(memo, mark, new)]
        out = [np.frombuffer(b"".join([memo[w] for w in words]), np.intc).astype(np.int32) for memo, words in split]
        for memo, w in long:
            del memo[w]
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Pieces joined as bytes; the library decodes what is not UTF-8."""
        out = []
        for x in ids:
            x = x.tolist()
            try:
                text = b"".join([self.raw[i] for i in x]).decode("utf-8")
            except UnicodeDecodeError:
                out.append(self.pipeline.decode(x, skip_special_tokens=False))
                continue
            out.append(text[1:] if self.spec.add_dummy_prefix and text[:1] == " " else text)
        return out


SCHEMA = (
    "doc_id long, token_ids array<int>, n_tokens long, n_byte_tokens long, ids_sha256 string, "
    "round_trip boolean, parity boolean"
)


def _coded(shared, verify: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = batch = None
        if verify:
            import sentencepiece

            exact = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
            batch = partial(exact.encode, num_threads=1)
        codec = Codec(shared.value, exact=exact, exact_batch=batch)
        give_back()  # what the model's tables were built from
        byte = np.array([kind == BYTE for *_, kind in codec.spec.pieces])
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = part.column("text").to_pylist()
                ids = codec.encode([t or "" for t in texts])
                back = codec.decode(ids)
                known = [t is not None for t in texts]
                pick_ = lambda xs: [x if k else None for x, k in zip(xs, known)]
                cols = {
                    "doc_id": part.column("doc_id"),
                    "token_ids": pa.array(pick_(ids), pa.list_(pa.int32())),
                    "n_tokens": pa.array(pick_([len(x) for x in ids]), pa.int64()),
                    "n_byte_tokens": pa.array(pick_([int(byte[x].sum()) for x in ids]), pa.int64()),
                    "ids_sha256": pa.array(pick_([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids])),
                    "round_trip": pa.array(pick_([a == t for a, t in zip(back, texts)]), pa.bool_()),
                    "parity": pa.array(
                        pick_(codec.agrees([t or "" for t in texts]))
                        if exact
                        else [None] * len(texts),
                        pa.bool_(),
                    ),
                }
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def encode_documents(df: DataFrame, model_path: str = DEFAULT_MODEL, verify: bool = True) -> DataFrame:
    """Token ids of every whole text, whether decoding gives the text back,
    and (``verify``) whether SentencePiece gives the same ids, compared once
    for each word that a task learns."""
    docs = pick(df, doc_id="doc_id", text="text")
    with open(model_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())  # one model file
    return docs.mapInArrow(frugal(_coded(shared, verify)), SCHEMA)


def decode_documents(df: DataFrame, ids_col: str = "token_ids", model_path: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id and the text that the ids in ``ids_col`` stand for (null: null)."""
    with open(model_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for b in batches:
            ids = b.column("ids").to_pylist()
            texts = codec.decode([np.array(x or [], np.int32) for x in ids])
            out = [t if x is not None else None for t, x in zip(texts, ids)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return pick(df, doc_id="doc_id", ids=ids_col).mapInArrow(frugal(run), "doc_id long, text string")
