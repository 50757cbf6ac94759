"""SentencePiece encoding and decoding by a weighted finite-state transducer.

A model file is compiled into a normaliser, a transducer of pieces (a trie whose finals carry piece
and weight) and a byte fallback for characters without a piece. Composed with a text, the transducer
gives a lattice of pieces; the encoding is its shortest path in the tropical semiring (min, +).

Weights. A unigram model weighs each piece by its negative score. A BPE model defines its encoding by
an order of merges, not by a sum; it is expressed by weights on *pairs* of neighbouring pieces: 0 if
merging their joined characters ends in just these two, infinite otherwise. A segmentation is the BPE
encoding exactly if all its neighbours are such pairs (no merge ever crosses a border that survives),
so there is one path of finite weight, and every prefix of a text has one too.

Pieces with white space only at their front let a text be cut before each run of it; the cuts are
composed one by one and remembered, so a distinct word is searched once.

Defined cases: a null or empty text has no ids; rows are encoded one by one, repeated ones alike; a null
id is passed through; other columns are not touched.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from tripwright.llm import shared
from tripwright.llm import words as W

SPACE = "▁"
_INF = float("inf")

# Numbers of fields and kinds in the public model file format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, raw[at : at + size]
            at += size


@dataclass
class Normaliser:
    """Replacement of characters, white space marks and the mark put in front of a text."""

    prefix: bool = True
    squeeze: bool = True
    units: np.ndarray | None = None  # double array of the strings to replace
    replacements: bytes = b""

    @staticmethod
    def compile(spec: dict[int, int | bytes]) -> Normaliser:
        out = Normaliser(bool(spec.get(3, 1)), bool(spec.get(4, 1)))
        if table := spec.get(2, b""):
            size = struct.unpack("<I", table[:4])[0]
            out.units = np.frombuffer(table[4 : 4 + size], dtype="<u4")
            out.replacements = table[4 + size :]
        return out

    def _longest(self, data: bytes, at: int) -> tuple[int, int] | None:
        """Length and replacement of the longest string to replace that begins at ``at``."""

        def offset(unit: int) -> int:
            return (unit >> 10) << ((unit & 512) >> 6)

        units, found = self.units, None
        node = offset(int(units[0]))
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(units):
                break
            unit = int(units[node])
            if unit & 0x800000FF != data[k]:
                break
            node ^= offset(unit)
            if unit & 256:
                found = k + 1 - at, int(units[node]) & 0x7FFFFFFF
        return found

    def _replaced(self, text: str) -> str:
        data, out, at = text.encode(), bytearray(), 0
        while at < len(data):
            if found := self._longest(data, at):
                out += self.replacements[found[1] : self.replacements.index(b"\0", found[1])]
                at += found[0]
            else:
                out.append(data[at])
                at += 1
        return out.decode()

    def __call__(self, text: str) -> str:
        if self.units is not None:
            text = self._replaced(text)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)


@dataclass
class Transducer:
    """A compiled model. ``ids_of`` caches the path of each cut; ``pairs`` the weights of BPE pairs."""

    kind: int
    pieces: list[str]
    kinds: list[int]
    scores: list[float]
    normalise: Normaliser
    byte_fallback: bool
    most_cached: int = 200_000
    trie: dict = field(default_factory=dict)
    ids_of: dict[str, tuple[int, ...]] = field(default_factory=dict)
    older: dict[str, tuple[int, ...]] = field(default_factory=dict)
    pairs: dict[tuple[str, str], bool] = field(default_factory=dict)

    def __post_init__(self) -> None:
        usable = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (_NORMAL, _USER_DEFINED, _UNUSED) and p}
        self.score_of = {p: self.scores[i] for p, i in usable.items()}
        self.id_of = usable
        self.unknown = self.kinds.index(_UNKNOWN) if _UNKNOWN in self.kinds else 0
        self.byte_ids = [-1] * 256
        for i, (p, k) in enumerate(zip(self.pieces, self.kinds)):
            if k == _BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        self.worst = min((self.scores[i] for i in usable.values()), default=0.0) - 10.0
        self.fixed = sorted((p for p, i in usable.items() if self.kinds[i] == _USER_DEFINED), key=len, reverse=True)
        live = [p for p, i in usable.items() if self.kinds[i] == _NORMAL and (self.kind == _UNIGRAM or len(self._merged(list(p))) == 1)]
        for p in live:
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = p
        inside = any(SPACE in p.lstrip(SPACE) for p in live)
        line = any("\n" in p and len(p) > 1 for p in live)
        stop = "" if line else "\n"
        cut = "[\\s\\S]+" if inside else f"{SPACE}*[^{SPACE}{stop}]+|{SPACE}+" + ("" if line else "|\n")
        first = "".join(re.escape(p) + "|" for p in self.fixed)
        if self.fixed:
            cut = f"(?:(?!{first[:-1]})[\\s\\S])+"
        self.cuts = re.compile(first + cut)
        text_of = []
        for i, (p, k) in enumerate(zip(self.pieces, self.kinds)):
            text_of.append("" if k == _CONTROL else " ⁇ " if k == _UNKNOWN else p.replace(SPACE, " "))
        self.text_of = text_of
        self.is_byte = np.array([k == _BYTE for k in self.kinds])

    # --- composition and shortest path ---------------------------------------------------

    def _merged(self, symbols: list[str]) -> list[str]:
        """BPE: join the neighbours with the best score, the leftmost of equals, until none is a piece."""
        score = self.score_of
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                s = score.get(symbols[k] + symbols[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _follows(self, a: str, b: str) -> bool:
        """BPE: whether the weight of b after a is finite."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 4 * self.most_cached:
                self.pairs.clear()
            known = self.pairs[a, b] = self._merged(list(a + b)) == [a, b]
        return known

    def path(self, text: str) -> list[str]:
        """Output strings of the shortest path of the composition with ``text``."""
        n, bpe = len(text), self.kind == _BPE
        weight = [_INF] * (n + 1)
        last = [""] * (n + 1)
        weight[0] = 0.0
        for i in range(n):
            if weight[i] == _INF:
                continue
            node, before, alone = self.trie, last[i], True
            for j in range(i, n):
                node = node.get(text[j])
                if node is None:
                    break
                piece = node.get("")
                if piece is None:
                    continue
                alone = alone and j > i
                if bpe:
                    if weight[j + 1] == _INF and (not before or self._follows(before, piece)):
                        weight[j + 1], last[j + 1] = 0.0, piece
                elif (w := weight[i] - self.score_of[piece]) < weight[j + 1]:
                    weight[j + 1], last[j + 1] = w, piece
            if alone:  # a character without a piece
                c = text[i]
                if bpe:
                    if weight[i + 1] == _INF and (not before or self._follows(before, c)):
                        weight[i + 1], last[i + 1] = 0.0, c
                elif (w := weight[i] - self.worst) < weight[i + 1]:
                    weight[i + 1], last[i + 1] = w, c
        out, at = [], n
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _cut_ids(self, cut: str) -> tuple[int, ...]:
        if cut in self.fixed:
            return (self.id_of[cut],)
        ids: list[int] = []
        for piece in self.path(cut):
            known = self.id_of.get(piece)
            if known is not None:
                ids.append(known)
            elif self.byte_fallback:
                ids += [self.byte_ids[b] for b in piece.encode()]
            elif not ids or ids[-1] != self.unknown:  # a run of unknown characters is one piece
                ids.append(self.unknown)
        return tuple(ids)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for cut in self.cuts.findall(self.normalise(text or "")):
            ids = self.ids_of.get(cut)
            if ids is None:
                ids = self.older.get(cut) or self._cut_ids(cut)
                if len(cut) <= 64:
                    if len(self.ids_of) > self.most_cached:
                        # What was not used since the last time goes; the rest comes back when used.
                        self.older, self.ids_of = self.ids_of, {}
                    self.ids_of[cut] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        if ids and self.is_byte[ids].any():
            text, run = [], bytearray()
            for i in ids:
                if self.is_byte[i]:
                    run.append(int(self.pieces[i][3:5], 16))
                else:
                    if run:
                        text.append(run.decode(errors="replace"))
                        run.clear()
                    text.append(self.text_of[i])
            text.append(run.decode(errors="replace"))
            out = "".join(text)
        else:
            out = "".join(map(self.text_of.__getitem__, ids))
        return out[1:] if self.normalise.prefix and out.startswith(" ") else out


def compile_model(raw: bytes, kind: int | None = None) -> Transducer:
    """The transducer of a model file; ``kind`` 1 reads its scores as unigram weights, 2 as BPE ranks."""
    pieces, kinds, scores = [], [], []
    trainer: dict[int, int | bytes] = {}
    normaliser: dict[int, int | bytes] = {}
    for number, value in _fields(raw):
        if number == _PIECES:
            f = dict(_fields(value))
            pieces.append(f.get(1, b"").decode())
            scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
            kinds.append(f.get(3, _NORMAL))
        elif number == _TRAINER:
            trainer = dict(_fields(value))
        elif number == _NORMALIZER:
            normaliser = dict(_fields(value))
    kind = kind or trainer.get(3, _UNIGRAM)
    if kind not in (_UNIGRAM, _BPE):
        raise ValueError(f"model type {kind} is neither unigram nor BPE")
    return Transducer(kind, pieces, kinds, scores, Normaliser.compile(normaliser), bool(trainer.get(35, 0)))


def encode(docs: DataFrame, model: bytes, column: str = "text", decoded: bool = False) -> DataFrame:
    """All columns and ``ids``, ``round_trip`` (whether decoding the ids gives the text back) and, if asked
    for, ``decoded``. A column of the documents with one of these names is replaced."""
    sent = shared.send(docs.sparkSession.sparkContext, compile_model(model))  # as large as the model file
    new = ["ids", "round_trip"] + ["decoded"] * decoded
    docs = docs.drop(*[n for n in new if n != column])
    names = docs.columns
    fields = [StructField("ids", ArrayType(IntegerType(), False)), StructField("round_trip", BooleanType()), StructField("decoded", StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.receive(sent)
        for block in W.blocks(batches, column):
            texts = W.column(block, column).to_pylist()
            ids = [own.encode(t) for t in texts]
            back = [own.decode(i) for i in ids]
            ends = np.cumsum([0] + [len(i) for i in ids]).astype(np.int32)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
            out = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array([b == (t or "") for b, t in zip(back, texts)])]
            out += [pa.array(back)] * decoded
            yield pa.RecordBatch.from_arrays([*block.columns, *out], [*names, *new])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields[: len(new)]]))
