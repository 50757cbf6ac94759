"""Phrase collocation mining: broadcast double-array tries of Apriori-safe candidates.

One scan turns the texts into blocks of 64-bit word names (language and word; 0 parts pieces) and counts the words. Then, for
phrases of 2, 3, ... words, a pass over the blocks counts the hashes of phrases whose parts one word shorter may be frequent:
tasks hand on hashes with counts, and each bucket of hashes sums its own, so there are as many counters as hashes, however
large the corpus is. Hashes that occur ``least`` times are live. No frequent phrase is lost: all its parts are as frequent, and
a hash counts no less than each phrase that has it. A last pass notes the different phrases of live hashes, the candidates;
all passes look hashes up in bitmaps that grow with the number of live ones, and what a bitmap lets pass wrongly goes where
the noted phrases meet the live hashes themselves. So there are hardly more candidates than frequent phrases.

Candidates of all lengths are dealt to tries of ``PER_TRIE`` phrases, each built as a double array in one task. A trie is
broadcast (its size is bounded, however many there are) and all text positions walk it at once, level by level, with
numpy; accepting states are counted with ``bincount``, and the shards' counts are summed. The tries decide exactly. Each trie
is a pass of its own; its counts are stored and its broadcast given up before the next one, so the driver holds one trie.
A trie's symbols are bytes of the rank its words have in the trie, so a node has at most 256 children.

Word names are checked: if two words of the corpus share a name, all is named anew with another seed. Scores are whole
numbers, computed in decimals of 38 digits.

Defined cases: a null text is empty, a null language ``und``. Rows without id count too; repeated rows count each. Texts
without words count nothing; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm import words as W
from tripwright.llm.packing import pack, pack_sorted, unpack, unpack_sorted
from tripwright.llm.shared import receive, send
from tripwright.llm.tables import written
from tripwright.session import new_workspace

LONGEST = 5
LEAST = 100
#: Bitmaps have 2 ** BITS bits at least, and 8 for each hash in them.
BITS = 23
PER_TRIE = 1 << 18
#: 2 ** BUCKET_BITS buckets by the highest bits of a hash, in which the phrases and counts of all tasks meet. Counts go by 48 bits of a hash.
BUCKET_BITS = 9
_CUT_OFF = 16
#: Words that a task counts before it hands their counts on, hashes likewise, and text bytes handled at once.
FLUSH = 1 << 19
TALLY = 1 << 20
BLOCK_BYTES = 1 << 20
#: Codes in a row, and in a stretch of rows that is worked on at once.
ROW_CODES = 1 << 14
STRETCH = 1 << 17
_CHUNK = 1 << 15
_CUT = np.zeros(256, dtype=bool)  # bytes that end a piece
_CUT[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _CUT.copy()
_GAP[[32, 9]] = True
_ENCODED = pa.schema([
    ("codes", pa.binary()), ("name", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()),
])


# Words


class _Counts:
    """Counts of words by name, with the text of each word kept once."""

    def __init__(self) -> None:
        self.names, self.slot, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.by_slot: list[np.ndarray] = []
        self.lang: list[pa.Array] = []
        self.word: list[pa.Array] = []

    def add(self, names: np.ndarray, count: np.ndarray, describe) -> None:
        """names ascend; ``describe(new)`` gives languages and words of the names at these places."""
        at = np.searchsorted(self.names, names)
        known = np.zeros(len(names), dtype=bool)
        inside = at < len(self.names)
        known[inside] = self.names[at[inside]] == names[inside]
        self.count[self.slot[at[known]]] += count[known]
        new = np.flatnonzero(~known)
        self.slot = np.insert(self.slot, at[new], len(self.count) + np.arange(len(new)))
        self.names = np.insert(self.names, at[new], names[new])
        self.count = np.concatenate([self.count, count[new]])
        lang, word = describe(new)
        self.by_slot.append(names[new]), self.lang.append(lang), self.word.append(word)

    def rows(self) -> dict[str, pa.Array]:
        names = np.concatenate(self.by_slot).view(np.int64)
        return {"name": pa.array(names), "lang": pa.concat_arrays(self.lang), "word": pa.concat_arrays(self.word), "n": pa.array(self.count)}


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes; begin, end and text of each word; and the piece it lies in, ascending."""
    data, offsets = W.text_bytes(texts)
    data = W._LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_GAP[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
    doc = np.searchsorted(offsets, start, side="right") - 1
    cuts = np.cumsum(_CUT[data], dtype=np.int64)
    return data, start, end, doc, (cuts[start] if len(start) else start) + doc


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    body = data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes()))


def encode(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Rows with ``codes`` (names of a block's words, 8 bytes each, 0 between pieces), and rows with a word's ``name``,
    ``lang``, ``word`` and its count ``n`` in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counts()

        def row(**columns: pa.Array) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in _ENCODED], schema=_ENCODED)

        for block in W.blocks(batches, "text", BLOCK_BYTES):
            data, start, end, doc, piece = tokens(W.column(block, "text"))
            if not len(start):
                continue
            lang = W.column(block, "lang").cast(pa.string()).dictionary_encode()
            tongue = W.span_hashes(*_spans(lang.dictionary))
            of_doc = lang.indices.to_numpy()
            with np.errstate(over="ignore"):
                salt = W.mix(tongue + np.uint64(seed))[of_doc[doc]]
                name = W.mix(W.span_hashes(data, start, end) ^ salt)
            name[name == 0] = 1
            different, first, turn, count = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
            size = end - start
            if (size != size[first][turn]).any():
                raise ValueError("two words of a block share a name")
            held.add(different, count, lambda new: (lang.dictionary.take(pa.array(of_doc[doc[first[new]]])), _strings(data, start[first[new]], end[first[new]])))
            breaks = np.flatnonzero(piece[1:] != piece[:-1]) + 1
            yield row(codes=_rows_of(np.insert(name, breaks, 0)))
            if len(held.count) > FLUSH:
                yield row(**held.rows())
                held = _Counts()
        if len(held.count):
            yield row(**held.rows())

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(run, "codes binary, name long, lang string, word string, n long")


def _rows_of(codes: np.ndarray) -> pa.Array:
    """Codes in rows of about ``ROW_CODES``, or a piece; each row ends with a 0."""
    ends = np.append(np.flatnonzero(codes == 0) + 1, len(codes) + 1)
    ends = ends[np.append((ends[:-1] // ROW_CODES) != (ends[1:] // ROW_CODES), True)]
    offsets = np.concatenate(([0], ends)) * 8
    body = pa.py_buffer(np.append(codes, np.uint64(0)).tobytes())
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), body])


def _spans(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = W.text_bytes(strings)
    return data, offsets[:-1], offsets[1:]


# Phrases that may be frequent


def _bits(n: int) -> int:
    """The power of two of a bitmap's size, for n hashes."""
    return max(BITS, (8 * n).bit_length())


def _has(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    at = (names >> np.uint64(65 - (8 * len(bits)).bit_length())).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _first(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the phrases of one word."""
    at = np.flatnonzero(codes)
    return at, codes[at]


def _longer(codes: np.ndarray, at: np.ndarray, value: np.ndarray, size: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the phrases one word longer of which both parts of ``size`` words are given."""
    pair = np.flatnonzero(at[1:] == at[:-1] + 1)
    at, value = at[pair], value[pair]
    return at, W.mix(value * np.uint64(W._BASE) + codes[at + size])


def eligible_of_each(codes: np.ndarray, bits: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """1, 2, ... ``len(bits)`` with places and hashes of the phrases of so many words that may be frequent, as may all their parts."""
    at, value = _first(codes)
    for size, own in enumerate(bits, 1):
        live = _has(own, value)
        at, value = at[live], value[live]
        yield size, at, value
        if size < len(bits):
            at, value = _longer(codes, at, value, size)


def eligible(codes: np.ndarray, bits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``len(bits)`` words."""
    for _, at, value in eligible_of_each(codes, bits):
        pass
    return at, value


def _tallied(held: list[np.ndarray]) -> pa.RecordBatch:
    """Hashes as a row for each bucket that has any: the different ones, ascending, and how often each occurs."""
    values = np.sort(np.concatenate(held) >> np.uint64(_CUT_OFF))
    first = W.runs(values)
    hashes, counts = values[first], np.diff(np.append(first, len(values)))
    bucket = (hashes >> np.uint64(64 - _CUT_OFF - BUCKET_BITS)).astype(np.int32)
    at = W.runs(bucket)
    parts = list(zip(np.split(hashes, at[1:]), np.split(counts, at[1:]), strict=True))
    return pa.RecordBatch.from_arrays([
        pa.array(bucket[at]), pa.array([pack_sorted(h) for h, _ in parts], pa.binary()), pa.array([pack(n, "<u4") for _, n in parts], pa.binary()),
    ], ["bucket", "hashes", "counts"])


def _summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes, ascending, and the sum of each one's counts."""
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = W.runs(every)
    return every[first], np.add.reduceat(np.concatenate(counts)[order], first) if len(first) else np.zeros(0, np.int64)


def live(codes: DataFrame, bits: list[np.ndarray], least: int) -> DataFrame:
    """``bucket``, ``live`` and ``n``: the hashes, ascending, of phrases of ``len(bits) + 1`` words that occur ``least`` times
    where both parts may be frequent; and how many these are."""
    sent, size = send(codes.sparkSession.sparkContext, bits), len(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, waiting = receive(sent), [], 0
        for block in _each(batches):
            held.append(_longer(block, *eligible(block, own), size)[1])
            waiting += len(held[-1])
            if waiting > TALLY:
                yield _tallied(held)
                held, waiting = [], 0
        if waiting:
            yield _tallied(held)

    def total(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, waiting = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for batch in groups:
            for i in range(batch.num_rows):
                hashes.append(unpack_sorted(batch.column("hashes")[i].as_py()))
                counts.append(unpack(batch.column("counts")[i].as_py(), "u").astype(np.int64))
                waiting += len(hashes[-1])
                if waiting > max(FLUSH, len(hashes[0])):
                    known, sums = _summed(hashes, counts)
                    hashes, counts, waiting = [known], [sums], 0
        known, sums = _summed(hashes, counts)
        found = known[sums >= least]
        some = [found] if len(found) else []
        yield pa.RecordBatch.from_arrays([
            pa.array([key[0].as_py()] * len(some), pa.int32()), pa.array([pack_sorted(f) for f in some], pa.binary()), pa.array([len(f) for f in some], pa.int64()),
        ], ["bucket", "live", "n"])

    tallies = codes.mapInArrow(run, "bucket int, hashes binary, counts binary")
    found = written(tallies.groupBy("bucket").applyInArrow(total, "bucket int, live binary, n long"), "phrase-live")
    sent.destroy()
    return found


def bitmap(found: DataFrame) -> np.ndarray:
    """The hashes of ``live`` by their highest bits."""
    size = _bits(found.agg(F.sum("n")).first()[0] or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for raw in batch.column("live"):
                flags = np.zeros(1 << (size - BUCKET_BITS), dtype=np.uint8)
                flags[(unpack_sorted(raw.as_py()) >> np.uint64(64 - _CUT_OFF - size)).astype(np.int64) % len(flags)] = 1
                packed.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(packed, pa.binary())], ["chunk", "bits"])

    return _joined(found.select("bucket", "live").mapInArrow(run, "chunk int, bits binary"), size)


def _joined(chunks: DataFrame, size: int) -> np.ndarray:
    """A bitmap of 2 ** size bits of parts of equal length."""
    out = np.zeros((1 << size) // 8, dtype=np.uint8)
    for chunk, bits in chunks.collect():
        out[chunk * len(bits) : (chunk + 1) * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def bitmap_of(names: DataFrame) -> np.ndarray:
    """The names (one column of longs) by their highest bits."""
    size = _bits(names.count())
    places = names.select(F.shiftrightunsigned(F.col(names.columns[0]), 64 - size).alias("p")).distinct()

    def run(group: pa.Table) -> pa.Table:
        p = group["p"].to_numpy()
        flags = np.zeros(_CHUNK, dtype=np.uint8)
        flags[p % _CHUNK] = 1
        return pa.table({"chunk": pa.array([int(p[0]) // _CHUNK]), "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    return _joined(places.withColumn("chunk", F.floor(F.col("p") / _CHUNK)).groupBy("chunk").applyInArrow(run, "chunk long, bits binary"), size)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        rows = batch.column(0).cast(pa.large_binary())
        ends = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset : rows.offset + len(rows) + 1] // 8
        codes = np.frombuffer(rows.buffers()[2], np.uint64, count=int(ends[-1])) if len(rows) and ends[-1] else np.zeros(0, np.uint64)
        at = 0
        while at < len(rows):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + STRETCH, side="right")) - 1)
            yield codes[ends[at] : ends[to]]
            at = to


class _Seen:
    """What a task has noted of the phrases of one length: a phrase is handed on once while it is held."""

    def __init__(self, size: int) -> None:
        self.size, self.held = size, []
        self.seen, self.told = np.zeros(0, np.uint64), np.zeros((0, size), np.uint64)

    def add(self, block: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        hashes, first, turn = np.unique(value, return_index=True, return_inverse=True)
        rows = block[at[:, None] + np.arange(self.size)]
        other = (rows != rows[first][turn]).any(axis=1)  # phrases of one hash that differ go by themselves
        place = np.searchsorted(self.seen, hashes)
        new = np.append(self.seen, 0)[place] != hashes if len(self.seen) else np.ones(len(hashes), dtype=bool)
        new |= place == len(self.seen)
        changed = ~new
        changed[changed] = (self.told[place[changed]] != rows[first[changed]]).any(axis=1)
        self.held.append((np.concatenate([hashes[new | changed], value[other]]), np.concatenate([rows[first[new | changed]], rows[other]])))
        if len(self.seen) > FLUSH // 4:
            self.seen, self.told = hashes, rows[first]
        else:
            self.seen, self.told = np.insert(self.seen, place[new], hashes[new]), np.insert(self.told, place[new], rows[first[new]], axis=0)

    def packed(self, more: int = -1) -> Iterator[pa.RecordBatch]:
        """What is held, if it is more than this, as a row for each bucket that has any; equal phrases share a bucket."""
        if sum(len(h) for h, _ in self.held) <= max(more, 0):
            return
        bucket = (np.concatenate([h for h, _ in self.held]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket, rows = bucket[order], np.concatenate([r for _, r in self.held])[order]
        first = W.runs(bucket)
        grams = pa.array([part.tobytes() for part in np.split(rows, first[1:])], pa.binary())
        self.held = []
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), self.size, np.int32)), pa.array(bucket[first]), grams], ["size", "bucket", "grams"])


def candidates(codes: DataFrame, bits: list[np.ndarray], found: DataFrame) -> DataFrame:
    """``gram``: each phrase of two to ``len(bits)`` words whose hash is live, once, 8 bytes a word.

    found: the live hashes of phrases of each ``size``, by ``bucket``. A task hands on a row for each bucket of a quarter of ``FLUSH`` phrases, for each size by itself.
    """
    sent = send(codes.sparkSession.sparkContext, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = receive(sent)
        noted = {size: _Seen(size) for size in range(2, len(own) + 1)}
        for block in _each(batches):
            for size, at, value in eligible_of_each(block, own):
                if size > 1:
                    noted[size].add(block, at, value)
                    yield from noted[size].packed(FLUSH // 4)
        for seen in noted.values():
            yield from seen.packed()

    noted = codes.mapInArrow(run, "size int, bucket int, grams binary")
    out = written(different(noted, found), "phrase-candidates")
    sent.destroy()
    return out


def different(noted: DataFrame, found: DataFrame) -> DataFrame:
    """``gram``: each phrase once, of rows ``size``, ``bucket`` and ``grams``, whose hash is in ``live`` of its ``size`` and ``bucket``."""

    def run(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = key[0].as_py()
        known, held, waiting, alive = np.zeros((0, size), np.uint64), [], 0, [np.zeros(0, np.uint64)]
        for batch in groups:
            alive += [unpack_sorted(raw.as_py()) for raw in batch.column(batch.schema.get_field_index("live")) if raw.is_valid]
            for raw in batch.column(batch.schema.get_field_index("grams")).drop_null():
                held.append(np.frombuffer(raw.as_py(), np.uint64).reshape(-1, size))
                waiting += len(held[-1])
                if waiting > max(FLUSH, len(known)):
                    known, held, waiting = _once(np.concatenate([known, *held])), [], 0
        known = _once(np.concatenate([known, *held]))
        known = known[np.isin(_hashes(known) >> np.uint64(_CUT_OFF), np.concatenate(alive))]
        yield pa.RecordBatch.from_arrays([_grams(known)], ["gram"])

    both = noted.withColumn("live", F.lit(None).cast("binary")).unionByName(found.withColumn("grams", F.lit(None).cast("binary")))
    return both.groupBy("size", "bucket").applyInArrow(run, "gram binary")


def _hashes(rows: np.ndarray) -> np.ndarray:
    """Of phrases as rows of names, the hashes that ``_longer`` gives."""
    value = rows[:, 0]
    for j in range(1, rows.shape[1]):
        value = W.mix(value * np.uint64(W._BASE) + rows[:, j])
    return value


def _once(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort(rows.T)]
    return rows[np.append(True, (rows[1:] != rows[:-1]).any(axis=1))] if len(rows) else rows


def _grams(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * 8
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows).tobytes())]).cast(pa.binary())


# Tries


class Trie:
    """A double array: the child of state ``s`` by byte ``c`` is ``base[s] + c`` if ``check`` there is ``s``.

    ``accept`` is the row of the phrase that ends in a state, or -1. ``words`` ascend; a word is the bytes of its rank.
    """

    def __init__(self, words: np.ndarray, base: np.ndarray, check: np.ndarray, accept: np.ndarray, longest: int) -> None:
        self.words, self.base, self.check, self.accept, self.longest = words, base, check, accept, longest
        self.width = _width(words)

    @staticmethod
    def build(grams: list[bytes]) -> Trie:
        """grams: different phrases; row i is the i-th."""
        n = len(grams)
        size = np.array([len(g) // 8 for g in grams])
        names = np.frombuffer(b"".join(grams), dtype=np.uint64)
        words, rank = np.unique(names, return_inverse=True)
        longest, width = int(size.max()), _width(words)
        table = np.full((n, longest), -1, dtype=np.int64)
        table[np.repeat(np.arange(n), size), np.arange(len(names)) - np.repeat(np.cumsum(size) - size, size)] = rank
        order = np.lexsort(table.T[::-1])  # a phrase comes before those that go on
        table, size = table[order], size[order]
        # Nodes level by level: equal prefixes stand together.
        node, levels, total = np.zeros(n, np.int64), [], 1
        for j in range(longest):
            live = np.flatnonzero(size > j)
            for b in reversed(range(width)):
                symbol, before = table[live, j] >> (8 * b) & 255, node[live]
                new = np.concatenate(([True], (before[1:] != before[:-1]) | (symbol[1:] != symbol[:-1])))
                first = np.flatnonzero(new)
                levels.append((before[first], symbol[first]))
                node[live] = total + np.cumsum(new) - 1
                total += len(first)
        parent = np.concatenate([[-1], *(p for p, _ in levels)])
        symbol = np.concatenate([[0], *(c for _, c in levels)])
        begin = np.searchsorted(parent, np.arange(total), side="left")  # parents ascend, so children stand together
        many = np.searchsorted(parent, np.arange(total), side="right") - begin
        base, where = _place(symbol, begin, many)
        slots = int(where.max()) + 257
        trie = Trie(words, np.zeros(slots, np.int32), np.full(slots, -1, np.int32), np.full(slots, -1, np.int32), longest)
        trie.base[where] = base  # without children 0: what stands there has no such parent
        trie.check[where[1:]] = where[parent[1:]]
        trie.accept[where[node]] = order
        return trie

    def walk(self, codes: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        """Rows of the phrases of 1, 2, ... words that begin at these places: all places advance together."""
        codes = np.concatenate([codes, np.zeros(self.longest, np.uint64)])
        state = np.zeros(len(at), dtype=np.int64)
        for j in range(self.longest):
            name = codes[at + j]
            rank = np.searchsorted(self.words, name)
            rank[rank == len(self.words)] = 0
            known = self.words[rank] == name
            at, state, rank = at[known], state[known], rank[known]
            for b in reversed(range(self.width)):
                child = self.base[state] + (rank >> (8 * b) & 255)
                good = self.check[child] == state
                at, state, rank = at[good], child[good], rank[good]
            rows = self.accept[state]
            yield rows[rows >= 0]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, words=self.words, base=self.base, check=self.check, accept=self.accept, longest=self.longest)
        return out.getvalue()

    @staticmethod
    def from_bytes(raw: bytes) -> Trie:
        held = np.load(io.BytesIO(raw))
        return Trie(held["words"], held["base"], held["check"], held["accept"], int(held["longest"]))


def _width(words: np.ndarray) -> int:
    """Bytes of a word's rank."""
    return max(1, (max(len(words) - 1, 1).bit_length() + 7) // 8)


def _place(symbol: np.ndarray, begin: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A base for each node with children and a slot for each node, so that no two nodes share a slot.

    Nodes with several children come first, those with most of them before others, each at the first base of a moving window that fits.
    Only children take the free slots that are left. Slots below 256 hold nothing but the root, so no base is negative.
    """
    n = len(symbol)
    used = np.zeros(2 * n + 1024, dtype=bool)
    used[:256] = True
    base, where = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    window, at = np.arange(128), 256
    order = np.argsort(-many, kind="stable")
    for node in order[: np.count_nonzero(many > 1)].tolist():
        children = slice(begin[node], begin[node] + many[node])
        own = symbol[children]
        while True:
            if at + 640 > len(used):
                used = np.concatenate([used, np.zeros(len(used), dtype=bool)])
            free = ~used[(at + window)[:, None] + own].any(axis=1)
            fits = int(free.argmax())
            if free[fits]:
                break
            at += len(window)
        base[node] = at + fits
        where[children] = base[node] + own
        used[base[node] + own] = True
    single = np.flatnonzero(many == 1)
    if len(single):
        used = np.concatenate([used, np.zeros(len(single), dtype=bool)])
        slots = np.flatnonzero(~used)[: len(single)]
        where[begin[single]] = slots
        base[single] = slots - symbol[begin[single]]
    return base, where


def tries(grams: DataFrame, per_trie: int = PER_TRIE) -> tuple[DataFrame, int]:
    """``shard``, ``row``, ``gram`` of each candidate and, at row -1, the ``trie`` of its shard; and how many shards."""
    shards = -(-grams.count() // per_trie)

    def run(key: tuple, group: pa.Table) -> pa.Table:
        rows = group["gram"].to_pylist()
        m = len(rows) + 1
        return pa.table({
            "shard": pa.array(np.full(m, key[0].as_py()), pa.int32()), "row": pa.array(np.arange(-1, m - 1), pa.int64()),
            "gram": pa.array([None, *rows], pa.binary()),
            "trie": pa.concat_arrays([pa.array([Trie.build(rows).to_bytes()], pa.binary()), pa.nulls(m - 1, pa.binary())]),
        })

    dealt = grams.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(max(shards, 1))).cast("int"))
    return written(dealt.groupBy("shard").applyInArrow(run, "shard int, row long, gram binary, trie binary"), "phrase-tries"), shards


def counted(codes: DataFrame, bits: list[np.ndarray], built: DataFrame, shards: int, least: int) -> DataFrame:
    """``shard``, ``row`` and ``f``, the occurrences of each candidate that has ``least``: a pass and a stored table for each shard."""
    spark = codes.sparkSession
    path, filters = new_workspace(spark, "phrase-counts"), send(spark.sparkContext, bits)
    for shard in range(shards):
        trie = bytes(built.where((F.col("shard") == shard) & (F.col("row") == -1)).select("trie").first()[0])
        sent = send(spark.sparkContext, Trie.from_bytes(trie))
        counted_by(codes, filters, sent, least).write.parquet(f"{path}/shard={shard}")
        sent.destroy()
    filters.destroy()
    return spark.read.schema("row long, f long, shard int").parquet(path)


def counted_by(codes: DataFrame, filters: Broadcast, sent: Broadcast, least: int) -> DataFrame:
    """``row`` and ``f`` of the phrases of a trie that occur ``least`` times.

    filters: bitmaps of one and two words; walks begin only where these allow a phrase to begin. Counts travel as arrays, a
    chunk of accepting states at a time, and are summed chunk by chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known, counts = receive(sent), receive(filters), np.zeros(0, np.int64)
        for block in _each(batches):
            for rows in own.walk(block, eligible(block, known)[0]):
                some = np.bincount(rows, minlength=len(counts))
                some[: len(counts)] += counts
                counts = some
        for at in range(0, len(counts), _CHUNK):
            part = counts[at : at + _CHUNK]
            if part.any():
                packed = zstandard.compress(part.astype("<i8").tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([at // _CHUNK], pa.int64()), pa.array([packed], pa.binary())], ["chunk", "counts"])

    def total(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(_CHUNK, dtype=np.int64)
        for batch in groups:
            for raw in batch.column(1):
                part = np.frombuffer(zstandard.decompress(raw.as_py()), "<i8")
                sums[: len(part)] += part
        found = np.flatnonzero(sums >= least)
        yield pa.RecordBatch.from_arrays([pa.array(found + key[0].as_py() * _CHUNK), pa.array(sums[found])], ["row", "f"])

    return codes.mapInArrow(run, "chunk long, counts binary").groupBy("chunk").applyInArrow(total, "row long, f long")


# Frequent phrases and their scores


def _stored(frame: DataFrame, label: str) -> DataFrame:
    """Like ``written``, in row groups of 8 MB: tasks that read them get small, even parts."""
    path = new_workspace(frame.sparkSession, label)
    frame.write.option("parquet.block.size", 8 << 20).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def frequent(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, per_trie: int = PER_TRIE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``gram`` (8 bytes a word), ``size`` and ``f`` of all phrases of up to ``longest`` words that occur ``least`` times;
    ``key`` (a word's name as bytes), ``lang`` and ``word`` of all words that do; and ``n``, all words of each ``lang``."""
    spark = docs.sparkSession
    for seed in range(64):
        encoded = _stored(encode(docs, seed), "phrase-words")
        rows = encoded.where(F.col("name").isNotNull())
        other = F.xxhash64("lang", "word")  # two words of one name differ in this
        words = written(rows.groupBy("name").agg(F.sum("n").alias("n"), F.min(other).alias("a"), F.max(other).alias("b")), "phrase-vocabulary")
        if words.where("a <> b").isEmpty():
            break
    else:
        raise ValueError("words share a name with every seed")
    totals = rows.groupBy("lang").agg(F.sum("n").alias("n"))
    codes = encoded.where(F.col("codes").isNotNull()).select("codes")
    common = words.where(F.col("n") >= least)
    names = rows.select("name", "lang", "word").distinct().join(common.select("name"), "name", "left_semi")
    names = names.select(_little_endian("name").alias("key"), "lang", "word")
    singles = common.select(_little_endian("name").alias("gram"), F.lit(1).alias("size"), F.col("n").alias("f"))
    bits, found = [bitmap_of(common.select("name"))], []
    for size in range(2, longest + 1):
        alive = live(codes, bits, least)
        bits.append(bitmap(alive))
        if not bits[-1].any():
            break
        found.append(alive.select(F.lit(size).alias("size"), "bucket", "live"))
    if not found:
        return singles, names, totals
    built, shards = tries(candidates(codes, bits[: len(found) + 1], reduce(DataFrame.unionByName, found)), per_trie)
    if not shards:
        return singles, names, totals
    counts = counted(codes, bits[:2], built, shards, least)
    kept = built.select("shard", "row", "gram").join(counts, ["shard", "row"])
    kept = written(kept.select("gram", (F.length("gram") / 8).cast("int").alias("size"), "f"), "phrase-frequent")
    return singles.unionByName(kept), written(names, "phrase-names"), totals


def _little_endian(name: str):
    """A long as its 8 bytes, lowest first."""
    digits = F.lpad(F.hex(F.col(name)), 16, "0")
    return F.unhex(F.concat(*(F.substring(digits, 15 - 2 * i, 2) for i in range(8))))


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = 2000, closed: int = 100, per_trie: int = PER_TRIE) -> DataFrame:
    """Each language's ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    A phrase of f occurrences goes if a longer frequent one that holds it has ``closed`` hundredths of f.
    """
    grams, names, totals = frequent(docs, longest, least, per_trie)
    f = grams.select("gram", "f")
    own = grams.where("size > 1").select("gram", "size", F.col("f").alias("a"))

    # The words of each phrase, and its language.
    placed = own.select("gram", F.explode(F.expr("sequence(0, size - 1)")).alias("at")).select("gram", "at", F.expr("substring(gram, 8 * at + 1, 8)").alias("key"))
    spelt = placed.join(names, "key").groupBy("gram").agg(
        F.first("lang").alias("lang"), F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"])).alias("phrase")
    )

    # Longer phrases that occur (nearly) as often.
    within = grams.where("size > 2").select(
        F.explode(F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(0, size - m), i -> substring(gram, 8 * i + 1, 8 * m))))")).alias("gram"),
        F.col("f").alias("longer"),
    ).groupBy("gram").agg(F.max("longer").alias("longer"))
    open_ = own.join(within, "gram", "left").where(F.coalesce(100 * F.col("longer") < closed * F.col("a"), F.lit(True))).select("gram", "size", "a")

    # All cuts of a phrase.
    cuts = open_.select("gram", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("k"), "size").select(
        "gram", "a", "k", F.expr("substring(gram, 1, 8 * k)").alias("left"), F.expr("substring(gram, 8 * k + 1, 8 * (size - k))").alias("right")
    )
    cuts = cuts.join(f.select(F.col("gram").alias("left"), F.col("f").alias("l")), "left").join(f.select(F.col("gram").alias("right"), F.col("f").alias("r")), "right")
    cuts = cuts.join(spelt, "gram").join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("above", wide("a") * wide("n")).withColumn("below", wide("l") * wide("r"))
    # 1000 a n may pass 38 digits: whole part and remainder are multiplied apart.
    score = F.expr("1000 * (above div below) + (1000 * (above % below)) div below")
    scored = cuts.withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rows = written(best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), "phrase-scores")

    # The first of each slice, then the first of all: no task sorts a whole language.
    slices = max(1, rows.count() // 100_000)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(slices))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
