"""Token ids as files: one zstandard frame per document, all with one shared dictionary.

A dictionary is trained on the serialized id arrays of a bounded sample of documents
(``SAMPLE_DOCUMENTS``, the first ``SAMPLE_IDS`` ids of each, chosen by a hash of the id). Every document is
compressed by itself with it, so one document can be read without its neighbours. The files are Parquet
in ascending doc_id order; a row is a *segment* of about ``SEGMENT_BYTES``: the frames one after the
other (``payload``), the index (``doc_id``, ``offset``, ``length``, ``n_ids`` of each document) and the hash of
the dictionary, which lies beside the segments. A reader refuses a dictionary with another hash.

Defined cases: a null or empty text has just the end id; null ids come first; rows of one id are kept
all, ordered by text; an empty table gives no segments.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwright.llm import shared
from tripwright.llm import words as W
from tripwright.session import new_workspace

SAMPLE_DOCUMENTS = 400
SAMPLE_IDS = 4096
DICTIONARY_BYTES = 64 << 10
SEGMENT_BYTES = 2 << 20
END_ID = 0

#: Unicode white space beyond ASCII in UTF-8, the only characters at which the vocabulary's pattern may cut.
_WIDE_SPACES = [c.encode() for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))]
_LEADS = np.zeros(256, dtype=bool)
_LEADS[[c[0] for c in _WIDE_SPACES]] = True
_COMPARED = 1 << 20

SEGMENTS = (
    "part int, segment int, dictionary string, doc_id array<long>, offset array<long>, "
    "length array<long>, n_ids array<long>, n_total long, payload binary"
)


class Encoders:
    """Sent to tasks by broadcast, so a worker opens the tokenizer once and keeps what it has learnt."""

    def __init__(self, tokenizer_file: str) -> None:
        self.file, self.encoder = tokenizer_file, None

    def get(self) -> ChunkEncoder:
        if self.encoder is None:
            self.encoder = ChunkEncoder(self.file)
        return self.encoder


def _white(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    white = W._WHITE[data]
    at = np.flatnonzero(_LEADS[data[:-1]])
    for c in _WIDE_SPACES:
        here = at[at + len(c) <= len(data)]
        for k, byte in enumerate(c):
            here = here[data[here + k] == byte]
        for k in range(len(c)):
            white[here + k] = True
    return white


def _span_index(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of all spans' elements, span after span."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _same(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size: np.ndarray) -> bool:
    """Whether all spans of ``a`` equal those of ``b``; some bytes at a time."""
    ends = np.cumsum(size)
    done = 0
    while done < len(size):
        to = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + _COMPARED)))
        own = slice(done, to)
        if not np.array_equal(a[_span_index(at[own], size[own])], b[_span_index(bt[own], size[own])]):
            return False
        done = to
    return True


class _Known:
    """Chunks, found by the hash of their bytes, with these bytes and their ids."""

    def __init__(self) -> None:
        self.hash, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.bytes, self.begin = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.hash)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entries of ascending hashes; -1 where there is none."""
        if not len(self):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self) - 1)
        return np.where(self.hash[at] == hashes, self.entry[at], -1)

    def add(self, hashes: np.ndarray, raw: np.ndarray, size: np.ndarray, ids: np.ndarray, n_ids: np.ndarray) -> None:
        """New chunks, one after the other in ``raw`` and ``ids``; their hashes are not yet known."""
        order = np.argsort(hashes)
        at = np.searchsorted(self.hash, hashes[order])
        self.entry = np.insert(self.entry, at, len(self) + order)
        self.hash = np.insert(self.hash, at, hashes[order])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(size)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n_ids)])
        self.bytes, self.ids = np.concatenate([self.bytes, raw]), np.concatenate([self.ids, ids])


class ChunkEncoder:
    """Encodes texts by their chunks; the tokenizer sees each distinct chunk once, as long as it is kept.

    A chunk is white space and the visible characters after it: no token begins with a visible character and goes on
    with white space. Chunks are cut and looked up on bytes, with numpy; a hash finds a chunk and its bytes confirm it.
    """

    def __init__(self, tokenizer_file: str, most: int = 1_000_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self.most = most
        self.known, self.older = _Known(), _Known()

    def _learn(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, hashes: np.ndarray, easy: np.ndarray) -> None:
        # What an older generation knows comes back from it.
        old = self.older.find(hashes)
        back = old >= 0
        if back.any():
            e = old[back]
            begin, own, first = self.older.begin[e], self.older.begin[e + 1] - self.older.begin[e], self.older.first[e]
            n = self.older.first[e + 1] - first
            self.known.add(hashes[back], self.older.bytes[_span_index(begin, own)], own, self.older.ids[_span_index(first, n)], n)
        easy = easy & ~back
        hard = ~easy & ~back
        if easy.any():
            # Easy chunks are encoded many at once, a line end between them: it always is a token of its own.
            own = size[easy]
            joined = np.full(int(own.sum()) + len(own), 10, dtype=np.uint8)
            raw = data[_span_index(start[easy], own)]
            ends = np.cumsum(own + 1)
            joined[_span_index(ends - own - 1, own)] = raw
            cuts = np.concatenate(([0], ends[49:-1:50], ends[-1:]))
            groups = [joined[a : b - 1].tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:])]
            lists = [e.ids + [self.line] for e in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(lists), np.uint32, sum(map(len, lists)))
            cut = np.flatnonzero(ids == self.line)
            self.known.add(hashes[easy], raw, own, np.delete(ids, cut), np.diff(cut, prepend=-1) - 1)
        if hard.any():
            own = size[hard]
            raw = data[_span_index(start[hard], own)]
            texts = [data[a : a + n].tobytes().decode() for a, n in zip(start[hard].tolist(), own.tolist())]
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            n = np.array([len(x) for x in lists], dtype=np.int64)
            self.known.add(hashes[hard], raw, own, np.fromiter(chain.from_iterable(lists), np.uint32, int(n.sum())), n)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        data, offsets = W.text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        white = _white(data)
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[1:-1] = white[1:] & ~white[:-1]
        begins[offsets] = True
        start = np.flatnonzero(begins[:-1])
        size = np.diff(start, append=len(data))
        hashes, example, which = np.unique(W.span_hashes(data, start, start + size), return_index=True, return_inverse=True)
        if len(self.known) > self.most:
            self.known, self.older = _Known(), self.known
        entry = self.known.find(hashes)
        if (new := np.flatnonzero(entry < 0)).size:
            at, own = start[example[new]], size[example[new]]
            visible = np.where(data[at] == 32, np.minimum(at + 1, len(data) - 1), at)
            plain = ~white[visible] & (visible < at + own)
            special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
            plain &= ~np.isin(example[new], np.searchsorted(start, special, side="right") - 1)
            self._learn(data, at, own, hashes[new], plain if self.line is not None else np.zeros(len(new), bool))
            entry = self.known.find(hashes)
        entry = entry[which]
        known = self.known
        if not (np.array_equal(size, known.begin[entry + 1] - known.begin[entry]) and _same(data, start, known.bytes, known.begin[entry], size)):
            # Chunks of one hash: the texts are encoded without looking chunks up.
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts.fill_null("").to_pylist(), add_special_tokens=False)]
            n = [len(x) for x in lists]
            return np.fromiter(chain.from_iterable(lists), np.uint32, sum(n)), np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
        first = known.first[entry]
        n = known.first[entry + 1] - first
        ends = np.concatenate(([0], np.cumsum(n)))
        return known.ids[_span_index(first, n)], ends[np.searchsorted(start, offsets)]


@dataclass(frozen=True)
class Dictionary:
    """A trained zstandard dictionary; ``key`` is the hash that files carry."""

    raw: bytes

    @property
    def key(self) -> str:
        return hashlib.sha256(self.raw).hexdigest()

    def data(self) -> zstandard.ZstdCompressionDict | None:
        return zstandard.ZstdCompressionDict(self.raw) if self.raw else None


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> Dictionary:
    """The dictionary of some serialized arrays; an empty one where they are too few to train on."""
    try:
        return Dictionary(zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes())
    except (zstandard.ZstdError, ValueError):
        return Dictionary(b"")


def _with_end(encoder: ChunkEncoder, texts: pa.Array) -> list[np.ndarray]:
    ids, begin = encoder.encode(texts)
    return [np.append(ids[a:b], np.uint32(END_ID)) for a, b in zip(begin[:-1], begin[1:])]


def shared_dictionary(docs: DataFrame, tokenizer_file: str) -> Dictionary:
    """Trained in one task on the bounded sample that the module names."""
    n = docs.count()
    top = min((1 << 63) - 1, int((1 << 64) * min(1.0, SAMPLE_DOCUMENTS / max(n, 1))) - (1 << 63))
    key = F.xxhash64("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer_file)
        samples = []
        for block in W.blocks(batches, "text"):
            samples += [ids[:SAMPLE_IDS].astype("<u4").tobytes() for ids in _with_end(encoder, W.column(block, "text"))]
        yield pa.RecordBatch.from_arrays([pa.array([train_dictionary(sorted(samples)).raw], pa.binary())], ["raw"])

    sample = docs.where(key <= F.lit(top)).select("text").repartition(1)
    row = sample.mapInArrow(run, "raw binary").first()
    return Dictionary(bytes(row[0]) if row else b"")


def write(docs: DataFrame, tokenizer_file: str) -> str:
    """Writes the ids of all documents; returns the folder of ``segments`` and ``dictionary``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dictionary = shared_dictionary(docs, tokenizer_file)
    folder = new_workspace(spark, "token-files")
    spark.createDataFrame([(dictionary.key, dictionary.raw)], "dictionary string, raw binary").write.parquet(f"{folder}/dictionary")

    encoders = shared.send(spark.sparkContext, Encoders(tokenizer_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.receive(encoders).get()
        compress = zstandard.ZstdCompressor(level=3, dict_data=dictionary.data()).compress
        part, number = TaskContext.get().partitionId(), 0
        doc_id: list[int | None] = []
        frames: list[bytes] = []
        n_ids: list[int] = []

        def segment() -> pa.RecordBatch:
            length = np.array([len(f) for f in frames], dtype=np.int64)
            row = [part, number, dictionary.key, doc_id, np.cumsum(length) - length, length, n_ids, sum(n_ids), b"".join(frames)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _ARROW)], _NAMES)

        held = 0
        for block in W.blocks(batches, "text", 2 << 20):
            for i, ids in zip(W.column(block, "doc_id").to_pylist(), _with_end(encoder, W.column(block, "text"))):
                frame = compress(ids.astype("<u4").tobytes())
                doc_id.append(i), frames.append(frame), n_ids.append(len(ids))
                held += len(frame)
                if held >= SEGMENT_BYTES:
                    yield segment()
                    doc_id, frames, n_ids, held, number = [], [], [], 0, number + 1
        if frames:
            yield segment()

    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SEGMENTS).write.parquet(f"{folder}/segments")
    return folder


_LONGS = pa.list_(pa.int64())
_NAMES = ["part", "segment", "dictionary", "doc_id", "offset", "length", "n_ids", "n_total", "payload"]
_ARROW = [pa.int32(), pa.int32(), pa.string(), _LONGS, _LONGS, _LONGS, _LONGS, pa.int64(), pa.binary()]


def segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(f"{folder}/segments")


def stored_dictionary(spark: SparkSession, folder: str) -> Dictionary:
    row = spark.read.schema("dictionary string, raw binary").parquet(f"{folder}/dictionary").first()
    found = Dictionary(bytes(row["raw"]))
    if found.key != row["dictionary"]:
        raise ValueError(f"the dictionary in {folder} is not the one its hash names")
    return found


def _frames(batches: Iterator[pa.RecordBatch], dictionary: Dictionary) -> Iterator[tuple[dict, int, np.ndarray]]:
    """Row, position and ids of each document of some segments."""
    decompress = zstandard.ZstdDecompressor(dict_data=dictionary.data()).decompress
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["dictionary"] != dictionary.key:
                raise ValueError("a segment was written with another dictionary")
            for k, (offset, length) in enumerate(zip(row["offset"], row["length"])):
                ids = np.frombuffer(decompress(row["payload"][offset : offset + length]), dtype="<u4")
                yield row, k, ids


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """Reads all files back: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of each document."""
    dictionary = stored_dictionary(spark, folder)
    all_segments = segments(spark, folder)
    # Sums per part go to the driver: as many numbers as there are files.
    parts = all_segments.groupBy("part").agg(F.sum("n_total").alias("n")).orderBy("part").collect()
    starts, before = [], 0
    for part, n in parts:
        starts.append((part, before))
        before += n
    first = spark.createDataFrame(starts, "part int, part_start long")
    earlier = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        all_segments.select("part", "segment", "n_total")
        .withColumn("in_part", F.coalesce(F.sum("n_total").over(earlier), F.lit(0)))
        .join(F.broadcast(first), "part")
        .select("part", "segment", (F.col("part_start") + F.col("in_part")).alias("start"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], _DIGEST_NAMES)

        for row, k, ids in _frames(batches, dictionary):
            before = sum(row["n_ids"][:k]) if k == 0 else before + row["n_ids"][k - 1]
            out.append((row["part"], row["segment"], row["doc_id"][k], before, len(ids), zlib.crc32(ids.tobytes())))
            if len(out) >= 20_000:
                yield batch()
                out.clear()
        if out:
            yield batch()

    read = all_segments.mapInArrow(run, "part int, segment int, doc_id long, before long, n_tokens long, ids_crc32 long")
    return read.join(placed, ["part", "segment"]).select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


_DIGEST_NAMES = ["part", "segment", "doc_id", "before", "n_tokens", "ids_crc32"]


def read_documents(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """``doc_id`` and ``ids`` of the documents whose ids ``wanted`` holds, by the offset index.

    Only the index is searched; of a segment only the wanted frames go on.
    """
    dictionary = stored_dictionary(spark, folder)
    index = segments(spark, folder).select(
        "part", "segment", F.explode(F.arrays_zip("doc_id", "offset", "length")).alias("at")
    ).select("part", "segment", "at.*")
    places = index.join(wanted.select(F.col("doc_id").cast("long")).distinct(), "doc_id", "left_semi")
    frames = segments(spark, folder).select("part", "segment", "dictionary", "payload").join(places, ["part", "segment"])
    cut = frames.select("doc_id", "dictionary", F.expr("substring(payload, cast(offset as int) + 1, cast(length as int))").alias("frame"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor(dict_data=dictionary.data()).decompress
        for batch in batches:
            if set(batch.column(1).to_pylist()) - {dictionary.key}:
                raise ValueError("a segment was written with another dictionary")
            ids = [np.frombuffer(decompress(f), dtype="<u4").astype(np.int64) for f in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, _LONGS)], ["doc_id", "ids"])

    return cut.mapInArrow(run, "doc_id long, ids array<long>")
