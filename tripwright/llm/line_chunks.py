"""Removal of repeated passages, found as content-defined chunks of lines and as windows of lines.

A text is cut into chunks after every line at which a rolling hash over the hashes of the last
``WINDOW`` lines is 0 modulo ``PERIOD``, so the same lines give the same cuts wherever they stand. A line of
``LONG`` words or more is a passage by itself and a chunk of its own. Chunks of two or more lines, and
those long lines, that occur more than once in the corpus are removed everywhere but at their first
place (smallest doc_id, then position), after their bytes have been compared: equal hashes with
different bytes stay. All other lines stay as they are.

Where chunks are cut depends on the lines around a passage. With ``whole``, passages of ``LONG`` words go whatever
stands around them: a line also goes if it lies in consecutive lines of ``LONG`` words or more whose bytes occur at
an earlier place, one that ends before they begin. It is enough to compare, for each line, the fewest lines
of ``LONG`` words that begin or end with it: those within a passage cover it.

What is repeated grows with the corpus, so texts meet it in joins by row, in the same plan at any size.
Hashes travel first; texts are only fetched for chunks whose hash occurs again. Sums and minima per
hash are combined before they are shuffled, so a passage in a third of all texts is one row a task.

Defined cases: null text stays null and empty text empty; a null id comes last in the order; rows equal
in id and text count as one row and get the same result; a text may lose all its lines and is then
empty; columns of other names are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripwright.llm import words as W
from tripwright.llm.tables import written

WINDOW = 2
PERIOD = 3
LONG = 50
MOST_LINES = 64


def chunks(texts: pa.Array) -> dict[str, np.ndarray]:
    """All chunks of the texts: ``text``, ``number`` in it, ``begin`` and ``end`` (bytes within the text, without
    the last line's end), ``lines``, ``words``, ``hash``."""
    w = W.words(texts)
    data, offsets = w.data, w.offsets
    text, start, stop = W.lines(data, offsets)
    last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
    n_words = np.searchsorted(w.start, stop) - np.searchsorted(w.start, start)
    hashes = W.span_hashes(data, start, stop)
    first = np.append(True, text[1:] != text[:-1]) if len(text) else np.zeros(0, bool)
    begin_of_text = np.maximum.accumulate(np.where(first, np.arange(len(text)), 0))
    position = np.arange(len(text)) - begin_of_text
    rolling = hashes.copy()
    for k in range(1, WINDOW):
        before = np.flatnonzero(position >= k)
        rolling[before] = rolling[before] + hashes[before - k] * np.uint64(W._BASE) * np.uint64(k)
    cut = (W.mix(rolling) % np.uint64(PERIOD) == 0) | last
    long = n_words >= LONG
    cut |= long
    cut[:-1] |= long[1:]
    # Lines count from the last cut, so that the same lines after it are cut alike wherever they stand.
    since = np.arange(len(text)) - np.maximum.accumulate(np.where(np.append(True, cut[:-1])[: len(text)], np.arange(len(text)), 0))
    cut |= since % MOST_LINES == MOST_LINES - 1
    final = np.flatnonzero(cut)
    initial = np.append(0, final[:-1] + 1) if len(final) else final
    begin, end, of = start[initial], stop[final], text[initial]
    head = np.append(True, of[1:] != of[:-1]) if len(of) else np.zeros(0, bool)
    number = np.arange(len(of)) - np.maximum.accumulate(np.where(head, np.arange(len(of)), 0))
    sums = np.append(0, np.cumsum(n_words))
    return {
        "text": of, "number": number, "begin": begin - offsets[of], "end": end - offsets[of],
        "lines": final - initial + 1, "words": sums[final + 1] - sums[initial], "hash": W.span_hashes(data, begin, end).view(np.int64),
    }


def _is_passage(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["words"] > 0) & ((c["lines"] > 1) | (c["words"] >= LONG))


def spans(texts: pa.Array, whole: bool) -> dict[str, np.ndarray]:
    """The passages that are compared: ``text``, ``first`` and ``last`` line in it, ``hash``; in order of the text."""
    c = chunks(texts)
    at = _is_passage(c)
    ends = np.cumsum(c["lines"])
    first, last = (ends - c["lines"])[at], (ends - 1)[at]
    w = W.words(texts)
    text, start, stop = W.lines(w.data, w.offsets)
    if whole:
        every = np.arange(len(text))
        sums = np.append(np.searchsorted(w.start, start), len(w.start))
        to = np.searchsorted(sums, sums[:-1] + LONG, side="left") - 1
        begins = np.flatnonzero(to < len(text))
        begins = begins[text[to[begins]] == text[begins]]
        since = np.searchsorted(sums, sums[1:] - LONG, side="right") - 1
        stops = np.flatnonzero(since >= 0)
        stops = stops[text[since[stops]] == text[stops]]
        pairs = np.stack([np.concatenate([first, every[begins], since[stops]]), np.concatenate([last, to[begins], every[stops]])], axis=1)
        first, last = np.unique(pairs, axis=0).T
    of = text[first]
    begin_of_text = np.searchsorted(text, of)
    return {"text": of, "first": first - begin_of_text, "last": last - begin_of_text, "hash": W.span_hashes(w.data, start[first], stop[last]).view(np.int64)}


def _places(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            c = spans(W.column(block, "text"), whole)
            of = pa.array(c["text"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c["hash"]), W.column(block, "doc_id").take(of), W.column(block, "row").take(of), pa.array(c["first"] << 32 | c["last"])],
                ["hash", "doc_id", "row", "span"],
            )

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted spans."""
    for block in W.blocks(batches, "text"):
        texts = W.column(block, "text")
        data, offsets = W.text_bytes(texts)
        text, start, stop = W.lines(data, offsets)
        wanted = W.column(block, "spans")
        of = np.repeat(np.arange(len(texts)), wanted.value_lengths().to_numpy(zero_copy_only=False))
        span = wanted.flatten().to_numpy(zero_copy_only=False)
        line = np.searchsorted(text, of)
        begin, end = start[line + (span >> 32)], stop[line + (span & 0xFFFFFFFF)]
        hashes = W.span_hashes(data, begin, end).view(np.int64)
        # Spans overlap, so their bytes are handed on in parts.
        parts = np.append(W.runs(np.cumsum(end - begin) // W.BLOCK_BYTES), len(of))
        for a, b in zip(parts[:-1].tolist(), parts[1:].tolist()):
            body = pa.array([data[x:y].tobytes() for x, y in zip(begin[a:b].tolist(), end[a:b].tolist())], pa.binary())
            rows = pa.array(of[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[a:b]), body, W.column(block, "doc_id").take(rows), W.column(block, "row").take(rows), pa.array(span[a:b])],
                ["hash", "body", "doc_id", "row", "span"],
            )


def repeated(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``row`` and ``spans``: the lines to remove from each row that loses any, as first << 32 | last. ``docs``: row, doc_id, text."""
    places = written(docs.mapInArrow(_places(whole), "hash long, doc_id long, row long, span long").distinct(), "line-places")
    again = places.groupBy("hash").count().where("count > 1").select("hash")
    wanted = places.join(again, "hash").groupBy("row").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    texts = written(docs.dropDuplicates(["row"]).join(wanted.hint("merge"), "row").mapInArrow(_texts, "hash long, body binary, doc_id long, row long, span long"), "line-bodies")
    # Minima combine before the shuffle; the first place is the one of the smallest id, null last.
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row", "span")
    kept = texts.groupBy("hash", "body").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Lines that repeat within the first place stay with it.
    inside = (F.col("row") == F.col("kept.row")) & (F.shiftright("span", 32) <= F.col("kept.span").bitwiseAND(F.lit(0xFFFFFFFF)))
    gone = texts.join(kept.drop("n"), ["hash", "body"]).where(~inside)
    return written(gone.groupBy("row").agg(F.collect_list("span").alias("spans")), "line-removed")


def remove(docs: DataFrame, whole: bool = False) -> DataFrame:
    """All columns of the documents with the repeated passages taken out of ``text``, and ``n_lines_removed``.

    Passages are the repeated chunks; with ``whole`` also all other repeated lines of ``LONG`` words together.
    """
    docs = docs.drop("n_lines_removed")
    names = docs.columns
    row = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))
    own = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").rlike("[\\x20\\x09-\\x0D]"))
    lost = repeated(own, whole)
    held = F.struct(*[F.col(f"`{n}`") for n in names]).alias("held")
    lost = lost.select(F.col("row").alias("_row"), F.col("spans").alias("_spans"))
    joined = docs.select(row.alias("_row"), held).join(lost.hint("merge"), "_row", "left")
    clean = joined.select("held.*", "_spans")
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            texts = block.column(text_at)
            lost = block.column(len(names)).to_pylist()
            body = texts.to_pylist()
            removed = np.zeros(len(texts), dtype=np.int64)
            for i, gone in enumerate(lost):
                if gone:
                    lines = body[i].split("\n")
                    stay = np.ones(len(lines), dtype=bool)
                    for span in gone:
                        stay[span >> 32 : (span & 0xFFFFFFFF) + 1] = False
                    body[i] = "\n".join(lines[k] for k in np.flatnonzero(stay))
                    removed[i] = len(lines) - int(stay.sum())
            columns = [*block.columns[: len(names)], pa.array(removed)]
            columns[text_at] = pa.array(body, pa.string())
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_lines_removed"])

    return clean.mapInArrow(run, StructType([*docs.schema.fields, StructField("n_lines_removed", LongType())]))
