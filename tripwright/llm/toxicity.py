"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its byte n-grams (with end marks) and of itself, hashed into ``buckets`` rows of an
embedding table; its vector is the bag's mean. A window of ``WINDOW`` words is the mean of its words'
vectors (a word said again counts as none), a linear softmax gives its class, and a text is as toxic as its most toxic window, so a
long text does not thin out what it says in one place. Embeddings and softmax are learnt together by
Adam on the labels alone: first every window carries its text's label, then only those windows of a
toxic text that the model finds most toxic do. Misspellings share most n-grams with known words.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS`` per class, ``SAMPLE_WORDS``
words in all, chosen by a hash of the id) in one task; everything else runs on all rows.

Defined cases: a null or empty text is one window without words, so its score comes from the bias; rows
with a null id are scored but never learnt from; several labels of one id count as their largest;
without usable labels of both classes the score is the share of toxic labels, or 0.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tripwright.llm import words as W

WINDOW = 16
SAMPLE_ROWS = 2000
SAMPLE_WORDS = 2_000_000
BUCKETS = 1 << 16
SIZES = (3, 4, 5, 6)
DIM = 4
TELLING = 2.5
FALSE_ALARM = 3.0
#: What is worked on at once: text bytes of a block, and words and bytes of a slice of its different words.
BLOCK_BYTES = 1 << 20
SLICE_WORDS = 20_000
SLICE_BYTES = 1 << 18


def _marked(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words one after the other with end marks, and where each begins."""
    length = end - start
    to = np.concatenate(([0], np.cumsum(length + 2)))
    marked = np.empty(to[-1], dtype=np.uint8)
    marked[to[:-1]] = 2  # control bytes no word holds at these places
    marked[to[1:] - 1] = 3
    inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    marked[np.repeat(to[:-1] + 1, length) + inner] = data[np.repeat(start, length) + inner]
    return marked, to


def _grams(marked: np.ndarray, to: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams (n = 0: the whole words) of marked words, and how many each word has."""
    if n == 0:
        return (W.span_hashes(marked, to[:-1], to[1:]) % np.uint64(buckets)).astype(np.int32), np.ones(len(to) - 1, np.int64)
    many = np.maximum(np.diff(to) - n + 1, 0)
    at = np.repeat(to[:-1] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    return (W.span_hashes(marked, at, at + n) % np.uint64(buckets)).astype(np.int32), many


def _slices(start: np.ndarray, end: np.ndarray) -> Iterator[slice]:
    """Words in slices of ``SLICE_WORDS`` words and about ``SLICE_BYTES`` bytes at most, or one word."""
    sizes, at = np.cumsum(end - start), 0
    while at < len(start):
        used = sizes[at - 1] if at else 0
        to = min(at + SLICE_WORDS, max(at + 1, int(np.searchsorted(sizes, used + SLICE_BYTES, side="right"))))
        yield slice(at, to)
        at = to


def subwords(data: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, one word after the other, and where each word's begin."""
    parts, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for own in _slices(start, end):
        marked, to = _marked(data, start[own], end[own])
        grams = [_grams(marked, to, n, buckets) for n in (0, *SIZES)]
        size = sum(many for _, many in grams)
        out, at = np.empty(int(size.sum()), np.int32), np.cumsum(size) - size
        for bucket, many in grams:  # each n in turn behind the shorter ones of its word
            out[np.repeat(at - (np.cumsum(many) - many), many) + np.arange(len(bucket))] = bucket
            at = at + many
        parts.append(out), sizes.append(size)
    size = np.concatenate(sizes)
    return np.concatenate(parts), np.cumsum(size) - size


def _word_means(weight: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The mean weight of each word's n-grams, by slices of words and one n at a time."""
    out = np.zeros(len(start))
    for own in _slices(start, end):
        if own.stop == own.start + 1 and end[own.start] - start[own.start] > SLICE_BYTES:
            out[own] = _long_word_mean(weight, data[start[own.start] : end[own.start]])
            continue
        marked, to = _marked(data, start[own], end[own])
        total, n_grams = np.zeros(len(to) - 1), np.zeros(len(to) - 1, np.int64)
        for n in (0, *SIZES):
            bucket, many = _grams(marked, to, n, len(weight))
            total += np.bincount(np.repeat(np.arange(len(many)), many), weight[bucket], minlength=len(many))
            n_grams += many
        out[own] = total / n_grams
    return out


def _long_word_mean(weight: np.ndarray, word: np.ndarray) -> float:
    """The same for one word, by windows of it."""
    marked = np.concatenate(([2], word, [3])).astype(np.uint8)
    total = float(weight[int(W.span_hashes(marked, np.array([0]), np.array([len(marked)]))[0] % np.uint64(len(weight)))])
    n_grams = 1
    for n in SIZES:
        last = len(marked) - n + 1
        for at in range(0, last, SLICE_BYTES):
            begin = np.arange(min(SLICE_BYTES, last - at))
            total += float(weight[(W.span_hashes(marked[at : at + SLICE_BYTES + n], begin, begin + n) % np.uint64(len(weight))).astype(np.int32)].sum())
        n_grams += last
    return total / n_grams


@dataclass
class Bags:
    """Texts as windows of words: ``word`` of each token, ``window`` it is in, ``text`` of each window."""

    word: np.ndarray
    window: np.ndarray
    text: np.ndarray
    n_texts: int
    bucket: np.ndarray  # n-grams of the distinct words
    begin: np.ndarray


def _windows(texts: pa.Array) -> tuple[W.Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts; where each different word first stands; ``word``, ``window`` and ``text`` as in ``Bags``."""
    w = W.words(texts, lower=True)
    _, first, word = np.unique(w.hashes(), return_index=True, return_inverse=True)
    counts = w.counts()
    in_text = np.arange(len(w.doc)) - (np.cumsum(counts) - counts)[w.doc]
    per_text = np.maximum((counts + WINDOW - 1) // WINDOW, 1)  # an empty text has one empty window
    base = np.cumsum(per_text) - per_text
    # A window's distinct words: saying a word often is not more toxic than saying it.
    pairs = np.unique((base[w.doc] + in_text // WINDOW) * np.int64(len(first) + 1) + word)
    window, word = pairs // (len(first) + 1), pairs % (len(first) + 1)
    return w, first, word, window, np.repeat(np.arange(w.n_docs), per_text)


def bags(texts: pa.Array, buckets: int) -> Bags:
    w, first, word, window, text = _windows(texts)
    bucket, begin = subwords(w.data, w.start[first], w.end[first], buckets)
    return Bags(word, window, text, w.n_docs, bucket, begin)


class _Sum:
    """Sums rows ``source`` of a matrix into rows ``target`` of another, by a fixed list of pairs."""

    def __init__(self, target: np.ndarray, source: np.ndarray, n: int) -> None:
        order = np.argsort(target, kind="stable")
        self.target, self.source, self.n = target[order].astype(np.int32), source[order].astype(np.int32), n
        self.begin = W.runs(self.target)

    def turned(self, n: int) -> _Sum:
        return _Sum(self.source, self.target, n)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, rows.shape[1]), rows.dtype)
        if len(self.begin):
            out[self.target[self.begin]] = np.add.reduceat(rows[self.source], self.begin, axis=0)
        return out


@dataclass(frozen=True)
class Model:
    """``weight`` of each bucket and ``bias``: the embeddings times the difference of the two classes'
    softmax rows. Averages are linear, so scoring needs no more than this product."""

    weight: np.ndarray
    bias: float
    embedding: np.ndarray | None = None
    softmax: np.ndarray | None = None

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, weight=self.weight, bias=self.bias)
        return out.getvalue()

    @staticmethod
    def from_bytes(raw: bytes) -> Model:
        held = np.load(io.BytesIO(raw))
        return Model(held["weight"], float(held["bias"]))

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(texts), -500, 500)))

    def odds(self, texts: pa.Array) -> np.ndarray:
        """Log odds of each text's most toxic window; nothing is kept of an n-gram but its word's sum."""
        w, first, word, window, text = _windows(texts)
        per_word = _word_means(self.weight, w.data, w.start[first], w.end[first])
        odds = np.bincount(window, per_word[word], minlength=len(text)) / WINDOW + self.bias
        worst = np.full(w.n_docs, -np.inf)
        np.maximum.at(worst, text, odds)
        return worst


def _telling(b: Bags, toxic: np.ndarray) -> np.ndarray:
    """For each window the largest log ratio of a word's share of toxic texts to its share of clean ones."""
    pairs = np.unique(b.word * np.int64(b.n_texts) + b.text[b.window])
    word, text = pairs // b.n_texts, pairs % b.n_texts
    share = [(np.bincount(word[toxic[text] == c], minlength=len(b.begin)) + 0.5) / ((toxic == c).sum() + 1) for c in (0, 1)]
    best = np.full(len(b.text), -np.inf)
    np.maximum.at(best, b.window, np.log(share[1] / share[0])[b.word])
    return best


def _training_part(texts: pa.Array, toxic: np.ndarray, buckets: int, max_windows: int) -> tuple[Bags, np.ndarray]:
    """The windows to learn from, at most ``max_windows`` of each class, and their labels.

    Most windows of a toxic text say nothing toxic. To begin with, those count that hold a word
    telling the classes apart, and the most telling one of each text.
    """
    w, first, word, window, text = _windows(texts)
    b = Bags(word, window, text, w.n_docs, np.zeros(0, np.int32), first)
    label = toxic[b.text]
    telling = _telling(b, toxic)
    best = np.full(b.n_texts, -np.inf)
    np.maximum.at(best, b.text, telling)
    use = np.zeros(len(b.text), dtype=bool)
    for own in (np.flatnonzero(label == 0), np.flatnonzero((label == 1) & ((telling >= TELLING) | (telling == best[b.text])))):
        use[own[:: max(1, -(-len(own) // max_windows))]] = True
    token = use[b.window]
    kept = np.zeros(len(first), dtype=bool)
    kept[b.word[token]] = True
    own = first[kept]  # n-grams of these words only
    bucket, begin = subwords(w.data, w.start[own], w.end[own], buckets)
    return Bags((np.cumsum(kept) - 1)[b.word[token]], (np.cumsum(use) - 1)[b.window[token]], b.text[use], b.n_texts, bucket, begin), label[use]


def train(texts: pa.Array, toxic: np.ndarray, buckets: int = BUCKETS, dim: int = DIM, rounds: int = 2, steps: int = 40, rate: float = 0.15, decay: float = 1e-7, seed: int = 7, max_windows: int = 12_000) -> Model:
    """Embeddings and softmax learnt jointly from texts with labels 0 and 1.

    Every fourth text is held back: on these the bias is set so that 0.5 parts the classes, where a
    clean text called toxic weighs ``FALSE_ALARM`` times a toxic one missed.
    """
    toxic = np.asarray(toxic, dtype=np.float64)
    aside = np.arange(len(toxic)) % 4 == 3
    if len(set(toxic[~aside])) < 2:
        share = float(toxic.mean()) if len(toxic) else 0.0
        return Model(np.zeros(1), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    b, target = _training_part(texts.filter(pa.array(~aside)), toxic[~aside], buckets, max_windows)
    used, bucket = np.unique(b.bucket, return_inverse=True)
    size = np.diff(np.append(b.begin, len(bucket))).astype(np.float32)[:, None]
    n_windows, n_words = len(b.text), len(b.begin)
    grams_to_words = _Sum(np.repeat(np.arange(n_words), size[:, 0].astype(int)), bucket, n_words)
    words_to_grams = grams_to_words.turned(len(used))
    words_to_windows = _Sum(b.window, b.word, n_windows)
    windows_to_words = words_to_windows.turned(n_words)
    random = np.random.default_rng(seed)
    embedding = random.normal(0, 0.1, (len(used), dim)).astype(np.float32)
    softmax = random.normal(0, 0.1, (2, dim)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    parts = (embedding, softmax, bias)
    moments = [np.zeros_like(x) for x in parts for _ in range(2)]
    weight = np.ones(n_windows)
    step = 0
    for _ in range(rounds):
        # Both classes weigh the same.
        share = [max(weight[target == c].sum(), 1e-9) for c in (0, 1)]
        importance = weight / np.where(target > 0, share[1], share[0]) / 2
        for _ in range(steps):
            step += 1
            mean = words_to_windows(grams_to_words(embedding) / size) / np.float32(WINDOW)
            odds = mean @ (softmax[1] - softmax[0]) + bias[1] - bias[0]
            error = ((1 / (1 + np.exp(-np.clip(odds, -60, 60))) - target) * importance).astype(np.float32)
            both = np.stack([-error, error], axis=1)
            to_words = windows_to_words(both @ softmax / np.float32(WINDOW)) / size
            grads = (words_to_grams(to_words) + decay * embedding, both.T @ mean + decay * softmax, both.sum(0))
            for i, (x, g) in enumerate(zip(parts, grads)):
                m, v = moments[2 * i], moments[2 * i + 1]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-12)
        # From now on a toxic text speaks by its worst window and by those that are surely toxic.
        worst = np.full(b.n_texts, -np.inf)
        np.maximum.at(worst, b.text, odds)
        chosen = (odds >= worst[b.text]) | (odds > np.log(9))
        weight = np.where(target > 0, chosen.astype(float), 1.0)
    table = np.zeros((buckets, dim))
    table[used] = embedding
    model = Model(table @ (softmax[1] - softmax[0]), float(bias[1] - bias[0]), table, softmax)
    held = pa.RecordBatch.from_arrays([texts.filter(pa.array(aside))], ["text"])
    score = np.concatenate([model.odds(block.column(0)) for block in W.blocks(iter([held]), "text", BLOCK_BYTES)])
    return Model(model.weight, model.bias - _cut(score, toxic[aside]), table, softmax)


def _cut(score: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the gap between two scores at which errors cost least; 0 without both classes."""
    if len(set(toxic)) < 2:
        return 0.0
    order = np.argsort(score)
    score, toxic = score[order], toxic[order]
    missed = np.concatenate(([0], np.cumsum(toxic)))
    alarms = np.concatenate((np.cumsum((1 - toxic)[::-1])[::-1], [0]))
    cost = missed + FALSE_ALARM * alarms
    best = np.flatnonzero(cost == cost.min())
    edges = np.concatenate(([score[0] - 2], (score[1:] + score[:-1]) / 2, [score[-1] + 2]))
    return float(edges[best].mean())


def labelled(docs: DataFrame, labels: DataFrame, rows_per_class: int = SAMPLE_ROWS) -> DataFrame:
    """A bounded sample of labelled rows (``key``, ``text``, ``toxic``), chosen by a hash of the id."""
    known = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .withColumn("key", F.xxhash64("doc_id"))
    )
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}  # two rows
    span = 1 << 64
    keep = F.lit(False)
    for toxic, n in sorted(counts.items()):
        top = min(span - 1, int(span * min(1.0, rows_per_class / n))) - (span >> 1)
        keep = keep | ((F.col("toxic") == toxic) & (F.col("key") <= F.lit(top)))
    # Some 2 * rows_per_class rows of three numbers: that is all that is broadcast.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known.where(keep)), "doc_id").select("key", "text", "toxic")


def _fitting(words: np.ndarray, toxic: np.ndarray, max_words: int) -> np.ndarray:
    """Which texts to train on: of each class those that still fit into its share of the words, in order.

    What the smaller class leaves goes to the other; a class of which no text fits keeps its shortest.
    """
    keep = np.zeros(len(words), dtype=bool)
    classes = sorted(set(toxic.tolist()), key=lambda c: (int(words[toxic == c].sum()), c))
    left = max_words
    for i, c in enumerate(classes):
        own, share = np.flatnonzero(toxic == c), left // (len(classes) - i)
        used = 0
        for k in own.tolist():
            if used + int(words[k]) <= share:
                keep[k] = True
                used += int(words[k])
        if not keep[own].any():
            keep[own[np.argmin(words[own])]] = True
        left = max(0, left - used)
    return keep


def fit(sample: DataFrame, max_words: int = SAMPLE_WORDS, trainer: Callable[..., Model] = train) -> Model:
    """The model of a bounded sample, trained in one task; texts that do not fit into ``max_words`` words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = pa.schema([("key", pa.int64()), ("text", pa.string()), ("toxic", pa.int32())]).empty_table()
        table = pa.concat_tables([empty, *(pa.Table.from_batches([b]).cast(empty.schema) for b in batches)])
        table = table.sort_by([("key", "ascending"), ("toxic", "ascending"), ("text", "ascending")])
        text = pa.chunked_array([table["text"]]).combine_chunks()
        toxic = table["toxic"].to_numpy()
        fits = _fitting(W.words(text).counts(), toxic, max_words) if len(text) else np.zeros(0, bool)
        model = trainer(text.filter(pa.array(fits, pa.bool_())), toxic[fits])
        yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], ["model"])

    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return Model.from_bytes(bytes(row[0])) if row else trainer(pa.array([], pa.string()), np.zeros(0))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of the documents and ``score``, the probability that the text is toxic."""
    names = docs.columns
    raw = docs.sparkSession.sparkContext.broadcast(model.to_bytes())  # the bucket weights: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.from_bytes(raw.value)
        for block in W.blocks(batches, "text", BLOCK_BYTES):
            scores = own.scores(W.column(block, "text"))
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(scores)], [*names, "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))
