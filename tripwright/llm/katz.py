"""Bigram language model by Katz backoff, counted and evaluated in blocks and buckets.

Model. Tokens are lower-cased words and one end mark per text; the first token's history is a start
mark. Counts r = 1..5 are discounted by Good-Turing (Katz's formula), larger ones are not. Each
history, the empty one too, gets one extra count, so some mass is always left:

    P(w | h) = d(c(hw)) c(hw) / (c(h) + 1)   if hw was seen, else   alpha(h) P(w)
    P(w)     = d(c(w)) c(w) / (N + 1)        if w was seen, else what is left, for one unknown token
    alpha(h) = (1 - sum of seen P(w | h)) / (1 - sum of P(w) over the same w);   1 for an unseen h

so that the probabilities of all known tokens and the unknown one sum to one for every history.

Work. Texts become *blocks* (a few MB): their vocabulary as sorted 64-bit hashes and their tokens as
indices into it. A block sends its vocabulary with counts to *buckets* by hash and gets back totals;
then it sends its distinct (history, word, text) triples to buckets by history, where totals, seen
continuations and each text's share of the score are worked out. Everything a block sends is
aggregated before it is sent, so no word or pair is hot; a history with more than ``1 / HOT`` of a
bucket's usual load is spread over buckets by word. Tables ``unigrams`` and ``bigrams`` (partitioned by
bucket) hold the model. Words are told apart by 64-bit hashes.

Defined cases: a null or empty text is the end mark alone; a null id is never held out; repeated rows
count as often as they occur; without training rows all tokens are unknown and each has P = 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm import words as W
from tripwright.llm.packing import groups
from tripwright.llm.packing import pack as _pack
from tripwright.llm.packing import unpack as _open
from tripwright.llm.tables import written

#: Good-Turing applies to counts up to this one.
MOST = 5
#: Tokens per bucket, about.
BUCKET_TOKENS = 1_200_000
#: Parts of a score travel as multiples of this.
STEP = 2.0**-34
BLOCK_BYTES = 8 << 20
HOT = 2
_END = np.uint64(1)
_START_ID = 0


def discounts(n: np.ndarray) -> np.ndarray:
    """``d[r]`` for r = 0..MOST from ``n[r]``, the number of types seen r times (r = 0..MOST + 1).

    Where the counts of counts do not support the formula, d(r) is r / (r + 1).
    """
    n = np.asarray(n, dtype=float)
    d = np.array([1.0] + [r / (r + 1) for r in range(1, MOST + 1)])
    if n[1] > 0:
        common = (MOST + 1) * n[MOST + 1] / n[1]
        for r in range(1, MOST + 1):
            if n[r] > 0 and n[r + 1] > 0 and common < 1:
                value = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
                d[r] = value if 0 < value < 1 else d[r]
    return d


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(counts > MOST, 1.0, d[np.minimum(counts, MOST)]) * counts


@dataclass(frozen=True)
class Unigrams:
    """What all blocks need to know of the unigram model."""

    tokens: int
    types: int
    d: tuple[float, ...]
    unknown: float  # probability of the unknown token
    texts: int  # in training

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, np.array(self.d)) / (self.tokens + 1), self.unknown)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_BLOCK = pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("train", pa.binary()), ("sizes", pa.binary()), ("vocabulary", pa.binary()), ("tokens", pa.binary()), ("n_tokens", pa.int64())])
_BLOCK_SQL = "block long, doc_id array<long>, train binary, sizes binary, vocabulary binary, tokens binary, n_tokens long"


def blocks(docs: DataFrame, train: Column) -> DataFrame:
    """Texts as stored blocks; ``train`` says which rows the model learns from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for number, part in enumerate(W.blocks(batches, "text", BLOCK_BYTES)):
            w = W.words(W.column(part, "text"), lower=True)
            counts = w.counts() + 1
            ends = np.cumsum(counts) - 1
            hashes = np.full(counts.sum(), _END, dtype=np.uint64)
            is_word = np.ones(len(hashes), dtype=bool)
            is_word[ends] = False
            hashes[is_word] = w.hashes()
            vocabulary, tokens = np.unique(hashes, return_inverse=True)
            yield _rows(_BLOCK, [(
                base + number, W.column(part, "doc_id").to_pylist(), _pack(W.column(part, "train").to_numpy(False), "u1"),
                _pack(counts, "<u4"), _pack(vocabulary, "<u8"), _pack(tokens, "<u4"), len(tokens),
            )])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(train, F.lit(True)).alias("train"))
    return written(chosen.mapInArrow(run, _BLOCK_SQL), "lm-blocks")


def _edges(values: np.ndarray, n: int) -> np.ndarray:
    """Where each of n buckets begins in sorted 64-bit values; a bucket is a range of the values."""
    starts = np.array([(b << 64) // n for b in range(n)], dtype=np.uint64)
    return np.append(np.searchsorted(values, starts), len(values))


_UNI_SQL = "block long, bucket int, ids binary, counts binary, histogram array<long>, tokens long"
_UNI = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary()), ("histogram", pa.list_(pa.int64())), ("tokens", pa.int64())])


def unigram_totals(stored: DataFrame, buckets: int) -> DataFrame:
    """For each block and bucket the ids and training counts of its words, in the block's order; and a
    row without block for each bucket: its words, their counts, counts of counts and tokens."""
    message = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                words, tokens = _open(row["vocabulary"], "u"), _open(row["tokens"], "u")
                learnt = np.repeat(_open(row["train"], "u"), _open(row["sizes"], "u"))
                counts = np.bincount(tokens, learnt, minlength=len(words))
                e = _edges(words, buckets)
                yield _rows(message, [(b, row["block"], _pack(words[e[b] : e[b + 1]], "<u8"), _pack(counts[e[b] : e[b + 1]], "<u4")) for b in range(buckets)])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), rows in groups(batches, "bucket"):
            words = [_open(r["words"], "u") for r in rows]
            distinct, at = np.unique(np.concatenate(words), return_inverse=True)
            counts = np.bincount(at, np.concatenate([_open(r["counts"], "u") for r in rows]), minlength=len(distinct)).astype(np.int64)
            # Frequent words get small ids, which compress well.
            rank = np.empty(len(distinct), dtype=np.int64)
            rank[np.argsort(-counts, kind="stable")] = np.arange(len(distinct))
            ids = rank * buckets + bucket + 1
            histogram = np.bincount(np.minimum(counts, MOST + 2), minlength=MOST + 3)
            yield _rows(_UNI, [(None, bucket, _pack(distinct, "<u8"), _pack(counts, "<u8"), histogram.tolist(), int(counts.sum()))])
            begin = 0
            for r, w in zip(rows, words):
                own = at[begin : begin + len(w)]
                begin += len(w)
                yield _rows(_UNI, [(r["block"], bucket, _pack(ids[own], "<u8"), _pack(counts[own], "<u8"), None, None)])

    sent = stored.mapInArrow(send, "bucket int, block long, words binary, counts binary")
    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    return written(dealt.mapInArrow(total, _UNI_SQL), "lm-unigrams")


def fit_unigrams(totals: DataFrame, texts: int) -> Unigrams:
    row = totals.where("block is null").agg(
        F.sum("tokens"), *[F.sum(F.col("histogram")[r]) for r in range(MOST + 3)]
    ).first()
    tokens, n = int(row[0] or 0), np.array([int(x or 0) for x in row[1:]])
    d = discounts(n[: MOST + 2])
    held = sum(d[r] * r * n[r] for r in range(1, MOST + 1))
    over = tokens - sum(r * int(n[r]) for r in range(1, MOST + 1))
    return Unigrams(tokens, int(n[1:].sum()), tuple(d.tolist()), 1 - float(held + over) / (tokens + 1), texts)


_PAIR = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32())] + [(c, pa.binary()) for c in ("history", "h_count", "run", "word", "w_count", "text", "times", "train")] + [("doc_id", pa.list_(pa.int64()))])
_PAIR_SQL = "bucket int, block long, kind int, history binary, h_count binary, run binary, word binary, w_count binary, text binary, times binary, train binary, doc_id array<long>"


def _triples(row: dict, ids: np.ndarray, counts: np.ndarray, uni: Unigrams, buckets: int, hot_count: int) -> list[tuple]:
    """A block's distinct (history, word, text) as messages to buckets, and its texts' own row."""
    tokens, sizes, train = _open(row["tokens"], "u"), _open(row["sizes"], "u").astype(np.int64), _open(row["train"], "u")
    text = np.repeat(np.arange(len(sizes)), sizes)
    word = ids[tokens]
    first = np.concatenate(([True], text[1:] != text[:-1]))
    history = np.where(first, _START_ID, np.roll(word, 1))
    h_count = np.where(first, uni.texts, np.roll(counts[tokens], 1))
    # What needs no history: base counts of each text.
    c = counts[tokens]
    logs = np.bincount(text, np.log10(c + 1.0), minlength=len(sizes))
    known = np.bincount(text, c > 0, minlength=len(sizes))
    out = [(int(row["block"] % buckets), row["block"], 0, _pack(sizes, "<u4"), _pack(known, "<u4"), _pack(logs, "<f8"), None, None, None, None, _pack(train, "u1"), row["doc_id"])]
    spread = np.where(h_count > hot_count, word, 0)
    place = W.mix(history.astype(np.uint64) * np.uint64(3) + W.mix(spread.astype(np.uint64))) % np.uint64(buckets)
    order = np.lexsort((text, word, history, place))
    place, history, word, text, h_count, c = (x[order] for x in (place, history, word, text, h_count, c))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (history[1:] != history[:-1]) | (word[1:] != word[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    times = np.diff(np.append(begin, len(order)))
    place, history, word, text, h_count, c = (x[begin] for x in (place, history, word, text, h_count, c))
    edges = np.searchsorted(place, np.arange(buckets + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        s = slice(edges[b], edges[b + 1])
        h, w = history[s], word[s]
        at = W.runs(h)
        # A word's count goes along with its first triple only.
        _, one = np.unique(w, return_index=True)
        sent = np.zeros(len(w), dtype=np.int64)
        sent[one] = c[s][one]
        out.append((
            b, row["block"], 1, _pack(h[at], "<u8"), _pack(h_count[s][at], "<u8"), _pack(np.diff(np.append(at, len(h))), "<u4"),
            _pack(w, "<u4" if w.max() < 1 << 32 else "<u8"), _pack(sent, "<u4" if sent.max() < 1 << 32 else "<u8"),
            _pack(text[s], "<u2" if len(sizes) < 1 << 16 else "<u4"), _pack(times[s], "<u4"),
            _pack(train[text[s]], "u1"), None,
        ))
    return out


#: kind 0: a block's texts; 1: sums of a block's texts; 2: backing off; 3: a hot history's part; 4: a bucket's model.
_OUT = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64())] + [(c, pa.binary()) for c in ("a", "b", "c", "d", "e")] + [("doc_id", pa.list_(pa.int64()))])
_OUT_SQL = "kind int, bucket int, block long, a binary, b binary, c binary, d binary, e binary, doc_id array<long>"
_STATS = MOST + 3  # of a history: c(h), types seen 1..MOST times, tokens of those seen more often, sum of their P(w)


def _bucket(bucket: int, rows: list[dict], uni: Unigrams, hot_count: int) -> Iterator[tuple]:
    """Totals of a bucket's pairs, and from them what each block's texts need."""
    parts = []
    for r in rows:
        run = _open(r["run"], "u")
        w = _open(r["word"], "u").astype(np.int64)
        _, one, back = np.unique(w, return_index=True, return_inverse=True)
        count = _open(r["w_count"], "u").astype(np.int64)[one][back]
        parts.append((np.repeat(_open(r["history"], "u").astype(np.int64), run), np.repeat(_open(r["h_count"], "u").astype(np.int64), run), w, count, _open(r["text"], "u").astype(np.int64), _open(r["times"], "u").astype(np.int64), _open(r["train"], "u")))
    history, h_count, word, w_count, text, times, train = (np.concatenate(x) for x in zip(*parts))
    owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.lexsort((word, history))
    h, w = history[order], word[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    pair_of = np.empty(len(order), dtype=np.int64)
    pair_of[order] = np.cumsum(new) - 1
    first = order[new]
    total = np.bincount(pair_of, times * train, minlength=len(first)).astype(np.int64)
    p_word = uni.probability(w_count[first])
    # Of each history, its seen continuations.
    h_first = W.runs(history[first])
    h_of = np.repeat(np.arange(len(h_first)), np.diff(np.append(h_first, len(first))))
    stats = np.zeros((len(h_first), _STATS))
    stats[:, 0] = h_count[first][h_first]
    for r in range(1, MOST + 1):
        stats[:, r] = np.bincount(h_of, total == r, minlength=len(h_first))
    stats[:, MOST + 1] = np.bincount(h_of, np.where(total > MOST, total, 0), minlength=len(h_first))
    stats[:, MOST + 2] = np.bincount(h_of, np.where(total > 0, p_word, 0), minlength=len(h_first))
    ids = history[first][h_first]
    hot = stats[:, 0] > hot_count
    seen = total > 0
    histogram = np.bincount(np.minimum(total, MOST + 2), minlength=MOST + 3)
    yield (4, bucket, None, _pack(history[first][seen], "<u8"), _pack(word[first][seen], "<u8"), _pack(total[seen], "<u8"), None, _pack(histogram, "<u8"), None)
    if hot.any():
        yield (3, bucket, None, _pack(ids[hot], "<u8"), _pack(stats[hot], "<f8"), None, None, None, None)
    r = total[pair_of]
    value = times * np.log10(np.maximum(r, 1) / (h_count + 1.0))
    for k, row in enumerate(rows):
        s = slice(*np.searchsorted(owner, [k, k + 1]))
        known, t = r[s] > 0, text[s]
        where, at = np.unique(t, return_inverse=True)
        sums = np.bincount(at, np.where(known, value[s], 0))
        rare = np.stack([np.bincount(at, np.where(r[s] == c, times[s], 0)) for c in range(1, MOST + 1)], axis=1)
        yield (1, bucket, row["block"], _pack(where, "<u4"), _pack(np.rint(sums / -STEP), "<u8"), _pack(rare, "<u4"), None, None, None)
        if not known.all():
            pair = pair_of[s][~known]
            of, at = np.unique(h_of[pair], return_inverse=True)
            yield (2, bucket, row["block"], _pack(t[~known], "<u4"), _pack(np.rint(times[s][~known] * np.log10(p_word[pair]) / -STEP), "<u8"), _pack(np.stack([at, times[s][~known]]), "<u4"), _pack(ids[of], "<u8"), _pack(stats[of], "<f8"), None)


def pair_totals(stored: DataFrame, totals: DataFrame, uni: Unigrams, buckets: int, hot_count: int) -> DataFrame:
    """The second exchange: blocks meet their words' totals, send triples, and buckets answer."""
    own = stored.select("block", F.lit(-1).alias("part"), "doc_id", "train", "sizes", "tokens")
    words = totals.where("block is not null").select(
        "block", F.col("bucket").alias("part"), F.lit(None).cast("array<long>").alias("doc_id"),
        F.col("ids").alias("train"), F.col("counts").alias("sizes"), F.lit(None).cast("binary").alias("tokens"),
    )
    met = own.unionByName(words).repartition("block").sortWithinPartitions("block", "part")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, "block"):
            ids = np.concatenate([_open(r["train"], "u") for r in rows[1:]]).astype(np.int64)
            counts = np.concatenate([_open(r["sizes"], "u") for r in rows[1:]]).astype(np.int64)
            yield _rows(_PAIR, _triples(rows[0], ids, counts, uni, buckets, hot_count))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), rows in groups(batches, "bucket"):
            for r in rows:
                if r["kind"] == 0:
                    yield _rows(_OUT, [(0, bucket, r["block"], r["history"], r["h_count"], r["run"], r["train"], None, r["doc_id"])])
            if pairs := [r for r in rows if r["kind"] == 1]:
                for out in _bucket(bucket, pairs, uni, hot_count):
                    yield _rows(_OUT, [out])

    dealt = met.mapInArrow(send, _PAIR_SQL).repartition("bucket").sortWithinPartitions("bucket")
    return written(dealt.mapInArrow(answer, _OUT_SQL), "lm-pairs")


@dataclass(frozen=True)
class Model:
    """The fitted model and, for each text, what is left to add up. ``bigrams()`` and ``unigrams()`` are its tables."""

    uni: Unigrams
    d: tuple[float, ...]
    answers: DataFrame
    totals: DataFrame
    buckets: int
    hot: dict[int, tuple[float, ...]]

    def unigrams(self) -> DataFrame:
        """``word`` (hash), ``id``, ``count``: one partition folder's worth per bucket."""
        buckets = self.buckets

        def run(batches):
            for _, rows in groups(batches, "bucket"):
                for r in rows:
                    counts = _open(r["counts"], "u").astype(np.int64)
                    rank = np.empty(len(counts), dtype=np.int64)
                    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(counts), r["bucket"], np.int32)), pa.array(_open(r["ids"], "u").astype(np.int64)), pa.array(rank * buckets + r["bucket"] + 1), pa.array(counts)], ["bucket", "word", "id", "count"])

        return self.totals.where("block is null").mapInArrow(run, "bucket int, word long, id long, count long")

    def bigrams(self) -> DataFrame:
        """``history`` and ``word`` (ids; history 0 begins a text) and ``count`` of each seen pair."""

        def run(batches):
            for _, rows in groups(batches, "bucket"):
                for r in rows:
                    cols = [pa.array(_open(r[c], "u").astype(np.int64)) for c in "abc"]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cols[0]), r["bucket"], np.int32)), *cols], ["bucket", "history", "word", "count"])

        return self.answers.where("kind = 4").select("bucket", "a", "b", "c").mapInArrow(run, "bucket int, history long, word long, count long")


def alpha(stats: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Backoff weights from rows of history statistics; 1 for an unseen history."""
    r = np.arange(1, MOST + 1)
    used = (stats[:, 1 : MOST + 1] @ (d[1:] * r) + stats[:, MOST + 1]) / (stats[:, 0] + 1)
    return np.where(stats[:, 0] > 0, (1 - used) / np.maximum(1 - stats[:, MOST + 2], 1e-300), 1.0)


def fit(docs: DataFrame, train: Column, bucket_tokens: int = BUCKET_TOKENS) -> Model:
    """Counts, discounts and all that scoring needs; ``docs`` has doc_id and text."""
    stored = blocks(docs, train)
    n = stored.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = max(2, -(-n // bucket_tokens))
    texts = docs.where(F.coalesce(train, F.lit(True))).count()
    totals = unigram_totals(stored, buckets)
    uni = fit_unigrams(totals, texts)
    answers = pair_totals(stored, totals, uni, buckets, max(1, n // buckets // HOT))
    histogram = np.zeros(MOST + 3, dtype=np.int64)
    hot: dict[int, np.ndarray] = {}
    # One histogram per bucket and the few hot histories: no more rows than a few per bucket.
    for row in answers.where("kind = 4").select("e").toLocalIterator():
        histogram += _open(bytes(row[0]), "u").astype(np.int64)
    for row in answers.where("kind = 3").select("a", "b").toLocalIterator():
        for h, part in zip(_open(bytes(row[0]), "u").tolist(), _open(bytes(row[1]), "f").reshape(-1, _STATS)):
            if h in hot:
                hot[h][1:] += part[1:]
            else:
                hot[h] = part.copy()
    d = discounts(histogram[: MOST + 2])
    return Model(uni, tuple(d.tolist()), answers, totals, buckets, {h: tuple(s) for h, s in hot.items()})


SCORES = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(model: Model) -> DataFrame:
    """For each text of ``fit`` its log10 probability, and the add-one unigram score as a base."""
    uni, d = model.uni, np.array(model.d)
    hot = {h: float(np.log10(alpha(np.array([s]), d)[0])) for h, s in model.hot.items()}
    logs_d = np.log10(d[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, "block"):
            info = rows[0]
            sizes, known = _open(info["a"], "u").astype(np.int64), _open(info["b"], "u").astype(np.int64)
            scores = np.zeros(len(sizes))
            for r in rows[1:]:
                where = _open(r["a"], "u")
                if r["kind"] == 1:
                    rare = _open(r["c"], "u").reshape(-1, MOST)
                    scores[where] += _open(r["b"], "u") * -STEP + rare @ logs_d
                else:
                    at, times = _open(r["c"], "u").reshape(2, -1)
                    weight = np.log10(alpha(_open(r["e"], "f").reshape(-1, _STATS), d))
                    for i, h in enumerate(_open(r["d"], "u").tolist()):
                        weight[i] = hot.get(h, weight[i])
                    np.add.at(scores, where, _open(r["b"], "u") * -STEP + times * weight[at])
            base = _open(info["c"], "f") - sizes * np.log10(uni.tokens + uni.types + 1.0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(info["doc_id"], pa.int64()), pa.array(_open(info["d"], "u") > 0), pa.array(sizes), pa.array(known), pa.array(np.full(len(sizes), uni.tokens)), pa.array(base), pa.array(scores)],
                ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    own = model.answers.where("kind in (0, 1, 2)").repartition("block").sortWithinPartitions("block", "kind")
    return own.mapInArrow(run, SCORES)
