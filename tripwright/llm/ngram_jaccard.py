"""Jaccard join of documents on word n-grams, by vertical partitioning.

Two documents link when ``den * |x & y| >= num * |x | y|`` for their sets of distinct n-grams.

1. Blocks of texts send their n-grams (64-bit hashes) to buckets by hash, which count in how many
   documents each occurs and send back those in two or more. An n-gram of one document joins nothing;
   a document with too many of them links with nothing and leaves here.
2. Documents with equal sets are one *class*, so copies cost nothing further.
3. The global order is rarest first, then by hash. Classes that link share an n-gram among the first few
   of each in that order (the prefix); components of that relation are *families*. Pairs of one family
   are compared in blocks of ``SIDE`` classes by ``SIDE``.
4. The order is cut at pivots into ``FRAGMENTS`` pieces of about equal weight. Each fragment counts the
   overlaps of a pair of blocks for its n-grams alone; the partial counts are summed per pair, and the
   sums decide exactly. Of each pair of blocks only a spanning forest of its links goes on.
5. Components of the links, over the classes.

Defined cases: null, empty and wordless texts have the empty set and link with nothing; rows are
documents, so repeated rows are copies; a null id is never the smallest of its component unless all
are; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm import words as W
from tripwright.llm.components import components
from tripwright.llm.packing import groups, pack, pack_sorted, unpack, unpack_sorted
from tripwright.llm.tables import written

BUCKET_GRAMS = 600_000
SIDE = 128
FRAGMENTS = 4


def text_grams(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each text, ordered by hash: hash and text; and the size of each text's set.

    A text of fewer words has one n-gram, all its words.
    """
    w = W.words(texts, lower=True)
    hashes, counts = w.hashes(), w.counts()
    at, value = W.windows(w.doc, hashes, size)
    short = np.flatnonzero((counts > 0) & (counts < size))
    begin = (np.cumsum(counts) - counts)[short]
    whole = np.zeros(len(short), dtype=np.uint64)
    for k in range(size):
        more = counts[short] > k
        whole[more] = W.mix(whole[more] * np.uint64(W._BASE) + hashes[begin[more] + k])
    value, text = np.concatenate([value, whole]), np.concatenate([w.doc[at], short])
    order = np.lexsort((text, value))
    value, text = value[order], text[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[new], text[new]
    return value, text, np.bincount(text, minlength=w.n_docs)


_SENT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.list_(pa.int64())), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_SENT_SQL = "bucket long, block long, kind int, doc_id array<long>, a binary, b binary, c binary"
_DOC_SQL = "doc_id long, n long, class long, check long, grams array<long>"


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def shared_grams(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """For each row: id, size of its set, the class of its set, and, where it can link at all, its n-grams
    that others have too, in the global order. An n-gram is one long: 8 bits of rarity, 56 of hash."""
    # Number of buckets: from the bytes of text, a word taking six or so.
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2, total // 6 // BUCKET_GRAMS + 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        edges = np.array([(b << 64) // buckets for b in range(buckets)], dtype=np.uint64)
        for number, part in enumerate(W.blocks(batches, "text")):
            value, text, n = text_grams(W.column(part, "text"), size)
            block = base + number
            of_set = []
            for salt in (1, 2):
                sums = np.zeros(len(n), dtype=np.uint64)
                np.add.at(sums, text, W.mix(value * np.uint64(2) + np.uint64(salt)))
                of_set.append(W.mix(sums ^ n.astype(np.uint64)).view(np.int64))
            rows = [(block % buckets, block, 0, W.column(part, "doc_id").to_pylist(), n.astype("<u4").tobytes(), of_set[0].tobytes(), of_set[1].tobytes())]
            cut = np.append(np.searchsorted(value, edges), len(value))
            width = "<u2" if len(n) < 1 << 16 else "<u4"
            rows += [
                (b, block, 1, None, pack_sorted(value[cut[b] : cut[b + 1]]), pack(text[cut[b] : cut[b + 1]], width), None)
                for b in np.flatnonzero(np.diff(cut)).tolist()
            ]
            yield _batch(_SENT, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), rows in groups(batches, "bucket"):
            sent = [r for r in rows if r["kind"] == 1]
            out = [tuple(r[f.name] for f in _SENT) for r in rows if r["kind"] == 0]
            if sent:
                values = [unpack_sorted(r["a"]) for r in sent]
                _, at, many = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
                many = many[at]
                begin = 0
                for r, v in zip(sent, values):
                    df = many[begin : begin + len(v)]
                    begin += len(v)
                    common = df > 1
                    if common.any():
                        text = unpack(r["b"], "u")[common]
                        out.append((bucket, r["block"], 1, None, pack_sorted(v[common]), pack(text, "<u4"), pack(np.minimum(df[common], 255), "u1")))
            if out:
                yield _batch(_SENT, out)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, "block"):
            info = rows[0]
            n = np.frombuffer(info["a"], "<u4").astype(np.int64)
            value = np.concatenate([np.zeros(0, "<u8")] + [unpack_sorted(r["a"]) for r in rows[1:]])
            text = np.concatenate([np.zeros(0, "<u4")] + [unpack(r["b"], "u") for r in rows[1:]])
            rarity = np.concatenate([np.zeros(0, "u1")] + [unpack(r["c"], "u") for r in rows[1:]])
            order = (rarity.astype(np.uint64) << np.uint64(56)) | (value >> np.uint64(8))
            held = np.bincount(text, minlength=len(n))
            able = (held * den >= num * n) & (n > 0)
            kept = able[text]
            order, text = order[kept], text[kept]
            sort = np.lexsort((order, text))
            # Longs are signed: the order survives moving it down by half the range.
            grams = (order[sort] ^ np.uint64(1 << 63)).view(np.int64)
            ends = np.concatenate(([0], np.cumsum(np.where(able, held, 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(grams), mask=pa.array(~able))
            yield pa.RecordBatch.from_arrays(
                [pa.array(info["doc_id"], pa.int64()), pa.array(n), pa.array(np.frombuffer(info["b"], np.int64)), pa.array(np.frombuffer(info["c"], np.int64)), lists],
                ["doc_id", "n", "class", "check", "grams"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = own.mapInArrow(send, _SENT_SQL).repartition("bucket").sortWithinPartitions("bucket", "block", "kind")
    back = dealt.mapInArrow(count, _SENT_SQL).repartition("block").sortWithinPartitions("block", "kind")
    return written(back.mapInArrow(gather, _DOC_SQL), "jaccard-documents")


def _families(classes: DataFrame, num: int, den: int) -> DataFrame:
    """``class``, ``family`` of the classes that share an n-gram of their prefixes with another one."""
    # |x & y| >= num / den * max(|x|, |y|), so of the first n - need + 1 n-grams one is shared; those of one
    # document alone come first in the order and are not listed.
    need = f"((n * {num} + {den - 1}) div {den})"
    prefix = classes.select("class", F.explode(F.expr(f"slice(grams, 1, cast(size(grams) - {need} + 1 as int))")).alias("gram"))
    heads = prefix.groupBy("gram").agg(F.min("class").alias("head"), F.count(F.lit(1)).alias("many")).where("many > 1")
    edges = prefix.join(heads, "gram").select(F.col("class").alias("a"), F.col("head").alias("b"))
    return components(edges, "jaccard-families").select(F.col("node").alias("class"), F.col("root").alias("family"))


_SEGMENT_SQL = "family long, i int, j int, fragment int, class long, n long, copies long, side int, grams binary"
_COUNT_SQL = "family long, i int, j int, fragment int, classes array<long>, n array<long>, copies array<long>, sides array<int>, counts binary"
_LINK_SQL = "a long, b long, links long"


def _links(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Steps 3 and 4: ``a`` (a class), ``b`` (the first class of its tree in a pair of blocks) and ``links`` (the
    number of other rows that a links with in it)."""
    family = written(_families(classes, num, den), "jaccard-families")
    sizes = family.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias("blocks"))
    rows = written(
        classes.join(family, "class").join(sizes, "family").withColumn("own", F.pmod(F.xxhash64("class"), "blocks").cast("int")),
        "jaccard-classes",
    )
    steps = [(k + 1) / FRAGMENTS for k in range(FRAGMENTS - 1)]
    found = rows.select(F.explode("grams").alias("g")).agg(F.percentile_approx("g", steps, 10_000)).first()[0] or []
    pivots = np.array(sorted(set(found)), dtype=np.int64)
    seg = pa.schema([("family", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("fragment", pa.int32()), ("class", pa.int64()), ("n", pa.int64()), ("copies", pa.int64()), ("side", pa.int32()), ("grams", pa.binary())])
    cnt = pa.schema([("family", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("fragment", pa.int32()), ("classes", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())), ("sides", pa.list_(pa.int32())), ("counts", pa.binary())])
    lnk = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch.column(batch.num_columns - 1)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k, r in enumerate(batch.select(range(batch.num_columns - 1)).to_pylist()):
                grams = flat[ends[k] : ends[k + 1]]
                cut = np.concatenate(([0], np.searchsorted(grams, pivots), [len(grams)]))
                pieces = [grams[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
                for other in range(r["blocks"]):
                    i, j = sorted((r["own"], other))
                    side = int(r["own"] == j)
                    out += [(r["family"], i, j, f, r["class"], r["n"], r["copies"], side, p) for f, p in enumerate(pieces)]
                if len(out) > 5000:
                    yield _batch(seg, out)
                    out = []
            if out:
                yield _batch(seg, out)

    def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in groups(batches, "family", "i", "j", "fragment"):
            grams = [np.frombuffer(r["grams"], np.int64) for r in group]
            _, at = np.unique(np.concatenate(grams), return_inverse=True)
            here = np.zeros((len(group), at.max() + 1 if len(at) else 1), dtype=np.float32)
            here[np.repeat(np.arange(len(group)), [len(g) for g in grams]), at] = 1
            counts = (here @ here.T).astype("<u4")  # exact: the numbers are far below 2 ** 24
            yield _batch(cnt, [(*key, *([r[c] for r in group] for c in ("class", "n", "copies", "side")), counts.tobytes())])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), group in groups(batches, "family", "i", "j"):
            first = group[0]
            size = len(first["classes"])
            overlap = sum(np.frombuffer(r["counts"], "<u4").astype(np.int64) for r in group).reshape(size, size)
            n, copies, side = (np.array(first[c], dtype=np.int64) for c in ("n", "copies", "sides"))
            link = den * overlap >= num * (n[:, None] + n[None] - overlap)
            np.fill_diagonal(link, False)
            if i != j:
                link &= side[:, None] != side[None]
            degree = link @ copies
            root = np.arange(size)
            while True:  # the smallest position that links reach
                low = np.minimum(root, np.where(link, root[None], size).min(1, initial=size))
                low = low[low]
                if (low == root).all():
                    break
                root = low
            has = np.flatnonzero(degree)
            if len(has):
                own = np.array(first["classes"], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own[has]), pa.array(own[root[has]]), pa.array(degree[has])], schema=lnk)

    keys = ["family", "i", "j"]
    cut = rows.select("family", "class", "n", "copies", "blocks", "own", "grams").mapInArrow(segments, _SEGMENT_SQL)
    dealt = cut.repartition(*keys, "fragment").sortWithinPartitions(*keys, "fragment", "class")
    summed = dealt.mapInArrow(overlaps, _COUNT_SQL).repartition(*keys).sortWithinPartitions(*keys, "fragment")
    return written(summed.mapInArrow(decide, _LINK_SQL), "jaccard-links")


def join(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """For each row ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable by links) and ``n_links``
    (other rows that it links with)."""
    rows = shared_grams(docs, size, num, den)
    # A class is named by 64 bits of its set; the other 64 tell sets apart that share them.
    named = rows.withColumn("class", F.xxhash64("class", "check", "n"))
    classes = written(
        named.where("n > 0").groupBy("class").agg(
            F.min("doc_id").alias("label"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.first("grams", True).alias("grams")
        ),
        "jaccard-sets",
    )
    links = _links(classes.where("grams is not null"), num, den)
    roots = components(links.select("a", "b"), "jaccard-components")
    labels = classes.select("class", "label", "copies").join(roots.withColumnRenamed("node", "class"), "class", "left")
    labels = labels.withColumn("root", F.coalesce("root", "class"))
    least = labels.groupBy("root").agg(F.min("label").alias("component_id"))
    degree = links.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    told = labels.join(least, "root").join(degree, "class", "left").select(
        "class", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    full = named.where("n > 0").select("doc_id", "n", "class").join(told, "class").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links"
    )
    empty = named.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(empty)
