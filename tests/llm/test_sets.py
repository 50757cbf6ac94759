"""Joins, searches, archives and line removal against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripwright.llm import line_chunks, neighbours, ngram_jaccard, queries, warc
from tripwright.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def smallest(edges, nodes):
    """Smallest node that each node reaches."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    expected = smallest(edges, {x for e in edges for x in e})
    assert found == {n: r for n, r in expected.items() if n in found}
    assert {n for a, b in edges if a != b for n in (a, b)} == set(found)


def brute_jaccard(rows, size, num, den):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    root = smallest(links, range(len(rows)))
    least = defaultdict(list)
    for i, r in root.items():
        if rows[i][0] is not None:
            least[r].append(rows[i][0])
    degree = [sum(i in e for e in links) for i in range(len(rows))]
    return sorted(((rows[i][0], len(sets[i]), min(least[root[i]], default=None), degree[i]) for i in range(len(rows))), key=str)


def near_copies():
    """A family with more classes than one block holds, of which not all link directly."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 9)):
            words[at] = f"x{rng.integers(0, 400)}"
        rows.append((1000 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("size, num", [(3, 90), (5, 80)])
def test_jaccard_against_all_pairs(spark, size, num, monkeypatch):
    rows = near_copies() + [(5, None), (6, ""), (7, "One two"), (8, "one TWO"), (9, "one"), (None, "one two"), (7, "one two"), (10, "other words altogether here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, ngram_jaccard.join(docs, size, num, 100).collect()), key=str)
    assert got == brute_jaccard(rows, size, num, 100)


def test_jaccard_of_odd_rows(spark, odd, none):
    got = sorted(map(tuple, ngram_jaccard.join(odd).collect()), key=str)
    assert got == brute_jaccard([(r.doc_id, r.text) for r in odd.collect()], 5, 80, 100)
    assert ngram_jaccard.join(none).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert [r.component_id for r in ngram_jaccard.join(nulls).collect()] == [None, None]


def test_search_finds_the_nearest(spark, small):
    rows = queries.table(spark, small, "embeddings")
    got = defaultdict(list)
    for r in queries.QUERIES["op10_neighbours"](spark, small).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    held = rows.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in held]), np.array([r.embedding for r in held])
    hits = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        hits += len({i for i, _ in got[q]} & set(ids[np.lexsort((ids, d))[:10]].tolist()))
        assert all(abs(score - d[ids == i][0]) < 1e-12 for i, score in got[q])
        assert got[q] == sorted(got[q], key=lambda p: (p[1], p[0]))
    assert hits >= 0.9 * 10 * len(got)


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    given = [(0, [1.0, 1.0, 0.0]), (1, [1.0, 1.0, 0.0]), (2, [1.0, 1.0, 0.0]), (100, [1.0, 1.0, 1.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 0.0]), (6, [inf, 1.0, 0.0]), (7, [None, 1.0, 0.0]), (8, [1.0]), (None, [1.0, 1.0, 0.0]), (9, [])]
    vectors = spark.createDataFrame(given, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    got = [tuple(r) for r in neighbours.search(vectors, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 100, 1.0), (100, 1, 0, 1.0), (100, 2, 1, 1.0), (100, 3, 2, 1.0)]
    assert neighbours.search(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_cells_come_by_ascending_distance():
    rng = np.random.default_rng(2)
    a, b = rng.random(9), rng.random(7)
    cells = list(neighbours.traverse(a, b))
    assert sorted(cells) == list(range(63))
    sums = [a[c // 7] + b[c % 7] for c in cells]
    assert sums == sorted(sums)


def test_hot_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP", 50)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(400)] + [(1000 + i, [float(i), 1.0, 0.0, 1.0]) for i in range(50)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.search(vectors, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 0.0) for i in range(1, 11)]


def test_archives(spark):
    given = [
        (1, "http://a.b.c/x", "z" * 2000), (2, "http://a.b.c/x", "z" * 2000), (3, None, None), (None, "x y\r\n", "é\r\n\r\nWARC/1.1"),
        (5, "http://a.b.c/y?q=1#top", "é" * 600), (6, "u", "é" * 600), (7, "v", "short"), (8, "v", "short"), (6, "u", "é" * 600), (9, "http://[bad", ""),
    ]
    pages = spark.createDataFrame(given, "page_id long, url string, html string").withColumn("offset", F.lit(1))
    folder = warc.write(pages)
    read = warc.records(spark, folder).collect()
    assert len(read) == len(given)
    newest = {"z" * 2000: 2, "é" * 600: 6}
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read), key=str)
    expected = []
    for page, _, html in given:
        raw = (html or "").encode()
        refers = newest.get(html) if newest.get(html, page) != page else None
        expected.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers else "response", refers))
    assert got == sorted(expected, key=str)
    index = warc.index(warc.records(spark, folder), block_lines=2)
    assert warc.captures(spark, index).count() == len(given)
    found = warc.lookup(spark, folder, index, "http://a.b.c/x")
    assert sorted((h["warc-type"], h["x-page-id"], b.endswith(b"z" * 2000)) for h, b in found) == [("response", "2", True), ("revisit", "1", False)]
    assert len(warc.lookup(spark, folder, index, "v")) == 2 and warc.lookup(spark, folder, index, "http://no") == []
    assert warc.surt("http://M.example.com:80/a?b#c") == "com,example,m)/a?b"


def test_no_pages(spark):
    folder = warc.write(spark.createDataFrame([], "page_id long, url string, html string"))
    index = warc.index(warc.records(spark, folder))
    assert warc.records(spark, folder).count() == warc.captures(spark, index).count() == 0


@pytest.mark.parametrize("ranged", [True, False])
def test_captures_of_many_urls(spark, monkeypatch, ranged):
    hot = "http://hot.example.com/a b"
    given = [(i, hot if i % 3 == 0 else f"https://h{i % 7}.example.com/{i % 40}?q={i}", f"page {i} " * (i % 9)) for i in range(300)] + [(300, None, "no url")]
    pages = spark.createDataFrame(given, "page_id long, url string, html string").repartition(3)
    folder = warc.write(pages)
    index = warc.index(warc.records(spark, folder).where("page_id % 4 <> 1"), block_lines=16)
    if not ranged:
        monkeypatch.setattr(warc, "_store", lambda uri: None)
    asked = [(hot,), (hot,), (None,), ("http://no",), *((u,) for i, u, _ in given if i % 5 == 0 and i < 300)]
    wanted = {warc.surt(u and u.replace(" ", "%20")) for (u,) in asked}
    got = warc.captured(spark, folder, index, spark.createDataFrame(asked, "url string")).collect()
    # Only what the index holds is found, each capture once.
    expected = sorted(i for i, u, _ in given if i % 4 != 1 and warc.surt(u and u.replace(" ", "%20")) in wanted)
    assert sorted(r.page_id for r in got) == expected and 100 < len(expected) < 200
    assert {r.page_id: r.payload_digest for r in got} == {i: hashlib.sha1(given[i][2].encode()).hexdigest() for i in expected}


def test_query_of_archives_looks_urls_up(spark, small, monkeypatch):
    scans = []
    monkeypatch.setattr(warc, "records", lambda *a, f=warc.records: scans.append(a) or f(*a))
    monkeypatch.setattr(warc, "captures", None)
    assert queries.QUERIES["op6_warc"](spark, small).count() == queries.table(spark, small, "pages").count()
    assert len(scans) == 1  # to build the index


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, small, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.sql(f"create view {table} as select * from '{small}/{table}.parquet'")
    other = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, small).select(*other.columns)
    assert sorted(map(tuple, got.collect())) == sorted(other.fetchall())


def brute_lines(rows):
    """Chunks by the cut rule; every chunk text but the first of its kind goes."""
    c = line_chunks.chunks(pa.array([t for _, t in rows], pa.string()))
    cut = defaultdict(list)
    for text, begin, end, lines in zip(*(c[k].tolist() for k in ("text", "begin", "end", "lines"))):
        cut[text].append((begin, end, lines))
    out, seen = {}, {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0)):
        raw, left, gone = (rows[i][1] or "").encode(), [], 0
        assert b"\n".join(raw[b:e] for b, e, _ in cut[i]) == raw
        for k, (b, e, lines) in enumerate(cut[i]):
            body, words = raw[b:e], WORD.findall(raw[b:e].decode())
            if words and (lines > 1 or len(words) >= line_chunks.LONG) and seen.setdefault(body, (rows[i], k)) != (rows[i], k):
                gone += lines
                continue
            left.append(body)
        out[i] = (rows[i][0], None if rows[i][1] is None else b"\n".join(left).decode(), gone)
    return sorted(out.values(), key=str)


def test_line_chunks(spark, small, odd):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, small, "documents").collect()]
    passage = "\n".join(f"line {i} of a passage that several texts share in full" for i in range(30))
    long = " ".join(f"w{i}" for i in range(60))
    rows += [(10_000 + i, f"own start {i}\n{passage}\nown end {i}") for i in range(5)]
    rows += [(20_000 + i, f"before {i}\n{long}\nafter {i}") for i in range(5)] + [(30_000, "\n\n\n"), (30_001, "\n\n\n")]
    rows += [(r.doc_id, r.text) for r in odd.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = line_chunks.remove(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(rows)
    left = {r.doc_id: r.text for r in got}
    assert left[20_000] == f"before 0\n{long}\nafter 0" and left[20_004] == "before 4\nafter 4"
    assert left[10_004].count("passage") < 10 and left[10_004].startswith("own start 4\n") and left[10_000] == rows[-len(odd.collect()) - 12][1]


def test_line_chunks_keep_columns(spark, odd, none):
    got = line_chunks.remove(odd)
    assert got.columns == [*odd.columns, "n_lines_removed"] and got.count() == odd.count()
    assert got.where("doc_id = 1").first().text is None
    assert line_chunks.remove(none).count() == 0


def test_cuts_do_not_shift():
    body = "\n".join(f"line {i}" for i in range(60))
    hashes = [set(line_chunks.chunks(pa.array([t]))["hash"].tolist()) for t in (body, "one more\n" + body, "a\nb\n" + body)]
    assert len(hashes[0] & hashes[1]) >= len(hashes[0]) - 2 and len(hashes[0] & hashes[2]) >= len(hashes[0]) - 2


def brute_passages(rows):
    """Without chunks: a line goes if lines of 50 words or more around it occur at an earlier place that ends before them."""
    out, seen = [], {}
    for r, (doc, text) in enumerate(rows):
        lines, gone = text.split("\n"), set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(len(WORD.findall(x)) for x in lines[a:b]) >= 50:
                    at = seen.setdefault("\n".join(lines[a:b]), (r, b))
                    if at[0] < r or at[1] <= a:
                        gone |= set(range(a, b))
        out.append((doc, "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)))
    return out


def test_short_passages_go_whatever_surrounds_them(spark):
    rng = np.random.default_rng(5)
    line = lambda name, n: " ".join(f"{name}.{k}" for k in range(n))
    passages = []
    for n_lines in (2, 3, 4, 5, 6) * 3:
        at = len(passages)
        passages.append("\n".join([line(f"p{at}.{k}", 60 // n_lines + int(rng.integers(0, 9))) for k in range(n_lines)] + [""] * (at % 2)))
    rows = []
    for doc in range(60):
        parts = []
        for k in range(4):
            parts += [line(f"own{doc}.{k}", int(rng.integers(1, 9))), passages[int(rng.integers(0, len(passages)))]]
        rows.append((doc, "\n".join([*parts, f"end {doc}"])))
    rows.append((100, "\n".join(["ten words that are the same in all these lines"] * 16)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = line_chunks.remove(docs, whole=True).collect()
    expected = brute_passages(rows)
    assert sorted(map(tuple, got)) == expected and sum(n for _, _, n in expected) > 500
    # Each passage is left once, whole.
    left = "\n".join(r.text for r in got)
    assert all(left.count(p) == 1 for p in passages)


def test_passages_of_other_blanks_go(spark):
    for blank in "\t\r\x0b\x0c":
        text = blank.join(f"w{k}" for k in range(60))
        got = line_chunks.remove(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")).collect()
        assert sorted(map(tuple, got)) == [(1, text, 0), (2, "", 1)]


def test_length_cuts_count_from_the_last_cut():
    lengths = lambda t: line_chunks.chunks(pa.array([t]))["lines"].tolist()
    body = next(b for b in ("\n".join([f"same {k}"] * 200) for k in range(99)) if len(lengths(b)) == 4)
    long = " ".join(["long"] * 60)
    assert lengths(body) == [64, 64, 64, 8] and lengths(f"{long}\n{body}") == [1, 64, 64, 64, 8]
