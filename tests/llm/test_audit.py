"""Phrases, threshold search and the filter audit against brute force, odd rows and empty tables."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwright.llm import filter_audit, phrases, threshold_topk

# Phrases


def brute_phrases(rows, longest, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    kept = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in kept.items():
        inside = any(
            lang == other and len(long) > len(words) and b >= a and any(long[i : i + len(words)] == words for i in range(len(long)))
            for (other, long), b in kept.items()
        )
        if not inside:
            n = totals[lang]
            cuts = [(1000 * a * n // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]], n))
    return sorted(
        (lang, i + 1, phrase.decode(), -a, left, right, n, -score)
        for lang, found in out.items() for i, (score, a, phrase, left, right, n) in enumerate(sorted(found)[:top])
    )


def mined(docs, **options):
    return sorted(map(tuple, phrases.mine(docs, **options).collect()))


TEXTS = [
    ("en", "The cat sat on the mat. the cat sat, the CAT sat on\tthe mat!"),
    ("en", "a a a a a a b a a\na a"),
    (None, "the cat sat on the mat"),
    ("und", "the cat sat on the mat; É cat\x0bsat É cat sat"),
    ("en", None),
    ("fr", ""),
    ("en", " \t .,; "),
] * 3


@pytest.mark.parametrize("per_trie", [3, 1 << 18])
def test_phrases_by_brute_force(spark, per_trie):
    rows = [(1, t, lang) for lang, t in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    docs = docs.withColumns({c: F.lit("x") for c in ("gram", "n", "name", "codes", "chunk")})
    for longest, least, top in ((5, 4, 2000), (3, 2, 5)):
        found = mined(docs, longest=longest, least=least, top=top, per_trie=per_trie)
        assert found == brute_phrases(TEXTS, longest, least, top) and found


def test_phrases_of_odd_and_empty_tables(odd, none):
    assert mined(none) == []
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert mined(odd) == brute_phrases(rows, 5, 100, 2000)
    assert mined(odd, least=10**6) == []


def test_candidates_are_the_frequent_phrases_however_large_the_corpus(spark, monkeypatch):
    """As many words as fill counters of fixed size many times over: tries get no phrase that is not frequent."""
    monkeypatch.setattr(phrases, "BITS", 15)
    random, least = np.random.default_rng(9), 4
    texts = [" ".join(f"w{k}" for k in random.integers(0, 700, 500)) + ". one two three four" for _ in range(400)]
    got, tries = [], phrases.tries
    monkeypatch.setattr(phrases, "tries", lambda grams, per_trie: got.append(grams.count()) or tries(grams, per_trie))
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(3)
    found, _, _ = phrases.frequent(docs, least=least)
    counts = Counter(
        tuple(words[i : i + k]) for t in texts for piece in t.split(". ") for words in [piece.split()] for k in range(1, 6) for i in range(len(words) - k + 1)
    )
    kept = Counter((len(words), a) for words, a in counts.items() if a >= least)
    assert Counter((r["size"], r["f"]) for r in found.collect()) == kept
    assert got == [sum(n for (size, _), n in kept.items() if size > 1)] and got[0] > 100


def test_trie_counts_like_a_dictionary():
    random = np.random.default_rng(2)
    codes = random.integers(1, 700, 20_000, dtype=np.uint64) ** np.uint64(3)
    codes[random.integers(0, len(codes), 900)] = 0
    grams = {codes[i : i + k].tobytes() for k in (1, 2, 3, 5) for i in range(0, 8000, 3) if codes[i : i + k].all()}
    grams |= {codes[i : i + 2].tobytes() for i in range(8000) if codes[i] == codes[5] and codes[i + 1]}  # a node of many children
    listed = sorted(grams)
    trie = phrases.Trie.from_bytes(phrases.Trie.build(listed).to_bytes())
    found = Counter()
    for rows in trie.walk(codes, np.arange(len(codes))):
        found.update(listed[r] for r in rows.tolist())
    wanted = Counter(g for k in (1, 2, 3, 5) for i in range(len(codes) - k + 1) if (g := codes[i : i + k].tobytes()) in grams)
    assert found == wanted


# Threshold search


def brute_topk(rows, top):
    fine = [(i, np.floor(1024 * np.array(x, dtype=float)).astype(int)) for i, x in rows if i is not None and x is not None and None not in x and np.isfinite(np.array(x, dtype=float)).all()]
    out = []
    for q in sorted({i for i, _ in fine if i % 100 == 0}):
        y = min((x.tolist() for i, x in fine if i == q))
        scored = sorted((-sum(a * b for a, b in zip(x.tolist(), y)), i) for i, x in fine if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:top], 1)]
    return out


@pytest.mark.parametrize("shard", [16, 8192])
def test_topk_by_brute_force(spark, shard):
    """Random vectors, a third of them copies, an id in several rows, odd vectors."""
    random = np.random.default_rng(4)
    rows = [(int(i * 10), random.normal(0, 1, 6).round(3).tolist()) for i in range(90)]
    rows += [(int(5 + i * 10), [0.5, -0.5, 0.25, 0.0, 0.0, 1.0]) for i in range(45)]
    rows += [(100, [1.0] * 6), (100, [-1.0] * 6), (7, []), (8, [0.0] * 6), (9, [3.0, 2.0]), (None, [9.0] * 6), (11, None)]
    rows += [(12, [None] + [9.0] * 5), (13, [float("nan")] * 6), (14, [float("inf")] * 6), (1000, []), (2000, [0.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.withColumns({c: F.lit("x") for c in ("x", "score", "shard", "block", "rank")}).repartition(3)
    found = threshold_topk.search(frame, F.col("vec_id") % 100 == 0, shard=shard, block=4)
    assert sorted(map(tuple, found.collect())) == sorted(brute_topk(rows, 10))


def test_topk_of_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert threshold_topk.search(frame, F.col("vec_id") % 100 == 0).collect() == [(0, 1, 1, 1024 * 2048)]
    assert threshold_topk.search(frame.limit(0), F.col("vec_id") % 100 == 0).isEmpty()


def test_walk_stops_early_where_it_can():
    """Few dimensions rule: most vectors are never scored; the answer is that of a full scan."""
    random = np.random.default_rng(6)
    x = (random.pareto(1.5, (5000, 4)) * 100).astype(np.int64)
    lists = threshold_topk.Lists(np.arange(5000), x)
    query = np.array([900, 3, 0, 0])
    met, score, scored = lists.best(-1, query, 10)
    wanted = np.lexsort((np.arange(5000), -(x @ query)))[:10]
    assert met.tolist() == wanted.tolist() and scored < 1000
    with pytest.raises(OverflowError):
        threshold_topk.Lists(np.arange(2), np.full((2, 2), 1 << 40)).best(-1, np.array([1 << 40, 1]), 1)


# Filter audit


def brute_audit(docs, labels):
    first = {}
    key = lambda i: (i is None, i or 0)
    for i, text, _ in docs:
        first[text or ""] = min(first.get(text or "", (True, 1)), key(i))
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    fails = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        mask = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": first[text] < key(i),
        }
        fails.append((lang or "", {f for f, x in mask.items() if x}, i in good, i in toxic))
    out, removals = [], Counter()
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                removals[part, f] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), sum(f in x[1] for x in own) - len(gone), sum(x[1] == {f} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone)))
    return sorted((*row, removals[row[0], row[1][row[2] - 1]]) for row in out)


def test_audit_by_brute_force(spark, odd):
    docs = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    many = " ".join(f"word{i}" for i in range(250))
    docs += [(20 + i, many + " " * (i % 3), ("en", "fr", None)[i % 3]) for i in range(12)]
    docs += [(None, many, "en"), (None, "only null ids", "en"), (None, "only null ids", "en"), (40, "A B C $ " * 60, "de"), (41, "Ä&é " * 300, "de")]
    labels = [(20, 1, 0), (20, 0, 1), (21, 1, None), (22, None, 1), (None, 1, 1), (40, 1, 1), (6, 1, 0), (999, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({c: F.lit("x") for c in ("part", "mask", "good", "n", "digest")})
    found = filter_audit.audit(frame.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, found.collect())) == brute_audit(docs, labels)


def test_audit_of_nothing(spark, none):
    assert filter_audit.audit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).isEmpty()


def test_diagrams_of_every_order():
    """Swaps lead through all orders, and a swapped diagram equals one that is built in that order."""
    random = np.random.default_rng(1)
    weights = {int(m): (int(random.integers(1, 50)), int(m) % 3) for m in random.integers(0, 32, 20)}
    diagram = filter_audit.Diagram(weights, 5)
    seen = {tuple(diagram.order)}
    for at in filter_audit.plain_changes(5):
        diagram.swap(at)
        seen.add(tuple(diagram.order))
        place = {v: i for i, v in enumerate(diagram.order)}
        turned = {sum(1 << place[v] for v in range(5) if m >> v & 1): w for m, w in weights.items()}
        fresh = filter_audit.Diagram(turned, 5)
        assert [len(level) for level in diagram.nodes] == [len(level) for level in fresh.nodes]
        assert [x[1:] for x in diagram.all_pass()] == [x[1:] for x in fresh.all_pass()]
    assert len(seen) == 120
