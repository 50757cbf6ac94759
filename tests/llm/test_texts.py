"""SentencePiece, token files and the language model: exact round trips and plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tripwright.llm import katz, queries, sentencepiece, token_files
from tripwright.llm import words as W

import pyarrow as pa
import re

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(spark, small):
    return {r.doc_id: r.text for r in queries.table(spark, small, "documents").select("doc_id", "text").collect()}


def test_words():
    given = ["ab  cD\n", "", "x", "\t ", None, "é|ü 日本 A", "q q", "end"]
    w = W.words(pa.array(given), lower=True)
    got = [[] for _ in given]
    for s, e, d in zip(w.start, w.end, w.doc):
        got[d].append(bytes(w.data[s:e]).decode())
    assert got == [WORD.findall((t or "").translate(LOWER)) for t in given]
    assert len(set(w.hashes().tolist())) == len({x for t in got for x in t})


@pytest.fixture(scope="module")
def model():
    return queries.public_file("piece_bpe_32k.model")


def test_encoding_is_the_library_s(spark, small, model):
    import sentencepiece as library

    own = sentencepiece.compile_model(model)
    other = library.SentencePieceProcessor(model_proto=model)
    odd = ["", " ", "  a", "a   b", "\n\n", "<s>", "▁▁x", "\x00a", "é日本語€😀", "hello     world", "x" * 300]
    for text in [*odd, *texts(spark, small).values()][:80]:
        ids = other.encode(text)
        assert own.encode(text) == ids
        assert own.decode(ids) == other.decode(ids)


def test_unigram_weights_take_the_shortest_path():
    own = sentencepiece.Transducer(1, ["<unk>", "a", "b", "ab", "abc", "c", "bc"], [2, 1, 1, 1, 1, 1, 1], [0, -1, -1, -1.5, -9, -1, -1.2], sentencepiece.Normaliser(False, False), False)

    def best(text):
        if not text:
            return 0.0
        return min(-own.score_of[p] + best(text[len(p) :]) for p in own.score_of if text.startswith(p))

    for text in ("a", "ab", "abc", "abcabc", "cab"):
        assert math.isclose(sum(-own.score_of[p] for p in own.path(text)), best(text))
    assert own.encode("azza") == [1, 0, 1]  # a run of unknown characters is one piece


def test_normaliser_replaces_the_longest_string():
    units = np.zeros(512, dtype=np.uint32)
    # "x" -> "yz": the root leads to 'x', whose leaf holds the place of the replacement.
    units[0] = 1 << 10
    units[1 ^ ord("x")] = (2 << 10) | 256 | ord("x")
    units[(1 ^ ord("x")) ^ 2] = 0x80000000
    own = sentencepiece.Normaliser(True, True, units, b"yz\0")
    assert own(" ax  x ") == "▁ayz▁yz"
    assert own("") == own(" ") == ""


def test_encode_odd_rows(odd, none, model):
    rows = sentencepiece.encode(odd, model, decoded=True).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.round_trip == ("▁" not in (r.text or "")) and (r.decoded == (r.text or "") or "▁" in r.text)
        assert (r.ids == []) == (not r.text)
    assert sentencepiece.encode(none, model).count() == 0


def test_token_files(spark, small, odd, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = queries.table(spark, small, "documents").select("doc_id", "text").unionByName(odd.where("doc_id < 3").select((F.col("doc_id") + 10**9).alias("doc_id"), "text"))
    folder = token_files.write(docs, path)
    got = {r.doc_id: r for r in token_files.digest(spark, folder).collect()}
    start = 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        assert tuple(got[r.doc_id])[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    wanted = docs.where("doc_id % 50 = 7").select("doc_id")
    read = {r.doc_id: r.ids for r in token_files.read_documents(spark, folder, wanted).collect()}
    assert set(read) == {r.doc_id for r in wanted.collect()}
    for r in docs.where("doc_id % 50 = 7").collect():
        assert read[r.doc_id] == tokenizer.encode(r.text, add_special_tokens=False).ids + [0]


def test_token_files_of_odd_rows(spark, odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = token_files.digest(spark, token_files.write(odd, path)).collect()
    assert len(rows) == odd.count()
    order = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in order] == list(np.cumsum([0] + [r.n_tokens for r in order])[:-1])
    assert order[0].doc_id is None  # null ids come first
    assert token_files.digest(spark, token_files.write(none, path)).count() == 0


ODD_TEXTS = [
    "", None, "É日本語 😀 <|endoftext|> ▁x <s> \x00 end", "a\u3000b \u2003 c\xa0d\x85 e\u1680\u1680f", "  \n\n x", " ", "\n", "x ", "<", "|a <| b",
    "tab\tx\r\ny \u2028z\u205f\u202f", "a\x1cb \x1f c", "'s don't  I'm 123 4567 ,,. \u200b z", "word " * 3000 + "x" * 5000, "à Ââ€ \xe2\x80",
]


def equal_to_library(encoder, texts):
    ids, begin = encoder.encode(texts)
    found = encoder.tokenizer.encode_batch(texts.fill_null("").to_pylist(), add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == [e.ids for e in found]


@pytest.mark.parametrize("collide", [False, True])
def test_chunks_are_cut_and_looked_up_on_bytes(monkeypatch, collide):
    hashes = token_files.W.span_hashes
    if collide:
        monkeypatch.setattr(token_files.W, "span_hashes", lambda *a: hashes(*a) % np.uint64(5))
    encoder = token_files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), most=20)
    texts = pa.array(ODD_TEXTS)
    for part in (texts, texts.slice(2, 6), texts.slice(0, 2), texts.slice(0, 0), pa.array([f"w{i} ö{i}\n" for i in range(100)]), texts):
        equal_to_library(encoder, part)


def test_a_chunk_is_encoded_once():
    """Also where there are many more of them than used to be kept."""
    encoder = token_files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    library, seen = encoder.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            seen.append(sum(len(t.split()) for t in texts))
            return library.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    blocks = [pa.array([f"x {' '.join(f'w{i}' for i in range(a, a + 50_000))}"]) for a in range(0, 400_000, 50_000)]
    first = [encoder.encode(b)[0] for b in blocks]
    assert sum(seen) == 400_001
    assert all(np.array_equal(encoder.encode(b)[0], ids) for b, ids in zip(blocks, first)) and sum(seen) == 400_001


def test_another_dictionary_is_refused(spark, small):
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = token_files.write(queries.table(spark, small, "documents").limit(30), path)
    other = token_files.Dictionary(b"other")
    spark.createDataFrame([("wrong", other.raw)], "dictionary string, raw binary").write.mode("overwrite").parquet(f"{folder}/dictionary")
    with pytest.raises(ValueError, match="dictionary"):
        token_files.digest(spark, folder)


@pytest.mark.parametrize("bucket_tokens", [katz.BUCKET_TOKENS, 3000])
def test_katz_against_plain_python(spark, small, bucket_tokens):
    docs = queries.table(spark, small, "documents")
    got = {r.doc_id: r for r in katz.score(katz.fit(docs, F.col("doc_id") % 7 != 2, bucket_tokens)).collect()}
    tokens = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in texts(spark, small).items()}
    uni, pairs, history = Counter(), Counter(), Counter()
    for i, w in tokens.items():
        if i % 7 != 2:
            uni.update(w), pairs.update(zip([0, *w[:-1]], w)), history.update([0, *w[:-1]])
    n = sum(uni.values())

    def factors(counts):
        c = Counter(counts.values())
        return katz.discounts([0] + [c[r] for r in range(1, 7)])

    du, dp = factors(uni), factors(pairs)
    share = lambda d, c: (1.0 if c > 5 else d[c]) * c
    unknown = 1 - sum(share(du, c) for c in uni.values()) / (n + 1)
    p = lambda w: share(du, uni[w]) / (n + 1) if uni[w] else unknown
    after = defaultdict(list)
    for (h, w), c in pairs.items():
        after[h].append((w, c))
    alpha = {h: (1 - sum(share(dp, c) for _, c in s) / (history[h] + 1)) / (1 - sum(p(w) for w, _ in s)) for h, s in after.items()}
    for i, w in tokens.items():
        score = sum(
            math.log10(share(dp, pairs[h, x]) / (history[h] + 1)) if pairs[h, x] else math.log10(alpha.get(h, 1) * p(x))
            for h, x in zip([0, *w[:-1]], w)
        )
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(uni[x] > 0 for x in w), n)
        assert math.isclose(r.score, score, rel_tol=1e-9)
        assert math.isclose(r.base_score, sum(math.log10((uni[x] + 1) / (n + len(uni) + 1)) for x in w), rel_tol=1e-9)
    # Probabilities of all known tokens and the unknown one sum to one after any history.
    for h in list(after)[:20]:
        total = sum(share(dp, pairs[h, w]) / (history[h] + 1) if pairs[h, w] else alpha[h] * p(w) for w in uni) + alpha[h] * unknown
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_katz_tables_and_odd_rows(spark, small, odd, none):
    docs = queries.table(spark, small, "documents")
    fitted = katz.fit(docs, F.lit(True))
    assert fitted.bigrams().agg(F.sum("count")).first()[0] == fitted.uni.tokens
    assert fitted.unigrams().where("count > 0").count() == fitted.uni.types
    rows = katz.score(katz.fit(odd, F.col("doc_id") != 5)).collect()
    assert len(rows) == odd.count() and all(r.score <= 0 and r.n_tokens >= 1 for r in rows)
    assert [r.train for r in rows if r.doc_id is None] == [True]
    assert katz.score(katz.fit(none, F.lit(True))).count() == 0
    untaught = katz.score(katz.fit(odd, F.lit(False))).collect()
    assert {r.score for r in untaught} == {0.0} and {r.n_known for r in untaught} == {0}
