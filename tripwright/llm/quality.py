"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Each rule looks at counts of one whole text and votes good (1), bad (-1) or abstains (0). How often it
does so on good and on bad texts, and with it how often its votes are right, is unknown.
Expectation-maximisation over *vote patterns* estimates that and the share of good texts, without any
label. Texts with
equal patterns have equal posteriors, so one aggregate (at most 3 ** len(RULES) rows, whatever the
size of the corpus) holds all that EM needs, and it is exact over all rows.

Defined cases: a null or empty text has no words, all counts 0, and fails the base rules. Rows are
judged one by one, so repeated rows get equal results; a null doc_id is passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm import words as W
from tripwright.llm.tables import written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_marks", "n_top_word")
_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!?")] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return np.diff(sums[offsets])


def _repeated(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each entry: 0 if unlike all others of its text, 1 if the first of equal ones, 2 if a later one."""
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    same = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    out = np.zeros(len(doc), dtype=np.int8)
    out[order[:-1][same]] = 1
    out[order[1:][same]] = 2
    return out


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text."""
    w = W.words(texts)
    n, data, offsets = w.n_docs, w.data, w.offsets
    black = ~W._WHITE[data]
    out = {
        "n_words": w.counts(),
        "word_chars": _per_text(black & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_letters": _per_text(_LETTER[data], offsets),
        "n_upper": _per_text(_UPPER[data], offsets),
        "n_marks": _per_text(_MARK[data], offsets),
    }
    # Of all lines, the ones with a word.
    line_doc, start, end = W.lines(data, offsets)
    seen = np.concatenate(([0], np.cumsum(black)))
    worded = seen[end] > seen[start]
    line_doc, start, end = line_doc[worded], start[worded], end[worded]
    again = _repeated(line_doc, W.span_hashes(data, start, end)) == 2
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = np.bincount(line_doc[again], minlength=n)
    hashes = w.hashes()
    at, value = W.windows(w.doc, hashes, 3)
    at = at[_repeated(w.doc[at], value) > 0]
    covered = np.zeros(len(hashes), dtype=bool)
    for k in range(3):
        covered[at + k] = True
    out["n_repeat_words"] = np.bincount(w.doc[covered], minlength=n)
    # The most frequent word of each text.
    order = np.lexsort((hashes, w.doc))
    d, h = w.doc[order], hashes[order]
    begin = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])))) if len(d) else np.zeros(0, int)
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, d[begin], np.diff(np.append(begin, len(d))))
    out["n_top_word"] = top
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in W.blocks(batches, "text"):
        counts = text_counts(W.column(block, "text"))
        arrays = [W.column(block, "doc_id").cast(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            arrays + [pa.array(counts[c].astype(np.int64)) for c in COUNTS], ["doc_id", *COUNTS]
        )


def document_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``COUNTS`` of every whole text."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_count_batches, _SCHEMA)


def _rule(bad: str, good: str = "false") -> str:
    return f"case when n_words = 0 then 0 when {bad} then -1 when {good} then 1 else 0 end"


#: Name and vote of each rule, as SQL over a text's counts.
RULES = {
    "symbols": _rule("n_symbols > 0.1 * n_words", "n_symbols < 0.02 * n_words"),
    "symbol_heavy": _rule("n_symbols > 0.5 * n_words"),
    "repeats": _rule("n_repeat_words > 0.3 * n_words"),
    "lines_again": _rule("n_dup_lines > 0.5 * n_lines"),
    "word_length": _rule("word_chars not between 2.5 * n_words and 12 * n_words"),
    "capitals": _rule("n_upper > 0.5 * n_letters", "n_letters > 0 and n_upper < 0.2 * n_letters"),
    "marks": _rule("n_marks > 0.3 * n_words"),
    "one_word": _rule("n_words >= 50 and n_top_word > 0.25 * n_words", "n_words >= 20 and n_top_word < 0.15 * n_words"),
}


@dataclass(frozen=True)
class Weights:
    """``table[rule, class, vote + 1]``: how often a rule casts a vote on bad (0) and good (1) texts;
    ``good``: the share of good texts."""

    table: np.ndarray
    good: float
    rounds: int

    def accuracy(self) -> np.ndarray:
        """For each rule, the probability that a vote it casts is right."""
        share = np.array([1 - self.good, self.good])
        right = share[0] * self.table[:, 0, 0] + share[1] * self.table[:, 1, 2]
        return right / (share[None, :, None] * self.table[:, :, [0, 2]]).sum((1, 2))

    def evidence(self) -> np.ndarray:
        """``[rule, vote + 1]``: what a vote adds to the log odds of a good text."""
        return np.log(self.table[:, 1] / self.table[:, 0])

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        ways = self.evidence()[np.arange(votes.shape[1]), votes + 1]
        return np.log(self.good / (1 - self.good)) + ways.sum(1)


#: Start of EM: good texts rarely get a bad vote; good votes and abstentions tell nothing yet.
START = np.array([[0.3, 0.35, 0.35], [0.02, 0.49, 0.49]])
START_GOOD = 0.8


def fit(votes: np.ndarray, n: np.ndarray, rounds: int = 200, tolerance: float = 1e-9) -> Weights:
    """EM over vote patterns (rows of -1, 0, 1), each held by ``n`` texts.

    Votes of different rules are independent given the class. A bad vote stays evidence against a
    text: its share among good texts is held at or below its share among bad ones, so the classes
    cannot swap. Without texts the start is returned.
    """
    m = votes.shape[1]
    now = Weights(np.repeat(START[None], m, axis=0), START_GOOD, 0)
    total = n.sum()
    if not total:
        return now
    cast = np.stack([votes == v for v in (-1, 0, 1)], axis=2)  # pattern, rule, vote
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(now.log_odds(votes), -60, 60)))
        held = np.stack([n * (1 - p), n * p])  # class, pattern
        counts = np.einsum("cp,prv->rcv", held, cast) + START[None]
        table = counts / counts.sum(2, keepdims=True)
        bad_vote = np.minimum(table[:, 1, 0], table[:, 0, 0])
        table[:, 1, 1:] *= ((1 - bad_vote) / (1 - table[:, 1, 0]))[:, None]
        table[:, 1, 0] = bad_vote
        good = float((held[1].sum() + START_GOOD) / (total + 1))
        moved = max(np.abs(table - now.table).max(), abs(good - now.good))
        now = Weights(table, good, k)
        if moved < tolerance:
            break
    return now


def judge(docs: DataFrame, rules: dict[str, str] = RULES, threshold: float = 0.5) -> DataFrame:
    """Counts, votes, ``posterior`` (probability that the text is good) and ``good`` of every document.

    The counts are stored once in the shared folder; EM reads their patterns, the result reads them all.
    """
    names = list(rules)
    vote = {r: F.expr(sql) for r, sql in rules.items()}
    # A pattern as one number in base 3, so that it is a cheap key.
    code = sum(((vote[r] + 1) * 3**i for i, r in enumerate(names)), F.lit(0)).cast("int")
    counts = written(document_counts(docs), "quality-counts").withColumn("_pattern", code)
    rows = counts.groupBy("_pattern").count().orderBy("_pattern").collect()  # 3 ** len(rules) at most
    codes = np.array([r[0] for r in rows], dtype=np.int64)
    votes = (codes[:, None] // 3 ** np.arange(len(names))) % 3 - 1
    weights = fit(votes, np.array([r[1] for r in rows], dtype=float))
    evidence = weights.evidence()
    odds = F.lit(float(np.log(weights.good / (1 - weights.good))))
    for i, r in enumerate(names):
        odds = odds + F.element_at(F.array(*map(F.lit, evidence[i].tolist())), vote[r] + 2)
    posterior = 1 / (1 + F.exp(-odds))
    return (
        counts.drop("_pattern")
        .withColumns({f"vote_{r}": vote[r].cast("int") for r in names} | {"posterior": posterior})
        .withColumn("good", F.col("posterior") >= threshold)
    )
