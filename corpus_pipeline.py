"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; the runner writes it and reads it again as the
next one's ``docs``. All but the last return the columns of ``documents``.

1. toxicity: documents that the classifier calls toxic go.
2. line dedup: repeated passages are cut out of the texts; the documents stay, also those left empty.
3. n-gram Jaccard join: of each group of near copies (five words, 0.8) the one of the smallest id stays.
4. mixing: sources, and languages as a classifier finds them in the texts, are weighed by the power 0.7 of their
   tokens, while good and poor texts keep their shares; documents that should weigh more occur more than once,
   and none is lost.
5. SentencePiece: ids of every text, and whether they decode to it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import line_chunks, mixing, ngram_jaccard, queries, sentencepiece, toxicity
from tripwright.llm.tables import written

#: Columns of ``documents``; stages keep any others too.
TEXT = "text"


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` after the text has changed."""
    return docs.withColumn("n_chars", F.char_length(TEXT).cast("long")) if "n_chars" in docs.columns else docs


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = queries.table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.labelled(docs, labels))
    return toxicity.score(docs, model).where("score < 0.5").drop("score")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_length(line_chunks.remove(docs, whole=True).drop("n_lines_removed"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_jaccard.join(docs, size=5, num=80, den=100)
    # Rows that go: those that have links and are not the first of their component.
    copies = found.where("n_links > 0 and doc_id is not null")
    first = F.col("doc_id") == F.col("component_id")
    gone = copies.where(~first).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    # Rows that repeat an id are copies of each other only where they have links.
    again = copies.where(first).groupBy("doc_id").count().where("count > 1").select("doc_id")
    twice = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(again, "doc_id", "left_anti").unionByName(twice).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(docs, queries.mixture_of(docs, queries.table(spark, sf_dir, "labels"), grow=True))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.public_file("piece_bpe_32k.model")
    return sentencepiece.encode(docs.select("doc_id", TEXT), model).select("doc_id", F.size("ids").alias("n_pieces"), "ids", "round_trip")


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", pieces),
]

#: Training, language classification and encoding are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
