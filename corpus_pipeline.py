"""A corpus pipeline of the text operators, one stage after the other.

Each stage takes the documents that the one before it kept. The first four give documents
again, the last one gives the packed pieces. Rows with a null id or text pass the filters as
the operators' docstrings say; an empty table stays empty; columns that documents don't have
are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystream.llm import decontaminate, minhash, packing, substring, toxicity
from paystream.llm.common import held_out, keep_rows, shipped, table
from paystream.session import work_dir

#: Scores from which a document is rejected.
TOXIC = 0.7
#: Words in a row that a repeated passage has at least.
PASSAGE = 50
#: Bytes of text that a worker looks for repeats in at once; the JVM is at its largest by then.
REPEAT_BYTES = 2_000_000


def documents(frame: DataFrame) -> DataFrame:
    """Just the columns of documents."""
    return frame.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )


@shipped
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the limit; learned from the labels of the training rows."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    shared = spark.sparkContext.broadcast(toxicity.train(docs, labels))

    def clean(texts: list[str]) -> list[bool]:
        model = shared.value
        return [model.probability(model.evidence(model.passages(toxicity.words_of(x)))) < TOXIC for x in texts]

    return keep_rows(documents(docs), clean)


@shipped
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies (five words, 0.8)."""
    return minhash.first_rows(documents(docs))


@shipped
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has."""
    rows = documents(docs)
    left = substring.deduplicate(rows, window=PASSAGE, carry=("lang", "source"), task_bytes=REPEAT_BYTES)
    return documents(left.withColumn("n_chars", F.length("text")))


@shipped
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without copies of benchmark items."""
    return decontaminate.remove(documents(docs), table(spark, sf_dir, "benchmark"))


@shipped
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
#: Learned scores, alignments and tokens are not for SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is a table that the next stage reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
