"""A cleaning pipeline over documents: toxicity, near-duplicates, benchmark decontamination, personal data, BPE round trip.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of documents; the last
one returns what was encoded. Between stages the rows are written as Parquet to the session's shared checkpoint folder.

Defined results, in every stage: null and empty texts are kept (their score is that of no evidence, they have no copies, hits,
spans or ids); long texts are worked on whole; rows with null or repeated ids are rows like others; an empty table gives an empty
result; columns other than those of documents are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontam, neardup, pii, toxicity
from ledgerloom.llm.common import cut, ensure_checkpoint_dir, remove, table
from ledgerloom.llm.queries import tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: The rows depend on trained models and a tokenizer, which SQL can't express; tests hold them against plain Python.
ORACLE_SQL = None


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored THRESHOLD or more go; the classifier learns from the labels of sf_dir."""
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), keep=COLUMNS)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(F.col("id").alias("doc_id"), *COLUMNS[1:])


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies (five-word shingles, similarity 0.8) stays: the smallest id.

    Rows with null or repeated ids each take part for themselves, under numbers above all ids, in the order of id and text; they
    come out with the ids they had.
    """
    docs = docs.select(*COLUMNS)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    plain, odd = docs.withColumn("row", F.col("doc_id").cast("long")), docs.where("doc_id is null")
    if not repeated.isEmpty():
        repeated = cut(repeated)
        odd = odd.unionByName(docs.join(repeated, "doc_id", "left_semi").select(*COLUMNS))
        plain = plain.join(repeated, "doc_id", "left_anti").select(*COLUMNS, "row")
    if not odd.isEmpty():
        most = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("long")).first()[0]
        named = odd.repartitionByRange(*COLUMNS).sortWithinPartitions(*COLUMNS).withColumn("row", F.lit(most) + 1 + F.monotonically_increasing_id())
        plain = plain.where("doc_id is not null").unionByName(cut(named))  # written, so that the numbers stay the same
    found = neardup.near_duplicates(plain, id_col="row", width=5, percent=80)
    gone = found.where(~F.col("kept")).select(F.col("id").alias("row"))
    return plain.join(gone, "row", "left_anti").select(*COLUMNS)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    found = decontam.hits(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS[2:])
    return found.where(F.size("ranges") == 0).select(F.col("id").alias("doc_id"), "text", *[F.col(f"kept_{c}").alias(c) for c in COLUMNS[2:]])


def personal_data_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind in brackets."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and the text decoded from them."""
    return bpe.encode_decode(docs, tokenizer("byte_bpe_50k.json"), keep=("lang", "source", "n_chars"))


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_copies_out),
    ("decontamination", benchmark_out),
    ("personal_data", personal_data_masked),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again. A stage's rows go when the next one's are written;
    those of the last stay, as the result reads them."""
    folder, before = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}", None
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:
            remove(spark, before)
        before = f"{folder}/{name}"
    return docs
