"""The corpus pipeline: documents to a mixed, deduplicated, tokenised corpus.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import exact_dedup, mixing, near_dedup, quality, sentencepiece_text
from pricelens.llm.common import bound_batches, scratch_dir, stage
from pricelens.llm.filters import fresh, split_by_keys
from pricelens.llm.queries import PIECES, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "quality")
    return quality.keep_good(docs, labels)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest id stays."""
    bound_batches(spark)
    return exact_dedup.exact_dedup(docs).where("kept").select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or
    more) the document with the smallest id stays; one without an id stays."""
    bound_batches(spark)
    # few documents go, so the others need not be shuffled to be found
    name, = fresh(docs, "_gone")
    gone = stage(near_dedup.near_dedup(docs.select("doc_id", "text")).where("not kept and doc_id is not null").select(F.col("doc_id").alias(name)), "near-gone")
    some, clean = split_by_keys(docs, "doc_id", gone, gone.count())
    return clean.unionByName(some.join(gone, F.col("doc_id") == F.col(name), "left_anti"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weighed 1, 2, 3, ...: documents left out, or repeated."""
    bound_batches(spark)
    return mixing.mix_rows(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's SentencePiece ids, and whether they decode to its text."""
    bound_batches(spark)
    path = tokenizer_path(PIECES)
    out = sentencepiece_text.round_trip(docs, path)
    same = F.col("decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit(sentencepiece_text.MARK), F.lit(" "))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_pieces"), "ids", same.alias("same_text"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mix_stage),
    ("sentencepiece", encode_stage),
]

# A trained classifier cannot be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES:
        path = scratch_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
