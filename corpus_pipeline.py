"""From raw documents to token ids: quality rules, line dedup, near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the
columns of ``documents``; the last one returns token ids. ``run`` writes every stage's result to the
shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.llm.bpe import default_files, encode_column, sha256
from hitledger.llm.linededup import dedup_lines
from hitledger.llm.mixing import mix_documents
from hitledger.llm.neardup import near_duplicates
from hitledger.llm.quality import judge, trusted_ids
from hitledger.stages import shared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rules or the log-likelihood ratio reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, trusted_ids(labels)).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated chunks of lines; every document stays, with its new length."""
    cleaned = dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, similarity 0.8."""
    return near_duplicates(docs, size=5, percent=80).where("first").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in whole uses: none, one or two rows each."""
    mixed, _ = mix_documents(docs, whole=True)
    copies = F.sequence(F.lit(1).cast("long"), F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1))))
    repeated = mixed.where("taken > 0").withColumn("__copy", F.explode(copies))
    return repeated.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digests of the ids and of the text they decode to."""
    both = encode_column(docs, default_files(), decoded="decoded", keep=["doc_id", "source"])
    return both.select(
        "doc_id",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        sha256(F.col("ids")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("mix sources", mix_sources),
    ("encode", encode),
]
#: SQL can express neither the signatures' bands nor byte-level BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = shared(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
