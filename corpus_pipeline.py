"""From raw documents to token ids: quality rules, line dedup, near-duplicate
removal, source mixing, byte-level BPE.

Each stage reads all rows that the stage before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextcat.llm import bpe
from nextcat.llm.common import text_of
from nextcat.llm.line_dedup import drop_shared_lines
from nextcat.llm.mixing import mixed_documents
from nextcat.llm.quality import keep_good
from nextcat.llm.simhash import drop_near_copies
from nextcat.session import scratch_path
from nextcat.sources.io import remove


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources share."""
    return drop_shared_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document copy that the mix takes."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the SHA-256 of the decoded ids of every copy, and
    whether they decode to the text's bytes."""
    texts = docs.select(F.struct("doc_id", F.sha2(text_of("text").cast("binary"), 256).alias("sha256")).alias("doc"), "text")
    encoded = bpe.encode(texts, bpe.load(spark), id_col="doc", decoded=True)
    digest = F.sha2("decoded", 256)
    return encoded.select("doc.doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", digest.alias("decoded_sha256"),
                          (digest == F.col("doc.sha256")).alias("round_trip"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("SimHash near-dedup", near_copies),
          ("mixing sources to target weights", mix), ("byte-level BPE", tokens)]

#: The tokenizer stage has no SQL form; tests hold the whole run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again; what
    a stage has read is removed once its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
