"""The operators' registered queries: each applies its operator with
production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, oracle, packing
from .chat import conversation_digests, format_windows
from .common import table
from .extract import extract
from .extract import train as train_extractor
from .hard_negatives import labelled_vectors, mine
from .labelled_pages import labelled_pages
from .langid import predict, train
from .line_dedup import line_dedup
from .mixing import mix_report
from .prefix_trie import prefix_trie, turn_sequences, with_shared_heads
from .quality import quality_rules
from .simhash import hex_fingerprint, simhash_groups
from .substring import substring_dedup
from .topk import top_products

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op3_quality_rules", oracle.quality_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                             "base_failed", "kept")])


@register("op5_line_dedup", oracle.line_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "lines.n_lines", "lines.n_shared", "lines.n_removed", "text")


@register("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), hex_fingerprint(F.col("fp")).alias("fingerprint"),
                         F.col("component").alias("component_id"))


@register("op2_source_mix", oracle.mix_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@register("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), bpe.load(spark), decoded=True)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(bpe.id_text(F.col("ids")), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op9_substring_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    model = train(docs.where(~held_out))
    return predict(docs, model, keep=("doc_id", held_out.alias("held_out")))


@register("op8_chat_format", oracle.chat_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok").alias("text")
    turns = [F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(n).cast("long").alias("turn"), F.lit(role).alias("role"), said)
             for n, role in enumerate(("user", "assistant"))]
    more = spark.range(1).select(F.inline(F.array(*turns)))
    return conversation_digests(format_windows(chats.unionByName(more)))


@register("op10_topk_products", oracle.topk_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors.where(F.col("vec_id") % 50 == 0), vectors)


@register("op4_html_extract")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = spark.createDataFrame([(p,) for p in labelled_pages()], "html string")
    texts = extract(table(spark, sf_dir, "pages"), train_extractor(labelled))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op11_best_fit_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.load(spark), digest=F.crc32("ids").alias("ids_crc32"))


@register("op13_prefix_trie", oracle.trie_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie(with_shared_heads(turn_sequences(table(spark, sf_dir, "conversations"))))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@register("op12_hard_negatives", oracle.negatives_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = labelled_vectors(table(spark, sf_dir, "embeddings"), label=label)
    return mine(vectors.withColumn("anchor", F.col("id") % 100 == 0))
