"""One query for each corpus operator, with production parameters over the whole tables."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import decode_documents, encode_documents
from .frames import crc_of_id
from .hard_negatives import hard_negatives
from .language import fit_languages, identify
from .language_model import score_texts
from .neardup import near_duplicates
from .oracles import SQL as SQL
from .passages import remove_passages
from .phrases import find_phrases
from .pii import replace_entities
from .prefix_trie import conversation_trie
from .quality import fit_quality, score_quality
from .rules import judge
from .substrings import remove_substrings
from .wrappers import extract

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: Surrogates of one key can't be told from random without it; set your own.
KEY = os.environ.get("CORPUS_SURROGATE_KEY", "surrogates of the corpus pipeline")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_documents(table(spark, folder, "documents").select("doc_id", "text"), TOKENIZER)
    both = decode_documents(coded.drop("text"), TOKENIZER)
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_phrases(spark: SparkSession, folder: str) -> DataFrame:
    found = find_phrases(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    away = crc_of_id(F.col("doc_id")) % 5 == 0
    found = identify(docs, fit_languages(docs.where(~away)))
    return found.select("doc_id", away.alias("held_out"), "lang_pred", "score")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    away = crc_of_id(F.col("doc_id")) % 3 == 1
    scored = score_quality(docs.select("doc_id", "text"), fit_quality(docs, labels.where(~away)))
    return scored.select("doc_id", away.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    away = crc_of_id(F.col("doc_id")) % 7 == 2
    scored = score_texts(docs, ~away)
    return scored.select("doc_id", away.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    cut = remove_substrings(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return replace_entities(docs, KEY, counted="n_entities")


def op10_passages(spark: SparkSession, folder: str) -> DataFrame:
    cut = remove_passages(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, folder, "pages"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after every seventh label has moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return conversation_trie(table(spark, folder, "conversations"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_language": op2_language,
    "op3_quality": op3_quality,
    "op4_language_model": op4_language_model,
    "op5_suffix_array": op5_suffix_array,
    "op6_minhash": op6_minhash,
    "op7_phrases": op7_phrases,
    "op8_rules": op8_rules,
    "op9_pii": op9_pii,
    "op10_passages": op10_passages,
    "op11_wrappers": op11_wrappers,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}
