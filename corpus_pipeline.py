"""The corpus pipeline: documents of good quality, one of each near-duplicate class, without benchmark text, with surrogates for personal data, as token ids."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.bpe import decode_documents, encode_documents
from barloom.llm.frames import fresh, kept_table
from barloom.llm.neardup import digest_of, text_classes
from barloom.llm.phrases import find_phrases
from barloom.llm.pii import replace_entities
from barloom.llm.quality import fit_quality, score_quality

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
KEY = os.environ.get("CORPUS_SURROGATE_KEY", "surrogates of the corpus pipeline")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels, doesn't reject. Empty texts get the share of label 1."""
    model = fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = fresh(docs, "quality_score")
    return score_quality(docs, model, out=score).where(F.col(score) >= 0.5).drop(score)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text that leads each near-duplicate class, in the row of its least doc_id; rows that repeat an id and text stay once, rows of classes without any id stay."""
    rows, classes = text_classes(docs)
    stay = kept_table(classes.where(F.col("leads") | F.col("class_id").isNull()).select("digest", "least"), "stay")
    own, own_id = fresh(docs, "own_digest"), fresh(docs, "own_id")

    def of(texts: DataFrame) -> DataFrame:
        texts = texts.select(F.col("digest").alias(own), F.col("least").alias(own_id))
        return docs.join(texts, (digest_of() == F.col(own)) & F.col("doc_id").eqNullSafe(F.col(own_id)), "left_semi")

    again = rows.where(F.col("doc_id").isNotNull()).groupBy("digest", F.col("doc_id").alias("least")).count().where(F.col("count") > 1)
    again = kept_table(stay.join(again, ["digest", "least"], "left_semi"), "again")
    if not again.take(1):
        return of(stay)
    alone = stay.join(again.select(F.col("digest").alias("other")), F.col("digest") == F.col("other"), "left_anti")
    return of(alone).unionByName(of(again).withColumn(own, digest_of()).dropDuplicates(["doc_id", own]).drop(own))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a run of ten words of any benchmark item (a shorter item: its whole run)."""
    row = fresh(docs, "row_key")  # written with the rows: each row's own verdict decides about it alone
    keyed = kept_table(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    found = find_phrases(keyed.select(F.col(row).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    hit = kept_table(found.where(F.col("n_hit") > 0).select(F.col("doc_id").alias(row)), "contaminated")
    return keyed.join(hit, row, "left_anti").select(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    return replace_entities(docs, KEY)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of all documents."""
    coded = encode_documents(docs.select("doc_id", "text"), TOKENIZER)
    return decode_documents(coded.drop("text"), TOKENIZER).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES = [("quality", quality), ("near_duplicates", near_dups), ("decontamination", decontaminated), ("pii", private), ("tokens", tokens)]
#: Nearest neighbours, signatures and digest-drawn surrogates aren't expressible in SQL; tests/llm hold brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = kept_table(docs, name)
    return docs
