"""Corpus pipeline: language, quality, near copies, repeated passages, packing.

Each stage takes the documents its predecessor kept and calls one operator of
``tickframe.llm``.  All stages but the last return the columns of documents.
``run`` writes each stage's result to the shared folder before the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import common, language, near_dup, packing, quality, substring_dedup


def _plain(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all but the used columns under names that no operator has, and the way back."""
    names = {c: c if c in used else f"__c{k}" for k, c in enumerate(docs.columns)}
    out = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return out, lambda df: df.select(*[F.col(f"`{n}`").alias(c) for c, n in names.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with at least the calibrated score."""
    model = language.train(docs)
    rows, back = _plain(docs, "text")
    out = language.predict(rows, model)
    return back(out.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= model.threshold)))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the threshold table."""
    return quality.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the least id.

    Documents without an id are no one's copies and stay.
    """
    found = near_dup.near_duplicates(docs, shingle=5, percent=80)
    drop = found.filter("NOT kept").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the passages that an earlier document has; those with nothing left go.

    ``n_chars``, where there is one, follows the text.
    """
    rows, back = _plain(docs, "doc_id", "text")
    out = substring_dedup.remove_repeats(rows).filter("n_removed = 0 OR n_removed < n_words")
    if "n_chars" in docs.columns:
        name = f"__c{docs.columns.index('n_chars')}"
        out = out.withColumn(name, F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(name)))
    return back(out)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences."""
    import public_tokenizers

    out = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to")


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring),
    ("packing", pack),
]

#: Language ID is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.write_scratch(docs, "stage")
    return docs
