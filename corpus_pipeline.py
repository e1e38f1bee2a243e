"""A corpus pipeline of five stages over ``documents``: quality, line dedup, near-duplicates,
mixing, packing. Every stage works on all that its predecessor kept; all but the last return the columns
of documents, whatever further ones there are. Null texts are empty ones to the classifier, stay null in
line dedup and near-duplicates, have no words to the mix, and are packed as an end id. Rows with a
null id are kept by all stages but the classifier, which judges them by their text. An
empty table gives empty tables. A document whose text line dedup removes whole goes on with an empty one, and is packed as an end id. How ties and repeated rows count is said at each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import linededup, mixing, neardup, packing, quality
from sigloom.llm.common import keys, stored
from sigloom.session import ship


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; learned from all labels and the documents given."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accept(docs, quality.train(quality.feature_table(docs, []), labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur before; n_chars follows the text."""
    ship(spark)
    out = linededup.dedup_passages(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): of rows that
    repeat the id that stays, the one with the least text. Rows with a null id stay."""
    ship(spark)
    groups = neardup.near_duplicates(docs).where("doc_id is not null")
    groups = stored(groups.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times")), "groups")
    dropped = groups.where("not kept or times > 1").select("doc_id")
    single = docs.join(keys(dropped), "doc_id", "left_anti").select(*docs.columns)
    again = docs.join(keys(groups.where("kept and times > 1").select("doc_id")), "doc_id", "left_semi")
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    firsts = again.groupBy("doc_id").agg(F.min(F.struct(F.col("text"), *rest)).alias("row"))
    return single.union(firsts.select(*[F.col("doc_id") if c == "doc_id" else F.col("row")[c].alias(c) for c in docs.columns]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ship(spark)
    return mixing.emit_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their ids; executors hold other stages' workers, so that the memo is half as large."""
    ship(spark)
    return packing.pack_documents(docs, memo_units=500_000).withColumnRenamed("payload", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Classifier, tokenizer and hash-seeded draws are beyond SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
