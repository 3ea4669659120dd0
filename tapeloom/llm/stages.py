"""The operators as stages of a corpus pipeline: documents in, documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import bpe, decontaminate, near, paragraphs, quality
from tapeloom.llm.frames import remainder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the labels of `sf_dir` teach."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 5) != 0)
    scored = quality.score(docs, model, keep=tuple(COLUMNS[1:]))
    return scored.filter(F.col("score") >= quality.THRESHOLD).select(COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """The documents' columns and a `row_key` of id and text: neither says alone which row it is."""
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    return docs.select(COLUMNS).withColumn("row_key", key)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the smallest id, rows without one last.

    Rows that share an id but no text are documents of their own; repeated rows stay once.
    """
    rows = keyed(docs)
    classes = near.near_duplicates(rows, id_col="row_key").select(F.col("doc_id").alias("row_key"), "class_id").distinct()
    ids = rows.select("row_key", "doc_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first")
    kept = ids.join(classes, "row_key").groupBy("class_id").agg(first).select("first.row_key")
    return rows.join(kept, "row_key").dropDuplicates(["row_key"]).select(COLUMNS)


def without_repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without paragraphs and passages that an earlier place has; a text of which nothing stays goes."""
    cut = paragraphs.without_repeats(docs.select(COLUMNS))
    return (
        cut.filter((F.col("n_cut") == 0) | (F.col("text") != ""))
        .withColumn("n_chars", F.when(F.col("n_cut") == 0, F.col("n_chars")).otherwise(F.length("text")))
        .select(COLUMNS)
    )


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; only the rows that hold one go."""
    rows = keyed(docs)
    found = decontaminate.leaks(rows, table(spark, sf_dir, "benchmark"), id_col="row_key")
    found = found.select(F.col("doc_id").alias("row_key")).distinct()
    return rows.join(found, "row_key", "left_anti").select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, n_chars) of the documents that are left."""
    path = bpe.default_tokenizer()
    encoded = bpe.encode(docs, path).withColumn("ids_sha256", F.sha2("ids", 256))
    decoded = bpe.decode(encoded, path, keep=("n_tokens", "ids_sha256"))
    return decoded.select(
        "doc_id", "n_tokens", "ids_sha256",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
