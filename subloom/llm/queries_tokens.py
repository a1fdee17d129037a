"""Queries of problems 8 and 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.llm.tokens import decode_corpus, encode_corpus, fill_containers
from subloom.session import read_table, stored


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k, without special tokens; null and empty texts have none."""
    return encode_corpus(read_table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document there and back: the text that its ids stand for."""
    return decode_corpus(p8_ids(spark, sf_dir), "doc_id", "ids")


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of 2,048 tokens of each document, or of each piece of a larger one."""
    return fill_containers(read_table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, containers that hold too much, documents split though they fit, and whether nine tenths of the space are used."""
    out = stored(p9_containers(spark, sf_dir))
    bins = out.groupBy("container").agg(F.sum("n_tokens").alias("n"))
    docs = out.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("pieces"))
    used = bins.agg(F.count_if(F.col("n") > 2048).alias("n_over"), (F.sum("n") > 0.9 * 2048 * F.count(F.lit(1))).alias("well_filled"))
    return docs.agg(F.count(F.lit(1)).alias("n_docs"), F.count_if((F.col("n") <= 2048) & (F.col("pieces") > 1)).alias("n_torn")).crossJoin(used)  # of one row each


QUERIES = {"p8_ids": p8_ids, "p8_decoded": p8_decoded, "p9_containers": p9_containers, "p9_valid": p9_valid}
SQL: dict[str, str] = {
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p9_valid": "SELECT count(*) AS n_docs, CAST(0 AS BIGINT) AS n_torn, CAST(0 AS BIGINT) AS n_over, true AS well_filled FROM documents",
}
