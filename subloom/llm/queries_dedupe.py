"""Queries of problem 7 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.llm.textdupes import copies, readable_texts
from subloom.session import read_table


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "line_records").select("record_id", "text")
    return lines.unionByName(readable_texts(read_table(spark, sf_dir, "raw_records"), "record_id", "payload"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record whose text stands in a record with a smaller id, with the smallest such id."""
    out = copies(_texts(spark, sf_dir), "record_id", "text", min_length=20)
    return out.filter("record_id <> first_id").select("first_id", "record_id").distinct()


def p7_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each line that has copies, short stock lines included, with the number of its records."""
    out = copies(_texts(spark, sf_dir), "record_id", "text", min_length=1)
    return out.filter("record_id = first_id").select("record_id", "n_copies").distinct()


def p7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collapsed corpus: one record for each distinct line, with the number of its records, 1 where it stands once."""
    out = copies(_texts(spark, sf_dir), "record_id", "text", min_length=1, single=True)
    return out.filter("record_id = first_id").select("record_id", "n_copies").distinct()


QUERIES = {"p7_found": p7_found, "p7_copies": p7_copies, "p7_lines": p7_lines}

_KEYS = r"""
WITH texts AS (
  SELECT record_id, text FROM line_records
  UNION ALL
  SELECT record_id, CASE WHEN json_valid(payload) THEN payload ->> '$.text' END FROM raw_records
), keys AS (
  SELECT record_id, lower(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) AS k FROM texts WHERE text IS NOT NULL
), firsts AS (
  SELECT record_id, k, min(record_id) OVER (PARTITION BY k) AS first_id, count(*) OVER (PARTITION BY k) AS n FROM keys WHERE k <> ''
)"""
SQL = {
    "p7_found": _KEYS + " SELECT first_id, record_id FROM firsts WHERE record_id <> first_id AND length(k) >= 20",
    "p7_copies": _KEYS + " SELECT record_id, n AS n_copies FROM firsts WHERE record_id = first_id AND n > 1",
    "p7_lines": _KEYS + " SELECT record_id, n AS n_copies FROM firsts WHERE record_id = first_id",
}
