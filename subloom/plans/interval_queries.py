"""Queries over line_records intervals, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.operators.intervals import gaps, merged_periods, to_ms
from subloom.session import read_table


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read_table(spark, sf_dir, "line_records")
    return t.select("movie_id", to_ms("start").alias("start_ms"), to_ms("end").alias("end_ms"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of at least 1,000 ms of a movie in which no line is on screen."""
    out = gaps(_lines(spark, sf_dir), "movie_id", "start_ms", "end_ms", at_least=1000)
    return out.select(F.col("entity").alias("movie_id"), "gap_start_ms", "gap_end_ms")


def p4_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous periods with a line on screen, per movie."""
    out = merged_periods(_lines(spark, sf_dir), "movie_id", "start_ms", "end_ms")
    return out.withColumnRenamed("entity", "movie_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p4_found": p4_found, "p4_periods": p4_periods}

_LINES = """
WITH lines AS (
  SELECT movie_id, CAST(round(start * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e
  FROM line_records WHERE movie_id IS NOT NULL AND start IS NOT NULL AND "end" IS NOT NULL
), seen AS (
  SELECT movie_id, s, e, max(e) OVER (PARTITION BY movie_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM lines WHERE e > s
)"""
SQL: dict[str, str] = {
    "p4_found": _LINES + " SELECT movie_id, m AS gap_start_ms, s AS gap_end_ms FROM seen WHERE s - m >= 1000",
    "p4_periods": _LINES
    + """, labelled AS (
  SELECT *, sum(CASE WHEN m IS NULL OR s > m THEN 1 ELSE 0 END) OVER (PARTITION BY movie_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM seen
)
SELECT movie_id, min(s) AS period_start_ms, max(e) AS period_end_ms, count(*) AS n_rows FROM labelled GROUP BY movie_id, island""",
}
