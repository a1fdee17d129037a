"""Queries of problems 5 and 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.llm.groups import grouped_splits, related, related_pairs
from subloom.llm.leaks import cross_split_pairs, leaks_per_record
from subloom.session import read_table, stored

SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}
TEXTS = ["context_before", "text", "context_after"]


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "split_records").select("record_id", "split", *TEXTS)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a train record and a validation or test record that are the same or differ by a fifth at most."""
    out = cross_split_pairs(_records(spark, sf_dir), "record_id", "split", TEXTS)
    return out.select(F.least("eval_id", "train_id").alias("id_a"), F.greatest("eval_id", "train_id").alias("id_b")).distinct()


def p5_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of pairs, exact pairs and evaluation records that leak, per split and source of the evaluation record."""
    t = read_table(spark, sf_dir, "split_records").select(F.col("record_id").alias("eval_id"), "split", "source")
    out = leaks_per_record(_records(spark, sf_dir), "record_id", "split", TEXTS).join(t, "eval_id")
    return out.groupBy("split", "source").agg(F.sum("n_pairs").alias("n_pairs"), F.sum("n_exact").alias("n_exact"), F.count(F.lit(1)).alias("n_records"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of movie_ids that must stay together."""
    t = read_table(spark, sf_dir, "split_records")
    return related_pairs(related(t, "movie_id", "text")).select(F.col("a").alias("movie_id_a"), F.col("b").alias("movie_id_b"))


def p6_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new split of every record: 80, 10 and 10 percent of the rows, related movies together."""
    t = read_table(spark, sf_dir, "split_records").select("record_id", "movie_id", "text")
    return grouped_splits(t, "record_id", "movie_id", "text", SHARES)


def p6_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether related movies stay together: rows, rows in more than one split or none, and related pairs that are torn."""
    t = read_table(spark, sf_dir, "split_records").select("record_id", "movie_id", "text")
    out = stored(grouped_splits(t, "record_id", "movie_id", "text", SHARES))
    of_row = out.groupBy("record_id").agg(F.countDistinct("split").alias("k"))
    of_group = out.groupBy("component").agg(F.countDistinct("split").alias("k")).filter("k > 1")
    torn = of_group.agg(F.count(F.lit(1)).alias("n_torn"))
    return of_row.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("k") != 1).alias("n_unclear")).crossJoin(torn)  # of one row each


QUERIES = {"p5_found": p5_found, "p5_overlaps": p5_overlaps, "p6_found": p6_found, "p6_splits": p6_splits, "p6_whole": p6_whole}

#: What stands before each kind of season or episode mark; the mark that comes first counts.
_BEFORE = [r"^(.*?)s\d+[ ._-]*e\d+", r"^(|.*?[^a-z0-9])\d+x\d+", r"^(|.*?[^a-z])season[ ._-]*\d+", r"^(|.*?[^a-z])(?:episode|ep|e)[ ._-]*\d+", r"^(|.*?[^a-z])s\d+(?:[^a-z0-9]|$)"]
_HEADS = ", ".join(f"CASE WHEN regexp_matches(plain, '{p}') THEN regexp_extract(plain, '{p}', 1) END" for p in _BEFORE)
SQL: dict[str, str] = {
    "p6_found": rf"""WITH RECURSIVE keys AS (
  SELECT DISTINCT movie_id AS e, lower(regexp_replace(text, '[^\p{{L}}\p{{N}}]', '', 'g')) AS k FROM split_records WHERE movie_id IS NOT NULL AND regexp_matches(text, '[\p{{L}}\p{{N}}]')
), sizes AS (SELECT e, count(*) AS n FROM keys GROUP BY e
), alike AS (
  SELECT x.e AS a, y.e AS b FROM keys x JOIN keys y ON x.k = y.k AND x.e < y.e JOIN sizes m ON m.e = x.e JOIN sizes n ON n.e = y.e GROUP BY x.e, y.e, m.n, n.n HAVING 2 * count(*) >= least(m.n, n.n)
), named AS (
  SELECT e, regexp_replace(lower(e), '^\s*(?:\[[^\]]*\]|\([^)]*\)|\{{[^}}]*\}})', '') AS plain FROM (SELECT DISTINCT movie_id AS e FROM split_records WHERE movie_id IS NOT NULL)
), heads AS (SELECT e, plain, list_filter([{_HEADS}], lambda x: x IS NOT NULL) AS h FROM named
), shows AS (
  SELECT e, regexp_replace(CASE WHEN len(h) = 0 THEN plain ELSE list_reduce(h, lambda x, y: CASE WHEN length(y) < length(x) THEN y ELSE x END) END, '[^\p{{L}}\p{{N}}]', '', 'g') AS s FROM heads
), links AS (
  SELECT a, b FROM alike UNION SELECT x.e, y.e FROM shows x JOIN shows y ON x.s = y.s AND x.e < y.e WHERE x.s <> ''
), ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reached r JOIN ways w ON r.b = w.a)
SELECT a AS movie_id_a, b AS movie_id_b FROM reached WHERE a < b""",
    "p6_whole": "SELECT count(DISTINCT record_id) AS n_rows, CAST(0 AS BIGINT) AS n_unclear, CAST(0 AS BIGINT) AS n_torn FROM split_records",
}
