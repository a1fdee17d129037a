"""Queries of problems 1, 2, 3 and 10."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.llm.encoding import letter_pairs, repaired
from subloom.llm.language import MIN_EVENTS, MIN_WORDS, document_stretches, event_languages, file_runs, fit, label_column, labels
from subloom.llm.reading import reading_levels
from subloom.llm.turns import turn_starts, turns
from subloom.session import read_table, stored


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents and files with what their labels stand for."""
    known = labels(read_table(spark, sf_dir, "language_codes"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", label_column("lang", known).alias("label"))
    files = read_table(spark, sf_dir, "subtitle_files").select(F.col("file_id").cast("long"), label_column("language", known).alias("label"))
    return docs, files


def _prototypes(spark: SparkSession, sf_dir: str) -> np.ndarray:
    docs, files = _labelled(spark, sf_dir)
    events = read_table(spark, sf_dir, "file_events").filter("kind = 'Dialogue'").select(F.col("file_id").cast("long"), "text")
    return fit(docs, "text", "label", events.join(files, "file_id"))


def _files(spark: SparkSession, sf_dir: str, prototypes: np.ndarray) -> DataFrame:
    """Runs of consecutive events in a language, of every file."""
    events = read_table(spark, sf_dir, "file_events")
    return file_runs(event_languages(events, prototypes, letter_pairs(events, "text")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages that a file or document is in but that its label doesn't stand for."""
    prototypes = _prototypes(spark, sf_dir)
    docs, files = _labelled(spark, sf_dir)
    runs = document_stretches(docs, "doc_id", "text", prototypes)
    in_docs = runs.filter((F.col("n_words") >= MIN_WORDS) & F.col("language").isNotNull()).select(F.col("doc_id").alias("record_id"), "language").distinct()
    in_files = _files(spark, sf_dir, prototypes).filter(F.col("longest") >= MIN_EVENTS).select(F.col("file_id").alias("record_id"), "language")
    out = []
    for kind, found, labelled in (("document", in_docs, docs.select(F.col("doc_id").alias("record_id"), "label")), ("file", in_files, files.withColumnRenamed("file_id", "record_id"))):
        other = found.join(labelled, "record_id").filter(~F.col("language").eqNullSafe(F.col("label")))
        out.append(other.select(F.lit(kind).alias("record_kind"), "record_id", "language"))
    return out[0].union(out[1]).distinct()


def p1_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of every document in one language, with its confidence; a document of one language, or none, has one row."""
    return document_stretches(_labelled(spark, sf_dir)[0], "doc_id", "text", _prototypes(spark, sf_dir))


def p1_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language of every file with its share of the events as confidence, what the label stands for and where it is from.

    A file without events that tell a language has one row with no language and confidence 0.
    """
    out = _files(spark, sf_dir, _prototypes(spark, sf_dir))
    out = out.select("file_id", "language", "longest", "events", (F.col("events") / F.col("of_events")).alias("confidence"))
    source = read_table(spark, sf_dir, "subtitle_files").select(F.col("file_id").cast("long"), "language_source")
    every = _labelled(spark, sf_dir)[1].join(source, "file_id").join(out, "file_id", "left")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("longest", "events")]
    return every.select("file_id", "language", *numbers, F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "label", "language_source", F.col("language").eqNullSafe(F.col("label")).alias("as_labelled"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose text holds characters that come from decoding with a wrong encoding."""
    return repaired(read_table(spark, sf_dir, "file_events"), "event_id", "text").select("event_id")


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The garbled events with their original text, as far as it can be had, and the way back to it."""
    return repaired(read_table(spark, sf_dir, "file_events"), "event_id", "text")


def p2_round_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in Cyrillic as UTF-8 read as Latin-1, restored: each has to be its own text again."""
    docs = read_table(spark, sf_dir, "documents").filter(F.col("text").rlike("[\u0400-\u04FF]"))
    wrong = docs.select("doc_id", F.decode(F.encode("text", "UTF-8"), "ISO-8859-1").alias("text"))
    return repaired(wrong, "doc_id", "text").select("doc_id", F.col("restored").alias("text"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each turn: the event_index of the line in which it starts, and the speaker."""
    return turn_starts(read_table(spark, sf_dir, "transcripts"), read_table(spark, sf_dir, "cast_members")).distinct()


def p3_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean turns in order of time, each with its member of the cast."""
    return turns(read_table(spark, sf_dir, "transcripts"), read_table(spark, sf_dir, "cast_members"))


def _stretches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The documents, and their stretches in one language."""
    docs = _labelled(spark, sf_dir)[0]
    return docs, document_stretches(docs, "doc_id", "text", _prototypes(spark, sf_dir))


def _english(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Documents that are in English and, by stretches of MIN_WORDS words, in no other language."""
    told = runs.filter(F.col("n_words") >= MIN_WORDS).groupBy("doc_id").agg(F.min("language").alias("first"), F.max("language").alias("last")).filter("first = 'en' AND last = 'en'")
    return docs.join(told.select("doc_id"), "doc_id", "left_semi")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reading band of each document of at least 40 words that is in English and no other language."""
    out = reading_levels(_english(*_stretches(spark, sf_dir)), "doc_id", "text", read_table(spark, sf_dir, "reading_labels"), min_words=40)
    return out.select("doc_id", "reading_band").distinct()


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading level and band of every document with a text, as p10_found has them, and its language.

    The language is that of its stretches of MIN_WORDS words or, where there are none, of all its stretches: "mixed" for
    several, null without any.
    """
    docs, runs = _stretches(spark, sf_dir)
    runs = stored(runs.select("doc_id", "language", "n_words"))
    levels = reading_levels(_english(docs, runs), "doc_id", "text", read_table(spark, sf_dir, "reading_labels"), min_words=40, every=docs)
    long = F.col("n_words") >= MIN_WORDS
    one = lambda f: F.coalesce(f(F.when(long, F.col("language"))), f("language"))
    told = runs.groupBy("doc_id").agg(one(F.min).alias("first"), one(F.max).alias("last"))
    told = told.select("doc_id", F.when(F.col("first").eqNullSafe(F.col("last")), F.col("first")).otherwise("mixed").alias("language"))
    return levels.join(told, "doc_id", "left")


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, words and mean level of each source, language and band: the corpus by how demanding its text is."""
    sources = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    out = p10_levels(spark, sf_dir).join(sources, "doc_id").groupBy("source", "language", "reading_band")
    return out.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_words").alias("n_words"), F.avg("level").alias("mean_level"))


QUERIES = {"p1_found": p1_found, "p1_documents": p1_documents, "p1_files": p1_files, "p2_found": p2_found, "p2_restored": p2_restored, "p2_round_trips": p2_round_trips, "p3_found": p3_found, "p3_turns": p3_turns, "p10_found": p10_found, "p10_levels": p10_levels, "p10_profile": p10_profile}
SQL: dict[str, str] = {"p2_round_trips": "SELECT doc_id, text FROM documents WHERE regexp_matches(text, '[\\x{400}-\\x{4ff}]')"}
