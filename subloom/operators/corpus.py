"""Corpus-wide operators on lines: duplicates, neighbours as context, counts of reasons and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subloom.functions.chars import strip
from subloom.functions.text import dedupe_key, word_count
from subloom.operators.rules import CleanConfig, with_classification
from subloom.operators.skew import hot_keys, salted_join
from subloom.session import stored


def deduped(df: DataFrame, order: list[str], text: str = "text", cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Classified lines of which only the first with the same words keeps its status.

    The order columns put the lines in order; of lines at one place, exactly one counts as first. Rejected lines take no
    part. A later line is rejected as duplicate_exact if its stripped text is that of the first line with its key, else as
    duplicate_near. Lines are classified once and stored; only digests of keys (of 128 bits) are shuffled. The first lines
    come from an aggregation and are joined back; keys of very many lines are salted. Null texts count as empty. An empty
    table gives an empty one.
    """
    rows = with_classification(df, text, cfg) if "status" not in df.columns else df
    if not cfg.dedupe:
        return rows
    body = F.coalesce(F.col(text), F.lit(""))
    live = F.col("status") != "rejected"
    exact = strip(body)
    near = dedupe_key(body) if cfg.near_dedupe else exact
    rows = stored(rows.withColumns({**_digests("_key", F.when(live, near)), **_digests("_exact", F.when(live, exact)), "_row": F.monotonically_increasing_id()}))
    lines, keys, own = rows.filter(live), ["_key1", "_key2"], F.struct("_exact1", "_exact2")
    at = F.struct(*order, "_row", own.alias("e"))
    first = stored(lines.groupBy(*keys).agg(F.min(at).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys, "n", F.col("f._row").alias("_first"), F.col("f.e").alias("_of_first")))
    joined = salted_join(lines, first, keys, hot_keys(first, keys, "n", rows.count()), "_row", "left")
    again = F.col("n").isNotNull() & (F.col("_row") != F.col("_first"))
    reason = F.when(own == F.col("_of_first"), "duplicate_exact").otherwise("duplicate_near")
    out = joined.withColumns({"status": F.when(again, "rejected").otherwise(F.col("status")), "reasons": F.when(again, F.array(reason)).otherwise(F.col("reasons"))})
    names = [c for c in rows.columns if c not in (*keys, "_exact1", "_exact2", "_row")]
    return out.select(*[F.col(f"`{c}`") for c in names]).unionByName(rows.filter(~live).select(*[F.col(f"`{c}`") for c in names]))


def _digests(name: str, c: Column) -> dict[str, Column]:
    """Two digests of 64 bits with seeds of their own."""
    return {f"{name}1": F.xxhash64(c), f"{name}2": F.xxhash64(F.lit(1), c)}


def with_context(df: DataFrame, entity: str, order: list[str], text: str = "text", window_s: str | None = None) -> DataFrame:
    """Adds context_before and context_after: the neighbouring texts of the entity in order, empty at the edges.

    window_s: a column of seconds that leads the order. With it, windows hold ten minutes of an entity and the texts at
    their edges come from the windows before and after, so that no task holds a whole entity.
    """
    if window_s is None:
        w = Window.partitionBy(entity).orderBy(*order)
        return df.withColumns({"context_before": F.coalesce(F.lag(text).over(w), F.lit("")), "context_after": F.coalesce(F.lead(text).over(w), F.lit(""))})
    df = df.withColumn("_b", F.floor(F.coalesce(F.col(window_s), F.lit(-1.0)) / 600).cast("long"))
    at = F.struct(*order)
    edges = df.groupBy(entity, "_b").agg(F.min_by(text, at).alias("_first"), F.max_by(text, at).alias("_last"))
    over = Window.partitionBy(entity).orderBy("_b")
    edges = edges.select(entity, "_b", F.lag("_last").over(over).alias("_prior"), F.lead("_first").over(over).alias("_next"))
    w = Window.partitionBy(entity, "_b").orderBy(*order)
    out = df.join(edges.withColumnRenamed(entity, "_e"), F.col(entity).eqNullSafe(F.col("_e")) & (df["_b"] == edges["_b"])).drop(edges["_b"]).drop("_e")
    n = F.row_number().over(w)
    out = out.withColumns({"context_before": F.coalesce(F.when(n == 1, F.col("_prior")).otherwise(F.lag(text).over(w)), F.lit("")), "context_after": F.coalesce(F.when(F.lead(F.lit(1)).over(w).isNull(), F.col("_next")).otherwise(F.lead(text).over(w)), F.lit(""))})
    return out.drop("_b", "_prior", "_next")


def to_records(lines: DataFrame, movie: str = "movie_id", keep: Sequence[str] = ()) -> DataFrame:
    """Extracted records of kept events (plain, start_s, end_s, style, name, index, has_tags) with context, one each.

    Lines go by start, index and, where there is one, line_no, as the index begins anew with each section. keep: further
    columns that stay.
    """
    ties = [c for c in ("line_no",) if c in lines.columns]
    w = with_context(lines, movie, ["start_s", "index", *ties], "plain", "start_s")
    name = F.when(strip(F.coalesce(F.col("name"), F.lit(""))) != "", F.col("name"))
    return w.select(F.col(movie).alias("movie_id"), F.col("plain").alias("text"), "context_before", "context_after", name.alias("speaker"), "style", F.bround("start_s", 3).alias("start"), F.bround("end_s", 3).alias("end"), F.col("index").alias("event_index"), "has_tags", *keep)


def reason_counts(df: DataFrame, order: list[str]) -> DataFrame:
    """reason, n and the first place at which it was met, for ordering ties."""
    each = df.select(*order, F.posexplode("reasons").alias("_i", "reason"))
    return each.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order, "_i")).alias("first_seen"))


def status_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def first_copy(df: DataFrame, digest: str, path: str, order: Column) -> DataFrame:
    """Adds duplicate_of: the path of the first row with the same digest, null for that row itself and null digests."""
    first = df.filter(F.col(digest).isNotNull()).groupBy(digest).agg(F.min(F.struct(order.alias("o"), F.col(path).alias("p"))).alias("_f"))
    out = df.join(first, digest, "left").withColumn("_p", F.col("_f.p"))
    return out.withColumn("duplicate_of", F.when(F.col("_p") != F.col(path), F.col("_p"))).drop("_f", "_p")


def file_statistics(events: DataFrame, file_id: str = "file_id") -> DataFrame:
    """Dialogue events, translatable ones, words and characters of each file; events need plain and translatable."""
    t = F.col("translatable")
    out = events.filter("kind = 'Dialogue'").groupBy(file_id).agg(F.count(F.lit(1)).alias("dialogue_count"), F.count_if(t).alias("translatable_count"), F.sum(F.when(t, word_count("plain")).otherwise(0)).alias("words"), F.sum(F.when(t, F.length("plain")).otherwise(0)).alias("chars"))
    avg = lambda c: F.coalesce(F.col(c) / F.nullif(F.col("translatable_count"), F.lit(0)), F.lit(0.0))
    return out.withColumns({"avg_chars": F.bround(avg("chars"), 2), "avg_words": F.bround(avg("words"), 2)})
