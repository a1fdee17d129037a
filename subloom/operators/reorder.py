"""Stable partition of event lines: those with a top-position tag after all others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.functions.chars import col
from subloom.operators.blocks import running

TOP = r"\{[^}]*\\an8[^}]*\}"
EVENT = r"^(?:Dialogue|Comment):"


def is_top(line: str | Column) -> Column:
    return F.coalesce(col(line).rlike(EVENT) & col(line).rlike(TOP), F.lit(False))


def new_positions(lines: DataFrame, file: str, line_no: str, top: Column) -> DataFrame:
    """Adds new_pos, from 0 in each file: rows that aren't top in their order, then top rows in theirs."""
    out = running(lines.withColumn("_top", top), file, line_no, sums={"_a": ~F.col("_top"), "_b": F.col("_top")}, totals={"_all": ~F.col("_top")})
    return out.withColumn("new_pos", F.when(F.col("_top"), F.col("_all") + F.col("_b")).otherwise(F.col("_a")) - 1).drop("_top", "_a", "_b", "_all")


def collected(files: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """key, n_top, changed, new_content of each file of bytes; new_content is null without an exact [Events] line.

    Bytes are read as Latin-1, so encoding, mark and line ends stay. The event lines reach from the first [Events]
    line to the next line that opens a section; blank lines before that stay, and an unterminated last line keeps
    its place at the end of the file. The size never changes. A file's lines never leave its row: nothing is shuffled.
    """
    blank = r"[ \t\r\n\x{0b}\x{0c}]"
    bare = lambda c: F.regexp_replace(c, rf"^{blank}+|{blank}+$", "")
    # Lines with their ends: CRLF, LF, CR and the separators at which bytes are split into lines.
    lines = F.regexp_extract_all(F.decode(col(content), "ISO-8859-1"), F.lit(r"[^\r\n]*(?:\r\n|\n|\r)|[^\r\n]+$"), F.lit(0))
    t = files.select(key, col(content).alias("_c"), lines.alias("_l"))
    first = lambda test: F.array_position(F.transform("_l", test), True)
    t = t.withColumn("_start", first(lambda x: bare(F.regexp_replace(x, r"^[\x{ef}\x{bb}\x{bf}]+", "")) == "[Events]").cast("int"))
    opens = first(lambda x, i: (i >= F.col("_start")) & F.regexp_replace(x, rf"^{blank}+", "").startswith("["))
    t = t.withColumn("_next", F.when(opens > 0, opens).otherwise(F.size("_l") + 1).cast("int"))
    inside = F.slice("_l", F.col("_start") + 1, F.col("_next") - F.col("_start") - 1)
    filled = F.array_max(F.transform(inside, lambda x, i: F.when(bare(x) != "", i + 1)))
    t = t.filter("_start > 0").withColumn("_body", F.slice(inside, F.lit(1), F.coalesce(filled, F.lit(0))))
    eol = F.when(F.exists("_l", lambda x: x.endswith("\r\n")), F.lit("\r\n")).otherwise(F.lit("\n"))
    t = t.withColumn("_open", F.coalesce(~F.try_element_at("_body", F.lit(-1)).rlike(r"[\r\n]$"), F.lit(False)))
    t = t.withColumn("_full", F.transform("_body", lambda x: F.when(x.rlike(r"[\r\n]$"), x).otherwise(F.concat(x, eol))))
    n = F.size("_body")
    parts = F.concat(F.slice("_l", F.lit(1), F.col("_start")), F.filter("_full", lambda x: ~is_top(x)), F.filter("_full", is_top), F.slice("_l", F.col("_start") + n + 1, F.size("_l")))
    joined = F.array_join(parts, "")
    new = F.encode(F.when(F.col("_open"), F.regexp_replace(joined, r"[\r\n]+$", "")).otherwise(joined), "ISO-8859-1")
    done = t.select(key, F.size(F.filter("_full", is_top)).alias("n_top"), (new != F.col("_c")).alias("changed"), new.alias("new_content"))
    none = files.select(key, lines.alias("_l")).filter(F.coalesce(~F.exists("_l", lambda x: bare(F.regexp_replace(x, r"^[\x{ef}\x{bb}\x{bf}]+", "")) == "[Events]"), F.lit(True)))
    return done.unionByName(none.select(key, F.lit(0).alias("n_top"), F.lit(None).cast("boolean").alias("changed"), F.lit(None).cast("binary").alias("new_content")))
