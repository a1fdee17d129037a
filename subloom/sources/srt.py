"""Cues of SRT documents as events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subloom.functions.chars import SPACE, col, strip
from subloom.functions.restore import unescape
from subloom.functions.timecode import to_stamp
from subloom.operators.blocks import numbered, running

_TIME = r"(\d{1,2}):(\d{1,2}):(\d{1,2})[,.](\d{1,3})"
TIMING = rf"^[{SPACE}]*{_TIME}[{SPACE}]*-->[{SPACE}]*{_TIME}(?:[{SPACE}]+.*)?$"
#: Markup that goes (fixed values).
DROPPED = r"(?i)<\s*/?\s*(?:font|span|s|em|strong|ruby|rt|rp|c(?:\.[\w-]+)*|v(?:\s[^>]*)?)\s*[^>]*>"


def markup(line: str | Column) -> Column:
    """Inline markup as tags, other known markup dropped; character references stay for the caller."""
    out = col(line)
    for name in ("i", "b", "u"):
        out = F.regexp_replace(out, rf"(?i)<\s*{name}\s*>", "{" + "\\\\" * 1 + f"{name}1" + "}")
        out = F.regexp_replace(out, rf"(?i)<\s*/\s*{name}\s*>", "{" + "\\\\" * 1 + f"{name}0" + "}")
    out = F.regexp_replace(out, r"(?i)<\s*br\s*/?\s*>", r"\\N")
    return F.regexp_replace(out, DROPPED, "")


def convert_markup(line: str | Column) -> Column:
    """markup, then character references as characters (last, so that what they spell isn't taken for markup)."""
    return unescape(markup(line))


def _seconds(line: Column, group: int) -> Column:
    part = lambda k: F.regexp_extract(line, TIMING, group + k).try_cast("long")
    fraction = F.rpad(F.regexp_extract(line, TIMING, group + 3), 3, "0").try_cast("double") / 1000.0
    return part(0) * 3600 + part(1) * 60 + part(2) + fraction


def srt_lines(files: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """key, line_no, line; every kind of line end counts, a leading byte order mark doesn't."""
    t = F.regexp_replace(F.regexp_replace(col(text), "^\\x{feff}", ""), "\r\r\n|\r\n|\r", "\n")
    return files.select(key, F.posexplode(F.split(t, "\n", -1)).alias("line_no", "line"))


#: Lines that a written cue may have; more would meet the next cue's places.
LINES = 1 << 12


def render_lines(cues: DataFrame, file: str, order: str) -> DataFrame:
    """file, line_no, line of cues (start and end in seconds, text: an array of lines, none of them blank) in order (a whole
    number): number, times, text, blank."""
    stamp = lambda c: F.regexp_replace(to_stamp(c), r"^(\d+):(.*)\.(\d\d)$", "$1:$2,$3" + "0")
    timing = F.concat(stamp("start"), F.lit(" --> "), stamp("end"))
    rows = F.concat(F.array(F.col(order).cast("string"), timing), F.col("text"), F.array(F.lit("")))
    return cues.select(file, F.col(order).alias("_o"), F.posexplode(rows).alias("_i", "line")).select(file, (F.col("_o").cast("long") * LINES + F.col("_i")).alias("line_no"), "line")


def parse_cues(lines: DataFrame, file: str = "path") -> DataFrame:
    """file, cue, start, end (seconds), lines (array) of every cue, without exact repetitions; cue counts from 0.

    A timing line opens a cue, the first blank line closes it, what follows up to the next timing is lost. A number
    directly before the next timing is that cue's. A cue without text is kept. A file may have any number of cues.
    """
    timing = F.col("line").rlike(TIMING)
    rows = running(lines.withColumn("_t", timing), file, "line_no", sums={"_cue": F.col("_t").cast("int")}, totals={"_cues": F.col("_t").cast("int")}).filter("_cue > 0")
    inside = Window.partitionBy(file, "_cue").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_blank", ~F.col("_t") & (strip("line") == "")).withColumn("_closed", F.max("_blank").over(inside))
    right = F.regexp_replace("line", rf"[{SPACE}]+$", "")
    # A null start or end stands for figures that no number holds; such timings are none.
    kept = F.filter(F.array_sort(F.collect_list(F.when(~F.col("_t") & ~F.col("_closed"), F.struct("line_no", right.alias("line"))))), lambda x: x.isNotNull())
    g = rows.groupBy(file, "_cue").agg(F.min(F.when(F.col("_t"), F.col("line"))).alias("_timing"), F.max("_closed").alias("_was_closed"), F.max("_cues").alias("_cues"), kept.alias("_kept"))
    texts = F.transform("_kept", lambda x: x["line"])
    glued = ~F.col("_was_closed") & (F.col("_cue") < F.col("_cues")) & F.coalesce(F.try_element_at(texts, F.lit(-1)).rlike(rf"^[{SPACE}]*\d+[{SPACE}]*$"), F.lit(False))
    g = g.withColumn("lines", F.when(glued, F.slice(texts, F.lit(1), F.size(texts) - 1)).otherwise(texts))
    g = g.withColumns({"start": _seconds(F.col("_timing"), 1), "end": _seconds(F.col("_timing"), 5)})
    once = g.groupBy(file, "start", "end", "lines").agg(F.min("_cue").alias("_cue"))
    return numbered(once, file, "_cue", "_n").select(file, (F.col("_n") - 1).cast("int").alias("cue"), "start", "end", "lines")


def cues_to_events(cues: DataFrame, file: str = "path") -> DataFrame:
    """Cues as Dialogue events: markup converted line by line, blank lines dropped, joined by line breaks."""
    each = cues.select(file, "cue", F.posexplode_outer("lines").alias("_i", "_line"))
    has = F.coalesce(F.col("_line").contains("&"), F.lit(False))
    marked = each.withColumn("_line", markup("_line"))
    # Only lines with character references pass through Python.
    done = marked.filter(~has).unionByName(marked.filter(has).withColumn("_line", unescape("_line")))
    texts = done.withColumn("_line", strip("_line")).groupBy(file, "cue").agg(F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("_i", "_line"))), lambda x: x["_line"] != ""), lambda x: x["_line"]), "\\N").alias("text"))
    out = cues.join(texts, [file, "cue"])
    lit = F.lit
    return out.select(file, F.col("cue").alias("line_no"), F.col("cue").cast("int").alias("index"), lit("Dialogue").alias("kind"), lit(0).alias("layer"), to_stamp("start").alias("start"), to_stamp(F.greatest("end", "start")).alias("end"), lit("Default").alias("style"), lit("").alias("name"), lit("0").alias("margin_l"), lit("0").alias("margin_r"), lit("0").alias("margin_v"), lit("").alias("effect"), "text", F.create_map().cast("map<string,string>").alias("extra"))


def parse_events(files: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """Events of documents of cues."""
    return cues_to_events(parse_cues(srt_lines(files, key, text), key), key)
