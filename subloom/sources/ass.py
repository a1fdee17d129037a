"""Sections, events and styles of ASS and SSA documents.

The lines of a file carry the last header and the last Format line forward over blocks of lines, so that a file may have
any number of them; everything else is an expression on a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.functions.chars import SPACE, col, strip
from subloom.operators.blocks import numbered, running

#: Columns of an event where no Format line stands (fixed values), and the kinds of events.
EVENT_FORMAT = ["Layer", "Start", "End", "Style", "Name", "MarginL", "MarginR", "MarginV", "Effect", "Text"]
KINDS = ["Dialogue", "Comment", "Picture", "Sound", "Movie", "Command"]
#: Columns of a style where no Format line stands (fixed values).
STYLE_FORMAT = "Name Fontname Fontsize PrimaryColour SecondaryColour OutlineColour BackColour Bold Italic Underline StrikeOut ScaleX ScaleY Spacing Angle BorderStyle Outline Shadow Alignment MarginL MarginR MarginV Encoding".split()
#: Format column, event field and its default (fixed values).
FIELDS = [("start", "start", "0:00:00.00"), ("end", "end", "0:00:00.00"), ("style", "style", "Default"), ("name", "name", ""), ("marginl", "margin_l", "0"), ("marginr", "margin_r", "0"), ("marginv", "margin_v", "0"), ("effect", "effect", ""), ("text", "text", "")]
STYLE_SECTIONS = ["v4+ styles", "v4 styles", "v4+ styles+"]


def key_value(line: str | Column) -> Column:
    """struct(key, value) at the first colon, the key stripped, the value on its left; null without a colon."""
    c = col(line)
    at = F.locate(":", c)
    key = strip(F.substring(c, F.lit(1), at - 1))
    value = F.regexp_replace(F.substring(c, at + 1, F.length(c)), rf"^[{SPACE}]+", "")
    return F.when(at > 0, F.struct(key.alias("key"), value.alias("value")))


def format_columns(value: str | Column) -> Column:
    return F.transform(F.split(col(value), ","), strip)


def with_sections(lines: DataFrame, file: str = "path", again: bool = False) -> DataFrame:
    """Adds section (as spelt, "" before the first header), section_no, header_no, index in its section and is_header."""
    s = strip("line")
    header = s.startswith("[") & s.endswith("]") & (F.length(s) > 2)
    name = strip(F.substring(s, F.lit(2), F.length(s) - 2))
    opened = F.when(header, F.struct(F.col("line_no").alias("n"), name.alias("name")))
    out = running(lines.withColumn("is_header", header), file, "line_no", {"_at": opened}, {"section_no": header.cast("int")}, again=again)
    out = out.withColumns({"section": F.coalesce("_at.name", F.lit("")), "header_no": F.coalesce("_at.n", F.lit(-1))})
    return out.withColumn("index", F.col("line_no") - F.col("header_no") - 1).drop("_at")


def with_events(lines: DataFrame, file: str = "path") -> DataFrame:
    """Section lines with kind (null where the line is no event), value and the format in force, as an array."""
    out = with_sections(lines, file, again=True) if "section" not in lines.columns else lines
    s = strip("line")
    usable = (F.lower("section") == "events") & ~F.col("is_header") & (s != "") & ~s.startswith(";")
    out = out.withColumn("_kv", F.when(usable, key_value("line")))
    key = F.lower(F.col("_kv.key"))
    out = running(out, file, "line_no", {"format": F.when(key == "format", format_columns("_kv.value"))})
    kinds = F.create_map(*[F.lit(x) for k in KINDS for x in (k.lower(), k)])
    out = out.withColumns({"format": F.coalesce("format", F.array(*map(F.lit, EVENT_FORMAT))), "kind": F.try_element_at(kinds, key), "value": F.col("_kv.value")})
    return out.drop("_kv")


def with_fields(rows: DataFrame, value: str, fmt: str) -> DataFrame:
    """Adds layer, the text fields and extra of event lines; only the first commas part fields, missing ones keep defaults.

    Columns are met without case, the last of several of one name counts; unknown ones, and a layer that is no number, go
    to the map extra.
    """
    rows = rows.withColumn("_v", F.split(value, ",", F.size(fmt)))
    # Names from the last to the first, so that the first place found is that of the last column of a name.
    used = F.slice(fmt, F.lit(1), F.least(F.size(fmt), F.size("_v")))
    rows = rows.withColumn("_k", F.reverse(F.split(F.lower(F.array_join(used, "\x00")), "\x00")))
    at = lambda name: F.when(F.array_contains("_k", name), F.get("_v", F.size("_k") - F.array_position("_k", name).cast("int")))
    number = r"^[+-]?\d+$"
    layer = strip(at("layer"))
    known = [k for k, _, _ in FIELDS]
    rows = rows.withColumn("_layer", F.when(layer.rlike(number), layer.try_cast("int")))
    odd = (F.size(F.array_except("_k", F.array(*map(F.lit, [*known, "layer"])))) > 0) | (F.array_contains("_k", "layer") & F.col("_layer").isNull())
    pairs = F.arrays_zip(used.alias("k"), F.slice("_v", F.lit(1), F.size("_k")).alias("v"))
    more = F.filter(pairs, lambda p: ~F.lower(p["k"]).isin([*known, "layer"]) | ((F.lower(p["k"]) == "layer") & ~strip(p["v"]).rlike(number)))
    last = F.filter(F.transform(more, lambda p, i: F.struct(p["k"].alias("key"), p["v"].alias("value"), i.alias("i"))), lambda p: ~F.exists(F.slice(more, p["i"] + 2, F.size(more)), lambda q: q["k"] == p["key"]))
    extra = F.when(odd, F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"], p["value"])))).otherwise(F.create_map().cast("map<string,string>"))
    fields = {"layer": F.coalesce("_layer", F.lit(0)), **{name: F.coalesce(at(k), F.lit(d)) for k, name, d in FIELDS}, "extra": extra}
    return rows.withColumns(fields).drop("_v", "_k", "_layer")


def parse_events(lines: DataFrame, file: str = "path") -> DataFrame:
    """file, line_no, index, kind, layer, start, ... text, extra of every event line."""
    found = with_fields(with_events(lines, file).filter(F.col("kind").isNotNull()), "value", "format")
    return found.select(file, "line_no", F.col("index").cast("int").alias("index"), "kind", "layer", *[name for _, name, _ in FIELDS], "extra")


def parse_styles(lines: DataFrame, file: str = "path") -> DataFrame:
    """file, name, fields (map) of the styles in the first style section; the last of one name wins, missing fields are empty."""
    s = with_sections(lines, file).filter(~F.col("is_header"))
    rank = F.array_position(F.array(*map(F.lit, STYLE_SECTIONS)), F.lower("section"))
    s = s.withColumn("_rank", rank).filter("_rank > 0")
    first = s.groupBy(file).agg(F.min(F.struct("_rank", "section_no")).alias("_first"))
    s = s.join(first, file).filter((F.col("_rank") == F.col("_first._rank")) & (F.col("section_no") == F.col("_first.section_no"))).drop("_first")
    s = s.withColumn("_kv", key_value("line"))
    key = F.lower(F.col("_kv.key"))
    s = running(s, file, "line_no", {"_fmt": F.when(key == "format", format_columns("_kv.value"))})
    s = s.withColumn("_fmt", F.coalesce("_fmt", F.array(*map(F.lit, STYLE_FORMAT)))).filter(key == "style")
    parts = F.transform(F.split("_kv.value", ",", F.size("_fmt")), strip)
    fields = F.map_from_entries(F.transform("_fmt", lambda k, i: F.struct(k.alias("key"), F.coalesce(F.get(parts, i), F.lit("")).alias("value"))))
    rows = s.select(file, "line_no", fields.alias("fields"), F.get(parts, F.lit(0)).alias("_0")).withColumn("name", F.coalesce(F.try_element_at("fields", F.lit("Name")), "_0"))
    return rows.groupBy(file, "name").agg(F.max_by("fields", "line_no").alias("fields"))


#: Head of a written document (fixed values).
HEAD = ["[Script Info]", "Title: ", "ScriptType: v4.00+", "WrapStyle: 0", "ScaledBorderAndShadow: yes", "PlayResX: 1280", "PlayResY: 720", "", "[V4+ Styles]", "Format: " + ", ".join(STYLE_FORMAT)]


_STYLE = ",Arial,48,&H00FFFFFF,&H000000FF,&H00000000,&H00000000,0,0,0,0,100,100,0,0,1,2,2,2,10,10,10,1"
_EVENT = ["layer", "start", "end", "style", "name", "margin_l", "margin_r", "margin_v", "effect", "text"]


def event_line() -> Column:
    return F.concat(F.col("kind"), F.lit(": "), F.concat_ws(",", *[F.col(f).cast("string") for f in _EVENT]))


#: Place of the header of the events; what comes before it leaves places free, which is the same to every reader.
_EVENTS_AT = 1 << 20


def render_lines(events: DataFrame, file: str, order: str) -> DataFrame:
    """file, line_no, line of a document of each file's events in order (a whole number), with a style line for each style
    that they use; events come out one by one, so a file may have any number. Texts hold no line ends."""
    at = lambda places, line: F.struct(places.cast("int").alias("line_no"), line.alias("line"))
    head = F.array(*[at(F.lit(i), F.lit(x)) for i, x in enumerate(HEAD)])
    styles = F.transform(F.array_sort(F.collect_set("style")), lambda x, i: at(i + len(HEAD), F.concat(F.lit("Style: "), x, F.lit(_STYLE))))
    opens = F.array(*[at(F.lit(_EVENTS_AT + i - 1), F.lit(x)) for i, x in enumerate(["", "[Events]", "Format: " + ", ".join(EVENT_FORMAT)])])
    top = events.groupBy(file).agg(F.concat(head, styles, opens).alias("_l")).select(file, F.inline("_l"))
    body = numbered(events.select(file, order, event_line().alias("line")), file, order, "_i")
    return top.unionByName(body.select(file, (F.col("_i") + _EVENTS_AT + 1).cast("int").alias("line_no"), "line"))


def render_documents(events: DataFrame, file: str, order: str, newline: str = "\r\n") -> DataFrame:
    """file, text: the same documents with their text as one value, which has to fit into a row."""
    body = F.transform(F.array_sort(F.collect_list(F.struct(order, event_line().alias("line")))), lambda x: x["line"])
    styles = F.transform(F.array_sort(F.collect_set("style")), lambda s: F.concat(F.lit("Style: "), s, F.lit(_STYLE)))
    parts = F.concat(F.array(*map(F.lit, HEAD)), styles, F.array(F.lit(""), F.lit("[Events]"), F.lit("Format: " + ", ".join(EVENT_FORMAT))), body, F.array(F.lit("")))
    return events.groupBy(file).agg(F.array_join(parts, newline).alias("text"))
