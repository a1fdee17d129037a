"""Checks that an edited document kept its structure, and of what a translation reads like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.functions.chars import LATIN, LETTER, count, strip
from subloom.functions.tags import is_translatable, strip_tags, tag_issues
from subloom.functions.text import bad_chars, event_label, name_or_symbol
from subloom.operators.blocks import running

#: Sections whose lines, and fields whose values, must not change (fixed values).
FROZEN_SECTIONS = ["script info", "v4+ styles", "v4 styles", "v4+ styles+", "aegisub project garbage"]
FROZEN_FIELDS = ["kind", "layer", "start", "end", "style", "name", "margin_l", "margin_r", "margin_v", "effect", "extra"]


def paired(original: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """struct columns a and b of the events that stand at the same place in both documents (keys: document, place)."""
    a = original.select(*keys, F.struct(*[c for c in original.columns if c not in keys]).alias("a"))
    b = changed.select(*keys, F.struct(*[c for c in changed.columns if c not in keys]).alias("b"))
    return a.join(b, keys)


def _shown(c: Column, name: str) -> Column:
    if name == "extra":
        return F.to_json(c)
    return c.cast("string") if name == "layer" else F.concat(F.lit("'"), c, F.lit("'"))


def _same(a: Column, b: Column, name: str) -> Column:
    """Maps compare by their sorted entries."""
    flat = (lambda c: F.array_sort(F.map_entries(c))) if name == "extra" else (lambda c: c)
    return flat(a).eqNullSafe(flat(b))


def structure_issues(original: DataFrame, changed: DataFrame, doc: str = "doc", place: str = "ordinal") -> DataFrame:
    """doc, ordinal, issue: event counts that differ (ordinal -1), changed fields and changed tags, for pairs of events.

    Events have the frozen fields, index and text. The shorter document ends the comparison.
    """
    counts = original.groupBy(doc).agg(F.count(F.lit(1)).alias("na")).join(changed.groupBy(doc).agg(F.count(F.lit(1)).alias("nb")), doc, "full_outer")
    na, nb = F.coalesce("na", F.lit(0)), F.coalesce("nb", F.lit(0))
    of_count = counts.filter(na != nb).select(doc, F.lit(-1).alias(place), F.format_string("event count differs: %d != %d", na, nb).alias("issue"))
    p = paired(original, changed, [doc, place])
    label = event_label(F.col("a.kind"), F.col("a.index"), F.col("a.start"), F.col("a.end"))
    field = [F.when(~_same(F.col(f"a.{f}"), F.col(f"b.{f}"), f), F.concat(F.lit(f"{f} changed ("), F.coalesce(_shown(F.col(f"a.{f}"), f), F.lit("None")), F.lit(" -> "), F.coalesce(_shown(F.col(f"b.{f}"), f), F.lit("None")), F.lit(")"))) for f in FROZEN_FIELDS]
    found = F.concat(F.array_compact(F.array(*field)), tag_issues("a.text", "b.text"))
    each = p.select(doc, place, label.alias("_l"), F.explode(found).alias("_i"))
    return of_count.unionByName(each.select(doc, F.col(place).cast("int").alias(place), F.concat_ws(": ", "_l", "_i").alias("issue")))


def section_issues(original: DataFrame, changed: DataFrame, doc: str = "doc") -> DataFrame:
    """doc, issue of lines with section, section_no and line_no (no headers): lists of sections that differ, frozen sections
    in one document only or with other lines, and other Format lines of events."""

    def described(lines: DataFrame, suffix: str) -> tuple[DataFrame, DataFrame]:
        names = lines.groupBy(doc, "section_no").agg(F.max("section").alias("section")).groupBy(doc).agg(F.transform(F.array_sort(F.collect_list(F.struct("section_no", "section"))), lambda x: x["section"]).alias(f"names_{suffix}"))
        # Events, the bulk of a document, never get this far.
        frozen = lines.withColumn("name", F.lower("section")).filter(F.col("name").isin(FROZEN_SECTIONS))
        one = frozen.groupBy(doc, "name", "section_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]).alias("lines"))
        first = one.groupBy(doc, "name").agg(F.min_by("lines", "section_no").alias(f"lines_{suffix}"))
        return names, first

    (na, fa), (nb, fb) = described(original, "a"), described(changed, "b")
    names = na.join(nb, doc).filter("names_a <> names_b").select(doc, F.concat(F.lit("section list differs: ["), F.array_join("names_a", ", "), F.lit("] != ["), F.array_join("names_b", ", "), F.lit("]")).alias("issue"))
    both = fa.join(fb, [doc, "name"], "full_outer")
    lone = both.filter("lines_a IS NULL OR lines_b IS NULL").select(doc, F.concat(F.lit("["), "name", F.lit("] present in only one file")).alias("issue"))
    other = both.filter("lines_a <> lines_b").select(doc, F.concat(F.lit("["), "name", F.lit("] lines changed")).alias("issue"))
    fmt = lambda d, s: d.filter((F.lower("section") == "events") & F.lower(strip("line")).startswith("format")).groupBy(doc).agg(F.max_by(F.regexp_replace("line", r"\s", ""), "line_no").alias(f"f_{s}"))
    formats = fmt(original, "a").join(fmt(changed, "b"), doc, "full_outer").filter("NOT f_a <=> f_b").select(doc, F.lit("Events Format line differs").alias("issue"))
    return names.unionByName(lone).unionByName(other).unionByName(formats)


def translation_lines(original: DataFrame, changed: DataFrame, doc: str = "doc", place: str = "ordinal") -> DataFrame:
    """Pairs of translatable events with src, dst (plain, stripped), and the flags empty, bad, untranslated, duplicated.

    duplicated compares with the pair before it that is dialogue and not empty, carried over blocks of a document of any
    size.
    """
    p = paired(original, changed, [doc, place]).filter(is_translatable("a.text"))
    p = p.select(doc, place, event_label(F.col("a.kind"), F.col("a.index"), F.col("a.start"), F.col("a.end")).alias("label"), (F.col("a.kind") == "Dialogue").alias("dialogue"), F.col("b.text").alias("raw"), strip_tags("a.text").alias("_s"), strip_tags(F.coalesce(F.col("b.text"), F.lit(""))).alias("out"))
    p = p.withColumns({"src": strip("_s"), "dst": strip("out")})
    p = p.withColumns({"empty": F.col("dst") == "", "bad": bad_chars("raw"), "untranslated": (F.col("dst") != "") & (F.col("src") == F.col("dst")) & ~name_or_symbol("_s")})
    p = running(p, doc, place, {"_b": F.when(F.col("dialogue") & ~F.col("empty"), F.struct("src", "dst"))}, strict=True)
    again = F.col("dialogue") & ~F.col("empty") & (F.col("dst") == F.col("_b.dst")) & (F.col("src") != F.col("_b.src")) & (F.length("dst") > 3)
    return p.withColumn("duplicated", F.coalesce(again, F.lit(False))).drop("_b", "_s")


def translation_summary(lines: DataFrame, doc: str = "doc", max_untranslated: float = 0.02, max_latin: float = 0.25) -> DataFrame:
    """Counts of each document, its share of untranslated lines and of Latin letters, and whether these are too high."""
    out = lines.groupBy(doc).agg(F.count(F.lit(1)).alias("translatable"), F.count_if("empty").alias("n_empty"), F.count_if(F.size("bad") > 0).alias("n_bad"), F.count_if("untranslated").alias("n_untranslated"), F.count_if("duplicated").alias("n_duplicated"), F.sum(count("out", LETTER)).alias("letters"), F.sum(count("out", LATIN)).alias("latin"))
    share, latin = F.col("n_untranslated") / F.col("translatable"), F.coalesce(F.col("latin") / F.nullif(F.col("letters"), F.lit(0)), F.lit(0.0))
    return out.withColumns({"too_many_untranslated": share > max_untranslated, "too_much_latin": latin > max_latin})


def translation_issues(lines: DataFrame, doc: str = "doc", place: str = "ordinal", max_untranslated: float = 0.02, max_latin: float = 0.25) -> DataFrame:
    """doc, ordinal, issue: messages on lines, and (ordinal null) on the document with a sample of five lines."""
    quoted = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    some = F.array_compact(
        F.array(
            F.when(F.col("empty"), F.concat(F.lit("empty translation for "), quoted(F.col("src")))),
            F.when(~F.col("empty") & (F.size("bad") > 0), F.concat(F.lit("unexpected characters "), F.array_join("bad", ", "))),
            F.when(F.col("duplicated"), F.concat(F.lit("duplicated translation "), quoted(F.col("dst")))),
        )
    )
    each = lines.select(doc, F.col(place).cast("long").alias(place), "label", F.explode(some).alias("_i")).select(doc, place, F.concat_ws(": ", "label", "_i").alias("issue"))
    sample = F.array_join(F.slice(F.transform(F.array_sort(F.collect_list(F.when(F.col("untranslated"), F.struct(place, F.concat(F.col("label"), F.lit(": "), quoted(F.col("src"))).alias("m"))))), lambda x: x["m"]), 1, 5), "; ")
    s = translation_summary(lines, doc, max_untranslated, max_latin).join(lines.groupBy(doc).agg(sample.alias("_sample")), doc)
    percent = lambda c, k: F.format_string(f"%.{k}f%%", F.bround(c * 100, k))
    u, la = F.col("n_untranslated") / F.col("translatable"), F.col("latin") / F.nullif(F.col("letters"), F.lit(0))
    whole = F.array_compact(
        F.array(
            F.when(F.col("too_many_untranslated"), F.concat(F.format_string("%d/%d translatable lines identical to source (", "n_untranslated", "translatable"), percent(u, 1), F.lit(f" > {max_untranslated:.1%}): "), F.col("_sample"))),
            F.when(F.col("too_much_latin"), F.concat(F.lit("Latin-script ratio in output is "), percent(la, 1), F.lit(f" (> {max_latin:.0%})"))),
        )
    )
    return each.unionByName(s.select(doc, F.lit(None).cast("long").alias(place), F.explode(whole).alias("issue")))
