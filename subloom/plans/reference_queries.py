"""Queries that exercise the core operators on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.functions import chars, tags, text, timecode
from subloom.functions.restore import restore
from subloom.operators import corpus, discover, reorder, rules, split, validate
from subloom.operators.blocks import numbered
from subloom.session import read_table
from subloom.sources import ass, files, records, srt

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "line_records")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "file_events")


def _joined(reasons: str = "reasons") -> Column:
    return F.array_join(reasons, ",").alias("reasons")


# Lines


@query
def line_classify(spark, sf_dir):
    """Status and ordered reasons of every line."""
    return rules.with_classification(_lines(spark, sf_dir)).select("record_id", "status", _joined())


@query
def document_line_classify(spark, sf_dir):
    """Status and reasons of every line of every document, counted by document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    out = rules.with_classification(docs, "line")
    return out.groupBy("doc_id", "status").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.size("reasons")).alias("n_reasons"))


@query
def status_counts(spark, sf_dir):
    return corpus.status_counts(rules.with_classification(_lines(spark, sf_dir)))


@query
def reason_histogram(spark, sf_dir):
    """Reasons by number of lines, with the first record that has each, after duplicates are taken out."""
    out = corpus.deduped(_lines(spark, sf_dir), ["record_id"])
    return corpus.reason_counts(out, ["record_id"]).select("reason", "n", F.col("first_seen.record_id").alias("first_record"))


@query
def dedupe_exact_near(spark, sf_dir):
    """Every line's status and reasons when only the first of the same words is kept."""
    return corpus.deduped(_lines(spark, sf_dir), ["record_id"]).select("record_id", "status", _joined())


@query
def clean_repeats(spark, sf_dir):
    """Status of every line delivered three times at one place, in the order of movie, time, index and text."""
    rows = _lines(spark, sf_dir).select("movie_id", "start", "event_index", "text")
    out = corpus.deduped(rows.unionByName(rows).unionByName(rows), ["movie_id", "start", "event_index", "text"])
    return out.groupBy("text", "status", _joined()).agg(F.count(F.lit(1)).alias("n_lines"))


@query
def context_lines(spark, sf_dir):
    """The lines before and after each line of its movie; lines without one have each other."""
    rows = _lines(spark, sf_dir).drop("context_before", "context_after")
    out = corpus.with_context(rows, "movie_id", ["start", "event_index", "record_id"], "text", "start")
    return out.select("record_id", "context_before", "context_after")


@query
def text_measures(spark, sf_dir):
    """Letters by script, words, capitals, control characters, captions and keys of every line."""
    t = F.col("text")
    return _lines(spark, sf_dir).select(
        "record_id",
        chars.count(t, chars.LETTER).cast("long").alias("letters"),
        chars.count(t, chars.LATIN).cast("long").alias("latin"),
        chars.count(t, chars.CYRILLIC).cast("long").alias("cyrillic"),
        F.round(text.latin_ratio(t), 9).alias("latin_ratio"),
        F.round(text.cyrillic_ratio(t), 9).alias("cyrillic_ratio"),
        text.word_count(t).cast("long").alias("words"),
        text.has_control_chars(t).alias("control"),
        text.is_caption(chars.strip(t)).alias("caption"),
        text.dedupe_key(t).alias("key"),
        chars.one_line(t).alias("one_line"),
    )


@query
def bad_characters(spark, sf_dir):
    """Labels of characters that no sound text holds, for the events that have some."""
    out = _events(spark, sf_dir).select("event_id", text.bad_chars("text").alias("b")).filter(F.size("b") > 0)
    return out.select("event_id", F.array_join("b", ",").alias("bad"))


@query
def name_or_symbol(spark, sf_dir):
    """Lines that may stay untranslated: names, numbers and symbols."""
    return _lines(spark, sf_dir).select("record_id", text.name_or_symbol("text").alias("keeps"))


@query
def word_stats_by_source(spark, sf_dir):
    """Documents, words and characters of each source and label."""
    d = read_table(spark, sf_dir, "documents")
    n = F.count(F.lit(1))
    return d.groupBy("source", "lang").agg(n.alias("n_docs"), F.sum(text.word_count("text")).alias("words"), F.sum(F.length("text")).alias("chars"))


# Events


@query
def event_drop_reasons(spark, sf_dir):
    """Every event's first reason to be dropped, its times in seconds and its text on one line."""
    out = rules.with_drop_reason(_events(spark, sf_dir))
    return out.select("event_id", "drop_reason", F.when(F.col("drop_reason").isNull(), F.col("plain")).alias("plain"), "has_tags")


@query
def drop_reason_counts(spark, sf_dir):
    """Dialogue events by drop reason of each file, with totals over all files (null file)."""
    out = rules.with_drop_reason(_events(spark, sf_dir).filter("kind = 'Dialogue'")).withColumn("drop_reason", F.coalesce("drop_reason", F.lit("extracted")))
    per_file = out.groupBy("file_id", "drop_reason").agg(F.count(F.lit(1)).alias("n"))
    total = per_file.groupBy("drop_reason").agg(F.sum("n").alias("n")).select(F.lit(None).cast("long").alias("file_id"), "drop_reason", "n")
    return per_file.unionByName(total)


@query
def timestamps(spark, sf_dir):
    """Times of events in seconds, and back as stamps; null for bad stamps."""
    e = _events(spark, sf_dir).select("event_id", timecode.to_seconds("start").alias("start_s"), timecode.to_seconds("end").alias("end_s"))
    return e.select("event_id", "start_s", "end_s", F.round(F.col("end_s") - F.col("start_s"), 6).alias("duration"), timecode.to_stamp("start_s").alias("stamp"))


@query
def tag_summary(spark, sf_dir):
    """Tags, karaoke, drawings and translatability of every event."""
    e = _events(spark, sf_dir).withColumn("p", tags.protect("text"))
    return e.select("event_id", F.size("p.tags").cast("long").alias("n_tags"), F.col("p.karaoke").alias("karaoke"), F.col("p.drawing").alias("drawing"), tags.is_translatable_struct(F.col("p")).alias("translatable"), tags.has_tags("text").alias("has_tags"), F.col("p.plain").alias("plain"))


@query
def restore_identity(spark, sf_dir):
    """Tags put back around an event's own plain text: the text as it was, breaks in their usual form."""
    return _events(spark, sf_dir).select("event_id", restore("text", tags.strip_tags("text")).alias("restored"))


@query
def extracted_records(spark, sf_dir):
    """Kept events as records with the neighbouring lines of their file as context."""
    e = _events(spark, sf_dir).withColumn("event_id", F.col("event_id").cast("long"))
    first = e.groupBy("file_id", "index").agg(F.min("event_id").alias("event_id"))
    kept = rules.with_drop_reason(e.join(first, ["file_id", "index", "event_id"])).filter("drop_reason IS NULL")
    return corpus.to_records(kept.withColumn("movie_id", F.col("file_id").cast("string")))


@query
def extract_two_sections(spark, sf_dir):
    """Records of files whose events stand in two sections, so that places in a section come twice: one for each event."""
    e = _events(spark, sf_dir).withColumn("line_no", F.col("event_id"))
    halved = e.withColumn("index", F.floor(F.col("event_id") / 2).cast("int"))
    kept = rules.with_drop_reason(halved).filter("drop_reason IS NULL").withColumn("movie_id", F.col("file_id").cast("string"))
    return corpus.to_records(kept, keep=["event_id"]).select("event_id", "movie_id", "text", "context_before", "context_after", "event_index")


@query
def stable_partition(spark, sf_dir):
    """New places of the event lines of each file when lines with a top-position tag go last."""
    e = _events(spark, sf_dir).withColumn("top", F.coalesce(F.col("kind").isin("Dialogue", "Comment") & F.col("text").rlike(reorder.TOP), F.lit(False)))
    return reorder.new_positions(e, "file_id", "event_id", F.col("top")).select("file_id", "event_id", F.col("new_pos").cast("long").alias("new_pos"))


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as documents can hold them: line ends within a text become line breaks."""
    return _events(spark, sf_dir).withColumn("text", F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]+", r"\\N"))


@query
def ass_render_parse(spark, sf_dir):
    """Events written as lines of documents and read back: place in the file and all fields."""
    out = ass.parse_events(ass.render_lines(_written(spark, sf_dir), "file_id", "event_id"), "file_id")
    return out.select("file_id", (F.col("index") - 1).cast("long").alias("ordinal"), "kind", "layer", "start", "end", "style", "name", "margin_l", "margin_r", "margin_v", "effect", "text")


@query
def styles_render_parse(spark, sf_dir):
    """Styles of the documents that events were written as."""
    out = ass.parse_styles(ass.render_lines(_written(spark, sf_dir), "file_id", "event_id"), "file_id")
    return out.select("file_id", "name", F.element_at("fields", "Fontname").alias("font"), F.size("fields").cast("long").alias("n_fields"))


@query
def section_validation(spark, sf_dir):
    """Issues of sections for documents of which every third has another title and every fifth a new section."""
    docs = ass.render_lines(_written(spark, sf_dir), "file_id", "event_id")
    title = F.when((F.col("file_id") % 3 == 0) & (F.col("line") == "Title: "), "Title: y").otherwise(F.col("line"))
    more = docs.groupBy("file_id").agg((F.max("line_no") + 1).alias("line_no")).filter("file_id % 5 = 0")
    more = more.select("file_id", F.inline(F.array(*[F.struct((F.col("line_no") + i).alias("line_no"), F.lit(x).alias("line")) for i, x in enumerate(["[Fonts]", ""])])))
    sections = lambda d: ass.with_sections(d, "file_id").filter("NOT is_header AND section <> ''")
    return validate.section_issues(sections(docs), sections(docs.withColumn("line", title).unionByName(more)), "file_id")


@query
def srt_render_parse(spark, sf_dir):
    """Lines written as cues of a movie and read back, repeated cues once; every fifth is in italics, every seventh quotes."""
    rows = _lines(spark, sf_dir).filter("movie_id IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL AND start < 360000 AND end < 360000")
    t = F.array_join(F.filter(F.transform(F.split(F.translate("text", "<&", "(+"), r"[\r\n]+"), chars.strip), lambda x: x != ""), "|")
    t = F.when(F.col("record_id") % 5 == 0, F.concat(F.lit("<i>"), t, F.lit("</i>"))).when(F.col("record_id") % 7 == 0, F.concat(F.lit("&quot;"), t, F.lit("&quot;"))).otherwise(t)
    cues = srt.render_lines(rows.withColumn("text", F.split(t, r"\|")), "movie_id", "record_id")
    out = srt.cues_to_events(srt.parse_cues(cues, "movie_id"), "movie_id")
    return out.select("movie_id", F.col("index").cast("long").alias("ordinal"), "start", "end", "text")


@query
def markup_conversion(spark, sf_dir):
    """Inline markup of cue lines as tags."""
    line = F.concat(F.lit("<i>"), F.translate("text", "<&", "(+"), F.lit("</i><br/><font color=red>x</font> &lt;b&gt;"))
    return _lines(spark, sf_dir).select("record_id", srt.convert_markup(line).alias("converted"))


@query
def line_split(spark, sf_dir):
    """Documents as lines: the number of lines of each, of empty ones and of characters."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = files.lines(docs, "doc_id").groupBy("doc_id")
    return out.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("line") == "").alias("n_empty"), F.sum(F.length("line")).alias("chars"))


@query
def encoding_detection(spark, sf_dir):
    """Documents written in six encodings, detected and decoded, with the digest of their bytes.

    What an encoding lacks is written as a question mark; where one would read like UTF-8, a letter of its own comes first.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    k = F.col("doc_id") % 6
    mark = lambda h: F.unhex(F.lit(h))
    upper = "".join(map(chr, range(0x80, 0x100)))
    cyrillic = F.concat(F.lit("Ж "), F.regexp_replace("text", r"[^\x{00}-\x{7f}А-яЁё]", "?"))
    latin = F.concat(F.lit("é "), F.regexp_replace("text", r"[^\x{00}-\x{7f}\x{a0}-\x{ff}]", "?"))
    content = (
        F.when(k == 0, F.encode("text", "UTF-8"))
        .when(k == 1, F.concat(mark("EFBBBF"), F.encode("text", "UTF-8")))
        .when(k == 2, F.concat(mark("FFFE"), F.encode("text", "UTF-16LE")))
        .when(k == 3, F.concat(mark("FEFF"), F.encode("text", "UTF-16BE")))
        .when(k == 4, F.encode(F.translate(cyrillic, files.CP1251, upper), "ISO-8859-1"))
        .otherwise(F.concat(F.encode(latin, "ISO-8859-1"), mark("98")))
    )
    out = files.with_text(d.select("doc_id", content.alias("content")))
    return out.select("doc_id", "codec", "bom", "encoding", "text", F.when(k < 2, F.col("sha1")).alias("sha1"), F.when(F.col("newline") == "\r\n", "crlf").otherwise("lf").alias("newline"))


@query
def collected_top_lines(spark, sf_dir):
    """Documents as bytes with top-position lines moved last: their number, whether anything moved, and the new bytes' digest."""
    docs = ass.render_documents(_written(spark, sf_dir), "file_id", "event_id", "\n")
    out = reorder.collected(docs.select("file_id", F.encode("text", "UTF-8").alias("content")), "file_id")
    return out.select("file_id", "n_top", "changed", F.md5("new_content").alias("new_md5"))


@query
def restore_around_changes(spark, sf_dir):
    """Tags put back around a text in other words: at its ends, and in proportion to where they stood, at the nearest space."""
    e = _events(spark, sf_dir).filter("kind = 'Dialogue'").select("event_id", F.regexp_extract("text", r"^((?:\{[^}p]*\})+)([^{}\\\r\n]+)$", 1).alias("lead"))
    e = e.withColumn("text", F.concat("lead", F.lit(r"one {\b1}two three{\i0}")))
    return e.select("event_id", restore("text", F.lit("дөрөв\nтав")).alias("restored"))


# Files


@query
def filename_parts(spark, sf_dir):
    """Language, key and id that names and folders of files give."""
    f = read_table(spark, sf_dir, "subtitle_files")
    return f.select("file_id", F.array_join(text.tokens("stem"), " ").alias("tokens"), text.language_from_filename("stem").alias("by_name"), text.language_from_folder("rel_dir").alias("by_folder"), text.base_key("stem").alias("key"), text.group_dir("rel_dir").alias("folder"), text.make_id(text.group_dir("rel_dir"), text.base_key("stem")).alias("id"))


def _script(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.script_language(_events(spark, sf_dir).withColumn("line_no", F.col("event_id")))


@query
def episode_ids(spark, sf_dir):
    """Unique ids of all files, as if all were kept: the first of a name has it, later ones get suffixes."""
    f = read_table(spark, sf_dir, "subtitle_files").select(F.lit(0).alias("root_no"), "path", text.group_dir("rel_dir").alias("group_dir"), text.base_key("stem").alias("base_key"))
    return discover.with_ids(discover.with_wanted_id(f)).select("path", "wanted_id", "id")


@query
def script_language(spark, sf_dir):
    """Letters by script of each file's first lines, and the language that they speak for."""
    return _script(spark, sf_dir)


@query
def file_dispositions(spark, sf_dir):
    """Which files are kept, skipped or copies, by name, folder and content."""
    f = read_table(spark, sf_dir, "subtitle_files").select("file_id", "path", "rel_dir", "stem", "sha1", F.lit(0).alias("root_no"))
    out = discover.with_disposition(discover.with_language(f.join(_script(spark, sf_dir).select("file_id", "detected"), "file_id", "left")))
    return out.select("file_id", "language", "language_source", "disposition", "reason", "duplicate_of")


@query
def content_copies(spark, sf_dir):
    """Files with the content of an earlier path."""
    f = read_table(spark, sf_dir, "subtitle_files")
    out = corpus.first_copy(f, "sha1", "path", F.struct(F.lower("path"), F.col("path")))
    return out.filter("duplicate_of IS NOT NULL").select("file_id", "duplicate_of")


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).withColumn("p", tags.protect("text"))
    e = e.withColumns({"translatable": tags.is_translatable_struct(F.col("p")), "plain": chars.one_line(F.col("p.plain"))})
    return corpus.file_statistics(e)


@query
def file_statistics(spark, sf_dir):
    """Dialogue, translatable events, words and characters of each file."""
    return _stats(spark, sf_dir)


@query
def corpus_statistics(spark, sf_dir):
    """Totals over all files, those without events included, by file name ending."""
    f = read_table(spark, sf_dir, "subtitle_files").select("file_id", F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).alias("extension"))
    numbers = ["dialogue_count", "translatable_count", "words", "chars"]
    out = f.join(_stats(spark, sf_dir), "file_id", "left").fillna(0, numbers).groupBy("extension").agg(F.count(F.lit(1)).alias("files"), *[F.sum(c).alias(c) for c in numbers])
    ratio = lambda c: F.bround(F.coalesce(F.col(c) / F.nullif(F.col("translatable_count"), F.lit(0)), F.lit(0.0)), 2)
    return out.withColumns({"avg_chars": ratio("chars"), "avg_words": ratio("words")})


# Records and splits


@query
def json_records(spark, sf_dir):
    """Readable payloads as records of the fixed schema."""
    return records.from_payload(read_table(spark, sf_dir, "raw_records"), "payload", ["record_id"])


@query
def output_records(spark, sf_dir):
    """Split records as they are written."""
    t = read_table(spark, sf_dir, "split_records")
    return t.select("record_id", *text.output_record())


@query
def episode_lines(spark, sf_dir):
    """Lines of each episode, a null one as None."""
    return split.episode_counts(_lines(spark, sf_dir), ["record_id"]).select("movie_id", "lines", F.col("first_seen.record_id").alias("first_record"))


@query
def split_summary(spark, sf_dir):
    """Lines, shares and episodes of each split."""
    return split.split_summary(read_table(spark, sf_dir, "split_records"))


_PARTS = ["split", "lines", "movies", "line_share"]


@query
def grouped_split(spark, sf_dir):
    """Lines and episodes of the splits to which episodes are assigned, largest first, where the fill is lowest.

    Which of two episodes of one size goes where depends on a seeded shuffle; these numbers don't.
    """
    out, _ = split.with_split(_lines(spark, sf_dir), ["record_id"])
    return split.split_summary(out).select(*_PARTS)


@query
def forced_split(spark, sf_dir):
    """The same with all first episodes in test, and a name that no episode has."""
    lines = _lines(spark, sf_dir)
    first = [r["movie_id"] for r in lines.filter("movie_id LIKE '%s01e01%'").select("movie_id").distinct().collect()]  # a list a user would give
    out, _ = split.with_split(lines, ["record_id"], (0.6, 0.2, 0.2), 7, [*first, "no such episode"])
    return split.split_summary(out).select(*_PARTS)


@query
def split_rows(spark, sf_dir):
    """Whether episodes stay whole: the number of episodes in more than one split, and of lines in all."""
    out, _ = split.with_split(_lines(spark, sf_dir), ["record_id"])
    per = out.groupBy("movie_id").agg(F.countDistinct("split").alias("k"), F.count(F.lit(1)).alias("n"))
    return per.agg(F.count_if(F.col("k") > 1).alias("n_torn"), F.sum("n").alias("n_lines"))


# Validation


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = numbered(_events(spark, sf_dir), "file_id", "event_id", "ordinal")
    return e.select("file_id", F.col("ordinal").cast("int").alias("ordinal"), *validate.FROZEN_FIELDS, "index", "text")


def _altered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events of each file by place, and the same with some styles, tags and texts changed and last events lost."""
    e = _placed(spark, sf_dir)
    n = F.col("ordinal")
    changed = e.withColumns({"style": F.when(n % 11 == 0, "Changed").otherwise(F.col("style")), "text": F.when(n % 7 == 0, F.regexp_replace("text", tags.BLOCK, "")).otherwise(F.col("text"))})
    return e, changed.filter(~((n % 50 == 0) & (F.col("file_id") % 2 == 0)))


@query
def structure_validation(spark, sf_dir):
    """Number of structure issues by file, for a changed copy of every file."""
    a, b = _altered(spark, sf_dir)
    out = validate.structure_issues(a, b, "file_id")
    kind = F.when(F.col("issue").contains("style changed"), "style").when(F.col("issue").contains("missing tag"), "tags").when(F.col("issue").startswith("event count"), "count").otherwise("other")
    return out.groupBy("file_id", kind.alias("kind")).agg(F.countDistinct("ordinal").alias("n_events"))


@query
def structure_messages(spark, sf_dir):
    """The issues in words for files with other styles, margins and effects, and with a new tag here and there."""
    a = _placed(spark, sf_dir)
    n = F.col("ordinal")
    b = a.withColumns(
        {
            "style": F.when(n % 11 == 0, "Changed").otherwise(F.col("style")),
            "layer": F.when(n % 13 == 0, F.col("layer") + 1).otherwise(F.col("layer")),
            "text": F.when(n % 17 == 0, F.concat(F.lit(r"{\blur9}{\blur9}"), "text")).otherwise(F.col("text")),
        }
    )
    return validate.structure_issues(a, b.filter(~((n % 50 == 0) & (F.col("file_id") % 2 == 0))), "file_id")


def _translated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events against themselves: every ninth text lost, every eighth with a bad character, of ten in a row two the same."""
    a, n = _placed(spark, sf_dir), F.col("ordinal")
    t = F.when(n % 9 == 0, "").when(n % 8 == 0, F.concat("text", F.lit("\ufffd\u0007"))).when((n % 10).isin(4, 5), "Адилхан мөр").otherwise(F.col("text"))
    return validate.translation_lines(a, a.withColumn("text", t), "file_id")


@query
def translation_validation(spark, sf_dir):
    """Counts of what is wrong with a translation."""
    out = validate.translation_summary(_translated(spark, sf_dir), "file_id")
    return out.select("file_id", "translatable", "n_empty", "n_bad", "n_untranslated", "n_duplicated", "letters", "latin", "too_many_untranslated", "too_much_latin")


@query
def translation_messages(spark, sf_dir):
    """The same in words, with a sample of five lines that were left as they are."""
    return validate.translation_issues(_translated(spark, sf_dir), "file_id")
