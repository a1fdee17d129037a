"""Speech transcripts into clean speaker turns (problem 3).

SQL expressions split lines into parts (one for each speaker that a line names), take labels off and remove fillers,
annotations, time stamps and music. Labels meet the cast by equality of normal forms, misspelt ones by the letters
left when one is dropped. Speakers are carried forward by windows over stretches of time of each movie, with a second
window over the stretches' last speakers, so that no task holds a whole movie; turns are islands of one speaker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subloom.operators.skew import hot_keys, salted_join
from subloom.session import stored

#: Styles of signs, songs, titles, captions and credits (fixed values).
NO_SPEECH = r"(?iu)(?:^|[^a-z])(?:signs?|op|ed|opening|ending|karaoke|titles?|credits?|songs?|lyrics?|typeset(?:ting)?|ts|notes?|caption|logo)(?:$|[^a-z])"
#: Forms of address before a name, and marks after one (fixed values).
TITLES = "mr|mrs|ms|miss|dr|doctor|prof|professor|capt|captain|sir|lady|madam|sgt|sergeant|lt|col|colonel|rev|fr"
_AFTER = r"\s*[\(\[][^\)\]]*[\)\]]\s*$"
#: Fillers (fixed values).
_FILLER = r"(?iu)(?<![\p{L}\p{N}'’])(?:u+h+m*|u+m+|e+r+m*|h+m+|m{2,}|a+h+|eh+)(?![\p{L}\p{N}'’])"
_NOTE = r"\([^()\n]*\)|\[[^\[\]\n]*\]|\{[^{}\n]*\}|<[^<>\n]*>|\*[^*\n]*\*"
_STAMP = r"(?<![\d:])\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d+)?(?![\d:])"
_MUSIC = "[♪♫♬♩]"
#: A part begins on a new line, after " >> ", or after a dash or stroke before something like a label.
_PARTS = r"\r?\n|\s+>>\s*|\s+[-–—/|]\s+(?=[\p{L}][^:\n.!?]{0,40}(?:\.[^:\n.!?]{0,30})?:\s)|\s+[-–—/|]\s+(?=[\(\[]\p{Lu}[^\)\]\n]{1,40}[\)\]]\s)"
_LABEL = r"^([\p{L}][^:\n!?]*?)\s*:(?:\s|$)"
_BRACKET = r"^[\(\[]([^\)\]\n]+)[\)\]]\s*:?"
STRETCH_S = 600


def name_key(label: Column) -> Column:
    """Normal form of a label: small letters, marks after it, titles and dots dropped, "last, first" turned round."""
    s = F.regexp_replace(F.lower(F.trim(label)), r"^[\s\-–—>]+", "")
    s = F.regexp_replace(F.regexp_replace(s, r"\s*:\s*$", ""), _AFTER, "")
    s = F.regexp_replace(s, r"^([^,]+),\s*(.+)$", "$2 $1")
    s = F.regexp_replace(s, rf"^(?:(?:{TITLES})\.?\s+)+(?=\S)", "")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}\s'’-]", " "), r"\s+", " "))
    return F.when(s != "", s)


def _aliases(cast: DataFrame) -> DataFrame:
    """movie_id, key, cast_id of the forms that stand for one member of a movie's cast only."""
    full = name_key(F.col("full_name"))
    words = F.split("full", " ")
    first, last = F.element_at(words, 1), F.element_at(words, -1)
    c = cast.select(F.col("movie_id").cast("string"), F.col("cast_id").cast("long"), full.alias("full")).dropna()
    forms = F.array_distinct(F.array("full", first, last, F.concat_ws(" ", F.substring(first, 1, 1), last), F.concat_ws(" ", first, F.substring(last, 1, 1))))
    # The same name twice in a cast is one speaker, the one with the smaller id.
    c = c.groupBy("movie_id", "full").agg(F.min("cast_id").alias("cast_id"))
    each = c.select("movie_id", "cast_id", F.explode(forms).alias("key"))
    return each.groupBy("movie_id", "key").agg(F.min("cast_id").alias("cast_id"), F.max("cast_id").alias("_top")).filter("cast_id = _top").drop("_top")


def _drops(key: Column) -> Column:
    """The key, and the key without each one of its letters."""
    return F.concat(F.array(key), F.transform(F.sequence(F.lit(1), F.length(key)), lambda i: F.concat(F.substring(key, F.lit(1), i - 1), F.substring(key, i + 1, F.length(key)))))


def resolve(labels: DataFrame, cast: DataFrame) -> DataFrame:
    """movie_id, key, cast_id for the labels (movie_id, key; each once) that stand for one cast member, misspelt ones included.

    Forms of fewer than five letters have to be met exactly: another letter makes another name of them. Labels that are
    more than two letters longer than every name can't be misspelt ones.
    """
    aliases = stored(_aliases(cast))
    exact = labels.join(aliases, ["movie_id", "key"])
    longest = aliases.agg(F.max(F.length("key"))).first()[0] or 0
    rest = labels.join(aliases, ["movie_id", "key"], "left_anti").filter(F.length("key").between(5, longest + 2))
    left = rest.select("movie_id", "key", F.explode(F.array_distinct(_drops(F.col("key")))).alias("k"))
    right = aliases.filter(F.length("key") >= 5).select("movie_id", F.col("key").alias("alias"), "cast_id", F.explode(F.array_distinct(_drops(F.col("key")))).alias("k"))
    d = F.levenshtein("key", "alias", 2)
    near = left.join(right, ["movie_id", "k"]).withColumn("d", d).filter("d BETWEEN 0 AND 2")
    levels = near.groupBy("movie_id", "key", "d").agg(F.min("cast_id").alias("low"), F.max("cast_id").alias("top"))
    best = levels.groupBy("movie_id", "key").agg(F.min(F.struct("d", "low", "top")).alias("b"))
    fuzzy = best.filter("b.low = b.top").select("movie_id", "key", F.col("b.low").alias("cast_id"))
    return exact.select("movie_id", "key", "cast_id").unionByName(fuzzy)


def clean_speech(text: Column) -> Column:
    """A part's own words: annotations, time stamps, music and fillers removed, spaces and marks around them mended."""
    s = F.regexp_replace(text, _NOTE, " ")
    s = F.regexp_replace(s, rf"^\s*{_STAMP}\s*[-–—]?|{_STAMP}\s*[-–—](?:\s|$)", " ")
    s = F.regexp_replace(s, _MUSIC, " ")
    s = F.regexp_replace(s, _FILLER + r"(?:\s*(?:\.{2,}|…)|\s*,)?(?:\s+-\s)?", " ")
    s = F.regexp_replace(s, r"^[\s,\-–—>]+", "")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"\s+([,.!?…])", "$1"), r"\s+", " "))


def has_words(speech: Column) -> Column:
    """Whether anything is left that is said: letters or digits, but no lone time stamp."""
    return F.regexp_replace(speech, _STAMP, "").rlike(r"[\p{L}\p{N}]")


def speech_parts(lines: DataFrame, cast: DataFrame) -> DataFrame:
    """movie_id, start, event_index, part, speech, cast_id (null where the part names nobody): parts that hold speech.

    Redelivered lines count once. A null movie or text, and lines of NO_SPEECH styles, hold no speech. A name in the
    text outweighs the column; the column counts for a line's first part.
    """
    rows = lines.select(F.col("movie_id").cast("string"), F.col("start").cast("double"), F.col("event_index").cast("long"), F.col("text").cast("string"), F.col("speaker").cast("string"), F.col("style").cast("string"))
    rows = rows.filter("movie_id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["movie_id", "start", "event_index", "text"])
    rows = rows.filter(~F.coalesce(F.col("style"), F.lit("")).rlike(NO_SPEECH))
    parts = rows.select("movie_id", "start", "event_index", "speaker", F.posexplode(F.split("text", _PARTS)).alias("part", "raw"))
    # What stands before a label: dashes, arrows, music, stamps and fillers.
    lead = rf"^(?:[\s\-–—>]|{_MUSIC}|\[?{_STAMP}\]?)+"
    parts = parts.withColumn("raw", F.regexp_replace("raw", lead, ""))
    parts = parts.withColumn("in_bracket", F.regexp_extract("raw", _BRACKET, 1)).withColumn("after", F.regexp_replace("raw", r"^(?:(?:" + _NOTE + r")\s*)+", ""))
    parts = parts.withColumn("label", F.regexp_extract("after", _LABEL, 1))
    parts = parts.withColumns({"k_bracket": name_key(F.nullif(F.col("in_bracket"), F.lit(""))), "k_label": name_key(F.nullif(F.col("label"), F.lit(""))), "k_column": F.when(F.col("part") == 0, name_key(F.col("speaker")))})
    parts = stored(parts.withColumn("pid", F.monotonically_increasing_id()))
    # Names are looked up apart from the texts: most parts have none, and a name may stand in a third of all lines.
    kinds = ["k_bracket", "k_label", "k_column"]
    names = parts.select("pid", "movie_id", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(k).alias("key")) for i, k in enumerate(kinds)])).alias("n"))
    names = names.select("pid", "movie_id", "n.i", "n.key").filter("key IS NOT NULL")
    labels = stored(names.groupBy("movie_id", "key").agg(F.count(F.lit(1)).alias("n")))
    known = stored(resolve(labels.select("movie_id", "key"), cast))
    told = salted_join(names, known, ["movie_id", "key"], hot_keys(labels, ["movie_id", "key"], "n", parts.count()), "pid")
    told = told.groupBy("pid").agg(*[F.max(F.when(F.col("i") == i, F.col("cast_id"))).alias("c" + k[1:]) for i, k in enumerate(kinds)])
    parts = parts.join(told, "pid", "left")
    body = F.when(F.col("c_bracket").isNotNull(), F.regexp_replace("raw", _BRACKET, "")).when(F.col("c_label").isNotNull(), F.regexp_replace("after", _LABEL, "")).otherwise(F.col("raw"))
    # Through an array of one, so that the filter doesn't have the words cleaned a second time.
    parts = parts.withColumn("speech", F.explode(F.array(clean_speech(body)))).filter(has_words(F.col("speech")))
    return parts.select("movie_id", "start", "event_index", "part", "speech", F.coalesce("c_bracket", "c_label", "c_column").alias("cast_id"))


def spoken_parts(lines: DataFrame, cast: DataFrame) -> DataFrame:
    """The parts that hold speech with `who` speaks, carried forward, and whether the part `opens` a turn.

    Lines go by start, ties by event_index, a null start first. Parts before the first name of a movie are left out.
    """
    at = F.struct(F.coalesce("start", F.lit(-1.0)).alias("s"), "event_index", "part")
    parts = speech_parts(lines, cast).withColumn("stretch", F.floor(F.coalesce("start", F.lit(-1.0)) / STRETCH_S).cast("long"))
    parts = stored(parts.withColumn("at", at))
    inside = Window.partitionBy("movie_id", "stretch").orderBy("at")
    ends = parts.groupBy("movie_id", "stretch").agg(F.max_by("cast_id", F.when(F.col("cast_id").isNotNull(), F.col("at"))).alias("last"))
    before = Window.partitionBy("movie_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("movie_id", "stretch", F.last("last", ignorenulls=True).over(before).alias("carried"))
    rows = parts.join(carried, ["movie_id", "stretch"])
    rows = rows.withColumn("who", F.coalesce(F.last("cast_id", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)), "carried"))
    rows = rows.withColumn("prior", F.coalesce(F.lag("who").over(inside), "carried")).filter("who IS NOT NULL")
    return rows.select("movie_id", "stretch", "at", "speech", "who", (~F.col("who").eqNullSafe(F.col("prior"))).alias("opens"))


def turn_starts(lines: DataFrame, cast: DataFrame) -> DataFrame:
    """movie_id, event_index, cast_id of each turn: the line in which it starts and who speaks.

    An empty table gives an empty one; further columns are dropped.
    """
    rows = spoken_parts(lines, cast).filter("opens")
    return rows.select("movie_id", F.col("at.event_index").cast("int").alias("event_index"), F.col("who").alias("cast_id"))


def turns(lines: DataFrame, cast: DataFrame) -> DataFrame:
    """movie_id, event_index, cast_id, start, n_parts, text of each turn.

    event_index and start are those of the line in which the turn starts; a turn that goes on into later stretches of
    STRETCH_S seconds is put together again. An empty table gives an empty one; further columns are dropped.
    """
    rows = stored(spoken_parts(lines, cast))
    inside = Window.partitionBy("movie_id", "stretch").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("movie_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    # Islands: the start of a part's turn is the last opening at or before it, in its stretch or carried from earlier ones.
    opened = rows.groupBy("movie_id", "stretch").agg(F.max(F.when(F.col("opens"), F.col("at"))).alias("open"))
    carried = opened.select("movie_id", "stretch", F.last("open", ignorenulls=True).over(before).alias("from"))
    rows = rows.join(carried, ["movie_id", "stretch"])
    rows = rows.withColumn("turn", F.coalesce(F.last(F.when(F.col("opens"), F.col("at")), ignorenulls=True).over(inside), "from"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "speech"))), lambda x: x["speech"]), " ")
    out = rows.groupBy("movie_id", "turn", F.col("who").alias("cast_id")).agg(F.count(F.lit(1)).alias("n_parts"), said.alias("text"))
    return out.select("movie_id", F.col("turn.event_index").cast("int").alias("event_index"), "cast_id", F.when(F.col("turn.s") >= 0, F.col("turn.s")).alias("start"), "n_parts", "text")
