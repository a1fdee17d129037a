"""Measures and keys of texts and file names, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subloom.functions.chars import CYRILLIC, LATIN, LETTER, SPACE, WORD, col, count, strip

#: Words of file and folder names that mean a language (fixed values).
EN_TOKENS = ["english", "en", "eng", "engl"]
MN_TOKENS = ["mongolian", "mn", "mon", "mng", "mongol", "khalkha"]


def _ratio(c: str | Column, pattern: str) -> Column:
    return F.coalesce(count(c, pattern) / F.nullif(count(c, LETTER), F.lit(0)), F.lit(0.0))


def latin_ratio(c: str | Column) -> Column:
    """Share of the letters that are Latin; 0 without letters."""
    return _ratio(c, LATIN)


def cyrillic_ratio(c: str | Column) -> Column:
    """Share of Cyrillic characters among the letters; 0 without letters."""
    return _ratio(c, CYRILLIC)


def words(c: str | Column) -> Column:
    return F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(WORD), F.lit(0))


def word_count(c: str | Column) -> Column:
    return F.coalesce(count(c, WORD), F.lit(0))


def has_control_chars(c: str | Column) -> Column:
    """Control or format characters other than new line, tab and zero-width space."""
    return F.coalesce(col(c).rlike(r"[\p{Cc}\p{Cf}&&[^\n\t\x{200b}]]"), F.lit(False))


def bad_chars(c: str | Column) -> Column:
    """Sorted labels of replacement, control, format, private and unassigned characters."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"[\x{fffd}\p{Cc}\p{Cf}\p{Co}\p{Cn}&&[^\n\t]]"), F.lit(0)))
    label = lambda x: F.concat(F.lit("U+"), F.lpad(F.regexp_replace(F.hex(F.encode(x, "UTF-32")), "^0+", ""), 4, "0"))
    # Code points of more than four digits keep them all.
    wide = lambda x: F.when(F.length(F.regexp_replace(F.hex(F.encode(x, "UTF-32")), "^0+", "")) > 4, F.concat(F.lit("U+"), F.regexp_replace(F.hex(F.encode(x, "UTF-32")), "^0+", ""))).otherwise(label(x))
    return F.array_sort(F.transform(found, wide))


def is_caption(stripped: str | Column, ratio: float = 0.8, min_words: int = 3) -> Column:
    """For a stripped text: wholly in () or [], or of at least min_words words and mostly capitals."""
    t = col(stripped)
    wrapped = t.rlike(r"(?s)^(?:\(.*\)|\[.*\])$")
    capitals = (word_count(t) >= min_words) & (count(t, r"\p{Lu}") >= ratio * F.greatest(count(t, r"\p{L}"), F.lit(1)))
    return F.coalesce(wrapped | capitals, F.lit(False))


def dedupe_key(c: str | Column) -> Column:
    """Small letters without punctuation, symbols and white space."""
    return F.regexp_replace(F.lower(col(c)), rf"[\p{{P}}\p{{S}}{SPACE}]+", "")


def name_or_symbol(c: str | Column) -> Column:
    """No letters, no words, or up to two words that all begin with a capital: fine to leave as it is."""
    t = strip(c)
    found = F.regexp_extract_all(t, F.lit(rf"{LETTER}+(?:['\x{{2019}}-]{LETTER}+)*"), F.lit(0))
    return ~t.rlike(LETTER) | (F.size(found) == 0) | ((F.size(found) <= 2) & F.forall(found, lambda w: w.rlike(r"^\p{Lu}")))


def event_label(kind: Column, index: Column, start: Column, end: Column) -> Column:
    return F.format_string("%s #%d [%s -> %s]", kind, index, start, end)


def tokens(stem: str | Column) -> Column:
    """Parts of a file name in small letters."""
    return F.filter(F.split(F.lower(col(stem)), rf"[{SPACE}._\-()\[\]{{}}]+"), lambda x: x != "")


def _any_of(arr: Column, names: list[str]) -> Column:
    return F.arrays_overlap(arr, F.array(*map(F.lit, names)))


def language_from_filename(stem: str | Column) -> Column:
    """en or mn where the name has a token of one of them only, else null."""
    en, mn = _any_of(tokens(stem), EN_TOKENS), _any_of(tokens(stem), MN_TOKENS)
    return F.when(en & ~mn, "en").when(mn & ~en, "mn")


def base_key(stem: str | Column) -> Column:
    """The name without language tokens, joined by underscores."""
    return F.array_join(F.filter(tokens(stem), lambda x: ~x.isin(EN_TOKENS + MN_TOKENS)), "_")


def _folders(rel_dir: str | Column) -> Column:
    return F.filter(F.split(F.coalesce(col(rel_dir), F.lit("")), "/"), lambda x: x != "")


def language_from_folder(rel_dir: str | Column) -> Column:
    """Language of the first folder that is named for one, else null."""
    named = F.filter(_folders(rel_dir), lambda x: F.lower(x).isin(EN_TOKENS + MN_TOKENS))
    first = F.lower(F.try_element_at(named, F.lit(1)))
    return F.when(first.isin(EN_TOKENS), "en").when(first.isin(MN_TOKENS), "mn")


def group_dir(rel_dir: str | Column) -> Column:
    """The folder path without language folders."""
    return F.array_join(F.filter(_folders(rel_dir), lambda x: ~F.lower(x).isin(EN_TOKENS + MN_TOKENS)), "/")


def make_id(folder: str | Column, key: str | Column) -> Column:
    """Safe id of folder and key; "root" where nothing is left."""
    joined = F.concat_ws("_", F.nullif(F.replace(col(folder), F.lit("/"), F.lit("_")), F.lit("")), F.nullif(col(key), F.lit("")))
    raw = F.when(joined == "", "root").otherwise(joined)
    safe = F.regexp_replace(F.regexp_replace(raw, r"[^A-Za-z0-9_.\-]+", "_"), "^_+|_+$", "")
    return F.when(safe == "", "root").otherwise(safe)


#: Columns of a split record (fixed values).
OUTPUT = ["text", "context_before", "context_after", "speaker", "movie_id", "start", "end"]


def output_record() -> list[Column]:
    """Columns of a split record: null texts become empty, nothing else is kept."""
    return [F.coalesce(F.col(c), F.lit("")).alias(c) if c in OUTPUT[:3] else F.col(f"`{c}`").alias(c) for c in OUTPUT]
