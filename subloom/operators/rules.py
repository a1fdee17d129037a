"""Which events are kept and how lines are classified, as Column expressions with ordered reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.functions.chars import CYRILLIC, SPACE, col, one_line, strip
from subloom.functions.tags import has_tags, is_translatable_struct, protect
from subloom.functions.text import cyrillic_ratio, has_control_chars, is_caption
from subloom.functions.timecode import to_seconds

#: Style names that aren't dialogue, as whole words (fixed values).
SKIP_STYLE = r"(?:^|[^a-z])(?:signs?|op|ed|opening|ending|karaoke|titles?|credits?|songs?|lyrics?|typeset(?:ting)?|ts|notes?|caption|logo)(?:$|[^a-z])"
#: Marks of what is no clean line (fixed values): tags that are left, markup, addresses, credits, wrong decoding.
RESIDUAL = r"[{}]|\\(?:[NnhabiuscKkp]|move|fad|fs|fn)"
MARKUP = r"</?[A-Za-z][^<>]*>"
ADDRESS = r"https?://|www\.|\.(?:com|net|org|mn)(?:[^\p{L}\p{M}\p{N}_]|$)"
CREDIT = (
    r"(?:^|[^\p{L}\p{M}\p{N}_])(?:(?:subtitles?|subs|sub)[" + SPACE + r"]+by|synced|corrected by|translated by|resync|opensubtitles|subscene|addic7ed|encoded by|ripped by)(?:[^\p{L}\p{M}\p{N}_]|$)"
    r"|орчуулсан|орчуулагч|орчуулга[" + SPACE + r"]*[:\x{ff1a}]|хадмал[" + SPACE + r"]*[:\x{ff1a}]|хадмалыг"
)
HINTS = r"(?iu)://|www\.|\.(?:com|net|org|mn)|by|sync|opensubtitles|subscene|addic7ed|орчуул|хадмал"
WRONG_DECODING = r"[\x{d0}\x{d1}][\x{80}-\x{bf}\x{400}-\x{45f}]|[\x{c3}\x{c2}][\x{80}-\x{bf}]|\x{e2}\x{20ac}"
NO_LETTERS = rf"^[{SPACE}\p{{P}}\p{{S}}]*$"
REJECT = ["empty_text", "punctuation_only", "replacement_char", "control_chars", "mojibake", "residual_ass_tags", "html_tags", "credit_or_url", "cyrillic_text"]


@dataclass(frozen=True)
class ExtractConfig:
    skip_style: str = SKIP_STYLE
    skip_nonempty_effect: bool = True


@dataclass(frozen=True)
class CleanConfig:
    reject_cyrillic: float = 0.5
    max_chars: int = 600
    dedupe: bool = True
    near_dedupe: bool = True
    flag_captions: bool = True
    caption_uppercase_ratio: float = 0.8
    caption_min_words: int = 3


def with_drop_reason(events: DataFrame, cfg: ExtractConfig = ExtractConfig()) -> DataFrame:
    """Adds plain (one line), start_s, end_s (not before the start), has_tags and drop_reason, null where the event is kept.

    The first test that fails names the reason: not_translatable, skipped_style, skipped_effect, bad_timestamp. A null
    text isn't translatable; null styles and effects count as empty.
    """
    e = events.withColumn("_p", protect(F.col("text")))
    plain = one_line(F.col("_p")["plain"])
    start, end = to_seconds("start"), to_seconds("end")
    reason = F.when(~F.coalesce((F.col("kind") == "Dialogue"), F.lit(False)) | ~is_translatable_struct(F.col("_p")) | (plain == ""), "not_translatable")
    if cfg.skip_style:
        reason = reason.when(F.coalesce(F.col("style"), F.lit("")).rlike("(?iu)" + cfg.skip_style), "skipped_style")
    if cfg.skip_nonempty_effect:
        reason = reason.when(strip(F.coalesce(F.col("effect"), F.lit(""))) != "", "skipped_effect")
    reason = reason.when(start.isNull() | end.isNull(), "bad_timestamp")
    return e.withColumns({"plain": F.coalesce(plain, F.lit("")), "start_s": start, "end_s": F.greatest(start, end), "has_tags": has_tags("text"), "drop_reason": reason}).drop("_p")


def reject_reasons(stripped: str | Column, cfg: CleanConfig = CleanConfig()) -> Column:
    t = col(stripped)
    low = F.lower(t)
    when = lambda cond, name: F.when(cond, F.lit(name))
    rules = [
        when(t.rlike(NO_LETTERS), "punctuation_only"),
        when(t.contains("�"), "replacement_char"),
        when(has_control_chars(t), "control_chars"),
        when(t.rlike(WRONG_DECODING), "mojibake"),
        when(t.rlike(RESIDUAL), "residual_ass_tags"),
        when(t.rlike(MARKUP), "html_tags"),
        # Most lines have none of the words that the patterns need; looking for those costs less.
        when(t.rlike(HINTS) & (low.rlike(ADDRESS) | low.rlike(CREDIT)), "credit_or_url"),
        when((t.rlike(CYRILLIC) if cfg.reject_cyrillic > 0 else F.lit(True)) & (cyrillic_ratio(t) >= cfg.reject_cyrillic), "cyrillic_text"),
    ]
    return F.when(t == "", F.array(F.lit("empty_text"))).otherwise(F.array_compact(F.array(*rules)))


def review_reasons(stripped: str | Column, cfg: CleanConfig = CleanConfig()) -> Column:
    t = col(stripped)
    caption = is_caption(t, cfg.caption_uppercase_ratio, cfg.caption_min_words) if cfg.flag_captions else F.lit(False)
    return F.array_compact(F.array(F.when(F.length(t) > cfg.max_chars, F.lit("very_long")), F.when(caption, F.lit("caption"))))


def with_classification(df: DataFrame, text: str = "text", cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Adds status (clean, review, rejected) and reasons in the order of the rules; a null text counts as empty.

    Rejected lines have their reject reasons only.
    """
    # Columns of their own, so that no rule works them out again.
    df = df.withColumn("_t", strip(F.coalesce(F.col(text), F.lit(""))))
    df = df.withColumns({"_reject": reject_reasons("_t", cfg), "_review": review_reasons("_t", cfg)})
    rejected, review = F.size("_reject") > 0, F.size("_review") > 0
    status = F.when(rejected, "rejected").when(review, "review").otherwise("clean")
    return df.withColumns({"status": status, "reasons": F.when(rejected, F.col("_reject")).otherwise(F.col("_review"))}).drop("_t", "_reject", "_review")
