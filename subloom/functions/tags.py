"""Override tags, drawings and karaoke of event texts, as Column expressions.

A text is cut into override blocks (from a brace to the next closing one) and what stands between them; a fold over
those pieces carries the drawing mode along and collects the plain text and everything that isn't text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subloom.functions.chars import LETTER, col, one_line, strip

BLOCK = r"\{[^}]*\}"
_PIECES = r"\{[^}]*\}|(?:[^{]++|\{(?![^}]*\}))++"
_KARAOKE = r"\\(?:kf|ko|K|k)(?=\d|\s|\\|\})"
_TEMPLATE = "array<struct<offset:int,kind:string,raw:string>>"
_EMPTY = {"plain": "string", "template": _TEMPLATE, "tags": "array<string>", "karaoke": "boolean", "drawing": "boolean", "mode": "boolean"}


def breaks(c: str | Column) -> Column:
    """Line breaks of the format become new lines, hard spaces become spaces."""
    return F.regexp_replace(F.regexp_replace(col(c), r"\\[Nn]", "\n"), r"\\h", " ")


def _state(**fields: Column) -> Column:
    return F.struct(*[fields[k].cast(t).alias(k) for k, t in _EMPTY.items()])


def _step(acc: Column, piece: Column) -> Column:
    is_tag = piece.startswith("{") & piece.endswith("}")
    modes = F.regexp_extract_all(piece, F.lit(r"\\p(\d+)"), F.lit(1))
    at = F.length(acc["plain"])
    kind = F.when(is_tag, "tag").when(acc["mode"], "draw")
    other = F.when(kind.isNotNull(), F.array(F.struct(at.alias("offset"), kind.alias("kind"), piece.alias("raw")))).otherwise(F.array().cast(_TEMPLATE))
    return _state(
        plain=F.when(kind.isNull(), F.concat(acc["plain"], breaks(piece))).otherwise(acc["plain"]),
        template=F.concat(acc["template"], other),
        tags=F.when(is_tag, F.concat(acc["tags"], F.array(piece))).otherwise(acc["tags"]),
        karaoke=acc["karaoke"] | (is_tag & piece.rlike(_KARAOKE)),
        drawing=acc["drawing"] | (~is_tag & acc["mode"]),
        mode=F.when(is_tag & (F.size(modes) > 0), F.try_element_at(modes, F.lit(-1)).rlike("[1-9]")).otherwise(acc["mode"]),
    )


def protect(c: str | Column) -> Column:
    """struct(plain, template(offset, kind, raw), tags, karaoke, drawing) of a text; null for null.

    Texts without braces, the most, don't enter the fold.
    """
    text = col(c)
    none = {"template": F.array(), "tags": F.array(), "karaoke": F.lit(False), "drawing": F.lit(False), "mode": F.lit(False)}
    folded = F.aggregate(F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0)), _state(plain=F.lit(""), **none), _step)
    full = F.when(text.contains("{"), folded).when(text.isNotNull(), _state(plain=breaks(text), **none))
    # Through an array of one, so that the fold is worked out once and not for each field.
    once = F.transform(F.array(full), lambda p: F.struct(*[p[k].alias(k) for k in _EMPTY if k != "mode"]))
    return F.when(text.isNotNull(), F.get(once, F.lit(0)))


def strip_tags(c: str | Column) -> Column:
    return protect(c)["plain"]


def has_tags(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike(BLOCK), F.lit(False))


def tags_of(c: str | Column) -> Column:
    return F.regexp_extract_all(col(c), F.lit(BLOCK), F.lit(0))


def is_translatable_struct(p: Column) -> Column:
    """Whether a protected text is dialogue: no karaoke, and a letter in its plain text."""
    return F.coalesce(~p["karaoke"] & p["plain"].rlike(LETTER), F.lit(False))


def is_translatable(c: str | Column) -> Column:
    return is_translatable_struct(protect(c))


def plain_text(c: str | Column) -> Column:
    """Text of an event on one line, tags removed."""
    return one_line(strip_tags(c))


def _more(a: Column, b: Column, word: str) -> Column:
    """Messages for the tags that a has more often than b."""
    n = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    surplus = lambda x: n(a, x) - n(b, x)
    over = F.filter(F.array_distinct(a), lambda x: surplus(x) > 0)
    return F.transform(over, lambda x: F.concat(F.lit(f"{word} tag "), x, F.when(surplus(x) > 1, F.concat(F.lit(" x"), surplus(x).cast("string"))).otherwise("")))


def tag_issues(original: str | Column, changed: str | Column) -> Column:
    """What differs between the override blocks and drawings of two texts; an empty array where nothing does."""
    a, b = F.coalesce(col(original), F.lit("")), F.coalesce(col(changed), F.lit(""))
    ta, tb = tags_of(a), tags_of(b)
    missing, extra = _more(ta, tb, "missing"), _more(tb, ta, "unexpected")
    draws = lambda c: F.transform(F.filter(protect(c)["template"], lambda x: x["kind"] == "draw"), lambda x: x["raw"])
    one = lambda cond, text: F.when(cond, F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))
    braces = lambda x, ch: F.length(x) - F.length(F.replace(x, F.lit(ch), F.lit("")))
    unbalanced = one(braces(b, "{") != braces(b, "}"), "unbalanced braces in translated text")
    reordered = one((F.size(missing) == 0) & (F.size(extra) == 0) & (ta != tb), "override tags reordered")
    drawn = one((a.contains("{") | b.contains("{")) & (draws(a) != draws(b)), "drawing commands changed or lost")
    return F.concat(unbalanced, missing, extra, reordered, drawn)


def dialogue_text(c: str | Column) -> Column:
    """Stripped plain text."""
    return strip(strip_tags(c))
