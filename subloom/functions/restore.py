"""Functions that no built-in expresses: tags put back around a translation, and character references."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from subloom.functions.chars import col
from subloom.functions.tags import protect

REACH = 3


def _at_space(text: str, pos: int) -> int:
    """The place nearest to pos, REACH away at most and left before right, that touches white space; else pos."""
    n = len(text)
    if not 0 < pos < n:
        return min(max(pos, 0), n)
    near = sorted(range(max(1, pos - REACH), min(n - 1, pos + REACH) + 1), key=lambda k: (abs(k - pos), k))
    return next((k for k in near if text[k - 1].isspace() or text[k].isspace()), pos)


def restored(plain: str, template: list, translated: str) -> str:
    """The translation with the pieces of the template: first and last ones at the ends, others in proportion, in order."""
    size, out, done = len(plain), [], 0
    for offset, raw in template:
        if offset <= 0:
            pos = 0
        elif offset >= size:
            pos = len(translated)
        else:
            pos = _at_space(translated, round(offset / size * len(translated)))
        pos = max(pos, done)
        out += [translated[done:pos].replace("\n", "\\N"), raw]
        done = pos
    return "".join(out) + translated[done:].replace("\n", "\\N")


@F.pandas_udf(StringType())
def _restore(protected: pd.DataFrame, translated: pd.Series) -> pd.Series:
    rows = zip(protected["plain"], protected["template"], translated, strict=True)
    return pd.Series([None if p is None or t is None else restored(p, [(x["offset"], x["raw"]) for x in tpl], t) for p, tpl, t in rows])


def restore(original: str | Column, translated: str | Column) -> Column:
    """The tags and drawings of the original text around a translated plain text; null where either is null."""
    p = protect(original)
    return _restore(F.struct(p["plain"].alias("plain"), p["template"].alias("template")), col(translated))


@F.pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def unescape(c: str | Column) -> Column:
    """Character references become characters. Decide by a filter or union which rows need it: a UDF sees them all."""
    return _unescape(col(c))
