"""Time stamps H:MM:SS.cc as seconds and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subloom.functions.chars import col, strip

_STAMP = r"^(?:[+-]?\d+:)?[+-]?\d+:[+-]?(?:\d+\.?\d*|\.\d+)$"


def to_seconds(stamp: str | Column) -> Column:
    """'0:01:23.40' as 83.4; minutes and seconds alone are read too; null for anything else (a bad stamp)."""
    s = F.regexp_replace(strip(stamp), r"[ ]*:[ ]*", ":")
    parts = F.split(s, ":")
    at = lambda i, t: F.try_element_at(parts, F.lit(i)).try_cast(t)
    hours = F.when(F.size(parts) == 3, at(1, "long")).otherwise(F.lit(0))
    return F.when(s.rlike(_STAMP), hours * 3600 + at(-2, "long") * 60 + at(-1, "double"))


def to_stamp(seconds: str | Column) -> Column:
    """83.4 as '0:01:23.40'; negative values count as 0, halves go to the even centisecond; null for null."""
    cs = F.rint(F.greatest(col(seconds), F.lit(0.0)) * 100).cast("long")
    h, m = F.floor(cs / 360000), F.pmod(F.floor(cs / 6000), F.lit(60))
    s, c = F.pmod(F.floor(cs / 100), F.lit(60)), F.pmod(cs, F.lit(100))
    return F.when(col(seconds).isNotNull(), F.format_string("%d:%02d:%02d.%02d", h, m, s, c))
