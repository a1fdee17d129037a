"""Subtitle files as rows: scan, encoding, text and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.functions.chars import col

#: File name endings that are read (fixed values).
EXTENSIONS = ["ass", "ssa", "srt"]
#: Upper half of the Cyrillic Windows code page in byte order (fixed values); its one gap, 0x98, stays as it is.
CP1251 = bytes(range(0x80, 0x98)).decode("cp1251") + "\x98" + bytes(range(0x99, 0x100)).decode("cp1251")


def scan(spark: SparkSession, roots: list[str], pattern: str | None = None) -> DataFrame:
    """root_no, root, path, content of every subtitle file under the roots, whatever the letter case of its ending.

    Files that can't be read, or are too long for a row, are left out; `unread` lists them.
    """
    limit = F.col("length") <= _longest(spark)
    return _listed(spark, roots, pattern, "content", limit, ignoreCorruptFiles=True, ignoreMissingFiles=True)


def unread(spark: SparkSession, roots: list[str], found: DataFrame, pattern: str | None = None) -> DataFrame:
    """path, error of the subtitle files under the roots of which `found` (root_no, path) has no row."""
    there = _listed(spark, roots, pattern, "length")  # no content is read for this
    error = F.when(F.col("length") > _longest(spark), F.format_string("longer than %d bytes", F.lit(_longest(spark)))).otherwise("can't be read")
    return there.join(found.select("root_no", "path"), ["root_no", "path"], "left_anti").select("path", error.alias("error"))


def _longest(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))


def _listed(spark: SparkSession, roots: list[str], pattern: str | None, column: str, only: Column | None = None, **options: bool) -> DataFrame:
    out = None
    for k, root in enumerate(roots):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).options(**options).load(root)
        found = found.filter(F.lower("path").rlike(pattern or rf"\.({'|'.join(EXTENSIONS)})$"))
        found = found if only is None else found.filter(only)
        rows = found.select(F.lit(k).alias("root_no"), F.lit(root.rstrip("/")).alias("root"), F.regexp_replace("path", "^file:/*", "/").alias("path"), column)
        out = rows if out is None else out.unionByName(rows)
    return out


def encoding(content: str | Column) -> Column:
    """struct(codec, bom): byte order marks first, then strict UTF-8, then cp1251, and latin-1 where that has a gap."""
    c = col(content)
    begins = lambda h: F.startswith(c, F.unhex(F.lit(h)))
    valid = F.is_valid_utf8(c.cast("string"))
    gap = F.contains(c, F.unhex(F.lit("98")))
    codec = F.when(begins("EFBBBF"), "utf-8").when(begins("FFFE"), "utf-16-le").when(begins("FEFF"), "utf-16-be").when(valid, "utf-8").when(gap, "latin-1").otherwise("cp1251")
    return F.struct(codec.alias("codec"), (begins("EFBBBF") | begins("FFFE") | begins("FEFF")).alias("bom"))


def decoded(content: str | Column, codec: Column, bom: Column) -> Column:
    """The text without its byte order mark; what can't be decoded becomes the replacement character."""
    c = col(content)
    body = F.when(bom, F.substring(c, F.when(codec == "utf-8", 4).otherwise(3), F.length(c))).otherwise(c)
    latin = F.decode(body, "ISO-8859-1")
    upper = "".join(map(chr, range(0x80, 0x100)))
    return (
        F.when(codec == "utf-8", F.make_valid_utf8(body.cast("string")))
        .when(codec == "utf-16-le", F.decode(body, "UTF-16LE"))
        .when(codec == "utf-16-be", F.decode(body, "UTF-16BE"))
        .when(codec == "cp1251", F.translate(latin, upper, CP1251))
        .otherwise(latin)
    )


def with_text(files: DataFrame) -> DataFrame:
    """Adds codec, bom, encoding (as it is named with its mark), text, newline and sha1 to rows with content."""
    e = encoding("content")
    out = files.withColumn("_e", e).withColumns({"codec": F.col("_e.codec"), "bom": F.col("_e.bom")}).drop("_e")
    out = out.withColumns({"text": decoded("content", F.col("codec"), F.col("bom")), "sha1": F.sha1("content")})
    name = F.when((F.col("codec") == "utf-8") & F.col("bom"), "utf-8-sig").otherwise(F.col("codec"))
    return out.withColumns({"encoding": name, "newline": newline("text")})


def newline(text: str | Column) -> Column:
    """CRLF where it occurs anywhere, else LF."""
    return F.when(col(text).contains("\r\n"), F.lit("\r\n")).otherwise(F.lit("\n"))


def lines(files: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """key, line_no, line: the text split at its one newline; a final newline leaves an empty last line."""
    t = F.regexp_replace(col(text), "^\\x{feff}", "")
    parts = F.when(t.contains("\r\n"), F.split(t, "\r\n", -1)).otherwise(F.split(t, "\n", -1))
    return files.select(key, F.posexplode(parts).alias("line_no", "line"))
