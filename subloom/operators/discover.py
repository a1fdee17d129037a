"""Which files are English, which are copies, and under what id each is kept."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subloom.functions.chars import CYRILLIC, LATIN, LETTER, count, one_line
from subloom.functions.tags import is_translatable_struct, protect
from subloom.functions.text import base_key, group_dir, language_from_filename, language_from_folder, make_id
from subloom.operators.blocks import ranked
from subloom.session import stored


def script_language(events: DataFrame, file: str = "file_id", max_lines: int = 300) -> DataFrame:
    """file and detected: mn where half of the letters of the first lines are Cyrillic, en where half are Latin, else null.

    The first max_lines translatable texts among the first 3 * max_lines Dialogue events count, by line_no; counts are
    summed over them before they are divided. WindowGroupLimit keeps no more rows than that of a file.
    """
    w = Window.partitionBy(file).orderBy("line_no")
    first = events.filter("kind = 'Dialogue'").select(file, "line_no", "text").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= 3 * max_lines)
    first = first.withColumn("_p", protect("text")).filter(is_translatable_struct(F.col("_p"))).withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= max_lines)
    plain = one_line(F.col("_p")["plain"])
    sums = first.groupBy(file).agg(F.sum(count(plain, LETTER)).alias("letters"), F.sum(count(plain, CYRILLIC)).alias("cyrillic"), F.sum(count(plain, LATIN)).alias("latin"))
    return sums.select(file, "letters", "cyrillic", "latin", detected(F.col("letters"), F.col("cyrillic"), F.col("latin")).alias("detected"))


def detected(letters: Column, cyrillic: Column, latin: Column) -> Column:
    some = F.nullif(letters, F.lit(0))
    return F.when(cyrillic / some >= 0.5, "mn").when(latin / some >= 0.5, "en")


def with_language(files: DataFrame) -> DataFrame:
    """Adds language and language_source to files with stem, rel_dir and detected: name, else folder; content outvotes both."""
    by_name, by_folder = language_from_filename("stem"), language_from_folder("rel_dir")
    prior = F.coalesce(by_name, by_folder)
    outvoted = F.col("detected").isNotNull() & ~F.col("detected").eqNullSafe(prior)
    source = F.when(outvoted, "content").when(by_name.isNotNull(), "filename").when(by_folder.isNotNull(), "folder").otherwise("unknown")
    return files.withColumns({"language": F.when(outvoted, F.col("detected")).otherwise(prior), "language_source": source, "group_dir": group_dir("rel_dir"), "base_key": base_key("stem")})


def path_parts(files: DataFrame) -> DataFrame:
    """Adds rel_dir (below root) and stem to rows with root and path."""
    rel = F.substring(F.col("path"), F.length("root") + 2, F.length("path"))
    name = F.element_at(F.split(rel, "/"), -1)
    return files.withColumns({"rel_dir": F.when(rel.contains("/"), F.regexp_replace(rel, "/[^/]*$", "")).otherwise(""), "stem": F.regexp_replace(name, r"\.[^.]*$", "")})


def with_disposition(files: DataFrame) -> DataFrame:
    """Adds disposition (kept, skipped, duplicate), reason and duplicate_of to files with language, sha1, root_no and path.

    Only English files register their digest; the first root, then the first path in small letters, is kept.
    """
    english = F.coalesce(F.col("language") == "en", F.lit(False))
    order = F.struct("root_no", F.lower("path").alias("low"), "path")
    first = files.filter(english).groupBy("sha1").agg(F.min(order).alias("_f"))
    out = files.join(first, "sha1", "left")
    copy = english & (F.col("_f.path") != F.col("path"))
    return out.withColumns(
        {
            "disposition": F.when(~english, "skipped").when(copy, "duplicate").otherwise("kept"),
            "reason": F.when(F.col("language").isNull(), "language_unknown").when(~english, "not_english"),
            "duplicate_of": F.when(copy, F.col("_f.path")),
        }
    ).drop("_f")


def unique_ids(wanted: list[str]) -> list[str]:
    """Ids in order; a taken one gets the first free suffix _2, _3, ..."""
    used: set[str] = set()
    out = []
    for base in wanted:
        name, n = base, 1
        while name in used:
            n += 1
            name = f"{base}_{n}"
        used.add(name)
        out.append(name)
    return out


def with_ids(kept: DataFrame) -> DataFrame:
    """Adds id to kept files (root_no, path, wanted_id): unique, first come first served by root and path.

    Files of one name are numbered over the whole cluster. Only where some of the numbers may be taken by other names do
    such a name and those names have to be settled one file after the other.
    """
    rows = kept.select("root_no", "path", "wanted_id", F.lower("path").alias("low"))
    counts = stored(rows.groupBy("wanted_id").agg(F.count(F.lit(1)).alias("n")))
    suffix = r"^(.+)_([2-9]|[1-9]\d+)$"
    numbers = counts.select(F.col("wanted_id").alias("v"), F.regexp_extract("wanted_id", suffix, 1).alias("u"), F.regexp_extract("wanted_id", suffix, 2).try_cast("long").alias("k")).filter("u <> ''")
    taken = numbers.join(counts.filter("n > 1").withColumnRenamed("wanted_id", "u"), "u")
    taken = taken.join(taken.groupBy("u").agg(F.count(F.lit(1)).alias("others")), "u").filter("k <= n + others")
    mixed = taken.select(F.explode(F.array("u", "v")).alias("wanted_id")).distinct()

    def settle(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["root_no", "low", "path"])
        return pd.DataFrame({"root_no": part["root_no"], "path": part["path"], "id": unique_ids(part["wanted_id"].tolist())})

    family = F.regexp_replace("wanted_id", r"(?:_\d+)+$", "")
    settled = rows.join(mixed, "wanted_id", "left_semi").groupBy(family).applyInPandas(settle, "root_no int, path string, id string")
    plain = ranked(rows.join(mixed, "wanted_id", "left_anti"), "wanted_id", ["root_no", "low", "path"], "_n")
    plain = plain.select("root_no", "path", F.when(F.col("_n") == 1, F.col("wanted_id")).otherwise(F.concat_ws("_", "wanted_id", F.col("_n").cast("string"))).alias("id"))
    return kept.join(settled.unionByName(plain), ["root_no", "path"])


def with_wanted_id(files: DataFrame) -> DataFrame:
    return files.withColumn("wanted_id", make_id("group_dir", "base_key"))
