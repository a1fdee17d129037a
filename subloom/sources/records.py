"""Records as JSON lines: read, written, and taken from payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType(
    [
        T.StructField("movie_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("context_before", T.StringType()),
        T.StructField("context_after", T.StringType()),
        T.StructField("speaker", T.StringType()),
        T.StructField("style", T.StringType()),
        T.StructField("start", T.DoubleType()),
        T.StructField("end", T.DoubleType()),
        T.StructField("event_index", T.IntegerType()),
        T.StructField("has_tags", T.BooleanType()),
    ]
)


#: Columns that put the rows of read_jsonl in the order of their files and lines, unique together.
LINE_ORDER = ["file_seq", "file", "block", "row_no"]


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType = RECORD) -> DataFrame:
    """Records of files or folders of JSON lines; a line that is no JSON stops the job, blank lines don't count.

    Of a folder, only its *.jsonl and *.json files are read, in the order of their names. Adds LINE_ORDER: the place in the
    list of paths, the file, the place of the split in it and the row (which counts up within a split).
    """
    out = None
    for k, p in enumerate([paths] if isinstance(paths, str) else paths):
        rows = spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", "*.json*").json(p)
        order = [F.lit(k).alias("file_seq"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row_no")]
        rows = rows.select(*[F.col(f"`{c}`") for c in schema.names], *order)
        out = rows if out is None else out.unionByName(rows)
    order = T.StructType([T.StructField("file_seq", T.IntegerType()), T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("row_no", T.LongType())])
    return out if out is not None else spark.createDataFrame([], T.StructType([*schema, *order]))


def write_jsonl(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines in a folder, nulls and non-ASCII characters written as they are; by: a folder for each of its values.

    What stood in the folder is replaced; with by, only the folders of values that are written again.
    """
    w = df.write.mode("overwrite").option("ignoreNullFields", "false").option("partitionOverwriteMode", "dynamic" if by else "static")
    (w.partitionBy(by) if by else w).json(path)


def from_payload(df: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """keep and the columns of RECORD from JSON payloads of any layout; payloads that can't be read are left out."""
    v = df.withColumn("_v", F.try_parse_json(F.col(payload))).filter(F.col("_v").isNotNull())
    return v.select(*keep, *[F.try_variant_get("_v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in RECORD])
