"""Line and JSON sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip


def numbered_lines(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """(file, line_no, value): text lines, numbered from 1 in each file; blank lines count.  ``most`` keeps the first lines of each file.

    Lines are numbered where they are read; only one row for each block of a file is brought together for the offsets.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i"))
    blocks = raw.groupBy("file", "block").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    out = raw.join(F.broadcast(blocks.select("file", "block", "first", before.alias("before"))), ["file", "block"])
    out = out.select("file", (F.col("before") + F.col("i") - F.col("first") + 1).alias("line_no"), "value")
    return out.where(F.col("line_no") <= most) if most is not None else out


def non_empty_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(strip(F.col("value")) != "")


def parsed(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Adds ``json`` (variant) to non-blank lines: bad JSON gives null, or fails with ``strict``."""
    parse = F.parse_json if strict else F.try_parse_json
    return lines.where(strip(F.col("value")) != "").withColumn("json", parse("value"))


def json_checks(required: list[str]) -> list:
    """Checks of a line's JSON in order: validity, required keys, ``metadata`` an object.  Null values count as present."""
    keys = F.json_object_keys("value")
    out = [("invalid_json", F.col("json").isNull()), ("not_an_object", keys.isNull())]
    out += [(f"missing_key:{k}", ~F.array_contains(keys, k)) for k in required]
    if "metadata" in required:
        out.append(("metadata_not_object", ~F.coalesce(F.schema_of_variant(F.try_variant_get("json", "$.metadata", "variant")).startswith("OBJECT"), F.lit(False))))
    return out


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A shard's manifest: one JSON object in a file."""
    return spark.read.json(path, multiLine=True)


def latest_file(spark: SparkSession, folder: str, pattern: str) -> str:
    """Path of the newest non-empty file below a folder; an error where there is none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    top = files.where("length > 0").select("path", "modificationTime").orderBy(F.desc("modificationTime"), "path").limit(1).collect()
    if not top:
        raise FileNotFoundError(f"no non-empty {pattern} below {folder}")
    return top[0].path
