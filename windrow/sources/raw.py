"""Raw zone: JSON lines below a prefix, and the listing of what is stored there."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow import schemas

_CORRUPT = "_corrupt_record"


def _relative(path: str, column: str):
    """The part of an object's address below ``path``, whatever directories are called."""
    place = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")
    prefix = place if place.startswith("/") else f"/{place}"
    at = F.locate(f"{prefix}/", F.col(column))
    return F.when(at > 0, F.substr(F.col(column), at + len(prefix) + 1)).otherwise(F.col(column))


def scan_raw(
    spark: SparkSession, path: str, schema: T.StructType = schemas.RAW, bad_lines: str = "fail"
) -> DataFrame:
    """All events below ``path`` with the object they came from in ``_source_object``.

    Blank lines are skipped. A malformed line stops the job; with ``bad_lines="keep"`` it
    becomes a row whose ``_corrupt_record`` holds the text (see ``good_lines``, ``bad_lines``).
    Directory names below the prefix do not become columns.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if bad_lines == "fail":
        reader = reader.schema(schema).option("mode", "FAILFAST")
        names = schema.names
    else:
        wider = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
        reader = reader.schema(wider).option("mode", "PERMISSIVE")
        names = wider.names
    return reader.json(path).select(
        *names, _relative(path, "_metadata.file_path").alias("_source_object")
    )


def with_object(df: DataFrame, path: str) -> DataFrame:
    """``df`` read from files below ``path``, with the key of each row's object."""
    return df.withColumn("_source_object", _relative(path, "_metadata.file_path"))


def good_lines(df: DataFrame) -> DataFrame:
    return df.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def bad_lines(df: DataFrame) -> DataFrame:
    return df.where(F.col(_CORRUPT).isNotNull()).select("_source_object", _CORRUPT)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Key, size and time of every object below ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            _relative(path, "path").alias("object_key"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def last_objects(listing: DataFrame, n: int = 20) -> DataFrame:
    return listing.orderBy(F.desc("object_key")).limit(n)
