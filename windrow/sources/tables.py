"""Layer tables: one of several formats, the first that is there."""

from __future__ import annotations

import re
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Conditions that mean "this format or path is not there"; every other error is raised.
_ABSENT = {"PATH_NOT_FOUND", "DATA_SOURCE_NOT_FOUND", "DELTA_TABLE_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE"}
_ERRORS = (AnalysisException, Py4JJavaError)


def condition(error: Exception) -> str:
    """Spark's name for an error, also when the connector lookup raised it inside the JVM."""
    if isinstance(error, Py4JJavaError):
        named = re.match(r"\[([A-Z_.]+)\]", error.java_exception.getMessage() or "")
        return named.group(1) if named else ""
    return error.getCondition() or ""


def _is_absent(error: Exception) -> bool:
    return condition(error).split(".")[0] in _ABSENT


def read_table(
    spark: SparkSession,
    base: str,
    schema: T.StructType | None = None,
    formats: Sequence[str] = ("delta", "parquet"),
) -> DataFrame:
    """Read ``<base>_<format>`` for the first format that is there."""
    absent = []
    for fmt in formats:
        reader = spark.read.format(fmt)
        if schema is not None and fmt != "delta":
            reader = reader.schema(schema)
        try:
            return reader.load(f"{base}_{fmt}")
        except _ERRORS as error:
            if not _is_absent(error):
                raise
            absent.append(f"{fmt}: {condition(error)}")
    raise FileNotFoundError(f"No table at {base} ({'; '.join(absent)})")


def read_if_there(
    spark: SparkSession, path: str, schema: T.StructType | None, fmt: str = "parquet", base: str | None = None
) -> DataFrame | None:
    """A table, or None when nothing was written yet; without a schema the files themselves.

    ``path`` may be a pattern; ``base`` then says where directory columns begin.
    """
    reader = spark.read.format(fmt)
    reader = reader.schema(schema) if schema else reader.option("recursiveFileLookup", "true")
    if base:
        reader = reader.option("basePath", base)
    try:
        return reader.load(path)
    except _ERRORS as error:
        if not _is_absent(error):
            raise
        return None
