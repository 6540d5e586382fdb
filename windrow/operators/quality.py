"""Checks on incoming rows and on what was stored."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow import fixed


def valid_events(df: DataFrame, keys: Sequence[str] = fixed.REQUIRED_KEYS) -> DataFrame:
    """Rows that carry every key. A key that is present but null counts as missing."""
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in expected if c not in have]


def require_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, expected)
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise on empty input. ``isEmpty`` stops at the first row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def column_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Per expected column: is it there, and in how many rows is it filled. One aggregate."""
    have = set(df.columns)
    filled = df.agg(*[(F.count(c) if c in have else F.lit(0).cast("long")).alias(c) for c in expected])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(c in have).alias("present"),
                F.col(c).alias("filled_rows"),
            )
            for c in expected
        ]
    )
    return filled.select(F.inline(rows))


def rows_per_object(df: DataFrame) -> DataFrame:
    return df.groupBy("_source_object").agg(F.count("*").alias("row_count"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count"))


def time_bounds(df: DataFrame, time: str = "timestamp_utc") -> DataFrame:
    return df.agg(
        F.min(time).alias("min_timestamp"),
        F.max(time).alias("max_timestamp"),
        F.count("*").alias("row_count"),
    )


def storage_summary(df: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """One row describing what is stored.

    Rows are first counted per (airport, object), combined on the map side, so a hot
    airport or object costs one row per task, and all else, both distinct counts too, is one
    aggregate of that small result: the input is read once. The list of airports is as long as
    there are airports. With a ``manifest`` the stored objects are those listed, including
    objects that hold no rows.
    """
    per_pair = df.groupBy("airport", "_source_object").agg(
        F.count("*").alias("n"),
        F.min("timestamp_utc").alias("t0"),
        F.max("timestamp_utc").alias("t1"),
        F.min("_kafka_offset").alias("o0"),
        F.max("_kafka_offset").alias("o1"),
    )
    objects = F.count_distinct("_source_object") if manifest is None else F.lit(0).cast("long")
    summary = per_pair.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_rows"),
        F.count_distinct("airport").alias("unique_airports"),
        F.array_join(F.array_sort(F.collect_set("airport")), ", ").alias("airport_list"),
        F.min("t0").alias("min_timestamp"),
        F.max("t1").alias("max_timestamp"),
        F.min("o0").alias("min_kafka_offset"),
        F.max("o1").alias("max_kafka_offset"),
        objects.alias("stored_objects"),
    )
    if manifest is None:
        return summary
    return summary.withColumn("stored_objects", manifest.agg(F.count("*")).scalar())
