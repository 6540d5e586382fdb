"""Exact order statistics without putting all rows in one task.

Values are grouped first, so that equal values become one row. The distinct values are
spread over buckets whose edges come from an approximate sketch; each bucket is sorted by
its own task and the bucket totals, one row per bucket, give what lies below it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def present(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull() & ~F.isnan(value))


#: Rows in a bucket, about; one task sorts what is distinct in one.
BUCKET_ROWS = 1_000_000


def _edges(rows: DataFrame, value: str, buckets: int | None) -> list[float]:
    """Inner edges of buckets with about as many rows each; their number follows the rows'."""
    buckets = buckets or max(64, -(-rows.count() // BUCKET_ROWS))
    edges = rows.approxQuantile(value, [i / buckets for i in range(1, buckets)], 1 / (4 * buckets))
    # +0.0 turns a negative zero into zero, which is how grouping sees it.
    return sorted({e + 0.0 for e in edges if math.isfinite(e)})


def _placed(rows: DataFrame, value: str, edges: list[float]) -> DataFrame:
    if not edges:
        return rows.withColumn("_bucket", F.lit(0.0))
    splits = [-math.inf, *edges, math.inf]
    return Bucketizer(splits=splits, inputCol=value, outputCol="_bucket").transform(rows)


def bucketed(
    df: DataFrame,
    value: str,
    sums: dict[str, Column],
    buckets: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per distinct value with its ``sums`` and its ``_bucket``. Runs the sketch job."""
    rows = present(df.withColumn(value, F.col(value).cast("double")), value)
    edges = _edges(rows, value, buckets)
    return _placed(rows.groupBy(*by, value).agg(*[c.alias(n) for n, c in sums.items()]), value, edges)


def _bucket_offsets(grouped: DataFrame, names: list[str], by: Sequence[str] = ()) -> DataFrame:
    totals = grouped.groupBy(*by, "_bucket").agg(*[F.sum(n).alias(n) for n in names])
    # One row per bucket and group, so these windows are bounded by the bucket count.
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_off_{n}") for n in names],
        *[F.col(n).alias(f"_in_{n}") for n in names],
        *[F.sum(n).over(Window.partitionBy(*by)).alias(f"{n}_total") for n in names],
    )


def cumulative(
    df: DataFrame,
    value: str,
    sums: dict[str, Column],
    buckets: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Per distinct value: the sums, ``<name>_below`` over all smaller values, ``<name>_total``.

    ``by`` names a few groups (experiment runs, say) that are kept apart.
    """
    names = list(sums)
    grouped = bucketed(df, value, sums, buckets, by)
    offsets = _bucket_offsets(grouped, names, by)
    inside = Window.partitionBy(*by, "_bucket").orderBy(value)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return grouped.join(offsets, [*by, "_bucket"]).select(
        *by,
        value,
        *names,
        *[
            (F.coalesce(F.sum(n).over(before), F.lit(0)) + F.col(f"_off_{n}")).alias(f"{n}_below")
            for n in names
        ],
        *[f"{n}_total" for n in names],
    )


def exact_quantile(
    df: DataFrame, value: str, probability: float, buckets: int | None = None, name: str = "threshold"
) -> DataFrame:
    """The smallest value with at least ``probability`` of the rows at or below it; one row.

    Nulls and NaN are left out. Rows are placed in buckets and counted there before anything
    is shuffled; only the rows of the one bucket that holds the answer are, and sorted. The
    result has the column's own type, so large integers stay exact.
    """
    rows = present(df, value).select(F.col(value).alias("_v"), F.col(value).cast("double").alias("_d"))
    placed = _placed(rows, "_d", _edges(rows, "_d", buckets))
    offsets = _bucket_offsets(placed.groupBy("_bucket").agg(F.count("*").alias("_n")), ["_n"])
    holder = offsets.withColumn(
        "_target", F.greatest(F.ceil(F.lit(probability) * F.col("_n_total")), F.lit(1)).cast("long")
    ).where((F.col("_off__n") < F.col("_target")) & (F.col("_target") <= F.col("_off__n") + F.col("_in__n")))
    # The holder is one row.
    held = placed.join(F.broadcast(holder.select("_bucket", "_off__n", "_target")), "_bucket")
    counted = held.groupBy("_v", "_off__n", "_target").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy("_target").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    running = counted.select("_v", "_target", (F.sum("_n").over(upto) + F.col("_off__n")).alias("_upto"))
    return running.where(F.col("_upto") >= F.col("_target")).agg(F.min("_v").alias(name))
