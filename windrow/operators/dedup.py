"""One row per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DELIVERY_ORDER = ("_kafka_partition", "_kafka_offset", "_source_object")


def first_delivery(
    df: DataFrame, key: str = "event_id", order: Sequence[str] = DELIVERY_ORDER
) -> DataFrame:
    """Keep the first delivery of each event.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the shuffle,
    so every map task sends at most one row per event however often it was delivered.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")
