"""Events as topic records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow import fixed


def encode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Key = airport (a fixed word when there is none), value = the event as JSON."""
    return df.select(
        F.coalesce(F.col("airport"), F.lit(fixed.UNKNOWN_KEY)).alias("key"),
        F.to_json(F.struct(*(columns or df.columns))).alias("value"),
    )


def send(df: DataFrame, servers: str, topic: str = fixed.TOPIC) -> None:
    """Write encoded records to a topic. Needs the Kafka connector on the class path."""
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
