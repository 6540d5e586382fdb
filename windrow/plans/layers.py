"""Raw events to bronze, silver and gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow import fixed
from windrow.functions import weather
from windrow.operators.dedup import first_delivery
from windrow.operators.labels import label_events
from windrow.operators.quality import valid_events
from windrow.operators.rolling import rolling_features


def typed_events(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Bronze columns and types. Not strict: text that does not parse becomes null."""
    if strict:
        time = F.to_timestamp("timestamp_utc")
        numbers = {c: F.col(c).cast("double") for c in fixed.BRONZE_MEASURES}
    else:
        time = F.try_to_timestamp("timestamp_utc")
        numbers = {c: F.col(c).try_cast("double") for c in fixed.BRONZE_MEASURES}
    return (
        raw.withColumns({"timestamp_utc": time, **numbers})
        .withColumn("event_date", F.to_date("timestamp_utc"))
        .select(*fixed.BRONZE_COLUMNS)
    )


def rejected_events(raw: DataFrame) -> DataFrame:
    """Valid raw rows in which some text did not parse."""
    names = ("timestamp_utc", *fixed.BRONZE_MEASURES)
    parsed = {
        c: F.try_to_timestamp(c) if c == "timestamp_utc" else F.col(c).try_cast("double") for c in names
    }
    bad = F.lit(False)
    for c, value in parsed.items():
        bad = bad | (F.col(c).isNotNull() & value.isNull())
    return valid_events(raw).where(bad)


def build_bronze(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Valid events, typed, one row per event id: one shuffle."""
    typed = typed_events(valid_events(raw), strict)
    if not strict:
        typed = typed.where(F.col("timestamp_utc").isNotNull())
    return first_delivery(typed)


def build_silver(bronze: DataFrame, **options) -> DataFrame:
    """Bronze with labels; raises on an empty table."""
    return label_events(bronze, **options)


def feature_rows(silver: DataFrame, **options) -> DataFrame:
    """Calendar and rolling columns in gold order, before incomplete rows go."""
    typed = silver.withColumns(
        {
            "timestamp_utc": F.col("timestamp_utc").cast("timestamp"),
            **{
                c: F.col(c).cast("double")
                for c in (
                    "temperature_c",
                    "wind_speed_kts",
                    "precipitation_mm",
                    "surface_pressure_pa",
                    "cape_j_kg",
                    "label",
                )
            },
        }
    )
    # Only what gold keeps goes through the shuffle; calendar columns are added after it.
    derived = {name for name, _, _ in fixed.ROLLING_FEATURES} | set(weather.calendar())
    carried = [c for c in fixed.GOLD_COLUMNS if c not in derived]
    return (
        rolling_features(typed.select(*carried), **options)
        .withColumns(weather.calendar())
        .select(*fixed.GOLD_COLUMNS)
    )


def build_gold(silver: DataFrame, **options) -> DataFrame:
    """Training features; a row with a null or NaN anywhere is left out after the windows."""
    return feature_rows(silver, **options).dropna()


def latest(df: DataFrame, n: int = 10) -> DataFrame:
    return df.orderBy(F.desc("timestamp_utc"), "event_id").limit(n)
