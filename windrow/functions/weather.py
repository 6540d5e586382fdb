"""Column expressions: event keys, unit conversion, the label rule, the risk score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrow import fixed


def event_key(airport: str = "airport", time: str = "timestamp_utc") -> Column:
    return F.concat(F.col(airport), F.lit("_"), F.date_format(F.col(time), "yyyy-MM-dd'T'HH:mm:ss"))


def longitude_360(lon) -> Column:
    """Degrees east in [0, 360); ``%`` would keep the sign."""
    return F.pmod(lon, F.lit(360.0))


def celsius(kelvin: str = "temperature_k") -> Column:
    return F.col(kelvin) - F.lit(fixed.KELVIN_OFFSET)


def wind_speed(u: str = "wind_u_ms", v: str = "wind_v_ms") -> Column:
    return F.sqrt(F.col(u) * F.col(u) + F.col(v) * F.col(v))


def knots(metres_per_second: Column) -> Column:
    return metres_per_second * F.lit(fixed.KNOTS_PER_MS)


def millimetres(metres: str = "precipitation_m") -> Column:
    return F.col(metres) * F.lit(fixed.MM_PER_M)


def disruption_rule(
    wind_limit: float = fixed.WIND_LIMIT_KTS, precip_limit: float = fixed.PRECIP_LIMIT_MM
) -> Column:
    """1.0 when wind or precipitation is over its limit; a null measure does not count as over."""
    over = (F.col("wind_speed_kts") > wind_limit) | (F.col("precipitation_mm") > precip_limit)
    return F.when(over, 1.0).otherwise(0.0)


def risk_score() -> Column:
    return (
        F.col("wind_speed_kts") / fixed.WIND_SCALE
        + F.col("precipitation_mm") / fixed.PRECIP_SCALE
        + F.col("cape_j_kg") / fixed.CAPE_SCALE
    )


def calendar(time: str = "timestamp_utc") -> dict[str, Column]:
    return {"hour_of_day": F.hour(time), "day_of_week": F.dayofweek(time), "month": F.month(time)}


def is_train(key: str = "event_id", percent: int = fixed.SPLIT_TRAIN_PERCENT) -> Column:
    """Split by a hash of the id: the same row lands on the same side however data is partitioned."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 100
    return bucket < percent
