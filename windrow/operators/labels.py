"""Disruption labels: the weather rule, or a score quantile when the rule finds one class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow import fixed
from windrow.functions import weather
from windrow.operators.ordered import exact_quantile


def with_rule(
    df: DataFrame,
    wind_limit: float = fixed.WIND_LIMIT_KTS,
    precip_limit: float = fixed.PRECIP_LIMIT_MM,
) -> DataFrame:
    measures = ("wind_speed_kts", "precipitation_mm", "cape_j_kg")
    return df.withColumns({m: F.col(m).cast("double") for m in measures}).withColumns(
        {
            "weather_rule_label": weather.disruption_rule(wind_limit, precip_limit),
            "risk_score_proxy": weather.risk_score(),
        }
    )


def class_count(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count_distinct(label).alias("class_count"))


def has_two_classes(df: DataFrame, label: str = "label") -> bool | None:
    """Is there more than one label value; None when there is no label at all.

    Both looks stop at the first row they find.
    """
    first = df.select(label).where(F.col(label).isNotNull()).first()
    return None if first is None else not df.where(F.col(label) != first[0]).isEmpty()


def score_threshold(
    df: DataFrame,
    score: str = "risk_score_proxy",
    quantile: float = fixed.FALLBACK_QUANTILE,
    relative_error: float = fixed.FALLBACK_ERROR,
) -> float:
    """The score quantile. An error of 0 takes the exact distributed path, not a full sketch."""
    if relative_error == 0:
        value = exact_quantile(df, score, quantile).first()[0]
    else:
        value = next(iter(df.approxQuantile(score, [quantile], relative_error)), None)
    if value is None:
        raise ValueError(f"{score} has no values to take a quantile of")
    return value


def label_events(
    df: DataFrame,
    quantile: float = fixed.FALLBACK_QUANTILE,
    relative_error: float = fixed.FALLBACK_ERROR,
    wind_limit: float = fixed.WIND_LIMIT_KTS,
    precip_limit: float = fixed.PRECIP_LIMIT_MM,
) -> DataFrame:
    """Add rule label, score, label and label source.

    Looks at the data to choose the label (early-exit jobs), so hand it a table. Raises
    when there is nothing to label.
    """
    ruled = with_rule(df, wind_limit, precip_limit)
    two_classes = has_two_classes(ruled, "weather_rule_label")
    if two_classes is None:
        raise ValueError("bronze has no rows to label")
    if two_classes:
        label, source = F.col("weather_rule_label"), fixed.RULE_SOURCE
    else:
        limit = score_threshold(ruled, quantile=quantile, relative_error=relative_error)
        label = F.when(F.col("risk_score_proxy") >= limit, 1.0).otherwise(0.0)
        source = fixed.FALLBACK_SOURCE
    return ruled.withColumns({"label": label, "label_source": F.lit(source)})
