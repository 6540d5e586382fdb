"""Train and test rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow import fixed
from windrow.functions.weather import is_train
from windrow.operators.labels import has_two_classes


def split_rows(
    df: DataFrame, key: str = "event_id", percent: int = fixed.SPLIT_TRAIN_PERCENT
) -> tuple[DataFrame, DataFrame]:
    train = is_train(key, percent)
    return df.where(train), df.where(~train)


def split_or_all(
    df: DataFrame, key: str = "event_id", label: str = "label", percent: int = fixed.SPLIT_TRAIN_PERCENT
) -> tuple[DataFrame, DataFrame]:
    """The split, or all rows on both sides when the train rows hold one class only."""
    train, test = split_rows(df, key, percent)
    return (train, test) if has_two_classes(train, label) else (df, df)


def with_side(df: DataFrame, key: str = "event_id", percent: int = fixed.SPLIT_TRAIN_PERCENT) -> DataFrame:
    """A row without a key has no side, as in ``split_rows``."""
    return df.withColumn("side", F.when(is_train(key, percent), "train").when(~is_train(key, percent), "test"))
