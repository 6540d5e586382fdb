"""Turn nested and time columns into text, decided from the schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.StructType, T.ArrayType, T.MapType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def flatten_nested(df: DataFrame) -> DataFrame:
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, _NESTED):
            changed[field.name] = F.to_json(F.col(f"`{field.name}`"))
        elif isinstance(field.dataType, _TIMES):
            changed[field.name] = F.col(f"`{field.name}`").cast("string")
    return df.withColumns(changed) if changed else df
