"""Writing raw events as JSON lines below run and ingest-date directories."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_KEYS = ("run_id", "year", "month", "day")


def new_run_id() -> str:
    """UTC start time and eight random characters; made once per run."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def with_run_keys(df: DataFrame, run_id: str, ingested: str = "_ingested_at_utc") -> DataFrame:
    """Directory columns: the run, and the date the row was ingested (not the event date)."""
    at = F.to_timestamp(ingested)
    return df.withColumns(
        {
            "run_id": F.lit(run_id),
            "year": F.date_format(at, "yyyy"),
            "month": F.date_format(at, "MM"),
            "day": F.date_format(at, "dd"),
        }
    )


def write_raw(df: DataFrame, path: str, run_id: str, max_records: int | None = None) -> None:
    """Append ``df``; ``max_records`` bounds the rows per object."""
    writer = with_run_keys(df, run_id).write.mode("append").partitionBy(*RUN_KEYS)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.json(path)
