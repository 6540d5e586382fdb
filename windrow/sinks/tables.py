"""Writing layer tables, with a read-back check."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.sources.tables import condition


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Bring rows of a partition directory together, so that each gets few files.

    The rebalance hint lets adaptive execution split a hot directory over several tasks
    and merge small ones.
    """
    return df.hint("rebalance", *keys)


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Tasks of the writes within keep ``most`` files open and do not sort their rows by directory.

    For a task that has all rows of few directories: a sort would hold them together.
    """
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(most))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("event_date",),
    fmt: str = "parquet",
    mode: str = "overwrite",
) -> None:
    out = balanced(df, *partition_by) if partition_by else df
    out.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)


def write_formats(
    df: DataFrame,
    base: str,
    partition_by: Sequence[str] = ("event_date",),
    formats: Sequence[str] = ("parquet", "delta"),
) -> dict[str, str]:
    """Write ``<base>_<format>`` for each format; says per format whether it was written.

    The first format must succeed and the others are written from it, so ``df`` is
    computed once. A later format whose connector is missing is reported.
    """
    first, *others = formats
    write_table(df, f"{base}_{first}", partition_by, first)
    outcome = {first: "written"}
    for fmt in others:
        stored = df.sparkSession.read.format(first).load(f"{base}_{first}")
        try:
            write_table(stored, f"{base}_{fmt}", partition_by, fmt)
            outcome[fmt] = "written"
        except (AnalysisException, Py4JJavaError) as error:
            if condition(error) != "DATA_SOURCE_NOT_FOUND":
                raise
            outcome[fmt] = "no connector"
    return outcome


def write_checked(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("event_date",),
    expected_rows: int | None = None,
) -> DataFrame:
    """Write, read back and compare row count and columns; returns the table as read.

    Without ``expected_rows`` the rows are kept while they are counted and written, so the
    input is computed once; the count of what is stored comes from the files' footers. (Observed
    metrics would do without, but in a session that has used them saved models no longer score:
    their tasks cannot be serialised.)
    """
    if expected_rows is None:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return write_checked(kept, path, partition_by, kept.count())
        finally:
            kept.unpersist()
    write_table(df, path, partition_by)
    spark = df.sparkSession
    names = set(spark.read.parquet(path).columns)
    if names != set(df.columns):
        raise RuntimeError(f"Columns at {path} differ: {sorted(names ^ set(df.columns))}")
    stored = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    found = stored.count()
    if expected_rows != found:
        raise RuntimeError(f"Expected {expected_rows} rows at {path} but read {found}")
    return stored


def write_sample(df: DataFrame, path: str, airport: str = "airport", time: str = "timestamp_utc") -> None:
    """Events below ``airport=/year=/month=`` directories."""
    parts = df.withColumns(
        {"year": F.year(time), "month": F.date_format(time, "MM")}
    )
    write_table(parts, path, (airport, "year", "month"))
