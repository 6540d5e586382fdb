"""Helpers that the operators of this folder share."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from windrow.session import materialise

#: The six ASCII white-space characters, as a Java pattern. Words are what lies between.
WHITE = r"[\x20\x09-\x0D]+"

#: A side may be broadcast when its rows, counted, times their width stay below this many bytes.
BROADCAST_BYTES = 16 << 20


class Memory(dict):
    """What ``make`` says of a key, remembered within ``limit`` bytes as Python holds them.

    With half of the limit used a new generation begins: of the one before only what is asked
    for again is taken over. Nothing depends on what is remembered. Keys of which ``keep`` says
    no are made anew each time.
    """

    #: Bytes of a place in a dict, with its share of free places.
    PLACE = 64

    def __init__(self, make: Callable, limit: int, keep: Callable | None = None):
        super().__init__()
        self.make, self.limit, self.keep, self.bytes, self.old = make, limit, keep, 0, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if self.keep is not None and not self.keep(key):
                return value
        if self.bytes > self.limit // 2:
            self.old = dict(self)
            self.clear()
            self.bytes = 0
        self[key] = value
        self.bytes += sys.getsizeof(key) + (0 if value is True or value is False else sys.getsizeof(value)) + self.PLACE
        return value


#: Bytes of rows that go to a Python worker at once. Both sides hold a batch whole.
BATCH_BYTES = 4 << 20


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends rows to Python in batches of ``BATCH_BYTES``.

    Batches by number alone are as large as texts are long.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def give_back() -> None:
    """Returns what Arrow keeps of freed batches: a worker lives on when its task has ended."""
    pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def broadcast_if_bounded(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """A broadcast hint, given only after counting rows of a fixed width, or summing the widths of a column."""
    if isinstance(row_bytes, Column):
        small = (df.agg(F.sum(row_bytes)).first()[0] or 0) <= BROADCAST_BYTES
    else:
        most = BROADCAST_BYTES // row_bytes
        small = df.limit(most + 1).count() <= most
    return F.broadcast(df) if small else df


def numbered(stored: DataFrame) -> DataFrame:
    """(_row, _doc): the rows of a stored table with a number each, whatever their columns are called.

    A written table: how files are split, and so the number that a scan gives to a row, follows
    the cores at hand, which may change between two scans.
    """
    return materialise(stored.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_doc")), "numbered")


def with_rank(df: DataFrame, *order: str, name: str = "_rank", into: str = "ranked") -> DataFrame:
    """``df`` with its position (from 0) in the total order of ``order``; a written table.

    A range partitioning, then one row per partition for the offsets: no task sees more
    than its own range. Rows equal in all of ``order`` are interchangeable.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(parts.withColumn("_at", F.monotonically_increasing_id()), into)
    part, inside = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_part": part, "_inside": inside})
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # As many rows as there are partitions.
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop("_part", "_inside", "_offset", "_at")
    )


def _hashed(kind: pa.DataType, separator: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            for key, piece in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if state is None or key != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(separator)
                state.update(piece)
            if len(done) >= 10_000:
                yield _digests(done, kind)
                done = []
        if state is not None:
            done.append((now, state.hexdigest()))
        yield _digests(done, kind)

    return run


def _digests(done: list, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], kind), pa.array([d for _, d in done], pa.string())], ["key", "sha256"])


def sha256_of_pieces(pieces: DataFrame, key: str, order: Sequence[str], piece: str, separator: str) -> DataFrame:
    """(key, sha256): the digest of each key's pieces, strings, by ``order`` with ``separator`` between them.

    A digest has to read its bytes in order, so a key is one task's; its rows go by one at a
    time and are never held together.
    """
    rows = pieces.repartition(key).sortWithinPartitions(key, *order).select(F.col(key).alias("key"), F.col(piece).alias("piece"))
    field = rows.schema["key"].dataType
    return rows.mapInArrow(_hashed(to_arrow_type(field), separator.encode()), f"key {field.simpleString()}, sha256 string")
