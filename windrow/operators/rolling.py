"""Rolling features over the last rows of each key.

The frame counts rows: the current row and the ``rows - 1`` before it, per key, in time
order. A plain window puts a whole key into one task. When the largest key is too big
for that, all rows are range partitioned on key and time order instead; each range is given the
few rows in front of it, so every frame is whole within its range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow import fixed
from windrow.session import materialise

#: Rows of one key that a single task may sort.
MAX_KEY_ROWS = 2_000_000

Feature = tuple[str, str, str]


def _columns(features: Sequence[Feature], frame) -> list[Column]:
    return [getattr(F, fn)(source).over(frame).alias(name) for name, fn, source in features]


def _with_order(df: DataFrame, time: str) -> DataFrame:
    # A real column, not an inline cast: the windows then share one sort.
    return df.withColumn("_order_s", F.col(time).cast("timestamp").cast("long"))


def key_sizes(df: DataFrame, key: str) -> DataFrame:
    """(key, n): one aggregate over one column."""
    return df.groupBy(key).agg(F.count("*").alias("n"))


def _by_range(keyed: DataFrame, key: str, tie: Sequence[str], slices: int) -> DataFrame:
    """Slice numbers from a range partitioning on the whole order, ties included.

    Evens out any distribution, also very many rows of one key within a second. The
    numbers are kept in a written table, since a later sampling might cut elsewhere.
    """
    ranged = keyed.repartitionByRange(slices, key, "_order_s", *tie)
    return materialise(ranged.withColumn("_slice", F.spark_partition_id().cast("long")), "ranges")


def rolling_plain(
    df: DataFrame,
    key: str,
    time: str,
    tie: Sequence[str],
    features: Sequence[Feature],
    rows: int,
) -> DataFrame:
    w = Window.partitionBy(key).orderBy("_order_s", *tie).rowsBetween(1 - rows, 0)
    return _with_order(df, time).select("*", *_columns(features, w)).drop("_order_s")


def rows_in_front(sliced: DataFrame, key: str, tie: Sequence[str], rows: int) -> DataFrame:
    """The last ``rows - 1`` rows before each slice, with that slice's number.

    They are among the last rows of the slices before it, of which each task sends at most
    ``rows - 1`` for a slice; all that follows has so many rows for each slice.
    """
    back = Window.partitionBy("_slice").orderBy(*[F.desc(c) for c in (key, "_order_s", *tie)])
    tails = sliced.withColumn("_back", F.row_number().over(back)).where(F.col("_back") < rows)
    tails = materialise(tails, "tails")
    ahead = Window.orderBy("_slice")
    places = tails.groupBy("_slice").agg(F.count("*").alias("n")).select(
        "_slice",
        F.row_number().over(ahead).alias("_place"),
        F.coalesce(F.sum("n").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("n").over(ahead.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
    )
    # A slice with few rows lets those of earlier ones pass through.
    to = places.select(F.col("_slice").alias("_to"), F.col("_place").alias("_next"), F.col("_before").alias("_start"))
    reach = F.explode(F.sequence(F.col("_place") + 1, F.col("_place") + rows - 1))
    held = tails.join(places.drop("_before"), "_slice").withColumn("_next", reach).join(to, "_next")
    held = held.where(F.col("_start") - F.col("_upto") + F.col("_back") < rows).withColumn("_slice", F.col("_to"))
    return held.select(*sliced.columns)


def rolling_sliced(
    sliced: DataFrame,
    key: str,
    tie: Sequence[str],
    features: Sequence[Feature],
    rows: int,
) -> DataFrame:
    """The same rows as ``rolling_plain``, from a stored table with ``_order_s`` and ``_slice``.

    Slices are stretches of the order by key, time and tie.
    """
    base = [c for c in sliced.columns if c not in ("_order_s", "_slice")]
    given = rows_in_front(sliced, key, tie, rows).withColumn("_given", F.lit(1))
    every = sliced.withColumn("_given", F.lit(0)).unionByName(given)
    w = Window.partitionBy("_slice", key).orderBy(F.desc("_given"), "_order_s", *tie).rowsBetween(1 - rows, 0)
    names = [name for name, _, _ in features]
    return every.select("*", *_columns(features, w)).where("_given = 0").select(*base, *names)


def rolling_features(
    df: DataFrame,
    key: str = "airport",
    time: str = "timestamp_utc",
    tie: Sequence[str] = ("event_id",),
    features: Sequence[Feature] = fixed.ROLLING_FEATURES,
    rows: int = fixed.ROLLING_ROWS,
    slices: int | None = None,
    sized_by: DataFrame | None = None,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Add the rolling columns.

    ``slices`` forces a range partitioning into so many: the input is read twice, for a
    sample of the order and for the rows. Without it the key sizes are measured first, on
    ``sized_by`` (by default ``df``), by an aggregate over the key alone. Pass a table there
    when ``df`` is costly; any superset of its rows serves.
    """
    if rows < 2:
        raise ValueError("a rolling frame has at least two rows")
    if slices is None:
        sizes = key_sizes(df if sized_by is None else sized_by, key)
        largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
        if largest is None or largest <= max_key_rows:
            return rolling_plain(df, key, time, tie, features, rows)
        # The range edges come from a sample: twice as many slices as must be stay below the limit.
        slices = 2 * -(-total // max_key_rows)
    elif slices < 1:
        raise ValueError("there is at least one slice")
    return rolling_sliced(_by_range(_with_order(df, time), key, tie, slices), key, tie, features, rows)
