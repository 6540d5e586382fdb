"""Topic or landed files to the raw zone and to bronze, in micro-batches.

Every batch writes to places named after the run and the batch and overwrites exactly
those. The run's name is kept next to the checkpoint, so a batch that is retried, also by the
next start, leaves the same rows once.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from windrow import schemas
from windrow.functions.flatten import flatten_nested
from windrow.operators.dedup import first_delivery
from windrow.operators.quality import valid_events
from windrow.plans.layers import typed_events
from windrow.session import broadcast_if_small
from windrow.sinks.raw import RUN_KEYS, new_run_id, with_run_keys
from windrow.sources import raw as raw_source
from windrow.sources.tables import read_if_there
from windrow.streaming import merging

log = logging.getLogger(__name__)

#: Bronze as the stream stores it: the batch that wrote a row is part of its address.
STREAM_BRONZE = T.StructType(
    [
        *schemas.BRONZE.fields,
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
_RUN = T.StructType([T.StructField("run_id", T.StringType())])
#: Dates up to which a batch prunes bronze by a list; beyond it by their range.
_DATE_LIST = 1000


def read_landed(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    schema: T.StructType = schemas.RAW,
    max_bytes: int | None = None,
) -> DataFrame:
    """A stream over JSON-lines files that appear below ``path``, oldest first.

    A batch takes ``max_files`` files, or as many as ``max_bytes`` hold, and one at least; else all
    there are, and a batch that is cut short is written again whole.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return raw_source.with_object(reader.json(path), path)


def _run_place(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-run"


def _kept_run(spark: SparkSession, checkpoint: str) -> str | None:
    kept = read_if_there(spark, _run_place(checkpoint), _RUN, "json")
    row = kept and kept.first()
    return row and row[0]


def run_of(spark: SparkSession, checkpoint: str, run_id: str | None = None) -> str:
    """The name of the run that a checkpoint belongs to: kept next to it by the first start.

    ``run_id`` names it then; a later start may repeat the name but not change it.
    """
    name = _kept_run(spark, checkpoint)
    if name is None:
        # Also where a start that failed has left a folder without a row.
        name = run_id or new_run_id()
        spark.createDataFrame([(name,)], _RUN).coalesce(1).write.mode("overwrite").json(_run_place(checkpoint))
        name = _kept_run(spark, checkpoint)
    if run_id and run_id != name:
        raise ValueError(f"the checkpoint belongs to run {name}, not to {run_id}")
    return name


def last_commit(spark: SparkSession, checkpoint: str) -> tuple[str, int] | None:
    """The run that a checkpoint belongs to and its newest committed batch, which is not run again."""
    name = _kept_run(spark, checkpoint)
    numbers = _numbers(spark, f"{checkpoint.rstrip('/')}/commits", "/commits/(\\d+)$")
    return (name, max(numbers)) if name and numbers else None


@dataclass
class RawSink:
    """Writes each batch to the raw zone and, best effort, to a second target.

    The raw write must succeed. When the second fails, the batch goes on. What the second
    misses is what the raw zone has and it has not, so nothing is forgotten with the process;
    ``repair`` writes it again from the raw zone, as soon as the second target takes a batch again.
    """

    path: str
    run_id: str
    second: Callable[[DataFrame, int], None] | None = None
    max_records: int | None = None
    behind: bool = False

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.second is None:
            self._write_raw(batch, batch_id)
            return
        # Two targets, one read of the source.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write_raw(batch, batch_id)
            late = self.behind
            self._write_second(batch, batch_id)
        finally:
            batch.unpersist()
        if late and not self.behind:
            self.repair(batch.sparkSession)

    def _write_raw(self, batch: DataFrame, batch_id: int) -> None:
        part = f"{batch_id + 1:05d}"
        keyed = with_run_keys(batch, self.run_id).withColumn("part", F.lit(part))
        writer = (
            keyed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*RUN_KEYS, "part")
        )
        if self.max_records:
            writer = writer.option("maxRecordsPerFile", self.max_records)
        writer.json(self.path)

    def _write_second(self, batch: DataFrame, batch_id: int) -> None:
        try:
            self.second(batch, batch_id)
            self.behind = False
        except Exception:
            self.behind = True
            log.exception("second target failed for batch %d; raw storage succeeded", batch_id)

    def missed(self, spark: SparkSession) -> list[int]:
        """Batches of this run that the raw zone has and the second target has not."""
        if self.second is None or not hasattr(self.second, "batches"):
            return []
        # Only this run's objects are listed.
        raw = _numbers(spark, f"{self.path}/run_id={self.run_id}", "/part=(\\d+)/part-[^/]*$")
        return sorted({n - 1 for n in raw} - self.second.batches(spark))

    def repair(self, spark: SparkSession) -> None:
        """Write the missed batches to the second target from what the raw zone holds."""
        for batch_id in self.missed(spark):
            stored = spark.read.json(self.path, schema=T.StructType([*schemas.RAW.fields, schemas.REST])).where(
                (F.col("run_id") == self.run_id) & (F.col("part").cast("int") == batch_id + 1)
            )
            self._write_second(stored.select(*schemas.RAW.names, schemas.REST.name), batch_id)


def _numbers(spark: SparkSession, path: str, pattern: str) -> set[int]:
    """Numbers in the names of the files below ``path``: one a batch of the run."""
    listing = read_if_there(spark, path, None, "binaryFile")
    if listing is None:
        return set()
    number = F.regexp_extract("path", pattern, 1)
    found = listing.where(number != "").select(number.cast("int").alias("n")).distinct()
    return {r.n for r in found.collect()}


@dataclass
class ParquetBatches:
    """A second target: each batch, nested values as text, in its own ``run_id=/batch_id=`` directory."""

    path: str
    run_id: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        place = f"{self.path}/run_id={self.run_id}/batch_id={batch_id}"
        flatten_nested(batch).write.mode("overwrite").parquet(place)

    def batches(self, spark: SparkSession) -> set[int]:
        return _numbers(spark, f"{self.path}/run_id={self.run_id}", "/batch_id=(\\d+)/part-[^/]*$")


@dataclass
class DeltaBatches:
    """The same as a Delta table: an append that Delta skips when it has seen the batch."""

    path: str
    run_id: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        once = {"txnAppId": self.run_id, "txnVersion": batch_id}
        flatten_nested(batch).write.format("delta").options(**once).mode("append").save(self.path)


@dataclass
class BronzeSink:
    """Adds the events of each batch that bronze does not hold yet.

    Bronze is laid out by event date, then run and batch. Known ids are looked for only in
    the dates of the batch: an event id contains its time, so a redelivery has the date of
    the first delivery, and only the directories of those dates are listed. Rows of this
    batch and of later ones (left by an attempt that failed) do not count as known.

    Every ``merge_every`` batches the dates that have many directories, ``merge_least`` or more, are
    merged, so what a batch lists and reads does not grow with the number of batches before it.
    """

    path: str
    run_id: str
    merge_every: int | None = 50
    merge_least: int = merging.LEAST

    def __post_init__(self):
        if self.run_id == merging.MERGED:
            raise ValueError(f"no run may be called {merging.MERGED}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.merge_every and batch_id and batch_id % self.merge_every == 0:
            merging.merge(batch.sparkSession, self.path, STREAM_BRONZE, self.merge_least)
        fresh = first_delivery(typed_events(valid_events(batch))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stored = self._stored(fresh)
            new = fresh if stored is None else self._without_known(fresh, stored, batch_id)
            placed = new.withColumns(
                {"run_id": F.lit(self.run_id), "batch_id": F.lit(batch_id).cast("long")}
            )
            (
                placed.hint("rebalance", "event_date")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("event_date", "run_id", "batch_id")
                .parquet(self.path)
            )
        finally:
            fresh.unpersist()

    def _stored(self, fresh: DataFrame) -> DataFrame | None:
        spark = fresh.sparkSession
        dates = fresh.select("event_date").distinct()
        listed = [r[0] for r in dates.limit(_DATE_LIST + 1).collect()]
        if not listed:
            return None
        if len(listed) > _DATE_LIST:
            low, high = fresh.agg(F.min("event_date"), F.max("event_date")).first()
            wanted, found = F.col("event_date").between(low, high), read_if_there(spark, self.path, STREAM_BRONZE)
        else:
            names = ",".join(d.isoformat() for d in listed)
            wanted = F.col("event_date").isin(listed)
            found = read_if_there(spark, f"{self.path}/event_date={{{names}}}", STREAM_BRONZE, base=self.path)
        if found is None:
            return None
        by = merging.held(spark, self.path)
        return merging.live(found.where(wanted), None if by is None else by.where(wanted))

    def _without_known(self, fresh: DataFrame, stored: DataFrame, batch_id: int) -> DataFrame:
        earlier = (F.col("run_id") != self.run_id) | (F.col("batch_id") < batch_id)
        ids = fresh.select("event_id")
        # Bronze stays where it is when the ids of one batch are few enough to send to it.
        known = stored.where(earlier).select("event_id").join(broadcast_if_small(ids), "event_id", "left_semi")
        return fresh.join(known, "event_id", "left_anti")


def read_stream_bronze(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(STREAM_BRONZE).parquet(path)
    return merging.live(rows, merging.held(spark, path)).select(*schemas.BRONZE.names)


def start(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = True,
    every: str | None = None,
) -> StreamingQuery:
    """Run a sink over a stream: over what is there now, or on and on."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def run_until(
    query: StreamingQuery,
    max_records: int | None = None,
    idle_seconds: float | None = None,
    poll_seconds: float = 1.0,
) -> int:
    """Let a query run until it ends, has read ``max_records``, or read nothing for a while.

    Counts whole batches, so it may read past ``max_records`` to the end of one. A batch cut
    short by the stop is run again on the next start and overwrites its own output. Returns
    the rows read.
    """
    read: dict[int, int] = {}
    quiet_since = time.monotonic()
    while not query.awaitTermination(poll_seconds):
        before = sum(read.values())
        read.update({p["batchId"]: p["numInputRows"] for p in query.recentProgress})
        total = sum(read.values())
        if total > before:
            quiet_since = time.monotonic()
        if max_records is not None and total >= max_records:
            break
        busy = query.status["isTriggerActive"] and query.status["isDataAvailable"]
        if idle_seconds is not None and not busy and time.monotonic() - quiet_since >= idle_seconds:
            break
    query.stop()
    read.update({p["batchId"]: p["numInputRows"] for p in query.recentProgress})
    return sum(read.values())
