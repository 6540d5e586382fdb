"""The steps a user runs, each from stored input to stored output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow import fixed, schemas
from windrow.operators import quality, runs, training
from windrow.plans import layers
from windrow.sinks.tables import write_formats, write_sample
from windrow.sources import grid as grid_source
from windrow.sources import raw as raw_source
from windrow.sources.tables import read_if_there, read_table
from windrow.streaming import ingest, merging, scoring, versions

SECOND_TARGETS = {"parquet": ingest.ParquetBatches, "delta": ingest.DeltaBatches}

BRONZE = "bronze/weather_events"
SILVER = "silver/weather_labeled"
GOLD = "gold/training_features"
FEATURES = "gold/versions"


def sample(
    grid: DataFrame,
    out: str,
    start: str,
    end: str,
    stations: Sequence[tuple] = fixed.STATIONS[:1],
) -> DataFrame:
    """Station events of a gridded archive as Parquet and as JSON lines; returns them as read."""
    spark = grid.sparkSession
    points = grid_source.extract_points(grid, grid_source.stations_frame(spark, stations), start, end)
    write_sample(grid_source.to_events(points), f"{out}/parquet")
    events = spark.read.parquet(f"{out}/parquet").select(*fixed.EVENT_COLUMNS)
    text = events.withColumn("timestamp_utc", events["timestamp_utc"].cast("string"))
    text.write.mode("overwrite").json(f"{out}/jsonl")
    return events


def consume(
    stream: DataFrame,
    raw: str,
    checkpoint: str,
    run_id: str | None = None,
    table: str | None = None,
    max_records: int | None = None,
    idle_seconds: float | None = None,
    object_rows: int | None = None,
    table_format: str = "parquet",
) -> ingest.RawSink:
    """Decoded events of a stream to the raw zone, and best effort to a table of raw rows.

    The run's name stays with the checkpoint, so a start after a failure replaces what the
    last batch left instead of adding to it. Batches that the table misses, also from earlier
    starts, are written to it from the raw zone. ``object_rows`` bounds the rows of an object.
    Reads what is there now and ends; with ``max_records`` or ``idle_seconds`` it waits for
    events until it has read that many or nothing has come for that long. ``table_format`` is
    parquet or delta; what a Delta table misses is not written again, as its rows do not say
    which batch they are from.
    """
    spark = stream.sparkSession
    run_id = ingest.run_of(spark, checkpoint, run_id)
    second = SECOND_TARGETS[table_format](table, run_id) if table else None
    sink = ingest.RawSink(raw, run_id, second=second, max_records=object_rows)
    names = [n for n in (*schemas.RAW.names, schemas.REST.name) if n in stream.columns]
    _run(stream.select(*names), sink, checkpoint, max_records, idle_seconds)
    sink.repair(spark)
    return sink


def _run(stream: DataFrame, sink, checkpoint: str, max_records: int | None, idle_seconds: float | None) -> None:
    waits = max_records is not None or idle_seconds is not None
    query = ingest.start(stream, sink, checkpoint, available_now=not waits)
    if waits:
        ingest.run_until(query, max_records, idle_seconds)
    else:
        query.awaitTermination()


def stream_bronze(
    stream: DataFrame,
    bronze: str,
    checkpoint: str,
    run_id: str | None = None,
    merge_every: int = 50,
    max_records: int | None = None,
    idle_seconds: float | None = None,
    merge_least: int = merging.LEAST,
) -> DataFrame:
    """Decoded events of a stream to bronze, each event once; returns the table as it is read.

    Ends like ``consume``. The table is merged on the way: every ``merge_every`` batches, the dates
    that have ``merge_least`` directories or more.
    """
    spark = stream.sparkSession
    sink = ingest.BronzeSink(bronze, ingest.run_of(spark, checkpoint, run_id), merge_every, merge_least)
    if "_source_object" not in stream.columns:
        stream = stream.withColumn("_source_object", F.lit(None).cast("string"))
    _run(stream.select(*schemas.RAW.names, "_source_object"), sink, checkpoint, max_records, idle_seconds)
    return ingest.read_stream_bronze(spark, bronze)


def merge_bronze(
    spark: SparkSession, bronze: str, least: int = merging.LEAST, checkpoint: str | None = None
) -> int:
    """Merge the small directories of a streamed bronze table, also while its stream runs.

    With the checkpoint of the stream its newest batch is merged too, once it is committed.
    """
    committed = ingest.last_commit(spark, checkpoint) if checkpoint else None
    return merging.merge(spark, bronze, ingest.STREAM_BRONZE, least, committed)


def validate(spark: SparkSession, raw: str, table: str | None = None) -> tuple[DataFrame, DataFrame, int | None]:
    """What the raw zone holds: one summary row, the filled rows per expected column, and
    the rows of the second target (None when there is none)."""
    rows = raw_source.scan_raw(spark, raw)
    second = read_if_there(spark, table, schemas.RAW) if table else None
    return (
        quality.storage_summary(rows, raw_source.manifest(spark, raw)),
        quality.column_report(rows, fixed.STORED_COLUMNS),
        None if second is None else second.count(),
    )


def bronze(spark: SparkSession, raw: str, lake: str) -> dict[str, str]:
    valid = quality.require_rows(quality.valid_events(raw_source.scan_raw(spark, raw)), "raw zone")
    return write_formats(layers.build_bronze(valid), f"{lake}/{BRONZE}")


def silver(spark: SparkSession, lake: str, **options) -> dict[str, str]:
    rows = read_table(spark, f"{lake}/{BRONZE}", schemas.BRONZE)
    return write_formats(layers.build_silver(rows, **options), f"{lake}/{SILVER}")


def gold(spark: SparkSession, lake: str, **options) -> dict[str, str]:
    rows = quality.require_rows(read_table(spark, f"{lake}/{SILVER}", schemas.SILVER), "silver")
    return write_formats(layers.build_gold(rows, **options), f"{lake}/{GOLD}", partition_by=())


def publish(spark: SparkSession, lake: str) -> int:
    """The gold table as the next version that scoring follows; returns its number."""
    return versions.publish(_features(spark, lake), f"{lake}/{FEATURES}")


def score(spark: SparkSession, lake: str, model: str, out: str, checkpoint: str, only_new: bool = False) -> None:
    """Score the versions published since the last call, each event once a version."""
    loaded = scoring.load_model(model)
    versions.start_scoring(spark, f"{lake}/{FEATURES}", loaded, out, checkpoint, only_new).awaitTermination()


def _features(spark: SparkSession, lake: str) -> DataFrame:
    return quality.require_rows(read_table(spark, f"{lake}/{GOLD}", schemas.GOLD), "gold")


def train(spark: SparkSession, lake: str, model: str) -> dict:
    """The standard forest: evaluated on the test rows, fitted on the train rows, saved."""
    record, fitted = training.train_and_evaluate(_features(spark, lake), fixed.FINAL_FOREST)
    training.save_model(fitted, model)
    return record["metrics"]


def experiments(spark: SparkSession, lake: str, run_table: str, model: str, refit: str = "fixed") -> DataFrame:
    """Five runs into the run table, and a final model on all rows; returns the ranked runs.

    ``refit="fixed"`` fits the standard forest, ``refit="best"`` the best run's settings.
    """
    features = _features(spark, lake)
    records = training.run_experiments(features)
    runs.log_runs(spark, records, run_table)
    spec = training.best_spec(records) if refit == "best" else fixed.FINAL_FOREST
    training.save_model(training.fit_final(features, spec), model)
    return runs.top_runs(runs.run_metrics(runs.read_runs(spark, run_table)))
