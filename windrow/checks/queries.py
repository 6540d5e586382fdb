"""One query per operator, over the whole test tables.

Sums and averages over several rows are rounded here, not in the library, because two
engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow import fixed, schemas
from windrow.functions.flatten import flatten_nested
from windrow.operators import labels, metrics, model_tables, quality, runs, split, training
from windrow.operators.dedup import first_delivery
from windrow.operators.ordered import exact_quantile
from windrow.operators.rolling import rolling_features
from windrow.plans import jobs, layers, samples
from windrow.session import materialise, use_utc, work_path
from windrow.sinks import kafka as kafka_sink
from windrow.sinks import raw as raw_sink
from windrow.sinks import tables as table_sink
from windrow.sources import grid as grid_source
from windrow.sources import kafka as kafka_source
from windrow.sources import raw as raw_source
from windrow.sources import tables as table_source
from windrow.streaming import ingest, scoring, versions

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Layers. Silver looks at the data before it labels it, so bronze is a written table.


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return layers.build_bronze(samples.raw_weather(spark, sf))


def _bronze_table(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(_bronze(spark, sf), "bronze")


def _silver(spark: SparkSession, sf: str, **options) -> DataFrame:
    return layers.build_silver(_bronze_table(spark, sf), **options)


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    return layers.build_gold(_silver(spark, sf))


#: Rows of a file of gold. A station is written by one task, and a file of one row group is read by one.
_GOLD_FILE_ROWS = 250_000


def _gold_table(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(_gold(spark, sf), "gold", _GOLD_FILE_ROWS)


# Sources


def grid_nearest_point(spark, sf):
    return grid_source.nearest_points(grid_source.stations_frame(spark), samples.grid(spark, sf))


_BOUNDS = ("1995-01-01", "2001-12-31")
_SHORT = {
    "2m_temperature": "t2m",
    "10m_u_component_of_wind": "u10",
    "10m_v_component_of_wind": "v10",
    "total_precipitation": "tp",
    "surface_pressure": "sp",
    "convective_available_potential_energy": "cape",
}


def grid_extract(spark, sf):
    rows = grid_source.extract_points(samples.grid(spark, sf), grid_source.stations_frame(spark), *_BOUNDS)
    return rows.withColumnsRenamed(_SHORT)


def grid_extract_tiled(spark, sf):
    """The same rows from a stored archive: its axes and the tiles of the points are read, no more."""
    grid, path = samples.grid(spark, sf), work_path(spark, "archive")
    grid_source.write_archive(grid, path)
    archive, axes = grid_source.read_archive(spark, path, grid.schema)
    rows = grid_source.extract_points(archive, grid_source.stations_frame(spark), *_BOUNDS, axes=axes)
    return rows.withColumnsRenamed(_SHORT)


def raw_scan(spark, sf):
    path = work_path(spark, "raw")
    raw = samples.raw_weather(spark, sf).select(*schemas.RAW.names)
    raw_sink.write_raw(raw, path, raw_sink.new_run_id())
    return raw_source.scan_raw(spark, path).drop("_source_object")


def raw_write(spark, sf):
    """Objects of bounded size; the directories come back as columns and agree with the rows."""
    path, run_id = work_path(spark, "raw"), raw_sink.new_run_id()
    raw = samples.raw_weather(spark, sf).select(*schemas.RAW.names)
    raw_sink.write_raw(raw, path, run_id, max_records=10_000)
    stored = spark.read.schema(schemas.RAW).json(path)
    placed = (F.col("run_id") == run_id) & (
        F.make_date("year", "month", "day") == F.to_date(F.to_timestamp("_ingested_at_utc"))
    )
    return stored.where(placed).select(*schemas.RAW.names)


def _by_day(spark, sf) -> str:
    """Raw rows below a directory for each ingest day, one object in each."""
    path = work_path(spark, "raw")
    raw = samples.raw_weather(spark, sf).select(*schemas.RAW.names).withColumn("day", F.substring("_ingested_at_utc", 1, 10))
    raw.repartition("day").write.partitionBy("day").json(path)
    return path


def raw_lineage(spark, sf):
    """The key of each row's object, which says the day that the row was ingested on."""
    rows = raw_source.scan_raw(spark, _by_day(spark, sf))
    day = F.regexp_extract("_source_object", "^day=([0-9-]+)/[^/]+[.]json$", 1)
    return rows.groupBy(day.alias("day")).agg(
        F.count("*").alias("row_count"), F.count_if(day == F.substring("_ingested_at_utc", 1, 10)).alias("same_day")
    )


def raw_last_objects(spark, sf):
    listing = raw_source.manifest(spark, _by_day(spark, sf)).where(F.col("object_key").endswith(".json"))
    return raw_source.last_objects(listing, 10).select(
        F.regexp_extract("object_key", "^day=([^/]+)/", 1).alias("day"), (F.col("size_bytes") > 0).alias("has_bytes")
    )


def raw_manifest(spark, sf):
    path = work_path(spark, "sample")
    table_sink.write_sample(samples.event_records(spark, sf), path)
    listing = raw_source.manifest(spark, path).where(F.col("object_key").endswith(".parquet"))
    return listing.groupBy(F.regexp_extract("object_key", "^(.*)/[^/]+$", 1).alias("directory")).agg(
        (F.sum("size_bytes") > 0).alias("has_bytes")
    )


def read_fallback(spark, sf):
    base = work_path(spark, "bronze")
    table_sink.write_table(_bronze(spark, sf), f"{base}_parquet")
    return table_source.read_table(spark, base, schemas.BRONZE).select(*fixed.BRONZE_COLUMNS)


def kafka_decode(spark, sf):
    raw = samples.raw_weather(spark, sf)
    value = F.to_json(F.struct(*fixed.EVENT_COLUMNS))
    records = raw.select(
        F.col("airport").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.col("_kafka_topic").alias("topic"),
        F.col("_kafka_partition").alias("partition"),
        F.col("_kafka_offset").alias("offset"),
    )
    return kafka_source.decode(records).drop("_ingested_at_utc", "_rest")


def kafka_new_fields(spark, sf):
    """A field that comes as a number from some stations and as text from another, and a nested one."""
    raw = samples.raw_weather(spark, sf)
    station = F.col("airport")
    text = F.to_json(F.struct(*fixed.EVENT_COLUMNS))
    more = (
        F.when(station == "JFK", F.concat(F.lit(', "gust": '), F.col("_kafka_offset").cast("string")))
        .when(station == "LAX", F.lit(', "gust": "calm"'))
        .otherwise(F.lit(', "origin": {"sensor": [1, 2]}'))
    )
    whole = F.concat(F.substring_index(text, "}", 1), more, F.lit("}"))
    records = raw.select(
        station.cast("binary").alias("key"),
        whole.cast("binary").alias("value"),
        F.col("_kafka_topic").alias("topic"),
        F.col("_kafka_partition").alias("partition"),
        F.col("_kafka_offset").alias("offset"),
    )
    return kafka_source.new_fields(records)


def raw_whole_record(spark, sf):
    """Fields outside the schema, one plain and one nested, come back from the raw zone."""
    raw = samples.raw_weather(spark, sf)
    extra = [F.col("_kafka_offset").alias("gust"), F.struct("airport", "_kafka_partition").alias("origin")]
    records = raw.select(
        F.col("airport").cast("binary").alias("key"),
        F.to_json(F.struct(*fixed.EVENT_COLUMNS, *extra)).cast("binary").alias("value"),
        F.col("_kafka_topic").alias("topic"),
        F.col("_kafka_partition").alias("partition"),
        F.col("_kafka_offset").alias("offset"),
    )
    path = work_path(spark, "raw")
    raw_sink.write_raw(kafka_source.decode(records), path, raw_sink.new_run_id())
    whole = T.StructType([*schemas.RAW.fields, schemas.REST])
    stored = raw_source.scan_raw(spark, path, whole)
    return stored.select(
        "event_id",
        "_kafka_offset",
        F.col("_rest.gust").alias("gust"),
        F.get_json_object("_rest.origin", "$.airport").alias("origin_airport"),
        F.size("_rest").cast("int").alias("unknown_fields"),
    )


# Sinks


def bronze_roundtrip(spark, sf):
    return table_sink.write_checked(_bronze(spark, sf), work_path(spark, "bronze"))


def sample_partitioned(spark, sf):
    path = work_path(spark, "sample")
    table_sink.write_sample(samples.event_records(spark, sf), path)
    return spark.read.parquet(path).select(*fixed.EVENT_COLUMNS, "year", "month")


def kafka_encode(spark, sf):
    return kafka_sink.encode(
        samples.raw_weather(spark, sf), ["event_id", "airport", "timestamp_utc", "_kafka_offset"]
    )


def kafka_default_key(spark, sf):
    """Records of a station that does not give its name go under the default key."""
    raw = samples.raw_weather(spark, sf)
    nameless = raw.withColumn("airport", F.when(F.col("airport") != "LAX", F.col("airport")))
    keyed = kafka_sink.encode(nameless, ["event_id", "_kafka_offset"])
    return keyed.groupBy(F.col("key").cast("string").alias("key")).agg(
        F.count("*").alias("row_count"), F.min(F.get_json_object(F.col("value").cast("string"), "$._kafka_offset").cast("bigint")).alias("first_offset")
    )


# Projections and filters


def unit_conversion(spark, sf):
    return samples.event_records(spark, sf)


def event_id_key(spark, sf):
    return samples.event_records(spark, sf).select("event_id", "airport", "timestamp_utc")


def raw_valid(spark, sf):
    return quality.valid_events(samples.raw_weather(spark, sf)).select(
        "event_id", "airport", "timestamp_utc", "_kafka_offset", "_source_object"
    )


def bronze_typed(spark, sf):
    return layers.typed_events(samples.raw_weather(spark, sf))


def flatten(spark, sf):
    nested = samples.raw_weather(spark, sf).select(
        "event_id",
        F.struct("airport", F.col("_kafka_offset").alias("offset")).alias("origin"),
        F.array("_kafka_topic", "_source_object").alias("tags"),
        F.create_map("airport", "_kafka_partition").alias("partitions"),
        F.to_timestamp("timestamp_utc").alias("timestamp_utc"),
    )
    return flatten_nested(nested)


def required_columns(spark, sf):
    return quality.column_report(
        samples.raw_weather(spark, sf), [*fixed.STORED_COLUMNS, "wind_gust_kts"]
    )


def peek_latest(spark, sf):
    return layers.latest(_bronze(spark, sf)).select(
        "event_id", "airport", "timestamp_utc", "wind_speed_kts"
    )


# Aggregates


def smoke_avg(spark, sf):
    return samples.raw_weather(spark, sf).agg(
        F.round(F.avg("wind_speed_kts"), 6).alias("avg_wind_speed_kts")
    )


def raw_by_airport(spark, sf):
    return quality.count_by(quality.valid_events(samples.raw_weather(spark, sf)), "airport")


def raw_time_bounds(spark, sf):
    return quality.time_bounds(quality.valid_events(samples.raw_weather(spark, sf)))


def storage_summary(spark, sf):
    return quality.storage_summary(samples.raw_weather(spark, sf))


def flush_parts(spark, sf):
    return quality.rows_per_object(samples.raw_weather(spark, sf))


def bronze_dedup(spark, sf):
    raw = samples.raw_weather(spark, sf).where("event_id is not null")
    return first_delivery(raw).select("event_id", "_kafka_partition", "_kafka_offset", "_source_object")


def bronze_table(spark, sf):
    return _bronze(spark, sf)


def silver_rule_label(spark, sf):
    return labels.with_rule(_bronze(spark, sf)).select("event_id", "weather_rule_label")


def silver_risk_score(spark, sf):
    ruled = labels.with_rule(_bronze(spark, sf))
    return ruled.select("event_id", "risk_score_proxy")


def class_count(spark, sf):
    return labels.class_count(_silver(spark, sf))


def quantile_threshold(spark, sf):
    ruled = labels.with_rule(_bronze_table(spark, sf))
    return exact_quantile(ruled, "risk_score_proxy", fixed.FALLBACK_QUANTILE)


def price_quantile(spark, sf):
    return exact_quantile(samples.table(spark, sf, "lineitem"), "l_extendedprice", fixed.FALLBACK_QUANTILE)


def silver_labeled(spark, sf):
    return _silver(spark, sf).select(
        "event_id",
        "airport",
        "timestamp_utc",
        "weather_rule_label",
        "risk_score_proxy",
        "label",
        "label_source",
    )


def silver_fallback(spark, sf):
    """Limits no event reaches leave one class, so the exact score quantile decides."""
    silver = _silver(spark, sf, relative_error=0, wind_limit=1e9, precip_limit=1e9)
    return silver.select("event_id", "weather_rule_label", "label", "label_source")


def label_distribution(spark, sf):
    return quality.count_by(_silver(spark, sf), "label")


def label_source_distribution(spark, sf):
    return quality.count_by(_silver(spark, sf), "label", "label_source")


# Gold


def gold_calendar(spark, sf):
    return _gold(spark, sf).select("event_id", "hour_of_day", "day_of_week", "month")


_ADDED_UP = ("wind_speed_avg_3h", "precipitation_sum_3h", "cape_avg_3h")


def _rolling_columns(df: DataFrame) -> DataFrame:
    names = [name for name, _, _ in fixed.ROLLING_FEATURES]
    return _rounded(df.select("event_id", *names), _ADDED_UP)


def gold_rolling(spark, sf):
    return _rolling_columns(rolling_features(_bronze_table(spark, sf)))


def gold_rolling_sliced(spark, sf):
    """The same rows when the time lines of the stations are cut into ranges."""
    return _rolling_columns(rolling_features(_bronze_table(spark, sf), slices=24))


def gold_dropna(spark, sf):
    silver = _silver(spark, sf)
    gappy = F.when(F.col("precipitation_mm") >= 1, F.col("cape_j_kg"))
    gold = layers.build_gold(silver.withColumn("cape_j_kg", gappy))
    columns = ["cape_j_kg", "wind_speed_avg_3h", "cape_avg_3h"]
    return _rounded(gold.select("event_id", *columns), columns[1:])


def gold_training_features(spark, sf):
    return _rounded(_gold(spark, sf), _ADDED_UP)


_SUPPLIER_ROLLING = {
    "key": "l_suppkey",
    "time": "l_shipdate",
    "tie": ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"),
    "features": (
        ("quantity_max", "max", "l_quantity"),
        ("quantity_avg", "avg", "l_quantity"),
        ("price_sum", "sum", "l_extendedprice"),
    ),
}


def _by_supplier(spark, sf, **options) -> DataFrame:
    columns = ("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_partkey", "l_quantity")
    items = samples.table(spark, sf, "lineitem").select(*columns, "l_extendedprice")
    items = items.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    rolled = rolling_features(items, **_SUPPLIER_ROLLING, **options).drop("l_extendedprice")
    return _rounded(rolled, ["quantity_avg", "price_sum"])


def rolling_by_supplier(spark, sf):
    return _by_supplier(spark, sf)


def rolling_by_supplier_sliced(spark, sf):
    """The same rows from ranges that cut suppliers anywhere."""
    return _by_supplier(spark, sf, slices=24)


# Models


def feature_vector(spark, sf):
    rows = training.assemble(_gold(spark, sf))
    at = {name: i for i, name in enumerate(fixed.FEATURE_COLUMNS)}
    values = vector_to_array("features")
    taken = ("temperature_c", "wind_speed_max_3h", "cape_avg_3h", "month")
    vectors = rows.select(
        "event_id",
        *[values[at[c]].alias(c) for c in taken],
        F.size(values).alias("vector_size"),
        "label",
    )
    return _rounded(vectors, ["cape_avg_3h"])


def train_test_split(spark, sf):
    return split.with_side(_silver(spark, sf)).select("event_id", "side")


def split_fallback(spark, sf):
    """All rows on both sides when the label has one value."""
    one_class = _silver(spark, sf).withColumn("label", F.lit(0.0))
    train, test = split.split_or_all(one_class)
    sides = train.select(F.lit("train").alias("side")).unionByName(test.select(F.lit("test").alias("side")))
    return quality.count_by(sides, "side")


def _rule_runs(spark, sf) -> DataFrame:
    wind, rain, score = F.col("wind_speed_kts"), F.col("precipitation_mm"), F.col("risk_score_proxy")
    rules = {
        "wind_over_10": wind > 10,
        "wind_over_15": wind > 15,
        "wind_over_20": wind > 20,
        "wind_over_25": wind > 25,
        "wind_over_25_again": wind > 25,
        "wind_over_30": wind > 30,
        "precipitation_over_10": rain > 10,
        "score_over_2": score > 2,
    }
    ruled = labels.with_rule(_bronze(spark, sf))
    return metrics.score_rules(ruled, rules, "weather_rule_label")


def metrics_accuracy_f1(spark, sf):
    ruled = labels.with_rule(_bronze(spark, sf))
    guess = F.when(F.col("wind_speed_kts") > 20, 1.0).otherwise(0.0)
    counts = metrics.confusion(ruled.withColumn("prediction", guess), "weather_rule_label")
    return _rounded(metrics.accuracy_f1(counts), ["accuracy", "f1"])


def metrics_auc(spark, sf):
    ruled = labels.with_rule(_bronze_table(spark, sf))
    return _rounded(metrics.area_under_roc(ruled, "weather_rule_label", "risk_score_proxy"), ["auc"])


def best_run(spark, sf):
    return _rounded(runs.best_run(_rule_runs(spark, sf)), ["accuracy", "f1"])


def top_runs(spark, sf):
    return _rounded(runs.top_runs(_rule_runs(spark, sf), tie="run_name"), ["accuracy", "f1"])


def _train_eval(spark, sf, spec: dict) -> DataFrame:
    records = training.run_experiments(_gold_table(spark, sf), [spec])
    return runs.run_metrics(runs.runs_frame(spark, records)).drop("run_id")


def rf_train_eval(spark, sf):
    return _train_eval(spark, sf, fixed.FINAL_FOREST)


def lr_train_eval(spark, sf):
    return _train_eval(spark, sf, fixed.EXPERIMENTS[4])


def _by_tables(spark, sf, spec: dict) -> DataFrame:
    """Fitted on the train rows and saved; then every row is scored from the saved tables too."""
    gold, path = split.with_side(_gold_table(spark, sf)), work_path(spark, "model")
    training.save_model(training.fit_final(gold.where("side = 'train'"), spec), path)
    mine = model_tables.score_by_tables(gold, path).select("event_id", "side", "prediction", "score")
    library = scoring.scored(gold, scoring.load_model(path))
    library = library.select("event_id", F.col("prediction").alias("p"), F.col("score").alias("s"))
    return mine.join(library, "event_id").groupBy("side").agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("prediction") == F.col("p")).alias("same_prediction"),
        F.count_if(F.abs(F.col("score") - F.col("s")) < 1e-9).alias("same_score"),
    )


def rf_by_tables(spark, sf):
    return _by_tables(spark, sf, fixed.FINAL_FOREST)


def lr_by_tables(spark, sf):
    return _by_tables(spark, sf, fixed.EXPERIMENTS[4])


def experiment_grid(spark, sf):
    records = training.run_experiments(_gold_table(spark, sf))
    return runs.run_metrics(runs.runs_frame(spark, records)).drop("run_id")


def runs_table(spark, sf):
    """Two sessions append to one table; what it holds, without the measured values."""
    path, gold = work_path(spark, "runs"), _gold_table(spark, sf)
    with training.kept_rows(gold) as kept:
        for spec in (fixed.EXPERIMENTS[0], fixed.EXPERIMENTS[4]):
            runs.log_runs(spark, training.run_experiments(gold, [spec], kept=kept), path)
    stored = runs.read_runs(spark, path)
    ranked = runs.top_runs(runs.run_metrics(stored))
    sizes = ("train_rows", "test_rows")
    params = stored.select("run_id", *[F.col("params")[c].cast("long").alias(c) for c in sizes])
    return ranked.join(params, "run_id").select(
        "run_name", *sizes, F.col("f1").between(0, 1).alias("has_f1"), F.col("auc").between(0, 1).alias("has_auc")
    )


def model_roundtrip(spark, sf):
    """The final forest is saved, loaded and agrees with itself on every row."""
    gold, path = _gold_table(spark, sf), work_path(spark, "model")
    model = training.fit_final(gold)
    training.save_model(model, path)
    loaded = scoring.load_model(path)
    a = scoring.scored(gold, model).select("event_id", F.col("score").alias("before"))
    b = scoring.scored(gold, loaded).select("event_id", F.col("score").alias("after"))
    return a.join(b, "event_id").groupBy((F.col("before") == F.col("after")).alias("same")).agg(
        F.count("*").alias("row_count")
    )


# Streams


#: Rows of a landed file, and bytes of a batch of them.
_FILE_ROWS, _BATCH_BYTES = 500_000, 512 << 20


def _landed(spark, sf) -> str:
    path = work_path(spark, "landed")
    samples.raw_weather(spark, sf).select(*schemas.RAW.names).write.option("maxRecordsPerFile", _FILE_ROWS).json(path)
    return path


def _land_files(rows: DataFrame, path: str, least: int) -> None:
    """``least`` files or more, from where the rows stand: counted first, not shuffled."""
    rows.write.mode("append").option("maxRecordsPerFile", max(1, -(-rows.count() // least))).json(path)


def _land_by_delivery(raw: DataFrame, path: str, batches: int) -> int:
    """Redeliveries behind all first deliveries, none of them shuffled; returns the files that a batch has to take."""
    again = F.col("_source_object") == "part-replay.jsonl"
    late = max(1, batches // 4)
    for some, least in ((raw.where(~again), batches - late), (raw.where(again), late)):
        _land_files(some.select(*schemas.RAW.names), path, least)
    listing = raw_source.manifest(raw.sparkSession, path).where(F.col("object_key").endswith(".json"))
    return max(1, -(-listing.count() // batches))


def stream_raw_to_bronze(spark, sf):
    """First deliveries stream in, the query ends; it starts again when redeliveries have come."""
    landed, bronze, checkpoint = (work_path(spark, n) for n in ("landed", "bronze", "checkpoint"))
    raw = samples.raw_weather(spark, sf)
    sink = ingest.BronzeSink(bronze, raw_sink.new_run_id())
    again = F.col("_source_object") == "part-replay.jsonl"
    for deliveries in (raw.where(~again), raw.where(again)):
        deliveries.select(*schemas.RAW.names).write.mode("append").json(landed)
        ingest.start(ingest.read_landed(spark, landed), sink, checkpoint).awaitTermination()
    return ingest.read_stream_bronze(spark, bronze).select(
        "event_id", "airport", "timestamp_utc", "event_date", *fixed.BRONZE_MEASURES
    )


def stream_bronze_merged(spark, sf):
    """Up to eight batches of one bronze table, merged by date on the way and once more at the end."""
    landed, bronze, checkpoint = (work_path(spark, n) for n in ("landed", "bronze", "checkpoint"))
    files = _land_by_delivery(samples.raw_weather(spark, sf), landed, 8)
    stream = ingest.read_landed(spark, landed, max_files=files)
    # A date has fewer directories than a merge asks for by default, and the last batches may add none.
    jobs.stream_bronze(stream, bronze, checkpoint, merge_every=3, merge_least=1)
    jobs.merge_bronze(spark, bronze, 1, checkpoint)
    return ingest.read_stream_bronze(spark, bronze).select("event_id", "airport", "timestamp_utc", "event_date")


def stream_dual_sink(spark, sf):
    """Each batch goes to the raw zone and to a table; both hold every row."""
    landed, raw, table = (_landed(spark, sf), work_path(spark, "raw"), work_path(spark, "table"))
    run_id = raw_sink.new_run_id()
    sink = ingest.RawSink(raw, run_id, second=ingest.ParquetBatches(table, run_id))
    stream = ingest.read_landed(spark, landed).select(*schemas.RAW.names)
    ingest.start(stream, sink, work_path(spark, "checkpoint")).awaitTermination()
    stores = {"raw": raw_source.scan_raw(spark, raw), "table": spark.read.schema(schemas.RAW).parquet(table)}
    summary = None
    for name, rows in stores.items():
        one = rows.agg(
            F.count("*").alias("row_count"),
            F.count("event_id").alias("with_id"),
            F.min("timestamp_utc").alias("min_timestamp"),
        ).select(F.lit(name).alias("store"), "*")
        summary = one if summary is None else summary.unionByName(one)
    return summary


def stream_numbered_parts(spark, sf):
    """A batch takes one landed file and writes one numbered part; the last one is as short as its file."""
    landed, raw, checkpoint = (work_path(spark, n) for n in ("landed", "raw", "checkpoint"))
    rows = samples.raw_weather(spark, sf).select(*schemas.RAW.names)
    with table_sink.open_files(spark, len(fixed.STATIONS)):
        rows.repartition("airport").write.partitionBy("airport").json(landed)
    stream = ingest.read_landed(spark, landed, max_files=1).withColumn("airport", F.regexp_extract("_source_object", "airport=([^/]+)", 1))
    jobs.consume(stream, raw, checkpoint)
    parts = spark.read.schema(schemas.RAW).json(raw)
    by_part = parts.groupBy("part", "airport").agg(F.count("*").alias("row_count"))
    return by_part.select("airport", "row_count", F.count("*").over(Window.partitionBy("part")).alias("stations_of_part")).withColumn(
        "numbers", F.lit(by_part.agg(F.max("part").cast("bigint")).first()[0]).cast("bigint")
    )


def stream_stops(spark, sf):
    """Stops once a number of records has been read, starts again, stops when nothing comes: each row is there once."""
    landed, raw, checkpoint = (work_path(spark, n) for n in ("landed", "raw", "checkpoint"))
    rows = samples.raw_weather(spark, sf).select(*schemas.RAW.names)
    _land_files(rows, landed, 4)

    def stream():
        return ingest.read_landed(spark, landed, max_files=1).select(*schemas.RAW.names)

    jobs.consume(stream(), raw, checkpoint, max_records=1)
    first = raw_source.scan_raw(spark, raw).count()
    jobs.consume(stream(), raw, checkpoint, idle_seconds=4)
    stored = raw_source.scan_raw(spark, raw)
    return stored.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("_kafka_offset").alias("offset_count"),
        F.lit(first > 0).alias("stopped_with_rows"),
    )


def stream_raw_restart(spark, sf):
    """The second target fails once, the process dies behind a raw write, the next start names
    no run: both targets hold every row once. Only the batch that was cut short is written again."""
    landed, raw, table, checkpoint = (_landed(spark, sf), *(work_path(spark, n) for n in ("raw", "table", "checkpoint")))
    run_id = ingest.run_of(spark, checkpoint)

    def away(batch, batch_id):
        raise OSError("second target is away")

    sink = ingest.RawSink(raw, run_id, second=away)

    def dies(batch, batch_id):
        sink(batch, batch_id)
        raise RuntimeError("process is gone")

    def stream():
        return ingest.read_landed(spark, landed, max_bytes=_BATCH_BYTES).select(*schemas.RAW.names)

    try:
        ingest.start(stream(), dies, checkpoint).awaitTermination()
    except StreamingQueryException:
        pass
    jobs.consume(stream(), raw, checkpoint, table=table)
    stores = {"raw": raw_source.scan_raw(spark, raw), "table": spark.read.schema(schemas.RAW).parquet(table)}
    rows = [df.select(F.lit(name).alias("store"), "event_id", "_kafka_offset") for name, df in stores.items()]
    return rows[0].unionByName(rows[1])


def stream_score(spark, sf):
    """Rows scored as they stream in, next to the batch score of the same row."""
    gold_path, scores = work_path(spark, "gold"), work_path(spark, "scores")
    _gold(spark, sf).write.parquet(gold_path)
    gold = spark.read.schema(schemas.GOLD).parquet(gold_path)
    model = training.fit_final(gold, fixed.EXPERIMENTS[0])
    stream = scoring.read_gold_stream(spark, gold_path)
    scoring.start_scoring(stream, model, scores, work_path(spark, "checkpoint")).awaitTermination()
    batch = scoring.scored(gold, model).select("event_id", F.col("score").alias("batch_score"))
    return (
        spark.read.parquet(scores)
        .join(batch, "event_id")
        .select("event_id", "airport", "timestamp_utc", (F.col("score") == F.col("batch_score")).alias("same"))
    )


def stream_score_versions(spark, sf):
    """Gold is rebuilt with stronger winds while scoring follows: every event once a version, as a batch scores it."""
    gold, base, out, checkpoint = (_gold_table(spark, sf), *(work_path(spark, n) for n in ("versions", "scores", "checkpoint")))
    model = training.fit_final(gold, fixed.EXPERIMENTS[0])
    again = gold.withColumn("wind_speed_kts", F.col("wind_speed_kts") + 5)
    for build in (gold, again):
        versions.publish(build, base)
        versions.start_scoring(spark, base, model, out, checkpoint).awaitTermination()
    batch = None
    for number, build in ((1, gold), (2, again)):
        rows = scoring.scored(build, model).select("event_id", F.lit(number).alias("of"), F.col("score").alias("batch_score"))
        batch = rows if batch is None else batch.unionByName(rows)
    return (
        versions.scores(spark, out)
        .withColumnRenamed("event_id", "id")
        .join(batch, (F.col("id") == F.col("event_id")) & (F.col("version") == F.col("of")))
        .groupBy("version")
        .agg(
            F.count("*").alias("row_count"),
            # The name that rows are shuffled by for the join, so they need not be shuffled once more.
            F.count_distinct("id").alias("event_count"),
            F.count_if(F.col("score") == F.col("batch_score")).alias("same_score"),
        )
    )


def catalog() -> dict[str, Query]:
    listed = (
        grid_nearest_point,
        grid_extract,
        grid_extract_tiled,
        raw_scan,
        raw_write,
        raw_lineage,
        raw_last_objects,
        raw_manifest,
        read_fallback,
        kafka_decode,
        kafka_new_fields,
        raw_whole_record,
        bronze_roundtrip,
        sample_partitioned,
        kafka_encode,
        kafka_default_key,
        unit_conversion,
        event_id_key,
        raw_valid,
        bronze_typed,
        required_columns,
        peek_latest,
        smoke_avg,
        raw_by_airport,
        raw_time_bounds,
        storage_summary,
        flush_parts,
        bronze_dedup,
        bronze_table,
        silver_rule_label,
        silver_risk_score,
        class_count,
        quantile_threshold,
        price_quantile,
        silver_labeled,
        silver_fallback,
        label_distribution,
        label_source_distribution,
        gold_calendar,
        gold_rolling,
        gold_rolling_sliced,
        gold_dropna,
        gold_training_features,
        rolling_by_supplier,
        rolling_by_supplier_sliced,
        feature_vector,
        train_test_split,
        split_fallback,
        metrics_accuracy_f1,
        metrics_auc,
        best_run,
        top_runs,
        rf_train_eval,
        lr_train_eval,
        rf_by_tables,
        lr_by_tables,
        experiment_grid,
        runs_table,
        model_roundtrip,
        stream_raw_to_bronze,
        stream_dual_sink,
        stream_numbered_parts,
        stream_stops,
        stream_raw_restart,
        stream_score,
        stream_score_versions,
        stream_bronze_merged,
    )
    named = {q.__name__: _in_utc(q) for q in listed}
    named["flatten_nested"] = _in_utc(flatten)
    return named


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run
