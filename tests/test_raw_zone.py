import json

import pytest
from pyspark.sql import functions as F

from plans import plan
from windrow import fixed, schemas
from windrow.functions.flatten import flatten_nested
from windrow.operators import quality
from windrow.plans import layers
from windrow.sinks import kafka as kafka_sink
from windrow.sinks import raw as raw_sink
from windrow.sinks import tables as table_sink
from windrow.sources import kafka as kafka_source
from windrow.sources import raw as raw_source
from windrow.sources import tables as table_source

RUN = "run_id=20220101T000000Z-abcdef12/year=2022/month=01/day=02"


def event(i, **changes):
    made = {
        "event_id": f"JFK_2022-01-01T{i:02d}:00:00",
        "airport": "JFK",
        "timestamp_utc": f"2022-01-01 {i:02d}:00:00",
        "latitude": 40.75,
        "longitude": 286.25,
        "temperature_c": 1.5,
        "wind_speed_kts": 10.0 + i,
        "precipitation_mm": 0.0,
        "surface_pressure_pa": 101000.0,
        "cape_j_kg": 5.0,
        "_kafka_topic": fixed.TOPIC,
        "_kafka_partition": 0,
        "_kafka_offset": i,
        "_ingested_at_utc": "2022-01-02T00:00:00+00:00",
    }
    made.update(changes)
    return made


@pytest.fixture
def prefix(tmp_path):
    base = tmp_path / "kafka_weather_events"
    folder = base / RUN
    folder.mkdir(parents=True)

    def put(name, lines):
        (folder / name).write_text("\n".join(lines) + "\n")

    put("part-00001.jsonl", [json.dumps(event(i)) for i in range(10)])
    put(
        "part-00002.jsonl",
        [json.dumps(event(10)), "", json.dumps({"test": "hello"}), json.dumps(event(11))],
    )
    nan = json.dumps(event(12, cape_j_kg=float("nan")))
    assert "NaN" in nan
    put("part-00003.jsonl", [nan, json.dumps(event(13, event_id=None))])
    return str(base)


def test_scan_reads_every_object_and_skips_blank_lines(spark, prefix):
    rows = raw_source.scan_raw(spark, prefix)
    assert rows.columns == [*schemas.RAW.names, "_source_object"]
    assert rows.count() == 15
    valid = quality.valid_events(rows)
    assert valid.count() == 13
    parts = {r["_source_object"]: r["row_count"] for r in quality.rows_per_object(valid).collect()}
    assert parts == {f"{RUN}/part-0000{n}.jsonl": c for n, c in ((1, 10), (2, 2), (3, 1))}


def test_nan_in_a_line_is_nan_and_leaves_gold(spark, prefix):
    bronze = layers.build_bronze(raw_source.scan_raw(spark, prefix))
    assert bronze.where(F.isnan("cape_j_kg")).count() == 1
    silver = layers.build_silver(bronze, relative_error=0)
    assert {r[0] for r in silver.select("label_source").distinct().collect()} == {fixed.FALLBACK_SOURCE}
    gold = layers.build_gold(silver)
    assert bronze.count() == 13 and gold.count() == 12


def test_a_malformed_line_stops_or_is_kept_apart(spark, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    (folder / "part-00001.jsonl").write_text(json.dumps(event(0)) + '\n{"event_id": "JFK_2022\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        raw_source.scan_raw(spark, str(folder)).collect()
    rows = raw_source.scan_raw(spark, str(folder), bad_lines="keep").cache()
    assert raw_source.good_lines(rows).count() == 1
    assert raw_source.bad_lines(rows).first()["_corrupt_record"] == '{"event_id": "JFK_2022'


def test_manifest_reads_no_contents(spark, prefix):
    listing = raw_source.manifest(spark, prefix)
    assert "content" not in plan(listing).split("ReadSchema")[-1]
    assert [r["object_key"].rsplit("/", 1)[-1] for r in raw_source.last_objects(listing, 2).collect()] == [
        "part-00003.jsonl",
        "part-00002.jsonl",
    ]
    assert listing.count() == 3 and listing.agg(F.min("size_bytes")).first()[0] > 0


def test_summary_counts_listed_objects(spark, prefix):
    (one,) = quality.storage_summary(
        quality.valid_events(raw_source.scan_raw(spark, prefix)), raw_source.manifest(spark, prefix)
    ).collect()
    assert one.asDict() == {
        "total_rows": 13,
        "unique_airports": 1,
        "airport_list": "JFK",
        "min_timestamp": "2022-01-01 00:00:00",
        "max_timestamp": "2022-01-01 12:00:00",
        "min_kafka_offset": 0,
        "max_kafka_offset": 12,
        "stored_objects": 3,
    }


def counting(spark, df):
    """``df`` and an accumulator of the rows that were read of it."""
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), read


def test_checks_read_their_input_once(spark, tmp_path):
    rows = spark.createDataFrame([event(i % 24, _kafka_offset=i) for i in range(96)], schemas.RAW)
    rows = rows.withColumn("_source_object", F.concat(F.lit("o"), F.col("_kafka_offset") % 7))
    once, read = counting(spark, rows)
    (one,) = quality.storage_summary(once).collect()
    assert (one["total_rows"], one["stored_objects"], one["unique_airports"]) == (96, 7, 1) and read.value == 96
    once, read = counting(spark, rows)
    stored = table_sink.write_checked(once, str(tmp_path / "t"), ("_kafka_partition",))
    assert stored.count() == 96 and read.value == 96
    with pytest.raises(RuntimeError, match="Expected 95"):
        table_sink.write_checked(rows, str(tmp_path / "t"), ("_kafka_partition",), 95)


def test_summary_of_nothing(spark):
    (one,) = quality.storage_summary(
        spark.createDataFrame([], schemas.RAW).withColumn("_source_object", F.lit("x"))
    ).collect()
    assert (one["total_rows"], one["unique_airports"], one["stored_objects"], one["airport_list"]) == (0, 0, 0, "")


def test_written_objects_hold_at_most_the_flush_size(spark, tmp_path):
    rows = spark.createDataFrame([event(i % 24, _kafka_offset=i) for i in range(72)], schemas.RAW).coalesce(1)
    path, run_id = str(tmp_path / "raw"), raw_sink.new_run_id()
    raw_sink.write_raw(rows, path, run_id, max_records=fixed.FLUSH_ROWS)
    sizes = [r["row_count"] for r in quality.rows_per_object(raw_source.scan_raw(spark, path)).collect()]
    assert sorted(sizes) == [2] + [10] * 7
    keys = [r["object_key"] for r in raw_source.manifest(spark, path).collect() if r["object_key"].endswith(".json")]
    assert all(k.startswith(f"run_id={run_id}/year=2022/month=01/day=02/") for k in keys)


def test_run_ids_differ_and_start_with_the_time():
    a, b = raw_sink.new_run_id(), raw_sink.new_run_id()
    assert a != b and len(a) == len("20220101T000000Z-abcdef12") and a[8] == "T"


def test_bad_text_fails_or_is_rejected(spark):
    schema = "event_id string, airport string, timestamp_utc string, " + ", ".join(
        f"{c} string" for c in fixed.BRONZE_MEASURES
    )
    ok = {c: "1.5" for c in fixed.BRONZE_MEASURES}
    rows = [
        {"event_id": "a", "airport": "JFK", "timestamp_utc": "2022-01-01 00:00:00", **ok},
        {"event_id": "b", "airport": "JFK", "timestamp_utc": "yesterday", **ok},
        {"event_id": "c", "airport": "JFK", "timestamp_utc": "2022-01-01 01:00:00", **{**ok, "cape_j_kg": "much"}},
    ]
    raw = spark.createDataFrame(rows, schema)
    for c in (*fixed.DELIVERY_COLUMNS, "_source_object"):
        raw = raw.withColumn(c, F.lit("0").cast(schemas.BRONZE[c].dataType))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        layers.build_bronze(raw).collect()
    kept = {r["event_id"]: r["cape_j_kg"] for r in layers.build_bronze(raw, strict=False).collect()}
    assert kept == {"a": 1.5, "c": None}
    assert {r["event_id"] for r in layers.rejected_events(raw).collect()} == {"b", "c"}


def test_required_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert quality.missing_columns(df, ["a", "c", "b", "d"]) == ["c", "d"]
    with pytest.raises(ValueError, match="c"):
        quality.require_columns(df, ["c"])
    report = {r["column_name"]: (r["present"], r["filled_rows"]) for r in quality.column_report(df, "abc").collect()}
    assert report == {"a": (True, 2), "b": (True, 1), "c": (False, 0)}


def test_empty_input_is_an_error(spark):
    with pytest.raises(ValueError, match="bronze"):
        layers.build_silver(spark.createDataFrame([], schemas.BRONZE))


def test_topic_round_trip(spark, raw):
    events = raw.select(*fixed.EVENT_COLUMNS)
    encoded = kafka_sink.encode(events)
    assert encoded.columns == ["key", "value"]
    records = encoded.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(fixed.TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(7).cast("long").alias("offset"),
    )
    back = kafka_source.decode(records)
    assert back.select(*fixed.EVENT_COLUMNS).exceptAll(events).isEmpty()
    first = back.first()
    assert (first["_kafka_topic"], first["_kafka_offset"]) == (fixed.TOPIC, 7)
    assert first["_ingested_at_utc"][-1] == "Z" or first["_ingested_at_utc"].endswith("+00:00")


def test_an_event_without_airport_gets_the_fixed_key(spark):
    df = spark.createDataFrame([(None, 1), ("JFK", 2)], "airport string, n int")
    assert {r["key"] for r in kafka_sink.encode(df).collect()} == {"UNKNOWN", "JFK"}


def test_a_test_message_on_the_topic_is_filtered(spark):
    records = spark.createDataFrame(
        [(bytearray(b'{"test": "hello"}'), fixed.TOPIC, 0, 1)], "value binary, topic string, partition int, offset long"
    )
    assert quality.valid_events(kafka_source.decode(records)).isEmpty()


def test_flatten_leaves_plain_columns_alone(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert flatten_nested(df) is df
    nested = df.select("n", F.struct("s").alias("o"), F.lit("2022-01-01").cast("date").alias("d"))
    assert flatten_nested(nested).first().asDict() == {"n": 1, "o": '{"s":"a"}', "d": "2022-01-01"}


def test_fallback_reads_the_format_that_is_there(spark, bronze, tmp_path):
    base = str(tmp_path / "bronze")
    with pytest.raises(FileNotFoundError):
        table_source.read_table(spark, base)
    assert table_sink.write_formats(bronze, base)["parquet"] == "written"
    assert table_source.read_table(spark, base).count() == bronze.count()


def test_other_read_errors_are_not_swallowed(spark, tmp_path):
    folder = tmp_path / "t_parquet"
    folder.mkdir()
    (folder / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        table_source.read_table(spark, str(tmp_path / "t"), formats=("parquet",))


def test_delta_tables(spark, bronze, tmp_path):
    base = str(tmp_path / "bronze")
    if table_sink.write_formats(bronze, base, formats=("parquet", "delta"))["delta"] != "written":
        pytest.skip("the Delta connector is not on the class path")
    assert table_source.read_table(spark, base, formats=("delta",)).count() == bronze.count()


def test_read_back_check_notices_lost_rows(spark, bronze, tmp_path):
    stored = table_sink.write_checked(bronze, str(tmp_path / "a"))
    assert stored.columns == bronze.columns and stored.count() == bronze.count()
    with pytest.raises(RuntimeError, match="rows"):
        table_sink.write_checked(bronze, str(tmp_path / "b"), expected_rows=1)


def test_tables_are_laid_out_by_date_with_few_files(spark, bronze, tmp_path):
    path = tmp_path / "bronze"
    table_sink.write_table(bronze, str(path))
    dates = list(path.glob("event_date=*"))
    assert len(dates) == bronze.select("event_date").distinct().count()
    assert len(list(path.glob("event_date=*/*.parquet"))) <= 2 * len(dates)
    one = dates[0].name.split("=")[1]
    assert f"event_date#" in plan(spark.read.parquet(str(path)).where(F.col("event_date") == one))


def test_known_fields_are_taken_in_one_walk(spark):
    """One look at a record for all columns, and one for the map of its fields."""
    value = '{"event_id": 5, "latitude": "12.5", "cape_j_kg": 1e3, "gust": 7, "origin": {"a": [1]}}'
    records = spark.createDataFrame([(value, "t", 0, 1)], "value string, topic string, partition int, offset long")
    found = kafka_source.decode(records)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_get(_whole") == 2
    row = found.first()
    assert (row.event_id, row.latitude, row.cape_j_kg, row.airport) == ("5", 12.5, 1000.0, None)
    assert row._rest == {"gust": "7", "origin": '{"a":[1]}'}
