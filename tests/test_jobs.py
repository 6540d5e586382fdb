"""All steps from a gridded archive to ranked runs, on 72 hourly events of one station."""

import pytest
from pyspark.sql import functions as F

from windrow import __main__ as cli
from windrow import fixed, schemas
from windrow.operators import runs
from windrow.plans import jobs
from windrow.session import materialise
from windrow.sources.tables import read_table
from windrow.streaming import ingest, scoring


@pytest.fixture(scope="module")
def archive(spark):
    """Three days, hourly, on a 0.25 degree grid around one station."""
    hours = spark.range(96).select((F.col("id") - 12).alias("h"))
    points = spark.range(9).select(
        (40.25 + F.floor(F.col("id") / 3) * 0.25).alias("latitude"), (286.0 + F.col("id") % 3 * 0.25).alias("longitude")
    )
    listed = [F.struct(F.lit(r[0]).alias("a"), F.lit(r[1]).alias("o")) for r in points.collect()]
    cells = hours.withColumn("p", F.explode(F.array(*listed)))
    h = F.col("h").cast("double")
    grid = cells.select(
        (F.lit("2022-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("h").cast("int"))).alias("time"),
        F.col("p.a").alias("latitude"),
        F.col("p.o").alias("longitude"),
        (270 + h / 10 + F.col("p.a")).alias("2m_temperature"),
        (h / 10).alias("10m_u_component_of_wind"),
        F.lit(1.0).alias("10m_v_component_of_wind"),
        (h / 1e6).alias("total_precipitation"),
        F.lit(101000.0).alias("surface_pressure"),
        (h * 3).alias("convective_available_potential_energy"),
    )
    return materialise(grid, "grid")


def test_from_archive_to_ranked_runs(spark, archive, tmp_path):
    at = {n: str(tmp_path / n) for n in ("sample", "landed", "raw", "table", "cp", "lake", "runs", "model", "best")}
    events = jobs.sample(archive, at["sample"], "2022-01-01T00:00:00", "2022-01-03T23:00:00")
    assert events.count() == 72
    first = events.orderBy("timestamp_utc").first()
    assert first["event_id"] == "JFK_2022-01-01T00:00:00"
    assert (first["latitude"], first["longitude"]) == (40.75, 286.25)

    sent = spark.read.schema(schemas.EVENT).json(at["sample"] + "/jsonl")
    sent.repartitionByRange(3, "timestamp_utc").write.json(at["landed"])
    landed = ingest.read_landed(spark, at["landed"], schema=schemas.EVENT).select(
        *fixed.EVENT_COLUMNS,
        F.lit(fixed.TOPIC).alias("_kafka_topic"),
        F.lit(0).alias("_kafka_partition"),
        F.hour(F.to_timestamp("timestamp_utc")).cast("long").alias("_kafka_offset"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("_ingested_at_utc"),
    )
    assert jobs.consume(landed, at["raw"], at["cp"], table=at["table"]).missed(spark) == []

    summary, columns, second = jobs.validate(spark, at["raw"], at["table"])
    assert second == 72
    assert jobs.validate(spark, at["raw"], str(tmp_path / "nowhere"))[2] is None
    row = summary.first()
    assert (row["total_rows"], row["airport_list"]) == (72, "JFK")
    assert (row["min_timestamp"], row["max_timestamp"]) == ("2022-01-01 00:00:00", "2022-01-03 23:00:00")
    assert {(r["present"], r["filled_rows"]) for r in columns.collect()} == {(True, 72)}

    assert jobs.bronze(spark, at["raw"], at["lake"])["parquet"] == "written"
    jobs.silver(spark, at["lake"])
    silver = read_table(spark, f"{at['lake']}/{jobs.SILVER}", schemas.SILVER)
    # A calm sample has one class, so the score quantile decides.
    assert {r[0] for r in silver.select("label_source").distinct().collect()} == {fixed.FALLBACK_SOURCE}
    assert 17 <= silver.where("label = 1").count() <= 20
    jobs.gold(spark, at["lake"])
    gold = read_table(spark, f"{at['lake']}/{jobs.GOLD}", schemas.GOLD)
    assert gold.count() == 72

    metrics = jobs.train(spark, at["lake"], at["model"])
    assert 0.5 < metrics["accuracy"] <= 1
    ranked = jobs.experiments(spark, at["lake"], at["runs"], at["best"], refit="best").collect()
    assert len(ranked) == 5 and ranked == sorted(ranked, key=lambda r: (-r["f1"], r["run_id"]))
    assert runs.read_runs(spark, at["runs"]).count() == 5
    assert scoring.scored(gold, scoring.load_model(at["model"])).count() == 72


def test_consume_waits_until_it_has_enough(spark, tmp_path):
    from test_streaming import chunks, hourly, land
    from windrow.sources import raw as raw_source

    landed, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    land(spark, landed, chunks(hourly(36), 12))
    stream = ingest.read_landed(spark, landed, max_files=1)
    sink = jobs.consume(stream, raw, str(tmp_path / "cp"), run_id="r1", max_records=72, idle_seconds=60)
    assert sink.run_id == "r1" and raw_source.scan_raw(spark, raw).count() == 72


def test_empty_raw_zone_is_an_error(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text('{"test": 1}\n')
    with pytest.raises(ValueError, match="raw zone"):
        jobs.bronze(spark, str(tmp_path / "raw"), str(tmp_path / "lake"))


def test_the_command_line_names_every_step():
    args = cli.parser().parse_args(["bronze", "--raw", "a", "--lake", "b"])
    assert (args.step, args.raw, args.lake) == ("bronze", "a", "b")
    args = cli.parser().parse_args(["consume", "--servers", "s", "--raw", "r", "--checkpoint", "c"])
    assert (args.table, args.idle_seconds, args.max_records, args.object_rows) == (None, 60, None, cli.OBJECT_ROWS)
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["silver"])
