import datetime
import glob

import pytest
from pyspark.sql import functions as F

from test_streaming import COLUMNS, chunks, content, hourly, land
from windrow import schemas
from windrow.checks import queries
from windrow.plans import jobs, layers, samples
from windrow.streaming import ingest, merging

LINEAGE = (*COLUMNS, "_kafka_partition", "_kafka_offset")


def batches(spark, rows, size):
    return [spark.createDataFrame(c, schemas.RAW).withColumn("_source_object", F.lit("")) for c in chunks(rows, size)]


def batch_bronze(spark, rows):
    return layers.build_bronze(spark.createDataFrame(rows, schemas.RAW).withColumn("_source_object", F.lit("")))


def test_many_small_batches_read_no_more_files_and_equal_batch_bronze(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "bronze"), []
    rows = hourly(60, redelivered=80, seed=21)
    sink = ingest.BronzeSink(path, "r1", merge_every=6)
    stored = ingest.BronzeSink._stored

    def counted(self, fresh):
        found = stored(self, fresh)
        seen.append((len(found.inputFiles()), found.count()) if found is not None else (0, 0))
        return found

    monkeypatch.setattr(ingest.BronzeSink, "_stored", counted)
    monkeypatch.setattr(merging, "LEAST", 2)
    for i, batch in enumerate(batches(spark, rows, 5)):
        sink(batch.coalesce(1), i)
    assert len(seen) == 40
    # Three dates, each with what came since the last two merges and one merged directory.
    assert max(files for files, _ in seen) <= 3 * (2 * 6 + 2 * merging.LEAST + 1)
    assert max(f for f, _ in seen[20:]) <= max(f for f, _ in seen[:20]) + 6
    want = content(batch_bronze(spark, rows), LINEAGE)
    assert content(ingest.read_stream_bronze(spark, path), LINEAGE) == want
    assert jobs.merge_bronze(spark, path, 1) > 0
    assert content(ingest.read_stream_bronze(spark, path), LINEAGE) == want


@pytest.fixture
def table(spark, tmp_path):
    path, rows = str(tmp_path / "bronze"), hourly(30, redelivered=20, seed=22)
    sink = ingest.BronzeSink(path, "r1", merge_every=None)
    for i, batch in enumerate(batches(spark, rows, 20)):
        sink(batch, i)
    return path, rows, sink


def test_a_merge_without_its_commit_is_not_read(spark, table, monkeypatch):
    path, rows, _ = table
    want = content(batch_bronze(spark, rows), LINEAGE)
    real = merging._register
    monkeypatch.setattr(merging, "_register", lambda p: str(p) + "-lost")
    assert merging.merge(spark, path, ingest.STREAM_BRONZE, 1) > 0
    monkeypatch.setattr(merging, "_register", real)
    assert glob.glob(f"{path}/*/run_id=merged/batch_id=1")
    assert content(ingest.read_stream_bronze(spark, path), LINEAGE) == want
    assert merging.merge(spark, path, ingest.STREAM_BRONZE, 1) > 0
    assert content(ingest.read_stream_bronze(spark, path), LINEAGE) == want


def test_replaced_directories_go_with_the_next_merge(spark, table):
    path, rows, sink = table
    places = lambda: {p.split("/bronze/")[1] for p in glob.glob(f"{path}/*/*/*")}
    before = places()
    merging.merge(spark, path, ingest.STREAM_BRONZE, 1)
    # A reader of the old directories can finish.
    assert before < places()
    assert merging.clear(spark, path) > 0
    newest = max(int(p.rsplit("=", 1)[1]) for p in before)
    assert all("run_id=merged" in p or p.endswith(f"={newest}") for p in places())
    assert merging.merge(spark, path, ingest.STREAM_BRONZE, 1) == 0
    assert content(ingest.read_stream_bronze(spark, path), LINEAGE) == content(batch_bronze(spark, rows), LINEAGE)
    # The newest batch may be written again, and redeliveries of merged events are still known.
    last = batches(spark, rows, 20)[newest]
    sink(last, newest)
    sink(spark.createDataFrame(rows, schemas.RAW).withColumn("_source_object", F.lit("")), newest + 1)
    assert ingest.read_stream_bronze(spark, path).count() == 60


def test_nothing_to_merge(spark, tmp_path):
    assert merging.merge(spark, str(tmp_path / "none"), ingest.STREAM_BRONZE) == 0
    with pytest.raises(ValueError):
        ingest.BronzeSink(str(tmp_path), merging.MERGED)


def test_the_step_streams_to_bronze(spark, tmp_path):
    rows = hourly(24, redelivered=10, seed=23)
    landed = str(tmp_path / "in")
    land(spark, landed, chunks(rows, 20))
    stream = ingest.read_landed(spark, landed, max_files=1).drop("_source_object")
    got = jobs.stream_bronze(stream, str(tmp_path / "bronze"), str(tmp_path / "cp"), merge_every=1)
    assert content(got, LINEAGE) == content(batch_bronze(spark, rows), LINEAGE)
    # The next start takes the run's name from the checkpoint.
    land(spark, landed, [rows[:5]])
    assert jobs.stream_bronze(stream, str(tmp_path / "bronze"), str(tmp_path / "cp")).count() == 48


def test_every_merge_of_the_query_merges(spark, tmp_path, monkeypatch):
    # Dates come in order, as in the tables, and the last batches bring redeliveries only.
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (i, start + datetime.timedelta(hours=5 * i), i, "error" if i % 4 == 0 else "view", float(i), f'{{"k": {i}}}')
        for i in range(90)
    ]
    events = spark.createDataFrame(rows, samples._SCHEMAS["events"])
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    merged, real = [], merging.merge

    def counted(*args, **options):
        merged.append(real(*args, **options))
        return merged[-1]

    monkeypatch.setattr(merging, "merge", counted)
    got = queries.stream_bronze_merged(spark, str(tmp_path))
    assert len(merged) == 3 and all(merged)
    want = layers.build_bronze(samples.raw_weather(spark, str(tmp_path)))
    assert want.count() > 80 and content(got, got.columns) == content(want, got.columns)


def test_the_newest_batch_is_merged_once_it_is_committed(spark, tmp_path):
    rows = hourly(40, redelivered=10, seed=25)
    landed, path, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "cp"))
    land(spark, landed, [rows, rows[:7]])
    jobs.stream_bronze(ingest.read_landed(spark, landed, max_files=1), path, checkpoint)
    # The second batch added nothing, so the first one is the newest of its run.
    assert jobs.merge_bronze(spark, path, 1) == 0
    assert jobs.merge_bronze(spark, path, 1, str(tmp_path / "other")) == 0
    assert jobs.merge_bronze(spark, path, 1, checkpoint) == 2
    want = content(batch_bronze(spark, rows), LINEAGE)
    assert content(ingest.read_stream_bronze(spark, path), LINEAGE) == want
    # A batch without a commit may still be written again and is left alone.
    more, (name, last) = hourly(48, seed=25), ingest.last_commit(spark, checkpoint)
    assert last == 1
    sink = ingest.BronzeSink(path, name)
    for _ in range(2):
        sink(batches(spark, more, len(more))[0], last + 1)
        assert jobs.merge_bronze(spark, path, 1, checkpoint) == 0
        assert ingest.read_stream_bronze(spark, path).count() == 96


def test_a_second_target_is_repaired_while_the_stream_runs(spark, tmp_path):
    landed, raw, table = (str(tmp_path / n) for n in ("in", "raw", "table"))
    land(spark, landed, chunks(hourly(36, seed=24), 24))
    target, calls = ingest.ParquetBatches(table, "r1"), []

    class Second:
        batches = target.batches

        def __call__(self, batch, batch_id):
            calls.append(batch_id)
            if calls == [0]:
                raise OSError("target away")
            target(batch, batch_id)

    sink = ingest.RawSink(raw, "r1", second=Second())
    stream = ingest.read_landed(spark, landed, max_files=1).select(*schemas.RAW.names)
    ingest.start(stream, sink, str(tmp_path / "cp")).awaitTermination()
    assert calls == [0, 1, 0, 2] and sink.missed(spark) == []


def test_a_run_folder_without_a_row_is_filled(spark, tmp_path):
    (tmp_path / "cp-run").mkdir()
    (tmp_path / "cp-run" / "part-0.json").write_text("")
    name = ingest.run_of(spark, str(tmp_path / "cp"))
    assert name and ingest.run_of(spark, str(tmp_path / "cp")) == name
