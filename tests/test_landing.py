"""How landed files come about and how much of them a batch takes."""

import glob
import os

from pyspark.sql import functions as F

from test_streaming import chunks, hourly, land
from windrow import schemas
from windrow.checks import queries
from windrow.sinks import tables as table_sink
from windrow.streaming import ingest


def test_open_files_write_directories_without_a_sort(spark, tmp_path):
    rows = spark.range(3000).withColumn("airport", F.concat(F.lit("A"), (F.col("id") % 3).cast("string")))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")

    def written(path):
        """Nodes of the plan that the write ran."""
        rows.repartition("airport").write.partitionBy("airport").json(path)
        store = spark._jsparkSession.sharedState().statusStore().executionsList()
        return store.apply(store.size() - 1).physicalPlanDescription()

    assert "Sort" in written(str(tmp_path / "sorted"))
    with table_sink.open_files(spark, 3):
        assert "Sort" not in written(str(tmp_path / "open"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert len(glob.glob(str(tmp_path / "open" / "airport=*" / "*.json"))) == 3
    assert spark.read.json(str(tmp_path / "open")).groupBy("airport").count().where("count = 1000").count() == 3


def test_a_batch_of_bounded_bytes_leaves_the_rest_to_the_next(spark, tmp_path):
    landed = str(tmp_path / "landed")
    land(spark, landed, chunks(hourly(24), 8))
    size = os.path.getsize(sorted(glob.glob(f"{landed}/*.json"))[0])
    seen = []
    stream = ingest.read_landed(spark, landed, max_bytes=int(size * 2.5)).select(*schemas.RAW.names)
    ingest.start(stream, lambda batch, _: seen.append(batch.count()), str(tmp_path / "checkpoint")).awaitTermination()
    assert len(seen) == 3 and sum(seen) == 48


def test_landed_files_come_from_where_the_rows_stand(spark, tmp_path):
    for parts, files in ((1, 4), (6, 6)):
        path = str(tmp_path / str(parts))
        queries._land_files(spark.range(0, 1002, 1, parts), path, 4)
        assert len(glob.glob(f"{path}/*.json")) == files and spark.read.json(path).count() == 1002


def test_redeliveries_land_behind_first_deliveries_without_a_shuffle(spark, tmp_path):
    for parts, each in ((1, 1), (16, 4)):
        path = str(tmp_path / str(parts))
        rows = spark.range(0, 1000, 1, parts).select(
            F.when(again_of("id"), "part-replay.jsonl").otherwise("part-00000000.jsonl").alias("_source_object"),
            F.col("id").alias("_kafka_offset"),
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RAW.fields if f.name != "_kafka_offset"],
        )
        assert queries._land_by_delivery(rows, path, 8) == each
        by_age = sorted(glob.glob(f"{path}/*.json"), key=os.path.getmtime)
        late = [spark.read.schema(schemas.RAW).json(f).where(again_of("_kafka_offset")).count() > 0 for f in by_age]
        assert late == sorted(late) and any(late) and not all(late)
        assert spark.read.schema(schemas.RAW).json(path).count() == 1000
        store = spark._jsparkSession.sharedState().statusStore().executionsList()
        plans = [store.apply(i).physicalPlanDescription() for i in range(store.size())]
        assert not any("REPARTITION" in p and path in p for p in plans)


def again_of(column):
    return F.col(column) % 5 == 0
