import pytest
from pyspark.sql import functions as F

from windrow import fixed
from windrow.operators import training
from windrow.plans import jobs
from windrow.streaming import scoring, versions


@pytest.fixture(scope="module")
def model(gold):
    return training.fit_final(gold, fixed.EXPERIMENTS[0], partitions=2)


def score(spark, base, model, tmp_path, **options):
    out = str(tmp_path / "scores")
    versions.start_scoring(spark, base, model, out, str(tmp_path / "cp"), **options).awaitTermination()
    return versions.scores(spark, out)


def test_a_table_rebuilt_twice_is_scored_once_a_version(spark, gold, model, tmp_path):
    base = str(tmp_path / "versions")
    builds = [gold, gold.where("wind_speed_kts > 10"), gold.withColumn("wind_speed_kts", F.lit(40.0))]
    for i, build in enumerate(builds, 1):
        assert versions.publish(build, base) == i
        got = score(spark, base, model, tmp_path)
        assert got.select("version").distinct().count() == i
    score(spark, base, model, tmp_path)
    for i, build in enumerate(builds, 1):
        mine = {r.event_id: r.score for r in got.where(F.col("version") == i).collect()}
        assert mine == {r.event_id: r.score for r in scoring.scored(build, model).collect()}
        assert got.where(F.col("version") == i).count() == len(mine)
        assert versions.read_version(spark, base, i).count() == len(mine)
    assert versions.read_version(spark, base).count() == builds[-1].count()


def test_a_batch_tried_again_writes_its_versions_over(spark, gold, model, tmp_path):
    base = str(tmp_path / "versions")
    versions.publish(gold, base)
    score(spark, base, model, tmp_path)
    # The checkpoint is lost: the pointers are read from the start.
    out = str(tmp_path / "scores")
    versions.start_scoring(spark, base, model, out, str(tmp_path / "cp2")).awaitTermination()
    assert versions.scores(spark, out).count() == gold.count()


def test_only_new_events(spark, gold, model, tmp_path):
    base, part = str(tmp_path / "versions"), gold.where("airport = 'JFK'")
    versions.publish(part, base)
    score(spark, base, model, tmp_path, only_new=True)
    versions.publish(gold, base)
    got = score(spark, base, model, tmp_path, only_new=True)
    assert got.count() == got.select("event_id").distinct().count() == gold.count()
    assert got.where("version = 2 AND airport = 'JFK'").isEmpty()


def test_a_build_that_fails_has_no_pointer(spark, gold, tmp_path):
    base = str(tmp_path / "versions")
    gold.limit(3).write.parquet(f"{base}/build-1")
    assert versions.last_version(spark, base) == 0
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, base)
    assert versions.publish(gold, base) == 1
    assert versions.read_version(spark, base).count() == gold.count()
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, base, 9)


def test_the_steps(spark, gold, model, tmp_path):
    lake, saved = str(tmp_path / "lake"), str(tmp_path / "model")
    gold.write.parquet(f"{lake}/{jobs.GOLD}_parquet")
    training.save_model(model, saved)
    for _ in range(2):
        jobs.publish(spark, lake)
        jobs.score(spark, lake, saved, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert versions.scores(spark, str(tmp_path / "out")).count() == 2 * gold.count()


def test_events_are_counted_where_the_join_has_them(spark, sf):
    """With a join by shuffle: both its sides and the counts of the versions, no third time for the rows."""
    from windrow.checks import queries

    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        found = queries.stream_score_versions(spark, sf)
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set(key, before)
