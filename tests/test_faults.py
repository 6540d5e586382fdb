"""Small faults of earlier versions that must not come back."""

import pytest
from pyspark.sql import functions as F

from windrow import fixed
from windrow.operators import ordered, split, training
from windrow.operators.rolling import _by_range
from windrow.sources import grid as grid_source
from windrow.sources import raw as raw_source
from windrow.streaming import scoring


def test_quantile_of_large_integers_is_exact(spark):
    df = spark.range(9007199254740993, 9007199254741093).withColumnRenamed("id", "x")
    assert ordered.exact_quantile(df, "x", 0.51).first()[0] == 9007199254741043


def test_slices_stay_below_the_limit(spark):
    keyed = spark.range(20_000).select(F.lit("a").alias("k"), F.col("id").alias("_order_s"), F.col("id").alias("t"))
    sliced = _by_range(keyed, "k", ["t"], 2 * 200)
    assert sliced.groupBy("_slice").count().agg(F.max("count")).first()[0] <= 100


def test_a_date_as_end_means_its_day(spark):
    times = spark.range(72).select(F.timestamp_seconds(F.col("id") * 3600 + 1640995200).alias("time"))
    until = grid_source._until
    assert times.where(until("time", "2022-01-03")).count() == 72
    assert times.where(until("time", "2022-01-03 00:00:00")).count() == 49


def test_a_missing_key_has_no_side(spark):
    df = spark.createDataFrame([("a",), (None,)], "event_id string")
    sides = {r.event_id: r.side for r in split.with_side(df).collect()}
    assert sides[None] is None and sides["a"] in ("train", "test")
    assert sum(part.count() for part in split.split_rows(df)) == 1


def test_object_keys_keep_repeated_directory_names(spark, tmp_path):
    path = tmp_path / "raw" / "run_id=a" / "raw" / "day=01"
    path.mkdir(parents=True)
    (path / "part-00001.jsonl").write_text('{"event_id": "x"}\n')
    for prefix in (f"{tmp_path}/raw", f"file://{tmp_path}/raw/"):
        key = raw_source.scan_raw(spark, prefix).first()["_source_object"]
        assert key == "run_id=a/raw/day=01/part-00001.jsonl"
        assert raw_source.manifest(spark, prefix).first()["object_key"] == key


def test_runs_need_names_of_their_own(gold):
    spec = fixed.EXPERIMENTS[0]
    with pytest.raises(ValueError, match="names"):
        training.fit_and_evaluate(gold, [spec, {**spec}])


def test_a_saved_model_says_what_it_is(gold, tmp_path):
    spec = next(s for s in fixed.EXPERIMENTS if s["model_type"] == "logistic_regression")
    training.save_model(training.fit_final(gold, spec), str(tmp_path / "model"))
    assert type(scoring.load_model(str(tmp_path / "model"))).__name__ == "LogisticRegressionModel"


def test_a_value_that_does_not_parse_is_an_error(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
