import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from windrow.operators import labels, metrics
from windrow.operators.ordered import cumulative, exact_quantile


def skewed_values(n=3000, seed=3):
    """A third of all rows share one value, the rest spread over many magnitudes."""
    rnd = random.Random(seed)
    return [5.0 if i % 3 == 0 else rnd.choice([-1, 1]) * 10 ** rnd.uniform(-6, 9) for i in range(n)]


@pytest.mark.parametrize("p", [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0])
def test_quantile_is_exact(spark, p):
    values = skewed_values()
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    expected = sorted(values)[max(1, math.ceil(p * len(values))) - 1]
    assert exact_quantile(df, "x", p).first()[0] == expected


def test_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert exact_quantile(df, "x", 0.5).first()[0] is None


def test_quantile_of_one_value(spark):
    df = spark.createDataFrame([(2.0,)] * 10, "x double")
    assert exact_quantile(df, "x", 0.75).first()[0] == 2.0


def test_zeros_of_either_sign_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (-0.0,), (1.0,)], "x double")
    rows = cumulative(df, "x", {"n": F.count("*")}, buckets=4).orderBy("x").collect()
    assert [(r["n"], r["n_below"]) for r in rows] == [(3, 0), (1, 3)]


def test_running_counts(spark):
    values = skewed_values(900)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in cumulative(df, "x", {"n": F.count("*")}, buckets=16).collect():
        assert r["n"] == values.count(r["x"])
        assert r["n_below"] == sum(v < r["x"] for v in values)


def scored(spark, n=4000, seed=5, distinct=None):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        label = float(rnd.random() < 0.3)
        score = min(max(rnd.gauss(0.4 + 0.2 * label, 0.2), 0.0), 1.0)
        if distinct:
            score = round(score * distinct) / distinct
        rows.append((str(i), label, float(score > 0.5), score))
    return spark.createDataFrame(rows, "id string, label double, prediction double, score double")


@pytest.mark.parametrize("distinct", [None, 3, 50])
def test_area_equals_the_library(spark, distinct):
    df = scored(spark, distinct=distinct).cache()
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert metrics.area_under_roc(df).first()["auc"] == pytest.approx(theirs, abs=1e-12)


def test_area_per_run(spark):
    a, b = scored(spark, seed=1), scored(spark, seed=2, distinct=4)
    both = a.withColumn("run", F.lit("a")).unionByName(b.withColumn("run", F.lit("b")))
    got = {r["run"]: r["auc"] for r in metrics.area_under_roc(both, by=("run",)).collect()}
    for name, df in (("a", a), ("b", b)):
        assert got[name] == pytest.approx(metrics.area_under_roc(df).first()["auc"], abs=1e-12)


def test_the_counts_are_shuffled_once(spark, tmp_path):
    from plans import executed

    path = str(tmp_path / "scored")
    scored(spark, n=500).write.parquet(path)
    text = executed(metrics.area_under_roc(spark.read.parquet(path))).split("== Initial Plan ==")[0]
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_area_needs_both_classes(spark):
    df = scored(spark, n=50).where("label = 1")
    assert metrics.area_under_roc(df).first()["auc"] is None


def test_accuracy_and_f1_equal_the_library(spark):
    df = scored(spark).withColumn("label", F.when(F.col("id") % 7 == 0, 2.0).otherwise(F.col("label"))).cache()
    ours = metrics.accuracy_f1(metrics.confusion(df)).first()
    for name in ("accuracy", "f1"):
        theirs = MulticlassClassificationEvaluator(metricName=name).evaluate(df)
        assert ours[name] == pytest.approx(theirs, abs=1e-12)


def test_threshold_of_an_empty_score_is_an_error(spark):
    df = spark.createDataFrame([(None,)], "risk_score_proxy double")
    for error in (0, 0.01):
        with pytest.raises(ValueError):
            labels.score_threshold(df, relative_error=error)


def test_approximate_threshold_is_close(spark):
    values = [float(i) for i in range(10_000)]
    df = spark.createDataFrame([(v,) for v in values], "risk_score_proxy double")
    assert abs(labels.score_threshold(df) - 7500) <= 110
    assert labels.score_threshold(df, relative_error=0) == 7499.0
