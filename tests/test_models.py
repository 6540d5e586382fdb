import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from windrow import fixed
from windrow.checks import queries
from windrow.operators import metrics, model_tables, runs, training
from windrow.streaming import scoring

SMALL_SPECS = (fixed.EXPERIMENTS[0], fixed.EXPERIMENTS[4])


@pytest.fixture(scope="module")
def records(gold):
    return training.run_experiments(gold, SMALL_SPECS, partitions=2)


def test_metrics_equal_the_library(gold):
    rows = training.model_rows(gold, partitions=2)
    model = training.estimator(fixed.EXPERIMENTS[0]).fit(rows)
    scored = training.score(model, rows).cache()
    ours = training.evaluate(scored).first()
    for name in ("accuracy", "f1"):
        theirs = MulticlassClassificationEvaluator(metricName=name).evaluate(scored)
        assert ours[name] == pytest.approx(theirs, abs=1e-12)
    theirs = BinaryClassificationEvaluator(numBins=0).evaluate(scored)
    assert ours["auc"] == pytest.approx(theirs, abs=1e-12)


def test_vectors_hold_the_features_in_order(gold):
    row = training.assemble(gold).first()
    assert list(row["features"].toArray()) == [float(row[c]) for c in fixed.FEATURE_COLUMNS]


def test_gaps_are_refused_by_the_assembler(gold):
    with pytest.raises(Exception, match="(?i)null"):
        training.assemble(gold.withColumn("cape_j_kg", F.lit(None).cast("double"))).collect()


def test_the_forest_does_not_depend_on_the_input_partitioning(gold):
    trees = {
        training.fit_final(gold.repartition(n), fixed.EXPERIMENTS[0], partitions=2).toDebugString.split("\n", 1)[1]
        for n in (1, 3, 8)
    }
    assert len(trees) == 1


def test_runs_are_recorded(records):
    assert [r["run_name"] for r in records] == [s["run_name"] for s in SMALL_SPECS]
    for r in records:
        assert 0.5 < r["metrics"]["accuracy"] <= 1 and 0.5 < r["metrics"]["f1"] <= 1 and 0.5 < r["metrics"]["auc"] <= 1
        assert r["params"]["train_rows"] > r["params"]["test_rows"] > 0
    assert records[0]["params"]["numTrees"] == 5 and records[1]["params"]["regParam"] == 0.01


def test_sessions_share_rows_that_are_laid_out_once(spark, sf, gold, monkeypatch):
    apart = [training.run_experiments(gold, [spec], partitions=2)[0]["metrics"] for spec in SMALL_SPECS]
    with training.kept_rows(gold, partitions=2) as kept:
        assert "event_id" not in kept.columns
        shared = [training.run_experiments(gold, [spec], kept=kept)[0]["metrics"] for spec in SMALL_SPECS]
        assert kept.storageLevel.useMemory
    assert shared == apart and not kept.storageLevel.useMemory

    laid_out, real = [], training.model_rows
    monkeypatch.setattr(training, "model_rows", lambda *a, **k: laid_out.append(1) or real(*a, **k))
    assert queries.runs_table(spark, sf).count() == 2
    assert len(laid_out) == 1


def test_gold_of_few_stations_is_stored_for_many_tasks(spark, sf, gold, monkeypatch):
    monkeypatch.setattr(queries, "_GOLD_FILE_ROWS", 100)
    table = queries._gold_table(spark, sf)
    files = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert sum(files) == gold.count() and max(files) <= 100 and len(files) > gold.select("airport").distinct().count()
    assert table.select("event_id").exceptAll(gold.select("event_id")).isEmpty()


def test_one_class_trains_on_all_rows_and_has_no_area(gold):
    calm = gold.withColumn("label", F.lit(0.0))
    (record,) = training.run_experiments(calm, SMALL_SPECS[:1], partitions=2)
    assert record["params"]["train_rows"] == record["params"]["test_rows"] == gold.count()
    assert record["metrics"] == {"accuracy": 1.0, "f1": 1.0, "auc": None}


def test_the_run_table_grows_and_is_ranked(spark, records, tmp_path):
    path = str(tmp_path / "runs")
    runs.log_runs(spark, records, path)
    runs.log_runs(spark, records[:1], path)
    stored = runs.read_runs(spark, path)
    assert stored.count() == 3
    ranked = [r["f1"] for r in runs.top_runs(runs.run_metrics(stored), 2).collect()]
    assert ranked == sorted((r["metrics"]["f1"] for r in [*records, records[0]]), reverse=True)[:2]
    assert stored.first()["params"]["spark_version"] == spark.version


def test_best_run_breaks_ties_by_accuracy_then_name(spark):
    rows = [("1", "b", 0.8, 0.9, 0.5), ("2", "a", 0.8, 0.9, 0.5), ("3", "c", 0.7, 0.9, 0.9), ("4", "d", 0.99, 0.8, 1.0)]
    frame = spark.createDataFrame(rows, "run_id string, run_name string, accuracy double, f1 double, auc double")
    assert runs.best_run(frame).first()["run_name"] == "a"
    as_records = [
        {"run_name": r[1], "metrics": {"accuracy": r[2], "f1": r[3], "auc": r[4]}} for r in rows
    ]
    specs = [{"run_name": n, "model_type": "x"} for n in "abcd"]
    assert training.best_spec(as_records, specs)["run_name"] == "a"


def test_a_saved_model_scores_the_same(spark, gold, tmp_path):
    for spec, kind in ((fixed.EXPERIMENTS[0], "random_forest"), (fixed.EXPERIMENTS[4], "logistic_regression")):
        path = str(tmp_path / kind)
        model = training.fit_final(gold, spec, partitions=2)
        training.save_model(model, path)
        training.save_model(model, path)
        loaded = scoring.load_model(path)
        before, after = scoring.scored(gold, model), scoring.scored(gold, loaded)
        assert before.exceptAll(after).isEmpty() and after.count() == gold.count()


def test_an_unknown_model_type_is_an_error():
    with pytest.raises(ValueError, match="tree"):
        training.estimator({"model_type": "tree"})


def test_rules_in_one_pass_equal_rules_one_by_one(silver):
    rules = {"w": F.col("wind_speed_kts") > 20, "p": F.col("precipitation_mm") > 5}
    together = {r["run_name"]: r for r in metrics.score_rules(silver, rules).collect()}
    for name, rule in rules.items():
        one = silver.withColumn("prediction", rule.cast("double"))
        alone = metrics.accuracy_f1(metrics.confusion(one)).first()
        assert together[name]["accuracy"] == alone["accuracy"] and together[name]["f1"] == alone["f1"]


def test_fits_at_the_same_time_change_nothing(gold):
    def measured(parallelism):
        done = training.run_experiments(gold, SMALL_SPECS, partitions=2, parallelism=parallelism)
        return [(r["run_name"], r["metrics"]) for r in done]

    assert measured(1) == measured(2)
    assert training.run_experiments(gold, []) == []


def test_tables_of_a_saved_model_score_like_the_model(spark, gold, tmp_path):
    for i, spec in enumerate((fixed.FINAL_FOREST, fixed.EXPERIMENTS[0], fixed.EXPERIMENTS[4])):
        path = str(tmp_path / f"m{i}")
        training.save_model(training.fit_final(gold, spec, partitions=2), path)
        mine = {r.event_id: r for r in model_tables.score_by_tables(gold, path).collect()}
        for r in scoring.scored(gold, scoring.load_model(path)).collect():
            assert mine[r.event_id].prediction == r.prediction
            assert abs(mine[r.event_id].score - r.score) < 1e-12
        if spec["model_type"] == "random_forest":
            nodes = model_tables.forest_nodes(spark, path)
            assert nodes.select("tree").distinct().count() == spec["numTrees"]
            assert nodes.where("feature IS NULL AND below IS NOT NULL").isEmpty()
        else:
            assert model_tables.regression_terms(spark, path).count() == len(fixed.FEATURE_COLUMNS) + 1


def test_a_forest_of_one_class_has_no_score(spark, gold, tmp_path):
    path = str(tmp_path / "one")
    calm = gold.withColumn("label", F.lit(0.0))
    training.save_model(training.fit_final(calm, fixed.EXPERIMENTS[0], partitions=2), path)
    rows = model_tables.score_by_tables(gold.limit(50), path).collect()
    library = {r.event_id: r for r in scoring.scored(gold, scoring.load_model(path)).collect()}
    assert {(r.prediction, r.score) for r in rows} == {(library[r.event_id].prediction, library[r.event_id].score) for r in rows}
