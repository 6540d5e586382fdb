import numpy as np
import pytest

from windrow.llm import toxicity
from windrow.llm.toxicity import Grammar


@pytest.fixture(scope="module")
def grammar():
    return Grammar({"idiot$": 4.0, "lowei": 3.0})


def total(grammar, text):
    return round(sum(grammar.clauses(text)[0]), 6)


def test_context_weighs_a_hit(grammar):
    plain = total(grammar, "such an Idiot here")
    assert plain == 4.0
    assert total(grammar, "you are an idiot") == 6.0
    assert total(grammar, "he is not an idiot") == 3.0  # a target and a negation
    assert total(grammar, "somebody said idiot") == 2.0
    assert total(grammar, "idiots") == 0.0 and total(grammar, "die loweischaft") == 3.0
    # Context ends with its clause and its reach.
    assert total(grammar, "you. idiot") == 4.0
    assert total(grammar, "you a b c d idiot") == 4.0
    assert total(grammar, "i will kill you") == 2.0
    assert grammar.clauses("idiot. fine! idiot; you idiot")[0] == [4.0, 4.0, 6.0]
    assert grammar.clauses("")[0] == [] and grammar.clauses("one two.\nthree")[1] == 3


def test_patterns_read_both_sides(grammar):
    # A threat is aimed at somebody; its word alone is none.
    assert total(grammar, "kill") == 0.0 and total(grammar, "they kill the process") == 0.0
    assert total(grammar, "kill you") == 2.0 and total(grammar, "i will never kill you") == 1.0
    assert total(grammar, "kill. you") == 0.0 and total(grammar, "kill a b c d you") == 0.0
    assert total(grammar, "ich werde dich töten") == 2.0 and total(grammar, "je vais te tuer") == 2.0
    # Reported speech may follow, and counts once.
    assert total(grammar, "you are an idiot, he said") == 3.0
    assert total(grammar, "he said you are an idiot, she said") == 3.0
    assert total(grammar, "i will kill you, he wrote") == 1.0
    assert total(grammar, "you are an idiot. he said") == 6.0


def test_threats_are_learned(spark):
    rows = [(f"one i will smash {w} now. n{i}", 1) for i, w in enumerate(["you", "them", "your"] * 5)]
    rows += [(f"one i will smash the record now. you n{i}", 0) for i in range(40)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert lexicon["smash>"] >= toxicity.LEAST_ODDS and "smash$" not in lexicon
    assert total(Grammar(lexicon), "smash the record") == 0.0 < total(Grammar(lexicon), "smash all of them")


def test_composition_is_the_product():
    go, worth = toxicity.compose(toxicity.CONTEXTS)
    assert len(go) == 4 * 9 * 5 and sorted(set(worth)) == [0.25, 0.375, 0.5, 0.75, 1.0, 1.5]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model, "doc_id", "text")
    assert out.where("score < 0 OR score > 1 OR (score >= 0.5) <> (predicted = 1)").count() == 0
    marked = out.where("held_out").join(labels, "doc_id").collect()
    clean = [r for r in marked if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
    assert sum(r.predicted == r.toxic for r in marked) >= 0.9 * len(marked)
    kept = toxicity.without_toxic(docs, model, "text")
    assert kept.columns == docs.columns and kept.count() == out.where("predicted = 0").count()


def test_labels_are_inputs_of_training_only(spark):
    """Changing the labels of held-out rows changes nothing."""
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    a = toxicity.fit(docs, labels)
    b = toxicity.fit(docs, labels.where(~toxicity.held_out("doc_id")))
    assert a.lexicon == b.lexicon and (a.weights == b.weights).all()


def test_odd_rows_and_no_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (7, 0)], "doc_id long, toxic int")
    for marks in (labels, labels.limit(0)):
        model = toxicity.fit(odd, marks)
        out = toxicity.score(odd, model, "doc_id", "text").collect()
        assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
        assert all(r.held_out is False for r in out if r.doc_id is None)
        same = {r.score for r in out if r.doc_id in (1, 2, 3)}
        assert len(same) == 1
        assert toxicity.score(none, model, "doc_id", "text").collect() == []


def test_the_regression_settles_on_classes_that_hardly_overlap():
    """Plain Newton steps run away here and end with the classes the wrong way round."""
    rng = np.random.default_rng(6)
    for n in (200, 5000, 40_000):
        y = (rng.random(n) < 0.1).astype(float)
        hit = y * (3 + rng.random(n)) + (1 - y) * 0.01 * rng.random(n) * (rng.random(n) < 0.02)
        x = np.column_stack([hit, hit * 20, hit > 0, rng.standard_normal(n)]).astype(float)
        x = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(n)])
        w = toxicity._logistic(x, y)
        assert np.abs(w).max() < 50 and ((x @ w > 0) == y).mean() > 0.999
