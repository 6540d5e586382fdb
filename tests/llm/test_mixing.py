import re
from collections import defaultdict

from windrow.llm import mixing


def by_source(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.source].append(r)
    return out


def test_targets_are_reshared(spark):
    # A small source stops at three times its size; what it leaves goes to the others by weight.
    rows = [("a", 100), ("b", 10), ("c", 1000), (None, 500)]
    got = {r.source: r for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert [got[s].weight for s in ("a", "b", "c", None)] == [1, 2, 3, 1]
    # Shares of 1610 by 1, 2, 3, 1: 230, 460, 690, 230; b stops at 30. Then 316, 948, 316; a stops at 300.
    assert [got[s].target for s in ("a", "b", "c", None)] == [300.0, 30.0, 960.0, 320.0]
    rows = [("a", 10), ("b", 1), ("c", 0)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert got == {"a": 8.0, "b": 3.0, "c": 0.0}


def test_near_targets_and_reruns(spark):
    rows = [(i, f"s{i % 4}", "w " * (5 + i * 7919 % 90)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, src string, body string").withColumnsRenamed({"id": "rank"})
    got = mixing.mix(df, "rank", "src", "body").collect()
    assert len(got) == len(rows)
    for source, mine in by_source(got).items():
        target, size = mine[0].target, mine[0].source_size
        assert size == sum(r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - target) <= max(r.size for r in mine)
        assert all(r.copies in (int(target // size), int(target // size) + 1) and r.copies <= 3 for r in mine)
    again = mixing.mix(df.repartition(5), "rank", "src", "body").collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in got}


def test_copies_are_due_to_everyone(spark):
    """Over many seeds each document's copies average its source's share."""
    rows = [(i, "a" if i < 6 else "b", "w " * (3 + i)) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id int, source string, text string")
    seen, due, n = defaultdict(int), {}, 12
    for seed in range(n):
        for r in mixing.mix(df, "doc_id", "source", "text", seed).collect():
            seen[r.doc_id] += r.copies
            due[r.doc_id] = r.target / r.source_size
    assert abs(sum(seen.values()) / n - sum(due.values())) < 1.5
    assert all(abs(seen[i] / n - due[i]) < 0.6 for i in due)


def test_odd_rows_and_empty_table(spark, odd, none, stored):
    got = mixing.mix(odd, "doc_id", "source", "text").collect()
    texts = odd.collect()
    assert len(got) == len(texts)
    assert sorted(r.size for r in got) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in texts)
    assert all(r.taken <= 3 * r.size and r.source_size >= r.size for r in got)
    assert mixing.mix(none, "doc_id", "source", "text").collect() == []
    out = mixing.repeated(stored, "doc_id", "source", "text")
    assert out.columns == stored.columns
    taken = mixing.mix(stored, "doc_id", "source", "text").groupBy().sum("copies").first()[0]
    assert abs(out.count() - taken) <= 8


def test_no_python_on_the_path(spark, sf):
    from windrow.llm import queries

    plan = queries.op2_mix_sources(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "InArrow", "Cartesian") if w in plan]
