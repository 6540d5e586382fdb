import math

import numpy as np
from pyspark.sql import functions as F

from windrow.llm import nearest


def brute(rows, queries, k):
    out = {}
    usable = {i: v for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    for q in queries:
        if q in usable:
            scored = []
            for i, v in usable.items():
                if i != q and len(v) == len(usable[q]):
                    total = 0.0
                    for a, b in zip(np.float32(v).astype(float), np.float32(usable[q]).astype(float)):
                        total += a * b
                    scored.append((-total, i))
            if scored:
                out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_odd_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(8).astype(np.float32)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]  # equal scores: smaller ids first
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [math.nan] + [1.0] * 7), (204, [math.inf] + [1.0] * 7)]
    rows += [(205, [None] + [1.0] * 7), (None, rows[0][1]), (206, [1.0, 2.0]), (207, [2.0, 1.0]), (208, [3.0])]
    rows += rows[:5]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, v string")
    got = found(nearest.search(df, F.col("vec_id") % 2 == 0, "vec_id", "embedding", 7))
    queries = {i for i, _ in rows if i is not None and i % 2 == 0}
    assert got == brute(rows, queries, 7)
    assert got[206] == [(207, 4.0)] and 208 not in got and 200 not in got


def test_fewer_than_k_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert found(nearest.search(df, F.lit(True), "vec_id", "embedding", 20)) == {1: [(2, 0.5)], 2: [(1, 0.5)]}
    assert nearest.search(df.limit(0), F.lit(True), "vec_id", "embedding", 20).collect() == []


def test_recall_and_bounds(spark):
    """Clustered vectors over several groups: recall of at least 0.9, and bounds that hold."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 64))
    v = (centres[rng.integers(0, 20, 6000)] + 0.4 * rng.standard_normal((6000, 64))).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = found(nearest.search(df, F.col("vec_id") % 50 == 0, "vec_id", "embedding", 20))
    d = v.astype(float)
    hits = 0
    for q in range(0, 6000, 50):
        score = d @ d[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20]) & {i for i, _ in got[q]})
    assert hits / (20 * 120) >= 0.9
    codes = nearest.Codes(np.arange(6000), d, d.mean(0))
    estimate, error = codes.estimates(d[:100])
    true = d[:100] @ codes.vectors.T
    assert np.mean(np.abs(estimate - true) <= error) > 0.999
    # The bits tell something: most rows are out of reach of the 20th best.
    least = np.partition(estimate - error, -20, axis=1)[:, -20]
    assert np.mean(estimate + error >= least[:, None]) < 0.5
    # Copies beyond those that can be answers are left out.
    assert len(nearest.Codes(np.arange(50), np.ones((50, 4)), np.zeros(4), 21).ids) == 21


def test_lists_are_merged_without_comparing_all_pairs(spark):
    """Distinct structs are sought by pairs: among the first 2 k of two passes, and not at all in one."""
    lists = [[(-float(i), i) for i in range(g, 30, 3)] for g in range(3)]
    df = spark.createDataFrame([(1, x) for x in lists], "query_id long, found array<struct<down:double,vec_id:long>>")
    want = [(-float(i), i) for i in range(29, 22, -1)]
    once = df.groupBy("query_id").agg(nearest.merged(7).alias("found"))
    assert "array_distinct" not in str(once._jdf.queryExecution().analyzed())
    assert [tuple(x) for x in once.first().found] == want
    twice = df.union(once).groupBy("query_id").agg(nearest.merged(7, 2).alias("found"))
    assert "array_distinct(slice(" in str(twice._jdf.queryExecution().analyzed())
    assert [tuple(x) for x in twice.first().found] == want
