import random

import numpy as np
import pytest

from windrow.llm import line_dedup
from windrow.llm.cuckoo import Cuckoo
from windrow.session import work_path

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            h = holders[key(line)]
            keeper = max((d for d in h if d is not None), default=None)
            if not (len(key(line)) >= 20 and len(h) >= 3 and doc != keeper):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def cleaned(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=repr)


def documents(n, seed):
    rng = random.Random(seed)
    pool = [f"  Repeated line number {i:02d} é ÄB\t" for i in range(40)] + ["short", "", "nineteen characters", "twenty characters é!!"]
    return [(i, "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own line {i} {j} of this document" for j in range(rng.randint(0, 9)))) for i in range(n)]


def keys(n, seed=3):
    rng = np.random.default_rng(seed)
    return rng.integers(-(2**63), 2**63 - 1, n), rng.integers(-(2**63), 2**63 - 1, n)


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_filter_adds_removes_and_survives_storage(n):
    high, low = keys(n)
    made = Cuckoo.build(high, low)
    assert made.contains(high, low).all() and made.held() == n
    more = keys(n // 10, 5)
    if made.has_room(len(more[0])):
        assert made.add(*more)
        made.remove(*more)
    half = n // 2
    made.remove(high[:half], low[:half])
    made = Cuckoo.load(made.dump())
    assert made.contains(high[half:], low[half:]).all() and made.held() == n - half
    others = keys(20_000, 9)
    assert made.contains(*others).mean() < 0.001


def test_filter_of_equal_fingerprints():
    high, low = np.full(6, 1 << 40), np.full(6, 77)
    made = Cuckoo.build(high, low)
    made.remove(high[:4], low[:4])
    assert made.held() == 2 and made.contains(high[:1], low[:1]).all()
    made.remove(high[:2], low[:2])
    with pytest.raises(ValueError):
        made.remove(high[:1], low[:1])


def test_a_full_filter_says_so():
    made = Cuckoo.build(*keys(11))
    assert not made.has_room(6) and not made.add(*keys(40, 4))


def test_equals_brute_force(spark):
    rows = documents(300, 1)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert cleaned(line_dedup.dedup(df, "doc_id", "text", 4)) == brute(rows)


def test_batches_and_deletions_can_be_taken_back(spark):
    rows = documents(400, 2)
    frame = lambda some: spark.createDataFrame(some, "doc_id bigint, text string").repartition(3)
    store = line_dedup.LineStore(spark, work_path(spark, "lines"), shards=3)
    for at in range(0, 400, 150):
        store.insert(frame(rows[at : at + 150]), "doc_id", "text")
    assert cleaned(store.clean(frame(rows), "doc_id", "text")) == brute(rows)
    with pytest.raises(ValueError):
        store.insert(frame(rows[5:6]), "doc_id", "text")
    before = sorted(map(tuple, store.counts().collect()))
    # Keepers are among those that go: the largest ids have many of the lines.
    gone = rows[::7] + rows[380:]
    left = [r for r in rows if r not in gone]
    store.delete(frame(gone + [(9999, "never there")]), "doc_id")
    assert cleaned(store.clean(frame(left), "doc_id", "text")) == brute(left)
    fresh = line_dedup.LineStore(spark, work_path(spark, "lines"), shards=3)
    fresh.insert(frame(left), "doc_id", "text")
    assert sorted(map(tuple, store.counts().collect())) == sorted(map(tuple, fresh.counts().collect()))
    sizes = lambda s: {(r.shard, r.plane): Cuckoo.load(bytes(r.slots)).held() for r in s._filters(s.version()[0]).collect()}
    assert {k: v for k, v in sizes(store).items() if v} == {k: v for k, v in sizes(fresh).items() if v}
    store.compact()
    assert cleaned(store.clean(frame(left), "doc_id", "text")) == brute(left)
    store.insert(frame(gone), "doc_id", "text")
    assert sorted(map(tuple, store.counts().collect())) == before
    assert cleaned(store.clean(frame(rows), "doc_id", "text")) == brute(rows)


def test_a_failed_version_is_not_read(spark):
    rows = documents(60, 3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    store = line_dedup.LineStore(spark, work_path(spark, "lines"), shards=2)
    store.insert(df, "doc_id", "text")
    spark.range(3).selectExpr("id AS doc_id", "id AS high", "id AS low").write.parquet(f"{store.path}/refs/version=2")
    assert cleaned(store.clean(df, "doc_id", "text")) == brute(rows)
    store.delete(df.where("doc_id < 30"), "doc_id")
    assert cleaned(store.clean(df.where("doc_id >= 30"), "doc_id", "text")) == brute(rows[30:])


def test_shards_are_kept(spark):
    path = work_path(spark, "lines")
    line_dedup.LineStore(spark, path, shards=2).delete(spark.createDataFrame([(1,)], "doc_id bigint"), "doc_id")
    with pytest.raises(ValueError):
        line_dedup.LineStore(spark, path, shards=4).version()


def test_odd_rows_and_empty_table(spark, odd, none):
    got = cleaned(line_dedup.dedup(odd, "doc_id", "text", 4))
    assert got == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert line_dedup.dedup(none, "doc_id", "text", 4).count() == 0


def test_without_sent_filters(spark, monkeypatch):
    rows = documents(80, 5)
    monkeypatch.setattr(line_dedup, "SENT_BYTES", -1)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert cleaned(line_dedup.dedup(df, "doc_id", "text", 4)) == brute(rows)


def test_very_long_text(spark):
    long = "\n".join(f"line {i % 5000} of a very long text" for i in range(60_000))
    rows = [(1, long), (2, long), (3, long[:2_000_000]), (4, "x" * 3_000_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert cleaned(line_dedup.dedup(df, "doc_id", "text", 4)) == brute(rows)
