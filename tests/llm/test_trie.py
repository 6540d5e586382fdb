import hashlib
import random
import zlib

import pytest

from windrow.llm import queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
DIGEST = hashlib.sha256


def brute(convs):
    """``convs``: id to list of (role, text)."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    saved = {k: (len(m) - 1) * (len(k[-1][1].encode()) if k else 0) for k, m in nodes.items()}
    kids, leaves, sums = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    for k in nodes:
        for a in range(len(k) + 1):
            leaves[k[:a]] += not kids[k]
            sums[k[:a]] += saved[k]
    out = []
    for k, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k))))
        parent = min(nodes[k[:-1]]) if k else None
        out.append((min(m), len(k), parent, len(m), kids[k], leaves[k], sums[k], DIGEST(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def rows_of(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()), key=repr)


def plain(spark, rows):
    turns = trie.numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(3), "conv_id", "turn", "role", "text")
    return trie.prefix_trie(turns)


def numbered(convs):
    return [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]


@pytest.mark.parametrize("longest", [3, 8, 9, 70])
def test_equals_brute_force(spark, longest):
    rng = random.Random(longest)
    stem = [("user" if i % 2 else "assistant", f"turn é {i}") for i in range(longest)]
    convs = {}
    for c in range(60):
        keep = rng.randint(0, longest)
        convs[c] = stem[:keep] + [("user", f"own {rng.randint(0, 2)}") for _ in range(rng.randint(0 if keep else 1, min(4, longest)))]
    got = plain(spark, numbered(convs)).withColumnRenamed("saved", "saved_tokens")
    assert rows_of(got) == brute(convs)


def test_query_rebuilds(spark, sf, tmp_path):
    rng = random.Random(4)
    convs = {}
    for c in [*range(0, 45), 100, 103, 999_999]:
        if c % 7 != 5:
            convs[c] = [(rng.choice(["user", "assistant", ""]), rng.choice(["a", "bé", "", "long text " * 5])) for _ in range(rng.randint(1, 20))]
    rows = numbered(convs)
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(tmp_path / "conversations.parquet"))
    assert rows_of(queries.op11_prefix_trie(spark, str(tmp_path))) == brute(rebuilt(convs))


def test_one_node_of_very_many_members(spark, monkeypatch):
    monkeypatch.setattr(trie, "STRETCH", 7)
    convs = {c: [("user", "hello")] for c in range(300)} | {500: [("user", "hello"), ("assistant", "x")]}
    assert rows_of(plain(spark, numbered(convs)).withColumnRenamed("saved", "saved_tokens")) == brute(convs)


def test_odd_rows_and_empty_table(spark):
    rows = [
        (1, None, "user", "first"),
        (1, 5, None, None),
        (1, 5, None, None),
        (2, None, "user", "first"),
        (2, 7, "", ""),
        (3, 1, "us", "er"),
        (4, 1, "u", "ser"),
        (5, 1, "user", "x" * 1_000_000),
        (None, 1, "user", "no conversation"),
    ]
    convs = {1: [("user", "first"), ("", ""), ("", "")], 2: [("user", "first"), ("", "")], 3: [("us", "er")], 4: [("u", "ser")], 5: [("user", "x" * 1_000_000)]}
    got = plain(spark, rows).withColumnRenamed("saved", "saved_tokens")
    assert rows_of(got) == brute(convs)
    assert plain(spark, []).count() == 0


def test_turnless_conversations_end_at_the_root(spark):
    turns = spark.createDataFrame([(1, 1, b"a" * 16, 3), (2, 0, None, 0), (3, 0, None, 0)], "conv bigint, at bigint, id binary, bytes bigint")
    root = trie.prefix_trie(turns).where("depth = 0").first()
    assert (root.conv_id, root.n_convs, root.n_children, root.n_leaves) == (1, 3, 1, 1)
    assert root.ends_sha256 == DIGEST(b"2,3").hexdigest()
    bare = trie.prefix_trie(turns.where("id IS NULL")).collect()
    assert [(r.depth, r.n_convs, r.n_leaves) for r in bare] == [(0, 2, 1)]


def test_texts_come_back(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hello"), (1, 1, None, "there"), (2, 0, "user", "hello")], SCHEMA)
    nodes = trie.prefix_trie(trie.numbered_turns(rows, "conv_id", "turn", "role", "text"))
    got = {(r.depth, r.last_role, r.last_text) for r in trie.with_text(nodes, rows, "role", "text").collect()}
    assert got == {(0, None, None), (1, "user", "hello"), (2, "", "there")}
