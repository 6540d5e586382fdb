import random
import re

from pyspark.sql import functions as F

from windrow.llm import graph, near_dups
from windrow.llm.near_dups import Similar

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    k = min(width, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, width, percent):
    """(n, least id of the component) per row, from all pairs."""
    sets = [shingles(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = find(i)
            least[r] = min(least.get(r, doc_id), doc_id)
    return sorted((str(d), len(s), str(least.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def grouped(spark, rows, width=3, percent=85):
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, n string")
    out = near_dups.group(df, "doc_id", "text", Similar(width, percent)).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out)


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_copies_chains_and_short_texts(spark):
    rng = random.Random(1)
    rows, doc_id = [], 0
    passage = [f"p{i}" for i in range(30)]
    for length in (1, 2, 3, 5, 20, 40, 55, 60, 66, 70, 90, 300):
        for _ in range(3):
            words = [f"w{rng.randrange(10**6)}" for _ in range(length)]
            for edits in (0, 0, 1, 1, 2, 4, length // 20):
                doc_id += 1
                rows.append((doc_id, " ".join(changed(rng, words, edits))))
            # A chain: each a little further from the first.
            for _ in range(6):
                words = changed(rng, words, 1 + length // 90)
                doc_id += 1
                rows.append((doc_id, "\n".join(words).upper()))
        for _ in range(10):
            doc_id += 1
            rows.append((doc_id, " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(length)])))
    rng.shuffle(rows)
    assert grouped(spark, rows) == brute(rows, 3, 85)


def test_a_large_group_around_the_threshold(spark):
    """Copies of one text, many pairs of which are just not linked: rounds of pivots find all."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(changed(rng, words, 2 + i % 5))) for i in range(250)]
    assert grouped(spark, rows) == brute(rows, 3, 85)
    assert grouped(spark, rows, 5, 80) == brute(rows, 5, 80)


def test_groups_without_their_origin_and_of_two_versions(spark):
    """Copies whose origin is not there, and two versions of it with copies of their own."""
    rng = random.Random(7)
    for width, percent in ((3, 85), (5, 80)):
        words = [f"w{i}" for i in range(150)]
        second = changed(rng, words, 6)
        rows = [(i, " ".join(changed(rng, words if i % 3 else second, 1 + i % 4))) for i in range(160)]
        # Parts of it, and it with more behind: neighbours of very different sizes.
        rows += [(200 + i, " ".join(words[: 100 + i * 4])) for i in range(12)]
        rows += [(300 + i, " ".join(words + [f"x{j}" for j in range(i * 6)])) for i in range(12)]
        rng.shuffle(rows)
        assert grouped(spark, rows, width, percent) == brute(rows, width, percent)


def test_few_pairs_of_a_large_group_are_looked_at(spark):
    """Near copies that are too far from each other: their differences tell it before any pair is formed."""
    rng, like = random.Random(8), Similar(5, 80)
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(changed(rng, words, 5))) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    whole = near_dups.sets(df, like.width, False).select(F.col("doc_id").alias("cid"), F.col("values").alias("whole"), "n").cache()
    groups = whole.select(F.lit(0).cast("long").alias("pivot"), "cid", "n", F.lit(1).alias("weight"))
    groups = groups.withColumn("pivot_n", F.lit(whole.where("cid = 0").first().n))
    roots = spark.createDataFrame([], "node long, root long")
    left = near_dups.open_groups(groups, roots)
    apart = near_dups.differences(left, whole.drop("n"), like)
    pairs = near_dups.difference_pairs(apart, like)
    sets = {i: shingles(t, 5) for i, t in docs[1:]}  # the pivot has been compared with all
    links = {(a, b) for a in sets for b in sets if a > b and 180 * len(sets[a] & sets[b]) >= 80 * (len(sets[a]) + len(sets[b]))}
    found = {(max(r), min(r)) for r in near_dups.linked_by_difference(pairs, apart, like).select("a", "b").collect()}
    assert found == links
    # All pairs would be 179,101.
    assert pairs.count() < 2000


def test_odd_rows_and_empty_table(spark, odd, none, stored):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert grouped(spark, rows) == brute(rows, 3, 85)
    assert near_dups.group(none, "doc_id", "text").collect() == []
    left = near_dups.one_of_each(stored, "doc_id", "text")
    assert left.columns == stored.columns
    ids = sorted(str(r.doc_id) for r in left.collect())
    # 4, 4, 5 and 6 are one text; 8 and 9 another; null and empty texts all stay.
    assert ids == sorted(map(str, [1, 2, 3, 4, None, None, 7, 8, 10, 11]))


def test_chances_and_sizes():
    like = Similar(3, 85)
    assert 36 <= like.common <= 41 and Similar().common < like.common


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (10, 9), (9, 8), (20, 21), (21, 20), (30, 30)] + [(100, i) for i in range(101, 160)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in graph.components(df).collect()}
    want = {**{i: 1 for i in range(1, 6)}, 8: 8, 9: 8, 10: 8, 20: 20, 21: 20, **{i: 100 for i in range(100, 160)}}
    assert got == want
    assert graph.components(df.limit(0)).collect() == []
