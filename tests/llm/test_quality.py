import re
from collections import Counter

from pyspark.sql import functions as F

from windrow.llm import quality


def base(text):
    t = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in t)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_measures(spark, odd, none):
    extra = ["a b c d e f g h " * 3, "x " * 30, "a b c d e f g h i a b c d e f g h", "é🙂\n\né🙂\n x\n x\n\t\n\t\n", "#" * 9]
    cases = [r.text for r in odd.collect()] + extra
    df = spark.createDataFrame(list(enumerate(cases)), "n_words int, text string")
    got = quality.measures(df.withColumnRenamed("n_words", "id"), ["id"], "text").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {r.id: tuple(r[n] for n in names) for r in got} == {i: base(t) for i, t in enumerate(cases)}
    out = quality.judge(odd, "doc_id", "text", ["lang", "source"])
    assert out.count() == odd.count()
    assert not [r for r in out.collect() if r.kept and r.base_failed]
    assert quality.judge(none, "doc_id", "text", ["lang", "source"]).collect() == []


def test_buckets_merge_and_are_near(spark):
    values = spark.range(0, 200_000, 37).select("id", quality.bucket(F.col("id")).alias("b"))
    assert values.where("b > id OR 16 * (id - b) > id").count() == 0
    rows = [("a", "x", "symbols", 0, 3), ("a", "y", "symbols", 0, 4), ("a", "y", "symbols", 16, 1)]
    sketch = spark.createDataFrame(rows, "g string, h string, measure string, bucket long, n long")
    merged = {(r.g, r.bucket): r.n for r in quality.merge(sketch, ["g"]).collect()}
    assert merged == {("a", 0): 7, ("a", 16): 1}


def test_thresholds_follow_the_source(spark):
    """What is usual in one source is rejected in another; a small source leans on its language."""
    clean = "one two three four five six seven eight nine ten el twelve th fo fi si se ei ni tw a{} b{}"
    marked = clean.replace(" ", " #### ", 6)
    rows = [(i, clean.format(i, i), "en", "plain") for i in range(300)]
    rows += [(1000 + i, marked.format(i, i), "en", "code") for i in range(150)]
    rows += [(2000, marked.format(1, 2), "en", "plain"), (2001, marked.format(1, 2), "en", "tiny")]
    rows += [(2002, clean.format(1, 2), None, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge(df, "doc_id", "text", ["lang", "source"]).collect()}
    assert all(kept[i] for i in range(300)) and all(kept[1000 + i] for i in range(150))
    assert not kept[2000] and kept[2002]


def test_clean_documents_stay(spark, sf):
    out = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text", ["lang", "source"])
    marks = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    clean = marks.where("quality = 1 AND NOT base_failed")
    assert clean.where("NOT kept").count() <= 0.01 * clean.count()


def test_limits_differ_among_sources_and_change_gradually(spark):
    """Two sources of a language with lines repeated more and less; a third of growing size."""
    def text(i, again):
        own = [f"one{i * 40 + j} two{i * 40 + j} three{i * 40 + j} four{i * 40 + j}" for j in range(30)]
        return "\n".join(x for j, o in enumerate(own) for x in ((o, "roundly7 aboutly7 againly7") if j < again else (o,)))

    rows = [(i, text(i, i % 3), "en", "calm") for i in range(400)] + [(1000 + i, text(1000 + i, 10 + i % 8), "en", "loops") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    measured = quality.measures(df, ["doc_id", "lang", "source"], "text")
    got = {r.source: r for r in quality.limits(quality.sketches(measured, ["lang", "source"]), ["lang", "source"]).collect()}
    assert got["loops"].most_dup_lines > got["calm"].most_dup_lines + 200_000
    verdicts = []
    for size in (1, 30, 90, 99, 100, 101, 110, 300, 3000):
        more = spark.createDataFrame([(5000 + i, text(5000 + i, 0), "en", "new") for i in range(size)], df.schema)
        probe = spark.createDataFrame([(9999, text(1, 20), "en", "new")], df.schema)
        out = quality.judge(df.union(more).union(probe), "doc_id", "text", ["lang", "source"])
        verdicts.append(out.where("doc_id = 9999").first().kept)
    # Its language's limits while it is small, its own when it is large, and no change at a hundred documents.
    assert verdicts[0] and not verdicts[-1] and verdicts == sorted(verdicts, reverse=True) and len(set(verdicts[3:6])) == 1
