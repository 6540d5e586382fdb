import random

import pytest
from pyspark.sql import functions as F

from plans import initial
from windrow.operators import rolling
from windrow.operators.rolling import rolling_features

FEATURES = (("hi", "max", "v"), ("mean", "avg", "v"), ("total", "sum", "v"))
SCHEMA = "k string, t timestamp, id string, v double"


def rows_with_a_hot_key(spark, n=600, seed=1, seconds=4000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 else f"k{rnd.randrange(6)}"
        second = rnd.randrange(seconds) if rnd.random() < 0.8 else 7
        value = None if rnd.random() < 0.05 else float(rnd.randrange(100))
        rows.append((key, second, f"{i:05d}", value))
    rows.append(("single", 3, "99999", 1.0))
    df = spark.createDataFrame(rows, "k string, s long, id string, v double")
    return df.select("k", F.timestamp_seconds("s").alias("t"), "id", "v")


def rolled(df, **options):
    return rolling_features(df, key="k", time="t", tie=("id",), features=FEATURES, **options)


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def brute_force(rows, width=3):
    out, groups = {}, {}
    for r in rows:
        groups.setdefault(r["k"], []).append(r)
    for group in groups.values():
        group.sort(key=lambda r: (r["t"], r["id"]))
        for i, r in enumerate(group):
            seen = [x["v"] for x in group[max(0, i - width + 1) : i + 1] if x["v"] is not None]
            out[r["id"]] = (max(seen), sum(seen) / len(seen), sum(seen)) if seen else (None,) * 3
    return out


def as_tuples(df):
    return {k: (r["hi"], r["mean"], r["total"]) for k, r in by_id(df).items()}


@pytest.mark.parametrize("rows", [2, 3, 5])
@pytest.mark.parametrize("slices", [1, 7, 60, 900])
def test_slices_change_nothing(spark, rows, slices):
    df = rows_with_a_hot_key(spark).cache()
    expected = brute_force(df.collect(), rows)
    assert as_tuples(rolled(df, rows=rows)) == expected
    assert as_tuples(rolled(df, rows=rows, slices=slices)) == expected


def test_a_hot_key_and_a_hot_second_are_cut(spark):
    for seconds in (100_000, 1):
        df = rows_with_a_hot_key(spark, seconds=seconds).cache()
        result = rolled(df, max_key_rows=150)
        assert as_tuples(result) == brute_force(df.collect())
        assert "_slice" in initial(result)
        assert "_slice" not in initial(rolled(df, max_key_rows=1000))


def test_the_input_is_read_once_for_a_sample_and_once_for_the_rows(spark):
    df, read = rows_with_a_hot_key(spark), spark.sparkContext.accumulator(0)
    count = df.count()

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    once = df.mapInArrow(counted, df.schema)
    assert rolled(once, slices=9).count() == count
    assert read.value == 2 * count
    assert rolled(once, max_key_rows=100).count() == count
    # The key sizes are one more, over the key alone.
    assert read.value == 5 * count


def test_only_the_ends_of_slices_are_given_to_the_next(spark):
    df = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").alias("_order_s"), F.floor(F.col("id") / 100).alias("_slice"))
    given = rolling.rows_in_front(df, "k", [], 4).orderBy("_slice", "_order_s").collect()
    assert [(r["_slice"], r["_order_s"]) for r in given] == [(s, s * 100 - 3 + i) for s in range(1, 10) for i in range(3)]
    # Slices of one row each: the rows in front come from several.
    thin = spark.range(5).select(F.lit("a").alias("k"), F.col("id").alias("_order_s"), (F.col("id") * 7).alias("_slice"))
    given = {(r["_slice"], r["_order_s"]) for r in rolling.rows_in_front(thin, "k", [], 3).collect()}
    assert given == {(7, 0), (14, 0), (14, 1), (21, 1), (21, 2), (28, 2), (28, 3)}


def test_rows_without_a_time_come_first_either_way(spark):
    rows = [("a", None, f"n{i}", float(i)) for i in range(3)] + [("a", i - 5, f"t{i}", 1.0 * i) for i in range(9)]
    df = spark.createDataFrame(rows, "k string, s long, id string, v double").select(
        "k", F.timestamp_seconds("s").alias("t"), "id", "v"
    )
    plain = as_tuples(rolled(df))
    assert as_tuples(rolled(df, slices=5)) == plain
    assert as_tuples(rolled(df, max_key_rows=4)) == plain


def test_plain_windows_share_one_shuffle_and_one_sort(bronze):
    text = initial(rolling_features(bronze))
    assert text.count("Exchange ") == 1
    assert text.count("Sort ") == 1
    assert text.count("Window ") == 1
    assert "Python" not in text


def test_a_filter_on_the_key_reaches_the_scan(bronze):
    df = rolling_features(bronze).where(F.col("airport") == "JFK")
    assert "EqualTo(airport,JFK)" in initial(df)


def test_nan_and_null_in_a_frame(spark):
    rows = [("a", i, str(i), v) for i, v in enumerate([1.0, float("nan"), None, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "k string, s long, id string, v double").select(
        "k", F.timestamp_seconds("s").alias("t"), "id", "v"
    )
    got = by_id(rolled(df))
    assert str(got["3"]["total"]) == "nan"
    assert got["4"]["total"] == 5.0
    assert got["5"]["mean"] == 3.0


def test_frames_of_one_row_are_refused(bronze):
    with pytest.raises(ValueError):
        rolling_features(bronze, rows=1)
    with pytest.raises(ValueError):
        rolling_features(bronze, slices=0)
