import pytest
from pyspark.sql import functions as F

from plans import initial
from windrow import fixed, schemas
from windrow.operators import labels, split
from windrow.operators.dedup import first_delivery
from windrow.plans import layers


def bronze_rows(spark, rows):
    """rows of (id, airport, second, wind, precipitation, cape)"""
    measures = "wind_speed_kts double, precipitation_mm double, cape_j_kg double"
    df = spark.createDataFrame(rows, f"event_id string, airport string, s long, {measures}")
    made = {
        "timestamp_utc": F.timestamp_seconds("s"),
        "event_date": F.to_date(F.timestamp_seconds("s")),
        **{c: F.lit(1.0) for c in ("latitude", "longitude", "temperature_c", "surface_pressure_pa")},
        "_kafka_topic": F.lit(fixed.TOPIC),
        "_kafka_partition": F.lit(0),
        "_kafka_offset": F.lit(0).cast("long"),
        "_ingested_at_utc": F.lit(""),
        "_source_object": F.lit(""),
    }
    return df.withColumns(made).select(*fixed.BRONZE_COLUMNS)


def test_the_first_delivery_stays_whatever_the_partitioning(spark, raw):
    expected = None
    for n in (1, 4, 8):
        rows = sorted(
            map(tuple, layers.build_bronze(raw.repartition(n)).select("event_id", "_kafka_partition", "_kafka_offset").collect())
        )
        expected = expected or rows
        assert rows == expected
    lowest = raw.where("event_id is not null").groupBy("event_id").agg(
        F.min(F.struct("_kafka_partition", "_kafka_offset")).alias("m")
    )
    assert expected == sorted((r["event_id"], *r["m"]) for r in lowest.collect())


def test_copies_are_cut_before_the_shuffle(raw):
    text = initial(layers.build_bronze(raw))
    assert text.count("Exchange ") == 1
    assert "Partial" in text.split("Exchange ")[1]
    assert "Python" not in text


def test_a_third_of_all_rows_with_one_id(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.lit(0).alias("_kafka_partition"),
        F.col("id").alias("_kafka_offset"),
        F.lit("x").alias("_source_object"),
    )
    kept = first_delivery(rows)
    assert kept.count() == 20_001
    assert kept.where("event_id = 'hot'").first()["_kafka_offset"] == 0


def test_rule_on_nan_null_and_limits(spark):
    nan = float("nan")
    rows = [
        ("a", "X", 0, 25.0, 10.0, 0.0),
        ("b", "X", 1, 25.1, 0.0, 0.0),
        ("c", "X", 2, 0.0, 10.1, 0.0),
        ("d", "X", 3, nan, 0.0, 0.0),
        ("e", "X", 4, None, 0.0, 0.0),
        ("f", "X", 5, None, 11.0, 0.0),
    ]
    ruled = labels.with_rule(bronze_rows(spark, rows))
    got = {r["event_id"]: r["weather_rule_label"] for r in ruled.collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 1.0, "d": 1.0, "e": 0.0, "f": 1.0}


def test_one_class_of_either_kind_uses_the_quantile(spark):
    for wind in (1.0, 100.0):
        rows = [(str(i), "X", i, wind + i / 100, 0.0, 0.0) for i in range(100)]
        silver = layers.build_silver(bronze_rows(spark, rows), relative_error=0)
        counts = {tuple(r) for r in silver.groupBy("label", "label_source").count().collect()}
        # The 75th value and the 25 above it are at or over the threshold.
        assert counts == {(1.0, fixed.FALLBACK_SOURCE, 26), (0.0, fixed.FALLBACK_SOURCE, 74)}


def test_two_classes_use_the_rule(silver):
    assert {r[0] for r in silver.select("label_source").distinct().collect()} == {fixed.RULE_SOURCE}
    assert silver.columns == schemas.SILVER.names


def test_the_class_check_pushes_its_filter_to_the_scan(bronze):
    ruled = labels.with_rule(bronze)
    text = initial(ruled.where(F.col("weather_rule_label") != 0.0).select("weather_rule_label"))
    read = text.split("ReadSchema:")[1]
    assert "cape_j_kg" not in read and "airport" not in read


def test_a_dropped_row_has_counted_in_its_neighbours(spark):
    rows = [("a", "X", 0, 30.0, 0.0, 6.0), ("b", "X", 3600, 1.0, 0.0, None), ("c", "X", 7200, 2.0, 0.0, 2.0)]
    gold = {r["event_id"]: r for r in layers.build_gold(layers.build_silver(bronze_rows(spark, rows))).collect()}
    assert set(gold) == {"a", "c"}
    assert gold["c"]["wind_speed_max_3h"] == 30.0 and gold["c"]["wind_speed_avg_3h"] == 11.0
    assert gold["c"]["cape_avg_3h"] == 4.0


def test_an_airport_with_one_row_is_kept(spark):
    rows = [("a", "X", 0, 30.0, 0.0, 6.0), ("b", "Y", 0, 1.0, 2.0, 3.0)]
    gold = {r["event_id"]: r for r in layers.build_gold(layers.build_silver(bronze_rows(spark, rows))).collect()}
    assert gold["b"]["precipitation_sum_3h"] == 2.0 and gold["b"]["cape_avg_3h"] == 3.0


def test_gold_has_the_fixed_columns_and_types(gold):
    assert gold.columns == list(fixed.GOLD_COLUMNS)
    assert [f.dataType for f in gold.schema] == [f.dataType for f in schemas.GOLD]


def test_gold_shuffles_once(silver):
    text = initial(layers.build_gold(silver))
    assert text.count("Exchange ") == 1 and text.count("Window ") == 1
    assert "_kafka" not in text.split("ReadSchema:")[1]


def test_peek_takes_the_latest(bronze):
    got = [r["timestamp_utc"] for r in layers.latest(bronze, 3).collect()]
    assert got == sorted((r[0] for r in bronze.select("timestamp_utc").collect()), reverse=True)[:3]
    assert "TakeOrderedAndProject" in initial(layers.latest(bronze, 3))


def test_average_of_literal_rows(spark):
    rows = spark.createDataFrame([("JFK", 25.5), ("LAX", 18.2), ("ORD", 30.1)], ["airport", "wind_speed_kts"])
    assert rows.agg(F.avg("wind_speed_kts")).first()[0] == pytest.approx(24.6)


def test_the_split_does_not_depend_on_the_partitioning(silver):
    sides = []
    for n in (1, 4, 8):
        train, test = split.split_rows(silver.repartition(n))
        sides.append((sorted(r[0] for r in train.select("event_id").collect()), test.count()))
    assert sides[0] == sides[1] == sides[2]
    share = len(sides[0][0]) / (len(sides[0][0]) + sides[0][1])
    assert 0.75 < share < 0.85


def test_a_one_class_split_uses_all_rows(silver):
    calm = silver.withColumn("label", F.lit(1.0))
    train, test = split.split_or_all(calm)
    assert train.count() == test.count() == silver.count()
    train, test = split.split_or_all(silver)
    assert train.count() + test.count() == silver.count()
