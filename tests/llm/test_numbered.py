"""Row numbers hold when files are split in another way, as after the loss of an executor."""

from contextlib import contextmanager

from conftest import SCHEMA, passage, row
from windrow.llm import common, mixing, near_dups


@contextmanager
def split(spark, parts):
    names = {"spark.sql.files.minPartitionNum": parts, "spark.sql.files.openCostInBytes": "64m" if parts > 1 else "0"}
    for name, value in names.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


def test_numbers_and_results_hold(spark, tmp_path):
    rows = [row(i, passage(40, 100 * (i // 2))) for i in range(40)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(8, "doc_id").write.parquet(path)
    stored = spark.read.parquet(path)
    seen = []
    for parts in (8, 1):
        with split(spark, parts):
            seen.append(spark.read.parquet(path).rdd.getNumPartitions())
    assert seen[0] != seen[1]

    with split(spark, 8):
        numbered = common.numbered(stored)
        first = {r._row: r._doc.doc_id for r in numbered.collect()}
        left = near_dups.one_of_each(stored, "doc_id", "text")
        mixed = mixing.repeated(stored, "doc_id", "source", "text")
        kept = {r.doc_id for r in near_dups.group(stored, "doc_id", "text").collect() if r.kept}
        taken = {r.doc_id: r.copies for r in mixing.mix(stored, "doc_id", "source", "text").collect() if r.copies}
        expected = sorted(r.doc_id for r in mixed.collect())
    with split(spark, 1):
        assert {r._row: r._doc.doc_id for r in numbered.select("*").collect()} == first
        assert {r.doc_id for r in left.collect()} == kept
        assert sorted(r.doc_id for r in mixed.collect()) == expected and set(expected) <= set(range(40)) and taken
