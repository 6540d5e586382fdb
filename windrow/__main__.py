"""``spark-submit`` entry: ``python -m windrow <step> ...``."""

from __future__ import annotations

import argparse

from windrow.plans import jobs
from windrow.session import build_session, use_utc
from windrow.sources import kafka as kafka_source


#: Rows of a stored object at most. How much a batch reads is not bound by it.
OBJECT_ROWS = 100_000


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="windrow")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, *options: str, **defaults) -> None:
        sub = steps.add_parser(name)
        for option in options:
            sub.add_argument(f"--{option}", required=option not in defaults, default=defaults.get(option))

    step("sample", "grid", "out", "start", "end")
    consume = {"table": None, "table-format": "parquet", "run-id": None, "object-rows": OBJECT_ROWS, "max-records": None, "idle-seconds": 60}
    step("consume", "servers", "raw", "checkpoint", *consume, **consume)
    ends = {"run-id": None, "max-records": None, "idle-seconds": 60}
    step("stream-bronze", "servers", "bronze", "checkpoint", "merge-every", *ends, **ends, **{"merge-every": 50})
    step("merge-bronze", "bronze")
    step("validate", "raw", "table", table=None)
    step("bronze", "raw", "lake")
    step("silver", "lake")
    step("gold", "lake")
    step("train", "lake", "model")
    step("experiments", "lake", "runs", "model", "refit", refit="fixed")
    step("publish", "lake")
    step("score", "lake", "model", "out", "checkpoint")
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = use_utc(build_session(f"windrow-{a.step}"))
    if a.step == "sample":
        jobs.sample(spark.read.parquet(a.grid), a.out, a.start, a.end).show(5, truncate=False)
    elif a.step == "consume":
        topic = kafka_source.read_topic(spark, a.servers)
        sink = jobs.consume(
            kafka_source.decode(topic),
            a.raw,
            a.checkpoint,
            a.run_id,
            a.table,
            int(a.max_records) if a.max_records else None,
            float(a.idle_seconds),
            int(a.object_rows),
            a.table_format,
        )
        print("run:", sink.run_id, "missed by the second target:", sink.missed(spark))
    elif a.step == "validate":
        summary, columns, second = jobs.validate(spark, a.raw, a.table)
        summary.show(truncate=False)
        columns.show(truncate=False)
        print("rows in the second target:", second)
    elif a.step == "stream-bronze":
        stream = kafka_source.decode(kafka_source.read_topic(spark, a.servers))
        most = int(a.max_records) if a.max_records else None
        stored = jobs.stream_bronze(
            stream, a.bronze, a.checkpoint, a.run_id, int(a.merge_every), most, float(a.idle_seconds)
        )
        print("events:", stored.count())
    elif a.step == "merge-bronze":
        print("dates merged:", jobs.merge_bronze(spark, a.bronze))
    elif a.step == "bronze":
        print(jobs.bronze(spark, a.raw, a.lake))
    elif a.step == "silver":
        print(jobs.silver(spark, a.lake))
    elif a.step == "gold":
        print(jobs.gold(spark, a.lake))
    elif a.step == "train":
        print(jobs.train(spark, a.lake, a.model))
    elif a.step == "experiments":
        jobs.experiments(spark, a.lake, a.runs, a.model, a.refit).show(truncate=False)
    elif a.step == "publish":
        print("version:", jobs.publish(spark, a.lake))
    elif a.step == "score":
        jobs.score(spark, a.lake, a.model, a.out, a.checkpoint)


if __name__ == "__main__":
    main()
