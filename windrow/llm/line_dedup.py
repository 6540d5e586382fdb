"""Line dedup that can be taken back: cuckoo filters in shards, backed by exact reference counts.

A store, a folder, holds for the documents put into it which line keys each has (``refs``), how
many documents have a key and which of them has the largest id (``counts``), and for every shard of
the keys two filters: of all keys held, and of those frequent enough to be dropped. Every insertion
or deletion of documents is a version: it writes the rows that it changes, and counts once its
commit is written, so a job that fails leaves nothing that is read.

An insertion asks the filters which of its keys may be held already; only those look for their
counts. ``clean`` thins the references by the filters of frequent keys where they stand, and
exact counts decide on what is left. A deletion takes its references back, finds the next keeper
of a key whose keeper is gone, and removes from the filters what is no longer held. The store is
then as if the documents had never been inserted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import common
from windrow.llm.cuckoo import Cuckoo
from windrow.session import materialise, work_path

#: Fixed by the task: code points that a key has at least, and documents that make it frequent.
LEAST_LENGTH, LEAST_DOCS = 20, 3

#: Bytes of all filters of frequent keys together, up to which tasks get them all.
SENT_BYTES = 32 << 20

HELD, FREQUENT = "held", "frequent"

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_FILTERS = "shard int, plane string, slots binary"


def line_keys(text: bytes) -> list[bytes | None]:
    """For each line the 16-byte hash of its key, None where the key is too short.

    A key is the line without ASCII white space at both ends, A to Z as small letters.
    """
    out = []
    for line in text.translate(_LOWER).split(b"\n"):
        key = line.strip(b" \t\n\v\f\r")
        long = len(key) >= LEAST_LENGTH and (
            len(key) >= 4 * LEAST_LENGTH or len(key.decode("utf-8", "replace")) >= LEAST_LENGTH
        )
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), ">i8").reshape(-1, 2).astype(np.int64)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _refs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found = [list(dict.fromkeys(k for k in line_keys(t) if k)) for t in _texts(part.column(1))]
            high, low = _halves([k for keys in found for k in keys])
            row = pa.array(np.repeat(np.arange(len(found)), [len(keys) for keys in found]))
            yield pa.RecordBatch.from_arrays([part.column(0).take(row), pa.array(high), pa.array(low)], ["doc_id", "high", "low"])


def references(docs: DataFrame) -> DataFrame:
    """(doc_id, high, low): the keys of each document, once; rows of one id are one document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.in_small_batches(docs.select("doc_id", "text")).mapInArrow(_refs, f"doc_id {kind}, high bigint, low bigint").distinct()


def _shard(shards: int):
    return F.pmod("high", F.lit(shards)).cast("int")


def _lookup(key: tuple, keys: pa.Table, filters: pa.Table) -> pa.Table:
    """``keys`` of a shard, with whether they may be held."""
    high, low = (keys.column(c).to_numpy() for c in ("high", "low"))
    held = np.zeros(len(high), bool)
    for slots in filters.column("slots").to_pylist():
        held |= Cuckoo.load(slots).contains(high, low)
    return keys.append_column("held", pa.array(held))


def _update(key: tuple, filters: pa.Table, changes: pa.Table) -> pa.Table:
    """The filter of one shard and plane after the changes; null slots where it must be built from the counts."""
    old = filters.column("slots").to_pylist()
    high, low = (changes.column(c).to_numpy() for c in ("high", "low"))
    added = changes.column("added").to_numpy().astype(bool)
    if not old:
        new = Cuckoo.build(high[added], low[added]).dump()
    else:
        grown, new = Cuckoo.load(old[0]), None
        grown.remove(high[~added], low[~added])
        if grown.has_room(int(added.sum())) and grown.add(high[added], low[added]):
            new = grown.dump()
    return _filter_row(key, new)


def _filter_row(key, slots: bytes | None) -> pa.Table:
    shard, plane = (k.as_py() for k in key)
    return pa.table(
        {"shard": pa.array([shard], pa.int32()), "plane": pa.array([plane]), "slots": pa.array([slots], pa.binary())}
    )


def _build(key: tuple, keys: pa.Table) -> pa.Table:
    return _filter_row(key, Cuckoo.build(keys.column("high").to_numpy(), keys.column("low").to_numpy()).dump())


def _thin(filters: dict[int, bytes], shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {shard: Cuckoo.load(slots) for shard, slots in filters.items()}
        for batch in batches:
            high, low = (batch.column(c).to_numpy() for c in (1, 2))
            shard = high % shards
            hit = np.zeros(len(high), bool)
            for s in np.unique(shard):
                if s in made:
                    own = shard == s
                    hit[own] = made[s].contains(high[own], low[own])
            yield batch.filter(pa.array(hit))

    return run


def _dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            drops = part.column(2)
            offsets = drops.offsets.to_numpy()
            pairs = np.stack([drops.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
            pairs = pairs.astype(">i8").tobytes()
            lines, gone, kept = [], [], []
            for i, text in enumerate(_texts(part.column(1))):
                mine = {pairs[16 * j : 16 * j + 16] for j in range(offsets[i], offsets[i + 1])} if drops[i].is_valid else ()
                own = text.split(b"\n")
                left = [line for line, key in zip(own, line_keys(text)) if key not in mine] if mine else own
                lines.append(len(own))
                gone.append(len(own) - len(left))
                kept.append(b"\n".join(left))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept"],
            )


class LineStore:
    """Documents whose lines are counted, in the folder ``path``.

    ``shards`` is fixed when the first documents go in: a task holds the keys that one insertion
    brings to one shard and that shard's filter, so ask for one shard per ten million keys or so.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", shards: int = 64):
        self.spark, self.path, self.shards, self.id_type = spark, path.rstrip("/"), shards, id_type
        self.schemas = {
            "refs": f"doc_id {id_type}, high bigint, low bigint",
            "counts": f"shard int, high bigint, low bigint, n bigint, keeper {id_type}",
            "gone": f"doc_id {id_type}",
            "filters": _FILTERS,
        }

    def version(self) -> tuple[int, int]:
        """The last version, and the one that holds all that was before it; both 0 for an empty store."""
        try:
            last = self.spark.read.schema("version int, base int, shards int").parquet(f"{self.path}/commits")
            last = last.orderBy(F.desc("version")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None
        if last and last.shards != self.shards:
            raise ValueError(f"the store at {self.path} has {last.shards} shards")
        return (last.version, last.base) if last else (0, 0)

    def _commit(self, version: int, base: int) -> None:
        row = self.spark.createDataFrame([(version, base, self.shards)], "version int, base int, shards int")
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _write(self, df: DataFrame, table: str, version: int) -> None:
        # A version that failed before its commit is written over.
        df.write.mode("overwrite").parquet(f"{self.path}/{table}/version={version}")

    def _read(self, table: str, since: int, version: int) -> DataFrame:
        """The rows of versions ``since`` to ``version``, with their ``version``."""
        schema = f"{self.schemas[table]}, version int"
        paths = [f"{self.path}/{table}/version={v}" for v in range(since, version + 1) if v]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(*paths)

    def _live(self, version: int, base: int) -> DataFrame:
        """References of documents that have not been deleted since."""
        refs, gone = self._read("refs", base, version), self._read("gone", base, version)
        gone = gone.groupBy(F.col("doc_id").alias("_gone")).agg(F.max("version").alias("_when"))
        left = refs.join(
            common.broadcast_if_bounded(gone, 64), F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.col("version") < F.col("_when")), "left_anti"
        )
        return left.drop("version")

    def counts(self) -> DataFrame:
        """shard, high, low, n, keeper: every key held, with its documents and the largest of their ids."""
        version, base = self.version()
        return self._latest(self._read("counts", base, version)).where("n > 0")

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct("n", "keeper"), "version").alias("c")
        return rows.groupBy("shard", "high", "low").agg(last).select("shard", "high", "low", "c.n", "c.keeper")

    def _filters(self, version: int) -> DataFrame:
        return self._read("filters", version, version).drop("version")

    def insert(self, docs: DataFrame, doc_id: str, text: str) -> None:
        """Count the lines of ``docs``, none of whose ids may be in the store yet.

        A null text has one empty line. Rows of one id, and rows without an id, are one document.
        """
        version, base = self.version()
        docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        new = version + 1
        self._write(references(docs), "refs", new)
        # Versions in between hold the same tables, if empty ones.
        refs = self._read("refs", new, new).drop("version")
        if version:
            again = self._live(version, base).select(F.col("doc_id").alias("_id")).distinct()
            if not refs.join(again, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").isEmpty():
                raise ValueError("some of the documents are in the store: delete them first")
        # A key that a third of the documents have is one row per task before the shuffle.
        own = refs.groupBy(_shard(self.shards).alias("shard"), "high", "low").agg(
            F.count("*").alias("n"), F.max("doc_id").alias("keeper")
        )
        if not version:
            changed = own.withColumn("was", F.lit(0).cast("bigint"))
        else:
            changed = self._added(own, version, base)
        changed = materialise(changed, "changed")
        self._close(changed, new, base, self._read("gone", new, version))

    def _added(self, own: DataFrame, version: int, base: int) -> DataFrame:
        """``own`` with what the store has for these keys, looked for only where the filters say so."""
        held = self._filters(version).where(F.col("plane") == HELD)
        asked = materialise(
            own.groupBy("shard").cogroup(held.groupBy("shard")).applyInArrow(
                _lookup, f"shard int, high bigint, low bigint, n bigint, keeper {self.id_type}, held boolean"
            ),
            "asked",
        )
        maybe = asked.where("held").select("shard", "high", "low")
        rows = self._read("counts", base, version)
        # Few keys are asked for: they go to the counts, the counts stay where they are.
        rows = rows.join(common.broadcast_if_bounded(maybe, 32), ["shard", "high", "low"], "left_semi")
        old = self._latest(rows).where("n > 0").select("shard", "high", "low", F.col("n").alias("was"), F.col("keeper").alias("kept"))
        known = asked.where("held").join(old, ["shard", "high", "low"], "left").select(
            "shard", "high", "low", (F.col("n") + F.coalesce("was", F.lit(0))).alias("n"),
            F.greatest("keeper", "kept").alias("keeper"), F.coalesce("was", F.lit(0)).cast("bigint").alias("was"),
        )
        fresh = asked.where("NOT held").select("shard", "high", "low", "n", "keeper", F.lit(0).cast("bigint").alias("was"))
        return fresh.unionByName(known)

    def delete(self, ids: DataFrame, doc_id: str) -> None:
        """Take documents out again; ids that the store does not have do nothing."""
        version, base = self.version()
        new = version + 1
        self._write(ids.select(F.col(doc_id).alias("doc_id")).distinct(), "gone", new)
        if not version:
            self._write(self._read("refs", 0, 0).drop("version"), "refs", new)
            self._close(self.spark.createDataFrame([], f"{self.schemas['counts']}, was bigint"), new, base)
            return
        gone = self._read("gone", new, new).select(F.col("doc_id").alias("_id"))
        gone = common.broadcast_if_bounded(gone, 64)
        same = F.col("doc_id").eqNullSafe(F.col("_id"))
        live = self._live(version, base)
        lost = materialise(
            live.join(gone, same, "left_semi").groupBy("high", "low").agg(F.count("*").alias("lost"), F.max("doc_id").alias("largest")), "lost"
        )
        rows = self._read("counts", base, version)
        rows = rows.join(common.broadcast_if_bounded(lost.select("high", "low"), 24), ["high", "low"], "left_semi")
        left = materialise(
            self._latest(rows).join(lost, ["high", "low"]).select(
                "shard", "high", "low", (F.col("n") - F.col("lost")).alias("n"), "keeper", F.col("n").alias("was"),
                F.col("largest").eqNullSafe(F.col("keeper")).alias("orphan"),
            ),
            "left",
        )
        orphans = left.where("orphan AND n > 0").select("high", "low")
        heirs = live.join(gone, same, "left_anti").join(common.broadcast_if_bounded(orphans, 24), ["high", "low"], "left_semi")
        heirs = heirs.groupBy("high", "low").agg(F.max("doc_id").alias("heir"))
        keeper = F.when(F.col("orphan"), F.col("heir")).otherwise(F.col("keeper"))
        changed = left.join(heirs, ["high", "low"], "left").select("shard", "high", "low", "n", keeper.alias("keeper"), "was")
        self._write(self._read("refs", 0, 0).drop("version"), "refs", new)
        self._close(materialise(changed, "changed"), new, base)

    def _close(self, changed: DataFrame, new: int, base: int, gone: DataFrame | None = None) -> None:
        """Write the counts and filters that follow from ``changed`` (with ``was``, the count before), and commit."""
        self._write(changed.drop("was"), "counts", new)
        if gone is not None:
            self._write(gone.drop("version"), "gone", new)
        steps = []
        for plane, least in ((HELD, 1), (FREQUENT, LEAST_DOCS)):
            now, before = F.col("n") >= least, F.col("was") >= least
            steps.append(
                changed.where(now != before).select("shard", F.lit(plane).alias("plane"), "high", "low", now.alias("added"))
            )
        by = ["shard", "plane"]
        filters = materialise(
            self._filters(new - 1).groupBy(*by).cogroup(steps[0].unionByName(steps[1]).groupBy(*by)).applyInArrow(_update, _FILTERS), "filters"
        )
        small = filters.where("slots IS NULL").select(*by)
        if not small.isEmpty():
            keys = self._latest(self._read("counts", base, new)).where("n > 0")
            plane = F.explode(F.when(F.col("n") >= LEAST_DOCS, F.array(F.lit(HELD), F.lit(FREQUENT))).otherwise(F.array(F.lit(HELD))))
            keys = keys.select("shard", plane.alias("plane"), "high", "low").join(F.broadcast(small), by, "left_semi")
            filters = filters.where("slots IS NOT NULL").unionByName(keys.groupBy(*by).applyInArrow(_build, _FILTERS))
        self._write(filters, "filters", new)
        self._commit(new, base)

    def compact(self) -> None:
        """One version that holds all; earlier ones are no longer read and may be removed."""
        version, base = self.version()
        if version == base:
            return
        new = version + 1
        self._write(self._live(version, base), "refs", new)
        self._write(self.counts(), "counts", new)
        self._write(self._read("gone", new, version).drop("version"), "gone", new)
        self._write(self._filters(version), "filters", new)
        self._commit(new, new)

    def drops(self) -> DataFrame:
        """(doc_id, drops): the frequent keys of each document that another one keeps."""
        version, base = self.version()
        refs = self._live(version, base)
        # A filter's size is 8 bytes a bucket, and only sizes come to the driver before it.
        frequent = self._filters(version).where(F.col("plane") == FREQUENT)
        size = frequent.agg(F.sum(F.length("slots"))).first()[0] or 0
        if size <= SENT_BYTES:
            filters = {r.shard: bytes(r.slots) for r in frequent.collect()}
            refs = refs.mapInArrow(_thin(filters, self.shards), self.schemas["refs"])
        counts = self._latest(self._read("counts", base, version)).where(F.col("n") >= LEAST_DOCS)
        side = common.broadcast_if_bounded(materialise(counts.select("high", "low", "keeper"), "frequent"), 64)
        hits = refs.join(side, ["high", "low"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        return hits.groupBy("doc_id").agg(F.collect_list(F.struct("high", "low")).alias("drops"))

    def clean(self, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
        """doc_id, n_lines, n_dropped, kept: each row of ``docs``, which are in the store, without its dropped lines.

        ``n_lines`` counts before dropping; lines are what newlines divide, so a null or empty
        text has one. ``kept`` is the rest, joined by newlines. Rows of one id drop the same keys.
        An empty table gives an empty result; further columns of any name are not read.
        """
        kind = docs.schema[doc_id].dataType.simpleString()
        drops = self.drops().withColumnRenamed("doc_id", "_id")
        rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        rows = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "drops")
        return common.in_small_batches(rows).mapInArrow(_dropped, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept string")


def dedup(docs: DataFrame, doc_id: str, text: str, shards: int = 64) -> DataFrame:
    """``clean`` of documents that go into a store of their own."""
    kind = docs.schema[doc_id].dataType.simpleString()
    store = LineStore(docs.sparkSession, work_path(docs.sparkSession, "lines"), kind, shards)
    store.insert(docs, doc_id, text)
    return store.clean(docs, doc_id, text)
