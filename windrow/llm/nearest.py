"""Nearest neighbours by inner product, with randomly rotated one-bit codes.

A vector is centred, rotated at random into at least ``BITS`` dimensions and kept as one bit a
dimension, with three numbers: its distance from the centre, its inner product with the centre
and how well the bits stand for its direction. From packed bits and these numbers the inner
product with a query is estimated, with a bound on the error that holds with high probability.

A first pass looks again, in double precision, at the best estimates of each group; the k-th
best score of all groups is what a vector has to reach. A second pass looks at all vectors
whose upper bound reaches it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.session import materialise

#: The chance that an estimate is outside its bounds, and the standard deviations that it takes.
MISS = 0.0005
WIDTH = NormalDist().inv_cdf(1 - MISS / 2)

#: Bits of a code at least: a short vector is turned into more dimensions than it has.
BITS = 256

#: Index rows in a group are about this many times the root of all; queries visit every group.
GROUP, LEAST_GROUP = 8, 2048

#: Queries estimated at once against a group.
QUERY_BLOCK = 256

SEED = 11


def usable(embedding: str) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    v = F.col(embedding)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def rotation(dim: int) -> np.ndarray:
    """A random turn from ``dim`` into at least ``BITS`` dimensions; lengths and angles stay."""
    wide = max(dim, BITS)
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim]).standard_normal((wide, dim)))
    return (q * np.sign(np.diag(r))).T


def inner(rows: np.ndarray, queries: np.ndarray, row: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of the pairs, summed from the first dimension to the last."""
    out = np.zeros(len(row))
    for d in range(rows.shape[1]):
        out += rows[:, d][row] * queries[:, d][query]
    return out


class Codes:
    """One-bit codes of some vectors of one dimension, with their correction numbers.

    Of equal vectors only the ``copies`` with the smallest ids are kept.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, centre: np.ndarray, copies: int | None = None):
        order = np.lexsort((ids, *vectors.T))
        ids, vectors = ids[order], vectors[order]
        if copies is not None:
            fresh = np.r_[True, (vectors[1:] != vectors[:-1]).any(1)]
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), 0))
            few = np.arange(len(ids)) - first < copies
            ids, vectors = ids[few], vectors[few]
        self.ids, self.vectors, self.centre = ids, vectors, centre
        self.turn = rotation(vectors.shape[1])
        self.wide = self.turn.shape[1]
        offset = vectors - centre
        self.length = np.linalg.norm(offset, axis=1)
        unit = offset @ self.turn / np.maximum(self.length, 1e-300)[:, None]
        self.bits = np.packbits(unit > 0, axis=1)
        # The code's own direction is (+-1, ...) / sqrt(wide); this is its cosine with the vector.
        fit = np.maximum(np.abs(unit).sum(1) / math.sqrt(self.wide), 1e-9)
        self.stretch = self.length / fit / math.sqrt(self.wide)
        self.spread = self.length * np.sqrt(np.maximum(1 - fit**2, 0)) / fit / math.sqrt(max(self.wide - 1, 1))
        self.shift = vectors @ centre

    def estimates(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products, queries by rows, and the bound on each one's error."""
        signs = np.unpackbits(self.bits, axis=1, count=self.wide).astype(np.float32) * 2 - 1
        offset = queries - self.centre
        # <v, q> = <v, c> + <c, q - c> + <v - c, q - c>; the last is what the bits tell.
        estimate = (offset @ self.turn).astype(np.float32) @ (signs * self.stretch[:, None].astype(np.float32)).T
        estimate += self.shift.astype(np.float32)
        estimate += (offset @ self.centre).astype(np.float32)[:, None]
        size = np.linalg.norm(offset, axis=1)
        # What single precision may add is far below the first term.
        error = (WIDTH * size)[:, None] * self.spread + 1e-5 * (size[:, None] * self.length + np.abs(self.shift)) + 1e-12
        return estimate, error.astype(np.float32)

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, reach: np.ndarray) -> Iterator[tuple]:
        """For each query its k best rows here: (ids, scores), best first, ties to smaller ids.

        Where ``reach`` is a number, of the rows whose upper bound comes up to it; else of
        the 2 k rows with the best estimates.
        """
        estimate, error = self.estimates(queries)
        first = np.isnan(reach)
        if first.any():
            wanted = min(2 * k + 1, estimate.shape[1])
            least = np.partition(estimate[first], -wanted, axis=1)[:, -wanted]
            estimate[first] -= least[:, None]
            error[first] = 0
        estimate += error
        q, row = np.nonzero(estimate >= np.where(first, 0, reach).astype(np.float32)[:, None])
        other = query_ids[q] != self.ids[row]
        q, row = q[other], row[other]
        score = inner(self.vectors, queries, row, q)
        order = np.lexsort((self.ids[row], -score, q))
        q, row, score = q[order], row[order], score[order]
        edges = np.searchsorted(q, np.arange(len(queries) + 1))
        for i in range(len(queries)):
            part = slice(edges[i], min(edges[i] + k, edges[i + 1]))
            yield self.ids[row[part]], score[part]


def _searcher(centres: dict[int, list[float]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, codes = None, [], {}

        def coded() -> dict[int, Codes]:
            made = {}
            for dim in {len(v) for _, v in rows}:
                mine = [(i, v) for i, v in rows if len(v) == dim]
                ids, vectors = np.array([i for i, _ in mine]), np.stack([v for _, v in mine])
                # One of the copies may be the query itself.
                made[dim] = Codes(ids, vectors, np.array(centres[dim]), k + 1)
            return made

        for batch in batches:
            found, where = [], batch.column(0).to_numpy()
            kinds, ids = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            reach = batch.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
            values, ends = batch.column(3).flatten().to_numpy(), batch.column(3).offsets.to_numpy()
            ends = ends - ends[0]
            vectors = [values[a:b].astype(np.float64) for a, b in zip(ends, ends[1:])]
            for at in range(0, len(ids), QUERY_BLOCK):
                asked: dict[int, list[int]] = {}
                for i in range(at, min(at + QUERY_BLOCK, len(ids))):
                    if where[i] != group:
                        found += _answers(codes, asked, ids, vectors, reach, k)
                        asked, group, rows, codes = {}, where[i], [], {}
                    if kinds[i] == 0:
                        rows.append((ids[i], vectors[i]))
                        continue
                    codes = codes or coded()
                    asked.setdefault(len(vectors[i]), []).append(i)
                found += _answers(codes, asked, ids, vectors, reach, k)
            yield pa.RecordBatch.from_pylist(found, _FOUND)

    return run


_FOUND = pa.schema(
    [
        ("query_id", pa.int64()),
        ("found", pa.list_(pa.struct([("down", pa.float64()), ("vec_id", pa.int64())]))),
    ]
)


def _answers(codes: dict[int, Codes], asked: dict[int, list[int]], ids, vectors, reach, k: int) -> list[dict]:
    out = []
    for dim, mine in asked.items():
        if dim in codes:
            queries = np.stack([vectors[i] for i in mine])
            hits = codes[dim].best(ids[mine], queries, k, reach[mine])
            for i, (near, score) in zip(mine, hits):
                best = [{"down": -s, "vec_id": n} for n, s in zip(near.tolist(), score.tolist())]
                out.append({"query_id": int(ids[i]), "found": best})
    return out


def merged(k: int, times: int = 1) -> Column:
    """The ``k`` best of all that was ``found`` for a query, where none is in more than ``times`` of the lists.

    A group is visited once a pass, so one pass has no repetitions. Of several passes they stand
    side by side once sorted: distinct structs are sought by pairs, hence only among the first.
    """
    best = F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, times * k)
    return F.slice(F.array_distinct(best), 1, k) if times > 1 else best


def search(vectors: DataFrame, queries: Column, vec_id: str, embedding: str, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row that ``queries`` selects.

    Vectors that are null, empty, zero or not finite throughout take no part, on either
    side; nor do rows without an id. Candidates have the query's dimension and another id.
    Rows that share an id are one vector, the least of them. Fewer than ``k`` candidates are
    all returned. An empty table gives an empty result.

    The index is dealt into groups; each task holds one group's codes at a time and streams the
    queries past them, a block at a time. Each query leaves at most ``k`` rows per group.
    """
    doubles = F.transform(embedding, lambda x: x.cast("double"))
    rows = vectors.where(usable(embedding) & F.col(vec_id).isNotNull())
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), doubles.alias("v"), queries.alias("asked"))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asked").alias("asked"))
    rows = materialise(rows.withColumn("dim", F.size("v")), "vectors")
    total = rows.count()
    groups = max(1, round(total / max(LEAST_GROUP, GROUP * math.sqrt(total))))
    # One number for each dimension.
    parts = rows.select("dim", F.posexplode("v")).groupBy("dim", "pos").agg(F.avg("col").alias("m")).collect()
    centres: dict[int, list[float]] = {}
    for r in sorted(parts, key=lambda r: (r.dim, r.pos)):
        centres.setdefault(r.dim, []).append(r.m)
    group = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("g")
    none = F.lit(None).cast("double").alias("reach")
    index = rows.select(group, F.lit(0).alias("kind"), "vec_id", "v", none)

    def visit(asked: DataFrame) -> DataFrame:
        """(query_id, found): the best of each group, of one query in one row per group."""
        every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g")
        dealt = index.union(asked.select(every, F.lit(1).alias("kind"), "vec_id", "v", "reach"))
        dealt = dealt.repartition(groups, "g").sortWithinPartitions("g", "kind")
        return dealt.mapInArrow(
            _searcher(centres, k), "query_id bigint, found array<struct<down:double,vec_id:bigint>>"
        )

    queries_of = rows.where("asked")
    first = materialise(visit(queries_of.select("vec_id", "v", none)).groupBy("query_id").agg(merged(k).alias("found")), "first")
    # Fewer than k found so far: everything may still be among the nearest.
    reached = F.when(F.size("found") >= k, -F.element_at("found", -1)["down"]).otherwise(F.lit(float("-inf")))
    reach = first.select("query_id", reached.alias("reach"))
    again = queries_of.join(reach, F.col("vec_id") == F.col("query_id")).select("vec_id", "v", "reach")
    found = visit(again).union(first).groupBy("query_id").agg(merged(k, 2).alias("found"))
    return found.select("query_id", F.posexplode("found").alias("rank", "near")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "near.vec_id", (-F.col("near.down")).alias("score")
    )
