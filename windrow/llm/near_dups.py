"""Near-duplicates by bottom-k sketches from one hash function.

Every document is the set of its word shingles, hashed once. Its sketch is the k smallest
hashes. Sketches are turned into inverted lists of retained values; documents that share one
are compared on the sketch of their union, and what passes is compared on the full sets.

Which values are listed: two documents as similar as asked have at least ``common`` values of
their sketches in common (but for a chance of ``MISS`` a pair), so it is enough to list each
sketch's rarest values, as many as leave fewer than ``common``. Values of passages
that very many documents share are common, hence not listed unless they are most of a sketch.

Long lists are not multiplied out. First each list's members are compared with one of them, the
pivot; members found to be linked are one component, and pairs within one need no look. Lists of
one pivot are one group, and a few of the strangers in it are pivots too. For what is left, each
member stands as its difference from the group's pivot: the members that it lacks and those that
it has besides. Two sets a and b of pivot p are linked exactly when their differences share at
least c(a) + c(b) - k members, where c weighs a difference's parts and k follows from p's size.
Near copies that are too far from each other share little of their differences, and few and rare
members of them tell that: the rarest are joined, up to where what is left cannot reach the
number. So no link between components is missed and copies are never paired with all copies.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm import common
from windrow.llm.graph import components
from windrow.session import materialise

#: Values that a sketch retains, and the chance that two similar documents go unseen.
K, MISS = 64, 1e-6

#: Strangers of a group that are its pivots in the second round.
PIVOTS = 8

#: Bytes of words and their hashes that a task remembers.
WORD_BYTES = 8 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@dataclass(frozen=True)
class Similar:
    """Linked when 100 x intersection >= percent x union, on sets of ``width``-word shingles."""

    width: int = 5
    percent: int = 80

    @property
    def common(self) -> int:
        """Values of the union's sketch that a linked pair shares, but for a chance of ``MISS``."""
        p, below = self.percent / 100, 0.0
        for i in range(K + 1):
            below += math.comb(K, i) * p**i * (1 - p) ** (K - i)
            if below > MISS:
                return i
        return K

    def listed(self, n: Column) -> Column:
        """How many values a document with ``n`` shingles lists.

        A set that is its own sketch shares at least percent of it with a linked one; a
        linked set just above k lacks a few values, for which some more are listed.
        """
        spare = K - math.ceil(K - (100 - self.percent) / 100 * K * 100 / self.percent)
        whole = n - F.ceil(n * self.percent / F.lit(100)) + 1 + spare
        return F.when(n > K, F.lit(K - self.common + 1)).otherwise(F.least(n, whole)).cast("int")


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str, width: int, words: dict) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; of all its words, if they are fewer."""
    parts = text.encode().translate(_LOWER).split()
    if not parts:
        return np.empty(0, np.int64)
    h = np.array([words[w] for w in parts], dtype=np.uint64)
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = _mixed(out) + h[i : len(h) - width + 1 + i]
    return np.unique(_mixed(out).view(np.int64))


def _sets(width: int, sketch: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = common.Memory(xxhash.xxh3_64_intdigest, WORD_BYTES)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingle_set(t or "", width, words) for t in part.column(1).to_pylist()]
                kept = [s[:K] if sketch else s for s in found]
                ends = np.cumsum([0, *map(len, kept)], dtype=np.int32)
                flat = np.concatenate(kept) if kept else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    names=["doc_id", "n", "set_hash", "values"],
                )
        common.give_back()

    return run


def sets(docs: DataFrame, width: int, sketch: bool) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.in_small_batches(docs.select("doc_id", "text")).mapInArrow(
        _sets(width, sketch), f"doc_id {kind}, n bigint, set_hash binary, values array<bigint>"
    )


def listed(classes: DataFrame, like: Similar) -> DataFrame:
    """(cid, n, weight, value): the rarest retained values of each class that another class has too.

    Values that no other class retains come first in the order of rarity and are not written.
    ``weight`` says how common a class's values are: in a group of copies it is largest for the
    one that the others were made from.
    """
    retained = classes.select("cid", "n", F.explode("values").alias("value"))
    # A hot value is one row per task here, and narrow rows in the join below.
    shared = retained.groupBy("value").agg(F.count("*").alias("seen")).where("seen > 1")
    held = retained.join(shared, "value").groupBy("cid", "n").agg(
        F.sort_array(F.collect_list(F.struct("seen", "value"))).alias("held"), F.sum("seen").alias("weight")
    )
    alone = F.least(F.col("n"), F.lit(K)).cast("int") - F.size("held")
    most = F.greatest(like.listed(F.col("n")) - alone, F.lit(0))
    chosen = held.select("cid", "n", "weight", F.explode(F.slice("held", F.lit(1), most)).alias("x"))
    chosen = materialise(chosen.select("cid", "n", "weight", "x.value"), "listed")
    several = chosen.groupBy("value").agg(F.count("*").alias("size")).where("size > 1").select("value")
    return materialise(chosen.join(several, "value"), "lists")


def _close_in_size(a: Column, b: Column, like: Similar) -> Column:
    return 100 * F.least(a, b) >= like.percent * F.greatest(a, b)


def promising(pairs: DataFrame, classes: DataFrame, like: Similar) -> DataFrame:
    """The pairs (a, b) whose sizes and union sketches allow the similarity."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("values").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(_close_in_size(F.col("n_a"), F.col("n_b"), like))
    both = both.withColumn("union", F.slice(F.sort_array(F.array_union("s_a", "s_b")), 1, K))
    shared = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), F.col("union")))
    return both.where(shared * K >= like.common * F.size("union")).select("a", "b")


def whole_sets(members: DataFrame, docs: DataFrame, like: Similar) -> DataFrame:
    """(cid, whole): the full sets of ``members``, made from their texts."""
    ids = common.broadcast_if_bounded(members.select(F.col("rep").alias("_rep")).distinct(), 32)
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(F.col("_rep"))).select("doc_id", "text")
    # An id that several texts share brings some that are not asked for.
    made = sets(texts, like.width, False).select("set_hash", "values").dropDuplicates(["set_hash"])
    made = made.join(members.select("cid", "set_hash"), "set_hash")
    return materialise(made.select("cid", F.col("values").alias("whole")), "whole")


def verified(pairs: DataFrame, whole: DataFrame, like: Similar) -> DataFrame:
    """The pairs that the full sets confirm."""
    side = lambda x: whole.select(F.col("cid").alias(x), F.col("whole").alias(f"w_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("w_a", "w_b"))
    sure = 100 * shared >= like.percent * (F.size("w_a") + F.size("w_b") - shared)
    return both.where(sure).select("a", "b")


def groups_by_pivot(lists: DataFrame) -> DataFrame:
    """(pivot, pivot_n, cid, n, weight): each list's members under its first member; lists of one pivot are one group."""
    first = F.max_by(F.struct("cid", "n"), F.struct("weight", -F.col("cid")))
    pivots = lists.groupBy("value").agg(first.alias("p"))
    held = lists.join(pivots, "value").select(F.col("p.cid").alias("pivot"), F.col("p.n").alias("pivot_n"), "cid", "n", "weight")
    return materialise(held.distinct(), "groups")


def _pairs(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    return rows.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()


def pivot_pairs(groups: DataFrame, like: Similar) -> DataFrame:
    """Each member of a group with the pivot."""
    pairs = groups.where(F.col("cid") != F.col("pivot")).where(_close_in_size(F.col("n"), F.col("pivot_n"), like))
    return _pairs(pairs, F.col("cid"), F.col("pivot"))


def open_groups(groups: DataFrame, roots: DataFrame) -> DataFrame:
    """``groups`` that hold several components, with each member's ``root`` and whether it is a ``stranger`` to its pivot."""
    own, main = roots.toDF("_n", "_r"), roots.toDF("_p", "_q")
    rooted = groups.join(own, F.col("cid") == F.col("_n"), "left").join(main, F.col("pivot") == F.col("_p"), "left")
    rooted = rooted.withColumn("root", F.coalesce("_r", "cid"))
    rooted = rooted.withColumn("stranger", F.col("root") != F.coalesce("_q", "pivot")).drop("_n", "_r", "_p", "_q")
    several = rooted.where("stranger").select("pivot").distinct()
    return materialise(rooted.join(several, "pivot", "left_semi"), "open-groups")


def stranger_pairs(members: DataFrame, like: Similar) -> DataFrame:
    """All members with a few strangers of their group."""
    turn = F.row_number().over(Window.partitionBy("pivot").orderBy(F.desc("weight"), "cid"))
    few = members.where("stranger").withColumn("turn", turn).where(F.col("turn") <= PIVOTS)
    few = few.select("pivot", F.struct("cid", "n", "root").alias("b"))
    pairs = members.join(few, "pivot").where(F.col("root") != F.col("b.root"))
    return _pairs(pairs.where(_close_in_size(F.col("n"), F.col("b.n"), like)), F.col("cid"), F.col("b.cid"))


def differences(members: DataFrame, whole: DataFrame, like: Similar) -> DataFrame:
    """(pivot, cid, root, stranger, apart, cost, slack) of each member but the pivot.

    ``apart`` is the difference from the pivot. With ``cost`` in units of 1 / (100 + percent)
    members, two are linked when they share cost + cost - slack of it at least.
    """
    own, base = whole.toDF("_n", "_own"), whole.toDF("_p", "_base")
    rows = members.where(F.col("cid") != F.col("pivot")).join(own, F.col("cid") == F.col("_n"))
    rows = rows.join(base, F.col("pivot") == F.col("_p"))
    lacks, more = F.array_except("_base", "_own"), F.array_except("_own", "_base")
    rows = rows.select("pivot", "pivot_n", "cid", "root", "stranger", lacks.alias("lacks"), more.alias("more"))
    return materialise(
        rows.select(
            "pivot",
            "cid",
            "root",
            "stranger",
            F.concat("lacks", "more").alias("apart"),
            (100 * F.size("lacks") + like.percent * F.size("more")).cast("bigint").alias("cost"),
            ((100 - like.percent) * F.col("pivot_n")).cast("bigint").alias("slack"),
        ),
        "differences",
    )


def difference_pairs(apart: DataFrame, like: Similar) -> DataFrame:
    """(pivot, a, b): pairs across components whose differences may share as much as a link asks.

    Members that no other difference of the group has come first in the order of rarity and
    are not joined. A linked pair meets at the rarest member that both have; from there on both
    have enough left. ``rest`` is what is left, and joined are places up to which it can be enough
    for the partner that asks least.
    """
    unit = 100 + like.percent
    held = apart.select("pivot", "cid", F.explode("apart").alias("value"))
    shared = held.groupBy("pivot", "value").agg(F.count("*").alias("seen")).where("seen > 1")
    ranked = held.join(shared, ["pivot", "value"]).groupBy("pivot", "cid").agg(
        F.sort_array(F.collect_list(F.struct("seen", "value"))).alias("held")
    )
    least = apart.groupBy("pivot").agg(
        F.min("cost").alias("least"), F.min(F.when(F.col("stranger"), F.col("cost"))).alias("least_stranger")
    )
    rows = apart.select("pivot", "cid", "root", "stranger", "cost", "slack").join(ranked, ["pivot", "cid"]).join(least, "pivot")
    # Who shares with a costly one is costly too: it has what is shared.
    partner = F.when(F.col("stranger"), F.col("least")).otherwise(F.col("least_stranger"))
    partner = F.greatest(partner, F.ceil((F.col("cost") - F.col("slack")) * like.percent / F.lit(100)))
    need = F.greatest(F.ceil((F.col("cost") + partner - F.col("slack")) / F.lit(unit)), F.lit(1))
    places = F.slice("held", F.lit(1), F.greatest(F.size("held") - F.col("need") + 1, F.lit(0)).cast("int"))
    rows = rows.withColumn("need", need).withColumn("all", F.size("held")).select(
        "pivot", "cid", "root", "stranger", "cost", "slack", "all", F.posexplode(places).alias("at", "x")
    )
    rows = rows.select("pivot", F.col("x.value").alias("value"), "cid", "root", "stranger", "cost", "slack", (F.col("all") - F.col("at")).alias("rest"))
    rows = materialise(rows, "places")
    several = rows.groupBy("pivot", "value").agg(F.count("*").alias("n"), F.count_if("stranger").alias("s")).where("n > 1 AND s > 0")
    rows = rows.join(several.select("pivot", "value"), ["pivot", "value"], "left_semi")
    other = rows.select("pivot", "value", F.struct("cid", "root", "stranger", "cost", "rest").alias("b"))
    # Strangers meet everyone, and each other once.
    pairs = rows.where("stranger").join(other, ["pivot", "value"]).where(
        (F.col("root") != F.col("b.root"))
        & (~F.col("b.stranger") | (F.col("cid") > F.col("b.cid")))
        & (unit * F.least("rest", "b.rest") >= F.col("cost") + F.col("b.cost") - F.col("slack"))
    )
    return pairs.select("pivot", F.col("cid").alias("a"), F.col("b.cid").alias("b")).distinct()


def linked_by_difference(pairs: DataFrame, apart: DataFrame, like: Similar) -> DataFrame:
    """The pairs (a, b) that are linked: what their differences share decides, so no whole set is carried."""
    side = lambda x: apart.select("pivot", F.col("cid").alias(x), F.col("apart").alias(f"w_{x}"), F.col("cost").alias(f"c_{x}"))
    slack = apart.groupBy("pivot").agg(F.first("slack").alias("slack"))
    both = pairs.join(side("a"), ["pivot", "a"]).join(side("b"), ["pivot", "b"]).join(slack, "pivot")
    shared = F.size(F.array_intersect("w_a", "w_b"))
    sure = (100 + like.percent) * shared >= F.col("c_a") + F.col("c_b") - F.col("slack")
    return _pairs(both.where(sure), F.col("a"), F.col("b"))


def group(docs: DataFrame, doc_id: str, text: str, like: Similar = Similar()) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id of the group), kept; one row per row.

    Letters A to Z are taken as small, words lie between ASCII white space. A null or empty
    text has no shingles and is linked with nothing. Equal sets are one class from the start,
    however many rows have them, and only classes are compared. Null ids never name a
    component that has another id. Repeated rows get the same component, and each is kept
    where it has the component's id. An empty table gives an empty result.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = materialise(sets(docs, like.width, True), "sketches")
    # Equal sets have equal sizes and sketches; a third of all rows may be one class.
    classes = own.where("n > 0").groupBy("set_hash").agg(
        F.first("n").alias("n"), F.first("values").alias("values"), F.min("doc_id").alias("rep")
    )
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    lists = listed(classes, like)
    members = materialise(classes.join(lists.select("cid").distinct(), "cid", "left_semi"), "members")
    whole = whole_sets(members, docs, like)
    check = lambda pairs: materialise(verified(promising(pairs, members, like), whole, like), "linked")
    groups = groups_by_pivot(lists)
    roots = materialise(components(check(pivot_pairs(groups, like))), "roots")

    def added(links: DataFrame) -> DataFrame:
        # What is known of components stands in for their links.
        known = roots.where("node <> root").toDF("a", "b")
        return roots if links.isEmpty() else materialise(components(links.union(known)), "roots")

    left = open_groups(groups, roots)
    if not left.isEmpty():
        roots = added(check(stranger_pairs(left, like)))
        left = open_groups(left.drop("root", "stranger"), roots)
        apart = differences(left, whole, like)
        pairs = materialise(difference_pairs(apart, like), "pairs")
        roots = added(materialise(linked_by_difference(pairs, apart, like), "linked"))
    named = classes.join(roots, F.col("cid") == F.col("node"), "left").select(
        "set_hash", "rep", F.coalesce("root", "cid").alias("root")
    )
    named = materialise(named, "named")
    ids = named.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("classes"))
    # Only components of several classes need the join.
    named = named.join(ids.where("classes > 1").drop("classes"), "root", "left").select(
        F.col("set_hash").alias("_h"), F.coalesce("component_id", "rep").alias("component_id")
    )
    out = own.select("doc_id", "n", "set_hash").join(named, (F.col("set_hash") == F.col("_h")) & (F.col("n") > 0), "left")
    out = out.withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def one_of_each(stored: DataFrame, doc_id: str, text: str, like: Similar = Similar()) -> DataFrame:
    """The rows of a stored table without all but one of each group: the one with the least id.

    Rows are told apart by numbers that are written first, so repeated rows and rows without an id
    leave one too; a row with an id goes before one without.
    """
    rows = common.numbered(stored)
    own = F.struct(F.col(f"_doc.`{doc_id}`").isNull().alias("none"), F.col(f"_doc.`{doc_id}`").alias("id"), F.col("_row").alias("row"))
    grouped = group(rows.select(own.alias("own"), F.col(f"_doc.`{text}`").alias("text")), "own", "text", like)
    gone = materialise(grouped.where(~F.col("kept")).select(F.col("doc_id.row").alias("_gone")), "gone")
    left = rows.join(common.broadcast_if_bounded(gone, 16), F.col("_row") == F.col("_gone"), "left_anti")
    return left.select("_doc.*")
