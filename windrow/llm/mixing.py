"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is due the same number of copies, its source's target over its
size. The whole part is settled; the fractional parts are rounded in pairs: words move from
one document of a pair to the other, in a direction drawn so that expectations hold, until one
of the two has none or all of its copy. The other goes on to the next pair. A source's words
never change in a pair, so at the end one document per source is left to chance.

Pairs are formed within blocks of a fixed number of documents; the one left over from each
block goes to a block of the next level, so the work is a reduction tree over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm import common
from windrow.session import materialise

#: Fixed by the task: weights of the sources in code-point order, and the most copies of a source.
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3

#: Documents that one block rounds.
BLOCK = 512

#: Shares closer than this to a whole number are whole.
EXACT = 1e-12

_ROUND = """
aggregate(
  slice(items, 2, size(items)),
  named_struct(
    'rank', items[0].rank, 'size', items[0].size, 'share', items[0].share,
    'done', cast(array() as array<struct<rank:bigint,up:boolean>>)),
  (a, x) -> transform(
    array(named_struct(
      'up', least((1 - a.share) * a.size, x.share * x.size),
      'down', least(a.share * a.size, (1 - x.share) * x.size))),
    m -> CASE
      WHEN x.draw * (m.up + m.down) < m.down AND (1 - a.share) * a.size <= x.share * x.size
      THEN named_struct('rank', x.rank, 'size', x.size, 'share', x.share - m.up / x.size,
        'done', array_append(a.done, named_struct('rank', a.rank, 'up', true)))
      WHEN x.draw * (m.up + m.down) < m.down
      THEN named_struct('rank', a.rank, 'size', a.size, 'share', a.share + m.up / a.size,
        'done', array_append(a.done, named_struct('rank', x.rank, 'up', false)))
      WHEN a.share * a.size <= (1 - x.share) * x.size
      THEN named_struct('rank', x.rank, 'size', x.size, 'share', x.share + m.down / x.size,
        'done', array_append(a.done, named_struct('rank', a.rank, 'up', false)))
      ELSE named_struct('rank', a.rank, 'size', a.size, 'share', a.share - m.down / a.size,
        'done', array_append(a.done, named_struct('rank', x.rank, 'up', true)))
    END)[0])
"""


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: source, place, weight, source_size, target.

    Shares of all words by weight; a source stops at ``MOST_COPIES`` times its size and the
    excess is shared again. Each round is one aggregate over the sources; only two numbers
    come back, the words left to share and the weights they go to.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = common.with_rank(
        materialise(sizes.withColumn("_null", F.col("source").isNull()), "sources"), "_null", "source", name="place"
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    placed = materialise(placed.withColumn("weight", weight.cast("long")), "weights")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    total, weights = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weights = total or 0, weights or 0
    rest, open_weight = total, weights

    def above():
        return MOST_COPIES * big("source_size") * F.lit(open_weight) < big("weight") * F.lit(rest)

    while open_weight:
        full, taken = placed.where(above()).agg(F.sum("weight"), F.sum("source_size")).first()
        now = (total - MOST_COPIES * (taken or 0), weights - (full or 0))
        if now == (rest, open_weight):
            break
        rest, open_weight = now
    shared = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(open_weight or 1))
    stopped = (MOST_COPIES * F.col("source_size")).cast("double")
    return placed.select(
        "source", "place", "weight", "source_size", F.when(above(), stopped).otherwise(shared).alias("target")
    )


def _draw(seed: int, level: int) -> Column:
    """A number in [0, 1) that only depends on the seed, the level and the rank."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), F.col("rank")), 11) * F.lit(2.0**-53)


def dependent_rounding(shares: DataFrame, rows: int, seed: int) -> DataFrame:
    """(rank, up) for each of ``shares``: place, rank (below ``rows``), size, share in (0, 1).

    Within a place the sum of size x share is kept, but for the last document of each place.
    """
    left = shares.select("place", "rank", F.col("size").cast("double").alias("size"), "share")
    left = left.withColumn("block", F.floor(F.col("rank") / BLOCK))
    settled, level, blocks = [], 0, -(-rows // BLOCK)
    while True:
        items = F.sort_array(F.collect_list(F.struct("rank", "size", "share", _draw(seed, level).alias("draw"))))
        rounded = materialise(
            left.groupBy("place", "block").agg(items.alias("items")).select("place", "block", F.expr(_ROUND).alias("r")),
            f"rounded-{level}",
        )
        settled.append(rounded.select(F.explode("r.done").alias("d")).select("d.rank", "d.up"))
        left = rounded.select(
            "place", "r.rank", "r.size", "r.share", F.floor(F.col("block") / BLOCK).alias("block")
        )
        level += 1
        if blocks <= 1:
            break
        blocks = -(-blocks // BLOCK)
    out = left.select("rank", (_draw(seed, level) < F.col("share")).alias("up"))
    for part in settled:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, doc_id: str, source: str, text: str, seed: int = 17, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (and ``row``).

    ``taken`` is copies x size. Documents of a source are rounded from long to short, so what
    is left to chance at the end is mostly a short one. The draws depend on the document's
    position in the order of (source, size, hash of the id, id), so a rerun gives the same.
    A null text has size 0 and is taken 0 times its size; a null source is a source, the last
    one; repeated rows are rounded one by one; an empty table gives an empty result.
    """
    carried = [F.col(row).alias("row")] if row else []
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), *carried
    )
    sized = materialise(sized.withColumns({"_down": -F.col("size"), "_hash": F.xxhash64(F.lit(seed), "doc_id")}), "sizes")
    aims = materialise(targets(sized), "targets")
    ranked = common.with_rank(sized, "source", "_down", "_hash", "doc_id", *(["row"] if row else []), name="rank").drop("_down", "_hash")
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(F.col("_due") + EXACT)
    aims_side = common.broadcast_if_bounded(aims, 256).withColumnRenamed("source", "_of")
    ranked = materialise(
        ranked.join(aims_side, F.col("source").eqNullSafe(F.col("_of")))
        .drop("_of")
        .withColumn("_due", due)
        .withColumns({"whole": whole, "share": F.col("_due") - whole}),
        "due",
    )
    shares = ranked.where((F.col("size") > 0) & (F.col("share") > EXACT))
    up = dependent_rounding(shares, ranked.count(), seed)
    copies = F.col("whole") + F.coalesce(F.col("up").cast("long"), F.lit(0))
    return ranked.join(up, "rank", "left").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        *(["row"] if row else []),
    )


def repeated(stored: DataFrame, doc_id: str, source: str, text: str, seed: int = 17) -> DataFrame:
    """The rows of a stored table, each as often as the mix takes it; rows taken no time go."""
    rows = common.numbered(stored)
    mixed = mix(rows.select("_row", *[f"_doc.`{c}`" for c in (doc_id, source, text)]), doc_id, source, text, seed, "_row")
    taken = materialise(mixed.where("copies > 0").select(F.col("row").alias("_taken"), "copies"), "taken")
    held = rows.join(common.broadcast_if_bounded(taken, 24), F.col("_row") == F.col("_taken"))
    return held.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_doc.*")
