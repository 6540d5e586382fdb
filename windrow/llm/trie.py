"""The trie of all conversations' beginnings, by ROLLUP.

A turn is named by a hash. A conversation is cut into blocks of ``WIDTH`` turns, one row each,
with the turns in columns t1, t2, ... and the node that the block before ended at as ``prior``.
One ROLLUP over those columns aggregates every prefix within every block together;
``grouping_id`` tells how many of a group's turns count. Blocks of all conversations are rolled
up at once, since the name of a prior node follows from the turns alone: names of whole prefixes
are put together from runs of blocks that double in length.

What a node needs from below comes from a second ROLLUP, over the nodes; what lies in further
blocks is first gathered up the tree of blocks, each step from twice as far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm import common
from windrow.session import materialise

#: Turns in a block: columns of the ROLLUP.
WIDTH = 8

#: Conversations that end at a node are listed in stretches of so many numbers.
STRETCH = 4096

_T = [f"t{i}" for i in range(1, WIDTH + 1)]


def _name(*parts: Column) -> Column:
    """A 128-bit name of byte strings of 16 bytes each, or of one string."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turn_name(role: Column, text: Column) -> Column:
    """Equal for equal (role, text), null counting as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return _name(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "utf-8"))


def numbered_turns(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, at, id, bytes) for each row: its place in the conversation from 1, by turn, nulls first.

    Rows of the same turn stand in the order of their names. Rows without a conversation are
    left out. ``bytes`` is the length of the text in UTF-8. Places come from one range
    partitioning of all rows, so a conversation that holds a third of them is spread like the rest.
    """
    named = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv"),
        F.col(turn).alias("turn"),
        turn_name(F.col(role), F.col(text)).alias("id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("bytes"),
    )
    ranked = materialise(common.with_rank(named, "conv", "turn", "id", into="turns"), "placed")
    starts = ranked.groupBy("conv").agg(F.min("_rank").alias("start"))
    return ranked.join(starts, "conv").select("conv", (F.col("_rank") - F.col("start") + 1).alias("at"), "id", "bytes")


def shared_openings(turns: DataFrame, of: Column, first: Column) -> DataFrame:
    """``turns`` where each conversation's first turns are another one's, with a row of its own for each turnless one.

    ``of`` and ``first``, over the column conv, say whose and how many. A conversation that has
    fewer gives what it has; the turns behind ``first`` are the conversation's own. The id is
    null in the row, at place 0, of a conversation that has no turns then.
    """
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"))
    plan = sizes.select("conv", "n", of.alias("base"), first.cast("bigint").alias("first"))
    given = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = plan.join(given, "base", "left").withColumn("taken", F.least("first", F.coalesce("base_n", F.lit(0))))
    plan = materialise(plan, "openings")
    most = plan.agg(F.max("taken")).first()[0] or 0
    heads = turns.where(F.col("at") <= most).withColumnRenamed("conv", "base").join(plan.select("base", "conv", "taken"), "base")
    heads = heads.where(F.col("at") <= F.col("taken")).select("conv", "at", "id", "bytes")
    own = turns.join(plan.select("conv", "first", "taken"), "conv").where(F.col("at") > F.col("first"))
    own = own.select("conv", (F.col("at") - F.col("first") + F.col("taken")).alias("at"), "id", "bytes")
    bare = plan.where((F.col("taken") == 0) & (F.col("n") <= F.col("first")))
    bare = bare.select("conv", F.lit(0).cast("bigint").alias("at"), F.lit(None).cast("binary").alias("id"), F.lit(0).cast("bigint").alias("bytes"))
    return heads.unionByName(own).unionByName(bare)


def _blocks(turns: DataFrame) -> DataFrame:
    """conv, block, prior, total (turns of the conversation), t1 ...: a row per conversation and block."""
    slot = F.pmod(F.col("at") - 1, F.lit(WIDTH))
    held = F.array_compact(F.transform(F.sort_array(F.collect_list(F.struct("slot", "id", "bytes"))), lambda t: F.when(t["id"].isNotNull(), t)))
    rows = turns.withColumns({"block": F.greatest(F.floor((F.col("at") - 1) / WIDTH), F.lit(0)), "slot": slot})
    rows = rows.groupBy("conv", "block").agg(held.alias("held"))
    rows = materialise(
        rows.withColumn("run", F.when(F.size("held") == WIDTH, _name(F.array_join(F.transform("held", lambda t: F.hex(t["id"])), "").cast("binary")))),
        "blocks",
    )
    totals = rows.groupBy("conv").agg(F.sum(F.size("held")).alias("total"), F.max("block").alias("last"))
    longest = totals.agg(F.max("last")).first()[0] or 0
    # Names of the runs of 1, 2, 4, ... blocks that end at each block, cut off at the conversation's start.
    names, reach = rows.select("conv", "block", "run"), 1
    while reach <= longest:
        before = names.select("conv", (F.col("block") + reach).alias("block"), F.col("run").alias("left"))
        joined = names.join(before, ["conv", "block"], "left")
        names = materialise(joined.select("conv", "block", F.when(F.col("left").isNull(), F.col("run")).otherwise(_name(F.col("left"), F.col("run"))).alias("run")), "names")
        reach *= 2
    priors = names.select("conv", (F.col("block") + 1).alias("block"), F.col("run").alias("prior"))
    rows = rows.drop("run").join(names, ["conv", "block"]).join(priors, ["conv", "block"], "left").join(totals, "conv")
    # The last column holds the whole prefix's name too, which its other columns and prior determine.
    turn = lambda i: F.get("held", F.lit(i))
    columns = [
        F.when(turn(i).isNotNull(), F.struct(turn(i)["id"].alias("id"), turn(i)["bytes"].alias("bytes"), *([F.col("run").alias("name")] if i == WIDTH - 1 else []))).alias(t)
        for i, t in enumerate(_T)
    ]
    return rows.select("conv", "block", F.coalesce("prior", F.lit(b"")).alias("prior"), "total", "last", *columns)


def _node(level: Column) -> Column:
    """The name of the prefix that ends ``level`` turns into a block."""
    inner = F.col("prior")
    out = F.when(level == 0, inner)
    for i, t in enumerate(_T[:-1]):
        inner = F.concat(inner, F.col(f"{t}.id"))
        out = out.when(level == i + 1, _name(F.lit(b"node"), inner))
    return out.otherwise(F.col(f"{_T[-1]}.name"))


def _rollup(rows: DataFrame, aggregates: str) -> DataFrame:
    """Every prefix within every block: prior, block, t1 ..., level, and the aggregates."""
    columns = ", ".join(_T)
    out = rows.sparkSession.sql(
        f"SELECT prior, block, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, {aggregates} "
        f"FROM {{rows}} GROUP BY prior, block, ROLLUP({columns})",
        rows=rows,
    )
    # A column that is null though it counts is behind the end of a conversation; a block's
    # level 0 is the node that the block before ends at.
    last = F.coalesce(*[F.when(F.col("level") == i + 1, F.col(t).isNotNull()) for i, t in enumerate(_T)], F.col("block") == 0)
    return out.where(last)


def _gathered(nodes: DataFrame, longest: int) -> DataFrame:
    """(root, leaves, saved): for a node that ends a block and goes on, the sums over all below it."""
    below = nodes.where("block > 0").groupBy("prior").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    tree = nodes.where((F.col("level") == WIDTH) & (F.col("leaf") == 0))
    tree = tree.select(F.col("node").alias("root"), F.when(F.col("block") > 0, F.col("prior")).alias("up"))
    tree, reach = materialise(tree.join(below, F.col("root") == F.col("prior")).drop("prior"), "gathered"), 1
    while reach < longest:
        more = tree.where("up IS NOT NULL").groupBy(F.col("up").alias("_up")).agg(F.sum("leaves").alias("_l"), F.sum("saved").alias("_s"))
        higher = tree.select(F.col("root").alias("_root"), F.col("up").alias("_next"))
        tree = materialise(
            tree.join(more, F.col("root") == F.col("_up"), "left")
            .join(higher, F.col("up") == F.col("_root"), "left")
            .select(
                "root",
                F.col("_next").alias("up"),
                (F.col("leaves") + F.coalesce("_l", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("_s", F.lit(0))).alias("saved"),
            ),
            "gathered",
        )
        reach *= 2
    return tree.drop("up")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv, at, id, bytes; at counts from 1 without gaps).

    node and parent (names; the root's parent is null), turn (the last turn's name), depth,
    conv_id (the smallest member, that is conversation that begins so), parent_conv_id, n_convs,
    n_children, n_leaves (nodes without children in the subtree, which has its top), saved
    (each node's members but one times its last turn's bytes, over the subtree), ends_sha256 (of
    the members that end here, in ascending order, joined by commas).

    A turnless conversation is a row whose id is null, at place 0: it ends at the root. Without
    rows there is no node. Ends are kept in pieces, so that no row grows with a node's members.
    """
    blocks = materialise(_blocks(turns), "prefixes")
    longest = blocks.agg(F.max("last")).first()[0] or 0
    level = F.col("level")
    depth = F.col("block") * WIDTH + level
    size = F.coalesce(*[F.when(level == i + 1, F.col(f"{t}.bytes")) for i, t in enumerate(_T)], F.lit(0))
    turn = F.coalesce(*[F.when(level == i + 1, F.col(f"{t}.id")) for i, t in enumerate(_T)])
    nodes = _rollup(blocks, "count(*) AS n_convs, min(conv) AS conv_id, max(total) AS deepest")
    nodes = materialise(
        nodes.withColumns(
            {
                "node": _node(level),
                "parent": F.when(level > 0, _node(level - 1)),
                "turn": turn,
                "depth": depth,
                "leaf": (F.col("deepest") == depth).cast("bigint"),
                "saved": (F.col("n_convs") - 1) * size,
            }
        ).drop("deepest"),
        "nodes",
    )
    values = nodes.select("prior", "block", "level", "node", *_T, F.col("leaf").alias("leaves"), "saved")
    if longest:
        further = _gathered(nodes, longest).toDF("_root", "_l", "_s")
        values = values.join(further, F.col("node") == F.col("_root"), "left").withColumns(
            {"leaves": F.col("leaves") + F.coalesce("_l", F.lit(0)), "saved": F.col("saved") + F.coalesce("_s", F.lit(0))}
        )
    sums = _rollup(values, "sum(leaves) AS n_leaves, sum(saved) AS saved").select(_node(level).alias("node"), "n_leaves", "saved")
    # Conversations that end at a node: their block's last turn.
    turns_here = sum((F.col(t).isNotNull().cast("int") for t in _T), F.lit(0))
    ends = blocks.where("block = last").select(_node(turns_here).alias("node"), "conv", F.floor(F.col("conv") / STRETCH).alias("stretch"))
    listed = F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",")
    ends = ends.groupBy("node", "stretch").agg(listed.alias("ids"))
    digests = common.sha256_of_pieces(ends, "node", ["stretch"], "ids", ",").toDF("node", "ends_sha256")
    kids = nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "node")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    plain = nodes.select("node", "parent", "turn", "depth", "conv_id", "n_convs")
    return (
        plain.join(sums, "node")
        .join(kids, "node", "left")
        .join(digests, "node", "left")
        .join(above, "parent", "left")
        .withColumns(
            {
                "n_children": F.coalesce("n_children", F.lit(0)),
                "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)),
            }
        )
    )


def with_text(nodes: DataFrame, rows: DataFrame, role: str, text: str) -> DataFrame:
    """``nodes`` with the role and text of their last turn, from the rows that the turns came from."""
    said = rows.select(turn_name(F.col(role), F.col(text)).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("last_role"), F.coalesce(F.col(text), F.lit("")).alias("last_text"))
    return nodes.join(said.dropDuplicates(["turn"]), "turn", "left")
