"""Repair of conversations' structure by the cheapest edits, with Four-Russians block tables.

Role initials must come to read ``(s?(ua)+)?``. Between rows a conversation is in one of four
states, and what the rest of it costs from each state is a vector. Less their smallest entry,
few vectors exist, so for every vector and every block of ``BLOCK`` symbols the vector in front of
the block and the cost added are tables; a conversation is read from its end one block a lookup.
Then blocks are expanded from its beginning, the other way round: the vectors inside one are
made again, and at each row the least letter among the cheapest edits is taken, so that ties
never depend on where blocks begin.

Rows meet the tables as one byte each. A conversation is cut into stretches of rows; a task
reads a conversation's stretches in order and holds one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm import common
from windrow.session import materialise

#: Fixed by the task: costs of the edits, and what a truncated row adds that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Symbols in a block, and places in a stretch.
BLOCK, STRETCH = 4, 1024

#: States: nothing yet, behind the system row, behind a user row, behind a pair.
START, SYSTEM, USER, PAIR = range(4)

#: From each state, the state behind a row of the role that is due: user, user, assistant, user.
DUE = (USER, USER, PAIR, USER)

#: Classes of roles by their initials, all others last; the state behind a row that is kept.
INITIALS = "sua"
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): PAIR, (PAIR, 1): USER}
LEGAL = ((0, 1), (1, 2), (2, 1))

#: A row's code is its class plus 4 for a truncated one, plus 8 for one that must go. Symbols
#: are 0 for rows that must go, and else 1 to 8.
SYMBOLS = 9
SYMBOL_OF = np.array([1, 3, 5, 7, 2, 4, 6, 8, 0, 0, 0, 0], np.uint8)

WHITE = " \t\n\x0b\x0c\r"


def edits(symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, state behind) of what may be done with a row."""
    yield "D", DELETE, state
    if symbol:
        kind, truncated = divmod(symbol - 1, 2)
        if (state, kind) in KEPT:
            yield "K", TRUNCATED * truncated, KEPT[state, kind]
        yield "R", REROLE + TRUNCATED * truncated, DUE[state]


def _with_inserts(costs: list[int]) -> list[int]:
    for _ in costs:
        costs = [min(c, INSERT + costs[DUE[q]]) for q, c in enumerate(costs)]
    return costs


class Tables:
    """Vectors of costs to go, by number; steps over one symbol and over one block."""

    def __init__(self):
        far = 1 << 20
        self.vectors: list[tuple[int, ...]] = []
        numbers: dict[tuple[int, ...], int] = {}

        def number(costs: list[int]) -> tuple[int, int]:
            low = min(costs)
            vector = tuple(c - low for c in costs)
            if vector not in numbers:
                numbers[vector] = len(self.vectors)
                self.vectors.append(vector)
            return numbers[vector], low

        self.end, self.end_cost = number(_with_inserts([0, far, far, 0]))
        self.step: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows meanwhile
            self.step.append(
                [
                    number(_with_inserts([min(c + vector[to] for _, c, to in edits(x, q)) for q in range(4)]))
                    for x in range(SYMBOLS)
                ]
            )
        to, cost = (np.array([[s[i] for s in row] for row in self.step], np.int32) for i in (0, 1))
        digits = np.arange(SYMBOLS**BLOCK)[:, None] // SYMBOLS ** np.arange(BLOCK) % SYMBOLS
        at = np.arange(len(self.vectors), dtype=np.int32)[:, None] + np.zeros(len(digits), np.int32)
        total = np.zeros_like(at)
        for i in reversed(range(BLOCK)):
            total += cost[at, digits[:, i]]
            at = to[at, digits[:, i]]
        self.block_to, self.block_cost = at.tolist(), total.tolist()

    def bounds(self, symbols: np.ndarray, right: int) -> tuple[list[int], int, int]:
        """Vectors behind each block, from the right end; the vector in front of all, and the cost added."""
        whole = len(symbols) // BLOCK * BLOCK
        behind, total = [], 0
        if whole < len(symbols):
            behind.append(right)
            for x in reversed(symbols[whole:].tolist()):
                right, cost = self.step[right][x]
                total += cost
        codes = symbols[:whole].reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK))
        for code in reversed(codes.tolist()):
            behind.append(right)
            total += self.block_cost[right][code]
            right = self.block_to[right][code]
        return behind, right, total

    def trace(self, symbols: np.ndarray, right: int, state: int) -> tuple[list[tuple[int, str, int]], int]:
        """(row, letter, state behind) of every edit, and the state behind all; inserts go before their row."""
        out = []
        behind, _, _ = self.bounds(symbols, right)
        for at, last in zip(range(0, len(symbols), BLOCK), reversed(behind)):
            block = symbols[at : at + BLOCK].tolist()
            inside, costs = [last], []
            for x in reversed(block):
                to, cost = self.step[inside[-1]][x]
                inside.append(to)
                costs.append(cost)
            for i, x in enumerate(block):
                here, there = self.vectors[inside[len(block) - i]], self.vectors[inside[len(block) - i - 1]]
                added = costs[len(block) - i - 1]
                while True:
                    done = {letter: to for letter, c, to in edits(x, state) if c + there[to] == added + here[state]}
                    if "D" not in done and INSERT + here[DUE[state]] == here[state]:
                        state = DUE[state]
                        out.append((at + i, "I", state))
                        continue
                    letter = min(done)
                    state = done[letter]
                    out.append((at + i, letter, state))
                    break
        return out, state

    def closing(self, state: int) -> list[int]:
        """States behind the inserts at the end of a conversation."""
        out = []
        while state in (SYSTEM, USER):
            state = DUE[state]
            out.append(state)
        return out


@cache
def tables() -> Tables:
    """Made once in each worker."""
    return Tables()


def _items(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column(2)
    return lists.offsets.to_numpy(), lists.values.field(0).to_numpy(), lists.values.field(1).to_numpy()


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of a conversation from its last: the vector behind each, costs and illegal pairs from it on."""
    mine, legal = tables(), np.zeros((4, 4), bool)
    legal[tuple(zip(*LEGAL))] = True
    now, right, total, illegal, following = None, 0, 0, 0, -1
    for batch in batches:
        ends, _, codes = _items(batch)
        rights, costs, pairs = [], [], []
        for i, conv in enumerate(batch.column(0).to_pylist()):
            if conv != now:
                now, right, total, illegal, following = conv, mine.end, mine.end_cost, 0, -1
            own = codes[ends[i] : ends[i + 1]]
            rights.append(right)
            _, right, cost = mine.bounds(SYMBOL_OF[own], right)
            total += cost
            kinds = own & 3
            illegal += int((~legal[kinds[:-1], kinds[1:]]).sum())
            if following >= 0:
                illegal += int(not legal[kinds[-1], following])
            following = int(kinds[0])
            costs.append(total + mine.vectors[right][START])
            pairs.append(illegal)
        more = [pa.array(rights, pa.int32()), pa.array(costs, pa.int64()), pa.array(pairs, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=["conv", "stretch", "items", "behind", "cost", "illegal"])


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of a conversation from its first: one row for every edit."""
    mine = tables()
    now, state = None, START
    for batch in batches:
        ends, places, codes = _items(batch)
        lasts = batch.column("last").to_pylist()
        for start in range(0, batch.num_rows, 256):
            conv_of, at, turn, letters, roles = [], [], [], [], []
            convs = batch.column(0).slice(start, 256).to_pylist()
            for i, conv in enumerate(convs, start):
                if conv != now:
                    now, state = conv, START
                own = slice(ends[i], ends[i + 1])
                found, state = mine.trace(SYMBOL_OF[codes[own]], batch.column("behind")[i].as_py(), state)
                if lasts[i]:
                    found += [(ends[i + 1] - ends[i] - 1, "I", to) for to in mine.closing(state)]
                here = places[own].tolist()
                for k, (row, letter, to) in enumerate(found):
                    conv_of.append(conv)
                    at.append(here[row])
                    turn.append(k)
                    letters.append(letter)
                    roles.append(("user" if to == USER else "assistant") if letter in "IR" else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv_of, pa.string()), pa.array(at, pa.int64()), pa.array(turn, pa.int32()), pa.array(letters, pa.string()), pa.array(roles, pa.string())],
                names=["conv", "at", "k", "edit", "role"],
            )


def damaged(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, at, turn, role, text: the rows after damage that only depends on conversation and turn.

    crc32 of ``conv_id:turn`` modulo 20 decides: 0 drops a row, 1 empties its text, 2 takes out
    the marks .!?, 3 puts it there twice, 4 makes its role user. A null of any column is one
    space, also in ``conv``, the conversation as text. ``at`` orders the rows of a conversation: by
    turn, nulls first, rows of one turn by a hash of role and text, a row and its copy together.
    """
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    named = rows.select(
        some(conv_id).alias("conv"), F.col(turn).alias("turn"), some(role).alias("role"), some(text).alias("text"), some(turn).alias("said")
    )
    named = named.withColumn("name", _content("role", "text"))
    ranked = common.with_rank(named, "conv", "turn", "name", into="ranked-turns")
    draw = F.crc32(F.concat("conv", F.lit(":"), "said").cast("binary")) % 20
    copies = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    marks = F.translate("text", ".!?", "")
    return ranked.withColumn("draw", draw).where("draw <> 0").withColumn("copy", F.explode(copies)).select(
        "conv",
        (F.col("_rank") * 2 + F.col("copy")).alias("at"),
        "turn",
        F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, marks).otherwise(F.col("text")).alias("text"),
    )


def _content(role: str, text: str) -> Column:
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)


def faults(rows: DataFrame) -> DataFrame:
    """conv, at, turn, class, fault of each row: blank, duplicate or truncated, whichever comes first, or null.

    A row is a duplicate when its conversation has its role and text earlier. ``at`` is unique in
    the table, so what comes first is joined back on it and no text that is repeated very often
    meets in one task.
    """
    stripped = F.trim("text", F.lit(WHITE))
    kind = F.coalesce(*[F.when(F.substring("role", 1, 1) == c, F.lit(i)) for i, c in enumerate(INITIALS)], F.lit(len(INITIALS)))
    narrow = rows.select(
        "conv", "at", "turn", kind.alias("class"), (stripped == "").alias("blank"),
        (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut"), _content("role", "text").alias("name"),
    )
    narrow = materialise(narrow, "narrow-turns")
    first = narrow.groupBy("conv", "name").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    return narrow.join(first, "at", "left").select("conv", "at", "turn", "class", fault.alias("fault"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations and their edits, of ``rows``: conv (text), at (unique, increasing), turn, role, text.

    First a row per conversation: conv, gaps (whole numbers between its least and largest turn
    that no row has; 0 without turns), blank, duplicate, truncated, illegal (neighbours whose
    role initials are not su, ua or au), cost and audit (letters of the cheapest edits in order,
    the least of equal ones: D delete, I insert, K keep, R rerole). Then a row per edit: conv, at,
    k, edit, role, text, by (at, k); role and text are null where a row is deleted. An inserted row
    has an empty text.
    """
    known = materialise(faults(rows), "faults")
    marked = {f: F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")}
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps")
    counts = known.groupBy("conv").agg(gaps, *marked.values())
    must = F.col("fault").isin("blank", "duplicate")
    code = F.col("class") + F.when(must, 8).when(F.col("fault") == "truncated", 4).otherwise(0)
    stretches = known.groupBy("conv", F.floor(F.col("at") / STRETCH).alias("stretch")).agg(
        F.sort_array(F.collect_list(F.struct("at", code.cast("tinyint").alias("code")))).alias("items")
    )
    items = "conv string, stretch bigint, items array<struct<at:bigint,code:tinyint>>"
    backward = stretches.repartition("conv").sortWithinPartitions("conv", F.desc("stretch"))
    backward = materialise(backward.mapInArrow(_backward, f"{items}, behind int, cost bigint, illegal bigint"), "costs")
    ends = backward.groupBy("conv").agg(
        F.min_by("cost", "stretch").alias("cost"), F.min_by("illegal", "stretch").alias("illegal"), F.max("stretch").alias("_last")
    )
    forward = backward.join(ends.select("conv", "_last"), "conv").select(
        "conv", "stretch", "items", "behind", (F.col("stretch") == F.col("_last")).alias("last")
    )
    forward = forward.repartition("conv").sortWithinPartitions("conv", "stretch")
    edited = materialise(forward.mapInArrow(_forward, "conv string, at bigint, k int, edit string, role string"), "edits")
    # A letter a row: stretch by stretch, then all of a conversation.
    letters = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "k", "edit"))), lambda e: e["edit"]), "")
    audit = edited.groupBy("conv", F.floor(F.col("at") / STRETCH).alias("stretch")).agg(letters.alias("audit"))
    audit = audit.groupBy("conv").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("stretch", "audit"))), lambda e: e["audit"]), "").alias("audit")
    )
    summary = counts.join(ends.drop("_last"), "conv").join(audit, "conv")
    old = rows.select(F.col("at").alias("_at"), F.col("role").alias("_role"), F.col("text").alias("_text"))
    stays = F.col("edit").isin("K", "R")
    repaired = edited.join(old, (F.col("at") == F.col("_at")) & (F.col("edit") != "I"), "left").select(
        "conv", "at", "k", "edit",
        F.when(F.col("edit") == "K", F.col("_role")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("edit") == "I", F.lit("")).when(stays, F.col("_text")).alias("text"),
    )
    return summary, repaired
