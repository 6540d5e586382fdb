"""Quality rules with thresholds that follow the corpus.

A document has four measures. For each language and source their distribution is kept as a
mergeable sketch: counts in buckets whose width is a sixteenth of their value, so sketches of
partitions, sources or days add up bucket by bucket, and a quantile read from one is at most
a sixteenth below the true one. A document is rejected when a measure lies far beyond what is
usual in its own language and source; a small group leans on the wider one it is part of.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm import common
from windrow.session import materialise

#: Measures, in millionths: the percentile that says what is usual, how many times its distance
#: from the median is far, and the least distance that is, for groups that hardly vary.
UPPER = {
    "symbols": (75, 3, 20_000),
    "dup_lines": (95, 3, 300_000),
    "repeats": (95, 3, 200_000),
    "word_length": (75, 3, 700_000),
}
#: The same below: words may be too short too.
LOWER = {"word_length": (25, 3, 1_200_000)}

#: A group's limits count as much as the group has documents, those of the next wider group as much as this many.
PRIOR = 100

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8


def _again(at: str) -> Column:
    """Of (hash, place) in order, the places whose hash a neighbour has too."""
    like = lambda x, j: F.coalesce(F.get(F.col(at), j)["g"] == x["g"], F.lit(False))
    return F.transform(F.filter(at, lambda x, i: like(x, i + 1) | like(x, i - 1)), lambda x: x["i"])


def _covered(starts: str) -> Column:
    """Words in the windows that begin at ``starts``, in order."""
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    cover = lambda a, s: F.struct(
        (s + WINDOW).alias("end"), (a["n"] + s + WINDOW - F.greatest(a["end"], s)).alias("n")
    )
    return F.aggregate(starts, none, cover, lambda a: a["n"])


def measures(docs: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``keys`` and the base measures of every row, over the whole text.

    Windows are compared by 64-bit hashes of their eight words within one document. The cheap
    look for any repeated hash comes first, so few documents are sorted.
    """
    out = docs.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.coalesce(F.col(text), F.lit("")).alias("_t")
    )
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.select("*", common.words(F.col("_t")).alias("_w"), lines.alias("_l"))
    out = out.select(
        *[f"_k{i}" for i in range(len(keys))],
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_lines"),
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_g"),
    )
    # Hashes of one word, then of two, four and eight.
    for width in (1, 2, 4):
        ahead = F.slice("_g", width + 1, F.size("_g"))
        out = out.withColumn("_g", F.zip_with("_g", ahead, lambda a, b: F.xxhash64(a, b)))
    out = out.withColumn("_g", F.slice("_g", 1, F.greatest(F.size("_g") - WINDOW + 1, F.lit(0))))
    # Own columns for what a lambda refers to, or it would be computed for each element.
    placed = F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    out = out.withColumn("_at", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), placed)).drop("_g")
    out = out.withColumn("_starts", F.sort_array(_again("_at")))
    repeats = F.when(F.col("_at").isNull(), F.lit(0)).otherwise(_covered("_starts"))
    return out.select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeats.cast("long").alias("n_repeat_words"),
        "n_lines",
    )


def _parts() -> dict[str, Column]:
    share = lambda a, b: F.expr(f"coalesce((1000000 * {a}) div nullif({b}, 0), 0)")
    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words"),
    }


def bucket(value: Column) -> Column:
    """The lower edge of a value's bucket: its five leading binary digits."""
    spare = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def sketches(measured: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group, measure and bucket with its count. Sketches add up by summing counts."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), bucket(v).alias("bucket")) for m, v in _parts().items()])
    )
    return (
        measured.select(*by, pairs.alias("p")).groupBy(*by, "p.measure", "p.bucket").agg(F.count("*").alias("n"))
    )


def merge(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def limits(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group: its size and the largest and least usual value of each measure, from its own documents.

    The windows run over the buckets of one group and measure, at most some hundreds.
    """
    w = Window.partitionBy(*by, "measure")
    below = F.sum("n").over(w.orderBy("bucket"))
    percentile = lambda p: F.min(F.when(100 * F.col("below") >= p * F.col("total"), F.col("bucket")))
    of = lambda table, i: F.coalesce(*[F.when(F.col("measure") == m, F.lit(x[i])) for m, x in table.items()], F.lit(50))
    read = (
        sketch.select("*", below.alias("below"), F.sum("n").over(w).alias("total"))
        .groupBy(*by, "measure")
        .agg(
            F.first("total").alias("size"),
            percentile(50).alias("mid"),
            percentile(of(UPPER, 0)).alias("high"),
            percentile(of(LOWER, 0)).alias("low"),
        )
    )
    most = {
        f"most_{m}": F.col("high") + F.greatest(far * (F.col("high") - F.col("mid")), F.lit(guard))
        for m, (_, far, guard) in UPPER.items()
    }
    least = {
        f"least_{m}": F.greatest(F.col("mid") - F.greatest(far * (F.col("mid") - F.col("low")), F.lit(guard)), F.lit(0))
        for m, (_, far, guard) in LOWER.items()
    }
    return read.groupBy(*by).agg(
        F.max("size").alias("size"),
        *[F.max(F.when(F.col("measure") == n.split("_", 1)[1], v)).cast("bigint").alias(n) for n, v in (most | least).items()],
    )


def judge(docs: DataFrame, doc_id: str, text: str, groups: Sequence[str]) -> DataFrame:
    """Every row with its measures, ``base_failed`` and ``kept``.

    ``groups`` are the columns that set thresholds, widest first. A group's limits are drawn
    towards those of the next wider one, at last of all rows, the more the fewer rows it has.
    A null in a group column is a group of its own. Null texts count as empty: no words, so
    the base rule fails. Equal rows get equal verdicts; an empty table gives an empty result.
    The thresholds cover all rows, whatever the base rule says of them.
    """
    names = [f"_g{i}" for i in range(len(groups))]
    keyed = docs.withColumns({n: F.col(g) for n, g in zip(names, groups)})
    keyed = keyed.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), *names)
    measured = materialise(measures(keyed, ["doc_id", *names], "_text"), "measures")
    finest = materialise(sketches(measured, names), "sketches")
    out = measured.withColumns(_parts())
    sides = [*[f"most_{m}" for m in UPPER], *[f"least_{m}" for m in LOWER]]
    for k in range(len(names) + 1):
        by = names[:k]
        found = limits(finest if k == len(names) else merge(finest, by), by)
        found = found.select(
            *[F.col(b).alias(f"_of{b}") for b in by], F.col("size").alias("_size"), *[F.col(x).alias(f"_own_{x}") for x in sides]
        )
        # A row for each group of sources, or one row.
        on, width = F.lit(True), F.lit(256)
        for b in by:
            on &= out[b].eqNullSafe(found[f"_of{b}"])
            width = width + 4 * F.coalesce(F.length(F.col(f"_of{b}").cast("string")), F.lit(0))
        out = out.join(common.broadcast_if_bounded(found, width) if k else F.broadcast(found), on, "left")
        drawn = lambda x: F.expr(f"(_size * _own_{x} + {PRIOR} * {x}) div (_size + {PRIOR})")
        out = out.withColumns({x: drawn(x) if k else F.col(f"_own_{x}") for x in sides})
        out = out.drop("_size", *[f"_own_{x}" for x in sides], *[f"_of{b}" for b in by])
    usual = F.lit(True)
    for m in UPPER:
        usual &= F.col(m) <= F.col(f"most_{m}")
    for m in LOWER:
        usual &= F.col(m) >= F.col(f"least_{m}")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & usual).alias("kept"),
    )
