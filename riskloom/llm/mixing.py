"""Mixing sources to target weights by fitting a budget of words exactly (operator 5).

Targets: every source has a weight and together they share a budget, a multiple of all words. No source
gets more than ``most`` times what it has; what it can't take is shared among the others by weight until
none is above. Sources are ordered by code point, null last; weights repeat in that order.

Fit: what a target holds of whole passes over its source, every document gets. For the rest the
documents are counted by their exact size, and a bounded knapsack chooses how many documents of each
size to take once more: first the same share of each size, then, while the remaining budget is above
``DP_WORDS``, further documents of the largest sizes that fit, and for what then remains a dynamic
program over the counts still free finds the sum that comes nearest from below.

Choice: of each size so many documents are taken, by a seeded hash of the id. A size may belong to a
third of all documents, so hashes are counted in bins first, and only the bin where the count runs out
is ordered. Reruns agree.

Null and empty texts have size 0 and nothing is taken of them. Repeated rows are separate documents;
which of two equal rows is taken is no matter. A source without words has target 0. Only the id, text
and source columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.staging import stage

#: Remaining budget, in words, from which on the dynamic program takes over.
DP_WORDS = 65_536
#: Bins of the seeded hash.
BINS = 1 << 12


def n_words(text: str) -> Column:
    """Number of runs of characters that aren't ASCII white space."""
    spaced = F.concat(F.lit(" "), F.coalesce(F.col(text), F.lit("")))
    return (F.size(F.split(F.regexp_replace(spaced, r"[\x20\x09-\x0D]+$", ""), r"[\x20\x09-\x0D]+")) - 1).cast("long")


def targets(sizes: DataFrame, weights: list[int], percent: int, most: int) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    A source stops at its cap exactly if the level, that is words per weight, reaches cap / weight. In
    the order of cap / weight the level is what the sources before leave, over the weights from there on.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int"))
    totals = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = totals.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("_before"),
        F.sum("weight").over(after).alias("_weights"),
        (F.sum("source_size").over(everything) * percent).alias("_budget"),
    ).withColumn("_level", (F.col("_budget") - F.col("_before") * 100) / (F.col("_weights") * 100))
    # The level of the first source that stays below its cap holds for it and all behind it.
    open_level = F.when(F.col("_level") * F.col("weight") < F.col("cap"), F.col("_level"))
    level = F.first(open_level, ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, 0))
    return filled.select(
        "source", "source_size",
        F.coalesce(level * F.col("weight"), F.col("cap").cast("double")).alias("target"),
    )


def fit_counts(size: np.ndarray, count: np.ndarray, budget: int) -> np.ndarray:
    """How many of the ``count`` documents of each size to take for a sum near ``budget``, not above."""
    take = np.zeros(len(size), np.int64)
    whole = int((size * count).sum())
    if budget <= 0 or whole == 0:
        return take
    if budget >= whole:
        return count.copy()
    # Exact whole-number share of each size: count * budget / whole, rounded down.
    take[:] = [int(c) * budget // whole for c in count]
    left = budget - int((take * size).sum())
    for i in np.argsort(-size, kind="stable"):
        if left <= DP_WORDS:
            break
        if 0 < size[i] <= left:
            more = min(int(count[i] - take[i]), (left - DP_WORDS) // int(size[i]) + 1, left // int(size[i]))
            take[i] += max(0, more)
            left -= max(0, more) * int(size[i])
    return take + _knapsack(size, count - take, min(left, DP_WORDS))


def _knapsack(size: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum: free documents of each size whose sizes add up to the most within budget.

    Sums reached so far are the bits of one integer. Counts are split into powers of two; each sum
    remembers the portion that first reached it.
    """
    reached, mask = 1, (1 << (budget + 1)) - 1
    by_sum: dict[int, tuple[int, int]] = {}
    for i in np.argsort(-size, kind="stable"):
        one, rest, portion = int(size[i]), int(free[i]), 1
        rest = min(rest, budget // one) if one > 0 else 0
        while rest > 0 and not reached >> budget & 1:
            portion = min(portion, rest)
            rest -= portion
            grown = (reached << one * portion) & mask & ~reached
            reached |= grown
            data = np.frombuffer(grown.to_bytes(budget // 8 + 1, "little"), np.uint8)
            for total in np.flatnonzero(np.unpackbits(data, bitorder="little")).tolist():
                by_sum[total] = (int(i), portion)
            portion *= 2
    total, take = reached.bit_length() - 1, np.zeros(len(size), np.int64)
    while total > 0:
        i, portion = by_sum[total]
        take[i] += portion
        total -= portion * int(size[i])
    return take


def _fit(groups: DataFrame) -> DataFrame:
    """(source, size, passes, extra) of (source, size, n, source_size, target), source by source."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        total, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        passes = int(target // total) if total else 0
        budget = int(round(target - passes * total))
        extra = fit_counts(rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), budget)
        return pd.DataFrame({"key": rows["key"], "size": rows["size"], "passes": passes, "extra": extra})

    return groups.groupBy("key").applyInPandas(fit, "key string, size long, passes long, extra long")


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: list[int] | None = None,
    percent: int = 150,
    most: int = 2,
    seed: int = 1,
) -> DataFrame:
    """(id, size, source_size, target, times) of every row; ``times`` is how often the mix takes it."""
    docs = df.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.concat(F.when(F.col(source_col).isNull(), "0").otherwise("1"), F.coalesce(source_col, F.lit(""))).alias("key"),
        n_words(text_col).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.length(text_col)).alias("at"),
    )
    docs = stage(docs.withColumn("bin", F.pmod(F.shiftright("at", 8), F.lit(BINS)).cast("int")), "sizes")
    aims = stage(targets(docs.select("source", "size"), weights or [5, 2, 1], percent, most), "targets")
    aims = aims.select(
        F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"), F.coalesce("source", F.lit(""))).alias("key"),
        "source_size", "target",
    )
    binned = docs.groupBy("key", "size", "bin").agg(F.count(F.lit(1)).alias("n"))
    binned = stage(binned, "bins")
    counts = binned.groupBy("key", "size").agg(F.sum("n").alias("n"))
    fitted = _fit(counts.join(aims, "key"))
    before = Window.partitionBy("key", "size").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    plan = binned.join(fitted, ["key", "size"]).select(
        "key", "size", "bin", "n", "passes", (F.col("extra") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("room")
    )
    plan = stage(plan, "plan").join(aims, "key")
    placed = docs.join(plan, ["key", "size", "bin"])
    open_bin = (F.col("room") > 0) & (F.col("room") < F.col("n"))
    order = Window.partitionBy("key", "size", "bin").orderBy("at", "id")
    out = ["id", "size", "source_size", "target"]
    sure = placed.where(~open_bin).select(*out, (F.col("passes") + (F.col("room") > 0).cast("long")).alias("times"))
    ordered = placed.where(open_bin).select(
        *out, (F.col("passes") + (F.row_number().over(order) <= F.col("room")).cast("long")).alias("times")
    )
    return sure.unionByName(ordered).withColumnRenamed("id", id_col)
