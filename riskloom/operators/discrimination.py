"""How well a score separates bad from good: KS, ROC AUC, Gini, decile table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rounding import half_even
from riskloom.operators import ordering
from riskloom.schemas import KEY, LABEL, SCORE


def score_counts(scored: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """``score, bad, good`` per distinct score. Ties collapse here, before any global order."""
    known = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(score).agg(
        F.sum(F.col(label).cast("bigint")).alias("bad"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("good"),
    )


def cumulative_shares(scored: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """Cumulative share of bad and of good rows by descending score, one row per score."""
    counts = score_counts(scored, score, label)
    summed = ordering.running_totals(
        counts, [F.col(score).desc_nulls_last()], {"bad": "bad", "good": "good"}
    )
    return summed.select(
        score,
        "bad",
        "good",
        "cum_bad",
        "cum_good",
        "all_bad",
        "all_good",
        (F.col("cum_bad") / F.greatest("all_bad", F.lit(1))).alias("cum_bad_share"),
        (F.col("cum_good") / F.greatest("all_good", F.lit(1))).alias("cum_good_share"),
    )


def _auc(bad: Column, good: Column) -> Column:
    # Pairs won, in halves: a good row loses to every bad row scored higher and ties with those at
    # the same score. Decimals keep the sum of products exact.
    halves = (2 * F.col("cum_bad") - bad).cast("decimal(19,0)") * good.cast("decimal(19,0)")
    won = F.sum(halves).cast("double") / 2
    pairs = F.max("all_bad").cast("double") * F.max("all_good").cast("double")
    return F.when(pairs > 0, won / pairs)


def discrimination(scored: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """One row ``applicants, bads, roc_auc, gini, ks``; AUC and Gini are null with one class only."""
    shares = cumulative_shares(scored, score, label)
    row = shares.agg(
        F.sum(F.col("bad") + F.col("good")).alias("applicants"),
        F.max("all_bad").alias("bads"),
        _auc(F.col("bad"), F.col("good")).alias("roc_auc"),
        F.max(F.abs(F.col("cum_bad_share") - F.col("cum_good_share"))).alias("ks"),
    )
    return row.select(
        "applicants", "bads", "roc_auc", (2 * F.col("roc_auc") - 1).alias("gini"), "ks"
    )


def ks_statistic(scored: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """One row ``ks``."""
    return discrimination(scored, score, label).select("ks")


def decile_table(
    scored: DataFrame, buckets: int = 10, digits: int | None = 4, score: str = SCORE
) -> DataFrame:
    """How many rows each tenth of the score order holds, its mean score and its share of outcomes 1.

    Decile 1 has the lowest scores; rows without a score are left out.
    """
    narrow = scored.select(KEY, score, LABEL).where(F.col(score).isNotNull())
    order = [F.col(score).asc_nulls_last(), F.col(KEY).asc_nulls_last()]
    binned = ordering.with_quantile(narrow, order, buckets, "pd_decile")
    table = binned.groupBy("pd_decile").agg(
        F.count(KEY).alias("applicants"),
        F.avg(score).alias("avg_pd"),
        F.avg(LABEL).alias("observed_default_rate"),
    )
    if digits is None:
        return table
    return table.select(
        "pd_decile",
        "applicants",
        half_even(F.col("avg_pd"), digits).alias("avg_pd"),
        half_even(F.col("observed_default_rate"), digits).alias("observed_default_rate"),
    )
