"""The risk reports over the feature table or the scored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.rounding import half_away
from riskloom.operators import ordering
from riskloom.schemas import KEY, LABEL, SCORE

# Columns of the most-delinquent report.
TOP_COLUMNS = [
    "loan_app_id",
    "score_v3",
    "bureau",
    "max_dpd",
    "num_trades",
    "total_sanctioned_amount",
    "emi_txn_count",
]


def band_distribution(table: DataFrame) -> DataFrame:
    """Applicants per risk band and their percentage. The grand total runs over the few band rows."""
    bands = table.groupBy("risk_band").agg(F.count("*").alias("applicants"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = F.lit(100.0) * F.col("applicants") / F.sum("applicants").over(everything)
    return bands.select("risk_band", "applicants", half_away(share, 1).alias("pct")).orderBy(
        "risk_band"
    )


def band_profile(table: DataFrame) -> DataFrame:
    """Mean score, delinquency, credits and minimum balance per risk band."""
    averages = {
        "avg_score": "score_v3",
        "avg_max_dpd": "max_dpd",
        "avg_total_credits": "total_credits",
        "avg_min_balance": "min_balance",
    }
    return (
        table.groupBy("risk_band")
        .agg(*[half_away(F.avg(column), 2).alias(name) for name, column in averages.items()])
        .orderBy("risk_band")
    )


def top_delinquent(table: DataFrame, rows: int = 10) -> DataFrame:
    """The applicants with the deepest delinquency, lowest score first among equals."""
    return (
        table.select(*TOP_COLUMNS)
        .orderBy(
            F.col("max_dpd").desc_nulls_last(), F.col("score_v3").asc_nulls_last(), F.col(KEY).asc()
        )
        .limit(rows)
    )


def _default_rate_pct() -> Column:
    return half_away(F.lit(100.0) * F.avg(LABEL), 2).alias("default_rate_pct")


def _average_pd() -> Column:
    return half_away(F.avg(SCORE), 4).alias("avg_model_pd")


def default_rate_by_band(scored: DataFrame) -> DataFrame:
    """Observed default rate and mean model PD per risk band."""
    return (
        scored.groupBy("risk_band")
        .agg(F.count("*").alias("applicants"), _default_rate_pct(), _average_pd())
        .orderBy("risk_band")
    )


def pd_quantiles(scored: DataFrame, buckets: int = 5, name: str = "pd_quintile") -> DataFrame:
    """Applicants, mean model PD and observed default rate per PD quintile (NTILE)."""
    narrow = scored.select(KEY, SCORE, LABEL)
    order = [F.col(SCORE).asc_nulls_last(), F.col(KEY).asc_nulls_last()]
    return (
        ordering.with_ntile(narrow, order, buckets, name)
        .groupBy(name)
        .agg(F.count("*").alias("applicants"), _average_pd(), _default_rate_pct())
        .orderBy(name)
    )


def report_pack(table: DataFrame) -> dict[str, DataFrame]:
    """All reports the table allows: the last two need a scored table."""
    reports = {
        "risk_band_distribution": band_distribution(table),
        "risk_band_profile": band_profile(table),
        "top_delinquent": top_delinquent(table),
    }
    if SCORE in table.columns:
        reports["default_rate_by_band"] = default_rate_by_band(table)
        reports["pd_quintiles"] = pd_quantiles(table)
    return reports
