"""Pairing bureau and banking documents by file stem, and the quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING_BUREAU = "bureau_missing_file"


def pair_documents(
    bureau: DataFrame, banking: DataFrame, carry_bureau: Sequence[str] = (), carry_banking: Sequence[str] = ()
) -> DataFrame:
    """One verdict per stem: ``stem, loan_app_id, reason``; a null reason means accepted.

    Only the small status columns of the parsed documents take part, so the shuffle on the stem
    never carries items. Columns named to be carried come along, with ``n_trades``; they should be narrow
    (``document_features``). The first reason found is kept: bureau defects, a missing or defective
    bank statement, then empty documents, then differing ids.
    """
    left = bureau.select(
        "stem",
        F.lit(True).alias("has_bureau"),
        F.col("loan_app_id").alias("bureau_id"),
        F.col("reason").alias("bureau_reason"),
        F.col("n_items").alias("n_trades"),
        *carry_bureau,
    )
    right = banking.select(
        "stem",
        F.lit(True).alias("has_banking"),
        F.col("loan_app_id").alias("banking_id"),
        F.col("reason").alias("banking_reason"),
        F.col("n_items").alias("n_txns"),
        *carry_banking,
    )
    reason = (
        F.when(F.col("has_bureau").isNull(), MISSING_BUREAU)
        .when(F.col("bureau_reason").isNotNull(), F.concat(F.lit("bureau_"), "bureau_reason"))
        .when(F.col("has_banking").isNull(), "banking_missing_file")
        .when(F.col("banking_reason").isNotNull(), F.concat(F.lit("banking_"), "banking_reason"))
        .when(F.col("n_trades") == 0, "bureau_empty")
        .when(F.col("n_txns") == 0, "banking_empty")
        .when(F.col("bureau_id") != F.col("banking_id"), "id_mismatch")
    )
    paired = left.join(right, "stem", "full_outer")
    carried = [*carry_bureau, *carry_banking]
    return paired.select(
        "stem",
        F.coalesce("bureau_id", "banking_id").alias("loan_app_id"),
        reason.alias("reason"),
        *(["n_trades", *carried] if carried else []),
    )


def rejects(verdicts: DataFrame) -> DataFrame:
    """The quarantine table: every stem that is left out, with its reason."""
    return verdicts.where(F.col("reason").isNotNull()).select("stem", "loan_app_id", "reason")


def accepted(parsed: DataFrame, rejected: DataFrame) -> DataFrame:
    """Parsed documents that are not in quarantine; ``parsed`` is a written table.

    A document's own defects drop it at the scan. What the other side rejects takes an anti join: read
    from its written table its size is known, and Catalyst broadcasts it below its threshold, so the
    documents are not shuffled; beyond it the same anti join is a sort-merge join.
    """
    sound = parsed.where(F.col("reason").isNull() & (F.col("n_items") > 0))
    return sound.join(rejected.select("stem"), "stem", "left_anti")


def without_statement(bureau: DataFrame, banking: DataFrame) -> DataFrame:
    """Bureau documents that have no bank statement file."""
    return bureau.join(banking.select("stem"), "stem", "left_anti")


def reject_counts(verdicts: DataFrame) -> DataFrame:
    """``reason, documents`` for every reason that occurs."""
    return rejects(verdicts).groupBy("reason").agg(F.count("*").alias("documents"))


def skipped_count(verdicts: DataFrame) -> DataFrame:
    """One row: applicants skipped. A statement without a bureau file is no applicant."""
    skipped = F.col("reason").isNotNull() & (F.col("reason") != MISSING_BUREAU)
    return verdicts.agg(F.count_if(skipped).alias("skipped"))
