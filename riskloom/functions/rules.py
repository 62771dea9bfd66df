"""Row-local risk rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days-past-due levels that get a flag, and the band limits
# (deep delinquency first, then score limits from worst to best).
DPD_LEVELS = (30, 60, 90)
BAND_5_FROM_DPD = 90
BAND_4_BELOW_SCORE = 500
BAND_3_BELOW_SCORE = 650
BAND_2_BELOW_SCORE = 750

# Statement wording looked for, by feature.
SALARY_TEXT = "salary"
EMI_TEXT = "emi"
CASH_TEXT = "cash withdrawal"


def at_least(value: Column, level: int) -> Column:
    """1 when ``value >= level``; 0 otherwise, also for null."""
    return F.coalesce((value >= level).cast("int"), F.lit(0))


def is_type(txn_type: Column, code: str) -> Column:
    """1 for the transaction type ``code`` (``CR`` / ``DR``), 0 for any other or null."""
    return F.when(txn_type == code, 1).otherwise(0)


def mentions(description: Column, text: str, whole_words: bool = False) -> Column:
    """1 when the description holds ``text`` in any case; null counts as 0.

    A plain substring by default (``emi`` is found in "Insurance Premium");
    ``whole_words=True`` asks for word boundaries.
    """
    lowered = F.lower(description)
    hit = lowered.rlike(rf"\b{text}\b") if whole_words else lowered.contains(text)
    return F.coalesce(hit.cast("int"), F.lit(0))


def amount_of_type(amount: Column, txn_type: Column, code: str) -> Column:
    """The amount for rows of the given type, 0.0 for the others."""
    return F.when(txn_type == code, amount).otherwise(F.lit(0.0))


def risk_band(score: Column, max_dpd: Column) -> Column:
    """Rule band 1 (best) to 5; the first matching rule wins and a null score gives 1."""
    return (
        F.when(max_dpd >= BAND_5_FROM_DPD, 5)
        .when(score < BAND_4_BELOW_SCORE, 4)
        .when(score < BAND_3_BELOW_SCORE, 3)
        .when(score < BAND_2_BELOW_SCORE, 2)
        .otherwise(1)
    )
