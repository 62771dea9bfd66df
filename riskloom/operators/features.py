"""Trades and transactions -> one feature row per applicant.

Every aggregate has a partial form, so an applicant holding a large share of the rows is reduced
before the shuffle; the distinct trade count is first spread on (applicant, trade reference).

Header values (score, bureau, bank, account) repeat on every row of a flat table. Aggregating those
strings along with the numbers makes Spark sort the rows instead of hashing them. Where the headers
exist as their own, much smaller table, pass them as ``headers``: the items are then hashed, and
the headers join the finished rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import coerce, rules
from riskloom.operators.flatten import POSITION
from riskloom.schemas import KEY

BUREAU_HEADERS = ["score_v3", "bureau"]
BANKING_HEADERS = ["bank_name", "acct_num"]


def first_known(value: Column, order: list[str]) -> Column:
    """Aggregate: first non-null ``value`` in the given order."""
    if not order:
        raise ValueError("a first value needs an order: pass the columns that number the rows")
    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return F.min_by(value, F.when(value.isNotNull(), position))


def _units(value: Column, money_scale: int) -> Column:
    units = value * float(10**money_scale) + F.lit(0.5)
    too_large = F.raise_error(F.concat(F.lit("amount beyond 64-bit minor units: "), value.cast("string")))
    return (
        F.when(units.isNull(), None)
        .when(F.abs(units) < float(2**63), F.floor(units))
        .otherwise(too_large.cast("bigint"))
    )


def money_sum(value: Column, money_scale: int | None) -> Column:
    """Aggregate: sum that is 0.0 over nothing.

    A plain double sum by default. For amounts of at most ``money_scale`` decimals the sum of whole
    minor units is exact whatever the row order (an overflow of bigint is an error).
    """
    if money_scale is None:
        return F.coalesce(F.sum(value), F.lit(0.0))
    total = F.sum(_units(value, money_scale)) / F.lit(float(10**money_scale))
    return F.coalesce(total, F.lit(0.0))


def money_avg(value: Column, money_scale: int | None) -> Column:
    """Aggregate: mean, exact in its sum when ``money_scale`` is given."""
    if money_scale is None:
        return F.avg(value)
    total = F.sum(_units(value, money_scale)) / F.lit(float(10**money_scale))
    return total / F.when(F.count(value) > 0, F.count(value))


def _order(df: DataFrame, order: list[str] | None) -> list[str]:
    if order is not None:
        return order
    return POSITION if set(POSITION) <= set(df.columns) else []


def _with_headers(features: DataFrame, headers: DataFrame | None, columns: list[str]) -> DataFrame:
    """Header columns put right after the key, joined from ``headers`` unless already there."""
    features = features.where(F.col(KEY).isNotNull())
    if headers is None:
        return features
    joined = features.join(headers.select(KEY, *columns), KEY, "inner")
    return joined.select(KEY, *columns, *[c for c in features.columns if c != KEY])


def bureau_features(
    trades: DataFrame,
    order: list[str] | None = None,
    money_scale: int | None = None,
    headers: DataFrame | None = None,
    approximate_trade_count: bool = False,
) -> DataFrame:
    """Score, bureau, trade count, delinquency and balance features per applicant.

    ``headers`` (one row per applicant) replaces the header columns of ``trades``.
    """
    order = _order(trades, order)
    count = F.approx_count_distinct if approximate_trade_count else F.count_distinct
    own = [] if headers is not None else BUREAU_HEADERS
    balance, sanctioned = F.col("current_balance"), F.col("sanctioned_amount")
    features = trades.groupBy(KEY).agg(
        *[first_known(F.col(c), order).alias(c) for c in own],
        count(F.col("trade_ref_num")).alias("num_trades"),
        F.max("dpd").alias("max_dpd"),
        F.avg("dpd").alias("avg_dpd"),
        money_sum(coerce.known(balance), money_scale).alias("total_current_balance"),
        money_sum(coerce.known(sanctioned), money_scale).alias("total_sanctioned_amount"),
    )
    flags = [rules.at_least(F.col("max_dpd"), n).alias(f"dpd_{n}_plus") for n in rules.DPD_LEVELS]
    return _with_headers(features.select("*", *flags), headers, BUREAU_HEADERS)


def flag_transactions(transactions: DataFrame, whole_words: bool = False) -> DataFrame:
    """Transactions with credit/debit flags and amounts and the wording flags."""
    kind, text, value = F.col("txn_type"), F.col("txn_desc"), coerce.known(F.col("txn_amount"))
    return transactions.select(
        "*",
        rules.is_type(kind, "CR").alias("is_credit"),
        rules.is_type(kind, "DR").alias("is_debit"),
        rules.mentions(text, rules.SALARY_TEXT, whole_words).alias("is_salary"),
        rules.mentions(text, rules.EMI_TEXT, whole_words).alias("is_emi"),
        rules.mentions(text, rules.CASH_TEXT, whole_words).alias("is_cash_withdrawal"),
        rules.amount_of_type(value, kind, "CR").alias("credit_amt"),
        rules.amount_of_type(value, kind, "DR").alias("debit_amt"),
    )


def banking_features(
    transactions: DataFrame,
    order: list[str] | None = None,
    money_scale: int | None = None,
    headers: DataFrame | None = None,
    whole_words: bool = False,
) -> DataFrame:
    """Cash-flow and balance features per applicant. Wording counts ignore the direction.

    ``headers`` (one row per applicant) replaces the header columns of ``transactions``.
    """
    order = _order(transactions, order)
    own = [] if headers is not None else BANKING_HEADERS
    balance = coerce.known(F.col("bal_after"))
    features = (
        flag_transactions(transactions, whole_words)
        .groupBy(KEY)
        .agg(
            *[first_known(F.col(c), order).alias(c) for c in own],
            F.count(coerce.known(F.col("txn_amount"))).alias("txn_count"),
            money_sum(F.col("credit_amt"), money_scale).alias("total_credits"),
            money_sum(F.col("debit_amt"), money_scale).alias("total_debits"),
            F.sum("is_salary").alias("salary_credits_count"),
            F.sum("is_emi").alias("emi_txn_count"),
            F.sum("is_cash_withdrawal").alias("cash_withdrawal_count"),
            money_avg(balance, money_scale).alias("avg_balance"),
            F.min(balance).alias("min_balance"),
            F.max(balance).alias("max_balance"),
        )
    )
    return _with_headers(features, headers, BANKING_HEADERS)


def join_features(bureau: DataFrame, banking: DataFrame) -> DataFrame:
    """Applicants known to both sides, with the risk band. Both inputs come out of a groupBy on the
    key, so the join adds no shuffle."""
    joined = bureau.join(banking, KEY, "inner")
    return joined.withColumn("risk_band", rules.risk_band(F.col("score_v3"), F.col("max_dpd")))


def build_features(
    trades: DataFrame,
    transactions: DataFrame,
    money_scale: int | None = None,
    trade_order: list[str] | None = None,
    transaction_order: list[str] | None = None,
) -> DataFrame:
    """The applicant feature table of two flat tables: one row per applicant, 23 columns."""
    return join_features(
        bureau_features(trades, trade_order, money_scale),
        banking_features(transactions, transaction_order, money_scale),
    )
