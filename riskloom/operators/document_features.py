"""The feature table straight from parsed documents.

Each document is reduced to one narrow row next to its scan, before the join that pairs documents. That join
and the aggregate after it carry these rows only; no exchange holds items. The one thing that rows of fixed
width cannot carry is the distinct count of trade references: they are exploded next to the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import coerce, rules
from riskloom.operators import pairing
from riskloom.operators.features import BANKING_HEADERS, BUREAU_HEADERS, first_known
from riskloom.schemas import KEY

BUREAU, BANKING = "bureau_facts", "banking_facts"

Value = Callable[[Column], Column]


def _money(items: str, value: Value, money_scale: int | None) -> Column:
    """Sum over a document's items, unknown ones left out: whole minor units, or a double without a scale.

    Null where units go beyond 64 bits. The caller makes that an error once the document is accepted.
    """
    if money_scale is None:
        return F.aggregate(items, F.lit(0.0), lambda total, i: total + F.coalesce(value(i), F.lit(0.0)))

    def add(total: Column, item: Column) -> Column:
        units = value(item) * float(10**money_scale) + F.lit(0.5)
        fits = F.abs(units) < float(2**63)
        return F.when(units.isNull(), total).when(fits, F.try_add(total, F.floor(units)))

    return F.aggregate(items, F.lit(0).cast("bigint"), add)


def _count(items: str, value: Value) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.aggregate(items, zero, lambda total, i: total + value(i).cast("bigint"))


def _facts(parsed: DataFrame, name: str, fields: dict[str, Column]) -> DataFrame:
    sound = F.col("reason").isNull() & (F.col("n_items") > 0)
    facts = F.when(sound, F.struct(*[c.alias(field) for field, c in fields.items()]))
    return parsed.select("stem", KEY, "reason", "n_items", facts.alias(name))


def bureau_facts(parsed: DataFrame, money_scale: int | None = None) -> DataFrame:
    """``stem, loan_app_id, reason, n_items, bureau_facts``: one narrow row per parsed bureau document."""
    return _facts(
        parsed,
        BUREAU,
        {
            **{c: F.col(c) for c in BUREAU_HEADERS},
            "max_dpd": F.array_max("trades.dpd"),
            "dpd_total": F.aggregate("trades", F.lit(0.0), lambda total, t: total + t["dpd"]),
            "balance": _money("trades", lambda t: coerce.known(t["current_balance"]), money_scale),
            "sanctioned": _money("trades", lambda t: coerce.known(t["sanctioned_amount"]), money_scale),
        },
    )


def banking_facts(parsed: DataFrame, money_scale: int | None = None) -> DataFrame:
    """``stem, loan_app_id, reason, n_items, banking_facts``: the same of parsed bank statements."""

    def amount_of(code: str) -> Value:
        return lambda t: rules.amount_of_type(coerce.known(t["txn_amount"]), t["txn_type"], code)

    def mentions(text: str) -> Column:
        return _count("transactions", lambda t: rules.mentions(t["txn_desc"], text))

    balance = lambda t: coerce.known(t["bal_after"])
    balances = F.transform("transactions", balance)
    return _facts(
        parsed,
        BANKING,
        {
            **{c: F.col(c) for c in BANKING_HEADERS},
            "txn_count": _count("transactions", lambda t: coerce.known(t["txn_amount"]).isNotNull()),
            "credits": _money("transactions", amount_of("CR"), money_scale),
            "debits": _money("transactions", amount_of("DR"), money_scale),
            "salary": mentions(rules.SALARY_TEXT),
            "emi": mentions(rules.EMI_TEXT),
            "cash": mentions(rules.CASH_TEXT),
            "balance": _money("transactions", balance, money_scale),
            "balances": _count("transactions", lambda t: balance(t).isNotNull()),
            "min_balance": F.array_min(balances),
            "max_balance": F.array_max(balances),
        },
    )


def pair_facts(bureau: DataFrame, banking: DataFrame, money_scale: int | None = None) -> DataFrame:
    """One row per stem: the verdict of ``pairing.pair_documents`` and the facts of both documents.

    Takes the written tables of parsed documents. Write the result: the quarantine and the features both come
    out of it.
    """
    return pairing.pair_documents(
        bureau_facts(bureau, money_scale), banking_facts(banking, money_scale), [BUREAU], [BANKING]
    )


def trade_counts(bureau: DataFrame, rejected: DataFrame) -> DataFrame:
    """``loan_app_id, num_trades``: distinct trade references over an applicant's accepted documents.

    Only (document, id, reference) leaves the scan, each reference once a document. The exact count spreads on
    (applicant, reference) first, so an applicant with a third of all trades is no hot spot.
    """
    sound = bureau.where(F.col("reason").isNull() & (F.col("n_items") > 0))
    references = sound.select("stem", KEY, F.explode(F.array_distinct("trades.trade_ref_num")).alias("reference"))
    # An anti join would be pushed below the explode, and its exchange would hold the arrays.
    marked = references.join(rejected.select("stem", F.lit(True).alias("rejected")), "stem", "left")
    kept = marked.where(F.col("rejected").isNull())
    return kept.groupBy(KEY).agg(F.count_distinct("reference").alias("num_trades"))


def features_of_pairs(pairs: DataFrame, bureau: DataFrame, money_scale: int | None = None) -> DataFrame:
    """The applicant feature table of written pairs (``pair_facts``): one row per applicant, 23 columns.

    ``bureau`` is the table of parsed bureau documents, read for trade references alone. Amounts beyond 64-bit
    minor units in an accepted document are an error.
    """
    unit = F.lit(1.0 if money_scale is None else float(10**money_scale))

    def fact(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def money(side: str, name: str) -> Column:
        total = fact(side, name)
        kind = "double" if money_scale is None else "bigint"
        beyond = F.raise_error(F.concat(F.lit("amount beyond 64-bit minor units in "), "stem")).cast(kind)
        return F.sum(F.coalesce(total, beyond)) / unit

    def first(side: str, name: str) -> Column:
        return first_known(fact(side, name), ["stem"]).alias(name)

    def total(side: str, name: str) -> Column:
        return F.sum(fact(side, name))

    accepted = pairs.where(F.col("reason").isNull() & F.col(KEY).isNotNull())
    summed = accepted.groupBy(KEY).agg(
        *[first(BUREAU, c) for c in BUREAU_HEADERS],
        F.max(fact(BUREAU, "max_dpd")).alias("max_dpd"),
        (total(BUREAU, "dpd_total") / F.sum("n_trades")).alias("avg_dpd"),
        money(BUREAU, "balance").alias("total_current_balance"),
        money(BUREAU, "sanctioned").alias("total_sanctioned_amount"),
        *[first(BANKING, c) for c in BANKING_HEADERS],
        total(BANKING, "txn_count").alias("txn_count"),
        money(BANKING, "credits").alias("total_credits"),
        money(BANKING, "debits").alias("total_debits"),
        total(BANKING, "salary").alias("salary_credits_count"),
        total(BANKING, "emi").alias("emi_txn_count"),
        total(BANKING, "cash").alias("cash_withdrawal_count"),
        F.try_divide(money(BANKING, "balance"), total(BANKING, "balances")).alias("avg_balance"),
        F.min(fact(BANKING, "min_balance")).alias("min_balance"),
        F.max(fact(BANKING, "max_balance")).alias("max_balance"),
    )
    counted = summed.join(trade_counts(bureau, pairing.rejects(pairs)), KEY, "left")
    flags = [rules.at_least(F.col("max_dpd"), n).alias(f"dpd_{n}_plus") for n in rules.DPD_LEVELS]
    return counted.select(
        KEY,
        *BUREAU_HEADERS,
        F.coalesce("num_trades", F.lit(0).cast("bigint")).alias("num_trades"),
        *["max_dpd", "avg_dpd", "total_current_balance", "total_sanctioned_amount"],
        *flags,
        *BANKING_HEADERS,
        *["txn_count", "total_credits", "total_debits"],
        *["salary_credits_count", "emi_txn_count", "cash_withdrawal_count"],
        *["avg_balance", "min_balance", "max_balance"],
        rules.risk_band(F.col("score_v3"), F.col("max_dpd")).alias("risk_band"),
    )
