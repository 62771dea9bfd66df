"""Raw documents -> one typed row per document, with a reason when it cannot be used.

Each text is parsed once, and all items come out of it in one cast to an array of structs whose
untrusted fields stay VARIANT until they are coerced. Stored as Parquet, later passes read single
leaf columns of the typed array and never touch the JSON again.

Write the output before filtering it: a filter on the reason of an unwritten table is pushed into the parse,
and Catalyst then repeats the parse for every column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import coerce

# Keys of the items.
TRADE_FIELDS = (
    "TRADE_REF_NUM string, PRODUCT_TYPE string, DATE_OPENED string, "
    "CURRENT_BALANCE variant, SANCTIONED_AMOUNT variant, DPD variant"
)
TRANSACTION_FIELDS = (
    "TXN_DATE string, TXN_AMOUNT variant, TXN_TYPE string, TXN_DESC string, BAL_AFTER variant"
)


def _text(doc: Column, key: str) -> Column:
    return F.try_variant_get(doc, f"$.{key}", "string")


def _parse(
    docs: DataFrame,
    header: dict[str, Callable[[Column], Column]],
    items_key: str,
    item_fields: str,
    items: str,
    item: Callable[[Column, Column | None], dict[str, Column]],
    amounts: list[str],
    whole: tuple[str, ...] = (),
    bad_header: Callable[[Column], Column] = lambda d: F.lit(False),
    shared: Callable[[Column], Column] | None = None,
    fate_only: bool = False,
) -> DataFrame:
    """``shared`` makes one value of all items of a document, which ``item`` gets with each of them.

    ``fate_only`` leaves out the items, and makes of them only the fields that can give a reason: Catalyst does
    not prune what is made inside an array.
    """
    doc = F.col("doc")
    judged = [*amounts, *whole]
    if fate_only:
        shared = None
    opened = docs.select("stem", "raw", F.try_parse_json("raw").alias("doc"))
    # Null when it is no array; an element that is no object becomes a null struct.
    elements = F.try_variant_get(doc, f"$.{items_key}", f"array<struct<{item_fields}>>")

    def typed(known: Column | None) -> Callable[[Column, Column], Column]:
        def one(element: Column, pos: Column) -> Column:
            made = item(element, known)
            values = [c.alias(name) for name, c in made.items() if not fate_only or name in judged]
            return F.struct(pos.alias("pos"), *values, element.isNotNull().alias("is_object"))

        return one

    if shared is None:
        typed_items = F.transform(elements, typed(F.lit(None).cast("int")))
    else:
        # Arrays of one element bind a value to a name, so that it is computed once for all items.
        def with_shared(found: Column) -> Column:
            return F.transform(F.array(shared(found)), lambda known: F.transform(found, typed(known)))[0]

        typed_items = F.transform(F.array(elements), with_shared)[0]

    fields = opened.select(
        "stem",
        doc.isNull().alias("corrupt"),
        F.col("raw").rlike(r"^\s*\{").alias("is_object"),
        *[make(doc).alias(name) for name, make in header.items()],
        bad_header(doc).alias("bad_header"),
        F.try_variant_get(doc, f"$.{items_key}", "variant").isNull().alias("no_items"),
        typed_items.alias(items),
    )
    bad_amount = F.exists(items, lambda i: _any_null([i[name] for name in amounts]))
    reason = (
        F.when(F.col("corrupt"), "corrupt_json")
        .when(~F.col("is_object"), "not_an_object")
        .when(F.col("loan_app_id").isNull(), "missing_id")
        .when(F.col("no_items"), None)
        .when(F.col(items).isNull() | F.exists(items, lambda i: ~i["is_object"]), "bad_items")
        .when(bad_amount, "bad_amount")
        .when(F.exists(items, lambda i: i["dpd"].isNull()) if "dpd" in whole else F.lit(False), "bad_dpd")
        .when(F.col("bad_header"), "bad_score")
    )
    return fields.select(
        "stem",
        *header,
        *([] if fate_only else [items]),
        F.when(F.col(items).isNull(), 0).otherwise(F.size(items)).alias("n_items"),
        reason.alias("reason"),
    )


def _any_null(columns: list[Column]) -> Column:
    found = columns[0].isNull()
    for column in columns[1:]:
        found = found | column.isNull()
    return found


def parse_bureau(docs: DataFrame, fate_only: bool = False) -> DataFrame:
    """``stem, loan_app_id, name, dob, bureau, score_v3, trades[], n_items, reason``; with ``fate_only`` no trades."""
    return _parse(
        docs,
        header={
            "loan_app_id": lambda d: _text(d, "LOAN_APP_ID"),
            "name": lambda d: _text(d, "NAME"),
            "dob": lambda d: _text(d, "DOB"),
            "bureau": lambda d: _text(d, "BUREAU"),
            "score_v3": lambda d: F.try_variant_get(d, "$.SCORE_V3", "bigint"),
        },
        items_key="TRADES",
        item_fields=TRADE_FIELDS,
        items="trades",
        item=lambda t, _: {
            "trade_ref_num": t["TRADE_REF_NUM"],
            "product_type": t["PRODUCT_TYPE"],
            "date_opened": t["DATE_OPENED"],
            "current_balance": coerce.amount(t["CURRENT_BALANCE"]),
            "sanctioned_amount": coerce.amount(t["SANCTIONED_AMOUNT"]),
            "dpd": coerce.days_past_due(t["DPD"]),
        },
        amounts=["current_balance", "sanctioned_amount"],
        whole=("dpd",),
        # A score that is there but isn't a number; a missing or null one is known to be unknown.
        bad_header=lambda d: F.try_variant_get(d, "$.SCORE_V3", "variant").isNotNull()
        & ~F.is_variant_null(F.try_variant_get(d, "$.SCORE_V3", "variant"))
        & F.try_variant_get(d, "$.SCORE_V3", "bigint").isNull(),
        fate_only=fate_only,
    )


def parse_banking(docs: DataFrame, fate_only: bool = False) -> DataFrame:
    """``stem, loan_app_id, bank_name, acct_num, transactions[], n_items, reason``; with ``fate_only`` no transactions.

    A statement's dates are read in one form, that of its first readable date. ``bad_date`` marks a date that
    is there but cannot be read so.
    """
    return _parse(
        docs,
        header={
            "loan_app_id": lambda d: _text(d, "LOAN_APP_ID"),
            "bank_name": lambda d: _text(d, "BANK_NAME"),
            "acct_num": lambda d: _text(d, "ACCT_NUM"),
        },
        items_key="TRANSACTIONS",
        item_fields=TRANSACTION_FIELDS,
        items="transactions",
        item=lambda t, form: {
            "txn_date": coerce.timestamp_of_form(t["TXN_DATE"], form),
            "txn_amount": coerce.amount(t["TXN_AMOUNT"]),
            "txn_type": t["TXN_TYPE"],
            "txn_desc": t["TXN_DESC"],
            "bal_after": coerce.amount(t["BAL_AFTER"]),
            "bad_date": t["TXN_DATE"].isNotNull() & coerce.timestamp_of_form(t["TXN_DATE"], form).isNull(),
        },
        shared=lambda items: coerce.date_form(items, "TXN_DATE"),
        amounts=["txn_amount", "bal_after"],
        fate_only=fate_only,
    )
