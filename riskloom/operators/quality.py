"""Table checks: each gives the offending rows or a count of them, never an exception."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordering import with_previous
from riskloom.schemas import KEY

# Limits of a bureau score, and the keys every document must carry.
SCORE_LOW, SCORE_HIGH = 300, 900
BUREAU_KEYS = ["LOAN_APP_ID", "NAME", "DOB", "BUREAU", "SCORE_V3", "TRADES"]
BANKING_KEYS = ["LOAN_APP_ID", "BANK_NAME", "ACCT_NUM", "TRANSACTIONS"]
TRADE_KEYS = ["TRADE_REF_NUM", "PRODUCT_TYPE", "DATE_OPENED", "CURRENT_BALANCE", "SANCTIONED_AMOUNT", "DPD"]
TRANSACTION_KEYS = ["TXN_DATE", "TXN_AMOUNT", "TXN_TYPE", "TXN_DESC", "BAL_AFTER"]

# Fixed value: balances are kept to cents.
BALANCE_TOLERANCE = 0.01


def score_range(table: DataFrame) -> DataFrame:
    """One row: rows checked, scores outside the limits, missing scores."""
    score = F.col("score_v3")
    return table.agg(
        F.count("*").alias("checked"),
        F.count_if((score < SCORE_LOW) | (score > SCORE_HIGH)).alias("out_of_range"),
        F.count_if(score.isNull()).alias("missing_score"),
    )


def missing_keys(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``key, documents`` that lack the key, over all documents that are JSON objects."""
    parsed = docs.select(
        F.col("raw").rlike(r"^\s*\{").alias("is_object"), F.try_parse_json("raw").alias("doc")
    )
    readable = F.col("is_object") & F.col("doc").isNotNull()
    counts = parsed.agg(
        *[
            F.count_if(readable & F.try_variant_get("doc", f"$.{key}", "variant").isNull()).alias(key)
            for key in keys
        ]
    )
    return counts.unpivot([], keys, "key", "documents")


def missing_paths(docs: DataFrame, keys: list[str], items_key: str, item_keys: list[str]) -> DataFrame:
    """``path, documents, places``: required keys that documents and their items lack, counted in one pass.

    ``documents`` lack the key somewhere, ``places`` is how often: once in a header, once for each item. An
    explicit null is there. Items that are no objects lack every key; without a list of items only the header counts.
    """
    parsed = docs.select(
        F.col("raw").rlike(r"^\s*\{").alias("is_object"), F.try_parse_json("raw").alias("doc")
    )
    opened = parsed.where(F.col("is_object") & F.col("doc").isNotNull()).withColumn(
        "items", F.try_variant_get("doc", f"$.{items_key}", "array<variant>")
    )

    def lacking(key: str):
        found = F.filter("items", lambda i: F.try_variant_get(i, f"$.{key}", "variant").isNull())
        return F.coalesce(F.size(found), F.lit(0))

    counts = {key: F.try_variant_get("doc", f"$.{key}", "variant").isNull().cast("int") for key in keys}
    counts |= {f"{items_key}[].{key}": F.when(F.col("items").isNotNull(), lacking(key)).otherwise(0) for key in item_keys}
    each = opened.select(*[count.alias(f"c{i}") for i, count in enumerate(counts.values())])
    sums = each.agg(*[x for i in range(len(counts)) for x in (F.count_if(F.col(f"c{i}") > 0).alias(f"d{i}"), F.sum(f"c{i}").alias(f"p{i}"))])
    rows = [
        F.struct(F.lit(path).alias("path"), F.col(f"d{i}").alias("documents"), F.coalesce(f"p{i}", F.lit(0)).alias("places"))
        for i, path in enumerate(counts)
    ]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def duplicate_applicants(features: DataFrame) -> DataFrame:
    """``loan_app_id, rows`` of every applicant with more than one row."""
    counted = features.groupBy(KEY).agg(F.count("*").alias("rows"))
    return counted.where(F.col("rows") > 1)


def decile_check(table: DataFrame) -> DataFrame:
    """One row over a decile table: its applicants, and whether the top rate exceeds the bottom."""
    rate = "observed_default_rate"
    return table.agg(
        F.count("*").alias("deciles"),
        F.sum("applicants").alias("applicants"),
        (F.max_by(rate, "pd_decile") > F.min_by(rate, "pd_decile")).alias("top_above_bottom"),
    )


def _dated_early(lagged: DataFrame) -> DataFrame:
    return lagged.where(F.col("txn_date") < F.col("prev_txn_date"))


def _unbalanced(lagged: DataFrame) -> DataFrame:
    signed = F.when(F.col("txn_type") == "DR", -F.col("txn_amount")).otherwise(F.col("txn_amount"))
    gap = F.abs(F.col("bal_after") - (F.col("prev_bal_after") + signed))
    # Half a cent of slack absorbs the binary representation of cents.
    return lagged.where(gap > BALANCE_TOLERANCE + 0.005)


def chronology_breaks(transactions: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Transactions dated before the last known date listed ahead of them in the same statement."""
    dated = transactions.where(F.col("txn_date").isNotNull())
    return _dated_early(with_previous(dated, keys, pos, ["txn_date"]))


def balance_breaks(transactions: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Transactions whose balance is not the previous balance plus or minus the amount."""
    return _unbalanced(with_previous(transactions, keys, pos, ["bal_after"]))


def _steps(parsed: DataFrame, columns: list[str], previous: list[str]) -> DataFrame:
    """Every item of parsed statements beside the one before it: both come out of the same arrays, so
    nothing is shuffled, and only the arrays in use are read."""
    arrays = [F.col(f"transactions.{c}").alias(f"all_{c}") for c in columns]
    narrow = parsed.select(KEY, "stem", *arrays)
    zipped = F.posexplode_outer(F.arrays_zip(*[F.col(f"all_{c}").alias(c) for c in columns]))
    rows = narrow.select("*", zipped)
    return rows.select(
        KEY,
        "stem",
        "pos",
        *[F.col(f"col.{c}") for c in columns],
        *[F.get(f"all_{c}", F.col("pos") - 1).alias(f"prev_{c}") for c in previous],
    )


def chronology_breaks_in_documents(parsed: DataFrame) -> DataFrame:
    """``chronology_breaks`` straight from parsed statements, without a shuffle."""
    dates = F.transform("transactions.txn_date", lambda d, i: F.struct(i.alias("pos"), d.alias("txn_date")))
    known = F.filter(dates, lambda x: x["txn_date"].isNotNull())
    rows = parsed.select(KEY, "stem", known.alias("known")).select(KEY, "stem", "known", F.posexplode("known"))
    rows = rows.select(
        KEY,
        "stem",
        F.col("col.pos").alias("pos"),
        F.col("col.txn_date").alias("txn_date"),
        F.get("known", F.col("pos") - 1)["txn_date"].alias("prev_txn_date"),
    )
    return _dated_early(rows)


def balance_breaks_in_documents(parsed: DataFrame) -> DataFrame:
    """``balance_breaks`` straight from parsed statements."""
    return _unbalanced(_steps(parsed, ["txn_amount", "txn_type", "bal_after"], ["bal_after"]))


def breaks_per_applicant(breaks: DataFrame) -> DataFrame:
    """``loan_app_id, breaks``."""
    return breaks.groupBy(KEY).agg(F.count("*").alias("breaks"))


def unreadable_dates(parsed: DataFrame) -> DataFrame:
    """``stem, unreadable``: parsed statements with dates that are there but not in the statement's form."""
    bad = F.size(F.filter("transactions.bad_date", lambda marked: marked)).cast("bigint")
    return parsed.select("stem", bad.alias("unreadable")).where(F.col("unreadable") > 0)
