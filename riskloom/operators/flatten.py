"""Parsed documents -> one row per trade / per transaction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.schemas import TRADE_COLUMNS, TRANSACTION_COLUMNS

# Document order: files by name, items by their place in the array.
POSITION = ["stem", "pos"]


def _flatten(parsed: DataFrame, items: str, columns: list[str], with_position: bool) -> DataFrame:
    header = [c for c in columns if c in parsed.columns]
    # explode, unlike posexplode, lets Catalyst prune the scan to the leaf columns in use; the
    # position is a field of the items.
    rows = parsed.select("stem", *header, F.explode(items).alias("item"))
    flat = [F.col(c) if c in header else F.col(f"item.{c}").alias(c) for c in columns]
    place = [F.col("stem"), F.col("item.pos").alias("pos")]
    return rows.select(*flat, *(place if with_position else []))


def flatten_trades(parsed: DataFrame, with_position: bool = False) -> DataFrame:
    """One row per trade with its document's header fields, in the fixed column order."""
    return _flatten(parsed, "trades", TRADE_COLUMNS, with_position)


def flatten_transactions(parsed: DataFrame, with_position: bool = False) -> DataFrame:
    """One row per transaction with its document's header fields, in the fixed column order."""
    return _flatten(parsed, "transactions", TRANSACTION_COLUMNS, with_position)


def union_all(*tables: DataFrame) -> DataFrame:
    """Bag union of increments by column name."""
    return reduce(lambda left, right: left.unionByName(right), tables)
