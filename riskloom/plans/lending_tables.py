"""The lending domain on the driver's star-schema tables.

Customers are applicants, orders their trades, line items their bank transactions. All expressions
are row-local and deterministic; the raw documents are written out of single order rows, so no
applicant's rows are ever gathered to make one.
"""

from __future__ import annotations

import tarfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.coerce import days_past_due_text
from riskloom.schemas import KEY, LABEL, SCORE, TRADE_COLUMNS

# Invented bureau and bank names.
BUREAUS = ["Borealis", "Meridian", "Tessera", "Quorum"]
BANKS = ["Alder", "Birch", "Cedar", "Elm", "Hazel", "Rowan"]

# Amounts in these tables carry cents.
MONEY_SCALE = 2

# Size at which an archive of documents is closed, and bytes that are compressed at a time.
ARCHIVE_BYTES, _PORTION = 2 << 20, 1 << 20

# Order of an applicant's trades (o_orderkey is unique).
TRADE_ORDER = ["pos"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded(key: Column, width: int) -> Column:
    """Zero-padded number; a longer one keeps all its digits."""
    text = key.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def applicant_id(key: Column) -> Column:
    return F.concat(F.lit("APP"), padded(key, 6))


def pick(names: list[str], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (key % len(names) + 1).cast("int"))


def to_cents(value: Column) -> Column:
    return F.floor(value * 100 + 0.5).cast("double") / 100


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header fields of each applicant: custkey, id, name, dob, bureau, score."""
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1975-01-01").cast("date"), (key % 10950).cast("int"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        applicant_id(key).alias(KEY),
        F.col("c_name").alias("name"),
        F.date_format(born, "yyyy-MM-dd").alias("dob"),
        pick(BUREAUS, F.col("c_nationkey")).alias("bureau"),
        (300 + F.floor((F.col("c_acctbal") + 1000) / 11000 * 600)).cast("bigint").alias("score_v3"),
    )


def raw_dpd(order_key: Column, status: Column) -> Column:
    """Days past due as bureaus write it: padded digits or a code."""
    return (
        F.when(order_key % 33 == 0, "XXX")
        .when((status == "F") & (order_key % 5 == 0), F.lpad((order_key % 181).cast("string"), 3, "0"))
        .otherwise("000")
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bureau and bank header values, one row per applicant, keyed by customer number."""
    key = F.col("c_custkey")
    return applicants(spark, sf_dir).select(
        key.alias(KEY), "score_v3", "bureau", *_bank_header(key)
    )


def _bank_header(customer: Column) -> list[Column]:
    return [
        pick(BANKS, customer).alias("bank_name"),
        padded(customer, 12).alias("acct_num"),
    ]


def _trade_values() -> dict[str, Column]:
    order_key, status, price = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice")
    return {
        "current_balance": F.when(status == "O", price).otherwise(0.0),
        "sanctioned_amount": price,
        "dpd": days_past_due_text(raw_dpd(order_key, status)),
    }


def trade_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades without their headers, keyed by customer number: orders alone, no join."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias(KEY),
        F.col("o_orderkey").alias("trade_ref_num"),
        *[value.alias(name) for name, value in _trade_values().items()],
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trade, header values repeated; ``pos`` gives the document order."""
    o = table(spark, sf_dir, "orders")
    joined = o.join(applicants(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        *TRADE_COLUMNS[:5],
        F.col("o_orderkey").cast("string").alias("trade_ref_num"),
        F.col("o_orderpriority").alias("product_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_opened"),
        *[value.alias(name) for name, value in _trade_values().items()],
        F.col("o_orderkey").alias("pos"),
    )


def _owned_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    item = table(spark, sf_dir, "lineitem")
    return item.join(o, F.col("l_orderkey") == F.col("o_orderkey"))


def _transaction_values() -> dict[str, Column]:
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    description = (
        F.when(line == 1, "Salary")
        .when(line == 2, "Loan EMI")
        .when(line == 3, "Cash Withdrawal")
        .when(line == 4, "Insurance Premium")
        .when(line == 5, None)
        .otherwise("UPI Transfer")
    )
    return {
        "txn_date": F.col("l_shipdate"),
        "txn_amount": price,
        "txn_type": F.when(F.col("l_returnflag") == "R", "CR").otherwise("DR"),
        "txn_desc": description,
        "bal_after": to_cents(price * (1 - F.col("l_discount")) - 1000 * F.col("l_quantity")),
    }


def transaction_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions without their headers, keyed by customer number."""
    return _owned_items(spark, sf_dir).select(
        F.col("o_custkey").alias(KEY),
        *[value.alias(name) for name, value in _transaction_values().items()],
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per bank transaction, header values repeated."""
    customer = F.col("o_custkey")
    return _owned_items(spark, sf_dir).select(
        applicant_id(customer).alias(KEY),
        *_bank_header(customer),
        *[value.alias(name) for name, value in _transaction_values().items()],
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed outcome of some applicants."""
    return table(spark, sf_dir, "labels").select(
        applicant_id(F.col("doc_id")).alias(KEY), (1 - F.col("quality")).cast("int").alias(LABEL)
    )


def fixed_pd(name: str = SCORE) -> Column:
    """A fixed-coefficient PD over the features, to six digits."""
    z = (
        F.lit(-1.2)
        + (620 - F.col("score_v3")) * F.lit(6e-3)
        + F.col("max_dpd") * F.lit(8e-3)
        - F.col("total_credits") * F.lit(2e-7)
        + F.col("cash_withdrawal_count") * F.lit(1e-2)
    )
    return (F.floor(1 / (1 + F.exp(-z)) * 1e6 + 0.5).cast("double") / 1e6).alias(name)


# --- raw documents, one bureau and one bank document per order row -----------------------------


def document_stem(order_key: Column) -> Column:
    return F.concat(F.lit("APP"), padded(order_key, 9))


def _defect(order_key: Column, number: int) -> Column:
    return order_key % 50 == number


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def _object(fields: dict[str, Column]) -> Column:
    parts = [F.concat(F.lit(f'"{key}": '), value) for key, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def _number(value: Column) -> Column:
    return value.cast("string")


def _dealt_orders(spark: SparkSession, sf_dir: str, ordered: bool) -> DataFrame:
    """Orders dealt by the stem of their documents, as intake lands them: rows of one input file would be parsed in one
    task. They are dealt, and if ``ordered`` sorted by it within a task, before any text is made of them, so neither the
    exchange nor the sort holds documents."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    dealt = orders.withColumn("stem", document_stem(F.col("o_orderkey"))).repartition("stem")
    return dealt.sortWithinPartitions("stem") if ordered else dealt


def bureau_documents(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """``stem, raw``: a bureau document of two trades per order, some of them defective.

    By o_orderkey modulo 50: 1 cut off, 2 an array, 3 no id, 4 no trades, 5 an amount in words,
    6 a null amount, 7 null trades, 18 no file.
    """
    k, customer = F.col("o_orderkey"), F.col("o_custkey")
    price = F.col("o_totalprice")
    opened = _quoted(F.date_format("o_orderdate", "yyyy-MM-dd"))
    balance = (
        F.when(_defect(k, 5), F.lit('"abc"')).when(_defect(k, 6), F.lit("null")).otherwise(_number(price))
    )
    first = _object(
        {
            "TRADE_REF_NUM": _quoted(k.cast("string")),
            "PRODUCT_TYPE": _quoted(F.col("o_orderpriority")),
            "DATE_OPENED": opened,
            "CURRENT_BALANCE": balance,
            "SANCTIONED_AMOUNT": _quoted(_number(price)),
            "DPD": _quoted(raw_dpd(k, F.col("o_orderstatus"))),
        }
    )
    # The second trade is shared by neighbouring orders; it has no balance key and a numeric DPD.
    second = _object(
        {
            "TRADE_REF_NUM": _quoted(F.concat(F.lit("S"), F.floor(k / 2).cast("string"))),
            "PRODUCT_TYPE": F.lit('"CC"'),
            "DATE_OPENED": opened,
            "SANCTIONED_AMOUNT": F.lit("20000"),
            "DPD": (k % 45).cast("string"),
        }
    )
    items = (
        F.when(_defect(k, 4), F.lit("[]"))
        .when(_defect(k, 7), F.lit("null"))
        .otherwise(F.concat(F.lit("["), first, F.lit(", "), second, F.lit("]")))
    )
    tail = {
        "NAME": _quoted(F.concat(F.lit("Customer#"), padded(customer, 9))),
        "DOB": F.lit('"1990-01-01"'),
        "BUREAU": _quoted(pick(BUREAUS, customer)),
        "SCORE_V3": (300 + (customer * 37) % 601).cast("string"),
        "TRADES": F.col("items"),
    }
    rows = _dealt_orders(spark, sf_dir, ordered).where(~_defect(k, 18)).withColumn("items", items)
    return _written(rows, "TRADES", tail, applicant_id(customer), cut=1, array=2, no_id=3)


def _written(
    rows: DataFrame, items_key: str, tail: dict[str, Column], holder: Column, cut: int, array: int, no_id: int
) -> DataFrame:
    """``stem, raw`` of the documents, in steps so that each text is put together once."""
    k = F.col("o_orderkey")
    whole = F.concat(F.lit('{"LOAN_APP_ID": '), _quoted(holder), F.lit(", "), F.col("body"))
    raw = (
        F.when(_defect(k, cut), F.substring_index("whole", f'"{items_key}"', 1))
        .when(_defect(k, array), F.concat(F.lit("["), "whole", F.lit("]")))
        .when(_defect(k, no_id), F.concat(F.lit("{"), "body"))
        .otherwise(F.col("whole"))
    )
    bodies = rows.withColumn("body", F.substr(_object(tail), F.lit(2)))
    texts = bodies.withColumn("whole", whole)
    return texts.select("stem", raw.alias("raw"))


def banking_documents(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """``stem, raw``: a bank document of three transactions per order, some of them defective.

    By o_orderkey modulo 50: 11 no file, 12 cut off, 13 no id, 14 no transactions, 15 a balance in
    words, 16 someone else's id, 17 an array. Modulo 20, the second transaction is dated too early
    (3) or carries a wrong balance (4), and modulo 9 = 2 it has an unreadable date. Modulo 8, dates are written
    month first (1) or with the month's name (5), else in ISO form.
    """
    k, customer = F.col("o_orderkey"), F.col("o_custkey")
    paid = F.floor(F.col("o_totalprice") / 10)
    day = F.col("o_orderdate").cast("date")

    def written(date: Column) -> Column:
        named = F.when(k % 8 == 5, F.date_format(date, "dd-MMM-yyyy"))
        return F.when(k % 8 == 1, F.date_format(date, "MM/dd/yyyy")).otherwise(
            F.coalesce(named, F.date_format(date, "yyyy-MM-dd"))
        )

    def txn(date: Column, amount: Column, kind: str, text: str, balance: Column) -> Column:
        return _object(
            {
                "TXN_DATE": _quoted(date),
                "TXN_AMOUNT": _number(amount),
                "TXN_TYPE": F.lit(f'"{kind}"'),
                "TXN_DESC": F.lit(f'"{text}"'),
                "BAL_AFTER": _number(balance),
            }
        )

    opening = F.col("o_totalprice")
    last = F.when(_defect(k, 15), F.lit('"n/a"')).otherwise(
        _number(to_cents(opening - paid - 500))
    )
    second_day = F.when(k % 9 == 2, F.lit("not a date")).otherwise(
        written(F.date_add(day, F.when(k % 20 == 3, -4).otherwise(4)))
    )
    second_balance = to_cents(opening - paid + F.when(k % 20 == 4, 7.0).otherwise(0.0))
    rows = [
        txn(written(day), opening, "CR", "Salary", opening),
        txn(second_day, paid, "DR", "Loan EMI", second_balance),
        txn(written(F.date_add(day, 9)), F.lit(500), "DR", "Cash Withdrawal", last),
    ]
    items = F.when(_defect(k, 14), F.lit("[]")).otherwise(
        F.concat(F.lit("["), F.concat_ws(", ", *rows), F.lit("]"))
    )
    tail = {
        "BANK_NAME": _quoted(pick(BANKS, customer)),
        "ACCT_NUM": _quoted(padded(customer, 12)),
        "TRANSACTIONS": F.col("items"),
    }
    holder = F.when(_defect(k, 16), F.lit("OTHER")).otherwise(applicant_id(customer))
    files = _dealt_orders(spark, sf_dir, ordered).where(~_defect(k, 11)).withColumn("items", items)
    return _written(files, "TRANSACTIONS", tail, holder, cut=12, array=17, no_id=13)


def _tar_header() -> Callable[[str, int], bytes]:
    """A function that gives the header block of a file with a plain name and size, byte for byte as ``tarfile`` would."""
    block = tarfile.TarInfo().tobuf()
    zeros = b"0" * 11  # the size in this block; its checksum counts them
    base = int(block[148:154], 8) - sum(zeros)
    before_size, before_check, after = block[100:124], block[135:148], block[154:]

    def header(name: str, size: int) -> bytes:
        if not name.isascii() or len(name) > 100 or size >= 8**11:
            info = tarfile.TarInfo(name)
            info.size = size
            return info.tobuf()
        plain, digits = name.encode(), b"%011o" % size
        check = b"%06o" % (base + sum(plain) + sum(digits))
        return plain.ljust(100, b"\0") + before_size + digits + before_check + check + after

    return header


def write_documents(docs: DataFrame, folder: str, compressed: bool = False, ordered: bool = False) -> None:
    """Each document (``stem, raw``) as a file ``<stem>.json`` inside tar archives, written by the task that holds it.

    Documents of one stem must be in one partition, and if ``ordered`` those of a partition are sorted by it already.
    Rows of a task are in order and archives are numbered, so a repeated task writes the same files once more. Of
    documents with one stem the greatest stays; one without a text is an empty file. Spark's own
    writers don't let rows name their files. Most of an archive of small documents is headers, padding and repeated
    keys; ``compressed`` archives (``.tar.zst``, a frame for each portion) are a small part of that.
    """
    room, ending = ARCHIVE_BYTES, ".tar.zst" if compressed else ".tar"
    portion = min(_PORTION, room)

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        task, number, packed, done, before = TaskContext.get().partitionId(), 0, bytearray(), bytearray(), None
        header, filled = _tar_header(), [bytes(-n % tarfile.BLOCKSIZE) for n in range(tarfile.BLOCKSIZE)]

        def add(stem: str, raw: bytes) -> None:
            packed.extend(header(f"{stem}.json", len(raw)))
            packed.extend(raw)
            packed.extend(filled[len(raw) % tarfile.BLOCKSIZE])

        def move() -> None:
            done.extend(pa.compress(packed, "zstd", asbytes=True) if compressed else packed)
            packed.clear()

        def close() -> None:
            packed.extend(bytes(2 * tarfile.BLOCKSIZE))
            move()
            with system.open_output_stream(f"{base}/documents-{task:06}-{number:06}{ending}", compression=None) as file:
                file.write(bytes(done))
            done.clear()

        for batch in batches:
            for stem, raw in zip(batch.column("stem").to_pylist(), batch.column("raw").to_pylist(), strict=True):
                raw = raw or b""
                if before is not None:
                    if before[0] == stem:
                        raw = max(before[1], raw)
                    else:
                        add(*before)
                        if len(packed) >= portion:
                            move()
                            if len(done) >= room:
                                close()
                                number += 1
                before = stem, raw
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})
        if before is not None:
            add(*before)
            close()

    rows = docs.select("stem", F.col("raw").cast("binary").alias("raw"))
    if not ordered:
        rows = rows.sortWithinPartitions("stem")
    rows.mapInArrow(put, "files bigint").write.format("noop").mode("overwrite").save()
