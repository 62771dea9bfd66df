"""Small literal documents and tables."""

import json

BUREAU = {
    "LOAN_APP_ID": "APP004417",
    "NAME": "Sample Person",
    "DOB": "1984-06-30",
    "BUREAU": "Meridian",
    "SCORE_V3": 655,
    "TRADES": [
        {
            "TRADE_REF_NUM": "k-88",
            "PRODUCT_TYPE": "HL",
            "DATE_OPENED": "2017-03-15",
            "CURRENT_BALANCE": 125000.5,
            "SANCTIONED_AMOUNT": 180000.0,
            "DPD": "031",
        },
        {
            "TRADE_REF_NUM": "k-93",
            "PRODUCT_TYPE": "AL",
            "DATE_OPENED": "2022-11-09",
            "CURRENT_BALANCE": 4000.25,
            "SANCTIONED_AMOUNT": 9000.0,
            "DPD": "STD",
        },
    ],
}

BANKING = {
    "LOAN_APP_ID": "APP004417",
    "BANK_NAME": "Cedar",
    "ACCT_NUM": "000777000778",
    "TRANSACTIONS": [
        {
            "TXN_DATE": "2023-07-02",
            "TXN_AMOUNT": 1200.0,
            "TXN_TYPE": "CR",
            "TXN_DESC": "Refund",
            "BAL_AFTER": 3200.0,
        },
        {
            "TXN_DATE": "2023-07-19",
            "TXN_AMOUNT": 700.5,
            "TXN_TYPE": "DR",
            "TXN_DESC": "Electricity",
            "BAL_AFTER": 2499.5,
        },
    ],
}


def without(document, key):
    return {k: v for k, v in document.items() if k != key}


def documents(spark, **texts):
    """``stem, raw`` rows from texts or objects."""
    rows = [(s, t if isinstance(t, str) else json.dumps(t)) for s, t in texts.items()]
    return spark.createDataFrame(rows, "stem string, raw string")


def trades(spark):
    """Two applicants: one late by 29 and 61 days, one by 91."""
    rows = [
        ("B7", "b7", 0, "P", "1979-04-04", "Tessera", 633, "k1", "HL", "2018-08-08", 750.25, 4000.0, 29),
        ("B7", "b7", 1, "P", "1979-04-04", "Tessera", 633, "k2", "AL", "2021-02-01", 1249.75, 6500.0, 61),
        ("B9", "b9", 0, "Q", "1991-12-12", "Quorum", 512, "k3", "HL", "2019-05-05", 310.5, 700.0, 91),
    ]
    return spark.createDataFrame(
        rows,
        "loan_app_id string, stem string, pos int, name string, dob string, bureau string, "
        "score_v3 bigint, trade_ref_num string, product_type string, date_opened string, "
        "current_balance double, sanctioned_amount double, dpd bigint",
    )


def transactions(spark):
    rows = [
        ("B7", "b7", 0, "Elm", "900", "2023-03-03", 900.0, "CR", "Salary March", 1400.0),
        ("B7", "b7", 1, "Elm", "900", "2023-03-09", 150.0, "DR", "EMI car", 1250.0),
        ("B7", "b7", 2, "Elm", "900", "2023-03-20", 300.0, "DR", "Cash withdrawal", 950.0),
        ("B9", "b9", 0, "Hazel", "901", "2023-03-05", 60.0, "DR", "Rent", -45.0),
    ]
    table = spark.createDataFrame(
        rows,
        "loan_app_id string, stem string, pos int, bank_name string, acct_num string, "
        "txn_date string, txn_amount double, txn_type string, txn_desc string, bal_after double",
    )
    return table.withColumn("txn_date", table.txn_date.cast("timestamp"))


def by_id(df):
    return {row.loan_app_id: row for row in df.collect()}
