import json
from collections import Counter

import pytest
from fixtures import BANKING, BUREAU, documents, without
from pyspark.sql import functions as F

from riskloom.functions import coerce
from riskloom.operators import flatten, pairing, parse, quality
from riskloom.schemas import TRADE_COLUMNS, TRANSACTION_COLUMNS


def test_one_row_per_trade(spark):
    rows = flatten.flatten_trades(parse.parse_bureau(documents(spark, a=BUREAU)))
    assert rows.columns == TRADE_COLUMNS
    found = rows.orderBy("trade_ref_num").collect()
    assert [r.loan_app_id for r in found] == ["APP004417"] * 2
    assert [r.score_v3 for r in found] == [655, 655]
    assert [r.dpd for r in found] == [31, 0]
    assert [r.sanctioned_amount for r in found] == [180000.0, 9000.0]


def test_one_row_per_transaction(spark):
    rows = flatten.flatten_transactions(parse.parse_banking(documents(spark, a=BANKING)))
    assert rows.columns == TRANSACTION_COLUMNS
    assert dict(rows.dtypes)["txn_date"] == "timestamp_ntz"
    assert rows.agg(F.sum("txn_amount")).first()[0] == 1900.5


def test_unreadable_date_is_null(spark):
    doc = dict(BANKING, TRANSACTIONS=[{"TXN_DATE": "soon"}, {"TXN_DATE": "2024-02-03"}, {}])
    rows = flatten.flatten_transactions(parse.parse_banking(documents(spark, a=doc)), True)
    dates = [str(r.txn_date) for r in rows.orderBy("pos").collect()]
    assert dates == ["None", "2024-02-03 00:00:00", "None"]


@pytest.mark.parametrize(
    "texts, expected, unreadable",
    [
        (["05/01/2024", "06/13/2024 10:30:00"], ["2024-05-01 00:00:00", "2024-06-13 10:30:00"], 0),
        (["13/01/2024", "05/02/2024", "2024-03-01"], ["2024-01-13 00:00:00", "2024-02-05 00:00:00", "None"], 1),
        (["31/31/2024", "05-Jan-2024", "6 december 2024"], ["None", "2024-01-05 00:00:00", "2024-12-06 00:00:00"], 1),
        (["20240229", "20240230", None], ["2024-02-29 00:00:00", "None", "None"], 1),
        (["2024/1/5", "2024-01-05"], ["2024-01-05 00:00:00", "None"], 1),
        (["2024-01-05", "01/06/2024"], ["2024-01-05 00:00:00", "None"], 1),
        (["05-anf-2024", "", "x"], ["None", "None", "None"], 3),
    ],
)
def test_a_statement_is_read_in_the_form_of_its_first_readable_date(spark, texts, expected, unreadable):
    doc = dict(BANKING, TRANSACTIONS=[{"TXN_DATE": t} for t in texts])
    parsed = parse.parse_banking(documents(spark, a=doc))
    rows = flatten.flatten_transactions(parsed, True)
    assert [str(r.txn_date) for r in rows.orderBy("pos").collect()] == expected
    assert [r.unreadable for r in quality.unreadable_dates(parsed).collect()] == [unreadable] * (unreadable > 0)


def test_empty_items_give_no_rows_and_the_same_columns(spark):
    docs = documents(spark, a=dict(BUREAU, TRADES=[]), b=without(BUREAU, "TRADES"))
    parsed = parse.parse_bureau(docs)
    assert [(r.n_items, r.reason) for r in parsed.collect()] == [(0, None), (0, None)]
    rows = flatten.flatten_trades(parsed)
    assert rows.columns == TRADE_COLUMNS and rows.count() == 0


TRADE = BUREAU["TRADES"][0]
REASONS = {
    "good": (BUREAU, None),
    "corrupt": ('{"LOAN_APP_ID": "APP1", "TRADES": [', "corrupt_json"),
    "blank": ("", "corrupt_json"),
    "not_a_number": ('{"LOAN_APP_ID": NaN}', "corrupt_json"),
    "list": ([BUREAU], "not_an_object"),
    "number": ("12", "not_an_object"),
    "no_id": (without(BUREAU, "LOAN_APP_ID"), "missing_id"),
    "null_id": (dict(BUREAU, LOAN_APP_ID=None), "missing_id"),
    "null_trades": (dict(BUREAU, TRADES=None), "bad_items"),
    "text_trades": (dict(BUREAU, TRADES="x"), "bad_items"),
    "text_in_trades": (dict(BUREAU, TRADES=["x", TRADE]), "bad_items"),
    "null_in_trades": (dict(BUREAU, TRADES=[TRADE, None]), "bad_items"),
    "null_amount": (dict(BUREAU, TRADES=[dict(TRADE, CURRENT_BALANCE=None)]), "bad_amount"),
    "word_amount": (dict(BUREAU, TRADES=[TRADE, dict(TRADE, SANCTIONED_AMOUNT="abc")]), "bad_amount"),
    "text_amount": (dict(BUREAU, TRADES=[dict(TRADE, CURRENT_BALANCE="12.5")]), None),
    "word_score": (dict(BUREAU, SCORE_V3="abc"), "bad_score"),
    "null_score": (dict(BUREAU, SCORE_V3=None), None),
    "no_score": (without(BUREAU, "SCORE_V3"), None),
    "endless_dpd": (dict(BUREAU, TRADES=[dict(TRADE, DPD="9" * 30)]), "bad_dpd"),
    "endless_number": (dict(BUREAU, TRADES=[dict(TRADE, DPD=1e30)]), "bad_dpd"),
    "no_amount": (dict(BUREAU, TRADES=[without(TRADE, "CURRENT_BALANCE")]), None),
}


def test_reasons(spark):
    docs = documents(spark, **{name: doc for name, (doc, _) in REASONS.items()})
    found = {r.stem: r.reason for r in parse.parse_bureau(docs).collect()}
    assert found == {name: reason for name, (_, reason) in REASONS.items()}


def test_text_and_absent_amounts(spark):
    docs = documents(spark, a=REASONS["text_amount"][0], b=REASONS["no_amount"][0])
    rows = flatten.flatten_trades(parse.parse_bureau(docs), True).orderBy("stem").collect()
    assert [r.current_balance for r in rows] == [12.5, 0.0]


VALUES = [
    '"000"', '"015"', '"180"', '"XXX"', '"STD"', "null", "30", '" 15 "', '"+5"', '"15.0"', "30.7",
    "-30.7", "true", '""', '"1_5"', '"1__5"', '"1d"', '"0x1p3"', '"12.5"', '" 1_000.5 "', '"1e3"',
    '"nan"', '"-inf"', '".5"', '"5."', '"."', "[1]", "{}", "1e400", '"1 2"',
]


def _whole(value):
    try:
        return int(value)
    except (TypeError, ValueError, OverflowError):
        return 0 if not isinstance(value, float) else None  # infinity


def _real(value):
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def test_coercion_agrees_with_plain_conversion(spark):
    raw = spark.createDataFrame([(v,) for v in VALUES], "raw string")
    value = F.try_parse_json("raw")
    found = raw.select("raw", coerce.days_past_due(value).alias("d"), coerce.amount(value).alias("a"))
    for row in found.collect():
        plain = json.loads(row.raw)
        assert row.d == _whole(plain), row.raw
        assert repr(row.a) == repr(_real(plain)), row.raw


def test_numbers_beyond_bigint_are_unusable(spark):
    raw = spark.createDataFrame([('"99999999999999999999"',), ("-99999999999999999999",)], "raw string")
    found = raw.select(coerce.days_past_due(F.try_parse_json("raw")).alias("d")).collect()
    assert [r.d for r in found] == [None, None]


@pytest.mark.parametrize("text,expected", [("015", 15), ("XXX", 0), (None, 0), (" +7", 7), ("1_0", 10)])
def test_days_past_due_text(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t string").select(coerce.days_past_due_text(F.col("t")))
    assert row.first()[0] == expected


def test_pairing_keeps_the_first_reason(spark):
    other = dict(BANKING, LOAN_APP_ID="APP000999")
    bureau = documents(
        spark, good=BUREAU, torn="{", alone=BUREAU, empty=dict(BUREAU, TRADES=[]), differ=BUREAU,
        no_txns=BUREAU, both="{", bad_txns=BUREAU,
    )
    banking = documents(
        spark, good=BANKING, torn=BANKING, empty=BANKING, differ=other, both="[]", orphan=BANKING,
        no_txns=dict(BANKING, TRANSACTIONS=[]), bad_txns=without(BANKING, "LOAN_APP_ID"),
    )
    verdicts = pairing.pair_documents(parse.parse_bureau(bureau), parse.parse_banking(banking))
    assert {r.stem: r.reason for r in verdicts.collect()} == {
        "good": None,
        "torn": "bureau_corrupt_json",
        "alone": "banking_missing_file",
        "empty": "bureau_empty",
        "no_txns": "banking_empty",
        "differ": "id_mismatch",
        "both": "bureau_corrupt_json",
        "bad_txns": "banking_missing_id",
        "orphan": "bureau_missing_file",
    }
    assert pairing.skipped_count(verdicts).first().skipped == 7
    counts = {r.reason: r.documents for r in pairing.reject_counts(verdicts).collect()}
    assert counts["bureau_corrupt_json"] == 2
    kept = pairing.accepted(parse.parse_bureau(bureau), pairing.rejects(verdicts))
    assert [r.stem for r in kept.collect()] == ["good"]
    assert [r.stem for r in pairing.without_statement(bureau, banking).collect()] == ["alone"]


def test_union_is_a_bag(spark):
    rows = flatten.flatten_trades(parse.parse_bureau(documents(spark, a=BUREAU)))
    assert flatten.union_all(rows, rows, rows).count() == 6


def test_missing_paths(spark):
    """By hand, over documents that lack keys at both levels, hold odd items or are no objects."""
    texts = [
        '{"A": 1, "T": [{"X": 1, "Y": null}, {"X": 2}, 5, null]}',
        '{"T": []}',
        '{"A": null, "T": null}',
        '{"A": "x", "T": {"X": 1}}',
        '{"A": 1}',
        "[1]",
        "broken",
        None,
        '{"T": [{"Y": 1}]}',
    ]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "stem string, raw string")
    want = Counter()
    places = Counter()
    for text in texts:
        try:
            doc = json.loads(text)
        except (TypeError, ValueError):
            continue
        if not isinstance(doc, dict):
            continue
        items = doc.get("T") if isinstance(doc.get("T"), list) else []
        lacks = Counter({k: int(k not in doc) for k in "AT"})
        lacks.update({f"T[].{k}": sum(not isinstance(i, dict) or k not in i for i in items) for k in "XY"})
        places.update(lacks)
        want.update({k: int(n > 0) for k, n in lacks.items()})
    got = quality.missing_paths(docs, ["A", "T"], "T", ["X", "Y"]).collect()
    assert [r.path for r in got] == ["A", "T", "T[].X", "T[].Y"]
    assert {r.path: (r.documents, r.places) for r in got} == {p: (want[p], places[p]) for p in want}
    assert quality.missing_paths(docs.limit(0), ["A"], "T", ["X"]).where("documents + places > 0").count() == 0
