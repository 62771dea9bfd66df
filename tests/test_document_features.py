from datetime import datetime

import pytest
from fixtures import BANKING, BUREAU, documents, without

from riskloom.operators import document_features, features, flatten, pairing, parse
from riskloom.plans import lending_tables


def _item(doc, key, **changes):
    return dict(doc[key][0], **changes)


def _written(spark, tmp_path, bureau, banking):
    for name, df in (("bureau", parse.parse_bureau(bureau)), ("banking", parse.parse_banking(banking))):
        df.write.mode("overwrite").parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / "bureau")), spark.read.parquet(str(tmp_path / "banking"))


def _documents(spark):
    """Two documents of one applicant, one of another, and some that are rejected on either side."""
    odd = dict(
        BUREAU,
        SCORE_V3=None,
        TRADES=[
            _item(BUREAU, "TRADES", CURRENT_BALANCE="nan", DPD="XXX"),
            _item(BUREAU, "TRADES", TRADE_REF_NUM=None, DPD=95),
            without(_item(BUREAU, "TRADES", TRADE_REF_NUM="T-9"), "CURRENT_BALANCE"),
        ],
    )
    words = dict(
        BANKING,
        BANK_NAME=None,
        TRANSACTIONS=[
            _item(BANKING, "TRANSACTIONS", TXN_TYPE="CR", TXN_DESC="SALARY Premium", BAL_AFTER="nan"),
            _item(BANKING, "TRANSACTIONS", TXN_TYPE=None, TXN_DESC=None, TXN_AMOUNT="nan"),
            {},
        ],
    )
    other = {"LOAN_APP_ID": "APP2"}
    references = dict(BUREAU, **other, TRADES=[{"TRADE_REF_NUM": None, "DPD": "1"}])
    bureau = dict(a=odd, b=BUREAU, c=references, d=BUREAU, e=dict(BUREAU, TRADES=[]), f=BUREAU)
    banking = dict(a=words, b=BANKING, c=dict(words, **other), d=dict(BANKING, **other), e=BANKING)
    return documents(spark, **bureau), documents(spark, **banking)


@pytest.mark.parametrize("money_scale", [None, 2])
def test_pairs_give_the_table_of_flattened_items(spark, tmp_path, money_scale):
    bureau, banking = _written(spark, tmp_path, *_documents(spark))
    pairs = document_features.pair_facts(bureau, banking, money_scale)
    pairs.write.parquet(str(tmp_path / "pairs"))
    pairs = spark.read.parquet(str(tmp_path / "pairs"))
    rejected = pairing.rejects(pairs)
    assert {r.stem for r in rejected.collect()} == {"d", "e", "f"}
    want = features.build_features(
        flatten.flatten_trades(pairing.accepted(bureau, rejected), True),
        flatten.flatten_transactions(pairing.accepted(banking, rejected), True),
        money_scale,
    )
    got = document_features.features_of_pairs(pairs, bureau, money_scale)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    rows = sorted(got.collect())
    assert rows == sorted(want.collect())
    assert [(r.loan_app_id, r.num_trades, r.max_dpd) for r in rows] == [("APP004417", 3, 95), ("APP2", 0, 1)]


def test_no_documents_give_no_rows(spark, tmp_path):
    bureau, banking = _written(spark, tmp_path, documents(spark, a=[]), documents(spark, b=[]))
    pairs = document_features.pair_facts(bureau, banking, 2)
    assert document_features.features_of_pairs(pairs, bureau, 2).count() == 0


def test_amounts_beyond_64_bits_matter_only_where_accepted(spark, tmp_path):
    huge = dict(BUREAU, TRADES=[_item(BUREAU, "TRADES", CURRENT_BALANCE=1e18)])
    for banking, fails in ((documents(spark, b=BANKING), False), (documents(spark, a=BANKING), True)):
        bureau, statements = _written(spark, tmp_path, documents(spark, a=huge, b=BUREAU), banking)
        table = document_features.features_of_pairs(document_features.pair_facts(bureau, statements, 2), bureau, 2)
        if fails:
            with pytest.raises(Exception, match="minor units in a"):
                table.collect()
        else:
            assert table.count() == 1


def _exchanged(df):
    """Types of every column that any exchange of the plan carries."""
    types, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
        if "Exchange" in node.nodeName():
            output = node.output()
            types += [output.apply(i).dataType().simpleString() for i in range(output.size())]
    return types


def test_no_exchange_holds_items(spark, tmp_path):
    bureau, banking = _written(spark, tmp_path, *_documents(spark))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        pairs = document_features.pair_facts(bureau, banking, 2)
        carried = _exchanged(pairs)
        pairs.write.parquet(str(tmp_path / "pairs"))
        table = document_features.features_of_pairs(spark.read.parquet(str(tmp_path / "pairs")), bureau, 2)
        carried += _exchanged(table)
        plan = table._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert carried and not [t for t in carried if "array" in t]
    # Pairs on the id; references on the stem, (id, reference) and the id; the quarantine on the stem.
    assert plan.count("Exchange hashpartitioning") == 5 and "SinglePartition" not in plan


def test_documents_are_dealt_before_texts_are_made(spark, tmp_path):
    """No exchange holds texts, and the fate of a document is the same whether its items are made or not."""
    row = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    rows = [(k, k % 9, "FO"[k % 2], 100.5 + k, datetime(2024, 1, 1 + k % 28), "1-URGENT") for k in range(1, 120)]
    spark.createDataFrame(rows, row).write.parquet(f"{tmp_path}/orders.parquet")
    kinds = [
        (lending_tables.bureau_documents, parse.parse_bureau),
        (lending_tables.banking_documents, parse.parse_banking),
    ]
    for documents, parsed in kinds:
        docs = documents(spark, str(tmp_path))
        plan = docs._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("RepartitionByExpression") :]
        assert "LOAN_APP_ID" in plan and "LOAN_APP_ID" not in below
        fate = ["stem", "loan_app_id", "reason", "n_items"]
        whole = sorted(parsed(docs).select(*fate).collect(), key=lambda r: r.stem)
        short = parsed(docs, fate_only=True)
        assert sorted(short.select(*fate).collect(), key=lambda r: r.stem) == whole
        assert len(whole) > 100 and len({r.reason for r in whole}) > 3
        assert not {"trades", "transactions"} & set(short.columns)
