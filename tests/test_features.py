import pytest
from fixtures import by_id, trades, transactions
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.operators import features, labels


@pytest.mark.parametrize("money_scale", [None, 2])
def test_bureau_features(spark, money_scale):
    out = by_id(features.bureau_features(trades(spark), money_scale=money_scale))
    assert out["B7"].num_trades == 2
    assert out["B7"].max_dpd == 61 and out["B7"].avg_dpd == 45.0
    assert out["B7"].total_sanctioned_amount == 10500.0
    assert out["B7"].total_current_balance == 2000.0
    assert (out["B7"].dpd_30_plus, out["B7"].dpd_60_plus, out["B7"].dpd_90_plus) == (1, 1, 0)
    assert out["B9"].dpd_90_plus == 1
    assert (out["B7"].bureau, out["B9"].score_v3) == ("Tessera", 512)


@pytest.mark.parametrize("money_scale", [None, 2])
def test_banking_features(spark, money_scale):
    out = by_id(features.banking_features(transactions(spark), money_scale=money_scale))
    assert out["B7"].txn_count == 3
    assert out["B7"].total_credits == 900.0
    assert out["B7"].total_debits == 450.0
    assert out["B7"].salary_credits_count == 1
    assert out["B7"].emi_txn_count == 1
    assert out["B7"].cash_withdrawal_count == 1
    assert out["B7"].avg_balance == 1200.0
    assert out["B9"].min_balance == -45.0
    assert out["B9"].total_credits == 0.0


def test_headers_give_the_same_table(spark):
    flat = features.bureau_features(trades(spark))
    heads = trades(spark).select("loan_app_id", "score_v3", "bureau").distinct()
    joined = features.bureau_features(trades(spark).drop("score_v3", "bureau"), headers=heads)
    assert joined.columns == flat.columns
    assert by_id(joined) == by_id(flat)


@pytest.mark.parametrize(
    "score,max_dpd,band",
    [
        (750, 89, 1), (749, 89, 2), (650, 0, 2), (649, 0, 3), (500, 0, 3), (499, 0, 4), (850, 90, 5),
        (499, 90, 5), (None, 0, 1),
    ],
)
def test_risk_band(spark, score, max_dpd, band):
    row = spark.createDataFrame([(score, max_dpd)], "s int, d int")
    assert row.select(rules.risk_band(F.col("s"), F.col("d"))).first()[0] == band


def test_feature_table(spark):
    table = features.build_features(trades(spark), transactions(spark))
    out = by_id(table)
    assert table.count() == 2 and len(table.columns) == 23
    assert out["B9"].risk_band == 5


def test_first_known_takes_document_order(spark):
    rows = [("A", "f2", 0, "late"), ("A", "f1", 1, "first"), ("A", "f1", 0, None), ("B", "f1", 0, None)]
    df = spark.createDataFrame(rows, "loan_app_id string, stem string, pos int, bureau string")
    found = df.groupBy("loan_app_id").agg(
        features.first_known(F.col("bureau"), ["stem", "pos"]).alias("b")
    )
    assert {r.loan_app_id: r.b for r in found.collect()} == {"A": "first", "B": None}


def test_unknown_values(spark):
    nan = float("nan")
    rows = [("A", nan, "CR", nan, None), ("A", 5.0, None, 2.0, "SALARY for June"), ("A", 7.0, "DR", 4.0, "Premium")]
    df = spark.createDataFrame(
        rows, "loan_app_id string, txn_amount double, txn_type string, bal_after double, txn_desc string"
    ).select("*", F.lit("b").alias("bank_name"), F.lit("1").alias("acct_num"))
    row = features.banking_features(df, order=["txn_desc"]).first()
    assert (row.txn_count, row.total_credits, row.total_debits) == (2, 0.0, 7.0)
    assert (row.avg_balance, row.min_balance, row.max_balance) == (3.0, 2.0, 4.0)
    assert row.salary_credits_count == 1
    assert row.emi_txn_count == 1  # inside "Premium"
    assert features.banking_features(df, order=["txn_desc"], whole_words=True).first().emi_txn_count == 0


def test_null_ids_are_left_out(spark):
    df = trades(spark).withColumn("loan_app_id", F.lit(None).cast("string"))
    assert features.bureau_features(df).count() == 0


def test_features_do_not_depend_on_partitioning(spark):
    expected = by_id(features.build_features(trades(spark), transactions(spark), 2))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            t = trades(spark).repartition(partitions, F.rand(1))
            x = transactions(spark).repartition(partitions, F.rand(2))
            assert by_id(features.build_features(t, x, 2)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hashed_items_and_one_shuffle_per_side(spark):
    heads = trades(spark).select("loan_app_id", "score_v3", "bureau")
    plan = features.banking_features(
        transactions(spark), headers=heads.selectExpr("loan_app_id", "'b' bank_name", "'1' acct_num")
    )._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_joins_add_no_shuffle(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        table = features.build_features(trades(spark), transactions(spark))
        plan = table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # One per side on the key, and one that spreads the distinct trade references.
    assert plan.count("Exchange hashpartitioning") == 3
    assert "SinglePartition" not in plan


def _labels(spark, rows):
    return spark.createDataFrame(rows, "loan_app_id string, default_flag int")


def test_labels(spark):
    table = features.build_features(trades(spark), transactions(spark))
    found = labels.attach_labels(table, _labels(spark, [("B7", 1), ("B0", 0)]))
    assert {r.loan_app_id: r.default_flag for r in found.collect()} == {"B7": 1, "B9": None}
    coverage = labels.label_coverage(found).first()
    assert (coverage.matched, coverage.total) == (1, 2)
    assert labels.require_labels(found).count() == 1
    assert labels.attach_labels(table, None).columns == table.columns


def test_repeated_labels_fan_out(spark, monkeypatch):
    monkeypatch.setattr(labels, "_SLICE", 3)
    many = _labels(spark, [("B7", 1)] * 7 + [("B7", 0)] * 2 + [("B7", None)] + [("B9", 1)])
    found = labels.attach_labels(features.build_features(trades(spark), transactions(spark)), many)
    counts = {(r[0], r[1]): r[2] for r in found.groupBy("loan_app_id", "default_flag").count().collect()}
    assert counts == {("B7", 1): 7, ("B7", 0): 2, ("B7", None): 1, ("B9", 1): 1}


def test_missing_labels_are_an_error(spark):
    table = features.build_features(trades(spark), transactions(spark))
    with pytest.raises(ValueError, match="default_flag"):
        labels.require_labels(table)
    with pytest.raises(ValueError, match="default_flag"):
        labels.require_labels(labels.attach_labels(table, _labels(spark, [("B0", 0)])))


def test_scans_read_only_the_item_columns_in_use(spark, tmp_path):
    from fixtures import BANKING, documents

    from riskloom.operators import flatten, parse, quality

    path = str(tmp_path / "parsed")
    parse.parse_banking(documents(spark, a=BANKING)).write.parquet(path)
    parsed = spark.read.parquet(path)

    def items_read(df):
        schemas = []
        plan = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        for i in range(plan.size()):
            schemas += [a.dataType().simpleString() for a in _java(plan.apply(i).output())]
        return [s for s in schemas if s.startswith("array")]

    def _java(seq):
        return [seq.apply(i) for i in range(seq.size())]

    rows = flatten.flatten_transactions(parsed).groupBy("loan_app_id").agg(F.sum("txn_amount"))
    assert items_read(rows) == ["array<struct<txn_amount:double>>"]
    breaks = quality.breaks_per_applicant(quality.chronology_breaks_in_documents(parsed))
    assert items_read(breaks) == ["array<struct<txn_date:timestamp_ntz>>"]


def test_first_values_need_an_order(spark):
    with pytest.raises(ValueError, match="order"):
        features.build_features(trades(spark).drop("pos"), transactions(spark))


def test_money_beyond_64_bits_is_an_error(spark):
    df = spark.createDataFrame([(2e17,)], "x double")
    with pytest.raises(Exception, match="64-bit"):
        df.agg(features.money_sum(F.col("x"), 2)).collect()
    assert df.agg(features.money_sum(F.col("x") / 10, 2)).first()[0] == 2e16


def test_copies_of_a_hot_label_spread(spark, monkeypatch):
    monkeypatch.setattr(labels, "_SLICE", 100)
    hot = spark.range(20_000).selectExpr("'B7' AS loan_app_id", "1 AS default_flag")
    table = features.build_features(trades(spark), transactions(spark))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        sizes = labels.attach_labels(table, hot).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset(merge)
    counts = [r[1] for r in sizes if r[1] > 1]
    assert sum(r[1] for r in sizes) == 20_001
    assert max(counts) < 2 * sum(counts) / len(counts) and len(counts) > 4


def test_labels_plan_the_feature_side_once(spark, monkeypatch):
    features = spark.range(7).select(F.concat(F.lit("A"), "id").alias("loan_app_id"))
    outcomes = spark.createDataFrame([("A1", 1)] * 5 + [("A2", 0)], "loan_app_id string, default_flag int")
    for size, rows in ((10, 11), (2, 11)):  # with and without an id beyond one slice
        monkeypatch.setattr(labels, "_SLICE", size)
        joined = labels.attach_labels(features, outcomes)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Range (0, 7") == 1
        assert joined.count() == rows
        assert joined.where("loan_app_id = 'A1' AND default_flag = 1").count() == 5
