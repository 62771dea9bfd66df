import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ordering, quality


def _scores(spark, n=3000, seed=1):
    """A third of the rows share one score."""
    draw = random.Random(seed)
    rows = [(f"A{i:05d}", 0.5 if draw.random() < 1 / 3 else round(draw.random(), 2)) for i in range(n)]
    draw.shuffle(rows)
    return rows, spark.createDataFrame(rows, "loan_app_id string, pd_score double")


def _order():
    return [F.col("pd_score").asc_nulls_last(), F.col("loan_app_id").asc_nulls_last()]


@pytest.fixture(params=[8, 200])
def shuffle_partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_row_numbers_with_merged_ranges(spark, shuffle_partitions):
    """Adaptive execution merges small ranges; wide rows keep several of them apart."""
    rows, df = _scores(spark, 5000)
    hashes = [F.sha2(F.concat("loan_app_id", F.lit(str(i))), 512) for i in range(8)]
    wide = df.withColumn("filler", F.concat(*hashes))
    adaptive = "spark.sql.adaptive"
    settings = {
        f"{adaptive}.advisoryPartitionSizeInBytes": "256k",
        f"{adaptive}.coalescePartitions.minPartitionSize": "64k",
    }
    for parallel in ("true", "false"):
        settings[f"{adaptive}.coalescePartitions.parallelismFirst"] = parallel
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            placed = ordering._place(wide, _order(), None)
            found = ordering.number_rows(wide, _order(), "rank").select("loan_app_id", "rank").collect()
        finally:
            for key in settings:
                spark.conf.unset(key)
        bins = placed.select("_bin").distinct().count()
        assert 1 < bins <= shuffle_partitions
        expected = {key: i + 1 for i, (key, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
        assert {r.loan_app_id: r["rank"] for r in found} == expected


@pytest.mark.parametrize("partitions", [None, 1, 4, 64])
def test_row_numbers(spark, partitions):
    rows, df = _scores(spark)
    found = ordering.number_rows(df.repartition(7), _order(), "rank", "n", partitions).collect()
    expected = {key: i + 1 for i, (key, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert {r.loan_app_id: r["rank"] for r in found} == expected
    assert {r.n for r in found} == {len(rows)}


def test_equal_scores_spread_over_partitions(spark):
    _, df = _scores(spark)
    placed = ordering._place(df, _order(), 16)
    sizes = [r["count"] for r in placed.groupBy("_bin").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 3000 / 16


def test_nulls_come_last_and_empty_input(spark):
    df = spark.createDataFrame([("a", None), ("b", 0.1), ("c", 0.3)], "loan_app_id string, pd_score double")
    found = ordering.number_rows(df, _order(), "rank").collect()
    assert {r.loan_app_id: r["rank"] for r in found} == {"b": 1, "c": 2, "a": 3}
    assert ordering.number_rows(df.limit(0), _order(), "rank").count() == 0


@pytest.mark.parametrize("partitions", [None, 1, 5, 40])
def test_running_totals(spark, partitions):
    draw = random.Random(3)
    rows = [(i / 7, draw.randint(0, 9), draw.randint(0, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "s double, a bigint, b bigint").repartition(6)
    found = ordering.running_totals(df, [F.col("s").desc()], {"a": "a", "b": "b"}, partitions).collect()
    a = b = 0
    expected = {}
    for s, x, y in sorted(rows, reverse=True):
        a, b = a + x, b + y
        expected[s] = (a, b)
    assert {r.s: (r.cum_a, r.cum_b) for r in found} == expected
    assert {(r.all_a, r.all_b) for r in found} == {(a, b)}


def test_no_single_task_over_the_rows(spark):
    _, df = _scores(spark, 200)
    plan = ordering.with_ntile(df, _order(), 5, "q")._jdf.queryExecution().executedPlan().toString()
    before, single, after = plan.partition("Exchange SinglePartition")
    assert single and "Exchange SinglePartition" not in after
    below = after.strip().splitlines()[1]
    assert "HashAggregate(keys=[_bin" in below  # only one row per bin gets there


def _bucket(spark, n, function, buckets):
    ranks = spark.range(1, n + 1).withColumn("n", F.lit(n).cast("bigint"))
    rows = ranks.select("id", function(F.col("id"), F.col("n"), buckets).alias("b")).orderBy("id")
    return [r.b for r in rows.collect()]


@pytest.mark.parametrize("n", [1, 3, 5, 7, 12, 23, 100])
def test_ntile(spark, n):
    size, extra = divmod(n, 5)
    expected = [k + 1 for k in range(5) for _ in range(size + (k < extra))]
    assert _bucket(spark, n, ordering.ntile_bucket, 5) == expected


def test_quantile_bins_of_every_size(spark):
    """All sizes up to 400 at once, against the equal-frequency cut of an array library."""
    sizes = range(2, 401)
    pairs = pd.DataFrame([(n, r) for n in sizes for r in range(1, n + 1)], columns=["n", "r"])
    df = spark.createDataFrame(pairs)
    found = df.select("n", "r", ordering.quantile_bucket(F.col("r"), F.col("n"), 10).alias("b")).toPandas()
    found = found.sort_values(["n", "r"]).b.to_numpy()
    expected = np.concatenate(
        [pd.qcut(pd.Series(np.arange(1, n + 1.0)), 10, labels=False).to_numpy() + 1 for n in sizes]
    )
    assert (found == expected).all()


def test_previous_row_across_chunks(spark):
    rows = [("hot", i, i * 2) for i in range(50)] + [("cold", 0, 7), ("cold", 9, 8), ("cold", 25, 9)]
    df = spark.createDataFrame(rows, "k string, pos int, v int").repartition(5)
    for chunk in (1, 4, 100):
        found = ordering.with_previous(df, ["k"], "pos", ["v"], chunk).collect()
        got = {(r.k, r.pos): r.prev_v for r in found}
        expected = {("hot", i): None if i == 0 else (i - 1) * 2 for i in range(50)}
        expected |= {("cold", 0): None, ("cold", 9): 7, ("cold", 25): 8}
        assert got == expected, chunk


def test_statement_checks(spark):
    rows = [
        ("A", 0, "2024-01-01", 100.0, "CR", 100.0),
        ("A", 1, "2024-01-03", 30.0, "DR", 70.0),
        ("A", 2, "2024-01-02", 20.0, "CR", 90.01),
        ("A", 3, "2024-01-04", 5.0, "DR", 99.0),
        ("B", 0, "2023-01-01", 1.0, "DR", -1.0),
    ]
    df = spark.createDataFrame(
        rows, "loan_app_id string, pos int, txn_date string, txn_amount double, txn_type string, bal_after double"
    )
    dates = quality.chronology_breaks(df, ["loan_app_id"]).collect()
    assert [(r.loan_app_id, r.pos) for r in dates] == [("A", 2)]
    balances = quality.balance_breaks(df, ["loan_app_id"])
    assert [(r.loan_app_id, r.pos) for r in balances.collect()] == [("A", 3)]
    assert [tuple(r) for r in quality.breaks_per_applicant(balances).collect()] == [("A", 1)]
