"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each one runs a library operator over whole tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions import coerce, rules
from riskloom.functions.rounding import half_away
from riskloom.operators import (
    boosting,
    discrimination,
    document_features,
    features,
    flatten,
    labels,
    logistic,
    model_table,
    models,
    ordering,
    pairing,
    parse,
    quality,
    reports,
)
from riskloom.plans import lending_tables as lending
from riskloom.schemas import KEY, LABEL, MODEL_FEATURES, SCORE
from riskloom.sources import documents, tables
from riskloom.sources.staging import stage, staging_path, staging_root
from riskloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared inputs ---------------------------------------------------------------------------


def _named(by_customer: DataFrame) -> DataFrame:
    """Rows keyed by customer number get the text id, once per applicant instead of per item."""
    return by_customer.withColumn(KEY, lending.applicant_id(F.col(KEY)))


def _bureau(spark: SparkSession, sf: str) -> DataFrame:
    return features.bureau_features(
        lending.trade_facts(spark, sf),
        money_scale=lending.MONEY_SCALE,
        headers=lending.headers(spark, sf),
    )


def _banking(spark: SparkSession, sf: str) -> DataFrame:
    return features.banking_features(
        lending.transaction_facts(spark, sf),
        money_scale=lending.MONEY_SCALE,
        headers=lending.headers(spark, sf),
    )


def bureau_side(spark: SparkSession, sf: str) -> DataFrame:
    return _named(_bureau(spark, sf))


def banking_side(spark: SparkSession, sf: str) -> DataFrame:
    return _named(_banking(spark, sf))


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return _named(features.join_features(_bureau(spark, sf), _banking(spark, sf)))


def labelled_table(spark: SparkSession, sf: str) -> DataFrame:
    return labels.attach_labels(feature_table(spark, sf), lending.labels(spark, sf))


def scored_table(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled applicants with the fixed-coefficient PD."""
    return labels.labelled_rows(labelled_table(spark, sf)).withColumn(SCORE, lending.fixed_pd())


def parsed_bureau(spark: SparkSession, sf: str) -> DataFrame:
    """Documents parsed once and written, as the build job does."""
    return stage(parse.parse_bureau(lending.bureau_documents(spark, sf)), "bureau")


def parsed_banking(spark: SparkSession, sf: str) -> DataFrame:
    return stage(parse.parse_banking(lending.banking_documents(spark, sf)), "banking")


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull())


def statuses(parsed: DataFrame, name: str) -> DataFrame:
    """Only the fate of each document, written: where nobody reads items, none are written."""
    return stage(parsed.select("stem", KEY, "reason", "n_items"), name)


def verdicts(spark: SparkSession, sf: str) -> DataFrame:
    return pairing.pair_documents(
        statuses(parse.parse_bureau(lending.bureau_documents(spark, sf), fate_only=True), "bureau"),
        statuses(parse.parse_banking(lending.banking_documents(spark, sf), fate_only=True), "banking"),
    )


# --- sources and sinks -----------------------------------------------------------------------


def _document_folders(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Both document folders in the layout the scan is for: a small file per document, named by its stem, in archives.

    They are compressed, as plain ones take 18 times the disk of the tables.
    """
    root = staging_path(spark, "raw")
    for kind, made in (("bureau", lending.bureau_documents), ("banking", lending.banking_documents)):
        lending.write_documents(made(spark, sf, ordered=True), f"{root}/{kind}", compressed=True, ordered=True)
    return f"{root}/bureau", f"{root}/banking"


def _both_kinds(bureau: DataFrame, banking: DataFrame) -> DataFrame:
    return flatten.union_all(
        bureau.withColumn("kind", F.lit("bureau")), banking.withColumn("kind", F.lit("banking"))
    )


@query
def s1_document_scan(spark, sf):
    bureau, banking = _document_folders(spark, sf)
    docs = _both_kinds(documents.read_documents(spark, bureau), documents.read_documents(spark, banking))
    holder = F.try_variant_get(F.try_parse_json("raw"), "$.LOAN_APP_ID", "string")
    return docs.select("kind", "file_name", "stem", holder.alias(KEY))


@query
def s2_first_documents(spark, sf):
    """The first 25 bureau files by name, and the statements that belong to them."""
    bureau, banking = _document_folders(spark, sf)
    # Written, as each of its uses would look through all archives again.
    first = stage(documents.read_first_documents(spark, bureau, 25), "first")
    docs = _both_kinds(first, documents.read_matching_documents(spark, banking, first))
    return docs.select("kind", "file_name", "stem", F.try_parse_json("raw").isNotNull().alias("readable"))


@query
def s3_paired_documents(spark, sf):
    return verdicts(spark, sf)


@query
def s4_quarantine(spark, sf):
    return pairing.rejects(verdicts(spark, sf))


@query
def s4_reject_counts(spark, sf):
    return pairing.reject_counts(verdicts(spark, sf))


@query
def s5_labels_csv(spark, sf):
    path = staging_path(spark, "labels")
    lending.labels(spark, sf).write.csv(path, header=True)
    return tables.read_labels(spark, path)


@query
def s6_feature_table_written(spark, sf):
    path = staging_path(spark, "features")
    tables.write_table(feature_table(spark, sf), path)
    return tables.read_features(spark, path)


@query
def s8_report_source(spark, sf):
    path = staging_path(spark, "features")
    tables.write_table(feature_table(spark, sf), path)
    tables.report_source(spark, staging_path(spark, "not_scored"), path, "s8_applicants")
    return spark.sql(
        "SELECT risk_band, count(*) AS applicants, max(max_dpd) AS max_dpd "
        "FROM s8_applicants GROUP BY risk_band"
    )


@query
def s9_scored_table_written(spark, sf):
    path = staging_path(spark, "scored")
    tables.write_table(scored_table(spark, sf), path)
    return tables.report_source(spark, path, staging_path(spark, "none"), "s9_applicants").select(
        KEY, LABEL, SCORE
    )


@query
def s11_resumed_ingestion(spark, sf):
    """Documents streamed in batches, then streamed again from the start: nothing is added."""
    docs, incoming = lending.bureau_documents(spark, sf), staging_path(spark, "incoming")
    docs.write.parquet(incoming)
    target = staging_path(spark, "landed")
    for run in ("first", "replayed"):
        source = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 4)
        query = ingest.ingest(
            source.parquet(incoming), target, staging_path(spark, f"{run}-progress")
        )
        query.awaitTermination()
    landed = ingest.landed_documents(spark, target)
    parsed = parse.parse_bureau(landed)
    return parsed.select("stem", KEY, "reason")


# --- flattening and coercion -----------------------------------------------------------------


@query
def p1_trades(spark, sf):
    return flatten.flatten_trades(usable(parsed_bureau(spark, sf)))


@query
def p2_transactions(spark, sf):
    return flatten.flatten_transactions(usable(parsed_banking(spark, sf)))


@query
def p3_days_past_due(spark, sf):
    raw = lending.raw_dpd(F.col("o_orderkey"), F.col("o_orderstatus"))
    coded = lending.table(spark, sf, "orders").select(raw.alias("raw_dpd"))
    value = coerce.days_past_due_text(F.col("raw_dpd"))
    return coded.groupBy("raw_dpd", value.alias("dpd")).agg(F.count("*").alias("trades"))


@query
def p4_amounts(spark, sf):
    """Event properties as amounts: ``k`` is a number, ``none`` is absent."""
    value = F.try_parse_json("props")
    k = coerce.amount(F.try_variant_get(value, "$.k", "variant"))
    none = coerce.amount(F.try_variant_get(value, "$.none", "variant"))
    rows = lending.table(spark, sf, "events").select("event_type", k.alias("k"), none.alias("n"))
    return rows.groupBy("event_type").agg(
        F.sum("k").alias("k_sum"), F.sum("n").alias("absent_sum"), F.count("k").alias("usable")
    )


@query
def p5_dates(spark, sf):
    k = F.col("o_orderkey")
    text = F.when(k % 7 == 0, "31/31/2020").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = lending.table(spark, sf, "orders").select(k, coerce.timestamp(text).alias("opened"))
    return rows


@query
def p5_statement_dates(spark, sf):
    """Dates of statements written in three forms."""
    rows = flatten.flatten_transactions(usable(parsed_banking(spark, sf)), with_position=True)
    return rows.select("stem", "pos", "txn_date")


@query
def p5_unreadable_dates(spark, sf):
    return quality.unreadable_dates(usable(parsed_banking(spark, sf)))


@query
def p6_required_id(spark, sf):
    docs = parse.parse_bureau(lending.bureau_documents(spark, sf))
    parsed = statuses(docs, "bureau").where(F.col("reason") == "missing_id")
    return parsed.select("stem")


@query
def p7_empty_documents(spark, sf):
    parsed = usable(parsed_bureau(spark, sf)).where(F.col("n_items") == 0)
    rows = flatten.flatten_trades(parsed, with_position=True)
    counted = rows.groupBy("stem").agg(F.count("*").alias("n"))
    return parsed.join(counted, "stem", "left").select(
        "stem", F.coalesce("n", F.lit(0)).alias("trades")
    )


@query
def p9_union(spark, sf):
    whole = lending.transactions(spark, sf)
    return flatten.union_all(
        whole.where(F.col("txn_type") == "CR"), whole.where(F.col("txn_type") == "DR")
    )


# --- predicates and derived columns ----------------------------------------------------------


@query
def f1_delinquency_flags(spark, sf):
    flags = [f"dpd_{n}_plus" for n in rules.DPD_LEVELS]
    return bureau_side(spark, sf).select(KEY, "max_dpd", *flags)


@query
def f2_f4_transaction_flags(spark, sf):
    flagged = features.flag_transactions(lending.transactions(spark, sf))
    counts = ["is_credit", "is_debit", "is_salary", "is_emi", "is_cash_withdrawal"]
    return flagged.groupBy("txn_type", "txn_desc").agg(
        *[F.sum(c).alias(c) for c in counts],
        features.money_sum(F.col("credit_amt"), lending.MONEY_SCALE).alias("credit_amt"),
        features.money_sum(F.col("debit_amt"), lending.MONEY_SCALE).alias("debit_amt"),
    )


@query
def f5_risk_band(spark, sf):
    band = rules.risk_band(F.col("score_v3"), F.col("max_dpd")).alias("risk_band")
    return bureau_side(spark, sf).select(KEY, "score_v3", "max_dpd", band)


@query
def f6_labelled_rows(spark, sf):
    return labels.labelled_rows(labelled_table(spark, sf)).select(KEY, LABEL, "risk_band")


@query
def f7_model_columns(spark, sf):
    """A table that lacks some model features keeps the rest, in their order."""
    table = bureau_side(spark, sf).drop("avg_dpd")
    return table.select(KEY, *models.usable_features(table))


@query
def f8_label_guard(spark, sf):
    return labels.require_labels(labelled_table(spark, sf)).agg(F.count("*").alias("labelled"))


# --- joins -----------------------------------------------------------------------------------


@query
def j1_joined_features(spark, sf):
    return feature_table(spark, sf).select(KEY, "num_trades", "txn_count", "risk_band")


@query
def j2_labels_joined(spark, sf):
    """Orders' priorities as outcomes: ids with several label rows fan out."""
    many = lending.table(spark, sf, "orders").select(
        lending.applicant_id(F.col("o_custkey")).alias(KEY),
        (F.col("o_orderstatus") == "F").cast("int").alias(LABEL),
    )
    every = lending.applicants(spark, sf).select(KEY, "score_v3")
    return labels.attach_labels(every, many)


@query
def j3_without_statement(spark, sf):
    missing = pairing.without_statement(
        lending.bureau_documents(spark, sf), lending.banking_documents(spark, sf)
    )
    return missing.select("stem")


@query
def j4_label_coverage(spark, sf):
    return labels.label_coverage(labelled_table(spark, sf))


# --- aggregation -----------------------------------------------------------------------------


@query
def a1_first_known(spark, sf):
    """First non-null value in document order, over a column with gaps."""
    k = F.col("o_orderkey")
    rows = lending.table(spark, sf, "orders").select(
        lending.applicant_id(F.col("o_custkey")).alias(KEY),
        F.when(k % 3 != 0, lending.pick(lending.BUREAUS, k)).alias("bureau"),
        k.alias("pos"),
    )
    return rows.groupBy(KEY).agg(features.first_known(F.col("bureau"), ["pos"]).alias("bureau"))


@query
def a2_a5_bureau_features(spark, sf):
    return bureau_side(spark, sf)


@query
def a6_a10_banking_features(spark, sf):
    return banking_side(spark, sf)


@query
def a11_feature_table(spark, sf):
    return feature_table(spark, sf)


@query
def a11_feature_table_of_flat_tables(spark, sf):
    """The same rows from flat tables that repeat the header values on every item."""
    return features.build_features(
        lending.trades(spark, sf),
        lending.transactions(spark, sf),
        lending.MONEY_SCALE,
        trade_order=lending.TRADE_ORDER,
        transaction_order=["txn_date"],
    )


@query
def a11_features_from_documents(spark, sf):
    """Raw documents to feature rows: parse, pair, quarantine, flatten, aggregate."""
    bureau, banking = parsed_bureau(spark, sf), parsed_banking(spark, sf)
    pairs = stage(document_features.pair_facts(bureau, banking, lending.MONEY_SCALE), "pairs")
    return document_features.features_of_pairs(pairs, bureau, lending.MONEY_SCALE)


@query
def a12_base_default_rate(spark, sf):
    return labels.base_default_rate(labelled_table(spark, sf))


@query
def a13_build_summary(spark, sf):
    return labels.build_summary(
        feature_table(spark, sf), pairing.skipped_count(verdicts(spark, sf))
    )


# --- reports ---------------------------------------------------------------------------------


@query
def r1_band_distribution(spark, sf):
    return reports.band_distribution(feature_table(spark, sf))


@query
def r2_band_profile(spark, sf):
    return reports.band_profile(feature_table(spark, sf))


@query
def r3_top_delinquent(spark, sf):
    return reports.top_delinquent(feature_table(spark, sf))


@query
def r4_default_rate_by_band(spark, sf):
    return reports.default_rate_by_band(scored_table(spark, sf))


@query
def r5_pd_quintiles(spark, sf):
    return reports.pd_quantiles(scored_table(spark, sf))


@query
def r6_report_gate(spark, sf):
    """Which reports there are before and after scoring, with their row counts."""
    sources = {
        "features": stage(feature_table(spark, sf), "features"),
        "scored": stage(scored_table(spark, sf), "scored"),
    }
    counts = [
        report.agg(F.count("*").alias("rows")).select(
            F.lit(source).alias("source"), F.lit(name).alias("report"), "rows"
        )
        for source, table in sources.items()
        for name, report in reports.report_pack(table).items()
    ]
    return reduce(DataFrame.unionByName, counts)


# --- ranks and running totals ----------------------------------------------------------------


def _all_scored(spark: SparkSession, sf: str) -> DataFrame:
    return feature_table(spark, sf).select(KEY, lending.fixed_pd())


def _by_score():
    return [F.col(SCORE).asc_nulls_last(), F.col(KEY).asc_nulls_last()]


@query
def w2_ntile(spark, sf):
    return ordering.with_ntile(_all_scored(spark, sf), _by_score(), 5, "pd_quintile")


@query
def w3_decile(spark, sf):
    return ordering.with_quantile(_all_scored(spark, sf), _by_score(), 10, "pd_decile")


@query
def w3_global_rank(spark, sf):
    """Every order ranked by status, a heavily tied key."""
    rows = lending.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    order = [F.col("o_orderstatus").asc_nulls_last(), F.col("o_orderkey").asc_nulls_last()]
    return ordering.number_rows(rows, order, "rank")


@query
def w4_cumulative_shares(spark, sf):
    shares = discrimination.cumulative_shares(scored_table(spark, sf))
    return shares.select(SCORE, "cum_bad", "cum_good", "cum_bad_share", "cum_good_share")


def _statement_rows(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.flatten_transactions(usable(parsed_banking(spark, sf)), with_position=True)


@query
def w5_chronology_breaks(spark, sf):
    statements = usable(parsed_banking(spark, sf))
    return quality.breaks_per_applicant(quality.chronology_breaks_in_documents(statements))


@query
def w5_chronology_breaks_of_rows(spark, sf):
    """The same from a flat table, where the previous row has to be found by key and position."""
    breaks = quality.chronology_breaks(_statement_rows(spark, sf), ["stem"])
    return quality.breaks_per_applicant(breaks)


@query
def w6_balance_breaks(spark, sf):
    statements = usable(parsed_banking(spark, sf))
    return quality.breaks_per_applicant(quality.balance_breaks_in_documents(statements))


@query
def w6_balance_breaks_of_rows(spark, sf):
    breaks = quality.balance_breaks(_statement_rows(spark, sf), ["stem"])
    return quality.breaks_per_applicant(breaks)


# --- models ----------------------------------------------------------------------------------

def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return labels.require_labels(labelled_table(spark, sf))


def _trained(spark: SparkSession, sf: str) -> tuple[models.Trained, DataFrame]:
    """Both candidates in full, and the labelled applicants.

    The labelled applicants are made once and written; training and scoring read them there. What was trained
    is kept beside them as tables under the application's staging folder, where later queries of the same
    tables find it. Training is reproducible, so it makes no difference which query comes first.
    """
    path = f"{staging_root(spark)}/trained-{hashlib.sha256(sf.encode()).hexdigest()[:16]}"
    try:
        compared = spark.read.parquet(f"{path}/comparison").collect()
    except AnalysisException:
        tables.write_table(_labelled(spark, sf), f"{path}/labelled")
        labelled = spark.read.parquet(f"{path}/labelled")
        trained = models.train(labelled)
        for name, model in trained.models.items():
            model_table.write_model(spark, model, f"{path}/{name}")
        tables.write_table(models.comparison(trained, labelled), f"{path}/comparison")  # last: now it is whole
        return trained, labelled
    labelled = spark.read.parquet(f"{path}/labelled")
    fitted = {r.model: models.load_model(spark, f"{path}/{r.model}") for r in compared}
    metrics = {r.model: {m: r[m] for m in models.METRICS} for r in compared}
    champion = next(r.model for r in compared if r.selected)
    return models.Trained(fitted, metrics, champion, MODEL_FEATURES, labelled), labelled


#: Small candidates whose whole fit SQL can state: one feature, and two rounds of stumps over all of them.
SMALL_LOGISTIC, SMALL_ROUNDS, SMALL_DEPTH = ["score_v3"], 2, 1


def _small(spark: SparkSession, sf: str) -> tuple[models.Trained, DataFrame]:
    """Small candidates by the same steps as the full ones, and the labelled applicants."""
    labelled = stage(_labelled(spark, sf).select(KEY, LABEL, *MODEL_FEATURES), "labelled")
    split = stage(models.stratified_split(labelled), "split")
    train_rows, test_rows = split.where("NOT is_test"), split.where("is_test")
    fitted = {
        models.LOGISTIC: logistic.fit_logistic(train_rows, SMALL_LOGISTIC, models.LOGISTIC),
        models.BOOSTING: boosting.fit_boosting(
            train_rows, MODEL_FEATURES, models.BOOSTING, rounds=SMALL_ROUNDS, depth=SMALL_DEPTH
        ),
    }
    metrics = {name: models.evaluate(model, test_rows) for name, model in fitted.items()}
    return models.Trained(fitted, metrics, models.choose(metrics), MODEL_FEATURES, split), labelled


@query
def m1_feature_matrix(spark, sf):
    matrix = models.feature_matrix(feature_table(spark, sf), MODEL_FEATURES)
    values = matrix.select(F.posexplode(vector_to_array("features")).alias("position", "x"))
    return values.groupBy("position").agg(
        F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )


@query
def m2_stratified_split(spark, sf):
    labelled = labels.labelled_rows(labelled_table(spark, sf)).select(KEY, LABEL)
    return models.stratified_split(labelled)


@query
def m2_split_sizes(spark, sf):
    split = m2_stratified_split(spark, sf)
    return split.groupBy(LABEL, "is_test").agg(F.count("*").alias("applicants"))


@query
def m3_standardized(spark, sf):
    """Mean and deviation the scaler finds, and the spread of what it returns, per feature."""
    matrix = stage(feature_table(spark, sf).select(*MODEL_FEATURES), "matrix")
    matrix = models.feature_matrix(matrix, MODEL_FEATURES)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    scaled = scaler.fit(matrix).transform(matrix)
    pairs = F.arrays_zip(
        vector_to_array("features").alias("x"), vector_to_array("scaled").alias("z")
    )
    values = scaled.select(F.posexplode(pairs).alias("position", "pair"))
    return values.groupBy("position").agg(
        half_away(F.avg("pair.x"), 2).alias("mean"),
        half_away(F.stddev_samp("pair.x"), 2).alias("deviation"),
        half_away(F.abs(F.avg("pair.z")), 6).alias("scaled_mean"),
        half_away(F.stddev_samp("pair.z"), 6).alias("scaled_deviation"),
    )


@query
def m4_logistic_pd(spark, sf):
    trained, labelled = _trained(spark, sf)
    return models.apply_model(trained.models[models.LOGISTIC], labelled).select(KEY, LABEL, SCORE)


@query
def m4_logistic_weights(spark, sf):
    """The fit on one feature: scaling, weight and, without a feature, the intercept."""
    trained, _ = _small(spark, sf)
    nodes = model_table.as_table(spark, trained.models[models.LOGISTIC])
    return nodes.select("feature", *[F.round(c, 4).alias(c) for c in ("mean", "deviation", "value")])


@query
def m5_boosting_pd(spark, sf):
    trained, labelled = _trained(spark, sf)
    return models.apply_model(trained.models[models.BOOSTING], labelled).select(KEY, LABEL, SCORE)


@query
def m5_boosted_stumps(spark, sf):
    """Two rounds of stumps over all features, node by node."""
    trained, _ = _small(spark, sf)
    nodes = model_table.as_table(spark, trained.models[models.BOOSTING])
    return nodes.select("tree", "node", "feature", "threshold", "below", "above", F.round("value", 6).alias("value"))


@query
def m6_probabilities(spark, sf):
    """PD of every labelled applicant by both small models."""
    trained, scored = _small(spark, sf)
    for name, model in trained.models.items():
        scored = models.apply_model(model, scored, f"{name}_pd")
    return scored.select(KEY, LABEL, *[F.round(f"{name}_pd", 6).alias(f"{name}_pd") for name in trained.models])


@query
def m7_m9_discrimination(spark, sf):
    return discrimination.discrimination(scored_table(spark, sf))


@query
def m10_champion(spark, sf):
    trained, labelled = _trained(spark, sf)
    return models.comparison(trained, labelled).where("selected").select("model", "roc_auc")


@query
def m11_scored_applicants(spark, sf):
    trained, labelled = _trained(spark, sf)
    return models.apply_model(trained.models[trained.champion], labelled)


@query
def m10_small_champion(spark, sf):
    trained, labelled = _small(spark, sf)
    return models.comparison(trained, labelled).where("selected").select("model", "roc_auc")


@query
def m11_small_scored(spark, sf):
    """All labelled applicants, training rows included, scored by the better small model."""
    trained, labelled = _small(spark, sf)
    scored = models.apply_model(trained.models[trained.champion], labelled)
    return scored.select(KEY, LABEL, F.round(SCORE, 6).alias(SCORE))


@query
def m12_decile_table(spark, sf):
    return discrimination.decile_table(scored_table(spark, sf), digits=None)


@query
def m13_model_comparison(spark, sf):
    trained, labelled = _trained(spark, sf)
    return models.comparison(trained, labelled)


@query
def m13_small_comparison(spark, sf):
    trained, labelled = _small(spark, sf)
    return models.comparison(trained, labelled)


@query
def s10_model_artifact(spark, sf):
    """The saved winner, loaded again and applied."""
    trained, labelled = _trained(spark, sf)
    path = staging_path(spark, "model")
    models.save_model(trained, path)
    model = models.load_model(spark, path)
    return models.apply_model(model, labelled).select(KEY, F.lit(model.name).alias("model"), SCORE)


@query
def s10_model_table(spark, sf):
    """Both small models written as tables, read again, and joined with the applicants node by node."""
    trained, labelled = _small(spark, sf)
    numbered = labelled.withColumn("nth", F.row_number().over(Window.partitionBy(KEY).orderBy(LABEL)))
    out = []
    for name, model in trained.models.items():
        path = staging_path(spark, "model")
        model_table.write_model(spark, model, path)
        nodes = spark.read.parquet(f"{path}/nodes")
        scored = model_table.score_by_join(nodes, numbered, [KEY, "nth"], model.features)
        out.append(scored.select(F.lit(name).alias("model"), KEY, F.round(SCORE, 6).alias(SCORE)))
    return out[0].unionByName(out[1])


# --- checks ----------------------------------------------------------------------------------


@query
def d1_score_range(spark, sf):
    return quality.score_range(lending.applicants(spark, sf))


@query
def d2_missing_keys(spark, sf):
    return quality.missing_keys(lending.bureau_documents(spark, sf), quality.BUREAU_KEYS)


@query
def d2_missing_paths(spark, sf):
    """Required keys of both kinds of documents and of their items."""
    kinds = {
        "bureau": (lending.bureau_documents, quality.BUREAU_KEYS, "TRADES", quality.TRADE_KEYS),
        "banking": (lending.banking_documents, quality.BANKING_KEYS, "TRANSACTIONS", quality.TRANSACTION_KEYS),
    }
    found = [
        quality.missing_paths(docs(spark, sf), *wanted).select(F.lit(kind).alias("kind"), "*")
        for kind, (docs, *wanted) in kinds.items()
    ]
    return found[0].unionByName(found[1])


@query
def d3_duplicate_applicants(spark, sf):
    return quality.duplicate_applicants(j2_labels_joined(spark, sf))


@query
def d4_decile_check(spark, sf):
    return quality.decile_check(discrimination.decile_table(scored_table(spark, sf), digits=None))
