"""The stages as plain functions: build, score, analytics, and all of them in turn.

Stages hand over through tables only, so each can be its own Spark application.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators import discrimination, document_features, labels, models, pairing, parse
from riskloom.operators.reports import report_pack
from riskloom.sources import documents, tables


@dataclass(frozen=True)
class Layout:
    """Where inputs and outputs live, under one root by default."""

    root: str

    @property
    def bureau(self) -> str:
        return f"{self.root}/raw/bureau"

    @property
    def banking(self) -> str:
        return f"{self.root}/raw/banking"

    @property
    def labels(self) -> str:
        return f"{self.root}/raw/labels.csv"

    @property
    def parsed_bureau(self) -> str:
        return f"{self.root}/processed/parsed_bureau"

    @property
    def parsed_banking(self) -> str:
        return f"{self.root}/processed/parsed_banking"

    @property
    def pairs(self) -> str:
        return f"{self.root}/processed/pairs"

    @property
    def rejects(self) -> str:
        return f"{self.root}/processed/rejects"

    @property
    def features(self) -> str:
        return f"{self.root}/processed/features"

    @property
    def scored(self) -> str:
        return f"{self.root}/processed/features_scored"

    @property
    def model(self) -> str:
        return f"{self.root}/models/pd_model"


def build_from_documents(
    spark: SparkSession,
    layout: Layout,
    bureau_docs: DataFrame,
    banking_docs: DataFrame,
    outcomes: DataFrame | None,
    money_scale: int | None = None,
) -> DataFrame:
    """Documents (``stem, raw``) -> parsed tables, pairs, quarantine table, feature table.

    Raw text is read and parsed once. Each parsed document then becomes one narrow row next to its scan;
    pairing, quarantine and features work on those rows.
    """
    tables.write_table(parse.parse_bureau(bureau_docs), layout.parsed_bureau)
    tables.write_table(parse.parse_banking(banking_docs), layout.parsed_banking)
    bureau = spark.read.parquet(layout.parsed_bureau)
    banking = spark.read.parquet(layout.parsed_banking)
    tables.write_table(document_features.pair_facts(bureau, banking, money_scale), layout.pairs)
    pairs = spark.read.parquet(layout.pairs)
    tables.write_table(pairing.rejects(pairs), layout.rejects)
    table = document_features.features_of_pairs(pairs, bureau, money_scale)
    tables.write_table(labels.attach_labels(table, outcomes), layout.features)
    written = spark.read.parquet(layout.features)
    if written.isEmpty():
        raise RuntimeError("every document was rejected: see the quarantine table for the reasons")
    return written


def build(
    spark: SparkSession,
    layout: Layout,
    limit: int | None = None,
    money_scale: int | None = None,
    glob: str = documents.DOCUMENT_GLOB,
) -> DataFrame:
    """Build the feature table from the raw document folders; ``limit`` takes the first files."""
    bureau = documents.read_first_documents(spark, layout.bureau, limit, glob)
    if limit:
        banking = documents.read_matching_documents(spark, layout.banking, bureau, glob)
    else:
        banking = documents.read_documents(spark, layout.banking, glob)
    outcomes = tables.read_labels(spark, layout.labels)
    return build_from_documents(spark, layout, bureau, banking, outcomes, money_scale)


def build_report(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row after a build: applicants, columns, skipped."""
    rejected = spark.read.parquet(layout.rejects)
    return labels.build_summary(
        spark.read.parquet(layout.features), pairing.skipped_count(rejected)
    )


def score(
    spark: SparkSession,
    layout: Layout,
    test_size: float = models.TEST_SIZE,
    score_all: bool = False,
    mark_test_rows: bool = False,
    boosting_rounds: int = models.BOOSTING_ROUNDS,
) -> dict[str, DataFrame]:
    """Train on the labelled applicants and write the scored table and the model.

    Labelled applicants are scored, training rows included; ``score_all`` adds those without an
    outcome, ``mark_test_rows`` adds ``is_test``. Returns the comparison and decile tables.
    """
    table = tables.read_features(spark, layout.features)
    labelled = labels.require_labels(table)
    trained = models.train(labelled, test_size, boosting_rounds=boosting_rounds)
    scored = models.apply_model(
        trained.models[trained.champion], table if score_all else labelled
    )
    if mark_test_rows:
        keys = [models.KEY, models.LABEL]
        marks = trained.split.select(*keys, "is_test").dropDuplicates(keys)
        scored = scored.join(marks, keys, "left")
    tables.write_table(scored, layout.scored)
    models.save_model(trained, layout.model)
    written = spark.read.parquet(layout.scored)
    return {
        "model_comparison": models.comparison(trained, written),
        "pd_deciles": discrimination.decile_table(labels.labelled_rows(written)),
    }


def analytics(spark: SparkSession, layout: Layout, view: str = "applicants") -> dict[str, DataFrame]:
    """The report pack over the scored table, or over the feature table before any scoring."""
    return report_pack(tables.report_source(spark, layout.scored, layout.features, view))


def run_all(
    spark: SparkSession,
    layout: Layout,
    limit: int | None = None,
    boosting_rounds: int = models.BOOSTING_ROUNDS,
) -> dict[str, DataFrame]:
    """build, score and analytics in turn; returns every result table by name."""
    build(spark, layout, limit)
    results = score(spark, layout, boosting_rounds=boosting_rounds)
    return {**results, **analytics(spark, layout)}
