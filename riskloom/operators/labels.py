"""Observed outcomes on the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.schemas import KEY, LABEL

# Copies of one label row are unfolded in slices of this many, so no array grows with the copies.
_SLICE = 10_000


def attach_labels(features: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Left join of the outcomes; ``None`` leaves the table as it is.

    An id with several label rows gives as many feature rows. Equal label rows are counted and cut into
    slices on their own narrow side, before the join, and unfolded after it. Only if some id has more copies
    than a slice holds, which the labels alone tell, are the joined rows dealt out by id and slice first; the
    feature side is planned once either way.
    """
    if labels is None:
        return features
    counted = labels.groupBy(*labels.columns).agg(F.count("*").alias("_copies"))
    slices = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_copies - 1) div {_SLICE}"))
    sliced = counted.withColumn("_slice", F.explode(slices))
    rest = F.least(F.coalesce(F.col("_copies") - F.col("_slice") * _SLICE, F.lit(1)), F.lit(_SLICE))
    joined = features.join(sliced, KEY, "left")
    if not counted.where(F.col("_copies") > _SLICE).isEmpty():
        joined = joined.repartition(F.col(KEY), F.col("_slice"))
    unfolded = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), rest)))
    return unfolded.drop("_copies", "_slice", "_copy")


def label_coverage(features: DataFrame) -> DataFrame:
    """One row ``matched, total``: applicants with an outcome, and all."""
    return features.agg(F.count(LABEL).alias("matched"), F.count("*").alias("total"))


def labelled_rows(features: DataFrame) -> DataFrame:
    """Rows with an outcome, the outcome as int."""
    return features.where(F.col(LABEL).isNotNull()).withColumn(LABEL, F.col(LABEL).cast("int"))


def require_labels(features: DataFrame) -> DataFrame:
    """The labelled rows; an error when there is no outcome column or no outcome at all."""
    if LABEL not in features.columns or labelled_rows(features).select(LABEL).isEmpty():
        raise ValueError(f"no {LABEL} values: build the feature table with a labels file")
    return labelled_rows(features)


def base_default_rate(table: DataFrame) -> DataFrame:
    """One row ``applicants, default_rate`` over the labelled rows."""
    return table.agg(F.count(LABEL).alias("applicants"), F.avg(LABEL).alias("default_rate"))


def build_summary(features: DataFrame, skipped: DataFrame) -> DataFrame:
    """One row ``applicants, columns, skipped``."""
    counted = features.agg(F.count("*").alias("applicants"))
    return counted.select(
        "applicants",
        F.lit(len(features.columns)).alias("columns"),
        skipped.select("skipped").scalar().alias("skipped"),
    )
