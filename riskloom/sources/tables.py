"""Labels, feature tables, scored tables and the report source."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.coerce import real_from_text
from riskloom.schemas import KEY, LABEL


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or ``None`` when nothing exists at ``path``."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The applicant feature table; an error when it was not built yet."""
    table = read_table(spark, path)
    if table is None:
        raise FileNotFoundError(f"no feature table at {path}; run the build job first")
    return table


def read_labels(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Observed outcomes from a CSV with a header row; ``None`` when there is no such file.

    Columns are taken by name, in any order; further ones are kept as texts. An outcome may be written as
    a whole or a real number (``1``, ``1.0``) or left empty; any other value than 0 and 1 is an error.
    """
    if path is None:
        return None
    try:
        raw = spark.read.csv(path, header=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    missing = {KEY, LABEL} - set(raw.columns)
    if missing:
        raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
    text = F.trim(F.col(LABEL))
    number = real_from_text(text)
    outcome = (
        F.when(text.isNull() | (text == ""), None)
        .when(number.isin(0.0, 1.0), number.cast("int"))
        .otherwise(F.raise_error(F.concat(F.lit(f"{LABEL} is neither 0 nor 1: "), text)).cast("int"))
    )
    return raw.select(KEY, outcome.alias(LABEL), *[c for c in raw.columns if c not in (KEY, LABEL)])


def write_table(df: DataFrame, path: str) -> None:
    """Write a Parquet table, replacing what was there."""
    df.write.mode("overwrite").parquet(path)


def report_source(
    spark: SparkSession, scored_path: str, features_path: str, view: str = "applicants"
) -> DataFrame:
    """The scored table if there is one, else the feature table, also registered as a SQL view."""
    table = read_table(spark, scored_path)
    if table is None:
        table = read_features(spark, features_path)
    table.createOrReplaceTempView(view)
    return table
