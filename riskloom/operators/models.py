"""Probability-of-default models: split, fit, compare, choose, apply, keep."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.operators import model_table
from riskloom.operators.boosting import fit_boosting
from riskloom.operators.discrimination import discrimination
from riskloom.operators.logistic import fit_logistic
from riskloom.operators.model_table import Model, apply_model
from riskloom.schemas import KEY, LABEL, MODEL_FEATURES
from riskloom.sources.staging import stage

# Model settings.
SEED = 42
TEST_SIZE = 0.2
LOGISTIC_ITERATIONS = 1000
BOOSTING_ROUNDS = 200
BOOSTING_DEPTH = 3
BOOSTING_RATE = 0.05
LOGISTIC = "logistic_regression"
BOOSTING = "gradient_boosting"

METRICS = ["roc_auc", "gini", "ks"]

# Bits of a draw, and how many of them one pass of the split looks at.
DRAW_BITS, PASS_BITS = 60, 15


@dataclass
class Trained:
    """Fitted candidates with their held-out metrics, and the winner's name."""

    models: dict[str, Model]
    metrics: dict[str, dict[str, float | None]]
    champion: str
    features: list[str]
    split: DataFrame


def usable_features(table: DataFrame, wanted: list[str] = MODEL_FEATURES) -> list[str]:
    """The model features the table has, in their fixed order."""
    return [name for name in wanted if name in table.columns]


def draw(seed: int = SEED) -> Column:
    """A number of ``DRAW_BITS`` bits that depends on seed and id alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(KEY), F.lit(""))))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def _cuts(draws: DataFrame, test_size: float) -> dict:
    """Per class: (draw, id, how many rows at them) up to which rows are test rows.

    The class's k-th smallest draw is found by a histogram of its leading bits, then of the next ones
    inside the bin that holds it, and so on; each pass is one aggregate of a bounded number of cells.
    """
    sizes = {r[LABEL]: r["n"] for r in draws.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {c: int(test_size * n + 0.5) for c, n in sizes.items()}
    cuts = {c: (0, k) for c, k in wanted.items() if k > 0}  # leading bits so far, rows wanted with them
    running = Window.partitionBy(LABEL).orderBy("_cell")  # at most 2 ** PASS_BITS cells for a class

    def crossing(cells: DataFrame, wanted_of: Column) -> list:
        """The cell of each class in which its wanted row lies, and the rows before it."""
        summed = cells.withColumn("_upto", F.sum("_n").over(running)).withColumn("_k", wanted_of)
        return summed.where("_upto >= _k AND _upto - _n < _k").collect()

    for shift in range(DRAW_BITS - PASS_BITS, -1, -PASS_BITS):
        if not cuts:
            return {}
        inside = F.lit(False)
        k_of = F.lit(None).cast("bigint")
        for c, (bits, k) in cuts.items():
            inside = inside | ((F.col(LABEL) == c) & (F.shiftright("_draw", shift + PASS_BITS) == bits))
            k_of = F.when(F.col(LABEL) == c, F.lit(k)).otherwise(k_of)
        cells = draws.where(inside).groupBy(LABEL, F.shiftright("_draw", shift).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
        cuts = {r[LABEL]: (r["_cell"], r["_k"] - (r["_upto"] - r["_n"])) for r in crossing(cells, k_of)}
    # Ids that share the whole draw, most often one: the cut is at one of them.
    inside, k_of = F.lit(False), F.lit(None).cast("bigint")
    for c, (bits, k) in cuts.items():
        inside = inside | ((F.col(LABEL) == c) & (F.col("_draw") == bits))
        k_of = F.when(F.col(LABEL) == c, F.lit(k)).otherwise(k_of)
    cells = draws.where(inside).groupBy(LABEL, F.col("_name").alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    found = crossing(cells, k_of)
    return {r[LABEL]: (cuts[r[LABEL]][0], r["_cell"], r["_k"] - (r["_upto"] - r["_n"]), r["_n"]) for r in found}


def stratified_split(labelled: DataFrame, test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """``labelled`` with ``is_test``: in every class exactly ``round(test_size * class size)`` rows.

    Test rows are those of the smallest draws, a hash of seed and id, so the choice depends on neither
    partitioning nor row order. Nothing is sorted or moved: the k-th draw of a class is found by a few
    aggregates, and a row then knows by its own draw. Only if an id at the cut has several rows, some of
    which are wanted, are these rows numbered: they are written with their places and counted by partition.
    """
    columns = [F.col(f"`{c}`") for c in labelled.columns]
    draws = labelled.withColumns({"_draw": draw(seed), "_name": F.coalesce(F.col(KEY), F.lit(""))})
    cuts = _cuts(draws.select(LABEL, "_draw", "_name"), test_size)
    chosen, tied = F.lit(False), F.lit(False)
    for c, (at, name, rows, of) in cuts.items():
        here = F.col(LABEL) == c
        last = F.col("_name") <= name if rows == of else F.col("_name") < name
        chosen = chosen | (here & ((F.col("_draw") < at) | ((F.col("_draw") == at) & last)))
        if rows < of:
            tied = tied | (here & (F.col("_draw") == at) & (F.col("_name") == name))
    split = draws.withColumn("is_test", F.coalesce(chosen, F.lit(False)))
    halves = {c: rows for c, (_, _, rows, of) in cuts.items() if rows < of}
    if not halves:
        return split.select(*columns, "is_test")
    alike = stage(draws.where(tied).withColumn("_at", F.monotonically_increasing_id()), "alike")
    part = F.shiftright("_at", 33).alias("_part")
    sums = alike.groupBy(LABEL, part).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(LABEL).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(LABEL, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_before"))
    # Within a partition, rows of a class are numbered by their places: they are few or alike.
    inside = Window.partitionBy(LABEL, "_part").orderBy("_at")
    numbered = alike.withColumn("_part", part).withColumn("_nth", F.row_number().over(inside)).join(shifts, [LABEL, "_part"])
    wanted = F.lit(0)
    for c, rows in halves.items():
        wanted = F.when(F.col(LABEL) == c, F.lit(rows)).otherwise(wanted)
    marked = numbered.withColumn("is_test", F.col("_before") + F.col("_nth") <= wanted)
    return split.where(~tied).select(*columns, "is_test").unionByName(marked.select(*columns, "is_test"))


def feature_matrix(table: DataFrame, features: list[str]) -> DataFrame:
    """``table`` with the vector column ``features``; a null or NaN feature is an error."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    return assembler.transform(table)


def fit_candidates(train_rows: DataFrame, features: list[str], boosting_rounds: int = BOOSTING_ROUNDS) -> dict[str, Model]:
    """Both candidates fitted, the logistic one first."""
    return {
        LOGISTIC: fit_logistic(train_rows, features, LOGISTIC, iterations=LOGISTIC_ITERATIONS),
        BOOSTING: fit_boosting(
            train_rows, features, BOOSTING, rounds=boosting_rounds, depth=BOOSTING_DEPTH, rate=BOOSTING_RATE
        ),
    }


def evaluate(model: Model, test: DataFrame) -> dict[str, float | None]:
    """ROC AUC, Gini and KS on held-out rows, rounded to 4 digits."""
    scored = apply_model(model, test.select(KEY, LABEL, *model.features))
    row = discrimination(scored).first()
    return {name: None if row[name] is None else round(row[name], 4) for name in METRICS}


def choose(metrics: dict[str, dict[str, float | None]]) -> str:
    """The candidate with the highest rounded AUC; the earlier one wins a tie."""
    return max(metrics, key=lambda name: metrics[name]["roc_auc"] or 0.0)


def train(
    labelled: DataFrame,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    boosting_rounds: int = BOOSTING_ROUNDS,
    partitions: int | None = None,
) -> Trained:
    """Split, fit both candidates, evaluate them on the held-out rows, choose the champion.

    The rows are written under ``spark.checkpoint.dir`` and read by every step of the fits. Boosting runs
    hundreds of short jobs; ``partitions`` sets how many tasks each has, else the rows stay in the
    partitions they were written in.
    """
    features = usable_features(labelled)
    rows = stage(labelled.select(KEY, LABEL, *features), "labelled")
    split = stage(stratified_split(rows, test_size, seed), "split")
    train_rows, test_rows = split.where(~F.col("is_test")), split.where("is_test")
    if partitions:
        train_rows = train_rows.coalesce(partitions)
    fitted = fit_candidates(train_rows, features, boosting_rounds)
    metrics = {name: evaluate(model, test_rows) for name, model in fitted.items()}
    return Trained(fitted, metrics, choose(metrics), features, split)


def comparison(trained: Trained, like: DataFrame) -> DataFrame:
    """``model, roc_auc, gini, ks, selected``: one row per candidate."""
    rows = [
        (name, *[values[m] for m in METRICS], name == trained.champion)
        for name, values in trained.metrics.items()
    ]
    return like.sparkSession.createDataFrame(
        rows, "model string, roc_auc double, gini double, ks double, selected boolean"
    )


def save_model(trained: Trained, path: str) -> None:
    """The winning model as tables: its rows, its name and its features."""
    model_table.write_model(trained.split.sparkSession, trained.models[trained.champion], path)


def load_model(spark: SparkSession, path: str) -> Model:
    """The saved model."""
    return model_table.read_model(spark, path)
