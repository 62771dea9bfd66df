"""Fitted models as rows: weights and tree nodes in one table, and two ways to score with them.

A model is a sum of terms on the scale of log odds. A row with a feature and a weight adds
``value * (x - mean) / deviation``; a row with neither a feature nor children adds ``value``; a row with children
sends ``x <= threshold`` to node ``below`` and the rest to ``above``. Trees are told apart by ``tree``, and each begins
at node 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import SCORE

NODE_SCHEMA = (
    "tree int, node int, feature string, mean double, deviation double,"
    " threshold double, below int, above int, value double"
)


@dataclass(frozen=True)
class Node:
    """One row of a model; see the module."""

    tree: int
    node: int
    feature: str | None = None
    mean: float | None = None
    deviation: float | None = None
    threshold: float | None = None
    below: int | None = None
    above: int | None = None
    value: float | None = None


@dataclass(frozen=True)
class Model:
    """A fitted model: its name, the features it needs, and its rows."""

    name: str
    features: list[str]
    nodes: list[Node]


def _tree_value(nodes: dict[int, Node], at: int) -> Column:
    node = nodes[at]
    if node.below is None:
        return F.lit(node.value)
    low, high = _tree_value(nodes, node.below), _tree_value(nodes, node.above)
    return F.when(F.col(node.feature) <= F.lit(node.threshold), low).otherwise(high)


def _term(rows: list[Node]) -> Column:
    first = rows[0]
    if first.feature is not None and first.below is None:
        return F.lit(first.value) * ((F.col(first.feature) - F.lit(first.mean)) / F.lit(first.deviation))
    return _tree_value({n.node: n for n in rows}, first.node)


def _trees(model: Model) -> list[list[Node]]:
    """The rows of each tree or weight, in the order of their numbers."""
    trees: dict[int, list[Node]] = {}
    for node in sorted(model.nodes, key=lambda n: (n.tree, n.node)):
        trees.setdefault(node.tree, []).append(node)
    return list(trees.values())


def terms(model: Model) -> list[Column]:
    """The terms whose sum is the log odds: one per weight and one per tree."""
    return [_term(rows) for rows in _trees(model)]


def probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def require_features(table: DataFrame, features: list[str]) -> DataFrame:
    """``table``, failing on a row with a null or NaN feature when it is read."""
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in features])
    message = F.lit(f"a model feature is null or NaN, among: {', '.join(features)}")
    return table.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True))


def _log_odds(model: Model, portion: int) -> Column:
    """The log odds of a model of many terms, by arrays: as one expression its code would be too long to compile."""
    place = {name: i for i, name in enumerate(model.features)}
    each = [
        {n.node: (place.get(n.feature), n.mean, n.deviation, n.threshold, n.below, n.above, n.value) for n in rows}
        for rows in _trees(model)
    ]

    def term(nodes: dict, at: int, x: list) -> np.ndarray | float:
        feature, mean, deviation, threshold, below, above, value = nodes[at]
        if below is not None:
            return np.where(x[feature] <= threshold, term(nodes, below, x), term(nodes, above, x))
        return value if feature is None else value * ((x[feature] - mean) / deviation)

    def log_odds(*columns: pa.Array) -> pa.Array:
        x = [c.to_numpy(zero_copy_only=False) for c in columns]
        total = np.zeros(len(x[0]))
        for at in range(0, len(each), portion):
            some = np.zeros(len(x[0]))
            for nodes in each[at : at + portion]:
                some = some + term(nodes, min(nodes), x)
            total = total + some
        return pa.array(total, pa.float64())

    return F.arrow_udf(log_odds, "double")(*[F.col(c).cast("double") for c in model.features])


def apply_model(model: Model, table: DataFrame, score: str = SCORE, portion: int = 20) -> DataFrame:
    """``table`` with the predicted probability.

    A model of at most ``portion`` terms is one expression; more terms are summed by arrays in the tasks, as many
    at a time.
    """
    each = terms(model)
    total = reduce(add, each) if len(each) <= portion else _log_odds(model, portion)
    out = require_features(table, model.features).withColumn("_log_odds", total)
    return out.select(*[F.col(f"`{c}`") for c in table.columns], probability(F.col("_log_odds")).alias(score))


def as_table(spark: SparkSession, model: Model) -> DataFrame:
    """The model's rows; a few for each tree."""
    rows = [tuple(vars(n).values()) for n in model.nodes]
    return spark.createDataFrame(rows, NODE_SCHEMA)


def write_model(spark: SparkSession, model: Model, path: str) -> None:
    """``<path>/nodes`` and ``<path>/about`` (name and features), both Parquet."""
    as_table(spark, model).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    about = spark.createDataFrame([(model.name, model.features)], "name string, features array<string>")
    about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def read_model(spark: SparkSession, path: str) -> Model:
    about = spark.read.parquet(f"{path}/about").first()
    rows = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes").collect()
    nodes = sorted((Node(**r.asDict()) for r in rows), key=lambda n: (n.tree, n.node))
    return Model(about.name, list(about.features), nodes)


def score_by_join(nodes: DataFrame, table: DataFrame, key: list[str], features: list[str], score: str = SCORE) -> DataFrame:
    """(key, score): probabilities by joining rows with a model's node table, a level of the trees at a time.

    ``key`` must be unique. Nodes are few (some for each tree of a model), so they are broadcast; a row is
    as many short rows as there are trees until their values are summed, next to where they are made.
    """
    values = F.create_map(*[x for c in features for x in (F.lit(c), F.col(c).cast("double"))])
    small = F.broadcast(nodes.select(*[F.col(c).alias(f"n_{c}") for c in nodes.columns]))
    rows = require_features(table, features).select(*key, values.alias("_x"))
    inside = F.col("n_below").isNotNull()
    at = rows.join(small.where("n_node = 0"))
    done = []
    depth = _depth(nodes)
    for level in range(depth + 1):
        x = F.col("_x")[F.col("n_feature")]
        weight = F.when(F.col("n_feature").isNull(), F.lit(1.0)).otherwise((x - F.col("n_mean")) / F.col("n_deviation"))
        done.append(at.where(~inside).select(*key, (F.col("n_value") * weight).alias("_part")))
        if level == depth:
            break
        following = F.when(x <= F.col("n_threshold"), F.col("n_below")).otherwise(F.col("n_above"))
        moved = at.where(inside).select(*key, "_x", F.col("n_tree").alias("_tree"), following.alias("_node"))
        at = moved.join(small, (F.col("_tree") == F.col("n_tree")) & (F.col("_node") == F.col("n_node")))
    parts = reduce(lambda a, b: a.unionByName(b), done)
    return parts.groupBy(*key).agg(probability(F.sum("_part")).alias(score))


def _depth(nodes: DataFrame) -> int:
    """Levels below the roots of the deepest tree; nodes are numbered as in a heap (children 2i+1 and 2i+2)."""
    last = nodes.where("tree > 0").agg(F.max("node")).first()[0] or 0
    return (last + 1).bit_length() - 1
