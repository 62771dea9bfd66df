"""Gradient boosting for a 0/1 outcome by histograms: each level of each tree is one grouped aggregate.

The score starts at the prior log odds. Every round fits a tree to what is left, ``y - p``; all trees are
shrunk by the same rate. A split is the one that parts the means of the two sides most, weighted by their
sizes; a leaf's value is a Newton step, the sum of ``y - p`` over the sum of ``p (1 - p)``. Features are cut at
quantiles, so a feature of few values is cut between any two of them and others at ``bins`` places.

Rows are binned once and written in blocks of bytes, which tasks keep as arrays. What leaves a task in a round is
sums by node, feature and bin, a few thousand numbers whatever the number of rows. A round is ``depth`` short jobs
without a plan to optimise or code to compile; every ``RENEW`` rounds the kept scores are made anew from the
written blocks and the trees so far, so a lost executor's part is made again from the same table.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from riskloom.operators.model_table import Model, Node, require_features
from riskloom.schemas import LABEL
from riskloom.sources.staging import stage

# Functions of this module travel to the executors by value: nothing has to be installed there but numpy and Arrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rounds after which the scores of the rows are made anew.
RENEW = 10
#: Digits of the gain per row to which splits tie; the earlier feature and lower threshold win.
GAIN_DIGITS = 12
#: Rows a task should have at least; fewer rows are read by fewer tasks.
TASK_ROWS = 50_000
#: Tasks whose sums the driver adds up itself; those of more tasks are first added up among tasks.
DIRECT = 64

#: Outcomes, bins (a row of the array for each row of the table) and scores.
Block = tuple[np.ndarray, np.ndarray, np.ndarray]
#: Split nodes of a tree to (feature, last bin below).
Tree = dict[int, tuple[int, int]]


def quantile_edges(rows: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Distinct quantiles of each feature, ascending, without its maximum."""
    places = [i / bins for i in range(1, bins + 1)]
    wanted = [F.percentile_approx(F.col(c).cast("double"), places) for c in features]
    tops = [F.max(F.col(c).cast("double")) for c in features]
    found = rows.agg(*wanted, *tops).first()
    k = len(features)
    return [sorted({x for x in found[i] or [] if x < found[k + i]}) for i in range(k)]


def _packed(rows: DataFrame, edges: list[list[float]]) -> DataFrame:
    """``y, bins``: a batch of rows (outcome, then features) as the bytes of two arrays.

    A value's bin is how many edges lie below it.
    """
    kind = np.uint8 if max(map(len, edges)) < 256 else np.uint16

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, *x = (np.asarray(column, np.float64) for column in batch.columns)
            bins = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x)], axis=1).astype(kind)
            yield pa.RecordBatch.from_pydict({"y": pa.array([y.tobytes()]), "bins": pa.array([bins.tobytes()])})

    return rows.mapInArrow(pack, "y binary, bins binary")


def _blocks(packed: DataFrame, edges: list[list[float]], prior: float) -> RDD:
    width, kind = len(edges), np.uint8 if max(map(len, edges)) < 256 else np.uint16

    def block(row) -> Block:
        y = np.frombuffer(row.y)
        return y, np.frombuffer(row.bins, kind).reshape(-1, width), np.full(len(y), prior)

    return packed.rdd.map(block)


def _nodes_of(bins: np.ndarray, tree: Tree) -> np.ndarray:
    """Number of the node each row is in."""
    at = np.zeros(len(bins), np.int64)
    for node in sorted(tree):  # as in a heap, children come after their parents
        feature, cut = tree[node]
        here = np.flatnonzero(at == node)
        at[here] = np.where(bins[here, feature] <= cut, 2 * node + 1, 2 * node + 2)
    return at


def _advanced(block: Block, trees: list[tuple[Tree, dict[int, float]]]) -> Block:
    """The block with the values of the trees added to its scores, one after the other."""
    y, bins, score = block
    for tree, values in trees:
        value = np.zeros(max(values) + 1)
        value[list(values)] = list(values.values())
        score = score + value[_nodes_of(bins, tree)]
    return y, bins, score


def _histogram(
    blocks: RDD, trees: list, tree: Tree, nodes: list[int], features: int, bins: int
) -> dict[int, dict]:
    """Per node: the sums (rows, gradient, curvature) of every feature and bin, once ``trees`` are added."""
    shape = (3, len(nodes), features, bins)
    place = np.full(2 * max(nodes) + 3, -1)
    place[nodes] = range(len(nodes))

    def sums(part: Iterable[Block]) -> Iterator[np.ndarray]:
        total = np.zeros((3, math.prod(shape[1:])))
        for block in part:
            y, binned, score = _advanced(block, trees)
            at = place[_nodes_of(binned, tree)]
            here = np.flatnonzero(at >= 0)
            p = 1 / (1 + np.exp(-np.clip(score[here], -700, 700)))
            cells = ((at[here, None] * features + np.arange(features)) * bins + binned[here]).ravel()
            for i, weight in enumerate((None, y[here] - p, p * (1 - p))):
                each = None if weight is None else np.repeat(weight, features)
                total[i] += np.bincount(cells, each, total.shape[1])
        yield total

    found = blocks.mapPartitions(sums)
    if blocks.getNumPartitions() > DIRECT:
        total = found.treeReduce(np.add)
    else:
        total = np.sum(found.collect(), axis=0)
    n, g, h = total.reshape(shape)
    out: dict[int, dict] = {node: {} for node in nodes}
    for i, f, b in np.argwhere(n).tolist():
        out[nodes[i]].setdefault(f, {})[b] = (float(n[i, f, b]), float(g[i, f, b]), float(h[i, f, b]))
    return out


def _best_split(features: dict[int, dict]) -> tuple | None:
    """(gain, feature, last bin below, sums below, sums above) of the widest split; None if no split parts the means."""
    best = None
    for feature in sorted(features):
        cells = features[feature]
        total = [math.fsum(c[i] for c in cells.values()) for i in range(3)]
        below = [0.0, 0.0, 0.0]
        for cut in sorted(cells)[:-1]:
            below = [a + b for a, b in zip(below, cells[cut])]
            above = [t - b for t, b in zip(total, below)]
            apart = below[1] / below[0] - above[1] / above[0]
            gain = round(below[0] * above[0] / total[0] ** 2 * apart**2, GAIN_DIGITS)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, feature, cut, below, above)
    return best


def _leaf(sums: Sequence[float], rate: float) -> float:
    return rate * sums[1] / sums[2] if sums[2] > 1e-150 else 0.0


def fit_boosting(
    rows: DataFrame,
    features: list[str],
    name: str,
    label: str = LABEL,
    rounds: int = 200,
    depth: int = 3,
    rate: float = 0.05,
    bins: int = 32,
) -> Model:
    """A model of ``rounds`` trees of ``depth`` levels; with outcomes of one kind only, the prior alone."""
    rows = require_features(rows.select(label, *features), features)
    edges = quantile_edges(rows, features, bins)
    y = F.col(label).cast("double")
    n, bads = rows.agg(F.count(y), F.sum(y)).first()
    n, bads = n or 0, bads or 0.0
    if not 0 < bads < n:
        return Model(name, list(features), [Node(0, 0, value=math.log((bads + 0.5) / (n - bads + 0.5)))])
    prior = math.log(bads / (n - bads))
    columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    few = rows.select(y.alias("y"), *columns).where("y IS NOT NULL").coalesce(math.ceil(n / TASK_ROWS))
    written = _blocks(stage(_packed(few, edges), "binned"), edges, prior)
    width = max(map(len, edges)) + 1
    current = written.persist(StorageLevel.MEMORY_AND_DISK)
    nodes = [Node(0, 0, value=prior)]
    done: list[tuple[Tree, dict[int, float]]] = []
    renewed = 0  # trees whose values the kept scores hold
    for number in range(1, rounds + 1):
        tree: Tree = {}
        open_nodes, sums = [0], {}
        for _ in range(depth):
            found = _histogram(current, done[renewed:], tree, open_nodes, len(features), width) if open_nodes else {}
            following = []
            for node in open_nodes:
                split = _best_split(found[node])
                if split is None:
                    continue
                tree[node] = split[1:3]
                for child, side in ((2 * node + 1, split[3]), (2 * node + 2, split[4])):
                    sums[child] = side
                    following.append(child)
            open_nodes = following
        if not tree:  # nothing left to part: the rounds that follow would be empty too
            break
        values = {leaf: _leaf(sums[leaf], rate) for leaf in sums if leaf not in tree}
        for node in sorted([*tree, *values]):
            if node in tree:
                feature, cut = tree[node]
                nodes.append(Node(number, node, features[feature], threshold=edges[feature][cut], below=2 * node + 1, above=2 * node + 2))
            else:
                nodes.append(Node(number, node, value=values[node]))
        done.append((tree, values))
        if number % RENEW == 0 and number < rounds:
            current.unpersist()
            renewed, so_far = number, list(done)
            current = written.map(lambda block, trees=so_far: _advanced(block, trees)).persist(StorageLevel.MEMORY_AND_DISK)
    current.unpersist()
    return Model(name, list(features), nodes)
