"""Approximate nearest neighbours by one navigable small-world graph per shard (operator 1).

Vectors are dealt to shards of bounded size, by the power of two of their length and within it by a hash.
Each shard gets a hierarchical graph of its own: levels are drawn per vector, neighbours are kept in flat
arrays of fixed width, and links are chosen so that they point into different directions. Each shard
measures how broad a search must be, on points of its own against brute force. The index is a table with
one row per shard. Queries come in blocks of bounded size; each block meets each shard once, and the
nearest of all shards are merged, ties to the smaller id.

Nearness is the inner product. For that, vectors get one more component that makes all of a shard equally
long; the nearest by angle then are those of largest product. As a shard's vectors differ in length by
less than a factor of 2, a few very long vectors elsewhere do no harm. Scores are computed on the vectors
as given, in double precision; a product beyond its range is infinite.

Equal vectors are one point of the graph. As many of their ids are kept as a query may return, the
smallest first, so a vector that a third of all rows share costs no more than any other. Vectors that are
null, zero, or hold null or non-finite components take no part; vectors only meet those of their length.
A null id takes no part. Repeated rows count once. Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import broadcast_if_small
from riskloom.sources.staging import stage

#: Points per shard, links per point (twice that on the ground), and least breadth of building and searching.
SHARD, LINKS, BUILD, SEARCH = 4096, 12, 48, 96
#: Points of a shard its breadth is measured on, and the share of their nearest that must be found.
PROBES, RECALL = 48, 0.97
#: Numbers in a block of queries (32 MB).
BLOCK = 1 << 22


class Graph:
    """A hierarchical graph over the rows of ``points``, in flat arrays.

    ``links[level]`` is (points, width), filled from the left and padded with -1.
    """

    def __init__(self, points: np.ndarray, links: list[np.ndarray], entry: int) -> None:
        self.points = points
        self.links = links
        self.entry = entry

    @classmethod
    def build(cls, points: np.ndarray, width: int = LINKS, breadth: int = BUILD, seed: int = 3) -> Graph:
        n = len(points)
        rng = np.random.default_rng(seed)
        drawn = np.minimum((-np.log(1 - rng.random(n)) / np.log(width)).astype(np.int64), 8)
        links = [np.full((n, 2 * width if level == 0 else width), -1, np.int32) for level in range(drawn.max(initial=0) + 1)]
        graph, top = cls(points, links, 0), int(drawn[0]) if n else 0
        for new in range(1, n):
            at, query = graph.entry, points[new]
            for level in range(top, drawn[new], -1):
                at = graph._greedy(query, at, level)
            starts = [at]
            for level in range(min(top, drawn[new]), -1, -1):
                near, ids = graph._search(query, starts, breadth, level)
                chosen = graph._diverse(ids, near, width)
                links[level][new, : len(chosen)] = chosen
                for other in chosen:
                    graph._link(int(other), new, level)
                starts = ids[:8].tolist()
            if drawn[new] > top:
                graph.entry, top = new, int(drawn[new])
        return graph

    def _greedy(self, query: np.ndarray, at: int, level: int) -> int:
        best = float(self.points[at] @ query)
        while True:
            near = self.links[level][at]
            near = near[near >= 0]
            if not len(near):
                return at
            scores = self.points[near] @ query
            k = int(scores.argmax())
            if not scores[k] > best:
                return at
            best, at = float(scores[k]), int(near[k])

    def _search(self, query: np.ndarray, starts: list[int], breadth: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the best ``breadth`` points found from ``starts``, best first.

        All unexpanded points among the best few are expanded in one step, so a step is one product.
        """
        links, points = self.links[level], self.points
        seen = np.zeros(len(points), bool)
        ids = np.unique(np.array(starts, np.int64))
        seen[ids] = True
        scores = points[ids] @ query
        fresh = np.ones(len(ids), bool)
        while True:
            order = np.argsort(-scores, kind="stable")[:breadth]
            ids, scores, fresh = ids[order], scores[order], fresh[order]
            open_ = np.flatnonzero(fresh)[:6]
            if not len(open_):
                return scores, ids
            fresh[open_] = False
            near = links[ids[open_]].ravel()
            near = np.unique(near[near >= 0])
            near = near[~seen[near]]
            if len(near):
                seen[near] = True
                ids = np.concatenate([ids, near])
                scores = np.concatenate([scores, points[near] @ query])
                fresh = np.concatenate([fresh, np.ones(len(near), bool)])

    def _diverse(self, ids: np.ndarray, scores: np.ndarray, width: int) -> np.ndarray:
        """Up to ``width`` candidates, best first, none nearer to a chosen one than to the point itself."""
        ids, scores = ids[: 3 * width], scores[: 3 * width]
        among = self.points[ids] @ self.points[ids].T
        chosen: list[int] = []
        for k in range(len(ids)):
            if len(chosen) == width:
                break
            if not chosen or among[k, chosen].max() < scores[k]:
                chosen.append(k)
        for k in range(len(ids)):  # fill up with the nearest of the others
            if len(chosen) == width:
                break
            if k not in chosen:
                chosen.append(k)
        return ids[chosen]

    def _link(self, point: int, new: int, level: int) -> None:
        row = self.links[level][point]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = new
            return
        ids = np.append(row, new).astype(np.int64)
        scores = self.points[ids] @ self.points[point]
        order = np.argsort(-scores, kind="stable")
        chosen = self._diverse(ids[order], scores[order], len(row))
        row[:] = -1
        row[: len(chosen)] = chosen

    def nearest(self, query: np.ndarray, k: int, breadth: int = SEARCH) -> np.ndarray:
        at = self.entry
        for level in range(len(self.links) - 1, 0, -1):
            at = self._greedy(query, at, level)
        return self._search(query, [at], max(breadth, k), 0)[1][:k]

    def breadth(self, queries: np.ndarray, k: int, least: int = SEARCH) -> int:
        """The breadth, doubled from the least one, that finds ``RECALL`` of the queries' ``k`` nearest."""
        k = min(k, len(self.points))
        exact = [np.argpartition(-(self.points @ q), k - 1)[:k] for q in queries]
        while least < len(self.points):
            found = sum(len(np.intersect1d(e, self.nearest(q, k, least))) for e, q in zip(exact, queries, strict=True))
            if found >= RECALL * k * len(queries):
                break
            least *= 2
        return least


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector, dim, power) of rows that take part; the power of two below the vector's length."""
    v = F.col(vector_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vector = F.transform(v, lambda x: x.cast("double"))
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(good)
    rows = rows.select(F.col(id_col).alias("id"), vector.alias("vector"), F.size(v).alias("dim"))
    # Squares of very long or short vectors leave the range of doubles, so the largest component is taken out.
    rows = rows.withColumn("_most", F.array_max(F.transform("vector", F.abs))).where("_most > 0")
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("_most")) * (x / F.col("_most")))
    power = F.floor(F.log2("_most") + F.log2(squares) / 2).cast("int")
    return rows.select("id", "vector", "dim", power.alias("power"))


def build_index(rows: DataFrame, keep: int) -> DataFrame:
    """The index of usable rows: (dim, power, shard, points, graph in bytes, breadth, ids of each point).

    ``keep`` ids of each distinct vector are stored.
    """
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    first = rows.select("id", "vector", "dim", "power").distinct().withColumn("_at", place).where(F.col("_at") <= keep)
    points = first.groupBy("vector", "dim", "power").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    points = stage(points, "points")
    sizes = points.groupBy("dim", "power").agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("long").alias("shards"))
    dealt = points.join(broadcast_if_small(sizes), ["dim", "power"])
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vector", key=lambda c: c.map(lambda v: tuple(v)))
        plain = np.stack(part["vector"].to_numpy()).astype(np.float64)
        unit = plain / np.abs(plain).max()
        square = (unit**2).sum(axis=1)
        rest = np.sqrt(np.maximum(square.max() - square, 0))
        lifted = (np.column_stack([unit, rest]) / np.sqrt(square.max())).astype(np.float32)
        graph = Graph.build(lifted)
        some = np.random.default_rng(7).permutation(len(unit))[:PROBES]
        asked = np.column_stack([unit[some] / np.sqrt(square[some])[:, None], np.zeros(len(some))])
        return pd.DataFrame(
            {
                "dim": [int(part["dim"].iloc[0])],
                "shard": [int(part["shard"].iloc[0])],
                "power": [int(part["power"].iloc[0])],
                "breadth": [graph.breadth(asked.astype(np.float32), keep)],
                "points": [plain.tobytes()],
                "lifted": [lifted.tobytes()],
                "links": [[level.tobytes() for level in graph.links]],
                "entry": [graph.entry],
                "ids": [np.concatenate([np.asarray(i, np.int64) for i in part["ids"]]).tobytes()],
                "n_ids": [part["ids"].map(len).to_numpy(np.int64).tobytes()],
            }
        )

    schema = (
        "dim int, power int, shard long, breadth int, points binary, lifted binary,"
        " links array<binary>, entry int, ids binary, n_ids binary"
    )
    chosen = dealt.select("dim", "power", "shard", "vector", "ids")
    return chosen.groupBy("dim", "power", "shard").applyInPandas(build, schema)


def search(index: DataFrame, queries: DataFrame, k: int, breadth: int = SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each usable query, itself left out.

    A shard is searched with its own breadth, or ``breadth`` if that is more.
    """
    places = index.select(*[F.col(c).alias(c) for c in ("dim", "power", "shard")]).distinct()
    blocks = queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) * F.col("dim") / BLOCK).cast("long").alias("blocks"))
    blocks = broadcast_if_small(stage(blocks, "blocks"))
    asked = queries.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    asked = asked.select("id", "vector", "dim", "block").join(broadcast_if_small(places), "dim")
    met = index.join(blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))

    def run(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(shard) and len(block):
            one = shard.iloc[0]
            dim = int(one["dim"])
            points = np.frombuffer(one["points"], np.float64).reshape(-1, dim)
            lifted = np.frombuffer(one["lifted"], np.float32).reshape(-1, dim + 1)
            links = [np.frombuffer(level, np.int32).reshape(len(points), -1) for level in one["links"]]
            graph = Graph(lifted, links, int(one["entry"]))
            ids, counts = np.frombuffer(one["ids"], np.int64), np.frombuffer(one["n_ids"], np.int64)
            begin = np.cumsum(counts) - counts
            for query_id, vector in zip(block["id"], block["vector"], strict=True):
                exact = np.asarray(vector, np.float64)
                unit = exact / np.abs(exact).max()
                lifted_query = np.append(unit / np.sqrt(unit @ unit), 0).astype(np.float32)
                near = graph.nearest(lifted_query, k + 1, max(breadth, int(one["breadth"])))
                with np.errstate(over="ignore"):
                    scores = (points[near] * exact).sum(axis=1)
                for point, score in zip(near, scores, strict=True):
                    own = ids[begin[point] : begin[point] + counts[point]]
                    own = own[own != query_id][:k]
                    found["query_id"] += [query_id] * len(own)
                    found["vec_id"] += own.tolist()
                    found["score"] += [float(score)] * len(own)
        return pd.DataFrame(found)

    keys = ["dim", "power", "shard", "block"]
    pairs = met.groupBy(*keys).cogroup(asked.groupBy(*keys))
    candidates = pairs.applyInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int, breadth: int = SEARCH) -> DataFrame:
    """Index ``df`` and search it for ``queries`` (both with the id and vector columns)."""
    index = stage(build_index(usable(df, id_col, vector_col), k + 1), "index")
    return search(index, usable(queries, id_col, vector_col).dropDuplicates(["id"]), k, breadth)
