"""A manifest of a dataset as a tree of hashes, one subtree for each source, and proofs for its rows (operator 13).

*Tree.* A row's leaf is the SHA-256 of its fields. The leaves of a source ascend by id; ``ARITY``
consecutive nodes become the hash of their digests (as hex text), level by level, until one is left. These
subroots, in the order of their sources, become the root likewise.

*Tiles.* ``LEVELS`` levels are folded in one task: a tile of a source holds at most ``ARITY ** LEVELS``
consecutive nodes, however large the source is. Tiles' digests are the nodes of the next round, a few thousand times
fewer. Going down again, each tile is told what lies beside the way from it to the root.

*Midstates.* A parent keeps a copy of its running hash before each child. To fold a replaced digest it
resumes the copy before that child with the replacement and the digests to the right only; what lies to
the left is never hashed again. For the way above a tile, the state behind the digests to the left is made once per tile.

*Places.* Rows are range-partitioned by (source, id, leaf), sorted and written; one row per written partition and
source then gives each row its place within its source. A hot source spans many partitions.

Sources are ordered by their UTF-8 bytes, a null source first; a null and an empty source are two trees. In
a source, null ids come first, and rows of one id go by their leaves; equal rows are leaves of their own
with equal digests. Null fields, null and empty texts are hashed apart. An empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.sources.staging import stage

#: Children of a node.
ARITY = 16
#: Levels that one task folds.
LEVELS = 3
#: Fields that a leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows that a task hands on at a time.
BATCH = 4096

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of fields, each as ``-`` or its length in bytes, a colon and its value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def lower_cased(text: Column) -> Column:
    """``text`` with its A-Z lower-cased."""
    return F.translate(text, _UPPER, _UPPER.lower())


def leaves(
    df: DataFrame, altered: dict[str, Column], where: Column, fields: tuple = FIELDS, id_col: str = "doc_id", group_col: str = "source"
) -> DataFrame:
    """(id, tree, leaf, put) of every row; ``put`` is the leaf of the altered row where ``where`` holds, else null."""
    plain = [F.col(c) for c in fields]
    other = [altered.get(c, F.col(c)) for c in fields]
    return df.select(
        F.col(id_col).alias("id"),
        # A name that sorts as the source does, null first.
        F.coalesce(F.concat(F.lit("+"), F.col(group_col).cast("string")), F.lit("")).alias("tree"),
        F.unhex(leaf_digest(plain)).alias("leaf"),
        F.when(where, F.unhex(leaf_digest(other))).alias("put"),
    )


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order``) within their ``tree``, and the tree's ``total``."""
    bounds = [F.asc("tree"), *[F.asc_nulls_first(c) for c in order]]
    sorted_rows = rows.repartitionByRange(*bounds).sortWithinPartitions(*bounds)
    # Partition above, row below: once written, a place is final, whatever is retried.
    written = stage(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "placed")
    written = written.withColumn("_bin", F.shiftright("_at", 33))
    pieces = written.groupBy("tree", "_bin").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")  # a row for each partition the tree lies in
    before = tree.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "tree",
        "_bin",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(tree).alias("total"),
    )
    joined = written.join(pieces, ["tree", "_bin"])
    return joined.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "total")


def height(nodes: int) -> int:
    """Levels above so many nodes."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // ARITY), levels + 1
    return levels


class Parent:
    """A node over up to ``ARITY`` digests, with its running hash before each and what follows each."""

    def __init__(self, children: list[bytes]) -> None:
        self.children = children
        self.states, state = [], hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()
        self.rights = [b""] * len(children)
        for i in range(len(children) - 1, 0, -1):
            self.rights[i - 1] = children[i] + self.rights[i]

    def left(self, slot: int) -> bytes:
        return b"".join(self.children[:slot])

    def fold(self, slot: int, digest: bytes) -> bytes:
        """The node's digest if the child in ``slot`` had another one."""
        state = self.states[slot].copy()
        state.update(digest + self.rights[slot])
        return state.hexdigest().encode()


class Tile:
    """Consecutive nodes of a tree, as many levels above them as the tile folds, and the way on to the root."""

    def __init__(self, digests: list[bytes], total: int, way: Iterable[tuple[bytes, bytes]] = ()) -> None:
        self.parents: list[list[Parent]] = []
        for _ in range(min(LEVELS, height(total))):
            row = [Parent(digests[i : i + ARITY]) for i in range(0, len(digests), ARITY)]
            self.parents.append(row)
            digests = [p.digest for p in row]
        self.top = digests[0]
        self.way = list(way)
        self.above = b"".join(left + right for left, right in self.way)
        self.resumed = [(hashlib.sha256(left), right) for left, right in self.way]
        self.beside: dict[tuple[int, int], bytes] = {}

    def steps(self, place: int) -> Iterator[tuple[Parent, int]]:
        for row in self.parents:
            yield row[place // ARITY], place % ARITY
            place //= ARITY

    def way_of(self, place: int) -> list[tuple[bytes, bytes]]:
        """What lies beside the way from a node to the root: (left, right) of each level."""
        return [(p.left(slot), p.rights[slot]) for p, slot in self.steps(place)] + self.way

    def siblings(self, place: int, level: int = 0) -> bytes:
        """All siblings of a node of the tile, level by level up to the root."""
        if level == len(self.parents):
            return self.above
        parent, slot = self.parents[level][place // ARITY], place % ARITY
        key = (level + 1, place // ARITY)
        if key not in self.beside:
            self.beside[key] = self.siblings(place // ARITY, level + 1)
        return parent.left(slot) + parent.rights[slot] + self.beside[key]

    def fold(self, place: int, digest: bytes) -> bytes:
        """The root if a node had another digest."""
        for parent, slot in self.steps(place):
            digest = parent.fold(slot, digest)
        for state, right in self.resumed:
            state = state.copy()
            state.update(digest + right)
            digest = state.hexdigest().encode()
        return digest


def _tiles(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """``nodes`` dealt by tile and sorted; ``tile`` is a number within the tree."""
    tiled = nodes.withColumn("tile", F.floor(F.col("pos") / ARITY**LEVELS).cast("long"))
    return tiled.select("tree", "tile", *columns).repartition("tree", "tile").sortWithinPartitions("tree", "tile", "pos")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each (tree, tile) in turn; a tile's rows are few."""
    key, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row[2:])
    if held:
        yield key, held


def _batched(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    for row in rows:
        held.append(row)
        if len(held) >= BATCH:
            yield out()
            held = []
    if held:
        yield out()


def tile_tops(nodes: DataFrame) -> DataFrame:
    """(tree, pos, total, leaf): the top of each tile of ``nodes`` (tree, pos, total, leaf), as a node of the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops() -> Iterator[tuple]:
            for (tree, tile), rows in _grouped(batches):
                total = rows[0][1]
                top = Tile([r[2].hex().encode() for r in rows], total).top
                yield tree, tile, -(-total // ARITY**LEVELS), bytes.fromhex(top.decode())

        yield from _batched(tops(), ["tree", "pos", "total", "leaf"], [pa.string(), pa.int64(), pa.int64(), pa.binary()])

    schema = "tree string, pos long, total long, leaf binary"
    return _tiles(nodes, ["pos", "total", "leaf"]).mapInArrow(run, schema)


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of each round, ``nodes`` first; in the last one every tree has a single node."""
    out = [nodes]
    while (out[-1].agg(F.max("total")).first()[0] or 0) > 1:
        out.append(stage(tile_tops(out[-1]), "tops"))
    return out


_WAY = "array<struct<l: binary, r: binary>>"
_WAY_ARROW = pa.list_(pa.struct([("l", pa.binary()), ("r", pa.binary())]))


def _with_heads(nodes: DataFrame, heads: DataFrame, extra: list[str]) -> DataFrame:
    """Nodes dealt by tile, each tile led by its row of ``heads`` (tree, pos, way, subroot, root), pos being the tile."""
    long = F.lit(None).cast("long")
    lead = heads.select(
        "tree", F.col("pos").alias("tile"), F.lit(-1).cast("long").alias("pos"), long.alias("total"), F.lit(None).cast("binary").alias("leaf"),
        *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in extra], "way", "subroot", "root",
    )
    rows = nodes.select(
        "tree", F.floor(F.col("pos") / ARITY**LEVELS).cast("long").alias("tile"), "pos", "total", "leaf", *extra,
        F.lit(None).cast(_WAY).alias("way"), F.lit(None).cast("binary").alias("subroot"), F.lit(None).cast("binary").alias("root"),
    )
    both = lead.unionByName(rows).repartition("tree", "tile")
    return both.sortWithinPartitions("tree", "tile", "pos")


def _tile_of(rows: list[tuple]) -> tuple[Tile, bytes, bytes]:
    """The tile of a head and its nodes, with the subroot and root."""
    way, subroot, root = rows[0][-3:]
    digests = [r[2].hex().encode() for r in rows[1:]]
    return Tile(digests, rows[1][1], [(s["l"], s["r"]) for s in way]), subroot, root


def _down(nodes: DataFrame, heads: DataFrame) -> DataFrame:
    """Heads of the tiles below: (tree, pos, way, subroot, root) of every node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ways() -> Iterator[tuple]:
            for (tree, _), rows in _grouped(batches):
                tile, subroot, root = _tile_of(rows)
                for i, row in enumerate(rows[1:]):
                    yield tree, row[0], [{"l": a, "r": b} for a, b in tile.way_of(i)], subroot, root

        types = [pa.string(), pa.int64(), _WAY_ARROW, pa.binary(), pa.binary()]
        yield from _batched(ways(), ["tree", "pos", "way", "subroot", "root"], types)

    schema = f"tree string, pos long, way {_WAY}, subroot binary, root binary"
    return _with_heads(nodes, heads, []).mapInArrow(run, schema)


def _proofs(nodes: DataFrame, heads: DataFrame) -> DataFrame:
    """(id, tree, leaf, subroot, root, proof_sha256, folded_root) of every leaf."""
    kind = nodes.schema["id"].dataType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (tree, _), rows in _grouped(batches):
                tile, subroot, root = _tile_of(rows)
                names = subroot.hex(), root.hex()
                for i, row in enumerate(rows[1:]):
                    leaf, doc, put = row[2], row[3], row[4]
                    folded = tile.fold(i, (leaf if put is None else put).hex().encode())
                    proof = hashlib.sha256(tile.siblings(i)).hexdigest()
                    yield doc, tree, leaf.hex(), *names, proof, folded.decode()

        names = ["id", "tree", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
        yield from _batched(found(), names, [id_type, *[pa.string()] * 6])

    schema = f"id {kind.simpleString()}, tree string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return _with_heads(nodes, heads, ["id", "put"]).mapInArrow(run, schema)


def manifest(rows: DataFrame) -> DataFrame:
    """(id, tree, leaf, subroot, root, proof_sha256, folded_root) of every row of ``leaves``.

    ``proof_sha256`` is the hash of all siblings up to the root, ``folded_root`` the root that the altered
    leaf (where there is one) leads to.
    """
    nodes = stage(placed(rows, ["id", "leaf", "put"]), "leaves")
    by_source = rounds(nodes)
    subroots = by_source[-1].select(F.col("tree").alias("name"), "leaf")
    ranked = placed(subroots.withColumn("tree", F.lit("")), ["name"])
    by_root = rounds(stage(ranked, "subroots"))
    root = by_root[-1].select(
        "tree", "pos", F.array().cast(_WAY).alias("way"), F.lit(b"").alias("subroot"), F.col("leaf").alias("root")
    )
    for below in reversed(by_root[:-1]):
        root = stage(_down(below, root), "ways")
    # A head of each source's topmost tile: the way of its subroot.
    heads = root.join(by_root[0].select("pos", "name", "leaf"), "pos").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "way", F.col("leaf").alias("subroot"), "root"
    )
    for below in reversed(by_source[1:-1]):
        heads = stage(_down(below, heads), "ways")
    return _proofs(nodes, heads)
