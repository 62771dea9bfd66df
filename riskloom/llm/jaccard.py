"""All pairs of texts whose word n-grams overlap enough, by PartEnum signatures (operator 8).

*Signatures.* Small sets are put into size bands that grow by a factor of 4; a set near the upper edge of its
band also takes part in the next one, so that sets similar enough always meet in the larger one's
band. In a band the domain of shingle hashes is cut into parts. Similar sets of sizes r and s differ in
at most ``d = (r + s)(1 - t)/(1 + t)`` shingles, so they differ in at most d parts. There are d + 2 parts,
and the subsets of two of them are enumerated: one subset agrees. Empty parts say nothing; a set with too few
others also signs each of its shingles. Larger sets are all in one band. Its parts are as fine as the domain,
each a single shingle, and so is each subset: at most r(1 - t) of the full parts of a set are empty in a
similar one, so of its full parts it signs only that many and one more, the first in the order of parts.

*Candidates.* In each group under one signature, a set is first paired only with the one closest to it;
that connects groups of copies. Any fixed order of parts will do for "first", so where a passage of many
texts fills large groups that aren't connected, its signatures are moved to the end of the order and the
texts concerned sign again. In the groups that are left, sets of different components that had any
partner there meet by sizes and sketches alone. What these can't rule out becomes a pair and is verified on whole sets. A large group is cut
into blocks, and a task that would make more than a few pairs for each of its members returns the members
instead: they get their whole sets and meet there once more, where pairs are verified at once and at most one
link per member is kept. So no link between different components is lost, none is wrong, and no step writes
more than a few rows per member.

Equal sets are one node from the start, so copies cost nothing beyond their own rows. Null and empty
texts have empty sets, are linked with nothing and are their own component. Rows with a null id have a
component like others; its number is null if all its ids are. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import (
    BROADCAST_ROWS,
    Words,
    broadcast_if_small,
    bytes_of,
    lists,
    mixed,
    small_batches,
    text_key,
    trim_memory,
)
from riskloom.llm.graph import components
from riskloom.sources.staging import stage

#: Members of a group in a block, and shingles of all of them (8 MB); a task compares two blocks at a time.
BLOCK, SHINGLES = 4096, 1 << 20
#: Pairs a task may make for each member it holds of a large group, before it returns the members.
DENSE = 4
#: Parities for a shingle in the wide sketches that candidates are tested with once more.
WIDE = 8
#: Members of a group that is large. Large groups with up to ``MIDDLE`` are compared many at a time.
LARGE, MIDDLE = 16, 256
#: Groups of more members than this, if still not connected after the first pass, have their
#: signatures moved to the end of the order of parts; at most so many of them.
RESIGN, FREQUENT = 256, 200_000
#: Bits of a signature. Different ones that look the same cost a comparison more, never a link.
BITS = 48

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_PAIRED_BELOW = 16  # bands that end here enumerate pairs of parts


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles; a shorter text is one shingle as a whole."""
    words = Words([t.lower() for t in texts])  # bytes: only A-Z are lower-cased
    starts = words.starts(size)
    shingles = words.rolling[0].spans(starts, starts + size)
    cut = np.searchsorted(words.row[starts], np.arange(1, len(texts))) if len(starts) else np.zeros(
        max(len(texts) - 1, 0), np.int64
    )
    sets = [np.unique(s) for s in np.split(shingles, cut)]
    for i in np.flatnonzero((words.counts > 0) & (words.counts < size)):
        first = words.first[i : i + 1]
        sets[i] = words.rolling[0].spans(first, first + words.counts[i])
    return sets


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed number."""
    total = np.array([len(shingles)], np.uint64) * _GOLD + mixed(shingles + _GOLD).sum(dtype=np.uint64)
    return int(mixed(total).view(np.int64)[0])


def signatures(shingles: np.ndarray, percent: int) -> tuple[int, list[np.ndarray], np.ndarray]:
    """How many parts a set signs in the band of large sets, its parts there in order, and what it signs besides."""
    n, nothing = len(shingles), np.empty(0, np.uint64)
    most = n * 100 // percent  # the largest set it can be similar to
    apart = (n + most) * (100 - percent) // (100 + percent)
    if apart == 0:  # similar means equal
        return 0, [nothing], nothing
    top = 4
    while top <= n:
        top *= 4
    ordered, besides = nothing, [nothing]
    for band in (top, 4 * top) if most >= top else (top,):
        if band > _PAIRED_BELOW:
            ordered = mixed(mixed(shingles ^ _GOLD) + np.uint64(_PAIRED_BELOW))
            continue
        largest = band - 1
        parts = (largest + largest * 100 // percent) * (100 - percent) // (100 + percent) + 2
        part = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        begin = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])
        whole = np.zeros(parts, np.uint64)
        whole[part[begin].astype(np.int64)] = np.add.reduceat(mixed(shingles ^ _GOLD), begin)
        i, j = np.triu_indices(parts, 1)
        full = (whole[i] != 0) | (whole[j] != 0)
        i, j = i[full], j[full]
        name = np.uint64(band) * np.uint64(1 << 32) + (i * parts + j).astype(np.uint64)
        besides.append(mixed(mixed(whole[i] + _GOLD) + mixed(whole[j] - _GOLD) * np.uint64(3) + mixed(name)))
        if len(begin) <= apart:  # too few parts to be sure that one agrees
            besides.append(mixed(shingles + mixed(np.array([band], np.uint64) + _GOLD)))
    return n * (100 - percent) // 100 + 1, [ordered], np.concatenate(besides)


def _shortened(signed: np.ndarray) -> np.ndarray:
    """Signatures of ``BITS`` bits, as signed numbers; there are so many that their bytes are most of what is shuffled."""
    return (signed >> np.uint64(64 - BITS)).view(np.int64)


def sketch(shingles: np.ndarray, factor: int = 1) -> np.ndarray:
    """Parities of hashes; where those of two sets differ, so do the sets, at least as often.

    There are about ``factor`` parities for a shingle. Half as many are found by folding.
    """
    bits = 1 << min(max(factor * len(shingles) - 1, 255).bit_length(), 16 if factor == 1 else 20)
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


class Sketches:
    """The sketches of a block of sets; sets that may be similar have equal ones or one twice as long."""

    def __init__(self, column: pa.ListArray) -> None:
        offsets = column.offsets.to_numpy()
        self.values = column.values.to_numpy().view(np.uint64)
        self.begin, self.width = offsets[:-1], np.diff(offsets)
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _at(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Row of each set in the matrix of this width, and the matrix."""
        if width not in self.folded:
            row = np.full(len(self.width), -1)
            parts, done = [], 0
            for own in (width, 2 * width):
                members = np.flatnonzero(self.width == own)
                row[members] = done + np.arange(len(members))
                done += len(members)
                some = self.values[self.begin[members][:, None] + np.arange(own)]
                parts.append(some if own == width else some[:, :width] ^ some[:, width:])
            self.folded[width] = row, np.concatenate(parts)
        return self.folded[width]

    def differ(self, one: int, others: np.ndarray) -> np.ndarray:
        """The least number of shingles by which one set and each of the others differ."""
        out = np.zeros(len(others), np.int64)
        common = np.minimum(self.width[others], self.width[one])
        for width in np.unique(common):
            some = np.flatnonzero((common == width) & (np.maximum(self.width[others], self.width[one]) <= 2 * width))
            row, matrix = self._at(int(width))
            out[some] = np.bitwise_count(matrix[row[others[some]]] ^ matrix[row[one]]).sum(axis=1, dtype=np.int64)
        return out

    def between(self, ones: np.ndarray, others: np.ndarray) -> np.ndarray:
        """The same for pairs; 0 where one sketch is more than twice as long as the other."""
        out = np.zeros(len(ones), np.int64)
        width = np.minimum(self.width[ones], self.width[others])
        twice = np.maximum(self.width[ones], self.width[others]) // np.maximum(width, 1)
        for own in np.unique(width):
            for fold in (1, 2):
                pairs = np.flatnonzero((width == own) & (twice == fold))
                for at in range(0, len(pairs), max(1, (1 << 19) // own)):  # 4 MB a side
                    some = pairs[at : at + max(1, (1 << 19) // own)]
                    sides = [self._folded(x[some], own) for x in (ones, others)]
                    out[some] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1, dtype=np.int64)
        return out

    def _folded(self, sets: np.ndarray, width: int) -> np.ndarray:
        """The sketches of some sets at ``width``, which is theirs or half of it."""
        out = self.values[self.begin[sets][:, None] + np.arange(width)]
        longer = np.flatnonzero(self.width[sets] > width)
        if len(longer):
            out[longer] ^= self.values[self.begin[sets[longer]][:, None] + width + np.arange(width)]
        return out


def _over(df: DataFrame, text: str, size: int, make, schema: str) -> DataFrame:
    """``make(batch, sets)`` over small batches; the text is the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1 << 20):  # a byte becomes some 40 in the arrays of hashes
            yield make(batch, shingle_sets(bytes_of(batch.column(batch.num_columns - 1)), size))

    return df.mapInArrow(run, schema)


def _nodes(df: DataFrame, size: int, percent: int) -> DataFrame:
    """Of every row of (id, text): its node, the size and sketch of its set, and what it may sign."""

    def make(batch: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        nodes = pa.array([set_id(s) for s in sets], pa.int64())
        sizes = pa.array([len(s) for s in sets], pa.int64())
        signed = [signatures(s, percent) for s in sets]
        columns = [
            lists([_shortened(np.concatenate([*(parts[: x[0]] for parts in x[1]), x[2]])) for x in signed]),
            lists([sketch(s) for s in sets]),
        ]
        names = ["id", "k1", "k2", "node", "n_shingles", "signatures", "sketch"]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], nodes, sizes, *columns], names)

    kind = df.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, k1 long, k2 long, node long, n_shingles long,"
        " signatures array<long>, sketch array<long>"
    )
    return _over(df.select("id", *text_key("text"), "text"), "text", size, make, schema)


def _again(df: DataFrame, frequent: DataFrame, size: int, percent: int) -> DataFrame:
    """What texts sign if the ``frequent`` signatures come last in the order of parts."""
    late = np.sort(np.array([r[0] for r in frequent.collect()], np.int64))  # at most FREQUENT
    shared = df.sparkSession.sparkContext.broadcast(late)

    def sign(shingles: np.ndarray) -> np.ndarray:
        signs, ordered, besides = signatures(shingles, percent)
        out = [besides]
        for parts in ordered:
            known, signed = shared.value, _shortened(parts)
            place = np.minimum(np.searchsorted(known, signed), max(len(known) - 1, 0))
            is_late = known[place] == signed if len(known) else np.zeros(len(parts), bool)
            out.append(np.concatenate([parts[~is_late], parts[is_late]])[:signs])
        return _shortened(np.concatenate(out))

    def make(batch: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        nodes = pa.array([set_id(s) for s in sets], pa.int64())
        return pa.RecordBatch.from_arrays([nodes, lists([sign(s) for s in sets])], ["node", "signatures"])

    return _over(df.select("text"), "text", size, make, "node long, signatures array<long>")


def _sets(df: DataFrame, size: int) -> DataFrame:
    """(node, shingles, sketch) of every row of (text); the sketch is a wide one."""

    def make(batch: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        nodes = pa.array([set_id(s) for s in sets], pa.int64())
        columns = [nodes, lists([s.view(np.int64) for s in sets]), lists([sketch(s, WIDE) for s in sets])]
        return pa.RecordBatch.from_arrays(columns, ["node", "shingles", "sketch"])

    return _over(df.select("text"), "text", size, make, "node long, shingles array<long>, sketch array<long>")


def _passing(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of those pairs (a, b, n_a, n_b, s_a, s_b) that wide sketches don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sides = [batch.column(i) for i in (4, 5)]
            words = [c.values.to_numpy().view(np.uint64) for c in sides]
            ends = [c.offsets.to_numpy() for c in sides]
            differ = np.empty(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                x, y = (w[e[i] : e[i + 1]] for w, e in zip(words, ends, strict=True))
                while len(x) != len(y):
                    if len(x) > len(y):
                        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                    else:
                        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
                differ[i] = np.bitwise_count(x ^ y).sum(dtype=np.int64)
            total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            kept = pa.array(differ * (100 + percent) <= total * (100 - percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(kept)

    return pairs.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _groups(signed: DataFrame) -> DataFrame:
    """(signature, group, node): the nodes under each signature that has several; equal groups once."""
    same = Window.partitionBy("signature")
    grouped = signed.select(
        "signature",
        "node",
        F.min("node").over(same).alias("least"),
        F.max("node").over(same).alias("most"),
        F.sum(F.shiftright(F.xxhash64("node"), 34)).over(same).alias("sum"),
    )
    group = F.xxhash64("least", "most", "sum").alias("group")
    return grouped.where("least <> most").groupBy(group, "node").agg(F.min("signature").alias("signature"))


def _texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text for each wanted node."""
    chosen = nodes.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct("k1", "k2", "id")).alias("r"))
    chosen = chosen.select("r.k1", "r.k2", F.col("r.id").alias("row_id"))
    if wanted.count() <= BROADCAST_ROWS // 2:  # three columns: 24 MB
        chosen = F.broadcast(chosen)
    keyed = docs.withColumns(dict(zip(("t1", "t2"), text_key("text"), strict=True)))
    on = (keyed.t1 == chosen.k1) & (keyed.t2 == chosen.k2) & keyed.id.eqNullSafe(chosen.row_id)
    return keyed.join(chosen, on).select("text")


def _blocks(rows: DataFrame) -> DataFrame:
    """Each member of a group with every other block of it: (group, x, y, block, ...), dealt and sorted so.

    Members are dealt to blocks by hash. The task of (x, y) holds two blocks, or one if they are the same.
    Groups of one ``anchor``, if there is that column, go to one task: what they share of members and sketches
    lies together there and is written in little space.
    """
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    rest = [c for c in rows.columns if c not in ("group", "blocks", "anchor")]
    anchor = F.col("anchor" if "anchor" in rows.columns else "group").alias("_anchor")
    keyed = rows.select(anchor, "group", *rest, block, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_other"))
    keyed = keyed.select(
        "_anchor", "group", F.least("block", "_other").alias("x"), F.greatest("block", "_other").alias("y"), "block", *rest
    )
    keyed = keyed.repartition("_anchor", "x", "y").drop("_anchor")
    return keyed.sortWithinPartitions("group", "x", "y", "block", "n", "node")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables of whole (group, x, y), with the place where each of these begins."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in (0, 1, 2)])
        change = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
        goes_on = last is not None and (keys[0] == last).all()
        cut = int(change[-1]) if len(change) else 0
        if cut or not goes_on:
            yield from _whole([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
        last = keys[-1]
    yield from _whole(held)
    trim_memory()


def _whole(parts: list[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    parts = [p for p in parts if p.num_rows]
    if parts:
        table = pa.Table.from_batches(parts).combine_chunks()
        keys = np.column_stack([table[c].to_numpy().astype(np.int64) for c in ("group", "x", "y")])
        yield table, np.flatnonzero(np.concatenate([[True], (np.diff(keys, axis=0) != 0).any(axis=1)]))


def _pairs_of_runs(
    sketches: Sketches, begin: np.ndarray, side: np.ndarray, n: np.ndarray, component: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, least difference) of promising pairs between the two blocks of a run, or inside one, for all runs at once."""
    ends = np.append(begin[1:], len(n))
    run = np.repeat(np.arange(len(begin)), ends - begin)
    block = np.cumsum(np.concatenate([[0], (np.diff(run) != 0) | (np.diff(side) != 0)]))
    left, right = block[begin][run], block[ends - 1][run]
    wide = int(n.max()) * 100 // percent + 2
    key = block * wide + n  # ascends, as each block is sorted by size
    low = np.searchsorted(key, right * wide + -(-n * percent // 100))
    low = np.where(left == right, np.arange(len(n)) + 1, low)
    high = np.searchsorted(key, right * wide + n * 100 // percent, side="right")
    others = np.where(block == left, np.maximum(high - low, 0), 0)
    done = np.concatenate([[0], np.cumsum(others)])
    found, at = [(np.empty(0, np.int64),) * 3], 0
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(done, done[at] + (1 << 15), side="right")) - 1)
        i = np.repeat(np.arange(at, to), others[at:to])
        j = low[i] + np.arange(done[at], done[to]) - done[i]
        apart = component[i] != component[j]
        i, j = i[apart], j[apart]
        differ = sketches.between(i, j)
        near = differ * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
        found.append((i[near], j[near], differ[near]))
        at = to
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _pairs_of_blocks(
    sketches: Sketches, side: np.ndarray, n: np.ndarray, component: np.ndarray, percent: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, all j, least differences) of promising pairs between two blocks, or inside one; each pair once."""
    left = np.flatnonzero(side == side[0])
    right = left if side[0] == side[-1] else np.flatnonzero(side == side[-1])
    for k, i in enumerate(left):
        low = k + 1 if right is left else np.searchsorted(n[right], -(-n[i] * percent // 100))
        other = right[low : np.searchsorted(n[right], n[i] * 100 // percent, side="right")]
        other = other[component[other] != component[i]]
        if len(other):
            differ = sketches.differ(i, other)
            near = differ * (100 + percent) <= (n[other] + n[i]) * (100 - percent)
            if near.any():
                yield int(i), other[near], differ[near]


_MEMBER = ["group", "x", "y", "block", "node", "component", "n"]


def _promising(rows: DataFrame, how: str, percent: int) -> DataFrame:
    """What sizes and sketches don't rule out within groups; members of one component don't meet.

    ``rows`` are (group, blocks, node, component, n, sketch). By ``how``: (group, node, partner) of each member that
    has any, with the ``closest`` in its blocks; or ``all`` pairs (a, b), where a task that would make more than ``DENSE`` a member of a
    large group returns those members that are in any pair instead, as (group, x, y, block, node, component, n).
    """

    def closest(i: np.ndarray, j: np.ndarray, differ: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, two, d = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([differ, differ])
        order = np.lexsort((d, one))
        one, two = one[order], two[order]
        first = np.concatenate([[True], np.diff(one) != 0]) if len(one) else np.empty(0, bool)
        return one[first], two[first]

    def returned(table: pa.Table, some: np.ndarray) -> pa.RecordBatch:
        member = [_column(table, c).take(pa.array(some)) for c in _MEMBER]
        return pa.RecordBatch.from_arrays([*member, *[pa.nulls(len(some), pa.int64())] * 2], [*_MEMBER, "a", "b"])

    def compare(table: pa.Table, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        side, node, component, n = (table[c].to_numpy() for c in ("block", "node", "component", "n"))
        sketches = Sketches(_column(table, "sketch"))
        if len(begin) > 1 or len(n) <= MIDDLE:
            i, j, differ = _pairs_of_runs(sketches, begin, side, n, component, percent)
            if how == "all":
                members = np.diff(np.append(begin, len(n)))
                run = np.repeat(np.arange(len(begin)), members)
                dense = (members > LARGE) & (np.bincount(run[i], minlength=len(begin)) > DENSE * members)
                inside = dense[run[i]]
                if inside.any():
                    yield returned(table, np.union1d(i[inside], j[inside]))
                    i, j = i[~inside], j[~inside]
        else:
            least, nearest = np.full(len(n), np.iinfo(np.int64).max), np.full(len(n), -1)
            kept, pairs = [(np.empty(0, np.int64),) * 2], 0
            for one, others, differ in _pairs_of_blocks(sketches, side, n, component, percent):
                pairs += len(others)
                if how == "all" and pairs <= DENSE * len(n):
                    kept.append((np.full(len(others), one), others))
                k = differ.argmin()
                for place, partner, d in ((others, one, differ), (np.array([one]), others[k], differ[k])):
                    closer = d < least[place]
                    least[place] = np.where(closer, d, least[place])
                    nearest[place] = np.where(closer, partner, nearest[place])
            i = np.flatnonzero(nearest >= 0)
            j, differ = nearest[i], least[i]
            if how == "all" and pairs > DENSE * len(n):
                yield returned(table, i)
                return
            if how == "all":
                i, j = (np.concatenate(c) for c in zip(*kept, strict=True))
        if how == "closest":
            i, j = closest(i, j, differ)  # in a large group it is known already, and this changes nothing
        if len(i) and how == "closest":
            group = _column(table, "group").take(pa.array(i))
            yield pa.RecordBatch.from_arrays([group, pa.array(node[i]), pa.array(node[j])], ["group", "node", "partner"])
        elif len(i):
            a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
            links = [pa.array(a, pa.int64()), pa.array(b, pa.int64())]
            empty = [pa.nulls(len(a), table.schema.field(c).type) for c in _MEMBER]
            yield pa.RecordBatch.from_arrays([*empty, *links], [*_MEMBER, "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begin in _runs(batches):
            ends = np.append(begin[1:], table.num_rows)
            most = np.cumsum((ends - begin) ** 2)  # twice the pairs there can be
            at = 0
            while at < len(begin):  # shorter runs are compared together, long ones alone
                to = int(np.searchsorted(most, (most[at - 1] if at else 0) + MIDDLE * MIDDLE * 8, side="right"))
                if ends[at] - begin[at] > MIDDLE:
                    to = at + 1
                else:
                    long = np.flatnonzero(ends[at:to] - begin[at:to] > MIDDLE)
                    to = max(at + 1, at + int(long[0]) if len(long) else to)
                yield from compare(table.slice(begin[at], ends[to - 1] - begin[at]), begin[at:to] - begin[at])
                at = to

    keyed = _blocks(rows)
    if how == "closest":
        return keyed.mapInArrow(run, "group long, node long, partner long")
    members = "group long, x int, y int, block int, node long, component long, n long"
    return keyed.mapInArrow(run, f"{members}, a long, b long").distinct()


def _column(table: pa.Table, name: str) -> pa.Array:
    """A column as one array."""
    column = table[name].combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _forest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) within groups that connect whatever is similar there, at most one per member.

    ``members`` are those of ``_promising``. Two members that a task has connected already don't meet.
    """

    def connect(table: pa.Table) -> list[tuple[int, int]]:
        side, node, component, n = (table[c].to_numpy() for c in ("block", "node", "component", "n"))
        shingles, sketches = _column(table, "shingles"), Sketches(_column(table, "sketch"))
        values, ends = shingles.values.to_numpy(), shingles.offsets.to_numpy()
        known = np.unique(component, return_inverse=True)[1]  # by member, the component it is in by now
        out = []
        left = np.flatnonzero(side == side[0])
        right = left if side[0] == side[-1] else np.flatnonzero(side == side[-1])
        for k, i in enumerate(left):
            low = k + 1 if right is left else np.searchsorted(n[right], -(-n[i] * percent // 100))
            other = right[low : np.searchsorted(n[right], n[i] * 100 // percent, side="right")]
            other = other[known[other] != known[i]]
            if not len(other):
                continue
            differ = sketches.differ(i, other)
            order = np.argsort(differ, kind="stable")
            own = values[ends[i] : ends[i + 1]]
            for j, d in zip(other[order], differ[order], strict=True):
                if d * (100 + percent) > (n[j] + n[i]) * (100 - percent):
                    break
                if known[j] == known[i]:
                    continue
                shared = len(np.intersect1d(own, values[ends[j] : ends[j + 1]], assume_unique=True))
                if shared * 100 >= (n[i] + n[j] - shared) * percent:
                    known[known == known[j]] = known[i]
                    out.append((int(min(node[i], node[j])), int(max(node[i], node[j]))))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begin in _runs(batches):
            for at, to in zip(begin, [*begin[1:], table.num_rows], strict=True):
                links = connect(table.slice(at, to - at))
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], ["a", "b"])

    rows = members.join(sets, "node").select("group", "x", "y", "block", "node", "component", "n", "shingles", "sketch")
    rows = rows.repartition("group", "x", "y").sortWithinPartitions("group", "x", "y", "block", "n", "node")
    return rows.mapInArrow(run, "a long, b long").distinct()


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the candidate pairs (a, b) that are similar, by their whole sets."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = stage(_sets(_texts_of(docs, nodes, stage(wanted, "wanted")), size), "sets")
    for side in "ab":
        one = sets.select(F.col("node").alias(side), F.size("shingles").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
        pairs = pairs.join(one, side)
    pairs = stage(_passing(pairs, percent), "likely")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_y"))
    union = F.size("_x") + F.size("_y") - F.col("_shared")
    joined = pairs.join(right, "b").join(left, "a").withColumn("_shared", F.size(F.array_intersect("_x", "_y")))
    return joined.where(F.col("_shared") * 100 >= union * percent).select("a", "b").distinct()


def _open(groups: DataFrame, brief: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(group, node, signature, component, members, anchor, blocks) of groups that hold several components.

    The anchor is a group's least node, as groups that share a passage or copies mostly share that; large ones stand alone.
    """
    named = groups.join(brief.select("node", "n"), "node").withColumn("component", F.col("node"))
    if labels is not None:
        named = named.drop("component").join(labels, "node", "left")
        named = named.withColumn("component", F.coalesce("component", "node"))
    several = named.groupBy("group").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"),
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("_n"), F.min("node").alias("_least"),
    ).where("_low <> _high")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("_n") / SHINGLES)).cast("int")
    blocks = F.when(F.col("members") > LARGE, blocks).otherwise(1).alias("blocks")
    anchor = F.when(F.col("members") > MIDDLE, F.col("group")).otherwise(F.col("_least")).alias("anchor")
    return named.drop("n").join(several.select("group", "members", anchor, blocks), "group")


def _meet(named: DataFrame, brief: DataFrame, how: str, percent: int) -> DataFrame:
    """What is promising in groups, with what is compared beside each member."""
    rows = named.select("group", "anchor", "node", "component", "blocks").join(brief, "node")
    return stage(_promising(rows, how, percent), "pairs")


def links(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between nodes that connect each component, and (node, component)."""
    signed = nodes.select("node", F.explode("signatures").alias("signature"))  # next to each other, equal nodes take little space
    groups = stage(_groups(signed), "groups")
    brief = nodes.join(broadcast_if_small(stage(groups.select("node").distinct(), "signers")), "node", "left_semi")
    brief = brief.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    brief = stage(brief, "sketches")
    # First everyone is paired with whom it is closest to. That settles copies, and copies of one original.
    met = _meet(_open(groups, brief, None), brief, "closest", percent)
    pairs = met.select(F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b")).distinct()
    found = stage(_verified(docs, nodes, stage(pairs, "distinct"), size, percent), "links")
    labels = stage(components(found), "labels")
    # All of a group have been compared, so who has no partner in it by sizes and sketches need not meet there again.
    partnered = broadcast_if_small(stage(met.select("group", "node").distinct(), "partnered"))
    groups = stage(groups.join(partnered, ["group", "node"], "left_semi"), "groups")
    # Large groups without much in common: their nodes sign again, these signatures last.
    still = stage(_open(groups, brief, labels), "open")
    large = still.where(F.col("members") > RESIGN)
    frequent = large.groupBy("signature").agg(F.max("members").alias("n"))
    frequent = frequent.orderBy(F.desc("n"), "signature").limit(FREQUENT).select("signature")
    concerned = stage(large.select("node").distinct(), "concerned")
    again = _again(_texts_of(docs, nodes, concerned), frequent, size, percent)
    again = _groups(again.select("node", F.explode("signatures").alias("signature")))
    rest = still.where(F.col("members") <= RESIGN).select("group", "node", "signature")
    groups = stage(rest.unionByName(again.select("group", "node", "signature")), "groups")
    # Then everyone meets everyone that isn't in the same component yet.
    left = stage(_open(groups, brief, labels), "open")
    met = _meet(left, brief, "all", percent)
    pairs = stage(met.where("group IS NULL").select("a", "b").distinct(), "distinct")
    found = stage(_verified(docs, nodes, pairs, size, percent).unionByName(found), "links")
    members = met.where("group IS NOT NULL")
    if not members.isEmpty():
        wanted = stage(members.select("node").distinct(), "wanted")
        sets = _sets(_texts_of(docs, nodes, wanted), size)
        found = found.unionByName(_forest(members.select(*_MEMBER), sets, percent))
    found = stage(found.distinct(), "links")
    return found, stage(components(found), "labels")


def similar_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75
) -> DataFrame:
    """(id, n_shingles, component_id) of every row; ``percent`` is the least Jaccard similarity.

    The component is named by the smallest id in it.
    """
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    nodes = stage(_nodes(docs, size, percent), "nodes", "zstd")
    _, labels = links(docs, nodes, size, percent)
    named = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.select("id", "n_shingles", "component")
    full = named.where("n_shingles > 0")
    least = full.groupBy("component").agg(F.min("id").alias("component_id"))
    return (
        full.join(least, "component")
        .select("id", "n_shingles", "component_id")
        .unionByName(named.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id")))
        .withColumnRenamed("id", id_col)
    )
