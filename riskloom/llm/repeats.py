"""Removal of passages that repeat, by seed and extend (operator 10).

*Seeds.* The words of each text are winnowed: of every window of ``length`` words, the smallest hash of
``seed`` words in it is the window's anchor. Equal windows have equal anchors at the same place, so
documents joined on anchors miss no repeat. Most anchors occur once and are dropped here.

*Extension.* An anchor serves a run of windows; together they span the words around it, as far as a
repeat through this anchor matters. Occurrences of an anchor are not paired: they are put into classes
by the hash of that whole span. A class of two or more extends both ways to all of its windows. Only
where one anchor has several spans (the edge of a repeat lies in one of them) are the windows of one
member of each class written out and counted one by one, with 128-bit hashes. What repeats is joined
into maximal runs again. All this grows with the number of occurrences, never with their square.

Null and empty texts have no words. Texts shorter than ``length`` keep all words. Repeated rows are
repeats of each other. Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Words, broadcast_if_small, bytes_of, lists, small_batches, text_key
from riskloom.sources.staging import stage


def _anchored_runs(words: Words, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """Row, anchor hash, span hash, first and last window start of each run of windows."""
    starts = words.starts(length)
    if not len(starts):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty
    n = len(words.row)
    places = np.arange(n - seed + 1)
    seeds = words.rolling[0].spans(places, places + seed)
    width = length - seed + 1
    anchors = np.empty(len(starts), np.int64)
    for at in range(0, len(starts), 1 << 14):
        some = starts[at : at + (1 << 14)]
        views = np.lib.stride_tricks.sliding_window_view(seeds[some[0] : some[-1] + width], width)
        back = views[some - some[0], ::-1].argmin(axis=1)  # of equal hashes, the last
        anchors[at : at + (1 << 14)] = some + width - 1 - back
    change = np.flatnonzero((np.diff(anchors) != 0) | (np.diff(starts) != 1)) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change, [len(starts)]]) - 1
    begin, end = starts[first], starts[last]
    rows = words.row[begin]
    spans = words.rolling[0].spans(begin, end + length)
    base = words.first[rows]
    return rows, seeds[anchors[first]].view(np.int64), spans.view(np.int64), begin - base, end - base


def _runs(df: DataFrame, text: str, length: int, seed: int) -> DataFrame:
    """One row per text: its key and the runs of windows by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            words = Words(bytes_of(batch.column(2)))
            rows, *columns = _anchored_runs(words, length, seed)
            cut = np.searchsorted(rows, np.arange(1, batch.num_rows))
            anchors, spans, begin, end = (np.split(c, cut) for c in columns)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists(anchors), lists(spans),
                 lists(begin, np.int32), lists(end, np.int32)],
                ["k1", "k2", "anchor", "span", "begin", "end"],
            )

    schema = "k1 long, k2 long, anchor array<long>, span array<long>, begin array<int>, end array<int>"
    return df.select(*text_key(text), text).mapInArrow(run, schema)


def _windows(df: DataFrame, text: str, length: int) -> DataFrame:
    """Both hashes of every window in the runs of ``df``, with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            words = Words(bytes_of(batch.column(2)), tables=2)
            rows, places, edges = [], [], []
            for i, runs in enumerate(batch.column(3).to_pylist()):
                for r in runs:
                    more = np.arange(r["begin"], r["end"] + 1)
                    places.append(more)
                    rows.append(np.full(len(more), i))
                    edges.append(np.full(len(more), r["alone"]))
            if not rows:
                continue
            row, place, edge = np.concatenate(rows), np.concatenate(places), np.concatenate(edges)
            at = words.first[row] + place
            keys = [batch.column(c).to_numpy(zero_copy_only=False)[row] for c in (0, 1)]
            spans = [r.spans(at, at + length).view(np.int64) for r in words.rolling]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (*spans, *keys, place.astype(np.int32), edge.astype(bool))],
                ["w1", "w2", "k1", "k2", "begin", "alone"],
            )

    schema = "w1 long, w2 long, k1 long, k2 long, begin int, alone boolean"
    return df.select("k1", "k2", text, "runs").mapInArrow(run, schema)


def _with_text(df: DataFrame, text: str, keyed: DataFrame) -> DataFrame:
    """Texts with what belongs to their key; only texts of such keys are shuffled if the keys are few."""
    keys = broadcast_if_small(keyed.select("k1", "k2"))
    return df.withColumns({c: k for c, k in zip(("k1", "k2"), text_key(text), strict=True)}).join(
        keys, ["k1", "k2"], "left_semi"
    ).join(keyed, ["k1", "k2"])


def repeated_windows(df: DataFrame, text: str = "text", length: int = 35, seed: int = 8) -> DataFrame:
    """(k1, k2, spans): for each text that has any, the runs (first, last) of repeated window starts."""
    if not 0 < seed <= length:
        raise ValueError("a seed must fit into a window")
    runs = _runs(df, text, length, seed).withColumn("row", F.monotonically_increasing_id())
    runs = stage(runs, "runs")  # from here on the numbers are fixed
    places = runs.select(
        "row", F.explode(F.arrays_zip("anchor", "span", "begin", "end")).alias("r")
    ).select("row", "r.*")
    shared = (
        places.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.min("span").alias("a"), F.max("span").alias("b"))
        .where("n > 1")
        .select("anchor", (F.col("a") != F.col("b")).alias("mixed"))
    )
    shared = stage(shared, "shared")  # so that a frequent anchor's side of the join can be split
    seeds = stage(places.join(shared, "anchor"), "seeds")
    classes = stage(
        seeds.where("mixed")
        .groupBy("anchor", "span")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "begin", "end")).alias("one")),
        "classes",
    )
    keys = runs.select("row", "k1", "k2")
    sure = seeds.where("NOT mixed").select("row", "begin", "end").unionByName(
        seeds.where("mixed")
        .join(classes.where("n > 1").select("anchor", "span"), ["anchor", "span"])
        .select("row", "begin", "end")
    )
    sure = sure.join(keys, "row").select("k1", "k2", "begin", "end")
    wanted = (
        classes.select("one.*", (F.col("n") == 1).alias("alone"))
        .join(keys, "row")
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("begin", "end", "alone")).alias("runs"))
    )
    wanted = stage(wanted, "edges")
    windows = stage(_windows(_with_text(df.select(text), text, wanted), text, length), "windows")
    twice = windows.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    edges = windows.where("alone").join(twice, ["w1", "w2"], "left_semi")
    edges = edges.select("k1", "k2", "begin", F.col("begin").alias("end"))
    return (
        sure.unionByName(edges)
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct(F.col("begin").alias("first"), F.col("end").alias("last"))).alias("spans"))
    )


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35, seed: int = 8
) -> DataFrame:
    """(id, n_words, n_removed, repeats, kept) of every row.

    ``repeats`` holds the maximal repeats as (start, end) in words, end exclusive; ``kept`` is the
    other words joined by one space.
    """
    docs = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = stage(repeated_windows(docs, "_text", length, seed), "repeats")
    keys = broadcast_if_small(found.select("k1", "k2"))
    kind = df.schema[id_col].dataType.simpleString()
    keyed = docs.withColumns(dict(zip(("k1", "k2"), text_key("_text"), strict=True)))
    nothing = F.array().cast("array<struct<first:int,last:int>>").alias("spans")
    rows = keyed.join(keys, ["k1", "k2"], "left_anti").select(id_col, "_text", nothing).unionByName(
        _with_text(docs, "_text", found).select(id_col, "_text", "spans")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            counts, removed, repeats, kept = [], [], [], []
            for text, spans in zip(bytes_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words = text.split()
                maximal: list[list[int]] = []
                for s in sorted((s["first"], s["last"] + length) for s in spans or ()):
                    if maximal and s[0] <= maximal[-1][1]:
                        maximal[-1][1] = max(maximal[-1][1], s[1])
                    else:
                        maximal.append([*s])
                left, at = [], 0
                for start, end in maximal:
                    left += words[at:start]
                    at = end
                left += words[at:]
                counts.append(len(words))
                removed.append(len(words) - len(left))
                repeats.append([{"start": a, "end": b} for a, b in maximal])
                kept.append(b" ".join(left).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(repeats, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(kept, pa.string())],
                [id_col, "n_words", "n_removed", "repeats", "kept"],
            )

    schema = (
        f"`{id_col}` {kind}, n_words long, n_removed long,"
        " repeats array<struct<start:int,end:int>>, kept string"
    )
    return rows.mapInArrow(run, schema)
