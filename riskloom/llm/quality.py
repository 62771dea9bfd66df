"""Quality of texts by a vote of their nearest labelled neighbours in a latent-semantic space (operator 11).

*Terms.* A text is counted as hashed terms of three families: character 3-grams of the lower-cased bytes,
shapes of words (runs of letter case, digits and the marks around them), and the share of words that repeat
one just before them. Counts are damped by logarithms and weighted by inverse document frequencies over
**all** documents; each family has length 1.

*Space.* The labelled texts that may be learned from, at most ``SAMPLE`` distinct ones of each label,
chosen by hash, span the space: their leading right singular vectors project any text to ``RANK``
numbers. The projected labelled texts, at most ``2 * SAMPLE`` vectors, are broadcast.

*Vote.* Every document is multiplied with every labelled vector, in blocks. Unit vectors are rounded to
multiples of ``1 / GRID``, so all products and sums are exact in double precision, and neither the order
of rows nor the size of a block changes a score. The ``NEIGHBOURS`` nearest vote (all that tie with the
last one too), weighted by a power of their similarity and by how many texts of their label one of the
sample stands for.

Null and empty texts have only a term of their own. A text that is near no labelled one (all products are
0 or less) gets the share of the good among all labelled texts. Equal texts get equal scores. Rows
with a null or repeated id are scored each by its text. A doc_id with contradicting labels, a label other
than 0 or 1 or a label without a document teaches nothing. Without any label every score is 0.5; with
labels of one kind, that kind. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import bytes_of, mixed, small_batches, text_key
from riskloom.llm.toxicity import held_out
from riskloom.sources.staging import stage

#: Distinct labelled texts of each label that span the space and vote, at most.
SAMPLE = 2_000
#: Neighbours that vote, and the power of the similarity that weighs them.
NEIGHBOURS, POWER = 25, 8
#: Dimensions of the latent space.
RANK = 64
#: Unit vectors are rounded to multiples of 1 / GRID.
GRID = 1 << 20
#: A text is called good from this score on.
THRESHOLD = 0.5

#: Buckets of each family of terms: character grams, shapes of words, repetition.
FAMILIES = (3072, 960, 64)
TERMS = sum(FAMILIES)
#: Words that a word is compared with before it; the steps in which their share is counted.
LAGS, STEPS = 4, 16
_PIECE = 1 << 20  # bytes counted at a time
_BLOCK = 256  # texts multiplied at a time
_SHAPES, _EMPTY = FAMILIES[0], FAMILIES[0] + FAMILIES[1]


def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte: lower case (blanks alike), class in a word's shape, and whether it is blank."""
    low = np.arange(256, dtype=np.uint32)
    kind = np.arange(256, dtype=np.uint16)
    for first, last, code in (("a", "z", "a"), ("A", "Z", "A"), ("0", "9", "0"), ("\x80", "\xff", "\x80")):
        kind[ord(first) : ord(last) + 1] = ord(code)
    low[ord("A") : ord("Z") + 1] += 32
    blank = np.isin(np.arange(256), [32, *range(9, 14)])
    low[blank], kind[blank] = 32, 32
    return low, kind, blank


_LOW, _KIND, _BLANK = _byte_tables()
_PAIRS = mixed(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1))  # a value of each pair of classes


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of 64-bit values over [start, end)."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:], dtype=np.uint64)
    return sums[ends] - sums[starts]


def _add_piece(counts: np.ndarray, words: np.ndarray, parts: list[tuple[int, bytes]]) -> None:
    """Add the terms of some parts of texts to ``counts``; ``words`` gets their words and repeated ones."""
    data = np.frombuffer(b" " + b" ".join([*(t for _, t in parts), b" "]), np.uint8)
    owner = np.array([i for i, _ in parts])
    sizes = np.array([len(t) + 1 for _, t in parts])
    ends = 1 + np.cumsum(sizes)  # of each part, after the blank behind it
    base = np.repeat((owner * TERMS).astype(np.int32), sizes)
    low = _LOW[data]
    gram = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
    gram *= np.uint32(2654435761)
    gram ^= gram >> np.uint32(15)
    # Grams begin at the blank before a part and end at the blank behind it.
    term = ((gram >> np.uint32(16)) * np.uint32(FAMILIES[0])) >> np.uint32(16)
    key = term[: len(base)].astype(np.int32) + base
    flat = counts.reshape(-1)
    flat += np.bincount(key, minlength=len(flat))
    np.subtract.at(flat, key[ends - 2], 1)  # but for the gram at a part's last byte: it holds the next one's first
    blank = _BLANK[data]
    start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    if not len(start):
        return
    of = owner[np.searchsorted(ends, start, side="right")]
    # A run of one class counts once or, if longer, twice: "Word!!" and "WORD!!!" have one shape each.
    kind = _KIND[data]
    same = kind[1:] == kind[:-1]
    value = _PAIRS[(kind[:-1] << np.uint16(8)) | kind[1:]]
    value[1:][same[1:] & same[:-1]] = 0
    shape = mixed(_spans(value, start - 1, end))
    key = of * TERMS + _SHAPES + (shape % np.uint64(FAMILIES[1])).astype(np.int64)
    flat += np.bincount(key, minlength=len(flat))
    word = _spans(gram.astype(np.uint64), start - 1, end - 1)
    again = np.zeros(len(word), bool)
    for lag in range(1, LAGS + 1):
        again[lag:] |= (word[lag:] == word[:-lag]) & (of[lag:] == of[:-lag])
    words += np.column_stack([np.bincount(of, minlength=len(words)), np.bincount(of[again], minlength=len(words))])


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Parts of texts, about a megabyte at a time; long texts are cut after a blank if there is one."""
    held, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            to = min(len(text), at + _PIECE)
            if to < len(text):
                to = max(text.rfind(b" ", at, to), text.rfind(b"\n", at, to)) + 1 or to
            held.append((i, text[at:to]))
            size += to - at + 1
            at = to
            if size >= _PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def count_terms(texts: list[bytes]) -> np.ndarray:
    """Counts of every term in each text.

    Repetition is the share of words that are one of the ``LAGS`` before them: a text has the term of each
    step its share reaches.
    """
    counts = np.zeros((len(texts), TERMS))
    words = np.zeros((len(texts), 2), np.int64)
    for parts in _pieces(texts):
        _add_piece(counts, words, parts)
    counts[:, _EMPTY] = words[:, 0] == 0
    steps = np.arange(1, STEPS + 1)
    counts[:, _EMPTY + steps] = (words[:, 1:] * STEPS >= words[:, :1] * steps) & (words[:, :1] > 0)
    return counts


@dataclass
class Neighbours:
    """What scoring needs: weights of terms, the projection, and the labelled vectors with their votes."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    good: np.ndarray
    votes: np.ndarray

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        """Damped, weighted counts; each family that occurs has length 1."""
        out = np.log1p(counts) * self.idf
        at = 0
        for size in FAMILIES:
            part = out[:, at : at + size]
            part /= np.maximum(np.sqrt((part * part).sum(axis=1, keepdims=True)), 1e-300)
            at += size
        return out

    def project(self, weighted: np.ndarray) -> np.ndarray:
        """Unit vectors of the latent space on the grid; texts outside of it are zero."""
        raw = weighted @ self.projection
        length = np.sqrt((raw * raw).sum(axis=1, keepdims=True))
        return np.rint(np.where(length > 1e-9, raw / np.maximum(length, 1e-9), 0) * GRID) / GRID

    def score_texts(self, texts: list[bytes]) -> np.ndarray:
        """Share of the good among the weighted votes of each text's neighbours."""
        out = np.full(len(texts), 0.5)
        if not len(self.good):
            return out
        all_good = float((self.good * self.votes).sum() / self.votes.sum())
        for at in range(0, len(texts), _BLOCK):
            own = self.project(self.weighted(count_terms(texts[at : at + _BLOCK])))
            near = own @ self.vectors.T  # exact: multiples of GRID**-2 below 2**53
            k = max(len(self.good) - NEIGHBOURS, 0)
            last = np.partition(near, k, axis=1)[:, k : k + 1]
            weight = np.where(near >= last, np.maximum(near, 0), 0) ** POWER * self.votes
            total = weight.sum(axis=1)
            voted = (weight * self.good).sum(axis=1)
            out[at : at + _BLOCK] = np.where(total > 0, voted / np.where(total > 0, total, 1), all_good)
        return np.round(out, 9)


def document_frequencies(df: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """Number of texts, and in how many of them each term occurs: counted over all rows.

    A task hands on one row per term, so what is shuffled depends on tasks, not on documents.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(TERMS + 1, np.int64)
        for batch in small_batches(batches, 1 << 20):
            texts = bytes_of(batch.column(0))
            found[TERMS] += len(texts)
            for at in range(0, len(texts), _BLOCK):
                found[:TERMS] += (count_terms(texts[at : at + _BLOCK]) > 0).sum(axis=0)
        term = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(found[term])], ["term", "n"])

    counted = df.select(text_col).mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(TERMS + 1, np.int64)
    for r in counted.collect():  # at most TERMS + 1 rows
        out[r["term"]] = r["n"]
    return int(out[TERMS]), out[:TERMS]


def _labelled(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(k1, k2, good): the distinct texts that may be learned from; copies of a text go by their majority."""
    mark = F.col(label_col).cast("int")
    taught = labels.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)) & F.col(label_col).isin(0, 1))
    taught = taught.groupBy(id_col).agg(F.min(mark).alias("_good"), F.max(mark).alias("_most")).where("_good = _most")
    texts = df.select(id_col, *text_key(text_col)).join(taught.select(id_col, "_good"), id_col)
    share = F.avg("_good")
    return texts.groupBy("k1", "k2").agg(F.when(share > 0.5, 1).when(share < 0.5, 0).alias("good")).where("good IS NOT NULL")


def _counts_of(df: DataFrame, chosen: DataFrame, text_col: str) -> list:
    """(k1, k2, good, terms, counts) of the chosen distinct texts, one row each."""
    keyed = df.select(*text_key(text_col), text_col).join(F.broadcast(chosen), ["k1", "k2"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1 << 20):
            texts, out = bytes_of(batch.column(3)), []
            for at in range(0, len(texts), _BLOCK):
                for row in count_terms(texts[at : at + _BLOCK]):
                    some = np.flatnonzero(row)
                    out.append((some.astype("<u2").tobytes(), row[some].astype("<f8").tobytes()))
            columns = [pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["k1", "k2", "good", "terms", "counts"])

    schema = "k1 long, k2 long, good int, terms binary, counts binary"
    found = keyed.select("k1", "k2", "good", text_col).mapInArrow(count, schema)
    return found.dropDuplicates(["k1", "k2"]).collect()  # at most 2 * SAMPLE rows of at most TERMS terms


def train(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Neighbours:
    """Term weights over all of ``df`` and the vectors of at most ``2 * sample`` labelled texts."""
    n, found = document_frequencies(df, text_col)
    idf = np.log((n + 1) / (found + 0.5))
    known = stage(_labelled(df, labels, id_col, text_col, label_col), "labelled")
    sizes = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_hash = [F.xxhash64(F.lit("quality"), "k1", "k2"), F.col("k1"), F.col("k2")]
    rows = []
    for good in sorted(sizes):
        chosen = known.where(F.col("good") == good).orderBy(*by_hash).limit(sample)
        rows += _counts_of(df, stage(chosen, "chosen"), text_col)
    rows.sort(key=lambda r: (r["good"], r["k1"], r["k2"]))
    good = np.array([r["good"] for r in rows], np.float64)
    of_label = {label: max(int((good == label).sum()), 1) for label in sizes}
    votes = np.array([sizes[r["good"]] / of_label[r["good"]] for r in rows], np.float64)
    empty = Neighbours(idf, np.zeros((TERMS, 0)), np.zeros((0, 0)), good, votes)
    if not rows:
        return empty
    matrix = np.zeros((len(rows), TERMS))
    for i, r in enumerate(rows):
        matrix[i, np.frombuffer(r["terms"], "<u2")] = np.frombuffer(r["counts"], "<f8")
    matrix = empty.weighted(matrix)
    model = Neighbours(idf, _right_vectors(matrix), np.zeros((0, 0)), good, votes)
    model.vectors = model.project(matrix)
    return model


def _right_vectors(matrix: np.ndarray, rank: int = RANK, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a seeded start."""
    width = min(rank, *matrix.shape)
    basis = np.random.default_rng(11).normal(size=(matrix.shape[1], min(width + 16, matrix.shape[1])))
    for _ in range(rounds):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    return basis @ np.linalg.svd(matrix @ basis, full_matrices=False)[2].T[:, :width]


def score(df: DataFrame, model: Neighbours, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most 2 * SAMPLE vectors of RANK numbers
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1 << 20):
            scores = shared.value.score_texts(bytes_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [id_col, "score"])

    scored = df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
