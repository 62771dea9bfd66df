"""Toxicity of texts by a bidirectional recurrent network over words and their characters (operator 6).

A text is cut into overlapping windows of ``WINDOW`` words, ``STRIDE`` apart. A word's input is an
embedding of its hash beside the mean embedding of its character 3- and 4-grams. Gated recurrent
cells read the window in both directions, attention pools their states, and a logistic unit scores the
window. A text is as toxic as its worst window. All of it is numpy; training runs on a bounded, seeded
sample of labelled rows, scoring runs in the tasks, window by window in batches.

Labels belong to texts, not windows. Training starts from the window of each toxic text that holds what
is most peculiar to toxic texts, and later takes the window the network itself finds worst; clean texts
give any of their windows. Held-back texts of the sample calibrate the score.

Null and empty texts get the score of an empty window. Equal texts get equal scores. Without labels of
both kinds there is no network and every score is 0. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Rolling, mixed, small_batches, texts_of

WINDOW, STRIDE = 48, 24
#: Labelled texts the network is trained on, of each kind, at most; all windows of each are kept.
SAMPLE = 1_200
#: A text is called toxic from this score on.
THRESHOLD = 0.7

_WORD_BUCKETS, _GRAM_BUCKETS, _EMBED, _HIDDEN = 8192, 16384, 8, 8
_TO_SPACE = bytes(32 if chr(b) in "\"'!#$%&()*+,-./:;<=>?@[\\]^_`{|}~" else b for b in range(128)) + bytes(
    range(128, 256)
)


def words_of(text: str) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.lower().encode("utf-8").translate(_TO_SPACE).split()


def windows(n: int) -> list[tuple[int, int]]:
    """Overlapping windows over ``n`` words; every word is in one, and none is left out at the end."""
    if n <= WINDOW:
        return [(0, n)]
    return [(a, min(a + WINDOW, n)) for a in range(0, n - WINDOW + STRIDE, STRIDE)]


class Inputs:
    """Hash buckets of distinct words: one for the word, some for its character grams."""

    def __init__(self, words: list[bytes]) -> None:
        data = np.frombuffer(b"".join([b"^" + w + b"$" for w in words]), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
        ends = np.cumsum(lengths)
        starts = ends - lengths
        owner = np.repeat(np.arange(len(words)), lengths)
        self.word = np.empty(0, np.int64)
        grams, owners = [], []
        if len(words):
            self.word = (Rolling(mixed(data.astype(np.uint64))).spans(starts, ends) % np.uint64(_WORD_BUCKETS)).astype(np.int64)
            code = data.astype(np.uint64)
            for size in (3, 4):
                n = len(data) - size + 1
                if n <= 0:
                    continue
                inside = np.flatnonzero(owner[:n] == owner[size - 1 :])
                gram = np.full(len(inside), size, np.uint64)
                for k in range(size):
                    gram = gram * np.uint64(257) + code[inside + k]
                grams.append((mixed(gram) % np.uint64(_GRAM_BUCKETS)).astype(np.int64))
                owners.append(owner[inside])
        self.gram = np.concatenate(grams) if grams else np.empty(0, np.int64)
        self.owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = np.argsort(self.owner, kind="stable")
        self.gram, self.owner = self.gram[order], self.owner[order]
        self.count = np.bincount(self.owner, minlength=len(words)).astype(np.float32)

    def vectors(self, weights: dict[str, np.ndarray]) -> np.ndarray:
        """One row per word, and a row of zeros at the end for no word."""
        out = np.zeros((len(self.word) + 1, 2 * _EMBED), np.float32)
        out[:-1, :_EMBED] = weights["word"][self.word]
        if len(self.gram):
            begin = np.concatenate([[0], np.cumsum(self.count[:-1])]).astype(np.int64)
            some = self.count > 0
            for at in range(0, len(self.word), 8192):
                part = slice(at, min(at + 8192, len(self.word)))
                mine = some[part]
                if not mine.any():
                    continue
                first, last = begin[part][0], begin[part][-1] + int(self.count[part][-1])
                sums = np.add.reduceat(weights["gram"][self.gram[first:last]], begin[part][mine] - first, axis=0)
                out[np.arange(part.start, part.stop)[mine], _EMBED:] = sums / self.count[part][mine][:, None]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _squash(x: np.ndarray, factor: float) -> np.ndarray:
    """``1 / (1 + exp(factor * x))`` in place of ``x``; an overflow means 0."""
    x *= factor
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    """Hyperbolic tangent in place of ``x``."""
    _squash(x, -2.0)
    x *= 2
    x -= 1
    return x


class Network:
    """Two gated recurrent layers, one per direction, attention and a logistic unit."""

    def __init__(self, seed: int = 5) -> None:
        self.rng = np.random.default_rng(seed)

        def scaled(*shape: int, by: float | None = None) -> np.ndarray:
            return self.rng.normal(0, by or 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        self.weights = {"word": scaled(_WORD_BUCKETS, _EMBED, by=0.1), "gram": scaled(_GRAM_BUCKETS, _EMBED, by=0.1)}
        for way in "fb":
            self.weights[f"in_{way}"] = scaled(2 * _EMBED, 3 * _HIDDEN)
            self.weights[f"state_{way}"] = scaled(_HIDDEN, 3 * _HIDDEN)
            self.weights[f"bias_{way}"] = np.zeros(3 * _HIDDEN, np.float32)
        self.weights["attend"] = scaled(2 * _HIDDEN, 2 * _HIDDEN)
        self.weights["query"] = scaled(2 * _HIDDEN)
        self.weights["out"] = scaled(2 * _HIDDEN)
        self.weights["out_bias"] = np.zeros(1, np.float32)
        self.slope, self.shift = 1.0, 0.0

    def _layer(self, way: str, places: np.ndarray, table: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """States of one direction for windows of word places; ``keep`` gathers what backward needs."""
        n, steps = places.shape
        recurrent = self.weights[f"state_{way}"]
        gates_by, new_by = recurrent[:, : 2 * _HIDDEN].copy(), recurrent[:, 2 * _HIDDEN :].copy()
        gates_in, new_in = table[:, : 2 * _HIDDEN].copy(), table[:, 2 * _HIDDEN :].copy()
        states = np.zeros((steps, n, _HIDDEN), table.dtype)
        h = np.zeros((n, _HIDDEN), table.dtype)
        whole = bool(mask.all())
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            at = places[:, t]
            gates = h @ gates_by
            gates += gates_in.take(at, axis=0, mode="wrap")
            _squash(gates, -1.0)
            z, r = gates[:, :_HIDDEN], gates[:, _HIDDEN:]
            own = h @ new_by
            new = r * own
            new += new_in.take(at, axis=0, mode="wrap")
            _tanh(new)
            following = new - h
            following *= 1 - z
            if not whole or keep is not None:
                live = mask[:, t : t + 1]
                following *= live
            following += h
            if keep is not None:
                keep.append((t, h, z, r, new, own, live))
            h = states[t] = following
        return states

    def logits(self, places: np.ndarray, vectors: np.ndarray, cache: dict | None = None) -> np.ndarray:
        """Logit of each window; -1 and the last row of ``vectors`` stand for no word."""
        w = self.weights
        mask = (places >= 0).astype(np.float32)
        both = []
        for way in "fb":
            table = vectors @ w[f"in_{way}"] + w[f"bias_{way}"]
            keep = [] if cache is not None else None
            both.append(self._layer(way, places, table, mask, keep))
            if cache is not None:
                cache[way] = keep
        states = np.concatenate(both, axis=2)
        seen = _tanh(states @ w["attend"])
        weight = seen @ w["query"] + (mask.T - 1) * 1e4
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        if cache is not None:
            cache.update(states=states, seen=seen, weight=weight, pooled=pooled, mask=mask)
        return pooled @ w["out"] + w["out_bias"]

    def gradients(self, places: np.ndarray, inputs: Inputs, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy."""
        w, cache = self.weights, {}
        vectors = inputs.vectors(w)
        logit = self.logits(places, vectors, cache)
        d = ((_sigmoid(logit) - y) / len(y)).astype(np.float32)
        grads = {"out": cache["pooled"].T @ d, "out_bias": d.sum(keepdims=True)}
        d_pooled = d[:, None] * w["out"]
        states, seen, weight = cache["states"], cache["seen"], cache["weight"]
        d_states = weight[:, :, None] * d_pooled[None]
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grads["query"] = np.einsum("tn,tnh->h", d_score, seen)
        d_seen = d_score[:, :, None] * w["query"] * (1 - seen**2)
        grads["attend"] = np.einsum("tnh,tnk->hk", states, d_seen)
        d_states += d_seen @ w["attend"].T
        d_vectors = np.zeros_like(vectors)
        for side, way in enumerate("fb"):
            own_states = d_states[:, :, side * _HIDDEN : (side + 1) * _HIDDEN]
            recurrent = w[f"state_{way}"]
            d_recurrent = np.zeros_like(recurrent)
            d_table = np.zeros((len(vectors), 3 * _HIDDEN), np.float32)
            d_h = np.zeros((len(y), _HIDDEN), np.float32)
            for t, h, z, r, new, own, live in reversed(cache[way]):
                total = d_h + own_states[t]
                d_new = total * live * (1 - z) * (1 - new**2)
                d_z = total * live * (h - new) * z * (1 - z)
                d_r = d_new * own * r * (1 - r)
                given = np.concatenate([d_z, d_r, d_new], axis=1)
                through = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_recurrent += h.T @ through
                d_h = total * (1 - live * (1 - z)) + through @ recurrent.T
                np.add.at(d_table, places[:, t], given)
            d_table[-1] = 0
            grads[f"state_{way}"] = d_recurrent
            grads[f"bias_{way}"] = d_table.sum(axis=0)
            grads[f"in_{way}"] = vectors.T @ d_table
            d_vectors += d_table @ w[f"in_{way}"].T
        grads["word"], grads["gram"] = np.zeros_like(w["word"]), np.zeros_like(w["gram"])
        np.add.at(grads["word"], inputs.word, d_vectors[:-1, :_EMBED])
        shares = d_vectors[:-1, _EMBED:] / np.maximum(inputs.count, 1)[:, None]
        np.add.at(grads["gram"], inputs.gram, shares[inputs.owner])
        return grads

    def score_texts(self, texts: list[list[bytes]]) -> np.ndarray:
        """Score of each text of words: that of its worst window."""
        return _sigmoid(self.slope * self.worst(texts)[0].astype(np.float64) + self.shift)

    def worst(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Largest window logit of each text, and which window has it."""
        index: dict[bytes, int] = {}
        flat = np.fromiter((index.setdefault(w, len(index)) for t in texts for w in t), np.int64)
        counts = np.array([len(t) for t in texts], np.int64)
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        per_text = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
        owner = np.repeat(np.arange(len(texts)), per_text)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        vectors = Inputs(list(index)).vectors(self.weights)
        logit = np.empty(len(owner), np.float32)
        steps = np.arange(WINDOW)
        for at in range(0, len(owner), 2048):
            rows, start = owner[at : at + 2048], nth[at : at + 2048] * STRIDE
            place = start[:, None] + steps
            real = place < counts[rows][:, None]
            where = np.where(real, first[rows][:, None] + place, 0)
            places = np.where(real, flat[where], -1) if len(flat) else np.full(place.shape, -1)
            logit[at : at + 2048] = self.logits(places, vectors)
        begin = np.cumsum(per_text) - per_text
        most = np.maximum.reduceat(logit, begin)
        hit = np.flatnonzero(logit == most[owner])
        which = np.full(len(texts), len(owner))
        np.minimum.at(which, owner[hit], nth[hit])
        return most, which


def _sample(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> list:
    """(hash, label, windows) of at most ``sample`` texts of each kind that may be trained on, by hash.

    Tasks send the words of a text once; its windows, all of them, are cut here and share their words.
    """
    marked = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col(id_col)))
        .groupBy(id_col).agg(F.max("toxic").alias("toxic"))
        .withColumn("_at", F.xxhash64(F.lit("toxicity"), F.col(id_col)))
    )
    chosen = [
        F.broadcast(marked.where(F.col("toxic") == kind).orderBy("_at", id_col).limit(sample)) for kind in (0, 1)
    ]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = [b" ".join(words_of(text)) for text in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["toxic", "at", "words"]
            )

    rows = []
    for kind in chosen:
        found = df.select(id_col, text_col).join(kind, id_col)
        found = found.select(F.col("toxic").cast("int").alias("toxic"), "_at", text_col)
        rows += found.mapInArrow(cut, "toxic int, at long, words binary").collect()
    known: dict[bytes, bytes] = {}
    out = []
    for at, toxic, text in sorted((r["at"], r["toxic"], bytes(r["words"])) for r in rows):
        words = [known.setdefault(w, w) for w in text.split()]
        out.append((at, toxic, [words[a:b] for a, b in windows(len(words))]))
    return out


def _peculiar(positive: list[list[list[bytes]]], negative: list[list[list[bytes]]]) -> dict[bytes, float]:
    """Log odds of words and their beginnings to occur in a toxic text."""
    def traits(text: list[list[bytes]]) -> set[bytes]:
        found = {w for window in text for w in window}
        return found | {w[:n] + b"*" for w in found for n in (4, 5) if len(w) > n}

    counts: dict[bytes, list[int]] = {}
    for side, texts in enumerate((negative, positive)):
        for text in texts:
            for trait in traits(text):
                counts.setdefault(trait, [0, 0])[side] += 1
    n, p = len(negative) + 1, len(positive) + 1
    return {t: float(np.log((b + 0.5) / p) - np.log((a + 0.5) / n)) for t, (a, b) in counts.items() if b >= 5}


def train(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, rounds: int = 10
) -> Network | None:
    """A calibrated network; None if the labels that may be learned from are all alike."""
    rows = [(y, cut) for _, y, cut in _sample(df, labels, id_col, text_col, sample)]
    if len({y for y, _ in rows}) < 2:
        return None
    held = [i % 5 == 4 for i in range(len(rows))]
    fit = [r for r, h in zip(rows, held, strict=True) if not h]
    if len({y for y, _ in fit}) < 2:
        fit = rows
    positive = [t for y, t in fit if y == 1]
    negative = [t for y, t in fit if y == 0]
    odds = _peculiar(positive, negative)

    def strange(window: list[bytes]) -> float:
        traits = set(window) | {w[:n] + b"*" for w in window for n in (4, 5) if len(w) > n}
        return sum(max(0.0, odds.get(t, 0.0) - 1.5) for t in traits)

    network = Network()
    np.seterr(over="ignore")
    chosen = [max(range(len(t)), key=lambda i, t=t: strange(t[i])) for t in positive]
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    step, rng = 0, network.rng
    for done in range(rounds):
        if done in (3, 6):
            chosen = [_worst_of(network, t) for t in positive]
            hardest = [t[_worst_of(network, t)] for t in negative]
        windows_now = [t[i] for t, i in zip(positive, chosen, strict=True)]
        clean = [t[i] for t in negative for i in rng.integers(0, len(t), 2)]
        clean += hardest if done >= 3 else []
        examples = [(w, 1.0) for w in windows_now] + [(w, 0.0) for w in clean]
        order = rng.permutation(len(examples))
        for at in range(0, len(order), 64):
            some = [examples[i] for i in order[at : at + 64]]
            index: dict[bytes, int] = {}
            places = np.full((len(some), WINDOW), -1, np.int64)
            for i, (window, _) in enumerate(some):
                places[i, : len(window)] = [index.setdefault(w, len(index)) for w in window]
            y = np.array([y for _, y in some], np.float32)
            step += 1
            for k, g in network.gradients(places, Inputs(list(index)), y).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rise = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                network.weights[k] -= (0.01 * rise).astype(np.float32)
    unseen = [r for r, h in zip(rows, held, strict=True) if h]
    unseen = unseen if len({y for y, _ in unseen}) == 2 else rows
    _calibrate(network, unseen)
    return network


def _worst_of(network: Network, windows_of_text: list[list[bytes]]) -> int:
    """The window of one text with the largest logit."""
    return int(network.worst(windows_of_text)[0].argmax())


def _calibrate(network: Network, rows: list[tuple[int, list[list[bytes]]]]) -> None:
    """A slope and shift for the logit of a text's worst window, by Newton steps with a small penalty."""
    logit = np.array([network.worst(t)[0].max() for _, t in rows], np.float64)
    y = np.array([y for y, _ in rows], np.float64)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    design = np.column_stack([logit, np.ones_like(logit)])
    beta = np.array([1.0, 0.0])
    for _ in range(30):
        p = _sigmoid(design @ beta)
        gradient = design.T @ (p - target) + 1e-3 * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(curve, gradient), -2, 2)
    network.slope, network.shift = max(float(beta[0]), 1e-3), float(beta[1])
    low, high = np.quantile(logit[y > 0], 0.01), logit[y == 0].max()
    if low > high:  # a clear gap: put the threshold into it, nearer to the toxic side
        cut = high + 0.6 * (low - high)
        network.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - network.slope * cut)


def held_out(ids):
    """Whether a row's label is kept from training: its id's checksum leaves 1 by 3."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def score(df: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(network)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2 << 20):
            scores = np.zeros(batch.num_rows)
            if shared.value is not None and batch.num_rows:
                with np.errstate(over="ignore"):
                    scores = shared.value.score_texts([words_of(t) for t in texts_of(batch.column(1))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [id_col, "score"])

    scored = df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
