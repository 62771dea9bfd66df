"""Secrets in texts: fixed patterns, and a character network over everything that looks like one (operator 3).

Candidates are the matches of the patterns and every other long token that mixes letters and digits.
A convolutional network over characters, in numpy, scores each candidate together with the text around
it. Matches of the patterns are findings whatever the network says; of the other candidates, those
above a threshold are added as kind ``net``.

The network is trained on all distinct findings that the patterns label. Three quarters of the values fit the
weights and the rest, unseen, calibrate the score and set the threshold, the largest that keeps the wanted recall.
In half of the positive examples the text before is blanked, so that the score doesn't rest on a keyword alone.
More than ``SAMPLE`` examples are dealt by hash to shards of about as many: a round is one pass of each shard from
the common weights, which are then averaged by the shards' sizes; labels count alike however many examples they
have. The fit is seeded and reruns agree.

Null and empty texts have no findings. Ties in position follow the order of the kinds. Only the id and
text columns are read. Empty tables train nothing; then only the patterns find.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, texts_of
from riskloom.sources.staging import stage

#: Fixed patterns: kind, expression, the group whose length counts, its least length.
PATTERNS = [
    (
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
    ("hex", r"[0-9a-f]+", 0, 0, 24),
]
KINDS = [kind for kind, *_ in PATTERNS] + ["net"]
_TOKEN = r"[A-Za-z0-9+/_=-]{16,}"

#: Examples the network is trained on at a time; more are dealt to shards of about as many.
SAMPLE = 4_000
#: Passes over the examples, and shards whose weights are averaged at a time.
ROUNDS, MERGED = 8, 64
#: Characters of a candidate and of the text on each side that the network reads at a time. A longer
#: candidate is read in windows, ``STEP`` apart, and is worth the largest score of them.
VALUE, CONTEXT, STEP = 40, 20, 20
RECALL = 0.95


def _patterns() -> tuple[list, re.Pattern]:
    return [(k, re.compile(p, f), g, n) for k, p, f, g, n in PATTERNS], re.compile(_TOKEN)


class Finder:
    """Base spans of a text, and the further candidates."""

    def __init__(self) -> None:
        self.patterns, self.token = _patterns()
        self.long = re.compile(r"[A-Za-z0-9+/_=-]{16}")

    @staticmethod
    def _may_assign(text: str) -> bool:
        """A prefilter: some name occurs, in either case."""
        lower = text.lower()
        return any(name in lower for name in ("passw", "secret", "token", "apikey", "api_key"))

    def find(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
        """(start, kind number, end) of all matches that are long enough, in order, and (start, end)
        of the long tokens of letters and digits that touch none of them."""
        named, long = self._may_assign(text), self.long.search(text)
        base, others = [], []
        for number, (_, pattern, group, least) in enumerate(self.patterns):
            if long if number else named:
                for match in pattern.finditer(text):
                    if match.end(group) - match.start(group) >= least:
                        base.append((match.start(), number, match.end()))
        base.sort()
        if long:
            at = 0
            for match in self.token.finditer(text):
                token = match.group()
                if any(map(str.isdigit, token)) and any(map(str.isalpha, token)):
                    while at < len(base) and base[at][2] <= match.start() and base[at][0] < match.start():
                        at += 1
                    near = base[max(0, at - 3) : at + 3]
                    if all(end <= match.start() or start >= match.end() for start, _, end in near):
                        others.append(match.span())
        return base, others


def codes(text: str, start: int, end: int, blank: bool = False) -> np.ndarray:
    """Character classes around and inside a whole candidate: 0 is nothing, 1-95 ASCII, 96 anything else."""
    before = " " * CONTEXT if blank else text[max(0, start - CONTEXT) : start].rjust(CONTEXT, "\0")
    value = text[start:end].ljust(VALUE, "\0")
    after = text[end : end + CONTEXT].ljust(CONTEXT, "\0")
    points = np.frombuffer((before + value + after).encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where(points == 0, 0, np.where((points >= 32) & (points < 127), points - 31, 96)).astype(np.uint8)


def windows(points: np.ndarray) -> np.ndarray:
    """Overlapping windows over the codes of one candidate, the last of them up to its end."""
    all_of_them = np.lib.stride_tricks.sliding_window_view(points, VALUE + 2 * CONTEXT)
    last = len(all_of_them) - 1
    return all_of_them[[*range(0, last, STEP), last]]


class Network:
    """Embedded characters, one convolution, maximum over places, a hidden layer, a calibrated logit."""

    CHARS, EMBED, WIDTH, FILTERS, HIDDEN = 97, 8, 5, 24, 16

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.rng = rng
        scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.weights = {
            "embed": rng.normal(0, 0.5, (self.CHARS, self.EMBED)).astype(np.float32),
            "conv": scale(self.WIDTH * self.EMBED, self.FILTERS),
            "conv_bias": np.zeros(self.FILTERS, np.float32),
            "hidden": scale(self.FILTERS, self.HIDDEN),
            "hidden_bias": np.zeros(self.HIDDEN, np.float32),
            "out": scale(self.HIDDEN, 1),
            "out_bias": np.zeros(1, np.float32),
        }
        self.slope, self.shift, self.threshold = 1.0, 0.0, 1.0

    def _forward(self, x: np.ndarray) -> tuple:
        w = self.weights
        embedded = w["embed"][x]
        views = np.lib.stride_tricks.sliding_window_view(embedded, self.WIDTH, axis=1)
        patches = views.transpose(0, 1, 3, 2).reshape(len(x), -1, self.WIDTH * self.EMBED)
        maps = patches @ w["conv"] + w["conv_bias"]
        top = maps.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(maps, top[:, None], axis=1)[:, 0], 0)
        hidden = np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)
        return patches, top, pooled, hidden, (hidden @ w["out"] + w["out_bias"])[:, 0]

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> dict[str, np.ndarray]:
        w = self.weights
        patches, top, pooled, hidden, logit = self._forward(x)
        d_logit = ((1 / (1 + np.exp(-logit)) - y) / len(y))[:, None].astype(np.float32)
        if weight is not None:
            d_logit *= weight[:, None].astype(np.float32)
        d_hidden = (d_logit @ w["out"].T) * (hidden > 0)
        d_pooled = (d_hidden @ w["hidden"].T) * (pooled > 0)
        rows = np.arange(len(x))[:, None]
        chosen = patches[rows, top]  # (rows, filters, width * embed)
        d_patch = d_pooled[:, :, None] * w["conv"].T[None]
        d_embed = np.zeros_like(w["embed"])
        places = top[:, :, None] + np.arange(self.WIDTH)
        np.add.at(
            d_embed,
            x[rows[:, :, None], places].reshape(-1),
            d_patch.reshape(len(x), self.FILTERS, self.WIDTH, self.EMBED).reshape(-1, self.EMBED),
        )
        return {
            "embed": d_embed,
            "conv": np.einsum("nf,nfp->pf", d_pooled, chosen),
            "conv_bias": d_pooled.sum(0),
            "hidden": pooled.T @ d_hidden,
            "hidden_bias": d_hidden.sum(0),
            "out": hidden.T @ d_logit,
            "out_bias": d_logit.sum(0),
        }

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.empty(0, np.float32), *(self._forward(x[at : at + 512])[4] for at in range(0, len(x), 512))])

    def _highest(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of examples of ``counts`` windows each, the window with the largest logit."""
        begin = np.cumsum(counts) - counts
        chosen = begin.copy()
        several = np.flatnonzero(counts > 1)
        if len(several):
            logit = self._logits(x[np.repeat(counts > 1, counts)])
            at = np.cumsum(counts[several]) - counts[several]
            for i, a in zip(several, at, strict=True):
                chosen[i] += logit[a : a + counts[i]].argmax()
        return chosen

    def moments(self) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
        """Adam's running means before the first step."""
        return tuple({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2))

    def one_pass(
        self, x: np.ndarray, y: np.ndarray, counts: np.ndarray, rng: np.random.Generator, moments: tuple, step: int,
        weight: np.ndarray | None = None, batch: int = 128, rate: float = 0.01,
    ) -> int:
        """Adam over shuffled batches; of an example of several windows, the one that scores highest so far."""
        first, second = moments
        chosen = self._highest(x, counts)
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            some = order[at : at + batch]
            step += 1
            for k, g in self._gradients(x[chosen[some]], y[some], None if weight is None else weight[some]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rise = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                self.weights[k] -= (rate * rise).astype(np.float32)
        return step

    def fit(
        self, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, batch: int = 128, rate: float = 0.01, counts: np.ndarray | None = None
    ) -> None:
        """Some passes over the examples."""
        counts = np.ones(len(y), np.int64) if counts is None else counts
        moments, step = self.moments(), 0
        for _ in range(rounds):
            step = self.one_pass(x, y, counts, self.rng, moments, step, batch=batch, rate=rate)

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float = RECALL, counts: np.ndarray | None = None) -> None:
        """Scale the logits on unseen findings; the threshold is the largest that keeps ``recall``."""
        counts = np.ones(len(y), np.int64) if counts is None else counts
        logit = _most(self._logits(x), counts).astype(np.float64)
        self._scale(logit, np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)))
        positive = np.sort(self.score(x[np.repeat(y > 0, counts)], counts[y > 0]))
        if len(positive):
            self.threshold = float(positive[int((1 - recall) * len(positive))])

    def _scale(self, logit: np.ndarray, target: np.ndarray, mean=np.mean) -> None:
        """Slope and shift by which the logits come near the targets."""
        slope, shift = 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(slope * logit + shift, -30, 30)))
            slope -= 0.1 * float(mean((p - target) * logit)) / (1 + float(mean(logit**2)))
            shift -= 0.1 * float(mean(p - target))
        self.slope, self.shift = max(slope, 1e-3), shift

    def _scores(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit.astype(np.float64) + self.shift, -30, 30)))

    def score(self, x: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
        """Score of each window, or of each example of ``counts`` windows: that of its highest."""
        if not len(x):
            return np.empty(0)
        logit = self._logits(x)
        if counts is not None:
            logit = _most(logit, counts)
        return self._scores(logit)


def _most(logit: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.maximum.reduceat(logit, np.cumsum(counts) - counts)


def _stacked(points: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all candidates end to end, and how many each has."""
    cut = [windows(p) for p in points]
    return np.concatenate(cut), np.fromiter(map(len, cut), np.int64, len(cut))


def examples(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(secret, points) of every labelled candidate: what the network would read, and its label.

    Matches of the patterns are secrets. Long tokens elsewhere, and stretches of plain text beside the
    matches, are not. Of an assignment the value alone is the candidate.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        plain = re.compile(r"\S{4,}")
        for batch in small_batches(batches):
            secret, points = [], []
            for text in texts_of(batch.column(0)):
                base, others = finder.find(text)
                starts = [start for start, _, _ in base]
                reach = list(accumulate((end for _, _, end in base), max, initial=0))
                for i, (start, kind, end) in enumerate(base):
                    if kind == 0:
                        start = finder.patterns[0][1].match(text, start).start(2)
                    points.append(codes(text, start, end, blank=(start + i) % 2 == 0).tobytes())
                    secret.append(1)
                    following = plain.search(text, end + 1)
                    if following:
                        others.append(following.span())
                for i, (start, end) in enumerate(others):
                    if reach[bisect_left(starts, end)] <= start:  # no finding that begins before its end reaches into it
                        points.append(codes(text, start, end, blank=(start + i) % 4 == 0).tobytes())
                        secret.append(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(secret, pa.int32()), pa.array(points, pa.binary())], ["secret", "points"]
            )

    return df.select(text_col).mapInArrow(run, "secret int, points binary")


def _sample(df: DataFrame, text_col: str, sample: int) -> list:
    """(secret, points) of at most ``sample`` distinct examples: half of each label, or what the other leaves."""
    return _first(stage(examples(df, text_col).distinct(), "examples"), sample)


def _first(found: DataFrame, sample: int) -> list:
    sides = [
        found.where(F.col("secret") == label).orderBy(F.xxhash64("points"), "points").limit(sample).collect()
        for label in (0, 1)
    ]
    most = [max(sample // 2, sample - len(other)) for other in reversed(sides)]
    return [r for rows, n in zip(sides, most, strict=True) for r in rows[:n]]


def _held(rows: list) -> np.ndarray:
    """Whether an example is kept from the fit: every fourth value of each label, with all its examples."""
    side: dict[bytes, bool] = {}
    values = [0, 0]
    for r in rows:
        value = bytes(r["points"][CONTEXT:-CONTEXT])
        if value not in side:
            side[value] = values[r["secret"]] % 4 == 3
            values[r["secret"]] += 1
    return np.array([side[bytes(r["points"][CONTEXT:-CONTEXT])] for r in rows])


def train(df: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Network | None:
    """A network fitted on all distinct examples, more than ``sample`` of them in shards; None without both labels."""
    found = stage(examples(df, text_col).distinct(), "examples")
    sizes = {r["secret"]: r["n"] for r in found.groupBy("secret").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    if sum(sizes.values()) > sample:
        return _train_in_shards(found, sample)
    rows = _first(found, sample)
    labels = np.array([r["secret"] for r in rows], np.float32)
    points = [np.frombuffer(r["points"], np.uint8) for r in rows]
    held = _held(rows)

    def part(some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, counts = _stacked([points[i] for i in np.flatnonzero(some)])
        return x, labels[some], counts

    network = Network()
    x, y, counts = part(~held)
    network.fit(x, y, counts=counts)
    x, y, counts = part(held if len(set(labels[held])) == 2 else ~held)
    network.calibrate(x, y, counts=counts)
    return network


def _label_weights(rows: DataFrame) -> dict[int, float]:
    """What an example of each label counts, so that both labels count alike."""
    sizes = {r["secret"]: r["n"] for r in rows.groupBy("secret").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {label: sum(sizes.values()) / (len(sizes) * n) for label, n in sizes.items()}


def _train_in_shards(found: DataFrame, shard_size: int) -> Network:
    """A network fitted on all of ``found`` (secret, points), which hold both labels.

    Every fourth value by hash is held back with all its examples, if they and the rest hold both labels.
    """
    value = F.expr(f"substring(points, {CONTEXT + 1}, length(points) - {2 * CONTEXT})")
    rows = found.withColumn("held", F.pmod(F.xxhash64(F.lit("held"), value), F.lit(4)) == 3)
    fitted, held = rows.where("NOT held"), rows.where("held")
    if len(_label_weights(fitted)) < 2:
        fitted = held = found
    elif len(_label_weights(held)) < 2:
        held = fitted
    network = Network()
    _fit_in_shards(network, fitted, shard_size)
    _calibrate_on_all(network, held)
    return network


_STATE = "shard long, place long, n long, step long, state binary"


def _state(network: Network, moments: tuple) -> np.ndarray:
    return np.concatenate([d[k].ravel() for d in (network.weights, *moments) for k in network.weights]).astype(np.float64)


def _restore(network: Network, moments: tuple, state: np.ndarray) -> None:
    at = 0
    for d in (network.weights, *moments):
        for k, shape in [(k, v.shape) for k, v in network.weights.items()]:
            size = int(np.prod(shape))
            d[k] = state[at : at + size].reshape(shape).astype(np.float32)
            at += size


def _merged(table: pa.Table) -> pa.Table:
    """One row for the states of a group: their mean by number of examples, summed in the order of places."""
    rows = sorted(table.to_pylist(), key=lambda r: r["place"])
    n = sum(r["n"] for r in rows)
    state = sum(np.frombuffer(r["state"]) * (r["n"] / n) for r in rows)
    one = {"shard": rows[0]["shard"], "place": rows[0]["shard"], "n": n, "step": max(r["step"] for r in rows), "state": state.tobytes()}
    return pa.Table.from_pylist([one], table.schema)


def _fit_in_shards(network: Network, rows: DataFrame, shard_size: int) -> None:
    """Rounds of a pass in each shard, every one from the mean of all shards' weights and running means."""
    spark, weights = rows.sparkSession, _label_weights(rows)
    shards = -(-rows.count() // shard_size)
    dealt = rows.select("secret", "points", F.pmod(F.xxhash64(F.lit("shard"), "points"), F.lit(shards)).alias("shard"))
    moments, step = network.moments(), 0
    names = [field.split()[0] for field in _STATE.split(", ")]

    def pass_of(number: int, shared: Broadcast):
        def one(table: pa.Table) -> pa.Table:
            own, means, taken = pickle.loads(pickle.dumps(shared.value))  # a worker's next shard starts from the same
            shard = table["shard"][0].as_py()
            rows_of = sorted(zip(table["secret"].to_pylist(), table["points"].to_pylist(), strict=True))
            y = np.array([secret for secret, _ in rows_of], np.float32)
            x, counts = _stacked([np.frombuffer(points, np.uint8) for _, points in rows_of])
            weight = np.array([weights[secret] for secret, _ in rows_of])
            taken = own.one_pass(x, y, counts, np.random.default_rng([number, shard]), means, taken, weight)
            row = (shard, shard, len(y), taken, _state(own, means).tobytes())
            kinds = [pa.int64()] * 4 + [pa.binary()]
            return pa.Table.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds, strict=True)], names)

        return one

    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast((network, moments, step))
        states, left = dealt.groupBy("shard").applyInArrow(pass_of(number, shared), _STATE), shards
        while left > MERGED:
            states = states.withColumn("shard", F.expr(f"shard div {MERGED}")).groupBy("shard").applyInArrow(_merged, _STATE)
            left = -(-left // MERGED)
        row = _merged(states.toArrow()).to_pylist()[0]
        _restore(network, moments, np.frombuffer(row["state"]))
        step = row["step"]
        shared.unpersist()


#: Steps of a logit in which the examples are counted for the scale of the score, and the largest that is told apart.
_FINE, _FAR = 256, 128


def _calibrate_on_all(network: Network, rows: DataFrame, recall: float = RECALL) -> None:
    """Scale and threshold from every row (secret, points): counts by logit, and the exact place of the threshold."""
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            if not batch.num_rows:
                continue
            x, counts = _stacked([np.frombuffer(p, np.uint8) for p in batch.column(1).to_pylist()])
            logit = _most(shared.value._logits(x), counts)
            bits = logit.view(np.uint32).astype(np.int64)
            order = np.where(bits >> 31, 0xFFFFFFFF - bits, bits + (1 << 31))  # ascends with the logit
            cell = np.round(np.clip(logit.astype(np.float64), -_FAR, _FAR) * _FINE).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell), pa.array(order)], ["secret", "cell", "order"])

    scored = stage(rows.select("secret", "points").mapInArrow(logits, "secret int, cell long, order long"), "logits")

    def counted(some: DataFrame, *by) -> list:
        return some.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(*by).collect()

    cells = counted(scored, "secret", "cell")  # at most 2 * _FAR * _FINE + 1 of a label
    label, cell, n = (np.array(c) for c in zip(*cells, strict=True))
    positives, others = (int(n[label == k].sum()) for k in (1, 0))
    target = np.where(label > 0, (positives + 1) / (positives + 2), 1 / (others + 2))
    share = n / np.where(label > 0, max(positives, 1), max(others, 1))
    network._scale(cell / _FINE, target, mean=lambda v: np.average(v, weights=share))
    wanted, secret = int((1 - recall) * positives), scored.where("secret = 1")
    place = F.col("order")
    for shift in (16, 0):  # leading bits of the wanted one, then all of them: at most 65,536 numbers each
        for r in counted(secret, F.shiftright(place, shift).alias("at")):
            if wanted < r["n"]:
                break
            wanted -= r["n"]
        secret = secret.where(F.shiftright(place, shift) == r["at"])
    bits = r["at"] - (1 << 31) if r["at"] >> 31 else 0xFFFFFFFF - r["at"]
    network.threshold = float(network._scores(np.array([bits], np.uint32).view(np.float32))[0])


def find_secrets(
    df: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, base, spans) of every row: findings as (kind, start, end, score), by start and then kind.

    ``base`` holds those of the patterns, ``spans`` the network's as well; offsets count code points.
    """
    shared = df.sparkSession.sparkContext.broadcast(network)
    kind = df.schema[id_col].dataType.simpleString()
    span = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in small_batches(batches):
            texts = texts_of(batch.column(1))
            spans, points = [], []
            for i, text in enumerate(texts):
                base, others = finder.find(text)
                for start, number, end in base:
                    spans.append((i, start, number, end))
                    points.append(codes(text, start, end))
                for start, end in others:
                    spans.append((i, start, len(PATTERNS), end))
                    points.append(codes(text, start, end))
            model = shared.value
            scores = model.score(*_stacked(points)) if model is not None and points else [0.0] * len(points)
            base_out, all_out = [[] for _ in texts], [[] for _ in texts]
            for (i, start, number, end), score in sorted(zip(spans, scores, strict=True), key=lambda s: s[0]):
                one = {"kind": KINDS[number], "start": start, "end": end, "score": float(score)}
                if number < len(PATTERNS):
                    base_out[i].append(one)
                    all_out[i].append(one)
                elif model is not None and score >= model.threshold:
                    all_out[i].append(one)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base_out, span), pa.array(all_out, span)], [id_col, "base", "spans"]
            )

    found = "array<struct<kind:string,start:long,end:long,score:double>>"
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, base {found}, spans {found}")


def mask(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans_col: str = "spans", mark: str = "<secret>"
) -> DataFrame:
    """(id, masked) of every row: the text with each stretch of spans, overlapping ones as one, replaced."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                parts, at = [], 0
                for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                    if start >= at:
                        parts += [text[at:start], mark]
                    at = max(at, end)
                out.append("".join([*parts, text[at:]]) if parts else text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [id_col, "masked"])

    return df.select(id_col, text_col, spans_col).mapInArrow(run, f"`{id_col}` {kind}, masked string")
