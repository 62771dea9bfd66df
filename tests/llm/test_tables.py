"""Operators on other tables against plain Python, and the toxicity network."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import chat, hamming, hnsw, mixing, toxicity
from riskloom.llm.graph import components

SF = "/root/testdata/sf0.001"
driver_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def vectors(spark, n=700, dim=20, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, rng.choice([0.5, 1, 2]), dim).tolist(), "x") for i in range(n)]
    rows += [(n + i, rows[3][1], "x") for i in range(60)]  # a hot vector
    rows += [(5000, None, "x"), (5001, [0.0] * dim, "x"), (5002, [float("nan")] * dim, "x"), (None, rows[0][1], "x")]
    rows += [(5003, [None] * dim, "x"), (5020, [1.0, 2.0], "x"), (5040, [], "x"), (10, rows[10][1], "x")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"), rows


def test_hnsw(spark):
    df, rows = vectors(spark)
    got = defaultdict(list)
    for r in hnsw.nearest(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding", 20).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = {i: np.array(v) for i, v, _ in rows if i is not None and v and len(v) == 20 and None not in v and i < 5000}
    hit = total = 0
    for q in [i for i in good if i % 20 == 0]:
        scores = sorted(((-float(v @ good[q]), i) for i, v in good.items() if i != q))
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        assert all(s == pytest.approx(float(good[i] @ good[q])) for _, i, s in mine)
        hit += len({m[1] for m in mine} & {i for _, i in scores[:20]})
        total += 20
    assert hit / total >= 0.9
    assert 5020 not in got  # alone with its length
    assert {5000, 5001, 5040}.isdisjoint(got)


def test_hnsw_of_outlying_norms(spark):
    """Gaussian vectors, a few thousand times as long, very large and very small ones."""
    rng = np.random.default_rng(4)
    plain = rng.normal(0, 1, (1500, 64))
    plain[7] *= 3000
    plain[11] = 0
    plain[11, 5] = 1e200
    plain[13] = plain[12] * 1e-200
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(plain)], "vec_id long, embedding array<double>")
    got = defaultdict(dict)
    for r in hnsw.nearest(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding", 20).collect():
        got[r.query_id][r["rank"]] = r.vec_id
    hit = 0
    for q in range(0, 1500, 20):
        scores = plain @ plain[q]
        want = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:20]
        assert len(got[q]) == 20
        hit += len(set(got[q].values()) & set(want))
    assert hit / (75 * 20) >= 0.9


def test_hnsw_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    got = hnsw.nearest(df, df.where("vec_id = 0"), "vec_id", "embedding", 20).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 0.5)]
    assert hnsw.nearest(df.limit(0), df.limit(0), "vec_id", "embedding", 20).collect() == []


def test_hamming(spark):
    df, rows = vectors(spark, dim=20)
    codes = hamming.sign_codes(df, "vec_id", "embedding")
    got = {tuple(r) for r in hamming.nearest_codes(codes, codes.where("id % 50 = 0"), 10).collect()}
    good = {}
    for i, v, _ in rows:
        if i is not None and v and None not in v and not np.isnan(v).any():
            good[i] = np.array(v) > 0
    want = set()
    for q in [i for i in good if i % 50 == 0]:
        near = sorted((int((good[i] != good[q]).sum()), i) for i in good if i != q and len(good[i]) == len(good[q]))
        want |= {(q, n + 1, i, d) for n, (d, i) in enumerate(near[:10])}
    assert got == want


def test_hamming_of_nothing(spark):
    codes = hamming.sign_codes(vectors(spark)[0].limit(0), "vec_id", "embedding")
    assert hamming.nearest_codes(codes, codes, 10).collect() == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    group = {}
    for e in edges:
        for x in e:
            group.setdefault(x, x)
    for a, b in edges:
        old, new = max(group[a], group[b]), min(group[a], group[b])
        group = {k: new if v == old else v for k, v in group.items()}
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in group.items() if k not in loops}


def water_filled(sizes, percent=150, most=2):
    sources = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(sources)}
    target, left, open_ = dict.fromkeys(sources, 0.0), sum(sizes.values()) * percent / 100, set(sources)
    while left > 1e-6 and open_:
        share, left = left / sum(weight[s] for s in open_), 0
        for s in list(open_):
            target[s] += share * weight[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.remove(s)
    return target


def test_mixing(docs_of):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 7, 50, 400])), rng.choice(["a", "b", "é", "z", None, "hot", "hot"])) for i in range(500)]
    rows += [(i, "same words here", "hot") for i in range(1000, 1300)]
    rows += [(2000, None, "a"), (2001, " \n", "b"), (None, "x y", "a"), (3000, "x y", "a"), (3000, "x y", "a"), (2002, None, "empty")]
    got = mixing.mix(docs_of(rows)).collect()
    again = mixing.mix(docs_of(rows[::-1])).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    sizes, source_of = defaultdict(int), {}
    for i, text, source in rows:
        sizes[source] += len((text or "").split())
        source_of[i] = source
    target = water_filled(sizes)
    taken = defaultdict(int)
    for r in got:
        source = source_of[r.doc_id]
        assert (r.source_size, r.target) == (sizes[source], pytest.approx(target[source]))
        assert 0 <= r.times <= 2
        taken[source] += r.times * r.size
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)


def test_fit_counts_is_exact_where_sums_allow():
    rng = np.random.default_rng(4)
    for _ in range(30):
        size = np.unique(rng.integers(1, 3000, 12))
        count = rng.integers(1, 6, len(size))
        budget = int(rng.integers(0, (size * count).sum() + 1))
        take = mixing.fit_counts(size, count, budget)
        assert (take >= 0).all() and (take <= count).all()
        assert (take * size).sum() <= budget
    ones = mixing.fit_counts(np.array([1, 90_000]), np.array([200_000, 5]), 300_123)
    assert int(ones @ np.array([1, 90_000])) == 300_123


def test_mixing_of_nothing(docs_of):
    assert mixing.mix(docs_of([])).collect() == []


def test_chat_fold(spark):
    events = [
        (1, 0, 0, 1, "open", "user"), (1, 1, 0, 1, "delta", "dra"), (1, 2, 0, 1, "edit", "new"), (1, 3, 0, 1, "delta", " text"),
        (1, 4, 1, 1, "open", "assistant"), (1, 5, 1, 1, "delta", "bad"), (1, 6, 1, 1, "regenerate", None),
        (1, 7, 1, 1, "delta", "good"), (1, 8, 1, 1, "delta", None), (2, 0, 0, 1, "delta", "no role"),
        (None, 0, None, 1, "open", None), (None, 1, None, 1, "delta", "x"),
    ]
    random.Random(0).shuffle(events)
    log = spark.createDataFrame(events, "conv_id long, seq long, message long, part int, kind string, text string")
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold(log).collect()}
    assert got == {(1, 0): ("user", "new text"), (1, 1): ("assistant", "good"), (2, 0): ("", "no role"), (None, None): ("", "x")}


def test_chat_round_trip(spark):
    rng = random.Random(8)
    bits = ["<|", "|>", "\\", "<\\|", "<|end|>", "<|turn|>", "</s>", "\n", "é🙂", "a b", ""]
    rows = [
        (rng.randrange(8), rng.randrange(6), rng.choice(["user", "assistant", "system", "<|x\\", None]), "".join(rng.choices(bits, k=6)), "x")
        for _ in range(120)
    ] + [(50, 0, "assistant", None, "x"), (50, None, "assistant", "late", "x"), (None, 0, "user", "w" * 30_000, "x"), (51, 0, "user", "s", "x"), (51, 0, "user", "s", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, message string")
    rendered = chat.render(chat.fold(chat.log_of(table)))
    marks = {r.conv_id: r.formatted.count(chat.TURN) for r in rendered.collect()}
    want = defaultdict(list)
    for c, t, role, text, _ in rows:
        want[c].append(((t is None, t or 0), role or "", text or ""))
    got = chat.read_back(rendered).collect()
    assert len(got) == len(want)
    for r in got:
        mine = [(t.role, t.text) for t in r.turns]
        theirs = [(a, b) for _, a, b in sorted(want[r.conv_id], key=lambda x: (x[0], x[1], x[2]))]
        assert mine == theirs and marks[r.conv_id] == len(theirs)
        assert list(r.loss_texts) == [b for a, b in theirs if a == "assistant"]


def test_chat_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.render(chat.fold(chat.log_of(empty)))).collect() == []


def test_toxicity_gradients(monkeypatch):
    monkeypatch.setattr(toxicity, "WINDOW", 4)
    net = toxicity.Network(1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    inputs = toxicity.Inputs([b"alpha", b"beta", b"g", b"delta"])
    places, y = np.array([[0, 1, 2, -1], [3, 3, 0, 1], [2, -1, -1, -1]]), np.array([1.0, 0, 1])

    def loss():
        p = 1 / (1 + np.exp(-net.logits(places, inputs.vectors(net.weights).astype(np.float64))))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, gradient in net.gradients(places, inputs, y).items():
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        net.weights[name][at] += 1e-3
        up = loss()
        net.weights[name][at] -= 2e-3
        down = loss()
        net.weights[name][at] += 1e-3
        assert gradient[at] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=1e-4)


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 72, 73, 500):
        spans = toxicity.windows(n)
        assert {i for a, b in spans for i in range(a, b)} == set(range(n))
        assert all(b - a <= toxicity.WINDOW for a, b in spans)


def test_toxicity_learns(spark, docs_of):
    rng = random.Random(9)
    plain = ["river", "stone", "walks", "under", "green", "light", "seven", "boats"]
    rows, marks = [], []
    for i in range(360):
        words = rng.choices(plain, k=rng.choice([5, 60, 300]))
        toxic = i % 3 == 0
        if toxic:
            for _ in range(1 + len(words) // 60):
                words[rng.randrange(len(words))] = rng.choice(["vileword", "vilething", "Vilest!"])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    docs = docs_of([*rows, (900, None), (901, ""), (None, "river"), (902, "boats " * 20_000)])
    labels = spark.createDataFrame([*marks, (None, 1, 1), (5000, 0, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    network = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, network).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()}
    assert len(got) == 364 and all(0 <= r.score <= 1 for r in got.values())
    held = [i for i, _, t in marks if got[i].held]
    assert len(held) > 80
    assert np.mean([got[i].predicted == (i % 3 == 0) for i in held]) > 0.95
    assert got[900].score == got[901].score and got[902].predicted == 0


def test_toxicity_learns_from_every_window(spark, docs_of):
    rng = random.Random(12)
    plain = ["river", "stone", "walks", "under", "green", "light", "seven", "boats"]
    rows, marks = [], []
    for i in range(240):
        words = rng.choices(plain, k=3_000)  # 124 windows
        if i % 3 == 0:
            at = 96 * rng.randrange(5, 25)  # between the windows that a choice of every fourth would keep
            words[at + 50 : at + 94 : 6] = [rng.choice(["vileword", "vilething", "Vilest!"]) for _ in range(8)]
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(i % 3 == 0)))
    docs = docs_of(rows)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    texts = Counter(" ".join(b" ".join(w[:24]).decode() for w in cut[:-1]) for _, _, cut in toxicity._sample(docs, labels, "doc_id", "text", 300))
    held = {r.doc_id for r in docs.where(toxicity.held_out(F.col("doc_id"))).select("doc_id").collect()}
    full = [toxicity.words_of(t) for i, t in rows if i not in held]
    assert texts == Counter(b" ".join(w[: 123 * 24]).decode() for w in full)
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    right = [r.predicted == (r.doc_id % 3 == 0) for r in got if r.doc_id in held]
    assert len(right) > 50 and np.mean(right) > 0.95


def test_toxicity_without_labels(spark, docs_of):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of([(1, "a"), (2, None)])
    assert toxicity.train(docs, labels) is None
    assert [r.score for r in toxicity.score(docs, None).collect()] == [0.0, 0.0]
    assert toxicity.score(docs.limit(0), None).collect() == []


@driver_tables
def test_hamming_equals_sql(spark):
    from compare import rows_of

    from riskloom.llm.queries import QUERIES, SQL

    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want, got = con.execute(SQL["op4_hamming"]), QUERIES["op4_hamming"](spark, SF)
    columns = [d[0] for d in want.description]
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want.fetchall())


@driver_tables
def test_pipeline(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    kept = pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == pipeline.COLUMNS and 0.8 * before < kept.count() <= before
    out = pipeline.run(spark, SF)
    assert out.count() > 0 and out.where("NOT round_trip").isEmpty()


def test_near_copies_are_decided_by_row(spark, docs_of):
    import corpus_pipeline as pipeline

    rng = random.Random(11)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60))

    def near(t):
        return " ".join([*t.split()[:-1], "changed"])

    a, b, c, d, e, f, g = (text() for _ in range(7))
    rows = [(None, a), (None, b), (None, near(b)), (None, c), (None, c)]  # clean texts without an id
    rows += [(7, d), (7, e), (7, e)]  # unrelated texts under one id
    rows += [(8, f), (9, near(f)), (9, g), (None, near(f))]  # a near copy beside another row of its id
    rows += [(None, None), (None, ""), (7, " ")]
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    group = list(range(len(rows)))
    for i, one in enumerate(sets):
        for j in range(i):
            if one and 100 * len(one & sets[j]) >= 75 * len(one | sets[j]):
                group = [group[j] if x == group[i] else x for x in group]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    best = {}
    for n, row, one in zip(group, rows, sets, strict=True):
        if one:
            best[n] = min(best.get(n, row), row, key=order)
    want = [*best.values(), *(r for r, one in zip(rows, sets, strict=True) if not one)]
    assert len(best) == 7
    got = pipeline.drop_near_copies(spark, docs_of(rows).select(*pipeline.COLUMNS), SF)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want)
