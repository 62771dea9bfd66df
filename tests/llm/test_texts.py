"""Operators on texts against plain Python, on messy rows: nulls, empty, long, repeated, clashing names."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm import byte_bpe, common, graph, jaccard, licenses, repeats, secrets
from riskloom.llm.common import lists

WORDS = "the of a red fox Runs over lazy DOG and then sleeps in old barn near river Été über naïve".split()


def messy(seed=0, n=60):
    rng = random.Random(seed)
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two"), (None, "null id " * 3), (4, "one")]
    passage = " ".join(rng.choices(WORDS, k=80))
    for i in range(10, 10 + n):
        words = rng.choices(WORDS, k=rng.choice([3, 20, 60, 150]))
        kind = i % 5
        if kind == 0:
            words[1:1] = passage.split()
        if kind == 1 and len(rows) > 9 and rows[-1][1]:
            words = rows[-1][1].split()
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(200, rows[-3][1]), (201, rows[-3][1]), (201, rows[-3][1])]
    rows.append((300, " ".join(rng.choices(WORDS, k=30_000))))
    rows.append((301, "x" * 50_000))
    return rows


def test_repeats(docs_of):
    rows = messy()
    length = 12
    seen = Counter()
    for _, text in rows:
        w = (text or "").split()
        seen.update(tuple(w[p : p + length]) for p in range(len(w) - length + 1))
    want = []
    for i, text in rows:
        w = (text or "").split()
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if seen[tuple(w[p : p + length])] > 1:
                gone[p : p + length] = [True] * length
        want.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    got = repeats.remove_repeats(docs_of(rows), length=length, seed=5).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=key) == sorted(want, key=key)
    for r in got:  # maximal repeats neither touch nor overlap, and make up what was removed
        assert sum(s.end - s.start for s in r.repeats) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.repeats, r.repeats[1:], strict=False))
    assert sum(r.n_removed for r in got) > 500


def test_repeats_of_nothing(docs_of):
    assert repeats.remove_repeats(docs_of([])).collect() == []


@pytest.mark.parametrize(("seed", "large", "block"), [(0, 16, 4096), (1, 16, 4096), (0, 1, 4), (1, 2, 3)])
def test_jaccard(docs_of, monkeypatch, seed, large, block):
    monkeypatch.setattr(jaccard, "LARGE", large)  # so that groups of the fixture are cut into blocks, too
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "DENSE", 4 if large == 16 else 0)
    rows = messy(seed)
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for g, (i, _), s in zip(group, rows, sets, strict=True):
        if s and i is not None:
            least[g].append(i)
    want = [
        (i, len(s), (min(least[g]) if least[g] else None) if s else i)
        for g, (i, _), s in zip(group, rows, sets, strict=True)
    ]
    got = [tuple(r) for r in jaccard.similar_components(docs_of(rows)).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_jaccard_dense_and_small_groups_in_one_task(spark):
    """A small group gives pairs, a dense one its members, and their sets a forest of links."""
    shingles = np.arange(40, dtype=np.uint64) * np.uint64(1 << 58)
    sets = {k: np.sort(np.append(shingles, np.uint64(k + 1))) for k in range(60)}
    rows = [(1 if k < 2 else 2 if k < 58 else 3, 1, k, k, 41, jaccard.sketch(s).tolist()) for k, s in sets.items()]
    schema = "group long, blocks int, node long, component long, n long, sketch array<long>"
    met = jaccard._promising(spark.createDataFrame(rows, schema).coalesce(1), "all", 75)
    got = met.collect()
    assert {(r.a, r.b) for r in got if r.group is None} == {(0, 1), (58, 59)}
    assert {r.node for r in got if r.group is not None} == set(range(2, 58))
    kept = [(k, s.view(np.int64).tolist(), jaccard.sketch(s, jaccard.WIDE).tolist()) for k, s in sets.items()]
    whole = spark.createDataFrame(kept, "node long, shingles array<long>, sketch array<long>")
    links = jaccard._forest(met.where("group IS NOT NULL").select(*jaccard._MEMBER), whole, 75).collect()
    assert len(links) == 55
    assert {x for r in links for x in r} == set(range(2, 58))


def test_jaccard_signing_again(docs_of, monkeypatch):
    """The same with groups that sign again, some compared together and some alone."""
    monkeypatch.setattr(jaccard, "RESIGN", 1)
    monkeypatch.setattr(jaccard, "MIDDLE", 3)
    test_jaccard(docs_of, monkeypatch, 2, 2, 3)


def test_only_members_with_partners_meet_again(spark):
    """The first pass names each member of a group that has a partner there, and no others."""
    rng = np.random.default_rng(6)
    shingles = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    sets = {k: shingles if k < 25 else rng.integers(0, 1 << 63, 40, dtype=np.uint64) for k in range(60)}
    sets = {k: np.sort(np.append(s, np.uint64(k + 1))) for k, s in sets.items()}
    rows = [(g, 1, k, k, 41, jaccard.sketch(s).tolist()) for k, s in sets.items() for g in (1, 2) if g == 1 or k >= 24]
    schema = "group long, blocks int, node long, component long, n long, sketch array<long>"
    got = jaccard._promising(spark.createDataFrame(rows, schema).coalesce(1), "closest", 75).collect()
    assert sorted((r.group, r.node) for r in got) == [(1, k) for k in range(25)]
    assert all(r.partner < 25 and r.partner != r.node for r in got)


def test_pairs_of_runs():
    """Runs of one block and of two give just the pairs that sizes and sketches allow."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    rows = []
    for run in range(12):
        for _ in range(int(rng.integers(1, 40))):
            some = np.unique(base[: int(rng.integers(20, 60))])
            rows.append((run, int(rng.integers(0, 1 + run % 2)), len(some), int(rng.integers(0, 9)), some))
    rows.sort(key=lambda r: r[:3])
    run, side, n, component = (np.array(c) for c in list(zip(*rows, strict=True))[:4])
    sketches = jaccard.Sketches(lists([jaccard.sketch(r[4]) for r in rows]))
    begin = np.flatnonzero(np.concatenate([[True], np.diff(run) != 0]))
    i, j, _ = jaccard._pairs_of_runs(sketches, begin, side, n, component, 75)
    want = set()
    for k in range(len(rows)):
        for m in range(k + 1, len(rows)):
            met = run[k] == run[m] and (side[k] != side[m] or len(set(side[run == run[k]])) == 1)
            fits = 75 * max(n[k], n[m]) <= 100 * min(n[k], n[m]) and component[k] != component[m]
            if met and fits and int(sketches.between(np.array([k]), np.array([m]))[0]) * 175 <= (n[k] + n[m]) * 25:
                want.add((k, m))
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(want)
    assert len(want) > 500


def test_large_sets_sign_a_quarter():
    """One band and n(1 - t) + 1 parts, whatever the size; that decides what is shuffled."""
    for n in (16, 50, 60, 200, 900):
        signs, ordered, besides = jaccard.signatures(np.sort(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)), 75)
        assert sum(len(p[:signs]) for p in ordered) + len(besides) == n // 4 + 1


def test_memory_is_given_back_after_the_last_batch(monkeypatch):
    """An idle worker must not hold what it needed, as others run beside it."""
    given, batch = [], pa.record_batch([pa.array([1, 2, 3])], ["n"])
    for module in (common, jaccard):
        monkeypatch.setattr(module, "trim_memory", lambda: given.append(1))
    assert sum(b.num_rows for b in common.small_batches(iter([batch, batch]))) == 6
    assert given == [1]
    keyed = pa.record_batch([pa.array([1, 1, 2])] * 3, ["group", "x", "y"])
    assert sum(t.num_rows for t, _ in jaccard._runs(iter([keyed]))) == 3
    assert given == [1, 1]


def test_rounds_over_few_edges_stay_in_few_tasks(spark, monkeypatch):
    """Components of few edges need no shuffle after the first pass, whatever the number of partitions."""
    files = []
    kept = graph.stage

    def staged(df, name):
        out = kept(df, name)
        files.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(graph, "stage", staged)
    settings = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = graph.components(spark.createDataFrame([(i, i + 1) for i in range(300) if i % 100 != 99], "a long, b long")).collect()
        many, files[:] = list(files), []
        monkeypatch.setattr(graph, "EDGES", 50)  # several tasks
        again = graph.components(spark.createDataFrame([(i, i + 1) for i in range(300) if i % 100 != 99], "a long, b long")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) == [(i, i // 100 * 100) for i in range(300)]
    assert all(n == 1 for _, n in many[1:])
    assert all(n <= 297 // 50 + 1 for _, n in files[1:])


def test_signatures_are_short_and_groups_of_one_anchor_lie_together(spark, docs_of):
    """Signatures leave two bytes empty; groups with the same least member go to the same task."""
    nodes = jaccard._nodes(docs_of(messy()).select(F.col("doc_id").alias("id"), "text"), 5, 75).collect()
    signed = [s for r in nodes for s in r.signatures]
    assert signed and all(0 <= s < 1 << 48 for s in signed)
    rows = [(g, 1, 7, k, k, 41, [k]) for g in range(40) for k in range(3)]
    schema = "group long, blocks int, anchor long, node long, component long, n long, sketch array<long>"
    dealt = jaccard._blocks(spark.createDataFrame(rows, schema))
    assert dealt.columns == ["group", "x", "y", "block", "node", "component", "n", "sketch"]
    assert dealt.select(F.spark_partition_id()).distinct().count() == 1
    assert dealt.count() == len(rows)


def test_jaccard_of_nothing(docs_of):
    assert jaccard.similar_components(docs_of([])).collect() == []
    assert [tuple(r) for r in jaccard.similar_components(docs_of([(1, None)])).collect()] == [(1, 0, 1)]


def test_similar_sets_share_a_signature():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(400):
        n = int(rng.choice([3, 4, 7, 15, 16, 40, 64, 200, 700]))
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        cut = int(rng.integers(0, n // 4 + 1))
        more = int(rng.integers(0, n // 4 + 1))
        other = np.unique(np.concatenate([base[cut:], rng.integers(0, 1 << 63, more, dtype=np.uint64)]))
        base = np.unique(base)
        shared = len(np.intersect1d(base, other))
        if 100 * shared < 75 * (len(base) + len(other) - shared) or len(base) == len(other) == shared:
            continue
        sides = []
        for one in (base, other):
            signs, ordered, besides = jaccard.signatures(one, 75)
            sides.append(set(np.concatenate([*(p[:signs] for p in ordered), besides]).tolist()))
        assert sides[0] & sides[1]


def test_secrets(docs_of):
    rng = random.Random(3)
    hexes = ["".join(rng.choices("0123456789abcdef", k=rng.choice([10, 23, 24, 40]))) for _ in range(60)]
    rows = messy(2) + [
        (1000 + i, f"{' '.join(rng.choices(WORDS, k=9))} {rng.choice(['password', 'API_KEY', 'Token', 'tocken'])} "
         f"{rng.choice([':', '=', '= ', '-'])}\"{h} AKIA{h.upper()} é {rng.choice(WORDS)}")
        for i, h in enumerate(hexes)
    ]
    docs = docs_of(rows)
    network = secrets.train(docs)
    assert network is not None
    got = secrets.find_secrets(docs, network).collect()
    texts = defaultdict(list)
    for i, text in rows:
        texts[i].append(text or "")
    patterns = [(k, re.compile(p, f), g, n) for k, p, f, g, n in secrets.PATTERNS]
    for r in got:
        want = [
            sorted(
                (m.start(), k, m.end())
                for k, (_, p, g, n) in enumerate(patterns)
                for m in p.finditer(t)
                if len(m.group(g)) >= n
            )
            for t in texts[r.doc_id]
        ]
        assert [(s.start, secrets.KINDS.index(s.kind), s.end) for s in r.base] in want
        assert {(s.kind, s.start, s.end) for s in r.base} <= {(s.kind, s.start, s.end) for s in r.spans}
    assert sum(len(r.base) for r in got) > 60
    masked = secrets.mask(secrets.find_secrets(docs.select("doc_id", "text"), network).join(docs.select("doc_id", "text"), "doc_id"))
    assert masked.where(F.col("masked").rlike("[0-9a-f]{24}")).isEmpty()


def test_network_gradients():
    import numpy as np

    net = secrets.Network()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(1, 97, (6, 80)).astype(np.uint8), np.array([0, 1, 1, 0, 1, 0.0])

    def loss():
        p = 1 / (1 + np.exp(-net._forward(x)[4]))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, gradient in net._gradients(x, y).items():
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        net.weights[name][at] += 1e-4
        up = loss()
        net.weights[name][at] -= 2e-4
        down = loss()
        net.weights[name][at] += 1e-4
        assert gradient[at] == pytest.approx((up - down) / 2e-4, rel=0.02, abs=1e-6)


def test_secret_sample_is_of_distinct_examples_of_both_labels(docs_of):
    rng = random.Random(4)
    value = lambda: "".join(rng.choices("0123456789abcdef", k=32))
    token = lambda: "".join(rng.choices("ghijklmnop0123456789", k=20))
    copies = [(i, f"{c} some words") for i in range(200) for c in ("ab12" * 8, "cd34" * 8, "ef56" * 8)]
    rows = copies + [(1000 + i, f"words before {value()} and {token()} after") for i in range(30)]
    got = secrets._sample(docs_of(rows), "text", 40)
    assert len(got) == 40 == len({(r.secret, bytes(r.points)) for r in got})
    assert Counter(r.secret for r in got) == {0: 20, 1: 20}
    sides = defaultdict(set)
    for r, held in zip(got, secrets._held(got), strict=True):
        sides[bytes(r.points[secrets.CONTEXT : -secrets.CONTEXT])].add(bool(held))
    assert all(len(s) == 1 for s in sides.values()) and {True, False} <= set.union(*sides.values())
    assert secrets.train(docs_of(rows), sample=40) is not None
    # every finding is followed by another: none of them is an example of something else
    many = " ".join("".join(rng.choices("0123456789abcdef", k=30)) for _ in range(80))
    assert {r.secret for r in secrets.examples(docs_of([(1, many)])).collect()} == {1}


def test_secret_network_learns_from_all_examples(docs_of, monkeypatch):
    """More examples than a shard holds: the threshold is the exact place among all that were held back."""
    import numpy as np
    from pyspark.sql import functions as F

    rng = random.Random(9)
    value = lambda: "".join(rng.choices("0123456789abcdef", k=32))
    token = lambda: "".join(rng.choices("ghijklmnop0123456789", k=20))
    docs = docs_of([(i, f"words before {value()} and {token()} after") for i in range(400)])
    network = secrets.train(docs, sample=100)
    found = secrets.examples(docs).distinct()
    inner = F.expr(f"substring(points, {secrets.CONTEXT + 1}, length(points) - {2 * secrets.CONTEXT})")
    rows = found.withColumn("held", F.pmod(F.xxhash64(F.lit("held"), inner), F.lit(4)) == 3).collect()
    scores = {
        label: np.sort(network.score(*secrets._stacked([np.frombuffer(r.points, np.uint8) for r in rows if r.held and r.secret == label])))
        for label in (0, 1)
    }
    assert len(scores[1]) > 60 and len(scores[0]) > 60
    assert network.threshold == pytest.approx(scores[1][int((1 - secrets.RECALL) * len(scores[1]))], rel=1e-4)
    assert (scores[0] < network.threshold).mean() > 0.9
    again = secrets.train(docs.repartition(7), sample=100)
    assert again.threshold == network.threshold and all((again.weights[k] == w).all() for k, w in network.weights.items())
    monkeypatch.setattr(secrets, "MERGED", 3)
    merged = secrets.train(docs, sample=100)
    assert all(np.allclose(merged.weights[k], w, atol=0.05) for k, w in network.weights.items())


def test_secret_threshold_keeps_recall():
    import numpy as np

    rng = np.random.default_rng(1)
    x, y = rng.integers(1, 97, (400, 80)).astype(np.uint8), (np.arange(400) % 8 == 0).astype(np.float32)
    net = secrets.Network()
    net.fit(x[:200], y[:200], rounds=1)
    net.calibrate(x[200:], y[200:])  # noise: most secrets score below one half
    score = net.score(x[200:][y[200:] > 0])
    assert np.quantile(score, 0.05) < 0.5
    assert (score >= net.threshold).mean() >= secrets.RECALL
    assert (score > net.threshold).mean() < secrets.RECALL


def test_secret_scores_read_whole_candidates(docs_of):
    import numpy as np

    rng = random.Random(8)
    plain = lambda n: "".join(rng.choices("ghijklmnop", k=n))
    key = lambda: "".join(rng.choices("0123456789abcdef", k=32))
    rows = [(i, f"{' '.join(rng.choices(WORDS, k=6))} {key()} {' '.join(rng.choices(WORDS, k=6))} {plain(30)}1") for i in range(300)]
    network = secrets.train(docs_of(rows))
    begin = "1" + plain(60)
    tails = [plain(40), key().upper() + plain(8), key()[:20].upper() + "/" + plain(19)]
    texts = [f"see {begin}{tail} here" for tail in tails]
    found = secrets.find_secrets(docs_of([(i, t) for i, t in enumerate(texts)]), network).collect()
    assert all(r.base == [] for r in found)
    points = [secrets.codes(t, 4, 4 + len(begin) + len(tail)) for t, tail in zip(texts, tails, strict=True)]
    assert len({p.tobytes() for p in points}) == 3 and len({network.score(*secrets._stacked([p]))[0] for p in points}) == 3
    for p in points:
        every = secrets.windows(p)
        assert np.isclose(network.score(*secrets._stacked([p]))[0], network.score(every).max())
        assert (every[0] == p[:80]).all() and (every[-1] == p[-80:]).all()
        assert len(every) * secrets.STEP >= len(p) - 80
    short = secrets.codes("a 0123456789abcdefg b", 2, 19)
    assert len(short) == 80 == secrets.windows(short).shape[1] and len(secrets.windows(short)) == 1


def test_no_secrets_to_learn_from(docs_of):
    docs = docs_of([(1, "nothing here"), (2, None)])
    assert secrets.train(docs) is None
    assert all(r.base == [] and r.spans == [] for r in secrets.find_secrets(docs, None).collect())


def ranks_and_library():
    tiktoken = pytest.importorskip("tiktoken")
    tokenizers = pytest.importorskip("public_tokenizers")
    ranks = byte_bpe.load_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ranks, tokenizers.PATTERN, library


def test_byte_bpe(docs_of, monkeypatch):
    ranks, pattern, library = ranks_and_library()
    rng = random.Random(5)
    odd = [
        "".join(rng.choices("the tion 012 \n\té中文日本語🙂ء'sLL''", k=rng.randrange(1, 40))) for _ in range(200)
    ]
    rows = messy() + [(400 + i, t) for i, t in enumerate(odd)] + [(900, "a  b \n c   "), (901, "<|endoftext|>")]
    got = byte_bpe.decode(byte_bpe.encode(docs_of(rows), ranks, pattern), ranks, portion=7).collect()
    both = byte_bpe.round_trip(docs_of(rows), ranks, pattern).collect()
    assert Counter(map(tuple, both)) == Counter(map(tuple, got))
    want = Counter((i, tuple(library.encode_ordinary(t or "")), t or "") for i, t in rows)
    import numpy as np

    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in got) == want


def test_transducer_forms_agree():
    """Deterministic, and nondeterministic where the table of states is full."""
    ranks, _, library = ranks_and_library()
    rng = random.Random(6)
    pieces = ["".join(rng.choices("aeiournstlz", k=rng.randrange(1, 30))) for _ in range(800)]
    whole = byte_bpe.Transducer(ranks)
    bare = byte_bpe.Transducer(ranks, limit=1)
    searched = [bare.encode(p.encode()) for p in pieces]
    assert [whole.encode(p.encode()) for p in pieces] == searched
    assert searched == [library.encode_ordinary(p) for p in pieces]


def test_pieces_encoded_together(monkeypatch):
    """New words of a batch go through the transducer together, whatever is remembered; none goes alone but long ones."""
    ranks, pattern, library = ranks_and_library()
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("aeiournstlzäß,.\n中🙂", k=rng.randrange(1, 14))) for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += ["", " ", " a", "a  b", "\n a\n b ", "x" * 47 + "q" * 60 + " " + "ab" * 24, "word " * 9 + "word", texts[3]]
    alone, one = [], byte_bpe.Transducer.encode
    monkeypatch.setattr(byte_bpe.Transducer, "encode", lambda self, piece: alone.append(piece) or one(self, piece))
    want = [library.encode_ordinary(t) for t in texts]
    for limit, size in ((1000, len(texts)), (5, 3), (5, 1)):
        words = byte_bpe.Vocabulary(ranks, pattern, remember=limit).words
        got = [packed for at in range(0, len(texts), size) for packed in words.encode(texts[at : at + size])]
        assert [np.frombuffer(packed, "<u4").tolist() for packed in got] == want
    assert all(len(piece) > byte_bpe.LONG for piece in alone)
    monkeypatch.setattr(byte_bpe, "LONG", 200)
    together = byte_bpe.Together(byte_bpe.Transducer(ranks))
    pieces = ["".join(rng.choices("aeiournstlz", k=rng.randrange(1, 150))) for _ in range(300)]
    assert [np.frombuffer(x, "<u4").tolist() for x in together.encode([p.encode() for p in pieces])] == [library.encode_ordinary(p) for p in pieces]


def test_rows_of_keys():
    """Keys that fall on the same places are told apart, and others aren't found."""
    rng = np.random.default_rng(9)
    keys = np.unique(rng.integers(0, 1 << 40, 5000))
    table = byte_bpe.Table({int(k): i for i, k in enumerate(keys[::2])})
    assert table.get(keys[::2]).tolist() == list(range(len(keys[::2])))
    assert (table.get(keys[1::2]) == -1).all()
    assert (byte_bpe.Table({}).get(keys) == -1).all()


def test_utf8_stream():
    text = "aé中🙂" * 5
    for step in range(1, 8):
        stream, data = byte_bpe.Utf8Stream(), text.encode()
        out = [stream.feed(data[i : i + step]) for i in range(0, len(data), step)]
        assert "".join(out) + stream.feed(b"", last=True) == text


def test_licenses(docs_of):
    rng = random.Random(7)
    lines = ["Licensed under CC BY-NC 4.0.", "CC-BY", "cc  by cc by", "GNU General Public License, version 3", "All Rights Reserved!",
             "Licensed under the Apache License, Version 2.0.", "all rights", "SPDX-License-Identifier: MIT", "the MIT License"]
    rows = messy(4) + [(500 + i, f"{rng.choice(WORDS)} {a}\n{b}") for i, (a, b) in enumerate((a, b) for a in lines for b in lines)]
    got = licenses.scan_licenses(docs_of(rows)).collect()
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    for r in got:
        want = []
        for t in texts[r.doc_id]:
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
            found = [(i, v) for i in range(len(w)) for k, v in licenses.BASE.items() if w[i : i + len(k.split())] == k.split()]
            want.append((len(w), found))
        assert (r.n_words, [(b.start, b.label) for b in r.base]) in want
        for d in r.detections:  # nothing kept is contained in something of its priority or a higher one
            assert not any(
                e is not d and e.start <= d.start and e.end >= d.end and e.priority >= d.priority for e in r.detections
            )
    of = {r.doc_id: {d.label for d in r.detections} for r in got}
    assert of[500] == {"cc-by-nc"} and "apache-2.0" in of[500 + 9 * 5 + 5] and "mit" in of[500 + 9 * 7 + 7]
    assert len(licenses.rules()) > 200


def test_licenses_see_as_far_as_their_rules(docs_of):
    notice = "x released under the terms of the GNU GPL as published by the Free Software Foundation; either version {} y"
    longest = "x published in accordance with the terms and conditions of the GNU General Public License as published by the Free Software Foundation, either version {} y"
    years = " ".join(str(y) for y in range(1960, 2020))
    rows = [(2, notice.format(2)), (3, notice.format(3)), (4, longest.format(2)), (5, f"copyright (c) {years} someone")]
    rows += [(1, "x provided to you in accordance with the terms and conditions of the GNU General Public License version 1 y")]
    got = {r.doc_id: [(d.label, d.start, d.end) for d in r.detections] for r in licenses.scan_licenses(docs_of(rows)).collect()}
    assert got[2] == [("gpl-2", 1, 19)] and got[3] == [("gpl-3", 1, 19)]
    assert [label for label, *_ in got[4]] == ["gpl-2"]
    assert got[1] == [("gpl", 1, 19)]  # gpl and gpl-1 match alike here: the smaller label stays
    assert got[5] == [("copyright", 0, 62)]
    assert licenses.spans()["version"][0] >= 25
    with pytest.raises(ValueError):
        licenses.most_words("(?: a)*")


def test_licenses_beside_line_separators(docs_of):
    """U+0085, U+2028 and U+2029 are word characters, and hide nothing around them."""
    rows = [(i, f"foo{c}bar licensed under the mit license here{c}") for i, c in enumerate([" ", "\x85", "\u2028", "\u2029"])]
    got = licenses.scan_licenses(docs_of(rows)).collect()
    assert [[d.label for d in r.detections] for r in got] == [["mit"]] * 4


def test_licenses_of_nothing(docs_of):
    assert licenses.scan_licenses(docs_of([])).collect() == []
