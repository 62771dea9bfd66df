"""The neighbour vote against plain numpy, on messy rows, and on held-out rows of the driver tables."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import quality
from riskloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
driver_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
WORDS = "The of a red fox runs over lazy dog and then sleeps in old barn near river Été über naïve 42".split()


def corpus(seed=0, n=400):
    """Plain texts, and ones of four kinds of junk; label 1 is plain."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.choice([5, 30, 120]))
        junk = i % 4 == 0
        if junk:
            kind = i // 4 % 4
            if kind == 0:
                words = [w + rng.choice(["###", "%%", "&&&"]) for w in words]
            elif kind == 1:
                words = [w.upper() + "!!" for w in words]
            elif kind == 2:
                words = " | ".join(words).split()
            else:
                words = [w for w in words for _ in range(9)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not junk)))
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def labels_of(spark, labels):
    return spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, score string")


def test_terms_of_a_text_do_not_depend_on_its_batch():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(40))).encode() for _ in range(50)]
    texts += [b"", b" \n", b"x", b"a a a a", b"word " * 400_000, b"y" * 1_500_000, b"\xff\xfe bad"]
    together = quality.count_terms(texts)
    assert together.min() == 0
    for text, row in zip(texts, together, strict=True):
        assert (quality.count_terms([text])[0] == row).all()
    plain = np.zeros(quality.FAMILIES[0])  # the grams of a short text, one by one
    for gram in (b" ab", b"ab "):
        code = (int.from_bytes(gram, "big") * 2654435761) & 0xFFFFFFFF
        plain[(((code ^ (code >> 15)) >> 16) * quality.FAMILIES[0]) >> 16] += 1
    assert (quality.count_terms([b"AB"])[0][: quality.FAMILIES[0]] == plain).all()
    repeated = quality.count_terms([b"a a a a", b"a b c d e f", b""])[:, quality.FAMILIES[0] + quality.FAMILIES[1] :]
    assert repeated[0, 1:13].all() and not repeated[0, 13:].any() and not repeated[1].any() and repeated[2, 0] == 1


def test_vote(spark, docs_of):
    rows, labels = corpus()
    rows += [(1000, None), (1001, ""), (None, rows[0][1]), (None, rows[1][1]), (7, rows[0][1]), (1002, "z" * 300_000)]
    labels += [(3, 0), (5, 1), (9999, 1), (None, 0)]  # contradicting, repeated, without a document, without an id
    docs = docs_of(rows)
    model = quality.train(docs, labels_of(spark, labels))
    taught = {i for i, _ in labels if i is not None and not held(i) and i not in (3, 9999)}
    text_of = {}
    for i, t in rows:
        if i in taught:
            text_of.setdefault(t, []).append(dict(labels[:400])[i])
    assert len(model.good) == len(text_of) - sum(2 * sum(v) == len(v) for v in text_of.values())
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "score", "predicted"}
    # By brute force: one text at a time, all neighbours sorted.
    vectors = model.vectors
    for i, text in rows[::7] + rows[-6:]:
        own = model.project(model.weighted(quality.count_terms([(text or "").encode()])))[0]
        near = np.array([float(own @ v) for v in vectors])
        last = np.sort(near)[-quality.NEIGHBOURS]
        weight = np.where(near >= last, np.maximum(near, 0), 0) ** quality.POWER * model.votes
        weight = weight if weight.any() else model.votes
        want = (weight * model.good).sum() / weight.sum()
        mine = {round(r.score, 6) for r in got if r.doc_id == i}
        assert round(want, 6) in mine
    by_id = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    right = [by_id[i].predicted == y for i, y in labels[:400] if held(i) and i != 7]
    assert sum(right) / len(right) >= 0.97
    assert by_id[1000].score == by_id[1001].score
    again = quality.score(docs_of(rows[::-1]).repartition(7), model).collect()
    assert sorted((str(r.doc_id), r.score) for r in again) == sorted((str(r.doc_id), r.score) for r in got)


def test_sample_keeps_the_shares_of_labels(spark, docs_of):
    rows, labels = corpus(2)
    model = quality.train(docs_of(rows), labels_of(spark, labels), sample=20)
    assert [int((model.good == k).sum()) for k in (0, 1)] == [20, 20]
    full = quality.train(docs_of(rows), labels_of(spark, labels))
    for k in (0, 1):
        assert model.votes[model.good == k].sum() == pytest.approx(full.votes[full.good == k].sum())


def test_copies_of_a_text_are_one_vote(spark, docs_of):
    rows, labels = corpus(3, 100)
    copies = [(1000 + i, rows[0][1]) for i in range(300)]
    model = quality.train(docs_of(rows + copies), labels_of(spark, labels + [(i, 0) for i, _ in copies]))
    assert len(model.good) <= 100


def test_nothing_to_learn_from(spark, docs_of):
    docs = docs_of([(1, "some text"), (2, None), (None, "")])
    none = quality.score(docs, quality.train(docs, labels_of(spark, []))).collect()
    assert [r.score for r in none] == [0.5] * 3
    one = [i for i in range(10) if not held(i)][:3]
    docs = docs_of([(i, f"some text {i}") for i in one] + [(50, None)])
    alike = quality.score(docs, quality.train(docs, labels_of(spark, [(i, 0) for i in one]))).collect()
    assert [r.predicted for r in alike] == [0] * 4
    empty = docs_of([])
    assert quality.score(empty, quality.train(empty, labels_of(spark, [(1, 1)]))).collect() == []


@driver_tables
def test_registered_query(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    out = QUERIES["op11_quality"](spark, SF)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    found = out.where("held_out").join(labels, "doc_id").groupBy("quality").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("right")
    )
    right = {r.quality: r.right for r in found.collect()}
    assert right[0] >= 0.9 and right[1] >= 0.98
