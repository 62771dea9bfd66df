"""The manifest against plain Python that builds and folds whole trees, on messy rows, and against SQL."""

import hashlib
import os
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from riskloom.llm import merkle
from riskloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"
driver_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([sha("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return out


def way(levels, place):
    """(left, right) beside a node, level by level."""
    out = []
    for nodes in levels[:-1]:
        start = place // 16 * 16
        run = nodes[start : start + 16]
        out.append((run[: place - start], run[place - start + 1 :]))
        place //= 16
    return out


def by_hand(rows, where):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root) of (doc_id, text, lang, source, n_chars) rows."""
    trees = defaultdict(list)
    for i, text, lang, source, n in rows:
        leaf = leaf_of((i, source, lang, n, text))
        put = leaf_of((i, source, lang, n, None if text is None else text.translate(LOWER))) if where(i) else leaf
        trees["" if source is None else "+" + source].append((i is not None, i or 0, leaf, put, i))
    names = sorted(trees, key=str.encode)
    for tree in trees.values():
        tree.sort()
    levels = {name: levels_of([leaf for _, _, leaf, _, _ in trees[name]]) for name in names}
    top = levels_of([levels[name][-1][0] for name in names]) if names else []
    out = []
    for at, name in enumerate(names):
        for place, (_, _, leaf, put, i) in enumerate(trees[name]):
            digest, proof = put, ""
            for left, right in way(levels[name], place) + way(top, at):
                digest = sha("".join([*left, digest, *right]))
                proof += "".join(left + right)
            out.append((i, leaf, levels[name][-1][0], top[-1][0], sha(proof), digest))
    return sorted(out, key=repr)


def rows_of(seed, sizes):
    rng = random.Random(seed)
    rows, i = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            i += 1
            text = " ".join(rng.choices(["The", "fox", "Été", "中文", "RUNS"], k=rng.randrange(6)))
            rows.append((i, rng.choice([text, text, text, None]), rng.choice(["en", None]), source, rng.choice([3, None])))
    rng.shuffle(rows)
    return rows


def run(spark, rows, every=5):
    names = "doc_id long, text string, lang string, source string, n_chars long"
    clash = ["leaf", "tree", "pos", "total", "tile", "root", "put", "id", "way"]
    df = spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows], names + "".join(f", {c} string" for c in clash))
    out = merkle.manifest(merkle.leaves(df, {"text": merkle.lower_cased(F.col("text"))}, F.col("doc_id") % every == 0))
    columns = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    return sorted(map(tuple, out.select(*columns).collect()), key=repr)


def by_every(every):
    return lambda i: i is not None and i % every == 0


SIZES = {"hot": 300, "a": 16, "b": 17, "c": 1, None: 5, "": 2, "é": 33, **{f"s{i}": 1 + i % 3 for i in range(20)}}


def test_manifest(spark):
    rows = rows_of(0, SIZES)
    rows += [(7, "Same id", "en", "hot", 1), (7, "Same id", "en", "hot", 1), (7, "other", "en", "hot", 1)]
    rows += [(None, "No Id", "en", "hot", 1), (None, "no id", "en", "hot", 1), (None, None, None, None, None)]
    rows += [(10_000, "LONG " * 200_000, "en", "a", 1), (10_005, "", "en", "a", 0)]
    got = run(spark, rows)
    want = by_hand(rows, by_every(5))
    assert got == want
    changed = {r[0] for r in rows if r[1] is not None and by_every(5)(r[0]) and r[1] != r[1].translate(LOWER)}
    assert {r[0] for r in got if r[5] != r[3]} == changed and len(changed) > 20


@pytest.mark.parametrize("levels", [1, 2])
def test_many_rounds_of_tiles(spark, monkeypatch, levels):
    """Low tiles, so that trees of some hundred leaves take several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BATCH", 10)
    rows = rows_of(1, SIZES)
    assert run(spark, rows, 3) == by_hand(rows, by_every(3))


def test_order_and_partitions_change_nothing(spark):
    rows = rows_of(2, {"x": 40, "y": 3})
    assert run(spark, rows) == run(spark, rows[::-1])


def test_small_manifests(spark):
    assert run(spark, []) == []
    lone = [(1, "Text", "en", "s", 4)]
    (row,) = run(spark, lone)
    assert row[1] == row[2] == row[3] == row[5] and row[4] == sha("")
    (row,) = run(spark, lone, 1)  # altered: the root is another
    assert row[3] != row[5] == leaf_of((1, "s", "en", 4, "text"))
    two = [(1, "a", None, "s", None), (2, "b", None, None, None)]
    assert run(spark, two) == by_hand(two, by_every(5))


def test_midstates_resume():
    children = [sha(str(i)).encode() for i in range(16)]
    parent = merkle.Parent(children)
    for slot in range(16):
        other = sha("other").encode()
        want = hashlib.sha256(b"".join([*children[:slot], other, *children[slot + 1 :]])).hexdigest().encode()
        assert parent.fold(slot, other) == want and parent.fold(slot, children[slot]) == parent.digest
        assert parent.left(slot) + children[slot] + parent.rights[slot] == b"".join(children)


@driver_tables
def test_registered_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    columns = "doc_id, leaf, subroot, root, proof_sha256, folded_root, verified"
    want = con.execute(f"SELECT {columns} FROM ({SQL['op13_merkle']})").fetchall()
    got = [tuple(r) for r in QUERIES["op13_merkle"](spark, SF).select(*columns.split(", ")).collect()]
    assert sorted(got) == sorted(want) and len(got) == 1000 and {r[-1] for r in got} == {True, False}
