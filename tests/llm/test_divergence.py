"""The audit of sources against plain Python with whole numbers, on messy rows, and against SQL."""

import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from riskloom.llm import divergence
from riskloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"
driver_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
WORDS = "The of a Red fox été Über naïve ÉTÉ antidisestablishment antidisestablished eightlet sixteen_letters中文".split()
WORDS += ["exactlyeight"[:8], "sixteenletterswo", "seventeenletterso", "y" * 40, " odd", "a'b-c2d"]


def by_hand(rows, least, ranks):
    """(lang, source, part, item, value, rank) rows of (text, lang, source)."""
    docs, count = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        groups.add((lang, source))
        docs[lang].update(set(terms))
        count[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        sources = sorted(s for g, s in groups if g == lang)
        both = sum((count[lang, s] for s in sources), Counter())

        def p_of(c, kept=kept):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        ps, q = {s: p_of(count[lang, s]) for s in sources}, p_of(both)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            parts = {
                "pair": [(o, sum(f(ps[s][t], ps[o][t]) for t in kept)) for o in sources if o != s],
                "term": [(t, f(ps[s][t], q[t])) for t in kept if count[lang, s][t] and ps[s][t] > q[t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                items = items if part == "pair" else items[:ranks]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(items, 1)]
    return sorted(out)


def table_of(spark, rows):
    """Columns of documents, and some of clashing names."""
    clash = ["n", "term", "block", "total", "terms", "value", "rank", "item", "first"]
    names = ["text", "lang", "source", "doc_id", *clash]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return spark.createDataFrame([(*r, "1", *["x"] * len(clash)) for r in rows], schema)


def messy(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["hot", "hot", "hot", "a", "b", "é", None])
        weights = [rng.random() ** 3 for _ in WORDS]
        rows.append((" ".join(rng.choices(WORDS, weights, k=rng.choice([0, 3, 40]))), lang, source))
    rows += [(None, "en", "empty"), ("12 34 !!", "fr", "x"), (None, "fr", "y"), ("only few", "it", "z"), rows[0], rows[0]]
    rows += [(" ".join(rng.choices(WORDS, k=50_000)), "en", "a"), ("w" * 100_000 + " fox", "en", "b")]
    return rows


@pytest.mark.parametrize(("seed", "least", "ranks"), [(0, 10, 10), (1, 3, 2), (2, 1, 1000)])
def test_audit(spark, seed, least, ranks):
    rows = messy(seed)
    got = divergence.audit_sources(table_of(spark, rows), least=least, ranks=ranks)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == by_hand(rows, least, ranks)


def test_blocks_and_chunks_change_nothing(spark, monkeypatch):
    rows = messy(3, 100)
    want = by_hand(rows, 2, 10)
    monkeypatch.setattr(divergence, "CHUNK", 1_000)
    monkeypatch.setattr(divergence, "BLOCK", 7)
    monkeypatch.setattr(divergence, "CELLS", 16)
    got = divergence.audit_sources(table_of(spark, rows).repartition(5), least=2)
    assert sorted(map(tuple, got.collect())) == want


def test_audit_of_nothing(spark):
    assert divergence.audit_sources(table_of(spark, [])).collect() == []
    one = divergence.audit_sources(table_of(spark, [("alone", "en", "s")])).collect()
    assert one == []  # no other source, no kept term
    two = divergence.audit_sources(table_of(spark, [("alone", "en", "s"), (None, "en", None)])).collect()
    assert sorted(map(tuple, two)) == [("en", "", "pair", "s", 0, 1), ("en", "s", "pair", "", 0, 1)]


def test_terms_of_a_chunk():
    rng = random.Random(4)
    texts = [" ".join(rng.choices(WORDS, k=30)).encode() for _ in range(40)] + [b"", b"a" * 8 + b" " + b"b" * 16]
    group = np.array([i % 3 for i in range(len(texts))])
    want, docs = Counter(), Counter()
    for text, g in zip(texts, group, strict=True):
        terms = [t.translate(LOWER) for t in TERM.findall(text.decode())]
        want.update((g, t) for t in terms)
        docs.update((g, t) for t in set(terms))
    found = {}
    for owner, term, count, in_docs in divergence.count_terms(texts, group):
        for g, t, c, d in zip(owner.tolist(), term.to_pylist(), count.tolist(), in_docs.tolist(), strict=True):
            assert (g, t) not in found
            found[g, t] = (c, d)
    assert found == {k: (n, docs[k]) for k, n in want.items()}


def test_radix_order():
    rng = np.random.default_rng(0)
    for columns in (
        [rng.integers(0, 3, 999).astype(np.uint32), rng.integers(0, 2**63, 999).astype(np.uint64) << np.uint64(1)],
        [rng.integers(0, 70_000, 999).astype(np.uint32)],
        [np.zeros(0, np.uint64)],
    ):
        assert (divergence.radix_order(columns) == np.lexsort(columns[::-1])).all()


def test_long_division(spark):
    rng = random.Random(1)
    rows = [(c, rng.randrange(max(c, 1), 9 * 10**15)) for c in (rng.randrange(10 ** rng.randrange(1, 15)) for _ in range(200))]
    df = spark.createDataFrame([*rows, (5, 5)], "a long, b long")
    got = df.select("a", "b", divergence._scaled(df.a, df.b).alias("p")).collect()
    assert all(r.p == 1 + 10**9 * r.a // r.b for r in got)


@driver_tables
def test_registered_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    columns = "lang, source, part, item, value, rank"
    want = con.execute(f"SELECT {columns} FROM ({SQL['op12_divergence']})").fetchall()
    got = [tuple(r) for r in QUERIES["op12_divergence"](spark, SF).collect()]
    assert sorted(got) == sorted(want) and len(got) > 1000
