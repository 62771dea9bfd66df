"""Archives of documents: what they take on disk, and how they are taken apart."""

import io
import pathlib
import random
import tarfile
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.plans import lending_tables
from riskloom.plans.catalog import QUERIES
from riskloom.sources import documents
from riskloom.sources.staging import staging_root


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    """Orders with a key that is null and one that comes twice, with other values."""
    draw, folder = random.Random(5), tmp_path_factory.mktemp("orders")

    def order(key):
        day = datetime(1992, 1, 1) + timedelta(days=draw.randrange(3000))
        price = round(draw.uniform(1000, 500000), 2)
        return key, draw.randrange(10**6), draw.choice("OFP"), price, day, draw.choice(["1-URGENT", "5-LOW"])

    rows = [order(k) for k in [*range(3000), 71, None]]
    names = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    made = spark.createDataFrame(rows, f"{names}, o_orderdate timestamp, o_orderpriority string")
    made.repartition(3).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def _files(spark):
    root = pathlib.Path(staging_root(spark).removeprefix("file:"))
    return {f: f.stat().st_size for f in root.glob("raw-*/*/*") if f.suffix in (".tar", ".zst")}


@pytest.mark.parametrize("name", ["s1_document_scan", "s2_first_documents"])
def test_folders_of_documents_take_less_disk_than_their_texts(spark, orders, name):
    made = {"bureau": lending_tables.bureau_documents, "banking": lending_tables.banking_documents}
    texts = {k: sorted(f(spark, orders).groupBy("stem").agg(F.max("raw")).collect()) for k, f in made.items()}
    before = _files(spark)
    rows = sorted((r.kind, r.stem, r.file_name) for r in QUERIES[name](spark, orders).collect())
    new = {f: size for f, size in _files(spark).items() if f not in before}
    assert sum(new.values()) < sum(len(raw) for rows in texts.values() for _, raw in rows) / 3
    read = {}
    for kind in made:
        folder = {f.parent for f in new if f.parent.name == kind}.pop()
        read[kind] = sorted((r.stem, r.raw) for r in documents.read_documents(spark, str(folder)).collect())
        assert read[kind] == [tuple(r) for r in texts[kind]]
    stems = {kind: [stem for stem, _ in read[kind]] for kind in made}
    if name == "s2_first_documents":
        first = stems["bureau"][:25]
        stems = {"bureau": first, "banking": [s for s in stems["banking"] if s in first]}
    assert rows == sorted((kind, s, f"{s}.json") for kind in made for s in stems[kind])


def test_orders_are_sorted_before_texts_are_made_of_them(spark, orders):
    for made in (lending_tables.bureau_documents, lending_tables.banking_documents):
        docs = made(spark, orders, ordered=True)
        plan = docs._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Sort [") == 1 and plan.index("AS raw") < plan.index("Sort [stem")
        dealt = docs.mapInArrow(lambda batches: batches, docs.schema)
        parts = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.collect_list("stem").alias("stems")).collect()
        assert parts and all(r.stems == sorted(r.stems) for r in parts)
        assert sorted(docs.collect()) == sorted(made(spark, orders).collect())


@pytest.mark.parametrize("compressed", [False, True])
def test_of_one_stem_the_greatest_text_stays(spark, tmp_path, monkeypatch, compressed):
    monkeypatch.setattr(lending_tables, "ARCHIVE_BYTES", 1)  # an archive is closed as soon as it may be
    rows = [("B", "2"), ("A", None), ("B", "é"), ("B", None), ("A", ""), ("C", "x" * 512), ("D" * 120, "y" * 3000)]
    docs = spark.createDataFrame(rows, "stem string, raw string").coalesce(1)
    for ordered in (False, True):
        folder = f"{tmp_path}/{ordered}"
        lending_tables.write_documents(docs.sort("stem") if ordered else docs, folder, compressed, ordered)
        found = {r.stem: r.raw for r in documents.read_documents(spark, folder, "*.json").collect()}
        assert found == {"A": "", "B": "é", "C": "x" * 512, "D" * 120: "y" * 3000}
        endings = {"".join(f.suffixes) for f in pathlib.Path(folder).glob("documents*")}
        assert endings == {".tar.zst" if compressed else ".tar"}


def test_headers_are_those_of_tarfile():
    header = lending_tables._tar_header()
    names = ["APP000000001.json", "a/b c.json", "n" * 100, "n" * 101, "é.json", "d/" * 80 + "x.json"]
    for name in names:
        for size in (0, 1, 511, 512, 8**11 - 1, 8**11):
            info = tarfile.TarInfo(name)
            info.size = size
            assert header(name, size) == info.tobuf()


def _archive(layout, members):
    packed = io.BytesIO()
    with tarfile.open(fileobj=packed, mode="w", format=layout) as archive:
        for name, content in members:
            info = tarfile.TarInfo(name)
            if content is None:
                info.type = tarfile.DIRTYPE
            elif isinstance(content, str):
                info.type, info.linkname = tarfile.SYMTYPE, content
            else:
                info.size = len(content)
            archive.addfile(info, io.BytesIO(content) if isinstance(content, bytes) else None)
    return packed.getvalue()


@pytest.mark.parametrize("layout", [tarfile.USTAR_FORMAT, tarfile.GNU_FORMAT, tarfile.PAX_FORMAT])
def test_members_are_those_that_tarfile_finds(monkeypatch, layout):
    monkeypatch.setattr(documents, "_PORTION", 700)  # headers and contents lie across portions
    files = [("a.json", b""), ("b.json", b"x" * 512), ("d/c.json", b"y" * 5000), ("last.json", b"{}")]
    others = {
        "plain": [],
        "folder": [("d", None)],
        "link": [("l.json", "a.json")],
        "long": [("d/" * 45 + "n" * 60 + ".json", b"long")],
        "no ASCII": [("é.json", "é".encode())],
    }
    for more in others.values():
        for place in range(len(files) + 1):
            members = files[:place] + more + files[place:]
            whole = _archive(layout, members)
            want = [m for m in members if isinstance(m[1], bytes)]
            assert list(documents._members(io.BytesIO(whole))) == want
            frames = b"".join(pa.compress(whole[i : i + 3000], "zstd", asbytes=True) for i in range(0, len(whole), 3000))
            assert list(documents._members(pa.CompressedInputStream(pa.BufferReader(frames), "zstd"))) == want
            no_end = whole[: max(i for i in range(0, len(whole), 512) if any(whole[i : i + 512])) + 512]
            assert list(documents._members(io.BytesIO(no_end))) == want
    assert list(documents._members(io.BytesIO(_archive(layout, [])))) == []


def test_torn_archives_are_errors():
    whole = _archive(tarfile.PAX_FORMAT, [("a.json", b"x" * 600), ("b.json", b"y" * 600)])
    for torn in (b"", whole[:100], whole[:700], whole[: 512 * 4 + 100], b"z" * 2000):
        with pytest.raises(tarfile.ReadError):
            list(documents._members(io.BytesIO(torn)))
