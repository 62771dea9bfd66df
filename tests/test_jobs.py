import json
import random
import shutil

import pytest
from fixtures import BANKING, BUREAU, without
from pyspark.sql import functions as F

from riskloom.operators import models
from riskloom.plans import jobs, lending_tables
from riskloom.sources import documents, tables
from riskloom.streaming import ingest


def _pair(i, draw):
    """An applicant whose score, delinquency and outcome go together."""
    risk = draw.random()
    key = f"APP{i:06d}"
    trades = [
        dict(BUREAU["TRADES"][0], TRADE_REF_NUM=f"{i}-{n}", DPD=str(int(risk * 100 * n)).zfill(3))
        for n in range(2)
    ]
    bureau = dict(BUREAU, LOAN_APP_ID=key, SCORE_V3=int(850 - 450 * risk), TRADES=trades)
    txns = [
        {
            "TXN_DATE": f"2024-01-{n + 1:02d}",
            "TXN_AMOUNT": round(100 + 900 * draw.random(), 2),
            "TXN_TYPE": "CR" if n % 3 == 0 else "DR",
            "TXN_DESC": ["Salary", "Loan EMI", "Cash Withdrawal"][n % 3],
            "BAL_AFTER": round(1000 * draw.random(), 2),
        }
        for n in range(6)
    ]
    return key, bureau, dict(BANKING, LOAN_APP_ID=key, TRANSACTIONS=txns), int(draw.random() < risk)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw_run")
    draw = random.Random(11)
    (root / "raw/bureau").mkdir(parents=True)
    (root / "raw/banking").mkdir()
    outcomes = ["loan_app_id,default_flag"]
    for i in range(120):
        key, bureau, banking, flag = _pair(i, draw)
        if i == 3:
            bureau = without(bureau, "LOAN_APP_ID")
        (root / f"raw/bureau/{key}.json").write_text("{torn" if i == 4 else json.dumps(bureau, indent=1))
        if i != 5:
            (root / f"raw/banking/{key}.json").write_text(json.dumps(banking))
        if i % 10 != 9:
            outcomes.append(f"{key},{flag}")
    (root / "raw/bureau/notes.json").write_text("{}")
    (root / "raw/labels.csv").write_text("\n".join(outcomes) + "\n")
    return root


@pytest.fixture(scope="module")
def built(spark, raw):
    layout = jobs.Layout(str(raw))
    return layout, jobs.build(spark, layout)


def test_build(spark, built):
    layout, table = built
    assert table.count() == 117 and len(table.columns) == 24
    reasons = {r.stem: r.reason for r in spark.read.parquet(layout.rejects).collect()}
    assert reasons == {
        "APP000003": "bureau_missing_id",
        "APP000004": "bureau_corrupt_json",
        "APP000005": "banking_missing_file",
    }
    row = table.where("loan_app_id = 'APP000000'").first()
    assert (row.num_trades, row.txn_count, row.salary_credits_count) == (2, 6, 2)
    assert table.where("default_flag is null").count() == 12
    summary = jobs.build_report(spark, layout).first()
    assert (summary.applicants, summary.columns, summary.skipped) == (117, 24, 3)


def test_reports_before_scoring(spark, built):
    layout, _ = built
    reports = jobs.analytics(spark, layout)
    assert list(reports) == ["risk_band_distribution", "risk_band_profile", "top_delinquent"]
    assert sum(r.applicants for r in reports["risk_band_distribution"].collect()) == 117
    assert spark.sql("SELECT count(*) FROM applicants").first()[0] == 117


def test_limit_takes_the_first_files(spark, raw, tmp_path):
    layout = jobs.Layout(str(tmp_path))
    shutil.copytree(raw / "raw", tmp_path / "raw")
    keys = {r.loan_app_id for r in jobs.build(spark, layout, limit=8).collect()}
    assert keys == {f"APP{i:06d}" for i in (0, 1, 2, 6, 7)}


def test_score_and_reports(spark, built):
    layout, _ = built
    results = jobs.score(spark, layout, boosting_rounds=10, mark_test_rows=True)
    scored = spark.read.parquet(layout.scored)
    assert scored.count() == 105
    assert scored.where("pd_score between 0 and 1").count() == 105
    assert scored.where("is_test").count() in (20, 21, 22)
    assert results["model_comparison"].count() == 2
    assert results["pd_deciles"].agg(F.sum("applicants")).first()[0] == 105
    reports = jobs.analytics(spark, layout)
    assert len(reports) == 5
    quintiles = reports["pd_quintiles"].collect()
    assert [r.applicants for r in quintiles] == [21] * 5
    assert quintiles[-1].default_rate_pct > quintiles[0].default_rate_pct
    model = models.load_model(spark, layout.model)
    assert model.name in (models.LOGISTIC, models.BOOSTING) and len(model.features) == 18
    again = models.apply_model(model, scored.drop("pd_score")).select("loan_app_id", "pd_score")
    assert again.exceptAll(scored.select("loan_app_id", "pd_score")).count() == 0


def test_score_everyone(spark, built):
    layout, _ = built
    jobs.score(spark, layout, boosting_rounds=2, score_all=True)
    assert spark.read.parquet(layout.scored).count() == 117


def test_run_all(spark, raw, tmp_path):
    shutil.copytree(raw / "raw", tmp_path / "raw")
    results = jobs.run_all(spark, jobs.Layout(str(tmp_path)), boosting_rounds=2)
    assert list(results) == [
        "model_comparison",
        "pd_deciles",
        "risk_band_distribution",
        "risk_band_profile",
        "top_delinquent",
        "default_rate_by_band",
        "pd_quintiles",
    ]
    assert all(table.count() > 0 for table in results.values())


def test_missing_inputs_are_errors(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path))
    (tmp_path / "raw/bureau").mkdir(parents=True)
    with pytest.raises(Exception, match="(?i)no raw documents|path"):
        jobs.build(spark, layout)
    with pytest.raises(FileNotFoundError):
        jobs.score(spark, layout)
    with pytest.raises(FileNotFoundError):
        jobs.analytics(spark, layout)


def test_nothing_usable_is_an_error(spark, tmp_path):
    for side in ("bureau", "banking"):
        (tmp_path / "raw" / side).mkdir(parents=True)
        (tmp_path / f"raw/{side}/APP000001.json").write_text("[]")
    with pytest.raises(RuntimeError, match="every document was rejected"):
        jobs.build(spark, jobs.Layout(str(tmp_path)))


def test_no_labels_file(spark, tmp_path):
    for side, doc in (("bureau", BUREAU), ("banking", BANKING)):
        (tmp_path / "raw" / side).mkdir(parents=True)
        (tmp_path / f"raw/{side}/APP000123.json").write_text(json.dumps(doc))
    layout = jobs.Layout(str(tmp_path))
    assert "default_flag" not in jobs.build(spark, layout).columns
    with pytest.raises(ValueError, match="default_flag"):
        jobs.score(spark, layout)


def test_labels_csv(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("loan_app_id,default_flag\nA1,1\nA1,0\nA2,\n")
    assert [tuple(r) for r in tables.read_labels(spark, str(path)).collect()] == [
        ("A1", 1),
        ("A1", 0),
        ("A2", None),
    ]
    assert tables.read_labels(spark, str(tmp_path / "none.csv")) is None
    assert tables.read_labels(spark, None) is None


def test_labels_as_users_write_them(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("note,default_flag,loan_app_id\nx,1.0,B1\ny,0.0,B2\nz, 1 ,B3\n,,B4\n")
    assert [tuple(r) for r in tables.read_labels(spark, str(path)).collect()] == [
        ("B1", 1, "x"),
        ("B2", 0, "y"),
        ("B3", 1, "z"),
        ("B4", None, None),
    ]
    path.write_text("loan_app_id,default_flag\nB1,2\n")
    with pytest.raises(Exception, match="neither 0 nor 1"):
        tables.read_labels(spark, str(path)).collect()
    path.write_text("loan_app_id,flag\nB1,1\n")
    with pytest.raises(ValueError, match="default_flag"):
        tables.read_labels(spark, str(path))


def test_document_files_are_listed_by_name(spark, raw):
    files = documents.document_files(spark, str(raw / "raw/bureau"))
    assert files.count() == 120
    first = documents.read_first_documents(spark, str(raw / "raw/bureau"), 3)
    assert sorted(r.stem for r in first.collect()) == [f"APP{i:06d}" for i in range(3)]
    assert documents.read_first_documents(spark, str(raw / "raw/bureau"), 0).count() == 120


# --- resumable ingestion ---------------------------------------------------------------------


def _land(spark, source, target, progress, per_batch=None):
    stream = ingest.stream_documents(spark, str(source), files_per_batch=per_batch)
    ingest.ingest(stream, str(target), str(progress)).awaitTermination()
    return sorted((r.stem, r.raw) for r in ingest.landed_documents(spark, str(target)).collect())


def _put(folder, numbers):
    folder.mkdir(exist_ok=True)
    for i in numbers:
        (folder / f"APP{i:06d}.json").write_text(json.dumps(dict(BUREAU, LOAN_APP_ID=f"APP{i:06d}"), indent=2))


def test_chunks_equal_one_run(spark, tmp_path):
    whole, part = tmp_path / "whole", tmp_path / "part"
    _put(whole, range(4))
    single = _land(spark, whole, tmp_path / "t1", tmp_path / "c1")
    assert len(single) == 4
    _put(part, range(2))
    assert len(_land(spark, part, tmp_path / "t2", tmp_path / "c2")) == 2
    _put(part, range(2, 4))
    assert _land(spark, part, tmp_path / "t2", tmp_path / "c2", per_batch=1) == single
    # Nothing new, then everything once more with no memory of what was read.
    assert _land(spark, part, tmp_path / "t2", tmp_path / "c2") == single
    assert _land(spark, part, tmp_path / "t2", tmp_path / "c3", per_batch=3) == single


def test_a_retried_batch_writes_the_same(spark, tmp_path):
    docs = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "1")], "stem string, raw string")
    more = spark.createDataFrame([("b", "2"), ("c", "3")], "stem string, raw string")
    target = str(tmp_path / "t")
    for batch, number in ((docs, 0), (more, 1), (docs, 0), (more, 1)):
        ingest.land_batch(batch, number, target)
    assert sorted(r.stem for r in ingest.landed_documents(spark, target).collect()) == ["a", "b", "c"]


def test_documents_in_archives_are_read_as_loose_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lending_tables, "ARCHIVE_BYTES", 4096)
    texts = {f"APP{i:09}": f'{{"LOAN_APP_ID": "é{i}"}}' for i in range(0, 90, 3)} | {"XYZ": "{}"}
    docs = spark.createDataFrame([*texts.items(), ("APP000000000", texts["APP000000000"])], "stem string, raw string")
    lending_tables.write_documents(docs.repartition(3, "stem"), f"{tmp_path}/archived")
    (tmp_path / "loose").mkdir()
    for stem, raw in texts.items():
        (tmp_path / "loose" / f"{stem}.json").write_text(raw)
    files = list((tmp_path / "archived").glob("*.tar"))
    assert 3 < len(files) < len(texts) / 2

    def rows(found):
        return sorted((r.file_name, r.stem, r.raw or "") for r in found.collect())

    found = {}
    for folder in ("archived", "loose"):
        path = f"{tmp_path}/{folder}"
        first = documents.read_first_documents(spark, path, 7)
        found[folder] = [
            rows(documents.read_documents(spark, path)),
            rows(documents.read_documents(spark, path, "APP00000003[^3].{json,txt}")),
            rows(first),
            rows(documents.read_matching_documents(spark, path, first.where("stem != 'APP000000003'"))),
            sorted((r.file_name, r.stem) for r in documents.document_files(spark, path).collect()),
        ]
    assert found["archived"] == found["loose"]
    assert [len(part) for part in found["archived"]] == [30, 3, 7, 6, 30]
    empty = spark.createDataFrame([("APP1", None), ("APP2", "")], "stem string, raw string")
    lending_tables.write_documents(empty.coalesce(1), f"{tmp_path}/empty")
    assert rows(documents.read_documents(spark, f"{tmp_path}/empty")) == [("APP1.json", "APP1", ""), ("APP2.json", "APP2", "")]
    for read in (documents.read_documents, lambda *a: documents.read_first_documents(*a[:2], 3, a[2])):
        with pytest.raises(FileNotFoundError):
            read(spark, f"{tmp_path}/archived", "none*.json")
