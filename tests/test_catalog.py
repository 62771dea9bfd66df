"""Every catalog query against its SQL on the smallest tables."""

import os
from functools import partial

import pytest
from compare import connect, difference, entry

from riskloom.operators import models
from riskloom.plans import catalog
from riskloom.plans.catalog import QUERIES
from riskloom.plans.expected_sql import EXPECTED
from riskloom.sources.staging import staging_root

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

# Model fits take a minute each; tests/test_scoring.py covers them with fewer rounds.
FITTED = {
    "m4_logistic_pd",
    "m5_boosting_pd",
    "m10_champion",
    "m11_scored_applicants",
    "m13_model_comparison",
    "s10_model_artifact",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF, name) is None


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(EXPECTED) == FITTED


def test_entry_offers_all_of_them():
    assert set(QUERIES) <= set(entry.queries()) and set(EXPECTED) <= set(entry.oracle_sql())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert [r.risk_band for r in rows] == [1, 2, 3, 4, 5]
    assert sum(r.applicants for r in rows) == 150


def test_labelled_applicants_are_made_once(spark, tmp_path, monkeypatch):
    """Training and scoring read them where they were written, also when the models are found there."""
    monkeypatch.setattr(models, "train", partial(models.train, boosting_rounds=1))
    here = tmp_path / "tables"  # what is kept goes by the path of the tables
    here.symlink_to(SF)
    counts = []
    for _ in range(2):
        trained, labelled = catalog._trained(spark, str(here))
        files = labelled.inputFiles()
        assert files and all(f.removeprefix("file:").lstrip("/").startswith(staging_root(spark).removeprefix("file:").lstrip("/")) for f in files)
        counts.append((labelled.count(), trained.champion))
    assert counts[0] == counts[1] and counts[0][0] > 0


def test_first_documents_look_through_the_archives_once(spark):
    """The first bureau documents are written; only the statements' archives are read for the result."""
    files = QUERIES["s2_first_documents"](spark, SF).inputFiles()
    assert any("/banking/" in f for f in files) and not any("/bureau/" in f for f in files)
