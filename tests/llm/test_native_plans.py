"""Operators that promise DataFrame functions run nothing in Python; the others read their table once."""

import re

import pytest
from shared_rows import SMALL

from vantagrid.llm import fingerprints, lines, mixing, pii, queries, secrets
from vantagrid.llm.common import Scratch, table

PYTHON = "Python|Pandas|MapInArrow|FlatMap"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(monkeypatch):
    """The plans of all tables that are written on the way."""
    plans, keep = [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df: plans.append(plan(df)) or keep(self, df))
    return plans


@pytest.mark.parametrize("name", ["op1_pii", "op6_fingerprints", "op7_source_mix", "op10_line_dedup"])
def test_native_queries(spark, name, written):
    assert not re.search(PYTHON, plan(queries.QUERIES[name](spark, SMALL)))
    assert name == "op6_fingerprints" or written
    assert not any(re.search(PYTHON, p) for p in written if "Scan ExistingRDD" not in p)


def test_personal_terms_stay_native(spark, documents, written):
    # terms are found, so that the texts are gone through for them
    docs = documents([(k, f"by Zorblatt for a@b.cd on day {k}") for k in range(6)] + [(k, f"nothing {k} here") for k in range(6, 80)])
    assert pii.sanitised(docs).where("clean IS NOT NULL").count() == 6
    assert len(written) > 6 and not any(re.search(PYTHON, p.replace("Scan ExistingRDD", "")) for p in written)


def test_native_operators(spark, written):
    docs = table(spark, SMALL, "documents")
    for df in (pii.sanitised(docs), fingerprints.fingerprints(docs), lines.deduplicated(docs), mixing.mix(docs)):
        assert not re.search(PYTHON, plan(df))


def test_scans_without_shuffle(spark):
    for name in ("op2_secret_scan", "op4_pieces", "op8_media"):
        assert "Exchange" not in plan(queries.QUERIES[name](spark, SMALL))


def test_no_products_and_no_local_checkpoints(spark):
    text = plan(secrets.secret_spans(table(spark, SMALL, "documents")))
    assert "CartesianProduct" not in text
    for name in ("op5_near_dedup", "op9_suffix_dedup", "op6_fingerprints"):
        assert "CartesianProduct" not in plan(queries.QUERIES[name](spark, SMALL))
