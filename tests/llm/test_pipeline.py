"""The corpus pipeline, stage by stage, against plain versions of its decisions."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from verdigrid.llm import rules, secret_scan, voting
from verdigrid.llm.common import written

from .test_operators import brute_components, odd_documents


@pytest.fixture(scope="module")
def tables(spark, sf):
    """Every stage's input, and the last one's output."""
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf), name))
    return out


def test_stages(spark, sf, tables):
    docs = tables[0]
    assert all(t.dtypes == docs.dtypes for t in tables[1:-1])
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = {r.doc_id for r in rules.quality_rules(docs, rules.fit_rules(docs, labels)).filter("kept").collect()}
    assert {r.doc_id for r in tables[1].collect()} == judged
    voted = {r.doc_id for r in voting.score_quality(tables[1], voting.fit_neighbours(docs, labels)).filter("predicted = 1").collect()}
    assert {r.doc_id for r in tables[2].collect()} == voted
    groups = brute_components([(r.doc_id, r.text) for r in tables[2].collect()])
    assert sorted(r.doc_id for r in tables[3].collect()) == sorted(i for i, c in groups.items() if i == c)
    before = {r.doc_id: r.text for r in tables[3].collect()}
    after = {r.doc_id: r for r in tables[4].collect()}
    assert set(before) == set(after) and all(r.n_chars == len(r.text) for r in after.values())
    assert not any(secret_scan.base_spans(r.text) for r in after.values())
    assert all(after[i].text == t for i, t in before.items() if not re.search("[0-9]{2}|AKIA|[=:]", t))
    assert {r.doc_id for r in tables[5].collect()} == set(after)


def test_odd_rows_pass_every_stage(spark, sf):
    text = "Many plain words stand here in a row so that this short text has more than twenty of them in all, and ends well."
    odd = odd_documents(spark, [(30, text), (30, text), (31, text), (None, text)])
    out = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd.limit(0), sf).count() == 0
        out = written(stage(spark, out, sf), name)
        assert out.dtypes == odd.dtypes
    kept = [r.doc_id for r in out.filter(F.col("text") == text).collect()]
    assert sorted(kept, key=str) == [30, None]
    assert {r.kept for r in out.collect()} == {"kept?"}
    pieces = corpus_pipeline.STAGES[-1][1](spark, out, sf).filter("doc_id is null").collect()
    assert sum(p.length for p in pieces) == pieces[0].doc_tokens


def test_registered():
    from __spark_entry__ import oracle_sql, queries

    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and {"op3_licence_scan", "op8_sharding"} <= set(oracle_sql())


@pytest.mark.parametrize("name", ["op3_licence_scan", "op8_sharding"])
def test_matches_duckdb(spark, sf, name):
    from checks.compare import connect, differences
    from verdigrid.llm import queries

    assert differences(queries.QUERIES[name](spark, sf), connect(sf).execute(queries.ORACLES[name]).df()) is None
