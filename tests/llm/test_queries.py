"""Registered queries: SQL where it exists, and the pipeline against brute force."""

import collections
import hashlib

import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck
from test_operators import brute_components, by_text, check_packing

import corpus_pipeline as CP
from rosterline.llm import queries as Q
from rosterline.llm import secrets as SC
from rosterline.llm import toxicity as TX
from rosterline.llm.common import written


def test_all_queries_and_the_pipeline_are_registered():
    import __spark_entry__ as E

    names = {n.split("_")[0] for n in Q.queries()}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in E.queries()
    assert [n for n, _ in CP.STAGES] == ["toxicity", "jaccard_join", "decontamination", "secrets", "packing"]


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_sql(spark, name):
    ok, said = compare(Q.queries()[name](spark, SF_SMALL), duck(SF_SMALL), Q.oracle_sql()[name])
    assert ok, said


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    model = TX.learn(docs, labels)
    for name, stage in CP.STAGES:
        before = docs
        after = written(stage(spark, before, SF_SMALL), f"test-{name}")
        if name != "packing":
            assert after.columns == before.columns
        had = collections.Counter(by_text(before))
        if name == "toxicity" and model is not None:
            bad = {r.doc_id for r in TX.score(before, model).where("predicted = 1").collect()}
            assert collections.Counter(by_text(after)) == collections.Counter({k: v for k, v in had.items() if k[0] not in bad})
        if name == "jaccard_join":
            keep = {c for _, n, c, _ in brute_components(by_text(before), 5, 80) if n}
            assert {i for i, t in by_text(after) if (t or "").split()} == keep
        if name == "decontamination":
            def shingles(t):
                v = (t or "").lower().split()
                return {" ".join(v[k : k + 5]) for k in range(len(v) - 4)} if len(v) >= 5 else ({" ".join(v)} if v else set())

            items = [s for s in map(shingles, bench) if s]
            clean = {k: v for k, v in had.items() if not any(len(shingles(k[1]) & s) >= 0.8 * len(s) for s in items)}
            assert collections.Counter(by_text(after)) == collections.Counter(clean)
        if name == "secrets":
            assert sorted(i for i, _ in by_text(after)) == sorted(i for i, _ in by_text(before))
            assert SC.scan(after).where("spans <> ''").count() == 0
        if name == "packing":
            assert check_packing(after.collect(), by_text(before)) < 0.02
        docs = after


def test_run_equals_its_stages(spark, tmp_path):
    rows = CP.run(spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in CP.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), f"again-{name}")
    key = lambda rs: hashlib.sha256("".join(sorted(f"{r.doc_id}:{r.start}:{r.length}:{r.ids_crc32}" for r in rs)).encode()).hexdigest()
    assert sum(r.length for r in rows) == sum(r.length for r in docs.collect())
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()} and key(rows)
