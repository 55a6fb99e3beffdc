"""The registered queries against SQL, and the pipeline against its stages done by hand."""

import os
import zlib

import duckdb
import pytest

from candlewick.llm.registry import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.execute(ORACLE_SQL[name])
    order = [c[0] for c in want.description]
    assert set(got.columns) == set(order)
    assert sorted(map(repr, (tuple(r) for r in got.select(order).collect()))) == sorted(map(repr, want.fetchall()))


def test_others_return_every_document(spark, duck):
    n = duck.execute("SELECT count(*) FROM documents").fetchall()[0][0]
    for name in ("op3_sentencepiece", "op4_quality_classifier", "op6_license_scan", "op7_quality_rules"):
        rows = QUERIES[name](spark, SF_DIR).collect()
        assert len({r.doc_id for r in rows}) == len(rows) == n
        if name.startswith("op3"):
            assert all(r.round_trip for r in rows)
        if name.startswith("op4"):
            assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from test_join import classes
    from test_substrings import by_words as removed

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.staged(stage(spark, docs, SF_DIR), name)
        if name == "packing":
            break
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        kept[name] = len(after)
        if name == "near_duplicates":
            assert set(after) == {i for i, c in classes([(i, r.text) for i, r in before.items()], corpus_pipeline.PERCENT, corpus_pipeline.SHINGLE).items() if i == c[1]}
        if name == "substring_dedup":
            want = removed([(i, r.text) for i, r in before.items()], 50)
            for i, r in after.items():
                assert r.text == (want[i][2] if want[i][1] else before[i].text) and (not want[i][1] or r.n_chars == len(r.text))
        else:
            assert all(before[i] == r for i, r in after.items())
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(after)
    assert kept["quality_classifier"] > kept["quality_rules"] >= kept["near_duplicates"] == kept["substring_dedup"] > 0
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    good = [i for i, q in label.items() if q == 1]
    scored = {r.doc_id: r.predicted for r in QUERIES["op4_quality_classifier"](spark, SF_DIR).collect()}
    assert sum(scored[i] for i in good) >= 0.99 * len(good)
