"""The queries against their SQL, and the pipeline against its stages' rules."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cabinlens.llm import dart_minhash, decontaminate, language_id, line_dedup, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name]).df()
    got = queries.QUERIES[name](spark, sf).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    assert sorted(map(str, got[cols].itertuples(index=False, name=None))) == sorted(map(str, want[cols].itertuples(index=False, name=None)))


def test_all_operators_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, sf).cache()
        assert out.columns == docs.columns, name
        if name == "language_id":
            assert out.count() == language_id.identify(seen).where("lang_pred <> 'und' AND score >= 0.5").count()
        elif name == "line_dedup":
            cut = line_dedup.line_dedup(seen.select("doc_id", "text")).where("n_removed = 0 OR n_removed < n_lines")
            assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted((r.doc_id, r.text) for r in cut.collect())
            assert out.where("n_chars <> length(text)").count() == 0
        elif name == "minhash_near_dedup":
            groups = dart_minhash.near_duplicates(seen).collect()
            assert sorted(r.doc_id for r in out.collect()) == sorted({r.class_id for r in groups})
        else:
            items = spark.read.parquet(f"{sf}/benchmark.parquet")
            clean = decontaminate.contamination(seen, items).where("NOT contaminated")
            assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in clean.collect())
        seen = out
    last = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, seen, sf).collect()}
    for r in seen.collect():
        assert last[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
        assert last[r.doc_id].n_tokens == len(last[r.doc_id].token_ids)


def test_odd_rows_pass_through(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, "the of and in that is to be with", None, None, None), (5000, None, "en", "s", 1), (5001, "", "en", "s", 0)], docs.schema)
    rows = docs.unionAll(odd).unionAll(docs.limit(3))
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, rows, sf).count() > 0, name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name
