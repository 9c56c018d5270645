"""The corpus pipeline stage by stage against the operators, and the registered queries."""

import numpy as np
import public_tokenizers
import pytest
from llm_cases import SF, same
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from medalake.llm import bradley_terry, secrets_scan, simhash
from medalake.llm.common import saved


def test_pipeline_stages(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "simhash_near_dedup",
                                                      "secret_scan", "packing"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    at = docs
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        at = saved(stage(spark, at, SF), spark, f"test-{name}")
        outs.append(at)
    classed, ruled, single, clean, pieces = outs
    for df in outs[:-1]:
        assert df.schema.fieldNames() == docs.schema.fieldNames()
    good = {r.doc_id for r in bradley_terry.score(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in classed.collect()} == good
    assert ruled.join(classed, "doc_id", "left_anti").count() == 0 and ruled.count() > 0
    groups = simhash.near_duplicates(spark, ruled).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups}
    before = {r.doc_id: r.text for r in single.collect()}
    for r in clean.collect():
        assert r.text == secrets_scan.redacted(before[r.doc_id], secrets_scan.scan_layers(before[r.doc_id])[1])
        assert r.n_chars == len(r.text)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean.collect())
    assert sum(p.length for p in pieces.collect()) == total
    assert same(corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect(),
                pieces.select("doc_id", "start", "length", "ids_crc32").collect())


def test_all_queries_are_registered(spark):
    found = __spark_entry__.queries()
    assert sorted(n.split("_")[0] for n in found if n.startswith("op")) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in found


def test_quality_rules_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(__spark_entry__.oracle_sql()["op1_quality_rules"]).fetchall()
    got = __spark_entry__.queries()["op1_quality_rules"](spark, SF)
    assert same(got.collect(), want)


def test_results_do_not_depend_on_the_partitions(spark, docs):
    a = simhash.near_duplicates(spark, docs.repartition(1)).collect()
    b = simhash.near_duplicates(spark, docs.repartition(7)).collect()
    assert same(a, b) and np.all([r.component_id <= r.doc_id for r in a])
