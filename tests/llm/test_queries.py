"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import normal
from huntspark.llm import simhash
from huntspark.llm.common import table
from huntspark.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations", "embeddings"):
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.collect(), df.columns) == normal(cursor.fetchall(), columns)


@pytest.mark.parametrize("name", ["op1_token_shards", "op2_mix", "op3_token_counts", "op4_simhash", "op6_toxicity", "op12_manifest", "op13_line_dedup"])
def test_one_row_per_document(spark, name):
    ids = sorted(r.doc_id for r in table(spark, SF, "documents").select("doc_id").collect())
    assert sorted(r.doc_id for r in QUERIES[name](spark, SF).collect()) == ids


def test_leaks_are_the_items_that_occur(spark):
    def normal_text(t):
        return " ".join((t or "").lower().split())

    items = {r.item_id: normal_text(r.text) for r in table(spark, SF, "benchmark").collect()}
    docs = {r.doc_id: normal_text(r.text) for r in table(spark, SF, "documents").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op7_leaks"](spark, SF).where("edits = 0").collect()} == want


def test_pipeline_stages(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_output"]
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        ids = {r.doc_id for r in kept.collect()}
        assert ids and ids <= set(before)
        if name != "token_output":
            assert kept.columns == columns
        if name == "near_duplicates":
            texts = [tuple(re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())) for i, t in before.items() if i in ids]
            assert len(texts) == len(set(texts))
        before, docs = {i: t for i, t in before.items() if i in ids}, kept


def test_near_duplicates_by_row(spark):
    """Copies without an id, repeated rows and an id with two texts: one row of each group, no clean text lost."""
    one, two, three = (" ".join(f"{c}{k}" for k in range(30)) for c in "abc")
    rows = [(None, one, "x"), (None, one, "x"), (1, two, "x"), (1, two, "x"), (2, two, "x"), (2, three, "x"), (3, one, "x"), (4, " ", "x"), (4, " ", "x"), (None, None, "x")]
    docs = spark.createDataFrame([(*r, {"a": 1}, 5) for r in rows], "doc_id long, text string, source string, more map<string,int>, fp int")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((tuple(r)[:3] for r in kept.collect()), key=repr) == sorted([(3, one, "x"), (1, two, "x"), (2, three, "x"), (4, " ", "x")], key=repr)


def test_near_duplicates_against_all_pairs(spark):
    """The stage keeps the smallest doc_id of each component of fingerprints that differ in at most three bits."""
    docs = table(spark, SF, "documents")
    prints = {r.doc_id: simhash.fingerprint(r.text, 3) for r in docs.collect()}
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= 3:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()} == {top(i) for i in ids}


def test_toxicity_stage_keeps_a_column_named_score(spark):
    docs = table(spark, SF, "documents").withColumn("score", F.lit(42))
    out = corpus_pipeline.toxicity(spark, docs, SF)
    assert out.columns == docs.columns and out.where("score <> 42").count() == 0 and out.count() > 0


def test_pipeline_of_nothing(spark):
    empty = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == [], name
