"""The pipeline against brute force, and every registered query against its oracle on the smallest tables."""

import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from gridcast.llm import quality, tokens
from gridcast.llm.oracle import ORACLE
from gridcast.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "embeddings", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_thirteen_operators():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = sorted(map(str, map(tuple, df.collect())))
    if name not in ORACLE:
        assert rows
        return
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    pick = [names.index(c) for c in df.columns]
    assert rows == sorted(str(tuple(r[i] for i in pick)) for r in want.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("source", F.when(F.col("doc_id") > 5, F.col("source")))
    path = None
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        came, path = path, os.path.join(spark.conf.get("spark.checkpoint.dir"), f"test-{name}-{os.getpid()}")
        after.write.mode("overwrite").parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name == "quality_rules":
            good = quality.quality(before).where("kept")
            assert sorted(r[0] for r in good.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())
        if name == "ngram_jaccard_join":
            from gridcast.llm.jaccard import jaccard_components
            groups = jaccard_components(before)
            assert {r[0] for r in docs.select("doc_id").collect()} == {r[0] for r in groups.select("component_id").collect()}
        if name == "benchmark_decontamination":
            gone = {r[0] for r in before.select("doc_id").collect()} - {r[0] for r in docs.select("doc_id").collect()}
            item = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            held = {r["doc_id"] for r in before.collect() if any(x in " ".join(r["text"].split()) for x in item)}
            assert held <= gone and len(gone) <= len(held) + 2
        if name == "source_mixing":  # the operator's SQL over what the stage before kept
            con = duckdb.connect()
            con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{came}/*.parquet')")
            want = sorted(r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLE['op5_mix_sources']})").fetchall())
            assert sorted(r[0] for r in docs.select("doc_id").collect()) == want and len(want) > 100
    last = {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in p.STAGES[-1][1](spark, docs, SF).collect()}
    tok = tokens.WordEncoder(tokens.default_tokenizer()).tok
    for r in docs.select("doc_id", "text").distinct().collect():
        ids = tok.encode(r["text"], add_special_tokens=False).ids + [1]
        assert (r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) in last


def test_run(spark):
    rows = p.run(spark, SF)
    assert rows.count() > 0 and {"doc_id", "start", "n_tokens"} <= set(rows.columns)


def test_stages_take_odd_rows(spark, odd):
    for name, stage in p.STAGES:
        after = stage(spark, odd, SF)
        assert after.count() <= 4 * odd.count(), name
        assert stage(spark, odd.limit(0), SF).count() == 0, name
