"""Operator 6: code lengths equal a byte-by-byte model; held-out accuracy."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gridcast.llm import ppm

TRAIN = {"aa": [b"the cat sat on the mat", b"the hat", b""], "bb": ["le chat é".encode(), b"la souris"], "cc": [b"x"]}


def brute(lang, text):
    count = [Counter() for _ in range(4)]
    for t in TRAIN[lang]:
        y = ppm.START + t
        for i in range(3, len(y)):
            for k in range(4):
                count[k][(y[i - k:i], y[i])] += 1
    total, kinds = [Counter() for _ in range(4)], [Counter() for _ in range(4)]
    for k in range(4):
        for (c, _), n in count[k].items():
            total[k][c] += n
            kinds[k][c] += 1
    y, bits = ppm.START + text, 0.0
    for i in range(3, len(y)):
        for k in range(3, -1, -1):
            c = y[i - k:i]
            if not total[k][c]:
                continue
            n = count[k][(c, y[i])]
            bits -= math.log2((n or kinds[k][c]) / (total[k][c] + kinds[k][c]))
            if n:
                break
        else:
            bits += 8
    return bits


def test_code_lengths(monkeypatch):
    trees = ppm.Trees(TRAIN)
    texts = [b"", b"the cat", "né\x00ÿ chat".encode(), b"zzz the the", b"x" * 50]
    want = np.array([[brute(g, t) for g in trees.langs] for t in texts])
    assert np.abs(trees.lengths(texts) - want).max() < 1e-3
    monkeypatch.setattr(ppm, "PIECE", 7)
    assert np.abs(trees.lengths(texts) - want).max() < 1e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = ppm.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n > 0.98
    assert got.where("score < 0 or score > 1").isEmpty()


def test_odd_rows(odd):
    got = ppm.predict_languages(odd).collect()
    assert len(got) == odd.count()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {"und"}
    none = ppm.predict_languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    assert ppm.predict_languages(odd.limit(0)).count() == 0


def test_sample_is_bounded_rows(spark):
    rows = [(1, f"hot text {i}", "en") for i in range(400)] + [(None, f"kein id {i}", "de") for i in range(50)] + [(3, "le meme texte", "fr")] * 500
    rows += [(4, "x" * 5000, "fr"), (5, None, "en"), (6, "no language", None), (7, "rare", "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = ppm.sample(docs, "doc_id", "text", "lang", max_docs=30, max_chars=2000)
    assert {g: len(t) for g, t in got.items()} == {"en": 30, "de": 30, "fr": 1, "zz": 1}
    assert got == ppm.sample(docs.repartition(5), "doc_id", "text", "lang", max_docs=30, max_chars=2000)
    assert sum(map(len, ppm.sample(docs, "doc_id", "text", "lang", max_docs=30, max_chars=100)["en"])) <= 100
    assert set(ppm.sample(docs, "doc_id", "text", "lang", max_langs=2)) == {"fr", "en"}
    assert ppm.sample(docs.limit(0), "doc_id", "text", "lang") == {}
