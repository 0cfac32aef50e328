"""Operator 8: neighbours equal a full comparison; held-out quality on labelled documents."""

import random

import numpy as np
from pyspark.sql import functions as F

from gridcast.llm import toxicity as x
from gridcast.llm.common import Words


def examples(n=150):
    rng = random.Random(2)
    bad, plain = [f"bad{i}" for i in range(8)], [f"w{i}" for i in range(300)]
    texts, label = [], []
    for i in range(n):
        y = i % 3 == 0
        words = [rng.choice(plain) for _ in range(30)] + [rng.choice(bad) for _ in range(rng.randint(1, 6) if y else 0)]
        rng.shuffle(words)
        texts.append(" ".join(words).encode())
        label.append(int(y))
    return x.Examples(list(range(n)), texts, np.array(label), (200, 100)), texts


def test_neighbours_are_exact(monkeypatch):
    monkeypatch.setattr(x, "BLOCK", 8)
    monkeypatch.setattr(x, "NEIGHBOURS", 5)
    model, texts = examples()
    assert set(model.term_of) <= {f"bad{i}" for i in range(8)} and len(model.term_of) >= 6
    doc, term, count = x.term_counts(Words(texts), model.term_of)
    weight = model._unit(doc, term, count, len(texts))
    dense = np.zeros((len(texts), len(model.term_of)))
    dense[doc, term] = weight
    for i in range(len(texts)):
        cosine = np.round(dense @ dense[i], 12)
        want = [k for k in np.lexsort((np.arange(len(texts)), -cosine)).tolist() if cosine[k] > 0][:5]
        near, cos = model.nearest(term[doc == i], weight[doc == i])
        near = model.rank[near]
        assert np.allclose(cos, cosine[want]) and set(near[cos > cos[-1] + 1e-9] if len(cos) else []) <= set(want)


def test_scores_tell_classes_apart():
    model, texts = examples()
    got, evidence = model.scores([b"w1 w2 w3", b"w1 bad1 w2 bad2, BAD3!", b""])
    assert got[1] > 0.5 > got[0] == got[2] and evidence[1] and not evidence[0]
    assert all(a <= b for a, b in zip(model.values, model.values[1:]))


def test_copies_do_not_make_words_suspicious():
    text = " ".join(f"q{i}" for i in range(40)).encode()
    other = [" ".join(f"r{i * 40 + j}" for j in range(30)).encode() for i in range(40)]
    assert x.choose_terms([text] * 20 + other, np.array([1] * 20 + [0] * 40)) == []


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = x.score_documents(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).where(held).join(labels, "doc_id")
    right, caught, said, toxic = got.agg(
        F.sum((F.col("toxic") == F.col("predicted")).cast("int")), F.sum(F.col("toxic") * F.col("predicted")),
        F.sum("predicted"), F.sum("toxic")).first()
    assert right / got.count() > 0.95 and caught / toxic > 0.8 and caught / said > 0.85


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 0, 1), (5, 1, 0), (5, 1, 0), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = x.score_documents(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in x.score_documents(odd, labels.limit(0)).collect()} == {0.0}
    assert x.score_documents(odd.limit(0), labels).count() == 0


def test_no_term_is_left_out(monkeypatch):
    monkeypatch.setattr(x, "BLOCK", 8)
    _, texts = examples()
    label = np.array([int(i % 3 == 0) for i in range(len(texts))])
    model = x.Examples(list(range(len(texts))), texts, label, (200, 100), x.REST)
    assert set(model.term_of) == {w.decode() for t in texts for w in t.split()}
    doc, term, count = x.term_counts(Words(texts), model.term_of)
    weight = model._unit(doc, term, count, len(texts))
    dense = np.zeros((len(texts), len(model.term_of)))
    dense[doc, term] = weight
    for i in range(len(texts)):
        cosine = np.round(dense @ dense[i], 12)
        cosine[i] = 0
        want = [k for k in np.lexsort((np.arange(len(texts)), -cosine)).tolist() if cosine[k] > 0][:x.NEIGHBOURS]
        near, cos = model.nearest(term[doc == i], weight[doc == i], int(np.flatnonzero(model.rank == i)[0]))
        near = model.rank[near]
        assert np.allclose(cos, cosine[want]) and set(near[cos > cos[-1] + 1e-9]) <= set(want)


def test_broad_toxic_vocabulary():
    texts = []
    for t in range(260):  # more listed terms than 256, each in a few texts
        texts += [f"bad{t} x{t}y{k} z{t}y{k}".encode() for k in range(10)]
    texts += [f"good{k % 50} v{k} u{k}".encode() for k in range(5000)]
    label = np.array([1] * 2600 + [0] * 5000)
    assert {f"bad{t}" for t in range(260)} == set(x.choose_terms(texts, label))
    model = x.Examples(list(range(len(texts))), texts, label, (5000, 2600), x.REST)
    got, evidence = model.scores([f"bad{t} new{t}".encode() for t in range(260)] + [b"x5y1 z5y1", b"good3 other", b"unseen"])
    assert (got[:261] > 0.5).all() and got[261] < 0.5 and all(evidence[:262]) and not evidence[262]


def test_fit_keeps_all_terms(spark):
    docs = spark.createDataFrame([(i, f"w{i} common") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    assert set(x.fit(docs, labels).term_of) == {"common", *(f"w{i}" for i in range(20))}


def test_examples_are_bounded_rows(spark):
    """An id with a third of all rows, repeated rows, null ids: the sample is bounded in rows and characters."""
    rows = [(1, f"hot text {i}") for i in range(300)] + [(2, "same")] * 300 + [(i, f"w{i} " * 5) for i in range(3, 300)] + [(None, "lost"), (500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i < 3)) for i in range(600)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = x.fit(docs, labels, max_per_class=50)
    assert len(model.ids) == 100 and model.label.sum() == 50 and model.ids.count(2) <= 1 and None not in model.ids
    assert len(x.fit(docs, labels, max_per_class=50, max_chars=60).ids) < 20
    again = x.fit(docs.repartition(7), labels, max_per_class=50)
    assert again.ids == model.ids and (again.post_weight == model.post_weight).all()


def test_rest_by_folds():
    _, texts = examples()
    label = np.array([int(i % 3 == 0) for i in range(len(texts))])
    loss = x.cross_validate(texts, label, [0.1, 1.0])
    assert loss[0.1] < loss[1.0] < 1.0


def test_order_of_examples_changes_nothing(monkeypatch):
    model, texts = examples()
    monkeypatch.setattr(x, "near_together", lambda doc, term, weight, n: np.arange(n)[::-1])
    other, _ = examples()
    for t in texts[:40] + [b"bad1 w3", b"w5 w9"]:
        assert np.allclose(model.scores([t])[0], other.scores([t])[0]) and model.scores([t])[1] == other.scores([t])[1]
