"""Operator 2: alignment against the textbook table; planted exact, edited and partial copies."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridcast.llm import decontaminate as d

words = st.lists(st.integers(2, 6), max_size=9)


def table(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1, j + 1] = max(0, h[i, j] + (d.MATCH if x == y else d.MISMATCH), h[i, j + 1] + d.GAP, h[i + 1, j] + d.GAP)
    return int(h.max())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=6))
def test_alignment_equals_table(pairs):
    best, end = d.align([np.array(a, np.uint64) for a, _ in pairs], [np.array(b, np.uint64) for _, b in pairs])
    for (a, b), s, e in zip(pairs, best.tolist(), end.tolist()):
        assert s == table(a, b) and table(a, b[:e]) == s


def corpus(spark):
    rng = random.Random(4)
    vocab = [f"word{i}" for i in range(900)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(14, 50)))) for i in range(30)] + [(77, None), (78, ""), (80, "zebra quagga")]
    items.append((90, items[0][1].upper() + "."))
    docs, want = [], set()
    for i in range(120):
        item, body = items[i % 30], text(rng.randint(20, 200))
        inner = item[1].split()
        kind = i % 4
        if kind == 1:
            want.add((i, item[0]))
        if kind == 2:
            inner = [w if rng.random() > 0.1 else "changed" for w in inner if rng.random() > 0.05]
            want.add((i, item[0]))
        if kind:
            body = body[:9] + (inner if kind < 3 else inner[:3]) + body[9:]
        docs.append((i, " ".join(body)))
    docs += [(500, "Zebra, quagga!"), (501, None), (502, ""), (None, items[3][1])]
    want |= {(500, 80), (None, 3)}
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), want


def test_planted_copies(spark):
    docs, items, want = corpus(spark)
    for block in (d.BLOCK_WORDS, 200):
        got = d.contaminated(docs, items, block_words=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want  # item 90 equals item 0, also in another block
        assert all(r["n_items"] == 1 + (r["item_id"] == 0) for r in got)
        assert all(r["score"] == 1.0 for r in got if r["doc_id"] is not None and r["doc_id"] % 4 == 1 and r["doc_id"] < 120)
        clean = d.drop_contaminated(docs, items, block_words=block)
        assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - {x for x, _ in want}
    assert {r["n_items"] for r in d.contaminated(docs, items).where("item_id = 0").collect()} == {2}


def test_sf_exact_passages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    plain = {(x["doc_id"], y["item_id"]) for x in docs.collect() for y in items.collect()
             if " ".join(y["text"].split()) in " ".join(x["text"].split())}
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()}
    assert plain <= got and len({x for x, _ in got}) <= len({x for x, _ in plain}) + 5


def test_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "a b c d e f g h i j"), (None, "a b"), (3, None)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in d.contaminated(odd, items).collect()) == [5, 5, 6]
    assert d.contaminated(odd, items.limit(0)).count() == 0 == d.contaminated(odd.limit(0), items).count()
    clean = d.drop_contaminated(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 3
    assert d.drop_contaminated(odd, items.limit(0)).count() == odd.count()


def test_items_without_id_are_dropped(spark):
    rng = random.Random(7)
    item = " ".join(f"secret{rng.randrange(900)}" for _ in range(30))
    docs = spark.createDataFrame([(1, f"some words {item} and more"), (2, "quite other words stand here")], "doc_id long, text string")
    items = spark.createDataFrame([(None, item), (None, None)], "item_id long, text string")
    assert [r["doc_id"] for r in d.drop_contaminated(docs, items).collect()] == [2]


def all_pairs(docs, items):
    """Score of every (document, item) pair that full Smith-Waterman puts at LEAST or above."""
    distinct = {}
    for i, t in sorted(items):
        w = d.Text([(t or "").encode()]).hashes
        if len(w):
            distinct.setdefault(w.tobytes(), (i, w))
    pairs = [(doc, i, a, b) for doc, t in docs for i, b in distinct.values() if len(a := d.Text([(t or "").encode()]).hashes)]
    best, _ = d.align([b for *_, b in pairs], [a for *_, a, _ in pairs])
    return {(doc, i): s / (d.MATCH * len(b)) for (doc, i, _, b), s in zip(pairs, best.tolist()) if s >= d.LEAST * d.MATCH * len(b)}


def test_recall_on_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in d.contaminated(docs, bench).collect()}
    want = all_pairs([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert want and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_recall_of_edited_copies(spark):
    """Items with up to half of their words changed, dropped or added, whole or in part."""
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(1500)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(12, 60)))) for i in range(40)]
    docs = []
    for i in range(400):
        rate, out = rng.random() * 0.5, []
        for w in items[i % 40][1].split():
            x = rng.random()
            out += [] if x < rate / 3 else [rng.choice(vocab)] if x < 2 * rate / 3 else [w, rng.choice(vocab)] if x < rate else [w]
        cut = rng.randint(0, len(out) // 2) if i % 5 == 0 else 0
        body = [rng.choice(vocab) for _ in range(rng.randint(10, 120))]
        docs.append((i, " ".join(body[:8] + out[cut:] + body[8:])))
    want = all_pairs(docs, items)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in d.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got.keys() <= want.keys() and all(got[k] <= want[k] + 1e-9 for k in got)
    recall = len(got) / len(want)
    print(f"recall {recall:.4f} of {len(want)} pairs")
    assert len(want) > 250 and recall >= 0.95
    assert sum(abs(got[k] - want[k]) < 1e-9 for k in got) >= 0.95 * len(got)
