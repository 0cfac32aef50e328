"""Operator 3 against a brute-force version."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from gridcast.llm import substrings as s


def brute(rows, n):
    seen, gone = {}, [set() for _ in rows]
    words = [(t or "").encode().split() for _, t in rows]
    places = sorted(((d if d is not None else -1), i, r) for r, (d, _) in enumerate(rows) for i in range(len(words[r]) - n + 1))
    for d, i, r in places:
        key = tuple(words[r][i:i + n])
        if seen.setdefault(key, (d, i)) < (d, i):
            gone[r].update(range(i, i + n))
    return sorted((str(d), len(w), len(g), b" ".join(x for i, x in enumerate(w) if i not in g).decode())
                  for (d, _), w, g in zip(rows, words, gone))


def corpus(seed):
    rng = random.Random(seed)
    passage = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(30)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passage) if rng.random() < 0.5 else " ".join(rng.choice("xyz") + str(rng.randrange(30)) for _ in range(rng.randint(0, 30)))
                 for _ in range(rng.randint(0, 4))]
        rows.append((i * 7 % 61, " \n".join(parts)))
    return rows + [(5, rows[3][1]), (None, passage[0]), (None, None), (200, ""), (201, passage[0] + " " + passage[0]), (201, passage[1])]


def test_equal_to_brute_force(spark, monkeypatch):
    rows = corpus(1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for window, m, bucket in ((20, 3, 400_000), (8, 3, 200), (5, 2, 50)):
        got = sorted((str(r[0]), r[1], r[2], r[3]) for r in s.dedup_substrings(df, window=window, m=m, bucket_windows=bucket).collect())
        assert got == brute(rows, window)


def test_equal_hashes_of_different_windows():
    from gridcast.llm.common import Words
    words = Words([b"a b c d a b c d", b"a b c d x y z w"])
    at = words.window_starts(4)
    which = words.doc_of()[at]
    flat = s._repeats(words, at, np.zeros(len(at), np.uint64), which, at - words.starts[which], 4)
    assert flat.tolist() == [False, False, False, False, True, True, False, False, False, False]


def test_words_are_hashed_without_a_vocabulary(monkeypatch):
    from gridcast.llm.common import Words
    texts = [b"", b" \t", b"a b\x0ba\x00  long-" + b"x" * 58 + b" " + b"y" * 64 + b"\r\n" + b"y" * 65, "b \u00a0 \x1c a".encode(), b" a"]
    flat = [w for t in texts for w in t.split()]
    words = Words(texts)
    assert words.flat == flat and [words.vocab[i] for i in words.ids] == flat
    assert words.starts.tolist() == [0, *np.cumsum([len(t.split()) for t in texts]).tolist()]
    assert [words.line[a:b - 1] for a, b in zip(words.place, words.place[1:])] == flat
    of = dict(zip(flat, words.quick.tolist()))
    assert [of[w] for w in flat] == words.quick.tolist() and len(set(of.values())) == len(of)
    monkeypatch.setattr(Words, "_coded", property(lambda self: 1 / 0))  # the vocabulary cost half of the operator's time
    again = Words([b"a b c d e f", b"x b c d e f"])
    at = again.window_starts(5)
    which = again.doc_of()[at]
    from gridcast.llm.common import rolling
    got = s._repeats(again, at, rolling(again.quick, 5)[at], which, at - again.starts[which], 5)
    assert got.tolist() == [False, False, False, True]


def test_odd_rows(odd):
    got = s.digest(s.dedup_substrings(odd)).collect()
    assert len(got) == odd.count()
    assert s.dedup_substrings(odd.limit(0)).count() == 0


def crc_twins(n=30_000):
    """Two texts of different lengths with one crc32."""
    seen = {}
    rng = random.Random(9)
    while True:
        words = [f"t{rng.randrange(10**9)}" for _ in range(rng.choice((3, 30)))]
        text = " ".join(words)
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        if len(other.split()) != len(words):
            return other, text


def test_texts_of_one_id_that_share_a_crc(spark):
    a, b = crc_twins()
    assert zlib.crc32(a.encode()) == zlib.crc32(b.encode())
    long = a if len(a.split()) == 30 else b
    for doc in (7, None):
        rows = [(doc, a), (doc, b), (doc, b), (90, long + " tail words"), (3, "x y"), (doc, None), (doc, "")]
        rows += [(-5, long)] if doc is not None else []
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        got = sorted((str(r[0]), r[1], r[2], r[3]) for r in s.dedup_substrings(df).collect())
        assert got == brute(rows, 20)


def test_key_columns_equal_those_of_tasks(spark):
    texts = ["", "a", "é 😀", "x" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [tuple(r) for r in df.select(*s.key_columns(F.col("text"))).collect()]
    assert got == list(zip(*(k.tolist() for k in s.text_keys([t.encode() for t in texts]))))
