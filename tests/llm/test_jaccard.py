"""Operator 7 against all pairs, with blocks and lists small enough to be cut."""

import random

import numpy as np
import pytest

from gridcast.llm import common, components
from gridcast.llm import jaccard as j


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    least = {k: min((d for d in g if d is not None), default=None) for k, g in groups.items()}
    return [(d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))], len(set(map(find, range(len(rows)))))


def corpus(seed, n=200):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(3, 80))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base[:rng.choice([1, 8])]))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        text = " ".join(words + [rng.choice(vocab) for _ in range(rng.choice([0, 0, 4]))])
        rows.append((i * 3 % 191, text.upper() if rng.random() < 0.2 else text))
    return rows + [(None, None), (900, ""), (901, "a b"), (902, "A  b"), (None, rows[0][1])]


@pytest.mark.parametrize("block,length,short", [(400_000, 256, 8), (150, 3, 2)])
def test_components_equal_all_pairs(spark, monkeypatch, block, length, short):
    monkeypatch.setattr(j, "LIST", length)
    monkeypatch.setattr(j, "SHORT", short)
    monkeypatch.setattr(common, "ARROW_ROWS", 7)
    rows = corpus(length)
    want, _ = brute(rows)
    got = [tuple(r) for r in j.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), block_shingles=block).collect()]
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_keep_one(spark, odd):
    rows = corpus(3, 60)
    _, groups = brute([r for r in rows if shingles(r[1])])
    kept = j.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert kept.count() == groups + sum(not shingles(t) for _, t in rows)
    assert j.keep_one(odd).columns == odd.columns
    assert j.keep_one(odd.limit(0)).count() == 0
    assert j.jaccard_components(odd.limit(0)).count() == 0


def test_index_search_is_exact():
    rng = random.Random(1)
    import numpy as np
    sets = [np.array(sorted(rng.sample(range(40), rng.randint(1, 30))), np.uint64) for _ in range(120)]
    index = j.Index(sets)
    for q in range(len(sets)):
        a = set(sets[q].tolist())
        want = [r for r in range(len(sets)) if r != q and 100 * len(a & set(sets[r].tolist())) >= 80 * len(a | set(sets[r].tolist()))]
        assert sorted(index.search(q, lambda r: False)) == want


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 501), (501, 502), (502, 500)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 500: 500, 501: 500, 502: 500}


@pytest.mark.parametrize("block,length,short", [(400_000, 256, 8), (10, 3, 2)])
def test_sets_of_four_link_to_sets_of_five(spark, monkeypatch, block, length, short):
    monkeypatch.setattr(j, "LIST", length)
    monkeypatch.setattr(j, "SHORT", short)
    rows, doc = [], iter(range(1000))
    for g in range(12):
        w = [f"g{g}x{i}" for i in range(10)]
        rows.append((next(doc), " ".join(w[:8])))  # four shingles, in five with the next one
        rows.append((next(doc), " ".join(w[:9])))
        v = [f"h{g}x{i}" for i in range(10)]  # a chain: nine words, the eight inside, nine
        rows += [(next(doc), " ".join(v[:9])), (next(doc), " ".join(v[1:9])), (next(doc), " ".join(v[1:10]))]
        u = [f"k{g}x{i}" for i in range(8)]  # three in four shingles do not link
        rows += [(next(doc), " ".join(u[:7])), (next(doc), " ".join(u))]
    common = [f"c{i}" for i in range(8)]  # one passage in many documents, with a word more at either end
    rows += [(next(doc), " ".join(common))]
    rows += [(next(doc), " ".join([f"a{i}", *common] if i % 2 else [*common, f"a{i}"])) for i in range(30)]
    want, groups = brute(rows)
    got = [tuple(r) for r in j.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), block_shingles=block).collect()]
    assert sorted(got) == sorted(want)
    assert groups == 12 * 4 + 1
    assert j.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), block_shingles=block).count() == groups


def test_bitmaps_never_drop_a_link():
    rng = np.random.default_rng(7)
    for _ in range(40):
        sets = []
        for _ in range(12):
            base = rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64)
            for _ in range(rng.integers(1, 4)):
                kept = base[rng.random(len(base)) > rng.choice([0, 0.05, 0.2, 0.6])]
                sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, rng.integers(0, 30)).astype(np.uint64)])))
        sets = [s for s in sets if len(s)]
        got = j.may_link(np.array([len(s) for s in sets]), [j.bitmap(s) for s in sets])
        for a, x in enumerate(sets):
            linked = any(a != b and 100 * (k := len(np.intersect1d(x, y))) >= 80 * (len(x) + len(y) - k) for b, y in enumerate(sets))
            assert got[a] or not linked


def test_bitmaps_drop_sets_that_share_a_passage():
    rng = np.random.default_rng(8)
    passage = rng.integers(0, 1 << 63, 46).astype(np.uint64)
    sets = [np.unique(np.concatenate([passage, rng.integers(0, 1 << 63, 250).astype(np.uint64)])) for _ in range(100)]
    sets += [np.append(sets[0][5:], np.uint64(1)), sets[1]]
    got = j.may_link(np.array([len(s) for s in sets]), [j.bitmap(s) for s in sets])
    assert sorted(np.flatnonzero(got).tolist()) == [0, 1, 100, 101]


def test_packed_slots_come_back():
    rng = np.random.default_rng(9)
    width = j.SLOTS // j.RANGES
    for n in (0, 1, 50, 100_000):
        slots = np.sort(rng.integers(0, j.SLOTS, n).astype(np.uint32))
        slots = np.sort(np.concatenate([slots, slots[::3], np.array([0, 254, 255, 256, width - 1, width, j.SLOTS - 1], np.uint32)]))
        used, blobs = j._packed(slots)
        assert np.array_equal(np.concatenate([r * width + j._unpacked(b) for r, b in zip(used, blobs)]), slots)


def test_sketch_tells_passages_of_a_large_corpus(spark):
    import pyarrow as pa
    rng = np.random.default_rng(10)
    passages = rng.integers(0, j.SLOTS, 100).astype(np.uint32)  # 80 times among 24 million shingles
    packs = [j._packed(np.sort(np.concatenate([rng.integers(0, j.SLOTS, 2_000_000).astype(np.uint32), np.repeat(passages, 8 if i < 8 else 4)]))) for i in range(12)]
    table = pa.table({"slot": pa.array([r for used, _ in packs for r in used], pa.int32()), "bits": pa.array([b for _, blobs in packs for b in blobs], pa.binary())})
    levels = j._levels(spark.createDataFrame(table), 24_000_000)
    assert (levels[passages & (len(levels) - 1)] > 0).all()
    assert (levels > 0).mean() < 0.01
    assert levels.max() < j.HOT


def test_order_does_not_change_components(spark, monkeypatch):
    monkeypatch.setattr(j, "RARE", 2)  # frequent from 2 on, hot from 8 on
    monkeypatch.setattr(j, "PACKED", 50)
    rows = corpus(12, 120)
    want, _ = brute(rows)
    got = [tuple(r) for r in j.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), block_shingles=900).collect()]
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_index_search_is_exact_with_lists_outside_the_matrix():
    rng = np.random.default_rng(11)
    every = rng.integers(0, 1 << 63, 30).astype(np.uint64)
    sets = []
    for g in range(150):
        base = rng.integers(0, 1 << 63, 40).astype(np.uint64)
        for _ in range(3):
            kept = np.concatenate([base, every[:10 * (g % 4)]])
            sets.append(np.unique(np.concatenate([kept[rng.random(len(kept)) > 0.08], rng.integers(0, 1 << 63, 2).astype(np.uint64)])))
    index = j.Index(sets)
    assert 0 < (index.column >= 0).sum() < (np.diff(index.begin) > 1).sum()
    near = 0
    for q in range(len(sets)):
        want = [r for r in range(len(sets)) if r != q and 100 * (k := len(np.intersect1d(sets[q], sets[r], True))) >= 80 * (len(sets[q]) + len(sets[r]) - k)]
        assert sorted(index.search(q, lambda r: False)) == want
        assert index.search(q, lambda r: True) == []
        near += len(want)
    assert near


def test_block_of_copies_on_the_brink_takes_little_time():
    import time
    rng = np.random.default_rng(12)
    base, sets = rng.integers(0, 1 << 63, 400).astype(np.uint64), []
    for _ in range(900):  # edited so much that most pairs do not link
        kept = base[rng.random(400) > rng.choice([0.06, 0.16])]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, 400 - len(kept)).astype(np.uint64)])))
    began = time.process_time()
    _, known = j.block_links(sets, [])
    assert time.process_time() - began < 4  # 22 s by binary probes alone
    assert 300 < len({known.find(i) for i in range(900)}) < 600
