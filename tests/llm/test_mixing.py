"""Operator 5 against a plain allocation and plain seeded prefixes."""

import hashlib

from pyspark.sql import functions as F

from gridcast.llm import mixing as m


def split(budget, children):
    """children: {name: (weight, cap)}; floors after the children that fill up, as the operator states."""
    given, left, rest = {}, budget, sum(w for w, _ in children.values())
    order = sorted(children.items(), key=lambda x: (x[1][1] / x[1][0] if x[1][0] else float("inf"), x[0]))
    while order:
        name, (w, cap) = order[0]
        if left * w < cap * rest:
            return given | {n: left * w // rest if rest else 0 for n, (w, _) in order}
        given[name] = cap
        left, rest, order = left - cap, rest - w, order[1:]
    return given


def test_share_leaves_shortage_to_siblings_first(spark):
    rows = [("d0", "en", "a", 10), ("d0", "en", "b", 1000), ("d0", "de", "c", 500), ("d1", "en", "d", 30), ("d2", "fr", "e", 4000), ("d3", "fr", "f", 0)]
    weights = {"d0": 5, "d1": 5, "d2": 1, "d3": 0}
    got = {r["source"]: r["given"] for r in m.allocate(spark.createDataFrame(rows, "domain string, lang string, source string, tokens long"),
                                                      50, 2, weights, {"en": 3}, {"a": 9}).collect()}
    total = sum(r[3] for r in rows) * 50 // 100
    domains = split(total, {d: (weights[d], 2 * sum(r[3] for r in rows if r[0] == d)) for d in weights})
    langs = split(domains["d0"], {"en": (3, 2020), "de": (1, 1000)})
    sources = split(langs["en"], {"a": (9, 20), "b": (1, 2000)})
    assert got == {"a": sources["a"], "b": sources["b"], "c": langs["de"], "d": domains["d1"], "e": domains["d2"], "f": 0}
    assert got["a"] == 20 and got["d"] == 60 and sum(got.values()) <= total


def plain(rows, plan, seed):
    out = []
    for leaf, given in plan.items():
        own = [(d, len(t.split())) for d, t, s in rows if s == leaf]
        tokens = sum(n for _, n in own)
        full = given // tokens if tokens else 0
        out += [(d, e) for d, _ in own for e in range(full)]
        room, groups = given - full * tokens if tokens else 0, {}
        for d, n in own:
            groups.setdefault(hashlib.md5(f"{seed}:{full}:{'' if d is None else d}".encode()).hexdigest(), []).append((d, n))
        if not room:
            continue
        for k in sorted(groups):
            room -= sum(n for _, n in groups[k])
            if room < 0:
                break
            out += [(d, full) for d, _ in groups[k]]
    return sorted(out, key=str)


def test_prefixes_of_seeded_epochs(spark, monkeypatch):
    rows = [(i, "w " * (i % 7 + 1), "ab"[i % 5 > 0]) for i in range(200)] + [(None, "x y", "a"), (3, "again", "a"), (900, "", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("lang", F.lit("en")).withColumn("epoch", F.lit("x"))
    tokens = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in "ab"}
    given = split(sum(tokens.values()) * 110 // 100, {s: ({"a": 3, "b": 1}[s], 3 * n) for s, n in tokens.items()})
    for leaves in (m.MAX_BROADCAST_LEAVES, 0):
        monkeypatch.setattr(m, "MAX_BROADCAST_LEAVES", leaves)
        got, names = m.mix(df, F.lit("d"), budget_percent=110, max_epochs=3, seed=5, source_weights={"a": 3})
        assert got.columns[:len(df.columns)] == df.columns
        assert sorted(((r["doc_id"], r[names["epoch"]]) for r in got.collect()), key=str) == plain(rows, given, 5)


def test_odd_rows(odd):
    got, names = m.mix_documents(odd)
    assert set(odd.columns) <= set(got.columns) and len(set(names.values())) == len(names)
    assert got.count() > 0
    assert m.mix_documents(odd.limit(0))[0].count() == 0
