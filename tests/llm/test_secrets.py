"""Operator 9 against Python's re."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridcast.llm import secrets as s

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX, GENERIC = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+"), re.compile("[A-Za-z0-9+/_=-]{20,}")


def base(text):
    out = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return out + [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text) if len(m[0]) >= 24]


def brute(rows):
    spans = [base(t or "") for _, t, _ in rows]
    extra = [[(m.start(), 3, m.end(), m[0]) for m in GENERIC.finditer(t or "") if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])]
             for _, t, _ in rows]
    owners, held = {}, {}
    for (d, _, o), a, b in zip(rows, spans, extra):
        for x in a + b:
            owners.setdefault(x[3], set()).add(o or "")
            held.setdefault(x[3], set()).add((o or "", d))
    names, out = ["assign", "access", "hex", "generic"], []
    for (d, _, _), a, b in zip(rows, spans, extra):
        free = [x for x in b if len(owners[x[3]]) <= 2 and (len(owners[x[3]]) == 1 or len(held[x[3]]) <= 20) and all(y[2] <= x[0] or y[0] >= x[2] for y in a)]
        said = lambda z: ",".join(f"{names[k]}:{i}:{j}" for i, k, j, _ in sorted(z))
        out.append((str(d), *(sum(x[1] == k for x in a) for k in range(3)), hashlib.sha256(said(a).encode()).hexdigest(), said(a + free)))
    return sorted(out)


def check(spark, rows):
    got = s.secrets(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted((str(r[0]), *r[1:6]) for r in got.collect()) == brute(rows)


def test_planted(spark):
    key, h = "AKIA" + "B7" * 9, "0123456789abcdef" * 3
    live = "Zx9" * 8
    texts = [f"é😀 password = 'hunter22' {key}", f"Token:{h} and {h[:23]}", f"secret==abc api-key: x apikey=abcdef_{h}", f"{live} {live}", None, "",
             f"API_KEY\" : \"{'a1' * 12}", "passwd: short", f"{h}{h} {key}9", "PASSWORD=token=secret=value99", f"x{live}"]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)] + [(50 + i, f"copied {'Ex4' * 9}", f"s{i}") for i in range(4)]
    rows += [(100 + i, f"one owner {'Ow5' * 9}", "s9") for i in range(25)]  # live however many repositories
    rows += [(200 + i, f"two owners {'Tw6' * 9} or {'Fe7' * 9 if i < 20 else ''}", f"s{i % 2}") for i in range(21)]
    check(spark, rows + [(None, texts[0], None), rows[0]])


def test_random_mixtures(spark):
    pieces = ["password", "=", ":", " ", "'", "\"", "token", "AKIA", "Q7", "a1b2c3d4", "é", "\n", "api_key", "deadbeef0123", "/", "."]
    texts = []

    @settings(max_examples=150, deadline=None, database=None, derandomize=True)
    @given(st.lists(st.sampled_from(pieces), max_size=30))
    def collect(parts):
        texts.append("".join(parts))

    collect()
    check(spark, [(i, t, f"s{i % 5}") for i, t in enumerate(texts)])


def test_odd_rows(odd):
    got = s.secrets(odd).collect()
    assert len(got) == odd.count() and {r["spans"] for r in got} == {""}
    assert s.secrets(odd.limit(0)).count() == 0


def test_plan_has_no_python(spark, odd):
    plan = s.secrets(odd.withColumn("owner", F.lit("x")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
