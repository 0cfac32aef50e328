"""Operator 10 against a brute-force version."""

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from gridcast.llm import quality as q


def brute(text: str) -> dict:
    words = [w.decode() for w in text.encode().split()]
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    lines = [x for x in text.encode().split(b"\n") if x.strip()]
    late = [x for i, x in enumerate(lines) if x in lines[:i]]
    out["n_dup_lines"] = len(late)
    out["dup_line_chars"] = sum(len(w.decode()) for x in late for w in x.split())
    for n in q.NGRAM_PERCENT:
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        count = Counter(grams)
        inside = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + n)}
        out[f"dup_{n}gram_chars"] = sum(len(words[j]) for j in inside)
        if n == 5:
            out["n_repeat_words"] = len(inside)
    out["base_failed"] = len(words) < 10 or 100 * out["n_repeat_words"] > 20 * len(words)
    bad = 100 * out["dup_line_chars"] > q.LINE_PERCENT * out["word_chars"] or 100 * out["n_symbols"] > q.SYMBOLS_PER_100_WORDS * len(words)
    bad = bad or any(100 * out[f"dup_{n}gram_chars"] > p * out["word_chars"] for n, p in q.NGRAM_PERCENT.items())
    out["kept"] = not (out["base_failed"] or bad)
    return out


def same(texts):
    got = q.signals([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert {k: v[i].item() for k, v in got.items()} == brute(t)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n#|"), max_size=120), min_size=1, max_size=5))
def test_signals_equal_brute_force(texts):
    same(texts)


def test_documents(documents):
    same([r["text"] or "" for r in documents.select("text").limit(60).collect()])


def test_hash_collisions_fall_back_to_words(monkeypatch):
    monkeypatch.setattr(q, "scramble", lambda h: h * 0)
    same(["a b c d e f a b c d e g", "x " * 30, "a b c d e"])


def test_query_and_stage(odd):
    got = q.quality(odd).collect()
    assert len(got) == odd.count()
    assert not any(r["kept"] for r in got if r["n_words"] < 10)
    kept = q.keep_good(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in got if r["kept"])
    assert q.quality(odd.limit(0)).count() == 0
