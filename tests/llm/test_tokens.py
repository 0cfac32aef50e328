"""Operator 1: ids equal the tokenizer's, and every file round-trips."""

import unicodedata
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridcast.llm import tokens as t

ENCODER = t.WordEncoder(t.default_tokenizer())
ODD = ["", " ", "a<|endoftext|>B <|ENDOFTEXT|> <|endoftext|>.", "don't I'LL it's. x'S, 'tis", "ΑΣ. ΣΑΣ, İstanbul ﬁ ①②, 12.5, a…, ́x é.",
       "\x00\x1c a b　c\x85d. ...", "ÉÈ.É!, x!!! --, ña.ñ", "😀. 👍🏽!", "K ſ Å.", "…. ²., ½!"]


def plain(text):
    return ENCODER.tok.encode(text, add_special_tokens=False).ids


def check(texts):
    ids, count = ENCODER.encode([x.encode() for x in texts])
    ends = np.cumsum(count)
    for x, n, e in zip(texts, count, ends):
        assert ids[e - n:e].tolist() == plain(x), x


def test_odd_texts():
    check(ODD)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_any_text(texts):
    check(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=200), min_size=1, max_size=6))
def test_grammar_round_trip(docs):
    ids, count = t.with_end(np.array([x for d in docs for x in d], np.uint32), np.array([len(d) for d in docs]), 1)
    rules, lengths, symbols, n = t.compress(ids, count, 6)
    assert t.expand(symbols, rules, 6).tolist() == ids.tolist()
    assert len(n) == len(docs) and n.sum() == len(symbols)
    block = {"rules": rules.tobytes(), "lengths": lengths.astype(np.uint32).tobytes(), "symbols": symbols.tobytes(),
             "doc_symbols": n.tolist(), "first": 6}
    for i, d in enumerate(docs):
        want = d + [1]
        assert t.doc_tokens_at(block, i).tolist() == want
        assert t.doc_tokens_at(block, i, len(want) // 3, len(want) // 2).tolist() == want[len(want) // 3:len(want) // 2]


def test_characters_that_normalise_to_several():
    many = [c for c in map(chr, range(0x80, 0x110000)) if not 0xD800 <= ord(c) < 0xE000
            and (len(c.lower()) > 1 or len(unicodedata.normalize("NFC", c)) > 1 or unicodedata.normalize("NFC", c) != c)]
    assert "\u0130" in many and "\u0958" in many and len(many) > 1000
    check([f"A{c}{p}" for c in many for p in (".", ",", "!", "..!")] + [f"{c}.a {c}, x" for c in many])
    check([f"a{chr(c)}." for c in range(0x80, 0x3000) if not 0xD800 <= c < 0xE000])


def test_latin_words():
    rng = np.random.default_rng(6)
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7)]
    check(["".join(rng.choice(letters, rng.integers(1, 14))) + rng.choice(["", ".", "!!", ",."]) for _ in range(4000)] + letters + ["×÷", "a×b", "÷."])


def test_each_pre_token_is_encoded_once():
    own = t.WordEncoder(t.default_tokenizer())
    text = "Word word, (word) WORD: 12 21. 1.2 É é! don't x×y"
    assert own.encode([text.encode()])[0].tolist() == plain(text)
    assert set(own.whole.number) == {x.encode() for x in ["word", ",", "(", ")", ":", "1", "2", ".", "é", "!", "don't", "x×y"]}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*map(chr, range(128)), *map(chr, range(0xA0, 0x100)), "\u0301", "\u0130", "Σ", "字", "²", "'s", "'LL",
                                          "<|endoftext|>", "<|ENDOFTEXT|>", " ", " ", "  "]), max_size=30).map("".join), min_size=1, max_size=4))
def test_mixed_signs(texts):
    check(texts)


def test_full_table_of_odd_words(monkeypatch):
    monkeypatch.setattr(t, "WORD_CACHE", 100)
    own = t.WordEncoder(t.default_tokenizer())
    for n in range(30):
        text = " ".join(f"don't слово, x'{'z' * (n + 1)}{i}. Ωμ{'α' * n}{'β' * i}!" for i in range(20))
        assert own.encode([text.encode()])[0].tolist() == plain(text)
    assert len(own.whole.number) <= 100 and len(own.known.number) <= 25 + 44  # what one text needs at once may exceed a fourth


def pair_counts(symbols, n):
    """Non-overlapping occurrences of each pair, from left to right, inside documents."""
    found, at = Counter(), 0
    for k in n.tolist():
        taken = {}
        for i in range(at, at + k - 1):
            pair = (int(symbols[i]), int(symbols[i + 1]))
            if taken.get(pair) != i:
                found[pair] += 1
                taken[pair] = i + 1
        at += k
    return found


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(3)
    for kinds, size, least in ((4, 6000, 16), (60, 20000, 16), (3, 500, 4), (2, 4000, 16)):
        ids, count = t.with_end(rng.zipf(1.3, size).clip(0, kinds).astype(np.uint32), np.full(size // 50, 50))
        rules, lengths, symbols, n = t.compress(ids, count, kinds + 1, least)
        assert t.expand(symbols, rules, kinds + 1).tolist() == ids.tolist()
        assert max(pair_counts(symbols, n).values(), default=0) < least
        grown = [len(t.expand(np.array([kinds + 1 + i], np.uint32), rules, kinds + 1)) for i in range(len(rules))]
        assert grown == lengths.tolist()


def test_small_cache_forgets_but_stays_right(monkeypatch):
    monkeypatch.setattr(t, "WORD_CACHE", 3)
    own = t.WordEncoder(t.default_tokenizer())
    for text in ["alpha beta gamma delta", "beta epsilon, zeta.", "alpha Alpha ALPHA"]:
        assert own.encode([text.encode()])[0].tolist() == plain(text)


def test_full_tables_keep_words_that_return(monkeypatch):
    monkeypatch.setattr(t, "WORD_CACHE", 100)
    own = t.WordEncoder(t.default_tokenizer())
    for n in range(30):
        text = " ".join(f"common Word{n}x word{n}y, {'z' * (n + 1)}{i}" for i in range(20))
        assert own.encode([text.encode()])[0].tolist() == plain(text)
    assert len(own.whole.number) <= 100 and b"common" in own.whole.number
    assert len(own.known.number) <= 25 + 24  # what one text needs at once may exceed a fourth


def test_files(spark, documents, odd):
    for df in (documents.select("doc_id", "text").repartition(5), odd):
        rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "") for r in df.collect()))
        got = t.tokenize(df, t.default_tokenizer()).collect()
        want, start = [], 0
        for has, d, _, text in rows:
            ids = plain(text) + [1]
            want.append((d if has else None, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        key = lambda r: (r[1], str(r[0]))
        assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    assert t.tokenize(odd.limit(0), t.default_tokenizer()).count() == 0
