"""Repetition coverage and the rules on it (operator 10).

Rolling hashes of 5 to 10 words find the n-grams that a text holds twice or
more; the rules measure the characters inside them and inside repeated lines.
Equal hashes are confirmed on the word ids, so the counts are exact.

Defined results: a null or empty text has no words and fails the base rule
(under 10 words); very long texts are judged whole; repeated rows, and rows with a
null or repeated doc_id, are judged each on its own text; an n-gram or line that
stands twice counts each time but the first (words: the first too); an empty table
gives an empty table; columns besides id and text are not looked at, and pass
through the filter.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import Words, as_bytes, covered, doc_text, free_name, rolling, scramble, small_batches, text_slices

#: Largest percentage of a text's word characters inside duplicated n-grams, by n.
NGRAM_PERCENT = {5: 30, 6: 29, 7: 28, 8: 27, 9: 26, 10: 25}
#: Largest percentage inside lines that repeat an earlier line.
LINE_PERCENT = 30
#: Largest number of symbols per 100 words.
SYMBOLS_PER_100_WORDS = 20
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"

LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
         *(f"dup_{n}gram_chars" for n in NGRAM_PERCENT)]
SIGNALS = T.StructType([*(T.StructField(c, T.LongType()) for c in LONGS),
                        T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _repeated(words: Words, n: int, at: np.ndarray, doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Those of the window positions `at` whose n words occur again in the same text."""
    if len(at) < 2:
        return at[:0]
    key = scramble(hashes[at] + doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    pos, key = at[order], key[order]
    same = key[1:] == key[:-1]
    left, right = pos[:-1][same], pos[1:][same]
    equal = doc[left] == doc[right]
    for j in range(n):
        equal &= words.ids[left + j] == words.ids[right + j]
    if not equal.all():  # two windows share a 64-bit hash: group by the ids themselves
        groups = defaultdict(list)
        for p in at.tolist():
            groups[(doc[p], words.ids[p:p + n].tobytes())].append(p)
        return np.array(sorted(p for g in groups.values() if len(g) > 1 for p in g), np.int64)
    hit = np.zeros(len(pos), bool)
    hit[1:] |= same
    hit[:-1] |= same
    return np.sort(pos[hit])


def _by_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the characters of their words."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    if len(lines) < 2 or len(set(lines)) == len(lines):
        return 0, 0
    seen, count, chars = set(), 0, 0
    for x in lines:
        if x in seen:
            count += 1
            chars += sum(len(w.decode()) for w in x.split())
        seen.add(x)
    return count, chars


def signals(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The signals of several texts at once."""
    words = Words(texts)
    n_docs, doc, out = len(texts), words.doc_of(), {}
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    out["n_words"] = np.diff(words.starts)
    out["word_chars"] = _by_text(~_SPACE[raw] & ((raw & 0xC0) != 0x80), ends)
    out["n_symbols"] = _by_text(_SYMBOL[raw], ends)
    lines = [_lines(t) for t in texts]
    out["n_dup_lines"] = np.array([x[0] for x in lines], np.int64)
    out["dup_line_chars"] = np.array([x[1] for x in lines], np.int64)
    chars = np.fromiter((len(w.decode()) for w in words.vocab), np.int64, len(words.vocab))
    chars = chars[words.ids] if len(words) else np.zeros(0, np.int64)
    at, valid = None, None
    for n in NGRAM_PERCENT:
        hashes = rolling(words.hashes, n)
        valid = words.window_starts(n)
        # a repeated n-gram begins with a repeated (n-1)-gram
        at = valid if at is None else np.intersect1d(at, valid, assume_unique=True)
        at = _repeated(words, n, at, doc, hashes)
        inside = covered(at, n, len(words))
        if n == REPEAT_WINDOW:
            out["n_repeat_words"] = _by_text(inside, words.starts)
        out[f"dup_{n}gram_chars"] = _by_text(chars * inside, words.starts)
    base = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"])
    bad = (100 * out["dup_line_chars"] > LINE_PERCENT * out["word_chars"]) | (
        100 * out["n_symbols"] > SYMBOLS_PER_100_WORDS * out["n_words"])
    for n, percent in NGRAM_PERCENT.items():
        bad |= 100 * out[f"dup_{n}gram_chars"] > percent * out["word_chars"]
    out["base_failed"], out["kept"] = base, ~(base | bad)
    assert n_docs == len(out["kept"])
    return out


def with_signals(docs: DataFrame, text_col: str = "text", out_col: str | None = None) -> tuple[DataFrame, str]:
    """docs, all columns kept, with a struct column of signals under a free name (returned too)."""
    small_batches(docs.sparkSession)
    name = free_name(docs, out_col or "quality_signals")
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, SIGNALS)])
    names = [f.name for f in SIGNALS.fields]
    where = docs.columns.index(next(c for c in docs.columns if c.lower() == text_col.lower()))

    def measure(batches):
        for b in text_slices(batches, b_name):
            got = signals(as_bytes(b.column(where)))
            struct = pa.StructArray.from_arrays([pa.array(got[k]) for k in names], names)
            yield pa.RecordBatch.from_arrays([*b.columns, struct], names=[*b.schema.names, name])

    b_name = docs.columns[where]
    return docs.mapInArrow(measure, schema), name


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and the signals as columns."""
    found, name = with_signals(doc_text(docs, id_col, text_col))
    return found.select("doc_id", f"{name}.*")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass the rules, with their own columns only."""
    found, name = with_signals(docs, text_col)
    return found.where(F.col(f"{name}.kept")).drop(name)
