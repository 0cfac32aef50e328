"""Toxicity from the nearest labelled examples by exact TF-IDF cosine (operator 8).

A bounded sample of labelled rows is the example set. Examples and documents are
unit TF-IDF vectors over all of its terms. Terms that significantly more toxic
examples hold than others are listed, however many, and all other terms weigh
REST of what they would; there, examples that repeat much of an earlier one do
not count, so copies of one toxic text do not make its ordinary words suspicious.
The k nearest examples are found exactly with a block-max inverted index: the
blocks of examples with the highest upper bounds are visited first, then all whose
bound reaches the k-th best cosine so far. Cosines weigh the votes,
shrunk to the share of toxic rows; isotonic regression on leave-one-out votes,
weighted to the class sizes of all labelled rows, calibrates the score.

Defined results: a null or empty text, and any text without a word of an example,
gets the score of a document without evidence; equal cosines go to the example
that stands first (by doc_id); repeated rows get equal results, and count once
among the examples; without labelled rows every score is 0; an empty table gives
an empty table; null labels, and labels with a null doc_id, are left out; texts
longer than MAX_CHARS are scored whole, but are no examples; documents with a null
doc_id are scored like others; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import Words, as_bytes, rolling, small_batches, text_sample, text_slices

#: Labelled rows and characters of each class in the example set; neighbours that vote.
MAX_PER_CLASS, MAX_CHARS, NEIGHBOURS = 2000, 8_000_000, 15
#: Weight of a term that is not listed, as a part of a listed one's (`cross_validate`).
REST = 0.1
MIN_TEXTS, MIN_G = 5, 20.0
#: A text is a copy if a larger share of its shingles stands in texts before it.
SHINGLE, COPIED = 5, 0.3
#: Cosine weight of the prior in a vote.
SHRINK = 0.25
#: Examples in a block; blocks visited first.
BLOCK, FIRST = 64, 8
#: Clusters that order the examples, so that those of a block are alike and its bounds are low for others.
CLUSTERS, CLUSTER_TERMS = 32, 1024
EVIDENCE = 3
_EDGE = ".,;:!?\"'()[]{}<>*#$%&|-_/\\"


def normal(word: bytes) -> str:
    """A word in lower case, without punctuation at its ends."""
    return word.decode().lower().strip(_EDGE)


def term_counts(words: Words, term_of: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the vocabulary terms in several texts, sorted by text, then term."""
    own = np.fromiter((term_of.get(normal(w), -1) for w in words.vocab), np.int64, len(words.vocab))
    term = own[words.ids] if len(words) else np.zeros(0, np.int64)
    hit = term >= 0
    key, n = np.unique(words.doc_of()[hit] * max(1, len(term_of)) + term[hit], return_counts=True)
    return key // max(1, len(term_of)), key % max(1, len(term_of)), n


def originals(words: Words) -> np.ndarray:
    """Which texts have at most COPIED of their shingles in texts before them."""
    n, at = len(words.starts) - 1, words.window_starts(SHINGLE)
    doc = words.doc_of()[at].astype(np.int32)
    shingle = rolling(words.hashes, SHINGLE)[at]
    order = np.lexsort((doc, shingle))
    shingle, doc = shingle[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = shingle[1:] != shingle[:-1]
    again = ~new  # in an earlier text; a shingle repeated in one text counts once
    again[1:] &= doc[1:] != doc[:-1]
    own = np.bincount(doc[new | again], minlength=n)
    return np.bincount(doc[again], minlength=n) <= COPIED * own


def choose_terms(texts: list[bytes], label: np.ndarray, words: Words | None = None) -> list[str]:
    """Terms that more toxic texts hold than expected, by a G-test over texts that are no copies."""
    words = words or Words(texts)
    names = [normal(w) for w in words.vocab]
    number = {w: i for i, w in enumerate(dict.fromkeys(names))}
    own = np.fromiter((number[w] for w in names), np.int64, len(names))
    new = originals(words)
    keep = new[words.doc_of()]
    pairs = np.unique(words.doc_of()[keep] * max(1, len(number)) + own[words.ids[keep]])
    doc, term = pairs // max(1, len(number)), pairs % max(1, len(number))
    size = np.bincount(label[new], minlength=2)
    b, a = (np.bincount(term[label[doc] == y], minlength=len(number)) for y in (0, 1))
    g, both = np.zeros(len(number)), a + b
    for y, held in ((1, a), (0, b)):
        for seen, total in ((held, both), (size[y] - held, size.sum() - both)):
            expected = total * size[y] / max(1, size.sum())
            g += 2 * seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))
    more = a * size[0] > b * size[1]
    scored = [(-g[i], w) for w, i in number.items() if w and a[i] >= MIN_TEXTS and more[i] and g[i] >= MIN_G]
    return [w for _, w in sorted(scored)]


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers begin .. begin + size - 1 of each range, end to end."""
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


def near_together(doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """An order of n unit vectors in which like ones stand together: by a few rounds of k-means on the commonest terms.

    It orders work only; no result depends on it.
    """
    if n <= BLOCK or not len(term):
        return np.arange(n)
    held = np.bincount(term)
    common = np.argsort(-held, kind="stable")[:CLUSTER_TERMS]
    column = np.full(len(held), -1)
    column[common] = np.arange(len(common))
    some = column[term] >= 0
    dense = np.zeros((n, len(common)), np.float32)
    dense[doc[some], column[term[some]]] = weight[some]
    centre = dense[np.linspace(0, n - 1, CLUSTERS).astype(int)].copy()
    for _ in range(8):
        of = (dense @ centre.T).argmax(1)
        for k in range(CLUSTERS):
            if (of == k).any():
                mean = dense[of == k].sum(0)
                centre[k] = mean / max(float(np.linalg.norm(mean)), 1e-9)
    return np.lexsort((np.arange(n), of))


class Examples:
    """Labelled examples under a block-max inverted index, and the calibration of their votes.

    rest: weight of terms that are not listed; without it, the vectors hold the listed ones alone.
    """

    def __init__(self, ids: list, texts: list[bytes], label: np.ndarray, class_rows: tuple[int, int], rest: float = 0.0):
        words = Words(texts)
        words.flat = None  # not needed, and larger than the rest
        terms = choose_terms(texts, label, words) if len(texts) else []
        listed = len(terms)
        if rest > 0:
            terms = list(dict.fromkeys([*terms, *(t for w in words.vocab if (t := normal(w)))]))
        self.term_of = {w: i for i, w in enumerate(terms)}
        n = len(texts)
        doc, term, count = term_counts(words, self.term_of)
        del words
        df = np.bincount(term, minlength=len(terms))
        self.idf = (np.log((1 + n) / (1 + df)) + 1) * np.where(np.arange(len(terms)) < listed, 1.0, rest)
        weight = self._unit(doc, term, count, n)
        #: Place among the examples as given: ties go by it.
        self.rank = near_together(doc, term, weight, n)
        place = np.argsort(self.rank)
        moved = np.argsort(place[doc], kind="stable")
        doc, term, count, weight = place[doc][moved], term[moved], count[moved], weight[moved]
        label = label[self.rank]
        self.ids, self.label = [ids[i] for i in self.rank.tolist()], label.astype(np.float64)
        order = np.lexsort((doc, term))
        self.post_doc, self.post_weight = doc[order].astype(np.int32), weight[order]
        self.n_blocks = max(1, -(-n // BLOCK))
        # an entry for each term and block that has postings: they follow one another
        key = term[order] * self.n_blocks + doc[order] // BLOCK
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.entry_block = (key[first] % self.n_blocks).astype(np.int32)
        self.entry_max = np.maximum.reduceat(self.post_weight, first) if len(first) else np.zeros(0)
        self.entry_post = np.append(first, len(key))
        self.begin = np.searchsorted(key[first], np.arange(len(terms) + 1) * self.n_blocks)
        rows = np.array(class_rows, np.float64)
        self.prior = rows[1] / rows.sum() if rows.sum() else 0.0
        votes = np.zeros(n)
        cut = np.searchsorted(doc, np.arange(n + 1))
        for i in range(n):
            votes[i] = self.vote(*self.nearest(term[cut[i]:cut[i + 1]], weight[cut[i]:cut[i + 1]], i))
        per_class = np.bincount(label, minlength=2) if n else np.ones(2)
        self._calibrate(votes, self.label, (rows / np.maximum(per_class, 1))[label] if n else votes)
        self.none = self.score(self.vote(np.zeros(0, np.int64), np.zeros(0)))

    def _unit(self, doc: np.ndarray, term: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        weight = (1 + np.log(count)) * self.idf[term] if len(term) else np.zeros(0)
        norm = np.sqrt(np.bincount(doc, weight ** 2, n)) if len(doc) else np.ones(n)
        return weight / norm[doc] if len(doc) else weight

    def nearest(self, term: np.ndarray, weight: np.ndarray, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest positive cosines (all but one, if asked), and the cosines. Exact."""
        if not len(term):
            return np.zeros(0, np.int64), np.zeros(0)
        size = self.begin[term + 1] - self.begin[term]
        entry, w = _ranges(self.begin[term], size), np.repeat(weight, size)
        block = self.entry_block[entry]
        bound = np.bincount(block, w * self.entry_max[entry], self.n_blocks)
        best_doc, best = np.zeros(0, np.int64), np.zeros(0)
        order, visited = np.argsort(-bound, kind="stable"), np.zeros(self.n_blocks, bool)
        for most in (FIRST, self.n_blocks):  # the blocks of the highest bounds give a floor for all others
            floor = best[NEIGHBOURS - 1] if len(best) >= NEIGHBOURS else 0.0
            visit = ~visited & (bound > 0) & (bound >= floor - 1e-12)
            visit[order[visit[order]][most:]] = False
            if not visit.any():
                break
            visited |= visit
            inside = np.flatnonzero(visit[block])
            begin = self.entry_post[entry[inside]]
            n = self.entry_post[entry[inside] + 1] - begin
            post = _ranges(begin, n)
            cosine = np.bincount(self.post_doc[post], np.repeat(w[inside], n) * self.post_weight[post], len(self.label))
            if but >= 0:
                cosine[but] = 0
            hit = np.flatnonzero((cosine > 0) & (cosine >= floor - 1e-9))
            doc, cos = np.concatenate([best_doc, hit]), np.round(np.concatenate([best, cosine[hit]]), 12)
            best_order = np.lexsort((self.rank[doc], -cos))[:NEIGHBOURS]
            best_doc, best = doc[best_order], cos[best_order]
        return best_doc, best

    def vote(self, doc: np.ndarray, cosine: np.ndarray) -> float:
        return float((cosine @ self.label[doc] + SHRINK * self.prior) / (cosine.sum() + SHRINK))

    def _calibrate(self, votes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        """Isotonic regression of the label on the vote (pool adjacent violators), as knots for interpolation."""
        at, inverse = np.unique(votes, return_inverse=True)
        blocks: list[list[float]] = []  # weight, weighted sum, first and last vote
        mass, total = np.bincount(inverse, weight, len(at)), np.bincount(inverse, weight * label, len(at))
        for x, m, s in zip(at.tolist(), mass.tolist(), total.tolist()):
            blocks.append([m, s, x, x])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
                m2, s2, _, last = blocks.pop()
                blocks[-1][0] += m2
                blocks[-1][1] += s2
                blocks[-1][3] = last
        self.knots = np.array([x for b in blocks for x in (b[2], b[3])] or [0.0])
        self.values = np.array([v for b in blocks for v in [b[1] / b[0] if b[0] else 0.0] * 2] or [0.0])

    def score(self, vote: float) -> float:
        return float(np.interp(vote, self.knots, self.values))

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Score and evidence (nearest examples as id:cosine) of each text."""
        out, evidence = np.full(len(texts), self.none), [""] * len(texts)
        doc, term, count = term_counts(Words(texts), self.term_of)
        weight = self._unit(doc, term, count, len(texts))
        cut = np.flatnonzero(np.diff(doc, prepend=-1))
        known: dict[bytes, tuple[float, str]] = {}
        for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(doc)]):
            key = term[lo:hi].tobytes() + count[lo:hi].tobytes()
            if key not in known:
                near, cosine = self.nearest(term[lo:hi], weight[lo:hi])
                said = ",".join(f"{self.ids[i]}:{c:.4f}" for i, c in zip(near[:EVIDENCE].tolist(), cosine.tolist()))
                known[key] = self.score(self.vote(near, cosine)), said
            out[doc[lo]], evidence[doc[lo]] = known[key]
        return out, evidence


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_per_class: int = MAX_PER_CLASS, max_chars: int = MAX_CHARS) -> Examples:
    """Examples from a bounded sample (`text_sample`) of the documents that the labels name."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("kind"))
    sizes = {r["kind"]: r["n"] for r in known.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = text_sample(texts, max_per_class, max_chars, known.distinct()).orderBy("id", "kind", "text").collect()
    return Examples([r["id"] for r in rows], [r["text"].encode() for r in rows],
                    np.array([r["kind"] for r in rows], np.int64), (sizes.get(0, 0), sizes.get(1, 0)), REST)


def cross_validate(texts: list[bytes], label: np.ndarray, rests: list[float], folds: int = 3) -> dict[float, float]:
    """Mean log loss per weight of unlisted terms, each fold scored by examples of the others: what REST is held to."""
    fold = np.array([xxhash.xxh64_intdigest(t) % folds for t in texts])
    out = {}
    for rest in rests:
        loss = []
        for f in range(folds):
            inside, held = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            per = np.bincount(label[inside], minlength=2)
            model = Examples(inside.tolist(), [texts[i] for i in inside], label[inside], (int(per[0]), int(per[1])), rest)
            p = np.clip(model.scores([texts[i] for i in held])[0], 1e-4, 1 - 1e-4)
            loss.append(-np.where(label[held] == 1, np.log(p), np.log(1 - p)))
        out[rest] = float(np.concatenate(loss).mean())
    return out


def score(docs: DataFrame, examples: Examples, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted, evidence. Only the text is looked at."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(examples)

    def judge(batches):
        for b in text_slices(batches, "text"):
            got, evidence = shared.value.scores(as_bytes(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(got), pa.array((got >= 0.5).astype(np.int32)),
                                              pa.array(evidence, pa.string())], names=["doc_id", "score", "predicted", "evidence"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(judge, "doc_id long, score double, predicted int, evidence string")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Operator 8 with production parameters: learns from the labels that are not held out."""
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    return score(docs, fit(docs, labels.where(~held))).withColumn("held_out", held)
