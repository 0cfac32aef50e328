"""Language identification by prediction by partial matching (operator 6).

For each language, a byte context tree of order 0 to 3 with escape method C is
built once and frozen. The code length of a byte is that of its longest context
with counts in the language; a byte new to a context pays the escape and goes on
in the next shorter one, down to a uniform code over 256 bytes. Frozen trees make
the code length a function of the last three bytes and the next one, so all
trees are laid out as one table (context, byte) -> bits per language, and a
text's exact code lengths are sums of table rows.

The trees are fitted on a bounded sample: per language up to `max_docs` whole
documents in hash order, of up to `max_chars` characters together, in the
`max_langs` languages with the most documents. Only rows that the caller passes
for training are seen.

Defined results: a null text, or one without a letter, is `und` with score 0;
equal code lengths go to the language that sorts first; without training rows
everything is `und`, and an empty table gives an empty table; training rows with
a null text or language are left out, and so are texts longer than `max_chars`;
a null doc_id is an id like others; a training row that is repeated counts once;
texts to be told are scored whole, however long; repeated rows get equal results;
other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import as_bytes, small_batches, text_sample, text_slices

ORDER = 3
MAX_DOCS, MAX_CHARS = 1000, 2_000_000
#: Most languages that are learned: the table holds a code length per context, byte and language.
MAX_LANGS = 100
#: Bytes before a text's first one.
START = b"\n" * ORDER
PIECE = 1 << 20
UNKNOWN = "und"


class Trees:
    """Frozen context trees of several languages as one table of code lengths in bits."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.langs = sorted(samples)
        joined = {g: [START + t for t in samples[g]] for g in self.langs}
        seen = np.zeros(256, bool)
        for texts in joined.values():
            for t in texts:
                seen[np.frombuffer(t, np.uint8)] = True
        self.size = int(seen.sum()) + 1  # the last symbol stands for every byte that training never saw
        self.symbol = np.where(seen, np.cumsum(seen) - 1, self.size - 1).astype(np.int32)
        a, n_lang = self.size, len(self.langs)
        counts = [[self._grams(joined[g], k) for g in self.langs] for k in range(ORDER + 1)]
        rows = np.full((1, a, n_lang), 8.0)  # order -1: 256 equally likely bytes
        contexts, begin, table, parents = [np.zeros(1, np.int64)], 0, [], None
        for k in range(ORDER + 1):
            own = np.unique(np.concatenate([c // a for c, _ in counts[k]] or [np.zeros(0, np.int64)])) if k else np.zeros(1, np.int64)
            parents = np.zeros(len(own), np.int64) if k == 0 else np.searchsorted(contexts[-1], own % a ** (k - 1))
            new = rows[parents].copy()
            for j, (code, n) in enumerate(counts[k]):
                row, sym = np.searchsorted(own, code // a), code % a
                total = np.bincount(row, n, len(own))
                kinds = np.bincount(row, minlength=len(own))
                used = total > 0
                new[used, :, j] += -np.log2(kinds[used] / (total[used] + kinds[used]))[:, None]
                new[row, sym, j] = -np.log2(n / (total[row] + kinds[row]))
            table.append(new)
            if k:
                contexts.append(own)
            rows = new
        start = np.cumsum([0] + [len(t) for t in table])
        #: Row of the longest context known to any language, by the last ORDER symbols.
        self.row = np.zeros(1, np.int32)
        for k in range(1, ORDER + 1):
            self.row = np.tile(self.row, a)
            self.row[contexts[k]] = start[k] + np.arange(len(contexts[k]))
        self.bits = np.concatenate([t.reshape(len(t) * a, n_lang) for t in table] + [np.zeros((1, n_lang))]).astype(np.float32)

    def _grams(self, texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of (k context symbols, symbol) and their counts; START is context only."""
        codes = []
        for t in texts:
            s = self.symbol[np.frombuffer(t, np.uint8)].astype(np.int64)
            code = s[ORDER:].copy()
            for j in range(1, k + 1):
                code += s[ORDER - j:len(s) - j] * self.size ** j
            codes.append(code)
        return np.unique(np.concatenate(codes or [np.zeros(0, np.int64)]), return_counts=True)

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        raw = np.frombuffer(b"".join(START + t for t in texts), np.uint8)
        size = np.array([ORDER + len(t) for t in texts], np.int64)
        first = np.cumsum(size) - size
        a = self.size
        for lo in range(ORDER, len(raw), PIECE):
            hi = min(len(raw), lo + PIECE)
            s = self.symbol[raw[lo - ORDER:hi]]
            n = hi - lo
            context = (s[0:n] * a + s[1:n + 1]) * a + s[2:n + 2]
            cell = self.row[context].astype(np.int64) * a + s[ORDER:]
            i0, i1 = np.searchsorted(first, lo, "right") - 1, np.searchsorted(first, hi, "left")
            for j in range(ORDER):  # the START bytes of texts cost nothing
                at = first[i0:i1] + j - lo
                cell[at[(at >= 0) & (at < n)]] = len(self.bits) - 1
            cuts = np.maximum(first[i0:i1] - lo, 0)
            out[i0:i1] += np.add.reduceat(self.bits[cell], cuts, axis=0, dtype=np.float64)
        return out


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_docs: int = MAX_DOCS,
           max_chars: int = MAX_CHARS, max_langs: int = MAX_LANGS) -> dict[str, list[bytes]]:
    """Bounded training sample (`text_sample`) of the languages with the most documents; equal counts: by name."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("kind"))
    rows = rows.where(F.col("text").isNotNull() & F.col("kind").isNotNull())
    langs = [r["kind"] for r in rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "kind").limit(max_langs).collect()]
    found: dict[str, list[bytes]] = {}
    for r in text_sample(rows.where(F.col("kind").isin(langs)), max_docs, max_chars).orderBy("kind", "id", "text").collect():
        found.setdefault(r["kind"], []).append(r["text"].encode())
    return found


def _has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode()))


def identify(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score, bits_per_byte. Only the text is looked at."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def predict(batches):
        model = shared.value
        for b in text_slices(batches, "text"):
            texts = as_bytes(b.column("text"))
            langs, score, rate = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            if model.langs:
                bits = model.lengths(texts)
                best = bits.argmin(1)
                score = 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
                rate = bits.min(1) / np.maximum([len(t) for t in texts], 1)
                langs = [model.langs[i] for i in best.tolist()]
            for i, t in enumerate(texts):
                if not _has_letter(t):
                    langs[i], score[i], rate[i] = UNKNOWN, 0.0, 0.0
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(langs, pa.string()), pa.array(score), pa.array(rate)],
                                             names=["doc_id", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double, bits_per_byte double")


def is_held_out(id_col: str = "doc_id"):
    """Fold of a document: crc32 of its id as text, modulo 5, is 0. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def predict_languages(docs: DataFrame) -> DataFrame:
    """Operator 6 with production parameters: learns from the documents that are not held out."""
    trees = Trees(sample(docs.where(~is_held_out()), "doc_id", "text", "lang"))
    return identify(docs, trees).withColumn("held_out", is_held_out())
