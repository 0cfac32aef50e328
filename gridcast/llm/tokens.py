"""Token ids in grammar-compressed shards (operator 1).

Texts are encoded with a public tokenizer in ascending doc_id order. Each range
partition is a shard; its blocks (a few MB of text each) are rows of a Parquet
table, so that Spark's commit protocol covers lost executors. A block is what has
a grammar of its own: rounds of replacement go on until no pair occurs MIN_PAIRS
times in it. A block holds

- `rules`: pairs of symbols, little-endian uint32; rule r makes symbol first + r,
- `lengths`: expansion length of each rule, uint32,
- `symbols`: the compressed ids of its documents, uint32,
- `doc_ids`, `doc_tokens`, `doc_symbols`: the documents, their ids and symbols.

Pairs never cross the end of a document, so one document is expanded from its
own symbols (`doc_tokens_at`), and the lengths find a token inside it.

Defined results: a null or empty text is the end id alone; equal doc_ids stand
in order of their texts; a null doc_id stands first; a text longer than a block
ends its block; an empty table gives an empty table; other columns are not
looked at.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridcast.llm.common import Words, as_bytes, doc_text, small_batches, text_slices, worker_state
from gridcast.session import shared_path

END_ID = 1
BLOCK_BYTES = 4 << 20
#: Pieces whose ids a worker keeps, and a fourth of that for cores of words that are not plain; a full table keeps
#: those that were looked up again.
WORD_CACHE = 400_000
#: A pair that occurs so often in a block becomes a rule; in one round, all pairs from this part of the fullest count on.
MIN_PAIRS, STEP = 16, 256
_SLOTS = 1 << 20

BLOCKS = ("shard int, block int, first int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
          "doc_symbols array<long>, rules binary, lengths binary, symbols binary")


# ---- encoding ---------------------------------------------------------------

#: Plain words: printable ASCII and letters of U+00C0 to U+00FF, which normalising only turns to lower case; without
#: `'`, whose contractions are pre-tokens, and `<`, which begins special tokens.
_PLAIN = re.compile(rb"(?:[!-&(-;=-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: Kinds of bytes: a plain word's pre-tokens are runs of letters, single digits and runs of signs.
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[[*b" "]] = _SPACE
_KIND[[c for c in range(33, 127) if c not in b"'<"]] = _SIGN
_KIND[[*b"0123456789"]] = _DIGIT
_KIND[[c for c in range(128) if chr(c).isalpha()]] = _LETTER
_LOWER = np.array([*bytes(range(256)).lower()], np.uint8)
#: Second bytes of the letters of U+00C0 to U+00FF after 0xC3.
_SECOND = np.isin(np.arange(256), [c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)])
#: Byte-level alphabet: a printable byte stands for itself, the n-th other one for U+0100 + n. Spaces stay, to part words.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LEVEL = np.arange(256, dtype="<u4")
_BYTE_LEVEL[[b for b in range(256) if b not in _PRINTABLE]] = np.arange(256, 512 - len(_PRINTABLE))
_BYTE_LEVEL[32] = 32


class Pieces(Words):
    """Words, of which plain ones are in lower case and cut into their pre-tokens, each with a space after it.

    A tokenizer that drops white space gives the same ids. Other words stay as they are.
    """

    def __init__(self, texts: list[bytes]):
        super().__init__(texts)
        raw = np.frombuffer(self.line, np.uint8)
        kind, line = _KIND[raw], _LOWER[raw]
        second = np.flatnonzero(raw[:-1] == 0xC3) + 1
        second = second[_SECOND[raw[second]]]
        kind[second - 1] = kind[second] = _LETTER
        line[second] |= 0x20 * (raw[second] < 0x9F).astype(np.uint8)
        odd = np.searchsorted(self.place, np.flatnonzero(kind == _ODD), "right") - 1
        odd = odd[np.diff(odd, prepend=-1) > 0]
        at = _ranges(self.place[odd], self.place[odd + 1] - self.place[odd])
        kind[at], line[at] = _SPACE, raw[at]
        left, right = kind[:-1], kind[1:]
        cuts = np.flatnonzero((left != _SPACE) & (right != _SPACE) & ((left != right) | (left == _DIGIT))) + 1
        line = np.insert(line, cuts, 0x20)
        self.starts = self.starts + np.searchsorted(cuts, self.place[self.starts])
        self.line, self.place = line.tobytes(), np.concatenate([[0], np.flatnonzero(line == 0x20) + 1])


class _Pool:
    """Id sequences end to end, each known by its number."""

    def __init__(self):
        self.ids, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, size: np.ndarray) -> int:
        """Append sequences; the number of the first."""
        first = len(self.size)
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])
        return first

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences by number, end to end, and their sizes."""
        size = self.size[which]
        return self.ids[_ranges(self.begin[which], size)], size


class _Table:
    """Id sequences of up to `most` words, and of more if they are needed at once."""

    def __init__(self, most: int):
        self.most = most
        self.number, self.pool, self.again = {}, _Pool(), np.zeros(0, bool)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 for those not held. Makes room for these first: numbers hold until the next call."""
        got = self._look(words)
        if len(self.number) + np.count_nonzero(got < 0) > self.most:
            if np.count_nonzero(self.again) > self.most // 2:
                self.again[:] = False
                self.again[got[got >= 0]] = True
            kept = np.flatnonzero(self.again)
            names, pool = list(self.number), _Pool()
            pool.add(*self.pool.take(kept))
            self.number = {names[i]: k for k, i in enumerate(kept.tolist())}
            self.pool, self.again = pool, np.zeros(len(kept), bool)
            got = self._look(words)
        return got

    def _look(self, words: list[bytes]) -> np.ndarray:
        got = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        self.again[got[got >= 0]] = True
        return got

    def add(self, words: list[bytes], ids: np.ndarray, size: np.ndarray) -> int:
        """Take in words that are not held; the number of the first."""
        first = self.pool.add(ids, size)
        self.number.update(zip(words, range(first, first + len(words))))
        self.again = np.concatenate([self.again, np.zeros(len(words), bool)])
        return first


class WordEncoder:
    """Ids of whole texts for a tokenizer that drops white space, from ids of words.

    Such a tokenizer never joins what white space parts, so each distinct piece is
    encoded once. Pieces of plain words are pre-tokens, which the tokenizer's model
    takes as they are. Of other words, those of letters alone are one pre-token each;
    many are encoded as one text and parted at the ids that end a word. Their
    trailing `.,!` are a pre-token of their own after a letter or digit that
    normalises to a single one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tok.model)  # takes pre-tokens
        size = self.tok.get_vocab_size()
        self.first = size
        self.ends = np.zeros(size, bool)
        for word, i in self.tok.get_vocab().items():
            self.ends[i] = word.endswith("</w>")
        self.known = _Table(WORD_CACHE // 4)  # words that are not plain, without trailing punctuation
        self.whole = _Table(WORD_CACHE)  # pieces

    def _plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain pieces, end to end, and their sizes: by the model alone, as nothing normalises or parts them."""
        said = _BYTE_LEVEL[np.frombuffer(b" ".join(words), np.uint8)].tobytes().decode("utf-32-le").split(" ")
        got = [self.model.encode_batch_fast([said[lo:lo + 500]], is_pretokenized=True, add_special_tokens=False)[0].ids
               for lo in range(0, len(said), 500)]
        ids = np.fromiter(chain.from_iterable(got), np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(words):
            return ids, np.diff(ends, prepend=0)
        got = [e.ids for e in self.model.encode_batch_fast(said, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def _learn(self, words: list[bytes]) -> None:
        """Encode words that are not plain and keep their ids."""
        letters, other = [], []
        for w in words:
            (letters if w.decode().isalpha() else other).append(w)
        order, ids, size = [], [], []
        for lo in range(0, len(letters), 500):
            part = letters[lo:lo + 500]
            found = np.array(self.tok.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(self.ends[found]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(found):
                other += part
                continue
            order = order + part
            ids.append(found)
            size.append(np.diff(cuts, prepend=0))
        for e in self.tok.encode_batch_fast([w.decode() for w in other], add_special_tokens=False):
            ids.append(np.array(e.ids, np.uint32))
            size.append([len(e.ids)])
        if words:
            self.known.add(order + other, np.concatenate(ids), np.concatenate(size))

    def _odd(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are not plain, end to end, and their sizes."""
        cores = [w.rstrip(b".,!") for w in words]
        for k, (w, core) in enumerate(zip(words, cores)):
            if len(core) < len(w) and not (core and _parts(core)):
                cores[k] = w
        tails = [w[len(core):] for w, core in zip(words, cores)]
        need = list(dict.fromkeys([*cores, *tails]))
        self._learn([need[i] for i in np.flatnonzero(self.known.find(need) < 0).tolist()])
        pieces = np.empty((len(words), 2), np.int64)
        for j, some in enumerate((cores, tails)):
            pieces[:, j] = np.fromiter(map(self.known.number.__getitem__, some), np.int64, len(some))
        ids, size = self.known.pool.take(pieces.ravel())
        return ids, size[::2] + size[1::2]

    def _numbers(self, vocab: list[bytes]) -> np.ndarray:
        """Number of each piece in whole; those not seen before are encoded."""
        number = self.whole.find(vocab)
        missing = np.flatnonzero(number < 0)
        plain = np.array([_PLAIN.fullmatch(vocab[i]) is not None for i in missing.tolist()], bool)
        for some, encode in ((missing[plain], self._plain), (missing[~plain], self._odd)):
            if len(some):
                words = [vocab[i] for i in some.tolist()]
                first = self.whole.add(words, *encode(words))
                number[some] = np.arange(first, first + len(words))
        return number

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and how many of them each text has."""
        pieces = Pieces(texts)
        number = self._numbers(pieces.vocab)
        ids, size = self.whole.pool.take(number[pieces.ids])
        ends = np.concatenate([[0], np.cumsum(size)])
        return ids, np.diff(ends[pieces.starts])


def _parts(core: bytes) -> bool:
    """Whether punctuation after a word is a pre-token of its own: its last character normalises to one letter or digit."""
    last = core[-1]
    if last < 128:
        return 48 <= last <= 57 or 65 <= last <= 90 or 97 <= last <= 122
    char = core.decode()[-1]
    normal = unicodedata.normalize("NFC", char).lower()
    return char.isalnum() and len(normal) == 1 and unicodedata.category(normal)[0] in "LN"


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0] .. begin[0]+size[0]-1, begin[1] .., end to end."""
    total = int(size.sum())
    first = np.cumsum(size) - size
    return np.arange(total) + np.repeat(begin - first, size)


def with_end(ids: np.ndarray, count: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each text's ids."""
    return np.insert(ids, np.cumsum(count), end_id).astype(np.uint32), count + 1


# ---- grammar ------------------------------------------------------------------

def _codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs of symbols as one number each."""
    code = left.astype(np.uint64)
    code <<= np.uint64(32)
    code |= right
    return code


def _frequent(code: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair codes that occur at least `least` times: where, which one it is there, and the codes."""
    pairs, rank, n = np.unique(code, return_inverse=True, return_counts=True)
    often = n >= least
    keep = often[rank]
    return np.flatnonzero(keep), (np.cumsum(often) - 1)[rank[keep]], pairs[often]


def compress(ids: np.ndarray, count: np.ndarray, first: int, least: int = MIN_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rules (n, 2), their expansion lengths, the symbols, and the symbols of each document.

    Rounds replace the most frequent pairs by nonterminals: those from a STEP-th
    of the fullest slot of a small table of counts, then all from `least` on;
    occurrences that overlap are replaced from left to right. Once all pairs from
    `least` on were taken, only pairs with a symbol of the last round can reach it
    again, so later rounds look at those alone. Ends when no pair reaches `least`.
    """
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(count) - 1] = True
    rules, made, lengths = [], first, np.ones(first, np.uint32)
    fresh_from = None  # first symbol of the last round, once all frequent pairs were taken
    while len(seq) > 1:
        if fresh_from is None:  # nearly all pairs count: take all but those across documents
            at, cross = None, np.flatnonzero(last[:-1])
            code = _codes(seq[:-1], seq[1:])
        else:
            fresh = seq >= fresh_from
            at, cross = np.flatnonzero((fresh[:-1] | fresh[1:]) & ~last[:-1]), []
            code = _codes(seq[at], seq[at + 1])
        slot = code * np.uint64(0x9E3779B97F4A7C15)
        slot >>= np.uint64(44)
        slot = slot.view(np.int64)
        filled = np.bincount(slot, minlength=_SLOTS)
        if len(cross):
            filled -= np.bincount(slot[cross], minlength=_SLOTS)
        bounds = [least] if fresh_from is not None else dict.fromkeys((max(least, int(filled.max()) // STEP), least))
        for bound in bounds:  # the second one where the fullest slots hold several rarer pairs
            full = (filled >= bound)[slot]
            full[cross] = False
            full = np.flatnonzero(full)
            hit, rank, pairs = _frequent(code[full], bound)
            if len(pairs):
                break
        else:
            break
        if bound == least:
            fresh_from = made
        at = full[hit] if at is None else at[full[hit]]
        begin = np.concatenate([[True], np.diff(at) != 1])  # starts of runs of overlapping pairs
        run = np.flatnonzero(begin)
        even = (at - np.repeat(at[run], np.diff(np.append(run, len(at))))) % 2 == 0
        at, rank = at[even], rank[even]
        left, right = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        rules.append(np.stack([left, right], 1))
        lengths = np.concatenate([lengths, lengths[left] + lengths[right]])
        seq[at] = made + rank
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
        made += len(pairs)
    ends = np.flatnonzero(last) + 1
    table = np.concatenate(rules).astype(np.uint32) if rules else np.zeros((0, 2), np.uint32)
    return table, lengths[first:], seq, np.diff(ends, prepend=0)


def expand(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """Ids behind symbols: each rule is expanded once, then every symbol takes its ids."""
    ids = np.arange(first, first + len(rules), dtype=np.uint32)
    owner = np.arange(len(rules))
    while True:  # nonterminals inside rules become their two parts until none is left
        inner = ids >= first
        if not inner.any():
            break
        at = np.arange(len(ids)) + np.cumsum(inner) - inner
        pair = rules[ids[inner] - first]
        out, whose = np.empty(len(ids) + len(pair), np.uint32), np.repeat(owner, 1 + inner)
        out[at[~inner]] = ids[~inner]
        out[at[inner]], out[at[inner] + 1] = pair[:, 0], pair[:, 1]
        ids, owner = out, whose
    size = np.concatenate([np.ones(first, np.int64), np.bincount(owner, minlength=len(rules))])
    begin = np.cumsum(size) - size
    return np.concatenate([np.arange(first, dtype=np.uint32), ids])[_ranges(begin[symbols], size[symbols])]


def doc_tokens_at(block: dict, n: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids start..stop of document n of a block, expanding only the symbols that cover them."""
    rules = np.frombuffer(block["rules"], np.uint32).reshape(-1, 2)
    first = block["first"]
    lengths = np.concatenate([np.ones(first, np.int64), np.frombuffer(block["lengths"], np.uint32)])
    before = sum(block["doc_symbols"][:n])
    symbols = np.frombuffer(block["symbols"], np.uint32)[before:before + block["doc_symbols"][n]]
    ends = np.cumsum(lengths[symbols])
    stop = int(ends[-1]) if stop is None else min(stop, int(ends[-1]))
    if start >= stop:
        return np.zeros(0, np.uint32)
    lo, hi = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
    skip = start - int(ends[lo - 1] if lo else 0)
    return expand(symbols[lo:hi], rules, first)[skip:skip + stop - start]


# ---- files ----------------------------------------------------------------------

def _blocks(batches) -> Iterator[pa.Table]:
    """Rows of BLOCK_BYTES of text and up to a quarter more, whatever the size of the batches; a longer text ends its block."""
    held, size = [], 0
    for b in text_slices(batches, "text", BLOCK_BYTES // 4):
        held.append(b)
        size += pa.compute.sum(pa.compute.binary_length(b.column("text"))).as_py() or 0
        if size >= BLOCK_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, n_shards: int | None = None) -> None:
    """Encode every whole text in ascending doc_id order and write the shards under `path`."""
    spark = docs.sparkSession
    small_batches(spark)
    shards = n_shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = doc_text(docs, id_col, text_col).repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches):
        encoder = worker_state(f"encoder:{tokenizer}", lambda: WordEncoder(tokenizer))
        shard = TaskContext.get().partitionId()
        for n, b in enumerate(_blocks(batches)):
            ids, count = with_end(*encoder.encode(as_bytes(b.column("text"))), end_id)
            rules, lengths, symbols, doc_symbols = compress(ids, count, encoder.first)
            yield pa.RecordBatch.from_pylist([{
                "shard": shard, "block": n, "first": encoder.first, "n_tokens": len(ids), "doc_ids": b.column("doc_id").to_pylist(),
                "doc_tokens": count.tolist(), "doc_symbols": doc_symbols.tolist(), "rules": rules.tobytes(),
                "lengths": lengths.astype(np.uint32).tobytes(), "symbols": symbols.tobytes()}], schema=_BLOCK_ARROW)

    rows.mapInArrow(encode, BLOCKS).write.mode("overwrite").option("compression", "zstd").parquet(path)


_LONGS = pa.list_(pa.int64())
_BLOCK_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int32()), ("n_tokens", pa.int64()),
                          ("doc_ids", _LONGS), ("doc_tokens", _LONGS), ("doc_symbols", _LONGS), ("rules", pa.binary()),
                          ("lengths", pa.binary()), ("symbols", pa.binary())])


def read_tokens(spark, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32, n_symbols."""
    blocks = spark.read.parquet(path)

    def digest(batches):
        for b in batches:
            for r in b.to_pylist():
                rules = np.frombuffer(r["rules"], np.uint32).reshape(-1, 2)
                raw = expand(np.frombuffer(r["symbols"], np.uint32), rules, r["first"]).astype("<u4").tobytes()
                n = np.array(r["doc_tokens"], np.int64)
                end = np.cumsum(n)
                crc = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(end.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["shard"]] * len(n), pa.int32()), pa.array([r["block"]] * len(n), pa.int32()),
                    pa.array(r["doc_ids"], pa.int64()), pa.array(end - n), pa.array(n), pa.array(crc, pa.int64()),
                    pa.array(r["doc_symbols"], pa.int64())],
                    names=["shard", "block", "doc_id", "inner", "n_tokens", "ids_crc32", "n_symbols"])

    docs = blocks.mapInArrow(digest, "shard int, block int, doc_id long, inner long, n_tokens long, ids_crc32 long, n_symbols long")
    sizes = blocks.select("shard", "block", "n_tokens")
    upto = Window.unboundedPreceding, -1
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    shards = shards.select("shard", F.coalesce(F.sum("size").over(Window.orderBy("shard").rowsBetween(*upto)), F.lit(0)).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block").rowsBetween(*upto))
    begins = sizes.select("shard", "block", F.coalesce(inside, F.lit(0)).alias("before")).join(shards, "shard").select(
        "shard", "block", (F.col("base") + F.col("before")).alias("base"))
    return docs.join(begins, ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32", "n_symbols")


def tokenize(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards into the shared folder and return what they hold, read back."""
    path = shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, id_col, text_col)
    return read_tokens(docs.sparkSession, path)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
