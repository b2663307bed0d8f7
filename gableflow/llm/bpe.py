"""Operator 8: token counts by rank-synchronous array merging.

A batch's pre-tokens are one ragged numpy array of symbols. In each round every sequence finds its lowest-rank pair and
all sequences apply theirs at the same time; a sequence without a pair is done. Merging a pair everywhere in its sequence
at once gives what one merge at a time gives, because a pair that holds the new symbol always ranks behind it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held, in_batches, slices, table, whole_text

TOKENIZER, LIMIT = "byte_bpe_50k.json", 1024
#: Words that a worker remembers, and the longest that it remembers.
CACHE, CACHED_CHARS = 1 << 19, 64
NONE = np.int64(1 << 40)
#: Marks a run's first word, which has no space before it. No text holds a lone surrogate.
FIRST = "\ud800"


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, as published with it."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE vocabulary with its merges as sorted arrays, and words met before."""

    def __init__(self, path: str, pattern: str | None = None):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.first = np.zeros(256, np.int64)
        for shown, byte in byte_symbols().items():
            self.first[byte] = vocab[shown]
        pair = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(pair, kind="stable")
        self.pair, self.rank, self.made = pair[order], np.arange(len(merges))[order], made
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pre = regex.compile(pattern or public_tokenizers.PATTERN)
        self.unsafe, self.cut = regex.compile(r" (?!\S)"), regex.compile(r" (?=\S)")
        self.counts: dict[str, int] = {}
        self.ids: dict[str, bytes] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.rank[at], NONE)

    def merged(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Non-empty pre-tokens -> (symbols that survive, in the order of tokens; how many each token has)."""
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        symbol = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), size)
        at = np.arange(len(symbol))  # a symbol's place among all bytes keeps the order of those that are done
        done: list[tuple[np.ndarray, ...]] = []
        if len(symbol):
            rank = np.full(len(symbol), NONE)
            rank[:-1] = np.where(owner[1:] == owner[:-1], self.ranks(symbol[:-1], symbol[1:]), NONE)
        while len(symbol):
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            width = np.diff(np.r_[start, len(symbol)])
            lowest = np.repeat(np.minimum.reduceat(rank, start), width)
            live = lowest < NONE
            if not live.all():
                done.append((at[~live], symbol[~live], owner[~live]))
                at, symbol, owner, rank, lowest = (x[live] for x in (at, symbol, owner, rank, lowest))
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == lowest)
            # in a run such as "aaa" the pair may be taken at every other place only
            run = np.cumsum(np.r_[True, np.diff(hit) > 1]) - 1
            lead = np.flatnonzero(np.r_[True, np.diff(hit) > 1])
            hit = hit[(np.arange(len(hit)) - lead[run]) % 2 == 0]
            symbol[hit] = self.made[rank[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            new = hit - np.arange(len(hit))  # where the new symbols stand after the cut
            at, symbol, owner, rank = (x[keep] for x in (at, symbol, owner, rank))
            changed = np.unique(np.r_[new, new[new > 0] - 1])
            last = changed == len(symbol) - 1
            inner = changed[~last]
            rank[inner] = np.where(owner[inner] == owner[inner + 1], self.ranks(symbol[inner], symbol[inner + 1]), NONE)
            rank[changed[last]] = NONE
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(tokens), np.int64)
        at, symbol, owner = (np.concatenate(x) for x in zip(*done, strict=True))
        return symbol[np.argsort(at)], np.bincount(owner, minlength=len(tokens))

    def words(self, text: str) -> list[str]:
        """Cut before a space that a visible character follows: no pre-token reaches over such a place."""
        parts = self.cut.split(text) if self.unsafe.search(text) else text.split(" ")
        return [FIRST + parts[0], *parts[1:]]  # the first has no space before it

    def learn(self, words: set[str], want_ids: bool) -> None:
        """Count, or give ids for, words that are not known yet. Words but the first stand for themselves after a space."""
        fresh = list(words)
        pre: dict[bytes, int] = {}
        members, sizes = [], []
        for w in fresh:
            own = [pre.setdefault(t.encode(), len(pre)) for t in self.pre.findall(w[1:] if w[:1] == FIRST else " " + w)]
            members += own
            sizes.append(len(own))
        tokens = list(pre)
        symbols, count = self.merged(tokens)
        members, sizes = np.array(members, np.int64), np.array(sizes, np.int64)
        if want_ids:
            ends = np.cumsum(count)
            packed = symbols.astype("<u2").tobytes()
            each = [packed[2 * (e - n) : 2 * e] for e, n in zip(ends.tolist(), count.tolist(), strict=True)]
            at = 0
            for w, n in zip(fresh, sizes.tolist(), strict=True):
                self.ids[w] = b"".join(each[i] for i in members[at : at + n].tolist())
                at += n
        else:
            total = np.r_[0, np.cumsum(count[members])] if len(members) else np.zeros(1, np.int64)
            ends = np.cumsum(sizes)
            self.counts.update(zip(fresh, (total[ends] - total[ends - sizes]).tolist(), strict=True))

    def _split(self, texts: list[str | None], known: dict, want_ids: bool) -> tuple[list[list[list[str]]], list[str]]:
        split = []
        for t in texts:
            t = t or ""
            runs = self.at_special.split(t) if self.at_special and any(s in t for s in self.special) else [t]
            split.append([r if r in self.special and i % 2 else self.words(r) for i, r in enumerate(runs)])
        met = set(chain.from_iterable(w for doc in split for w in doc if isinstance(w, list)))
        fresh = met.difference(known)
        if len(known) + len(fresh) > CACHE:
            known.clear()
            fresh = met
        if fresh:
            self.learn(fresh, want_ids)
        return split, [w for w in fresh if len(w) > CACHED_CHARS]

    def count(self, texts: list[str | None]) -> list[int]:
        split, long = self._split(texts, self.counts, False)
        get = self.counts.__getitem__
        out = [sum(1 if isinstance(w, str) else sum(map(get, w)) for w in doc) for doc in split]
        for w in long:
            del self.counts[w]
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids as little-endian unsigned 16-bit numbers."""
        split, long = self._split(texts, self.ids, True)
        get = self.ids.__getitem__
        out = [b"".join(np.array([self.special[w]], "<u2").tobytes() if isinstance(w, str) else b"".join(map(get, w)) for w in doc) for doc in split]
        for w in long:
            del self.ids[w]
        return out


def byte_bpe(path: str) -> ByteBpe:
    """The worker's own instance, kept from task to task."""
    return held(("bpe", path), lambda: ByteBpe(path))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per row of docs: id_col, n_bytes, n_tokens, over_limit.

    Tokens are those of the tokenizers library for the file: no begin or end token, and a special token's string inside a
    text is that token. A null or empty text has none. Very long texts are counted whole, a pre-token of any length too.
    Repeated rows are counted each; null ids stay null. Other columns are neither read nor returned. An empty table gives
    an empty result.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in slices(batches, "text"):
            n = bpe.count(batch.column(1).to_pylist())
            size = pa.compute.binary_length(batch.column(1)).cast(pa.int64())
            yield pa.record_batch([batch.column(0), size, pa.array(n, pa.int64()), pa.array([x > limit for x in n])], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return in_batches(docs.select(F.col(id_col), whole_text(text_col).alias("text")), run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean", ("bpe", path))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
