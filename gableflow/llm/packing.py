"""Operator 9: packing by concatenate and cut.

The first pass tokenizes every document once and writes its ids with its place in its partition, a running sum that the
task keeps itself. The partitions' token totals, one number for each task, give every partition's offset in the one long
stream by a prefix sum. The second pass cuts the stream into fixed windows: a document's pieces are the boundary records
between its own start and end, and no task needs to know another's documents.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import held, in_batches, slices, table, whole_text, written

WINDOW, END_ID = 2048, 1
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker remembers, the longest of them (others are tokenized each time), bytes of text at a time.
CACHE, CACHED_BYTES, SLICE = 800_000, 96, 4 << 20
#: One run of Latin letters, of which the tokenizer makes one pre-token, and the marks that may follow it as the next.
LETTERS, MARKS = r"[A-Za-zÀ-ÖØ-öø-ÿ]+", bytes(c for c in range(33, 127) if not chr(c).isalnum())

#: The characters by which the tokenizer shows bytes that are not printed as themselves.
SHOWN = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173]) if b >= 127}


class WordIds:
    """Ids of texts under a tokenizer that never joins what stands on both sides of ASCII white space, and folds case.

    Its pre-tokens end in a token that is marked as an end, so letter words can be tokenized many at once and told apart
    in the result; words of any other kind are tokenized one by one.
    """

    def __init__(self, path: str, cache: int = CACHE):
        self.cache = cache
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # words of LETTERS in lower case are their own pre-tokens: the rules that find these in any text are left out for them
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.latin = re.compile(LETTERS)
        self.known: dict[bytes, bytes] = {}
        self.long: list[bytes] = []

    def _learn(self, fresh: list[bytes]) -> None:
        known, cores, others, rest, joined, latin = self.known, set(), set(), [], [], self.latin.fullmatch
        for word in fresh:
            if word.isalpha():  # bytes: only A-Z and a-z are alpha
                cores.add(word)
                continue
            core = word.rstrip(MARKS)
            if core.isalpha() or (not core.isascii() and latin(core.decode())):
                if core not in known:
                    (cores if core.isascii() else others).add(core)
                if len(core) < len(word):
                    marks = word[len(core) :]
                    joined.append((word, core, marks))
                    if marks not in known:
                        rest.append(marks)
            else:
                rest.append(word)
        rest = list(dict.fromkeys(rest))
        for word, got in zip(rest, self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False), strict=True):
            known[word] = np.array(got.ids, "<u2").tobytes()
        for own in (list(cores), list(others)):
            for at in range(0, len(own), 4096):
                some = own[at : at + 4096]
                text = b" ".join(some).decode().lower()
                if not text.isascii():
                    text = text.encode().decode("latin-1").translate(SHOWN)
                ids = np.array(self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids)
                stop = (2 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
                packed, start = ids.astype("<u2").tobytes(), 0
                for core, end in zip(some, stop, strict=True):
                    known[core] = packed[start:end]
                    start = end
        for word, core, marks in joined:
            known[word] = known[core] + known[marks]

    def packed(self, texts: list[str | bytes | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 16-bit numbers. Texts may come as UTF-8."""
        raw = [t if isinstance(t, bytes) else (t or "").encode() for t in texts]
        split = [(t if b"<|" in t else t.lower()).split() for t in raw]  # special tokens keep their case
        ids = [list(map(self.known.get, words)) for words in split]
        fresh: set[bytes] = set()
        holes = []
        for words, own in zip(split, ids, strict=True):
            if None in own:
                at = [i for i, x in enumerate(own) if x is None]
                fresh.update(map(words.__getitem__, at))
                holes.append((words, own, at))
        if len(self.known) + len(fresh) > self.cache:
            self.known = {w: x for words, own in zip(split, ids, strict=True) for w, x in zip(words, own, strict=True) if x is not None}
        self._learn(list(fresh))
        for words, own, at in holes:
            for i in at:
                own[i] = self.known[words[i]]
        for word in fresh:
            if len(word) > CACHED_BYTES:
                del self.known[word]
        return list(map(b"".join, ids))

    def coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
        """The words of all texts in order, as places in a list of distinct words; where each text's begin and the last one's end; that list, and the ids of each.

        A text with white space around it has empty words there, which have no ids. Words are lower-case, but for the
        texts with special tokens, which keep their case.
        """
        special = pa.compute.match_substring(texts, "<|")
        low = pa.compute.ascii_lower(texts)
        split = pa.compute.ascii_split_whitespace(pa.compute.if_else(special, texts, low) if pa.compute.any(special).as_py() else low)
        begin = split.offsets.to_numpy()
        found = split.flatten().dictionary_encode()
        met = texts_in(found.dictionary)
        for word in self.long:
            self.known.pop(word, None)
        self.long = [w for w in met if len(w) > CACHED_BYTES]
        fresh = [w for w in met if w not in self.known]
        if len(self.known) + len(fresh) > self.cache:
            self.known = {w: ids for w in met if (ids := self.known.get(w)) is not None}
        self._learn(fresh)
        return found.indices.to_numpy(), begin - begin[0], found.dictionary, pa.array(list(map(self.known.__getitem__, met)), pa.binary())


def texts_in(column: pa.Array) -> list[bytes]:
    """The bytes of all values of a column of strings or binaries without nulls: as to_pylist, and faster for many short ones."""
    data = column.cast(pa.binary())
    _, offsets, values = data.buffers()
    if values is None or not len(data):
        return [b""] * len(data)
    at = np.frombuffer(offsets, np.int32)[data.offset : data.offset + len(data) + 1].tolist()
    raw = values.to_pybytes()
    return [raw[a:b] for a, b in zip(at, at[1:])]


def word_ids(path: str, cache: int = CACHE) -> WordIds:
    """The worker's own instance, kept from task to task."""
    return held(("words", path, cache), lambda: WordIds(path, cache))


def tokenized(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int, cache: int = CACHE) -> DataFrame:
    """(id, part, first, n, ids): a document's ids with the end id, as 16-bit numbers, and where they start in its partition's stream."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, at = word_ids(path, cache), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u2").tobytes()
        for batch in slices(batches, "text", SLICE):
            ids = [x + end for x in words.packed(batch.column(1).cast(pa.binary()).to_pylist())]
            n = np.fromiter((len(x) // 2 for x in ids), np.int64, len(ids))
            first = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.record_batch([batch.column(0), pa.array(np.full(len(ids), part, np.int64)), pa.array(first), pa.array(n), pa.array(ids, pa.binary())], names=["id", "part", "first", "n", "ids"])

    return in_batches(docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")), run, f"id {kind}, part bigint, first bigint, n bigint, ids binary", ("words", path, cache))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = WINDOW, path: str | None = None, end_id: int = END_ID, cache: int = CACHE) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (binary, 32-bit little-endian).

    Documents stand in the stream partition after partition, in the order in which their partition is read. Every sequence
    but the last has exactly window tokens. A null or empty text is its end id alone. Rows that repeat an id are packed
    like any other row; null ids stay null. A very long text is tokenized whole and has as many pieces as windows that it
    meets. Other columns are neither read nor returned. An empty table has no pieces. cache: words that a worker remembers.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    stream = written(tokenized(docs, id_col, text_col, path, end_id, cache), "token-stream")
    totals = stream.groupBy("part").agg(F.sum("n").alias("total"))
    # one row for each task of the first pass
    offsets = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            begin = batch.column(1).to_numpy() + batch.column(2).to_numpy()
            n = batch.column(3).to_numpy()
            pieces = (begin + n - 1) // window - begin // window + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = begin[doc] // window + nth
            a = np.maximum(begin[doc], sequence * window)
            b = np.minimum(begin[doc] + n[doc], (sequence + 1) * window)
            start, length = a - begin[doc], b - a
            ids = batch.column(4)
            cut = []
            for d, s, k in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True):
                if s == 0:
                    own = np.frombuffer(ids[d].as_buffer(), "<u2").astype("<u4")
                cut.append(own[s : s + k].tobytes())
            crc = np.fromiter(map(zlib.crc32, cut), np.int64, len(cut))
            yield pa.record_batch(
                [batch.column(0).take(pa.array(doc)), *map(pa.array, (start, length, crc, n[doc], sequence, a - sequence * window)), pa.array(cut, pa.binary())],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    placed = stream.join(F.broadcast(offsets), "part").select("id", "base", "first", "n", "ids")
    out = in_batches(placed, run, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
    return out.withColumnRenamed("id", id_col)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
