"""Operator 6: toxicity by the nearest labelled examples.

Examples are a bounded sample of labelled documents. Every word of the sample and every beginning of a longer word is a term
of the index. A term's weight in a text is its damped frequency, times its inverse document frequency, times the evidence
that the sample's labels go with it (log-likelihood ratio, plus a floor that keeps every term in): plain TF-IDF is led by
rare words that say nothing about toxicity. Vectors have unit length. The inverted index keeps each term's postings by
falling weight in blocks with their largest weight: blocks are read by what they may add, until those left cannot bring
another example among the nearest, which makes the search exact. Neighbours vote by nearness, smoothed towards the sample's
share of toxic texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_batches, slices, table, whole_text, written

#: Bounds of the labelled sample: rows, and characters of their texts together.
SAMPLE, SAMPLE_CHARS = 3000, 1 << 24
#: What every term's evidence counts at least.
FLOOR = 0.05
#: Neighbours, distance at which a vote is halved, weight of the prior, threshold.
NEIGHBOURS, SOFT, PRIOR, THRESHOLD = 15, 0.02, 8.0, 0.3
#: Postings of a block, what blocks that are not read may add to a cosine at most, neighbours that are named.
BLOCK, SLACK, EVIDENCE = 128, 0.01, 5
WORD = re.compile(r"[^\W\d_]+")
PREFIX = 5
#: Words that a worker remembers, the longest of them.
CACHE, CACHED_CHARS = 100_000, 32


#: ASCII without its letters, as spaces.
_ONLY_LETTERS = str.maketrans({chr(c): " " for c in range(128) if not chr(c).isalpha()})


def words_of(text: str) -> list[str]:
    """The text's runs of letters, in lower case."""
    low = text.lower()
    return low.translate(_ONLY_LETTERS).split() if low.isascii() else WORD.findall(low)


def terms_of(word: str) -> list[str]:
    """A lower-case word's terms: itself and its beginning."""
    return [word, f"{word[:PREFIX]}*"] if len(word) > PREFIX else [word]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of many ranges, one after the other."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


class Vocabulary:
    """Counts a text's terms; remembers the terms of words that it met, as one number: the word's and its beginning's, from 1."""

    def __init__(self, at: dict[str, int]):
        self.at = at
        self.met: dict[str, int] = {}

    def _code(self, word: str) -> int:
        get = self.at.get
        return get(word, -1) + 1 | (get(f"{word[:PREFIX]}*", -1) + 1 << 32 if len(word) > PREFIX else 0)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The text's terms, each once, and how often each stands in it."""
        words = Counter(words_of(text or ""))
        met = self.met
        try:
            codes = np.fromiter(map(met.__getitem__, words), np.int64, len(words))
        except KeyError:
            if len(met) > CACHE:
                met.clear()
            codes = np.empty(len(words), np.int64)
            for i, word in enumerate(words):
                if (code := met.get(word)) is None:
                    code = self._code(word)
                    if len(word) <= CACHED_CHARS:
                        met[word] = code
                codes[i] = code
        times = np.fromiter(words.values(), np.float64, len(words))
        own, shared = codes & 0xFFFFFFFF, codes >> 32
        has, begins = own > 0, shared > 0
        terms, place = np.unique(shared[begins], return_inverse=True)
        return np.r_[own[has], terms] - 1, np.r_[times[has], np.bincount(place, times[begins], len(terms))]


def evidence(docs: np.ndarray, toxic: np.ndarray, n: int, n_toxic: int) -> np.ndarray:
    """Log-likelihood ratio of each term and the label: docs, toxic: how many (toxic) examples hold the term."""
    out = np.zeros(len(docs))
    for have, all_have in ((docs, 1), (n - docs, 0)):
        for label in (n_toxic, n - n_toxic):
            seen = (toxic if label is n_toxic else docs - toxic) if all_have else (n_toxic - toxic if label is n_toxic else n - n_toxic - docs + toxic)
            expected = have * label / max(n, 1)
            out += np.where(seen > 0, 2 * seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-12)), 0.0)
    return np.maximum(out, 0.0)


class BlockMaxIndex:
    """Exact nearest examples by cosine over all terms of the examples."""

    def __init__(self, ids: list, labels: list[int], texts: list[str]):
        at: dict[str, int] = {}
        terms, counts, size = [], [], []
        for text in texts:
            own: dict[int, int] = {}
            for word, times in Counter(words_of(text)).items():
                for t in terms_of(word):
                    i = at.setdefault(t, len(at))
                    own[i] = own.get(i, 0) + times
            terms.append(np.fromiter(own, np.int32, len(own)))
            counts.append(np.fromiter(own.values(), np.float64, len(own)))
            size.append(len(own))
        n, self.vocabulary = len(ids), at
        label, size = np.array(labels, float), np.array(size, np.int64)
        doc = np.repeat(np.arange(n), size)
        term = np.concatenate(terms) if n else np.zeros(0, np.int32)
        held = np.bincount(term, minlength=len(at))
        toxic = np.bincount(term, label[doc], len(at))
        self.weight_of = np.log1p(n / np.maximum(held, 1)) * (FLOOR + evidence(held, toxic, n, int(label.sum())))
        weight = (1 + np.log(np.concatenate(counts))) * self.weight_of[term] if n else np.zeros(0)
        weight /= np.sqrt(np.bincount(doc, weight * weight, n))[doc]
        order = sorted(range(n), key=lambda i: (texts[i], labels[i]))  # ties go by this order, in which ids play no part
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids, self.labels = [ids[i] for i in order], label[order]
        # a term's postings by falling weight, cut into blocks; a block's first posting is its largest
        by = np.lexsort((place[doc], -weight, term))
        self.doc, self.weight = place[doc][by].astype(np.int32), weight[by].astype(np.float32)
        first = np.cumsum(held) - held
        blocks = -(-held // BLOCK)
        self.block_at = np.r_[0, np.cumsum(blocks)]
        start = _ranges(np.zeros(len(held), np.int64), blocks) * BLOCK
        self.block_start = np.repeat(first, blocks) + start
        self.block_size = np.minimum(np.repeat(held, blocks) - start, BLOCK)
        self.block_most = self.weight[self.block_start].astype(np.float64)
        self.cost = np.minimum(held, BLOCK).astype(np.float64)
        self.order = 1 - 1e-9 * (start // BLOCK)
        by = np.argsort(place[doc], kind="stable")
        full = [i for i in range(n) if size[order[i]]]  # a text without words is never near
        self.text_term, self.text_weight, self.text_at = term[by].astype(np.int64), weight[by].astype(np.float32), np.r_[0, np.cumsum(size[order])]
        self.holds = np.zeros(n, bool)
        self.holds[full] = True
        self.dense = np.zeros(len(at), np.float32)
        self.prior = float(label.mean()) if n else 0.0

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Weights of unit length of a text's terms."""
        weight = (1 + np.log(counts)) * self.weight_of[terms]
        return weight / math.sqrt(weight @ weight) if len(weight) else weight

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine, ties by their order in the index, and the cosines.

        Blocks are read by what they may add for each of their postings, until the blocks that are left can add at most SLACK
        to any example, whatever it holds: of a term's blocks that are left only the largest weight counts, as an example
        has one posting. All examples that may then be among the first k are scored whole.
        """
        if not len(terms):
            return np.zeros(0, np.int64), np.zeros(0)
        asked = self.vector(terms, counts)
        n = self.block_at[terms + 1] - self.block_at[terms]
        blocks = _ranges(self.block_at[terms], n)
        weight = np.repeat(asked, n)
        most = weight * self.block_most[blocks]
        after = np.r_[most[1:], 0.0]
        after[np.cumsum(n) - 1] = 0.0
        gain = most / np.repeat(self.cost[terms], n)
        order = np.argsort(gain * self.order[blocks])[::-1]  # a term's own blocks stay in their order
        left = most[np.cumsum(n) - n].sum() - np.cumsum((most - after)[order])
        read = order[: int(np.searchsorted(-left, -SLACK)) + 1]
        slack = max(float(left[len(read) - 1]), 0.0) + 1e-5
        size = self.block_size[blocks[read]]
        where = _ranges(self.block_start[blocks[read]], size)
        added = self.weight.take(where, mode="clip") * np.repeat(weight[read].astype(np.float32), size)
        near = np.bincount(self.doc.take(where, mode="clip"), added, len(self.ids))
        bar = np.partition(near, len(near) - k)[len(near) - k] - slack if len(near) > k else -1.0
        best = np.flatnonzero((near >= bar) & self.holds)
        self.dense[terms] = asked
        size = self.text_at[best + 1] - self.text_at[best]
        where = _ranges(self.text_at[best], size)
        part = self.dense.take(self.text_term.take(where, mode="clip"), mode="clip") * self.text_weight.take(where, mode="clip")
        self.dense[terms] = 0
        score = np.add.reduceat(part, np.cumsum(size) - size, dtype=np.float64) if len(best) else np.zeros(0)
        top = np.lexsort((best, -score))[:k]
        return best[top], score[top]

    def judge(self, terms: np.ndarray, counts: np.ndarray) -> tuple[float, list]:
        """The vote and the ids of the nearest examples."""
        best, score = self.nearest(terms, counts)
        vote = 1 / (np.maximum(1 - score, 0) + SOFT)
        value = (vote @ self.labels[best] + PRIOR * self.prior) / (vote.sum() + PRIOR)
        return float(min(max(value, 0.0), 1.0)), [self.ids[i] for i in best[:EVIDENCE].tolist()]


def _least_hashes(ids: DataFrame, n: int, sample: int) -> DataFrame:
    """The sample rows with the least hashes. A bar somewhat above the last one's keeps the others from being sorted."""
    if n > 2 * sample:
        bar = -(1 << 63) + int((1 << 64) * (sample + 8 * math.sqrt(sample)) / n)
        ids = ids.where(F.xxhash64("id") < F.lit(bar))
    return ids.orderBy(F.xxhash64("id"), "id").limit(sample)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> BlockMaxIndex:
    """Index of the labelled documents (label 0 or 1), of which a bounded sample by hash of the id is used.

    The sample is the first rows by hash, at most sample of them and at most chars characters together, so what comes to
    the driver is bounded. Ids and labels that are null are left out; an id that is labelled twice has its larger label,
    and of an id's repeated texts the least counts.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    known = written(known, "labels")
    chosen = _least_hashes(known, known.count(), sample)
    own = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    examples = written(own.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text")).withColumn("h", F.xxhash64("id")), "labelled-sample")
    sizes = sorted((r["h"], r["id"], r["n"]) for r in examples.select("h", "id", F.length("text").alias("n")).collect())  # sample rows at most
    total = np.cumsum([n for _, _, n in sizes])
    fit = int(np.searchsorted(total, chars, "right"))
    if not fit:
        return BlockMaxIndex([], [], [])
    last = sizes[fit - 1][0]
    rows = sorted(examples.where(F.col("h") <= F.lit(last)).collect(), key=lambda r: (r["h"], r["id"]))[:fit]
    return BlockMaxIndex([r["id"] for r in rows], [r["label"] for r in rows], [r["text"] for r in rows])


def score(docs: DataFrame, index: BlockMaxIndex, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), score_as: str = "score", evidence_as: str = "evidence") -> DataFrame:
    """One row per row of docs: id_col, the columns in keep, score, evidence (ids of the nearest examples).

    A null or empty text, or one that has no term of the index, has the sample's share of toxic texts as its score and no
    evidence; with no labelled example at all every score is 0. Very long texts are read whole, one at a time. Ties at the
    last neighbour go to the example whose heaviest term and then whose text comes first; ids play no part. Repeated rows
    get the same score; null ids stay null. Other columns than those in keep are not read; where one of these has the
    name of a result, give the result another. An empty table gives an empty result.
    """
    columns = list(dict.fromkeys((id_col, *keep)))
    kinds = [docs.schema[c].dataType for c in columns]
    names = [f"c{i}" for i in range(len(columns))]  # Arrow batches with names that any column may have
    schema = T.StructType([*map(T.StructField, names, kinds), T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(kinds[0]))])
    own = len(columns)
    text = columns.index(text_col) if text_col in columns else own
    shared = docs.sparkSession.sparkContext.broadcast(index)  # its size is bounded by the sample's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        counter = Vocabulary(index.vocabulary)
        for batch in slices(batches, text, 2 << 20):
            out = [index.judge(*counter.counts(body)) for body in batch.column(text).to_pylist()]
            kind = pa.list_(batch.schema.field(0).type)
            yield pa.record_batch([*batch.columns[:own], pa.array([s for s, _ in out], pa.float64()), pa.array([e for _, e in out], kind)], names=[*names, "score", "evidence"])

    given = [F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)]
    judged = in_batches(docs.select(*given, *([] if text < own else [F.col(text_col).alias("text")])), run, schema)
    return judged.select(*(F.col(n).alias(c) for c, n in zip([*columns, score_as, evidence_as], judged.columns, strict=True)))


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, **shape) -> DataFrame:
    """Scores of docs by labels outside the held-out fold."""
    return score(docs, learn(docs, labels.where(~held_out())), **shape)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
