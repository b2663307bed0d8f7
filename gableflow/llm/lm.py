"""Operator 5: language-model scoring.

Two scores of every text. The base score is a smoothed word unigram: counts are exact over all training documents; the
commonest words' counts are broadcast up to a fixed number, the rest are joined. The model is a causal self-attention
model over subword ids (see attention.py): outputs and shares come from counts over all training documents, and the
weights from every subword of every training document as a target. Each document is dealt by its hash to one of a few
rounds and to one of the round's trainers, whose number grows with the subwords; after a round the trainers' weights are
averaged, and the next one starts from there. Texts are tokenized once, into a written table that both training and
scoring read. What is learned depends on the documents alone, not on how the table is cut into partitions.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .attention import BATCH, BUCKETS, KINDS, WINDOW, Outputs, Scorer, Trainer, portions, start_weights, texts_of, training_windows
from .common import discard, in_batches, slices, table, whole_text, written
from .packing import TOKENIZER, texts_in, word_ids

#: Smoothing of the base; words whose counts are broadcast.
ADD, COMMON = 0.1, 400_000
#: Subwords that one trainer goes through, where each round ends as a share of the documents, rows that are averaged at a time.
PER_TRAINER, ROUNDS, FAN = 1 << 23, (0.125, 0.5, 1.0), 4
#: Words counted in memory before they are passed on, words whose ids a worker remembers, bytes of text at a time.
FLUSH, REMEMBERED, SLICE = 400_000, 750_000, 12 << 20
#: The end of a text: the word that no text holds, and the tokenizer's own end token.
END, END_TOKEN = "", "<|endoftext|>"


def held_out(id_col: str = "doc_id"):
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(False))


def gathered(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches put together, or cut, so that the texts of each stay near max_bytes: a word then counts once for many rows."""
    some, n = [], 0
    for batch in slices(batches, text, max_bytes):
        size = batch.column(text).nbytes
        if some and n + size > max_bytes:
            yield pa.concat_batches(some)
            some, n = [], 0
        some.append(batch)
        n += size
    if some:
        yield pa.concat_batches(some)


def _sums(words: list[pa.Array], counts: list[pa.Array]) -> tuple[pa.Array, pa.Array]:
    """Distinct words with the sums of their counts."""
    sums = pa.table({"word": pa.chunked_array(words, pa.string()), "n": pa.chunked_array(counts, pa.int64())}).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return tuple(pa.concat_arrays(sums.column(c).chunks) for c in ("word", "n_sum"))


def _read(docs: DataFrame, id_col: str, text_col: str, held, path: str, end_id: int) -> DataFrame:
    """Rows of documents (row, id, held_out, text, ids) and rows of training words with counts (word, n), in one pass."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(path, REMEMBERED), np.array([end_id], "<u2").tobytes()
        own: tuple[list[pa.Array], list[pa.Array]] = [], []
        names = ["row", "id", "held_out", "text", "ids", "word", "n"]

        def count(some: pa.Array, counts: np.ndarray) -> None:
            own[0].append(some.cast(pa.string()))
            own[1].append(pa.array(counts, pa.int64()))

        def passed_on(most: int) -> Iterator[pa.RecordBatch]:
            """The counts, if they are of more than so many words."""
            some, counts = _sums(*own)
            own[0][:], own[1][:] = [some], [counts]
            if len(some) > most:
                n = len(some)
                own[0].clear()
                own[1].clear()
                yield pa.record_batch([pa.nulls(n, pa.int64()), pa.nulls(n, id_type), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.string()), pa.nulls(n, pa.binary()), some, counts], names=names)

        for batch in gathered(batches, "text", SLICE):
            id_type, n = batch.schema.field("id").type, batch.num_rows
            texts, learned = batch.column("text"), ~np.array(batch.column("held_out").to_pylist(), bool)
            places, begin, met, ids = words.coded(texts)
            packed = ids.take(pa.array(places))
            at, data = np.frombuffer(packed.buffers()[1], np.int32)[begin].tolist(), packed.buffers()[2]
            data = data.to_pybytes() if data is not None else b""
            yield pa.record_batch([batch.column("row"), batch.column("id"), batch.column("held_out"), texts, pa.array([data[a:b] + end for a, b in zip(at, at[1:])], pa.binary()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], names=names)
            special = pa.compute.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
            counts = np.bincount(places[np.repeat(learned & ~special, np.diff(begin))], minlength=len(met))
            counts[pa.compute.binary_length(met).to_numpy() == 0] = 0
            count(met.filter(pa.array(counts > 0)), counts[counts > 0])
            for text in texts.filter(pa.array(learned & special)).cast(pa.binary()).to_pylist():
                seen = Counter(text.lower().split())
                count(pa.array(list(seen), pa.binary()), np.array(list(seen.values()), np.int64))
            if learned.any():
                count(pa.array([END]), learned.sum()[None])
            if sum(map(len, own[0])) > 2 * FLUSH:
                yield from passed_on(FLUSH)
        if own[0]:
            yield from passed_on(0)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), held.alias("held_out"), whole_text(text_col).alias("text"))
    return written(in_batches(rows, run, f"row bigint, id {kind}, held_out boolean, text string, ids binary, word string, n bigint", ("words", path, REMEMBERED)), "texts-and-words")


def _counts_after(texts: DataFrame, vocabulary: int, kind: np.ndarray) -> np.ndarray:
    """How often each subword stands after each kind of subword, over all training documents. kind: of every id, and of the start."""
    kinds = int(kind.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary * kinds, np.int64)
        for batch in slices(batches, "ids"):
            for packed in portions(iter(batch.column(0).to_pylist()), 1 << 20):
                ids, size = texts_of(packed)
                before = np.r_[np.int64(0), kind[ids[:-1]]]
                before[np.cumsum(size) - size] = kind[-1]
                total += np.bincount(ids * kinds + before, minlength=len(total))
        total = total.reshape(vocabulary, kinds)
        seen = np.flatnonzero(total.any(axis=1))
        yield pa.record_batch([pa.array(seen), *(pa.array(total[seen, b]) for b in range(kinds))], names=["token", *(f"b{b}" for b in range(kinds))])

    schema = "token bigint, " + ", ".join(f"b{b} bigint" for b in range(kinds))
    sums = in_batches(texts.select("ids"), run, schema).groupBy("token").agg(*(F.sum(f"b{b}").alias(f"b{b}") for b in range(kinds)))
    got = sums.toArrow()  # one row for each token of the vocabulary at most
    out = np.zeros((vocabulary, kinds), np.int64)
    at = got.column("token").to_numpy()
    for b in range(kinds):
        out[at, b] = got.column(f"b{b}").to_numpy()
    return out


def _mean(rows: list[dict]) -> tuple[int, np.ndarray]:
    """Windows of all rows, and the mean of their weights by windows, added up in the order of their places."""
    rows = sorted(rows, key=lambda r: r["place"])
    windows = sum(r["windows"] for r in rows)
    total = sum(np.frombuffer(r["weights"], np.float32) * np.float64(r["windows"]) for r in rows)
    return windows, (total / windows).astype(np.float32)


def _averaged(got: DataFrame) -> np.ndarray | None:
    """got (place, windows, weights) -> the mean of the weights by windows, in the order of places.

    Rows are added up FAN at a time until FAN are left for the driver: it sees a fixed number of bytes whatever their number.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        for place in sorted({r["place"] // FAN for r in rows}):
            windows, mean = _mean([r for r in rows if r["place"] // FAN == place])
            yield pa.record_batch([pa.array([place]), pa.array([windows]), pa.array([mean.tobytes()], pa.binary())], names=["place", "windows", "weights"])

    n = got.agg(F.max("place")).first()[0]
    while n is not None and n >= FAN:
        n //= FAN
        fewer = written(in_batches(got.repartition(n + 1, F.floor(F.col("place") / FAN)), work, "place bigint, windows bigint, weights binary"), "averages")
        discard(got)
        got = fewer
    rows = [r.asDict() for r in got.collect()]
    discard(got)
    return _mean(rows)[1] if rows else None


def _places(spark: SparkSession, n: int):
    """A column that repartition(n) sends to the partition of its trainer's number, so that no task gets two while others get none.

    For many trainers the hash alone evens out what tasks get.
    """
    if n > 4096:
        return F.col("trainer")
    found = spark.range(64 * n).select(F.pmod(F.hash("id"), F.lit(n)).alias("place"), "id").groupBy("place").agg(F.min("id").alias("id")).collect()
    by = {r["place"]: r["id"] for r in found}
    return F.element_at(F.array(*(F.lit(by.get(t, t)).cast("bigint") for t in range(n))), F.col("trainer").cast("int") + 1)


def _train(texts: DataFrame, outputs: Outputs, subwords: int, per_trainer: int) -> np.ndarray:
    """Weights from all training documents, dealt by a hash of their id and text."""
    vocabulary = len(outputs.of)
    flat = start_weights(vocabulary, outputs.bias)
    share = F.pmod(F.xxhash64("id", "ids", F.lit("round")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    begin = 0.0
    for r, stop in enumerate(ROUNDS):
        part = subwords * (stop - begin)
        trainers = max(1, round(part / per_trainer))
        shared = texts.sparkSession.sparkContext.broadcast((flat, outputs))
        expected = int(part / trainers / WINDOW / BATCH)

        def work(batches: Iterator[pa.RecordBatch], shared=shared, r: int = r, expected: int = expected) -> Iterator[pa.RecordBatch]:
            flat, outputs = shared.value
            trainer, now = None, None

            def done() -> pa.RecordBatch:
                return pa.record_batch([pa.array([now]), pa.array([trainer.windows]), pa.array([trainer.finish().tobytes()], pa.binary())], names=["place", "windows", "weights"])

            for batch in slices(batches, "ids"):
                place, packed = batch.column("trainer").to_numpy(), batch.column("ids")
                for t in np.unique(place).tolist():
                    if t != now:
                        if trainer is not None:
                            yield done()
                        trainer, now = Trainer(flat, len(outputs.of), expected, 1000 * r + t), t
                    own = np.flatnonzero(place == t)  # rows are in the order of their trainers
                    for some in portions((x.as_py() for x in packed.slice(own[0], len(own))), 1 << 18):
                        trainer.feed(training_windows(*texts_of(some), outputs))
            if trainer is not None:
                yield done()

        own = texts.where((share >= begin) & (share < stop)).select("ids", F.pmod(F.xxhash64("id", "ids"), F.lit(trainers)).alias("trainer"), F.xxhash64("id", "ids", F.lit("order")).alias("number"))
        dealt = own.repartition(trainers, _places(texts.sparkSession, trainers)).sortWithinPartitions("trainer", "number").select("trainer", "ids")
        got = _averaged(written(in_batches(dealt, work, "place bigint, windows bigint, weights binary"), "trained"))
        if got is not None:
            flat = got
        begin = stop
    return flat


def _least_common(counts: DataFrame, common: int) -> int:
    """The count from which on words are broadcast, so that there are at most common of them: from a histogram of some hundred steps."""
    steps = counts.groupBy(F.floor(F.log2("c") * 16).alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("least")).orderBy(F.desc("step")).collect()
    least, words = 1 << 62, 0
    for r in steps:
        words += r["n"]
        if words > common:
            break
        least = r["least"]
    return least


def _score(texts: DataFrame, common: pa.Array, gains: np.ndarray, total: int, distinct: int, model: Scorer) -> DataFrame:
    """Documents' rows with the model's score and the base score of common words, and a row for each rarer word of each. gains: of the common words."""
    spark = texts.sparkSession
    kind = texts.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast((common, gains, model))
    bottom = math.log10(total + ADD * (distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, gains, model = shared.value
        names = ["row", "id", "held_out", "n_tokens", "known", "base", "score", "word", "n"]
        for batch in gathered(batches, "text", SLICE):
            n, ids = batch.num_rows, texts_in(batch.column("ids"))
            size = np.fromiter((len(x) // 2 for x in ids), np.int64, n)
            score = model.score(np.frombuffer(b"".join(ids), "<u2"), size)
            split = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(batch.column("text")))
            words, own = split.flatten(), np.repeat(np.arange(n), np.diff(split.offsets.to_numpy()))
            real = pa.compute.binary_length(words).to_numpy() > 0  # white space around a text leaves empty words
            words = pa.concat_arrays([words if real.all() else words.filter(pa.array(real)), pa.array([END] * n, words.type)])
            own = np.r_[own[real], np.arange(n)]
            place = pa.compute.fill_null(pa.compute.index_in(words, common), -1).to_numpy()
            tokens, is_known = np.bincount(own, minlength=n), place >= 0
            known = np.bincount(own[is_known], minlength=n)
            base = np.bincount(own[is_known], gains[place[is_known]], n) - bottom * tokens
            yield pa.record_batch([batch.column("row"), batch.column("id"), batch.column("held_out"), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(score), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], names=names)
            rare = words.filter(pa.array(~is_known)).dictionary_encode()
            if len(rare):
                pairs, counts = np.unique(own[~is_known] * len(rare.dictionary) + rare.indices.to_numpy(), return_counts=True)
                of, word = np.divmod(pairs, len(rare.dictionary))
                m = len(pairs)
                empty = [pa.nulls(m, x) for x in (batch.schema.field("id").type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                yield pa.record_batch([batch.column("row").take(pa.array(of)), *empty, rare.dictionary.take(pa.array(word)), pa.array(counts, pa.int64())], names=names)

    schema = f"row bigint, id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, score double, word string, n bigint"
    return in_batches(texts.select("row", "id", "held_out", "text", "ids"), run, schema)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, held=None, path: str | None = None, common: int = COMMON, per_trainer: int = PER_TRAINER) -> DataFrame:
    """One row per row of docs: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score.

    held tells which rows nothing is learned from. A null or empty text is its end alone. Rows that repeat an id are read,
    learned from and scored each; null ids stay null and are learned from. Other columns are neither read nor returned. An
    empty table gives an empty result; without training documents no token is known, and the model is as it starts. Very
    long texts are trained on and scored whole, window by window. Documents alike in id and text go to the same trainer.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    words = word_ids(path, REMEMBERED)
    vocabulary, end_id = len(words.ends), words.tokenizer.token_to_id(END_TOKEN)
    read = _read(docs, id_col, text_col, held_out(id_col) if held is None else held, path, end_id)
    texts = read.where(F.col("row").isNotNull()).select("row", "id", "held_out", "text", "ids")
    counts = written(read.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    whole = counts.agg(F.sum("c").alias("total"), F.count("*").alias("distinct")).first()
    total, distinct = whole["total"] or 0, whole["distinct"]
    least = _least_common(counts, common)
    top = counts.where(F.col("c") >= least).toArrow()
    known = pa.array([], pa.string()) if not len(top) else pa.concat_arrays(top.column("word").chunks)

    learned = texts.where(~F.col("held_out"))
    before = _counts_after(learned, vocabulary, np.r_[np.arange(vocabulary) % BUCKETS, 0])
    outputs = Outputs(before)
    outputs.add_shares(_counts_after(learned, vocabulary, outputs.kind))
    model = Scorer(_train(learned.select("id", "ids"), outputs, int(before.sum()), per_trainer), outputs)
    scored = written(_score(texts, known, np.log10(top.column("c").to_numpy() + ADD), total, distinct, model), "scored")
    rest = counts.where(F.col("c") < least)
    rare = scored.where(F.col("word").isNotNull()).select("row", "word", "n").join(rest, "word", "left")
    gain = F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + F.lit(ADD))
    sums = written(rare.groupBy("row").agg(F.sum(gain).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known")), "rare-words")
    out = scored.where(F.col("word").isNull()).join(sums, "row", "left")
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
