"""Operators against brute force, libraries, held-out labels and DuckDB."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from gableflow.llm import attention, bpe, exact_dedup, lm, merkle, mixing, packing, pii, queries, reputation, simhash, toxicity

from .helpers import agree, frame, oracle

SF = "/root/testdata/sf0.001"
ALPHABET = [" ", "  ", "\n", " \n", "\t", "\x1c", "\x85", "\xa0", "\u3000", "a", "b", "ab", "aaa", "e\u0301", "é", "1", "22", "'s", "'ll", "<|endoftext|>", "<|endof", "!", "...", "中", "😀", "\u200b", "İ", "Σ", "ß", "\x00", "K", "WORD", "Word."]


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def fuzz():
    rng = random.Random(3)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) for _ in range(5000)]


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, name):
    agree(queries.QUERIES[name](spark, SF), oracle(queries.ORACLES[name], SF, ["documents", "pages", "labels"]))


def test_exact_dedup_bears_colliding_hashes(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    agree(exact_dedup.exact_dedup(table, hash_bits=3, least=64), oracle(exact_dedup.ORACLE_SQL, SF, ["documents"]))


def test_chunks_are_the_text(spark, docs):
    rows = spark.createDataFrame(docs, "doc_id long, text string").select("text", exact_dedup.chunks_of(simhash.F.col("text")).alias("c")).collect()
    assert all("".join(r.c) == r.text for r in rows) and all(len(c) <= exact_dedup.MAX_CHUNK for r in rows for c in r.c)


def test_mixing_targets(spark):
    rows = [(i, "a" if i < 800 else "b" if i < 950 else "c", 10 + i % 7) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    own = {s: sum(r[2] for r in rows if r[1] == s) for s in "abc"}

    def shares(**how):
        out = mixing.mix(df, mixing.F.col("n"), **how).groupBy("source").agg(mixing.F.sum("n_tokens").alias("t"), mixing.F.max("copy").alias("c")).collect()
        return {r.source: (r.t, r.c) for r in out}

    even = shares(entropy=1.0, repeats=None)
    assert max(t for t, _ in even.values()) / min(t for t, _ in even.values()) < 1.02
    limited = shares(entropy=1.0, repeats=2.0)
    assert limited["c"][0] / own["c"] == pytest.approx(2.0, rel=0.03) and limited["c"][1] <= 2
    assert {k: t for k, (t, _) in shares(entropy=None, repeats=None).items()} == own
    small = mixing.mix(df, mixing.F.col("n"), budget=2000, block=500).select("block", "n_tokens").collect()
    assert 2000 <= sum(r.n_tokens for r in small) < 2060 and {r.block for r in small} == {0, 1, 2, 3}


def test_url_strength():
    assert reputation.STRENGTH[0] < reputation.STRENGTH[1]


def test_domains(spark):
    cases = {"a.b.example.co.uk": ("example.co.uk", "co.uk"), "www.example.com": ("example.com", "com"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "me@x.example.org:8080": ("example.org", "org"), "com": ("com", "com"), "": ("", ""), "a.com.xyz": ("com.xyz", "xyz")}
    df = spark.createDataFrame([(h,) for h in cases], "host string")
    got = {r.host: (r.d, r.s) for r in df.select("host", reputation.domain_of(reputation.F.col("host")).alias("d"), reputation.suffix_of(reputation.F.col("host")).alias("s")).collect()}
    assert got == cases


def test_bad_host_is_blocked(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 4 == 0 else f'h{i % 4}'}.example.net/{i}") for i in range(400)], "page_id long, url string")
    known = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(300)], "doc_id long, quality int")
    out = {(r.host, r.verdict) for r in reputation.judge_urls(pages, known).collect()}
    assert out == {("bad.example.net", "block"), ("h1.example.net", "allow"), ("h2.example.net", "allow"), ("h3.example.net", "allow")}


def brute_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return sorted(out + [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15])


def test_base_spans():
    rng = random.Random(1)
    parts = [*"aZ0159..@@--++ ()%_é\n", "a.b", "c@d.e", "1.2.3.4", "4111111111111111", " "]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))
        assert pii.base_spans(text) == brute_spans(text), text
    for hard in ("1" * 100000, "a" * 100000 + "@", "+1" + "(" * 100000, "1." * 50000, "@" * 50000):
        pii.base_spans(hard)


def test_field_finds_more_and_leaves_clean_text():
    field = pii.trained()
    found = lambda t: [(pii.KINDS[k], t[a:b]) for a, k, b in pii.added_spans([t], [pii.base_spans(t)], field)[0]]
    assert found("write to jack.doe at webmail dot org now") == [("email", "jack.doe at webmail dot org")]
    assert found("call (212) 555-0187 now") == [("phone", "(212) 555-0187")]
    assert found("card 4111.1111.1111.1111 was used") == [("card", "4111.1111.1111.1111")]
    for clean in ("the cat sat at home. It was 12 years old", "version 2.0 of 1998", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "", "\n\n"):
        assert found(clean) == []


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    field = pii.Field(rng.normal(size=(5, pii.SHAPES, 9)), rng.normal(size=(9, 9)))
    line = np.repeat([0, 1, 2, 3], [5, 1, 4, 3])
    shape = rng.integers(0, pii.SHAPES - 1, len(line))
    label, score = field.decode(shape, line), field.scores(shape, line)
    for k in range(4):
        at = np.flatnonzero(line == k)
        paths = np.array(list(np.ndindex(*[9] * len(at))))
        value = field.enter[paths[:, 0]] + sum(score[a][paths[:, i]] for i, a in enumerate(at)) + sum(field.step[paths[:, i], paths[:, i + 1]] for i in range(len(at) - 1))
        assert tuple(label[at]) == tuple(paths[value.argmax()])


def held_out_lines(rng):
    """Lines that the table does not hold, from other words and numbers: (line, spans (kind, text))."""
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 3)))
    digits = lambda n: "".join(rng.choice("23456789") for _ in range(n))

    def card(sep):
        own = "4" + digits(14)
        own += next(c for c in "0123456789" if pii.luhn(own + c))
        return sep.join(own[i : i + 4] for i in range(0, 16, 4))

    made = {
        "email": lambda: rng.choice([f"{word()} at {word()} dot {rng.choice(['com', 'org', 'net'])}", f"{word()} (at) {word()} (dot) org", f"{word()}.{word()} at {word()} dot de"]),
        "phone": lambda: rng.choice([f"0{digits(3)} {digits(3)} {digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}"]),
        "ip": lambda: " . ".join(str(rng.randint(1, 250)) for _ in range(4)), "card": lambda: card("."),
    }
    frames = {"email": ["please write to {} soon", "{} has it", "mail {} now", "his address: {}."], "phone": ["call {} today", "phone {}", "ring {} at six", "tel {} please"], "ip": ["host {} is up", "server {} restarts", "ip {} again"], "card": ["card {} was lost", "paid by card {} there"]}
    for kind, own in frames.items():
        for _ in range(60):
            text = made[kind]()
            yield rng.choice(own).format(text), [(kind, text)]
    for _ in range(240):
        yield rng.choice([f"version {rng.randint(1, 9)} . {rng.randint(0, 9)} . {rng.randint(0, 9)} . {rng.randint(0, 9)}", f"{word()} sat at {word()} with {digits(2)} {word()}", f"lot {digits(3)}, {digits(3)} and {digits(4)} of {word()}", f"at {digits(1)} the dot on {word()} moved", f"in {1900 + rng.randint(0, 99)} about {digits(3)} {word()} came"]), []


def test_field_on_held_out_lines():
    found = wanted = right = 0
    field = pii.trained()
    for line, spans in held_out_lines(random.Random(12)):
        got = {(pii.KINDS[k], line[a:b]) for a, k, b in pii.added_spans([line], [pii.base_spans(line)], field)[0]}
        found, wanted, right = found + len(got), wanted + len(spans), right + len(got & set(spans))
    assert right / found >= 0.95 and right / wanted >= 0.85, (right / found, right / wanted)


def test_pii_query_by_brute_force(spark, docs):
    """Counts, hash and order of the base spans by plain expressions; added spans are well formed and keep off them."""
    for r in pii.op3_pii(spark, SF).collect():
        text = dict(docs)[r.doc_id]
        base = brute_spans(text)
        said = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in base) for i in range(4))
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        spans = [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)]
        more = [x for x in spans if x not in base]
        assert spans == sorted(spans) and set(base) <= set(spans) and len(more) == r.n_added
        assert all(b <= s or e <= a for a, _, b in more for s, _, e in base) and all(pii._well_formed(text, a, b, k) for a, k, b in more)


def test_lm_base_and_model(spark, docs):
    out = {r.doc_id: r for r in lm.score_texts(spark.createDataFrame(docs, "doc_id long, text string"), common=200, per_trainer=30_000).collect()}
    counts = collections.Counter()
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in docs}
    words = {k: [*t.encode().lower().split(), b""] for k, t in docs}
    for k in words:
        if not held[k]:
            counts.update(words[k])
    total, distinct = sum(counts.values()), len(counts)
    for k, own in words.items():
        r = out[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(own), sum(counts[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own))
    library, seen = Tokenizer.from_file(P.path("word_bpe_49k.json")), collections.Counter()
    ids = {k: [*library.encode(t, add_special_tokens=False).ids, library.token_to_id("<|endoftext|>")] for k, t in docs}
    for k, own in ids.items():
        if not held[k]:
            seen.update(own)
    n = sum(seen.values())
    unigram = sum(math.log10((seen[i] + 0.1) / (n + 0.1 * 49408)) for k, own in ids.items() if held[k] for i in own)
    assert sum(out[k].score for k in ids if held[k]) > 0.95 * unigram


def test_lm_does_not_depend_on_the_layout(spark, docs):
    """One partition, or five in another order: the same scores."""
    table = spark.createDataFrame(docs, "doc_id long, text string")
    one, five = ({r.doc_id: r.score for r in lm.score_texts(df, per_trainer=60_000).collect()} for df in (table.coalesce(1), table.orderBy(lm.F.desc("doc_id")).repartition(5)))
    assert all(one[k] == pytest.approx(five[k], rel=1e-4) for k in one)


def small_outputs(rng, vocabulary=200):
    outputs = attention.Outputs(rng.integers(0, 9, (vocabulary, attention.BUCKETS)))
    outputs.add_shares(rng.integers(0, 5, (vocabulary, attention.KINDS + 1)))
    return outputs


def plain_probabilities(p, outputs, x):
    """Probabilities of every subword after the inputs x (start first), by loops over the model as it is described."""
    e = [p["e"][i] for i in x]
    q = e[-1] @ p["q"]
    weight = np.array([math.exp(q @ (v @ p["k"]) / attention.WIDTH**0.5 + p["far"][len(e) - 1 - j]) for j, v in enumerate(e)])
    z = sum(w * (v @ p["v"]) for w, v in zip(weight / weight.sum(), e, strict=True))
    out = np.exp(np.r_[z, e[-1]] @ p["out"] + p["bias"])
    return (out / out.sum())[outputs.of] * 10.0 ** outputs.within[:, outputs.kind[x[-1]]]


def test_attention_scores_by_brute_force():
    """Every subword once, with the context of its window; probabilities over the vocabulary add up to one."""
    rng = np.random.default_rng(0)
    outputs = small_outputs(rng)
    flat = attention.start_weights(200) + rng.normal(0, 0.2, len(attention.start_weights(200))).astype(np.float32)
    p = {k: v.astype(np.float64) for k, v in attention.unflat(flat, 200).items()}
    size = np.array([1, 5, 32, 33, 48, 49, 100])
    ids = rng.integers(0, 200, size.sum())
    got = attention.Scorer(flat, outputs).score(ids, size)
    for d, n in enumerate(size):
        own = ids[size[:d].sum() : size[:d].sum() + n]
        want = 0.0
        for i in range(n):
            start = 0 if i < attention.WINDOW else ((i - attention.WINDOW) // attention.STRIDE + 1) * attention.STRIDE
            share = plain_probabilities(p, outputs, [200 if start == 0 else own[start - 1], *own[start:i]])
            # the part of probability that outputs without a subword hold is lost, and nothing else
            assert share.sum() <= 1 + 1e-5
            want += math.log10(share[own[i]])
        assert got[d] == pytest.approx(want, abs=1e-3)


def test_attention_gradient(monkeypatch):
    rng = np.random.default_rng(1)
    flat = attention.start_weights(50).astype(np.float64) + rng.normal(0, 0.1, len(attention.start_weights(50)))
    x, y = rng.integers(0, 51, (3, 32)), rng.integers(-1, attention.OUTPUTS, (3, 32))
    p = attention.unflat(flat, 50)
    _, g, rows, more = attention.step(p, x, y)
    g = g | {"e": np.zeros_like(p["e"])}
    g["e"][rows] = more
    for name, value in p.items():
        for at in rng.integers(0, value.size, 8):
            near = []
            for h in (1e-5, -2e-5):
                value.reshape(-1)[at] += h
                near.append(attention.step(p, x, y)[0])
            value.reshape(-1)[at] += 1e-5
            assert g[name].reshape(-1)[at] == pytest.approx((near[0] - near[1]) / 2e-5, abs=1e-5), name


def test_training_windows_hold_every_subword():
    rng = np.random.default_rng(2)
    outputs = small_outputs(rng)
    size = np.array([1, 31, 32, 33, 200])
    ids = rng.integers(0, 200, size.sum())
    windows = attention.training_windows(ids, size, outputs)
    real = windows[:, 1] >= 0
    assert real.sum() == size.sum() and (windows[:, 1][real] == outputs.of[ids]).all()
    before = np.r_[200, ids[:-1]]
    before[np.cumsum(size) - size] = 200
    assert (windows[:, 0][real] == before).all()


def test_scorer_lets_every_block_through_once(monkeypatch):
    """A later window's context costs nothing again: as many places as there are blocks of STRIDE, whatever the sequences' length."""
    outputs, places = small_outputs(np.random.default_rng(4)), []
    plain = attention.Scorer._said
    monkeypatch.setattr(attention.Scorer, "_said", lambda self, inputs, *a: (places.append(len(inputs) - attention.STRIDE), plain(self, inputs, *a))[1])
    size = np.array([1, 16, 17, 32, 33, 5000])
    attention.Scorer(attention.start_weights(200), outputs).score(np.zeros(size.sum(), np.int64), size)
    assert sum(places) == sum(-(-n // attention.STRIDE) * attention.STRIDE for n in size.tolist())


def test_step_in_chunks_is_the_step():
    """Chunks, and arrays that are used again, change no gradient; a last chunk may be short."""
    rng = np.random.default_rng(5)
    p = attention.unflat(attention.start_weights(50).astype(np.float64), 50)
    n = 2 * attention.CHUNK + 3
    x, y = rng.integers(0, 51, (n, attention.WINDOW)), rng.integers(-1, attention.OUTPUTS, (n, attention.WINDOW))
    room = attention.Room(np.dtype(np.float64))
    attention.step(p, x[::-1], y, room)
    loss, g, rows, more = attention.step(p, x, y, room)
    parts, real, sums = [], (y >= 0).sum(axis=1), np.zeros((51, attention.WIDTH))
    for i in range(n):
        parts.append(attention.step(p, x[i : i + 1], y[i : i + 1]))
        sums[parts[-1][2]] += parts[-1][3] * real[i] / real.sum()
    assert loss == pytest.approx(sum(part[0] * k for part, k in zip(parts, real, strict=True)) / real.sum())
    assert all(g[name] == pytest.approx(sum(part[1][name] * k for part, k in zip(parts, real, strict=True)) / real.sum(), abs=1e-12) for name in g)
    assert sums[rows] == pytest.approx(more, abs=1e-12)


def test_coded_words_are_the_library_s():
    """Ids of whole texts from words told apart by Arrow, with other letters, marks, special tokens and white space around."""
    words = packing.WordIds(P.path("word_bpe_49k.json"), cache=40)
    texts = ["", "   ", "\tTHE the\x0b Éß ÿÀÖ ñ's don't!! ", "a\x1cB İ Áb e\u0301 ÀÉ,", "<|endoftext|> ABC <|x", "y" * 300 + " y 12 a-b", "x\x85y\xa0z"] * 3
    for some in (pa.array(texts), pa.array(texts).slice(2), pa.array(texts[::-1]).slice(1, 4)):
        places, begin, met, ids = words.coded(some)
        assert len(met) == len(ids) and begin[0] == 0 and len(begin) == len(some) + 1
        for text, a, b in zip(some.to_pylist(), begin, begin[1:], strict=False):
            got = b"".join(ids[int(i)].as_py() for i in places[a:b])
            assert np.frombuffer(got, "<u2").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids, text


def brute_toxicity(rows, labels):
    """Scores of rows (id, text) by dense vectors over every word and beginning of the labelled texts, and all cosines."""
    known = [(t or "", labels[k]) for k, t in rows if k in labels and zlib.crc32(str(k).encode()) % 4 != 2]

    def terms(text):
        out = collections.Counter()
        for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
            out[w] += 1
            if len(w) > toxicity.PREFIX:
                out[w[: toxicity.PREFIX] + "*"] += 1
        return out

    counts = [terms(t) for t, _ in known]
    y = np.array([label for _, label in known], float)
    at = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    has = np.array([[t in c for t in at] for c in counts], float)
    n, total = len(known), y.sum()
    weight = np.zeros(len(at))
    for rows_in, inside in ((has, True), (1 - has, True)):
        for own, share in ((y, total), (1 - y, n - total)):
            seen, expected = rows_in.T @ own, rows_in.sum(axis=0) * share / n
            weight += np.where(seen > 0, 2 * seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-12)), 0)
    weight = np.log1p(n / has.sum(axis=0)) * (toxicity.FLOOR + np.maximum(weight, 0))

    def vector(c):
        v = np.zeros(len(at))
        for t, k in c.items():
            if t in at:
                v[at[t]] = (1 + math.log(k)) * weight[at[t]]
        return v / (np.linalg.norm(v) or 1)

    examples = np.array([vector(c) for c in counts])
    out = []
    for _, text in rows:
        v = vector(terms(text))
        cosine = examples @ v
        best = np.argsort(-cosine, kind="stable")[: toxicity.NEIGHBOURS if v.any() else 0]
        edge = cosine[best[-1]] if len(best) else 0
        tied = len({round(y[i]) for i in np.flatnonzero(np.abs(cosine - edge) < 1e-9)}) > 1 if len(best) else False
        vote = 1 / (np.maximum(1 - cosine[best], 0) + toxicity.SOFT)
        out.append((None if tied else (vote @ y[best] + toxicity.PRIOR * y.mean()) / (vote.sum() + toxicity.PRIOR), np.sort(cosine[best])[::-1]))
    return out


def test_toxicity_query_by_brute_force(spark, docs):
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    got = {r.doc_id: r for r in toxicity.op6_toxicity(spark, SF).collect()}
    checked = 0
    for (k, _), (want, _) in zip(docs, brute_toxicity(docs, labels), strict=True):
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2) and got[k].predicted == int(got[k].score >= 0.3)
        if want is not None:
            checked += 1
            assert got[k].score == pytest.approx(want, abs=1e-3)  # cosines are single precision
    assert checked > 150


def test_toxicity_search_is_exact(monkeypatch):
    rows = duckdb.sql("SELECT doc_id, text, toxic FROM '/root/testdata/sf0.01/documents.parquet' JOIN '/root/testdata/sf0.01/labels.parquet' USING (doc_id) ORDER BY doc_id").fetchall()
    for block, slack in ((16, 0.02), (8, 0.2), (64, 0.0), (64, 9.0)):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        monkeypatch.setattr(toxicity, "SLACK", slack)
        index = toxicity.BlockMaxIndex([r[0] for r in rows], [r[2] for r in rows], [r[1] for r in rows])
        counter = toxicity.Vocabulary(index.vocabulary)
        for _, text, _ in rows[::4]:
            terms, counts = counter.counts(text)
            full = np.zeros(len(rows))
            for t, w in zip(terms.tolist(), index.vector(terms, counts).tolist(), strict=True):
                first = index.block_start[index.block_at[t]]
                own = slice(first, first + index.block_size[index.block_at[t] : index.block_at[t + 1]].sum())
                full[index.doc[own]] += index.weight[own] * w
            best, score = index.nearest(terms, counts)
            assert np.allclose(np.sort(full)[::-1][: len(score)], score, atol=1e-5) and np.allclose(full[best], score, atol=1e-5) and len(best) == min(15, len(rows))


def test_toxicity_holds_out_and_is_calibrated(spark):
    """Held-out recall, precision and reliability over ten bins, on labels that no example has."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = toxicity.toxicity(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels.where(toxicity.held_out()).select("doc_id"), "doc_id", "left_semi").unionByName(
        spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels.where(~toxicity.held_out()).select("doc_id"), "doc_id", "left_semi")), labels)
    rows = judged.join(labels, "doc_id").where(toxicity.held_out()).select("score", "toxic").collect()
    score, toxic = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    said = score >= toxicity.THRESHOLD
    assert toxic[said].mean() > 0.93 and said[toxic == 1].mean() > 0.9 and said[toxic == 0].mean() < 0.01
    place = np.minimum((score * 10).astype(int), 9)
    gap = sum(abs(score[place == b].sum() - toxic[place == b].sum()) for b in range(10)) / len(rows)
    assert gap < 0.05


def test_toxicity_sample_is_bounded(spark, docs):
    table, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in docs], "doc_id long, toxic int")
    assert len(toxicity.learn(table, labels, sample=20).ids) == 20
    few = toxicity.learn(table, labels, chars=20_000)
    size = {k: len(t) for k, t in docs}
    assert few.ids and sum(size[k] for k in few.ids) <= 20_000
    assert toxicity.learn(table, labels, chars=0).ids == []


def brute_tree(text):
    """Root, and the sections' lists of pieces with repeats, by plain means."""
    paragraphs = re.findall(r"[^\n]*\n+|[^\n]+", text)
    piece = re.compile(r"(?s).{14,96}?(?:(?<=[aeio.,;|][ \t\n\x0b\f\r])|(?<=\n)|\Z)|.{96}|.+")
    shas, sections, own = [hashlib.sha256(p.encode()).hexdigest() for p in paragraphs], [], []
    for i, sha in enumerate(shas):
        own.append(sha)
        if sha[-1] in "08" or i == len(shas) - 1:
            sections.append(hashlib.sha256("".join(own).encode()).hexdigest())
            own = []
    return hashlib.sha256("".join(sections).encode()).hexdigest(), collections.Counter(xxhash.xxh64_intdigest(m.encode(), 42) for p in paragraphs for m in piece.findall(p))


def brute_likeness(a, b):
    (root_a, a), (root_b, b) = brute_tree(a), brute_tree(b)
    total = sum(a.values()) + sum(b.values())
    return 1.0 if root_a == root_b else 2 * sum((a & b).values()) / total if total else 0.0


@pytest.mark.parametrize("odd", [False, True])
def test_merkle_query_by_brute_force(spark, docs, odd):
    if odd:
        rng = random.Random(8)
        docs = [(i, "".join(rng.choice(["", "\n", "\n\n", "a. ", "same line again, \n", "中文 ", "x" * 200, "tail o "]) for _ in range(rng.randint(0, 30)))) for i in range(150)]
    out = {r.doc_id: r for r in merkle.edit_fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    seen = {}
    for i, (k, text) in enumerate(docs):
        n, then, r = len(text), docs[(i + 1) % len(docs)][1], out[k]
        edited = text[: n - n // 4] + then[: n // 4]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint and r.fingerprint.split(";")[0] == brute_tree(text)[0] and r.edited_fingerprint.split(";")[0] == brute_tree(edited)[0]
        assert (r.near_edited, r.near_next) == (pytest.approx(brute_likeness(text, edited)), pytest.approx(brute_likeness(text, then)))
        if text == edited:
            assert r.edit_start is None
        else:  # what lies outside the range is the same in both
            rest = n - r.edit_stop
            assert 0 <= r.edit_start <= r.edit_stop <= n and text[: r.edit_start] == edited[: r.edit_start] and text[r.edit_stop :] == edited[len(edited) - rest :] and r.edit_start + rest <= min(n, len(edited))
            assert odd or n < 2000 or r.edit_start > n - n // 4 - 120  # close to the edit
    assert len(set(seen.values())) == len(seen)


def test_merkle_locates_edits(spark):
    text = "".join(f"line number {i} of the text\n" for i in range(40))
    other = text.replace("number 17 of", "number 99 of")
    df = spark.createDataFrame([(text, other), (text, text), (text, text + "more\n"), (text, "")], "a string, b string")
    df = merkle.with_tree(merkle.with_tree(df, merkle.F.col("a"), "ta"), merkle.F.col("b"), "tb")
    got = [r.d for r in df.select(merkle.differing(merkle.F.col("ta"), merkle.F.col("tb")).alias("d")).collect()]
    found = text[got[0].start : got[0].stop]
    assert got[0].paragraph == 18 and "17" in found and found in "line number 17 of the text\n" and got[1] is None
    assert (got[2].start, got[2].stop) == (len(text), len(text)) and (got[3].start, got[3].stop) == (0, len(text))


def test_bpe_counts_as_the_library(docs, fuzz):
    library, own = Tokenizer.from_file(P.path("byte_bpe_50k.json")), bpe.ByteBpe(P.path("byte_bpe_50k.json"))
    texts = [t for _, t in docs] + fuzz + ["", "a" * 5000, " " * 300, "ab" * 2000]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.count(texts) == [len(w) for w in want]
    assert [np.frombuffer(x, "<u2").tolist() for x in own.encode(texts)] == want


def test_token_count_query(spark, docs):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = [*docs, (10**6, None), (10**6 + 1, ""), (10**6 + 2, "<|endoftext|> " * 600), (10**6 + 3, "a " * 1024)]
    out = {r.doc_id: r for r in bpe.token_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (out[k].n_bytes, out[k].n_tokens, out[k].over_limit) == (len((text or "").encode()), n, n > 1024)


def test_word_ids_as_the_library(docs, fuzz):
    library, own = Tokenizer.from_file(P.path("word_bpe_49k.json")), packing.WordIds(P.path("word_bpe_49k.json"))
    texts = [t for _, t in docs] + fuzz + ["x" * 3000]
    for _ in range(2):
        assert [np.frombuffer(x, "<u2").tolist() for x in own.packed(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def packed_whole(rows, texts, window=packing.WINDOW):
    library, per, places = Tokenizer.from_file(P.path("word_bpe_49k.json")), collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        per[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for k, text in texts:
        ids, at = [*library.encode(text, add_special_tokens=False).ids, 1], 0
        for r in sorted(per[k], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for k, own in places.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == window or k == max(places)
    assert sorted(places) == list(range(len(places)))


def test_packing(spark, docs):
    packed_whole(packing.op9_packing(spark, SF).collect(), docs)


def test_xxh64():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 256, int(n)).astype(np.uint8).tobytes() for n in rng.integers(0, 130, 2000)]
    size = np.array(list(map(len, parts)))
    assert simhash.xxh64(b"".join(parts) + bytes(8), np.cumsum(size) - size, size).tolist() == [xxhash.xxh64_intdigest(p, 42) for p in parts]


def brute_fingerprint(text):
    words = text.encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum((2 * sum(h >> j & 1 for h in hashes) > len(hashes)) << j for j in range(64))


def brute_components(fps, radius=3):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root[i], root[j]
                if a != b:
                    root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("tile", [simhash.TILE, 8])
def test_simhash_query(spark, docs, tile):
    rng = random.Random(5)
    own = [*docs, *((10_000 + i, t.replace("the", "teh", 1) + (" end" if rng.random() < 0.5 else "")) for i, (_, t) in enumerate(docs[:60]))]
    fps = [brute_fingerprint(t) for _, t in own]
    root = brute_components(fps)
    least = {}
    for (k, _), r in zip(own, root, strict=True):
        least[r] = min(k, least.get(r, k))
    out = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(spark.createDataFrame(own, "doc_id long, text string"), tile=tile).collect()}
    assert out == {k: (format(f, "016x"), least[r]) for (k, _), f, r in zip(own, fps, root, strict=True)}


def test_bit_sliced_distances():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    fps = np.concatenate([base ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, False))) for k in (0, 1, 2, 3, 4, 6, 20, 24, 25)])
    true = np.bitwise_count(fps[:, None] ^ fps[None])
    for radius in (0, 1, 3, 7, 24):
        found = {(int(a), int(b)) for x, y in simhash.near(fps, fps, radius) for a, b in zip(x, y, strict=True)}
        assert found == set(zip(*map(lambda v: v.tolist(), np.nonzero(true <= radius)), strict=True))
        assert (simhash.within(fps[1:], fps[:-1], radius) == (np.bitwise_count(fps[1:] ^ fps[:-1]) <= radius)).all()


def near_table():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randint(80, 240))
        rows.append((10 * i, " ".join(words)))
        if i % 3 == 0:
            for c in range(1, 4):
                copy = list(words)
                for _ in range(c):
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
                rows.append((10 * i + c, " ".join(copy)))
    return rows


def near_roots(rows):
    """The least id of every row's component, by all pairs."""
    shingles = {k: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for k, t in rows}
    root = {k: k for k in shingles}
    for i, (a, _) in enumerate(rows):
        for b, _ in rows[:i]:
            if len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b]) >= 0.8 and root[a] != root[b]:
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    return root


@pytest.mark.parametrize("tile", [2048, 4])
def test_near_copies(spark, tile):
    rows = near_table()
    root = near_roots(rows)
    out = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), tile=tile).collect()}
    assert sum(out[k] == root[k] for k in root) >= 0.99 * len(root)


def test_near_copies_of_long_texts(spark):
    """Similarities on both sides of 0.8 and close to it, of texts with many more shingles than a sample holds."""
    rng, rows, root = random.Random(4), [], {}
    for i in range(60):
        words = [f"w{rng.randrange(100_000)}" for _ in range(rng.randint(1000, 3000))]
        copy = list(words)
        for k in rng.sample(range(len(words) // 5), int(len(words) / 5 * rng.uniform(0.055, 0.074))):
            copy[5 * k : 5 * k + 5] = [f"new{rng.randrange(10**9)}" for _ in range(5)]
        a, b = ({tuple(t[j : j + 5]) for j in range(len(t) - 4)} for t in (words, copy))  # texts of different i have none in common
        root |= {2 * i: 2 * i, 2 * i + 1: 2 * i if len(a & b) / len(a | b) >= 0.8 else 2 * i + 1}
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
    assert 10 < sum(root[k] == k for k in range(1, 120, 2)) < 50
    out = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == root


def test_near_copies_with_repeated_passages(spark):
    """The same shingles, of which one text repeats some many times."""
    rng, rows = random.Random(5), []
    for i in range(40):
        words = [f"w{rng.randrange(100_000)}" for _ in range(104)]
        passage = [f"p{rng.randrange(100_000)}" for _ in range(5)]
        rows += [(2 * i, " ".join(words + 2 * passage)), (2 * i + 1, " ".join(words + 50 * passage))]
    root = near_roots(rows)
    assert all(root[k] == k - k % 2 for k in root)
    out = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == root


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_buckets(spark, seed):
    """Hundreds of near copies of a few texts in buckets of many tiles, with texts at the edge that only some are linked to."""
    rng, rows = random.Random(seed), []
    bases = [[f"w{rng.randrange(100_000)}" for _ in range(120)] for _ in range(2)]
    bases.append([*bases[0][:112], *(f"v{rng.randrange(100_000)}" for _ in range(8))])
    for i in range(360):
        words = list(bases[i % 3])
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    root = near_roots(rows)
    for tile in (16, 64):
        out = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), tile=tile).collect()}
        assert sum(out[k] == root[k] for k in root) >= 0.99 * len(root)
    fps = [brute_fingerprint(t) for _, t in rows]
    least = brute_components(fps)
    got = {r.doc_id: r.component_id for r in simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string"), tile=4).collect()}
    assert got == {k: least[k] for k, _ in rows}


def test_tiles_are_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_SHINGLES", 500)
    rows = near_table()
    root = near_roots(rows)
    out = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(out[k] == root[k] for k in root) >= 0.99 * len(root)


def test_held_out_columns(spark):
    out = {r.doc_id: r.h for r in frame(spark).select("doc_id", lm.held_out().alias("h")).collect()}
    assert out[None] is False and all(h == (zlib.crc32(str(k).encode()) % 10 == 0) for k, h in out.items() if k is not None)
