"""The corpus pipeline, stage by stage, on a small fixture."""

import collections
import random

import corpus_pipeline
import duckdb
import public_tokenizers as P
import pytest
from gableflow.llm import mixing, toxicity
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .helpers import SCHEMA, frame
from .test_operators import brute_toxicity, near_roots, near_table, packed_whole

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "simhash near-dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.reject_toxic(spark, docs, SF)
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.score for r in toxicity.op6_toxicity(spark, SF).collect()}
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {k for k, s in scores.items() if s < toxicity.THRESHOLD} and 0 < len(ids) < len(scores)
    texts = collections.defaultdict(list)
    for r in kept.collect():
        texts[r.text].append(r.doc_id)
    unique = corpus_pipeline.drop_copies(spark, kept, SF)
    assert unique.columns == docs.columns
    assert sorted(r.doc_id for r in unique.collect()) == sorted(max(v) for v in texts.values())


def test_repeated_rows_leave_one(spark):
    rows = [(1, "same words here", "en", "a", 1), (1, "same words here", "en", "a", 1), (2, "same words here", "en", "a", 1), (3, None, "en", "a", 0), (None, "", "en", "a", 0), (4, "other text", None, None, None)]
    out = corpus_pipeline.drop_copies(spark, spark.createDataFrame([*rows, (2, "same words here", "en", "a", 1)], SCHEMA), SF).collect()
    assert sorted((r.doc_id for r in out), key=str) == [2, 3, 4]
    near = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    assert sorted((r.doc_id for r in near), key=str) in ([1, 3, 4], [1, 4, None])


def test_near_copies_go(spark):
    rows = near_table()
    out = corpus_pipeline.drop_near_copies(spark, frame(spark, [(k, t, "en", f"s{k % 3}", len(t)) for k, t in rows]), SF).collect()
    left = {r.doc_id for r in out}
    least = set(near_roots(rows).values())
    assert least <= left and len(left - least) <= 1 and len(left) < len(rows) - 80


def test_mixing_and_packing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 200")
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns
    packed_whole(corpus_pipeline.pack(spark, docs, SF).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def plain_run(rows, labels):
    """What run() returns, by plain means: {doc_id: copies drawn} of rows (id, text, lang, source, n_chars)."""
    scores = brute_toxicity([(r[0], r[1]) for r in rows], labels)
    assert all(s is not None for s, _ in scores)
    kept = [r for r, (s, _) in zip(rows, scores, strict=True) if s < corpus_pipeline.REJECT]
    last = {}
    for r in kept:
        last[r[1]] = max(r[0], last.get(r[1], -1))
    kept = [r for r in kept if last[r[1]] == r[0]]
    root = near_roots([(r[0], r[1]) for r in kept])
    kept = [r for r in kept if root[r[0]] == r[0]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", kept)
    return collections.Counter(r[0] for r in con.sql(f"SELECT doc_id FROM ({mixing.ORACLE_SQL})").fetchall())


def test_run_by_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, t, "en", f"s{min(k % 7, 2)}", len(t)) for k, t in near_table()]
    rows += [(5000 + k, t, "en", "s1", n) for k, t, _, _, n in rows[::9]]  # exact copies
    for i in range(60):
        words = [f"z{rng.randrange(400)}" for _ in range(60)]
        rows.append((9000 + i, " ".join(words + (["vile", "rotten", "scoundrel"] * 3 if i % 2 else [])), "en", "s3", 0))
    labels = {k: int("vile" in t) for k, t, *_ in rows if k % 3 or k >= 9000}
    folder = f"file://{tmp_path}"
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, v) for k, v in labels.items()], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    want = plain_run(rows, labels)
    pieces = corpus_pipeline.run(spark, folder).collect()
    library, size = Tokenizer.from_file(P.path("word_bpe_49k.json")), {}
    for k, t, *_ in rows:
        size[k] = len(library.encode(t, add_special_tokens=False).ids) + 1
    held, places = collections.Counter(), collections.defaultdict(list)
    for r in pieces:
        held[r.doc_id] += r.length
        places[r.sequence_id].append((r.offset, r.length))
        assert r.doc_tokens == size[r.doc_id]
    assert held == {k: n * size[k] for k, n in want.items()}
    assert not any(k >= 9000 and k % 2 for k in held) and sum(k >= 9000 for k in held) > 20
    for k, own in places.items():
        assert sum(n for _, n in own) == 2048 or k == max(places)


CLASH = ["row", "id", "sha", "keep_id", "keep_sha", "kept", "toxicity score", "toxicity evidence", "score", "evidence", "block", "place", "copy", "num", "digest", "key", "of", "range", "slot", "a.b"]


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_bears_odd_rows_and_names(spark, stage):
    docs = frame(spark)
    more = docs.withColumns({c: F.lit("clash") for c in CLASH})
    out, wide = stage(spark, docs, SF), stage(spark, more, SF)
    if stage is not corpus_pipeline.pack:
        assert out.columns == docs.columns and wide.columns == more.columns
        assert {tuple(r)[len(docs.columns) :] for r in wide.collect()} == {("clash",) * len(CLASH)}
    key = lambda df: sorted((str(r.doc_id) for r in df.select("doc_id").collect()))
    assert key(out) == key(wide) and len(key(out)) > 0
    assert stage(spark, frame(spark, []), SF).count() == 0
