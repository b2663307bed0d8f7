"""Nulls, empty and long texts, repeats, empty tables and clashing names, for every operator."""

import pytest

from gableflow.llm import bpe, exact_dedup, lm, merkle, mixing, packing, pii, reputation, simhash, toxicity

from .helpers import ODD, clashing, frame, rows_of


def labels(spark):
    return spark.createDataFrame([(k, 1, int(k % 2 == 0)) for k in range(1, 12)] + [(4, 0, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "exact": lambda s, df: exact_dedup.exact_dedup(df),
    "pii": lambda s, df: pii.personal_data(df),
    "lm": lambda s, df: lm.score_texts(df, common=5, per_trainer=20_000),
    "toxicity": lambda s, df: toxicity.score(df, toxicity.learn(df.select("doc_id", "text"), labels(s))),
    "merkle": lambda s, df: merkle.edit_fingerprints(df),
    "bpe": lambda s, df: bpe.token_counts(df),
    "packing": lambda s, df: packing.pack(df),
    "simhash": lambda s, df: simhash.simhash_components(df),
    "near": lambda s, df: simhash.near_copies(df),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    run = OPERATORS[name]
    plain, clash = run(spark, frame(spark)), run(spark, clashing(frame(spark)))
    assert plain.columns == clash.columns
    a, b = rows_of(plain), rows_of(clash)
    if name == "packing":  # a document's place in the stream is free
        a, b = sorted({r[0] for r in a}, key=str), sorted({r[0] for r in b}, key=str)
        assert a == sorted({r[0] for r in ODD}, key=str)
    else:
        assert len(a) == len(ODD)
    if name == "lm":
        assert [r[:-2] for r in a] == [r[:-2] for r in b]
        assert [r[-1] for r in a] == pytest.approx([r[-1] for r in b], rel=1e-5)
    else:
        assert a == b


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, frame(spark, [])).count() == 0


def test_mixing_odd_rows(spark):
    tokens = mixing.words_in(mixing.whole_text())
    out = mixing.mix(clashing(frame(spark)), tokens, entropy=None, repeats=None).select("row.doc_id", "row.word", "copy").collect()
    assert len(out) == len(ODD) and {r.word for r in out} == {"clash"} and {r.copy for r in out} == {0}
    assert mixing.mix(frame(spark, []), tokens).count() == 0


def test_urls_odd_rows(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.Example.ORG/es/x?y"), (5, "HTTP://A.Example.ORG/es/x?y"), (None, "x://b.com#z"), (6, "http://com/de/")], "page_id long, url string")
    known = labels(spark)
    out = reputation.judge_urls(clashing(pages), known).collect()
    assert len(out) == 8
    by = {r.page_id: r for r in out}
    assert (by[1].host, by[1].path, by[3].host, by[4].host) == ("", "", "", "")
    assert (by[5].host, by[5].path, by[5].rule, by[5].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert (by[None].host, by[None].path, by[6].rule) == ("b.com", "", "com/de/")
    assert reputation.judge_urls(pages.limit(0), known).count() == 0
    assert {r.verdict for r in reputation.judge_urls(pages, known.limit(0)).where("rule is null").collect()} == {"allow"}


def test_exact_keeps_one_row_of_each_group(spark):
    out = exact_dedup.exact_dedup(frame(spark)).collect()
    kept = {}
    for r in out:
        kept.setdefault(r.text_sha256, []).append(r.kept)
    assert all(sum(v) == 1 for v in kept.values())
    same = [r for r in out if r.group_size == 4]
    assert {r.keep_id for r in same} == {9} and len(same) == 4  # 5, 9 twice and null


def test_mixing_splits_repeated_ids(spark):
    """All rows of one id, or of none, get places of their own in the prefix sums."""
    rows = [(7 if i % 2 else None, "a" if i % 3 else "b", 5) for i in range(3000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, n long"), mixing.F.col("n"), entropy=None, repeats=None, block=500).groupBy("block").count().collect()
    assert sum(r["count"] for r in out) == 3000 and max(r["count"] for r in out) < 200 and len(out) == 30


def test_long_text_beyond_one_slice(spark):
    """A text above every slice's bytes beside short ones."""
    text = "".join(f"word{i % 9973} and {i} more. " + ("\n" if i % 50 == 0 else "") for i in range(420_000))
    assert len(text) > 8 << 20
    df = frame(spark, [(1, text, "en", "a", len(text)), (2, "short text", "en", "a", 10), (3, text, "en", "b", len(text))])
    for name in ("exact", "pii", "toxicity", "bpe", "packing", "simhash", "near", "merkle"):
        out = OPERATORS[name](spark, df).collect()
        assert {r.doc_id for r in out} == {1, 2, 3}, name
