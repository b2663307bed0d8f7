"""The corpus pipeline: STAGES in order, run() over the documents table, ORACLE_SQL for its rows.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; its result is written as
Parquet and read again as the next one's docs. All stages but the last return the columns of docs. A document is a row;
rows that repeat an id and a text are copies of each other, of which the exact stage keeps one. Columns beyond those of
documents pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gableflow.llm import exact_dedup, mixing, packing, simhash, toxicity
from gableflow.llm.common import discard, struct_of_row, table, unused, whole_text, written

#: Parameters of the stages beyond the operators' own defaults: the score from which documents go, words that a worker of
#: the last stage remembers (its executors have grown through four stages).
REJECT, CACHE = toxicity.THRESHOLD, 200_000


def _stay(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """Rows of docs that judged (doc_id, text_sha256, kept: a row for each row of docs) keeps, one for each kept row."""
    keepers = judged.where("kept").select(F.col("doc_id").alias("keep_id"), F.col("text_sha256").alias("keep_sha"))
    rows = docs.select(struct_of_row(docs).alias("row"), F.col("doc_id").alias("id"), F.sha2(whole_text(), 256).alias("sha"))
    out = rows.join(keepers, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha")), "left_semi")
    if judged.groupBy("doc_id", "text_sha256").count().where("count > 1").limit(1).count():
        out = out.dropDuplicates(["id", "sha"])
    return out.select("row.*")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as toxic.

    A null, empty or wordless text has the score of the labelled sample's share and stays unless that reaches REJECT.
    Ties and repeated rows score alike. Very long texts are scored whole. An empty table stays empty.
    """
    keep = tuple(docs.columns)
    name = unused("toxicity score", docs.columns)
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"), keep=keep, score_as=name, evidence_as=unused("toxicity evidence", docs.columns))
    return scored.where(F.col(f"`{name}`") < REJECT).select(*(F.col(f"`{c}`") for c in keep))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts: the one with the largest id, nulls below all others.

    Null and empty texts are one group. Of rows that repeat the id and the text one stays. An empty table stays empty.
    """
    return _stay(docs, written(exact_dedup.exact_dedup(docs).select("doc_id", "text_sha256", "kept"), "judged"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near copies (five-word shingles, similarity 0.8): the one with the smallest id.

    Null ids come before all others; equal ids are told apart by their text's hash. Texts without words are one component.
    Very long texts are compared by all their shingles. An empty table stays empty.
    """
    named = docs.select(F.struct(F.col("doc_id"), F.sha2(whole_text(), 256).alias("text_sha256")).alias("id"), "text")
    found = simhash.near_copies(named, "id").select("id.*", (F.col("id") == F.col("component_id")).alias("kept"))
    return _stay(docs, written(found, "judged"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents so that sources have their target weights, each block of the mixture in its own order.

    A document may be drawn several times or not at all. A null source is a source; null and empty texts cost nothing. A
    very long text may overshoot its source's quota. An empty table stays empty.
    """
    drawn = mixing.mix(docs, mixing.words_in(whole_text()))
    return drawn.repartition("block").sortWithinPartitions("block", "place").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the mixture's tokens into sequences: one row per piece of a document.

    A null or empty text is its end id. Rows that repeat an id are packed each; null ids stay null. A very long text has
    many pieces. An empty table has none.
    """
    return packing.pack(docs, cache=CACHE).drop("ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL has neither the tokenizer nor the toxicity model; tests/llm/test_pipeline.py holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name.replace(' ', '-')}")
            discard(before)
    return docs
