"""Operator 1: exact dedup by content-defined chunk recipes (DataFrame functions only).

A text is cut where its own characters say so, never at fixed places, so a passage that many documents share becomes the
same chunks in each of them. The dictionary of distinct chunks is the one place where text is shuffled, each distinct
chunk once per map task. It proves which 64-bit hashes name one chunk only; such a hash is that chunk's verified
identifier. A hash that two different chunks share is told apart by the chunk's rank among them. From there on a document
is the ordered list of its identifiers: lists are grouped and joined, long texts are not moved again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, whole_text, written

#: A chunk has MIN_CHUNK to MAX_CHUNK characters. It ends after white space that follows one of some character pairs, after
#: one of every 61 characters of other scripts, or after a letter and two digits, as in long runs without white space.
MIN_CHUNK, MAX_CHUNK = 512, 8192
OTHER = "".join(chr(c) for c in range(0x370, 0xD800, 61))
BOUNDARY = rf"(?<=[nrst][aeioy.,;|]\s)|(?<=(?=[^\x00-\u036f])[{OTHER}])|(?<=[A-Za-z][0-4][5-9])"


def chunks_of(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK, boundary: str = BOUNDARY) -> Column:
    """The text as an array of content-defined chunks; joined again they are the text. The empty text has none."""
    pattern = rf"(?s).{{{least},{most}}}?(?:{boundary}|\z)|.{{{most}}}|.+"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = MIN_CHUNK, most: int = MAX_CHUNK, hash_bits: int = 64) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after no change; a null text counts as empty, and all empty texts are equal. The row
    with the largest id of each group is kept (a null id is below all others). Rows that repeat an id and a text are rows
    of their group like any other, and exactly one of them is kept. A very long text is a longer list of chunks. Other columns are neither read nor returned. An empty
    table gives an empty result. hash_bits is for tests: few bits make hashes collide, with the same result.
    """
    hashed = (lambda c: F.xxhash64(c)) if hash_bits >= 64 else (lambda c: F.pmod(F.xxhash64(c), F.lit(1 << hash_bits)))
    base = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    pieces = base.select("id", "text", chunks_of(F.col("text"), least, most).alias("chunks"))

    known = pieces.select(F.explode("chunks").alias("chunk")).select(hashed(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = known.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    rows = pieces.withColumn("row", F.monotonically_increasing_id())
    if not shared.limit(1).count():  # every hash is the verified identifier of one chunk
        recipes = rows.select("id", "row", F.transform("chunks", hashed).alias("recipe"), F.sha2("text", 256).alias("text_sha256"))
    else:
        ranks = known.join(written(shared, "shared-hashes"), "h", "left_semi").withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("chunk")).cast("long"))
        placed = rows.select("id", "row", F.sha2("text", 256).alias("text_sha256"), F.posexplode_outer("chunks").alias("at", "chunk")).withColumn("h", hashed(F.col("chunk")))
        named = placed.join(ranks, ["h", "chunk"], "left").select("id", "row", "text_sha256", "at", F.struct("at", "h", F.coalesce("rank", F.lit(0)).alias("rank")).alias("part"))
        recipes = named.groupBy("row", "id", "text_sha256").agg(F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.col("part")))).alias("parts"))
        recipes = recipes.select("id", "row", F.flatten(F.transform("parts", lambda p: F.array(p["h"], p["rank"]))).alias("recipe"), "text_sha256")
    recipes = written(recipes, "recipes")

    groups = written(recipes.groupBy("recipe").agg(F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("group_size")), "recipe-groups")
    out = recipes.join(groups, "recipe")
    return out.select(F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
