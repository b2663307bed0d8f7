"""Operator 7: document fingerprints as Merkle trees over paragraphs and sections (DataFrame functions only).

A paragraph is a line with the line ends after it. Its leaves are small content-defined pieces with 64-bit hashes; its own
hash is SHA-256 of its text. A section is a run of paragraphs that ends where a paragraph's hash says so, and its hash is
that of its paragraphs' hashes; the root is that of the sections' hashes. Equal roots mean equal texts. From differing
roots one goes down: sections that agree at both ends are passed over whole, then paragraphs, then pieces, and what is
left between them is where the texts differ. Likeness is the share of leaves in common, repeats counted; equal sections
bring theirs without a look at them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table, whole_text, written

PARAGRAPH = r"[^\n]*\n+|[^\n]+"
#: A piece has 14 to 96 characters and ends after white space behind some characters, or at a paragraph's end.
PIECE = r"(?s).{14,96}?(?:(?<=[aeio.,;|]\s)|(?<=\n)|\z)|.{96}|.+"
#: Last hex digits of a paragraph's hash that end a section: one paragraph in eight does.
LAST = ["0", "8"]


def with_tree(df: DataFrame, text: Column, name: str) -> DataFrame:
    """df with the column name: struct(root, sections: hashes; leaves: pieces in each section; ends: each section's last
    paragraph; paragraphs: struct(sha, chars, pieces: hashes, sizes: characters of each piece))."""
    p, e, s = f"__{name}_paragraphs", f"__{name}_ends", f"__{name}_sections"

    def paragraph(x: Column) -> Column:
        own = lambda cut: F.struct(F.sha2(x, 256).alias("sha"), F.length(x).alias("chars"), F.transform(cut, lambda y: F.xxhash64(y)).alias("pieces"), F.transform(cut, F.length).alias("sizes"))
        return let(F.regexp_extract_all(x, F.lit(PIECE), F.lit(0)), own)

    df = df.withColumn(p, F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), paragraph))
    whole = F.when(F.size(p) > 0, F.sequence(F.lit(1), F.size(p))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(e, F.filter(whole, lambda i: (i == F.size(p)) | F.substring(F.element_at(p, i)["sha"], 64, 1).isin(LAST)))
    starts = F.concat(F.array(F.lit(0)), F.slice(e, 1, F.greatest(F.size(e) - 1, F.lit(0))))
    section = lambda own: F.struct(F.sha2(F.array_join(F.transform(own, lambda x: x["sha"]), ""), 256).alias("sha"), _total(F.transform(own, lambda x: F.size(x["pieces"]))).alias("n"))
    df = df.withColumn(s, F.when(F.size(e) > 0, F.zip_with(starts, F.col(e), lambda a, b: let(F.slice(p, a + 1, b - a), section))).otherwise(F.array().cast("array<struct<sha:string,n:int>>")))
    hashes = F.transform(s, lambda x: x["sha"])
    tree = F.struct(F.sha2(F.array_join(hashes, ""), 256).alias("root"), hashes.alias("sections"), F.transform(s, lambda x: x["n"]).alias("leaves"), F.col(e).alias("ends"), F.col(p).alias("paragraphs"))
    return df.withColumn(name, tree).drop(p, e, s)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda acc, x: acc + x)


def _between(xs: Column, lead: Column, trail: Column) -> Column:
    """xs without its first lead and last trail items."""
    return F.slice(xs, lead + 1, F.greatest(F.size(xs) - lead - trail, F.lit(0)))


def _leading(xs: Column, ys: Column) -> Column:
    """How many items agree from the start."""
    n = F.least(F.size(xs), F.size(ys))
    agree = F.zip_with(F.slice(xs, 1, n), F.slice(ys, 1, n), lambda x, y: x == y)
    return let(F.array_position(agree, F.lit(False)).cast("int"), lambda at: F.when(at > 0, at - 1).otherwise(n))


def _agreeing(xs: Column, ys: Column, body) -> Column:
    """body(lead, trail): how many items agree from the start, and of the rest from the end."""
    ends = lambda lead: let(_leading(F.reverse(_between(xs, lead, F.lit(0))), F.reverse(_between(ys, lead, F.lit(0)))), lambda trail: body(lead, trail))
    return let(_leading(xs, ys), ends)


def pieces_of(tree: Column) -> Column:
    return F.flatten(F.transform(tree["paragraphs"], lambda x: x["pieces"]))


def fingerprint(tree: Column) -> Column:
    """The tree as one string: root; 16 hex digits of every section; the pieces' hashes in the order of the text, in base 64."""
    packed = F.unhex(F.array_join(F.transform(pieces_of(tree), lambda x: F.lpad(F.hex(x), 16, "0")), ""))
    return F.concat_ws(";", tree["root"], F.array_join(F.transform(tree["sections"], lambda s: F.left(s, F.lit(16))), ""), F.base64(packed))


def _in_common(xs: Column, ys: Column) -> Column:
    """Items in common, repeats counted, in one walk over both in order; hashes lose their top bit to the side's mark."""
    both = F.sort_array(F.concat(F.transform(xs, lambda x: F.shiftleft(x, 1)), F.transform(ys, lambda y: F.shiftleft(y, 1).bitwiseOR(F.lit(1)))))
    zero = F.struct(F.lit(0).cast("bigint").alias("item"), F.lit(0).alias("left"), F.lit(0).alias("common"))

    def walk(acc: Column, x: Column) -> Column:
        item, left = F.shiftright(x, 1), F.when(acc["item"] == F.shiftright(x, 1), acc["left"]).otherwise(0)
        mine = x.bitwiseAND(F.lit(1)) == 0
        return F.struct(item.alias("item"), F.when(mine, left + 1).otherwise(F.greatest(left - 1, F.lit(0))).alias("left"), (acc["common"] + F.when(~mine & (left > 0), 1).otherwise(0)).alias("common"))

    return F.aggregate(both, zero, walk, lambda acc: acc["common"])


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the leaves in common by the leaves of both. a, b: struct(root, sections, leaves, pieces)."""

    def common(lead: Column, trail: Column) -> Column:
        below = lambda t: (_total(F.slice(t["leaves"], 1, lead)), _total(F.reverse(F.slice(F.reverse(t["leaves"]), 1, trail))))
        (lead_a, trail_a), (lead_b, trail_b) = below(a), below(b)
        return lead_a + trail_a + _in_common(_between(a["pieces"], lead_a, trail_a), _between(b["pieces"], lead_b, trail_b))

    both = F.size(a["pieces"]) + F.size(b["pieces"])
    return F.when(a["root"] == b["root"], 1.0).when(both == 0, 0.0).otherwise(2.0 * _agreeing(a["sections"], b["sections"], common) / both)


def leaves(tree: Column) -> Column:
    """What likeness needs of a tree."""
    return F.struct(tree["root"].alias("root"), F.transform(tree["sections"], lambda s: F.left(s, F.lit(16))).alias("sections"), tree["leaves"].alias("leaves"), pieces_of(tree).alias("pieces"))


def differing(a: Column, b: Column) -> Column:
    """Where tree a's text differs from tree b's: struct(section, paragraph: 1-based numbers of the first branches that differ,
    start, stop: the code points of a between which all differences lie). Null for equal roots."""
    chars = lambda own: _total(F.transform(own, lambda x: x["chars"]))
    flat = lambda own, k: F.flatten(F.transform(own, lambda x: x[k]))

    def in_sections(lead: Column, trail: Column) -> Column:
        last = lambda t, n: F.when(n > 0, F.element_at(t["ends"], n)).otherwise(0)
        return let(
            F.struct(last(a, lead).alias("a0"), last(a, F.size(a["sections"]) - trail).alias("a1"), last(b, lead).alias("b0"), last(b, F.size(b["sections"]) - trail).alias("b1"), lead.alias("section")),
            in_paragraphs,
        )

    def in_paragraphs(of: Column) -> Column:
        mine, other = F.slice(a["paragraphs"], of["a0"] + 1, of["a1"] - of["a0"]), F.slice(b["paragraphs"], of["b0"] + 1, of["b1"] - of["b0"])
        sha = lambda own: F.transform(own, lambda x: x["sha"])
        return _agreeing(sha(mine), sha(other), lambda lead, trail: in_pieces(of, lead, trail, _between(mine, lead, trail), _between(other, lead, trail)))

    def in_pieces(of: Column, above: Column, below: Column, mine: Column, other: Column) -> Column:
        def found(lead: Column, trail: Column) -> Column:
            before, after = F.slice(a["paragraphs"], 1, of["a0"] + above), F.reverse(F.slice(F.reverse(a["paragraphs"]), 1, F.size(a["paragraphs"]) - of["a1"] + below))
            sizes = flat(mine, "sizes")
            start = chars(before) + _total(F.slice(sizes, 1, lead))
            stop = chars(a["paragraphs"]) - chars(after) - _total(F.slice(F.reverse(sizes), 1, trail))
            return F.struct((of["section"] + 1).alias("section"), (of["a0"] + above + 1).alias("paragraph"), start.alias("start"), stop.alias("stop"))

        return _agreeing(flat(mine, "pieces"), flat(other, "pieces"), found)

    return F.when(a["root"] != b["root"], _agreeing(a["sections"], b["sections"], in_sections))


def _in_order(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(key, n_chars, at): documents numbered from 0 in the order of their key, and whether any stands in several rows."""
    keys = docs.groupBy("key").agg(F.first(F.length("text")).alias("n_chars"), F.count("*").alias("rows"))
    ranged = keys.repartitionByRange("key").sortWithinPartitions("key").select("key", "n_chars", "rows", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    ranged = written(ranged, "ordered-keys")
    parts = ranged.groupBy("part").agg(F.count("*").alias("n"), F.max("rows").alias("rows")).orderBy("part").collect()  # a row for each partition
    before, offsets = 0, []
    for r in parts:
        offsets.append((r["part"], before))
        before += r["n"]
    spark = docs.sparkSession
    base = spark.createDataFrame(offsets, "part int, base bigint")
    numbered = ranged.join(F.broadcast(base), "part").select("key", "n_chars", (F.col("base") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("at"))
    count = F.lit(before)
    earlier = numbered.select(F.pmod(F.col("at") + 1, count).alias("at"), F.col("key").alias("target"), F.floor(F.col("n_chars") / 4).cast("int").alias("wanted"))
    return written(numbered.join(earlier, "at").select("key", "target", "wanted"), "next-documents"), any(r["rows"] > 1 for r in parts)


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and
    where the edit is found: edit_section, edit_paragraph, edit_start, edit_stop (see differing).

    The edited text has its last quarter of characters replaced by as many from the start of the next document in the
    order of ids, null ids first and equal ids by their text's hash; the first follows the last. Rows that repeat an id
    and a text are one document. A null text counts as empty; an empty text has no paragraphs, and is equal to another
    empty one. A very long text is a longer tree, and a very long line a longer list of leaves; work grows with their
    number. Other columns are neither read nor returned. An empty table gives an empty result.
    """
    named = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).select(F.struct("id", F.sha2("text", 256).alias("sha")).alias("key"), "text")
    order, repeated = _in_order(named)
    placed = named.join(order, "key")
    heads = with_tree(placed.select("target", F.substring(F.col("text"), F.lit(1), F.col("wanted")).alias("head"), "text"), F.col("text"), "next_tree")
    heads = heads.select(F.col("target").alias("key"), "head", leaves(F.col("next_tree")).alias("next"))
    if repeated:
        heads = heads.dropDuplicates(["key"])
    n = F.length("text")
    pairs = placed.select("key", "text").join(heads, "key")
    pairs = pairs.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / 4).cast("int")), F.col("head")))
    both = with_tree(with_tree(pairs, F.col("text"), "tree"), F.col("edited"), "edited_tree")
    both = both.withColumns({"own": leaves(F.col("tree")), "other": leaves(F.col("edited_tree")), "edit": differing(F.col("tree"), F.col("edited_tree"))})
    return both.select(
        F.col("key.id").alias(id_col), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("tree")).alias("fingerprint"),
        fingerprint(F.col("edited_tree")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"),
        F.col("edit.section").alias("edit_section"), F.col("edit.paragraph").alias("edit_paragraph"), F.col("edit.start").alias("edit_start"), F.col("edit.stop").alias("edit_stop"),
    )


def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents"))
