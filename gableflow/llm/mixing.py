"""Operator 4: temperature mixing of sources (DataFrame functions only).

The token shares of the sources are raised to an exponent a between 0 (all alike) and 1 (as they are) and normalised. The
exponent is bisected, many points at a time and each time in one aggregate over the sources' totals: it is the largest
that reaches the target entropy, raised where needed until no source is repeated more often than the limit. Weights
become whole token quotas of the budget. A source's documents stand in a permutation by hash, of which it gives whole
rounds and then a first part up to its quota; every block of the mixture takes the same share of each source's quota, and
stands in a permutation of its own. Prefix sums have three levels, hash ranges, shares of the rows of one key within a
range, and rows of a share, so that no task holds a source or all rows that repeat an id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, struct_of_row, table, whole_text, written

#: Production parameters: entropy as a share of the largest possible, most rounds of a source, tokens of a block.
ENTROPY, REPEATS, BLOCK, SEED = 0.95, 4.0, 1 << 16, "mix"
#: Points tried at once, and how often.
POINTS, ROUNDS = 32, 6


def words_in(text: Column) -> Column:
    """Tokens as mixing counts them: runs between white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def temperature(totals: DataFrame, budget: int, entropy: float | None, repeats: float | None) -> float:
    """totals (tokens, positive) -> the exponent. The driver sees POINTS numbers a round, whatever the number of sources."""
    whole = totals.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).first()
    if not whole["n"]:
        return 1.0

    def reach(grid: list[float]) -> dict[float, tuple[float, float]]:
        p = F.col("tokens") / F.lit(float(whole["tokens"]))
        each = totals.select(p.alias("p"), F.explode(F.array(*map(F.lit, grid))).alias("a"))
        sums = each.groupBy("a").agg(F.sum(F.pow("p", F.col("a"))).alias("z"), F.sum(F.pow("p", F.col("a")) * F.log("p")).alias("s"), F.max(F.pow("p", F.col("a") - 1)).alias("top"))
        return {r["a"]: (math.log(r["z"]) - r["a"] * r["s"] / r["z"], r["top"] / r["z"] * budget / whole["tokens"]) for r in sums.collect()}

    def bisect(holds) -> float:
        """holds is true up to some exponent and false above: that exponent, rounded down to the grid; 0 if it never is."""
        low, high = 0, POINTS**ROUNDS
        while high - low > 1:
            grid = sorted({low + (high - low) * k // POINTS for k in range(POINTS + 1)})
            got = reach([g / POINTS**ROUNDS for g in grid])
            ok = [g for g in grid if holds(*got[g / POINTS**ROUNDS])]
            if grid[-1] in ok:
                return high / POINTS**ROUNDS
            if not ok:
                return low / POINTS**ROUNDS
            low, high = max(ok), min(g for g in grid if g > max(ok))
        return low / POINTS**ROUNDS

    a = 1.0 if entropy is None else bisect(lambda h, top: h >= entropy * math.log(whole["n"]) - 1e-9)
    if repeats is not None:
        b = bisect(lambda h, top: top > max(repeats, budget / whole["tokens"]) + 1e-9)
        a = max(a, min(1.0, b + 1 / POINTS**ROUNDS) if b or reach([0.0])[0.0][1] > max(repeats, budget / whole["tokens"]) + 1e-9 else 0.0)
    return a


def mix(rows: DataFrame, tokens: Column, id_col: str = "doc_id", source_col: str = "source", *, budget: int | None = None, entropy: float | None = ENTROPY, repeats: float | None = REPEATS, block: int = BLOCK, seed: str = SEED) -> DataFrame:
    """One row per drawn copy of a document: row (the input row, as a struct), source, n_tokens, copy, block, place.

    The mixture is read in the order of (block, place). budget is the number of tokens to draw; without one it is what the
    rows hold. A null source is a source of its own. A document without tokens takes its turn like any other and costs
    nothing; in a source without any tokens every document is drawn once, into a block by its hash. Quotas are met up to
    the document that crosses them. Rows that repeat an id are separate documents in the same place of the permutation, in
    no particular order; null ids share one place. Very long texts cost what they hold, like any other. Columns of any
    name may be in rows, as they stay inside the struct. An empty table gives an empty result.
    """
    # a struct is never null, and a null inside it equals another
    named = rows.select(struct_of_row(rows).alias("row"), F.col(id_col).cast("string").alias("id"), F.struct(F.col(source_col).alias("source")).alias("of"), tokens.alias("n_tokens"))
    named = written(named.withColumn("num", F.monotonically_increasing_id()), "counted-rows")
    totals = written(named.groupBy("of").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "source-totals")
    whole = totals.agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")).first()
    budget = int(whole["tokens"] or 0) if budget is None else budget
    used = totals.where("tokens > 0")
    a = temperature(used, budget, entropy, repeats)
    z = used.agg(F.sum(F.pow(F.col("tokens") / F.lit(float(whole["tokens"] or 1)), F.lit(a)))).first()[0] or 1.0
    weight = F.pow(F.col("tokens") / F.lit(float(whole["tokens"] or 1)), F.lit(a)) / F.lit(z)
    quotas = totals.select("of", "tokens", F.when(F.col("tokens") > 0, F.floor(weight * F.lit(float(budget)) + 1e-6)).otherwise(0).alias("quota"))

    ranges = max(1, math.isqrt(whole["docs"] or 0))
    blocks = max(1, -(-budget // block))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("id", F.lit(""))))
    high = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    placed = named.withColumn("key", key).withColumn("range", F.floor(high * ranges / F.lit(float(1 << 32))).cast("int"))
    placed = placed.withColumn("slot", F.pmod(F.xxhash64("num"), F.lit(ranges)).cast("int"))
    shares = written(placed.groupBy("of", "range", "key", "slot").agg(F.sum("n_tokens").alias("held")), "share-totals")
    sums = shares.groupBy("of", "range").agg(F.sum("held").alias("held"))
    before = F.sum("held").over(Window.partitionBy("of").orderBy("range")) - F.col("held")
    offsets = written(sums.select("of", "range", before.alias("before")).join(quotas, "of"), "range-offsets")
    inside = F.sum("held").over(Window.partitionBy("of", "range").orderBy("key", "slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("held")
    starts = written(shares.withColumn("inside", inside).join(offsets, ["of", "range"]).select("of", "range", "key", "slot", (F.col("before") + F.col("inside")).alias("before"), "tokens", "quota"), "share-offsets")

    joined = placed.join(starts, ["of", "range", "key", "slot"])
    order = Window.partitionBy("of", "range", "key", "slot").orderBy("num").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    drawn = joined.withColumn("start", F.col("before") + F.sum("n_tokens").over(order) - F.col("n_tokens"))
    copies = F.when(F.col("tokens") > 0, F.expr("quota div tokens") + (F.col("start") < F.expr("quota % tokens")).cast("long")).otherwise(1)
    drawn = drawn.withColumn("copies", copies).where("copies > 0")
    drawn = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    into = F.when(F.col("tokens") > 0, F.least(F.expr(f"cast((copy * tokens + start) as decimal(38,0)) * {blocks} div quota"), F.lit(blocks - 1).cast("long"))).otherwise(F.expr(f"cast({{}} as decimal(38,0)) * {blocks} div {1 << 32}".format("conv(substring(key, 1, 8), 16, 10)")))
    drawn = drawn.withColumn("block", into)
    discard(totals, shares, offsets)
    return drawn.select("row", "of.source", "n_tokens", "copy", "block", F.md5(F.concat_ws(":", F.lit(seed), "block", "copy", F.coalesce("id", F.lit("")))).alias("place"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words_in(whole_text()).alias("n_tokens"))
    return mix(docs, F.col("n_tokens")).select("row.doc_id", "source", "n_tokens", "copy", "block", "place")


def _bisect_sql(name: str, holds: str) -> str:
    """CTE: the largest multiple of 2^-30 up to 1 for which holds(a) is true, given that it is true at 0 and false at 1."""
    mid = "((low + high) // 2 / (1::BIGINT << 30)::DOUBLE)"
    return f"""{name} AS (
  SELECT 0 AS step, 0::BIGINT AS low, (1::BIGINT << 30) AS high
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN mid ELSE low END, CASE WHEN ok THEN high ELSE mid END
  FROM (SELECT step, low, high, (low + high) // 2 AS mid, (SELECT {holds.replace("$a", mid)} FROM p) AS ok FROM {name} WHERE high - low > 1))"""


_EVEN = "ln(sum(p ** $a)) - $a * sum(p ** $a * ln(p)) / sum(p ** $a) >= 0.95 * ln(count(*)) - 1e-9"
_OFTEN = "max(p ** ($a - 1)) / sum(p ** $a) > 4 + 1e-9"

ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
t AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY source),
whole AS (SELECT CAST(sum(tokens) AS BIGINT) AS budget FROM t),
p AS (SELECT tokens / (budget * 1.0::DOUBLE) AS p FROM t, whole WHERE tokens > 0),
{_bisect_sql("even", _EVEN)},
{_bisect_sql("often", _OFTEN)},
a AS (
  SELECT greatest(
    CASE WHEN (SELECT {_EVEN.replace("$a", "1.0::DOUBLE")} FROM p) THEN 1.0::DOUBLE ELSE (SELECT max(low) FROM even WHERE high - low <= 1) / (1::BIGINT << 30)::DOUBLE END,
    CASE WHEN (SELECT {_OFTEN.replace("$a", "0.0::DOUBLE")} FROM p) THEN ((SELECT max(low) FROM often WHERE high - low <= 1) + 1) / (1::BIGINT << 30)::DOUBLE ELSE 0.0::DOUBLE END) AS a),
q AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN CAST(floor((tokens / (budget * 1.0::DOUBLE)) ** a / (SELECT sum(p ** a) FROM p, a) * budget + 1e-6) AS BIGINT) ELSE 0 END AS quota FROM t, whole, a),
s AS (SELECT d.*, q.tokens, q.quota,
             CAST(sum(n_tokens) OVER (PARTITION BY d.source ORDER BY key, CAST(doc_id AS VARCHAR), n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS BIGINT) AS start
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
c AS (SELECT *, CASE WHEN tokens > 0 THEN quota // tokens + CASE WHEN start < quota % tokens THEN 1 ELSE 0 END ELSE 1 END AS copies FROM s),
e AS (SELECT *, unnest(range(0, copies)) AS copy, greatest(1, (budget + 65535) // 65536) AS blocks FROM c, whole WHERE copies > 0),
b AS (SELECT *, CASE WHEN tokens > 0 THEN CAST(least(((copy * tokens + start)::HUGEINT * blocks) // quota, blocks - 1) AS BIGINT) ELSE CAST((('0x' || key[1:8])::BIGINT::HUGEINT * blocks) // 4294967296 AS BIGINT) END AS block FROM e)
SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens, copy, block, md5('mix:' || block || ':' || copy || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM b
"""
