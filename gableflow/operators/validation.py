"""Accuracy of computed attributes against thematic properties: long tables, errors, summaries, quality, rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import circular_difference, numeric
from .faces import GROUND, ROOF, WALL
from .rows import first_by, sample_by_hash

TILT, AZIMUTH = "tilt", "azimuth"
HEIGHTS = ("min_height", "max_height")


def mapping(spark: SparkSession, config: dict) -> DataFrame:
    """(level, attribute_name, source_label, unit) from a parsed configuration.

    attributes.parent.<name> and attributes.child.<class>.<name> hold computed_column or computed_columns, source_label and
    unit; entries without a label are skipped.
    """
    rows = []
    attributes = config.get("attributes", {})
    for level, entries in (("parent", attributes.get("parent", {})), *((f"child.{k}", v or {}) for k, v in attributes.get("child", {}).items())):
        for entry in entries.values():
            label = (entry or {}).get("source_label")
            columns = (entry or {}).get("computed_columns") or [(entry or {}).get("computed_column")]
            if label:
                rows += [(level, c, label, entry.get("unit")) for c in ([columns] if isinstance(columns, str) else columns) if c]
    return spark.createDataFrame(rows, "level string, attribute_name string, source_label string, unit string")


def thematic_values(entities: DataFrame, prop: DataFrame, labels: DataFrame, entity: str) -> DataFrame:
    """(entity, attribute_name, thematic_value): numeric properties of the entities, under every attribute their label stands for."""
    value = numeric(F.col("val_double"), F.col("val_int"), F.col("val_string"))
    own = prop.select(F.col("feature_id").alias(entity), F.col("name").alias("source_label"), value.alias("thematic_value")).where("thematic_value is not null")
    return own.join(entities.select(entity).hint("merge"), entity, "left_semi").join(F.broadcast(labels.select("source_label", "attribute_name")), "source_label").select(entity, "attribute_name", "thematic_value")


def sampled_eligible(values: DataFrame, entity: str, n: int, seed: int = 0) -> DataFrame:
    """n entities with a thematic value for each attribute, the same ones every time."""
    return sample_by_hash(values, entity, n, seed, ["attribute_name"])


def long_table(df: DataFrame, entity: str, attributes: list[str], keep: list[str]) -> DataFrame:
    """(entity, keep, attribute_name, calculated_value): one row per attribute."""
    return df.select(entity, *keep, *(F.col(a).cast("double") for a in attributes)).unpivot([entity, *keep], attributes, "attribute_name", "calculated_value")


def _errors(df: DataFrame, difference: Column, circular: Column) -> DataFrame:
    percent = F.when(~circular & (F.col("thematic_value") != 0), F.lit(100.0) * F.col("difference") / F.col("thematic_value"))
    return df.withColumn("difference", difference).withColumn("percent_error", percent)


def validate_buildings(buildings: DataFrame, thematic: DataFrame, attributes: list[str], keep: tuple[str, ...] = ("has_attached_neighbour",)) -> DataFrame:
    """Long table of building attributes with their errors; the percent error is null at 0."""
    own = long_table(buildings, "building_feature_id", attributes, list(keep)).join(thematic.hint("merge"), ["building_feature_id", "attribute_name"])
    return _errors(own, F.col("calculated_value") - F.col("thematic_value"), F.lit(False))


def validate_surfaces(faces: DataFrame, thematic: DataFrame, attributes: list[str], classes: tuple[str, ...] = (ROOF, WALL, GROUND)) -> DataFrame:
    """Long table of surface attributes: one face per surface, azimuths of -1 dropped and compared on the circle."""
    own = first_by(faces.where(F.col("classname").isin(*classes)), ["surface_feature_id"], [F.col("building_feature_id"), F.col("face_idx")])
    rows = long_table(own, "surface_feature_id", attributes, ["building_feature_id", "classname", "is_valid", "is_planar"]).join(thematic.hint("merge"), ["surface_feature_id", "attribute_name"])
    circular = F.col("attribute_name") == AZIMUTH
    rows = rows.where(~circular | ((F.col("calculated_value") != -1) & (F.col("thematic_value") != -1)))
    difference = F.when(circular, circular_difference(F.col("calculated_value"), F.col("thematic_value"))).otherwise(F.col("calculated_value") - F.col("thematic_value"))
    return _errors(rows, difference, circular)


def within_tolerance(rows: DataFrame, absolute: float, percent: float) -> DataFrame:
    """rows with within_tolerance: the difference or the percent error is small enough."""
    return rows.withColumn("within_tolerance", (F.abs("difference") <= absolute) | F.coalesce(F.abs("percent_error") <= percent, F.lit(False)))


def plot_errors(rows: DataFrame) -> DataFrame:
    """The plots' own errors: absolute circular distance for azimuths, percentages over thematic + 1e-6, none for angles."""
    d = F.col("calculated_value") - F.col("thematic_value")
    around = F.abs(circular_difference(F.col("calculated_value"), F.col("thematic_value")))
    error = F.when(F.col("attribute_name") == AZIMUTH, around).otherwise(d)
    percent = F.when(~F.col("attribute_name").isin(TILT, AZIMUTH), F.lit(100.0) * d / (F.col("thematic_value") + F.lit(1e-6)))
    return rows.withColumn("error", error).withColumn("error_percent", percent)


def _rmse(value: Column) -> Column:
    return F.sqrt(F.avg(value * value))


def error_summary(rows: DataFrame, *by: str) -> DataFrame:
    """Per attribute (and by): count, mean, sample deviation, RMSE; mean, median, deviation of the percent error; 4 decimals."""
    d, p = F.col("difference"), F.col("percent_error")
    r4 = lambda c, name: F.round(c, 4).alias(name)
    return rows.groupBy("attribute_name", *by).agg(
        F.count("*").alias("n"), r4(F.avg(d), "mean_difference"), r4(F.stddev_samp(d), "std_difference"), r4(_rmse(d), "rmse"), r4(F.avg(p), "mean_percent"), r4(F.median(p), "median_percent"), r4(F.stddev_samp(p), "std_percent")
    )


def error_breakdown(rows: DataFrame, source: str = "match_source") -> DataFrame:
    return rows.groupBy("attribute_name", source).agg(F.count("*").alias("n"), F.round(_rmse(F.col("difference")), 4).alias("rmse"), F.round(F.avg("difference"), 4).alias("mean_difference"))


def geometry_quality(faces: DataFrame) -> DataFrame:
    """Per class: faces, invalid and non-planar ones, and their percentages."""
    count = lambda c: F.count(F.when(~F.col(c), 1))
    share = lambda c: F.round(F.lit(100.0) * count(c) / F.count("*"), 2)
    return faces.groupBy("classname").agg(F.count("*").alias("total"), count("is_valid").alias("invalid"), share("is_valid").alias("invalid_percent"), count("is_planar").alias("non_planar"), share("is_planar").alias("non_planar_percent"))


def descriptive_stats(values: DataFrame, value: str = "thematic_value", by: str = "attribute_name") -> DataFrame:
    own = values.withColumn("__v", F.expr(f"try_cast({value} as double)")).where("__v is not null")
    r4 = lambda c, name: F.round(c, 4).alias(name)
    return own.groupBy(by).agg(F.count("*").alias("n"), r4(F.avg("__v"), "mean"), r4(F.stddev_samp("__v"), "std"), F.min("__v").alias("least"), F.max("__v").alias("most"))


def problematic(rows: DataFrame, percent: float = 10.0, absolute: float = 170.0) -> DataFrame:
    return rows.where(F.coalesce(F.abs("percent_error") > percent, F.lit(False)) | F.coalesce(F.abs("difference") > absolute, F.lit(False)))


def error_percentiles(rows: DataFrame) -> DataFrame:
    """Per attribute: P5, P25, P75, P95 of the absolute difference, and the percentage of rows beyond the RMSE."""
    size = F.abs("difference")
    stats = rows.groupBy("attribute_name").agg(F.percentile(size, F.array(*(F.lit(x) for x in (0.05, 0.25, 0.75, 0.95)))).alias("p"), _rmse(F.col("difference")).alias("rmse"), F.count("*").alias("n"))
    tail = rows.join(F.broadcast(stats.select("attribute_name", "rmse")), "attribute_name").groupBy("attribute_name").agg(F.count(F.when(size > F.col("rmse"), 1)).alias("beyond"))
    out = stats.join(tail, "attribute_name")
    return out.select("attribute_name", *(F.round(F.col("p")[i], 4).alias(f"p{q}") for i, q in enumerate((5, 25, 75, 95))), F.round(F.lit(100.0) * F.col("beyond") / F.col("n"), 2).alias("tail_percent"))


def rmse_stratified(rows: DataFrame) -> DataFrame:
    """Per attribute: RMSE of valid and planar faces, of the others, and the second by the first."""
    good = F.coalesce(F.col("is_valid") & F.col("is_planar"), F.lit(False))
    d2 = F.col("difference") * F.col("difference")
    own = rows.groupBy("attribute_name").agg(F.sqrt(F.avg(F.when(good, d2))).alias("g"), F.sqrt(F.avg(F.when(~good, d2))).alias("b"))
    return own.select("attribute_name", F.round("g", 4).alias("rmse_good"), F.round("b", 4).alias("rmse_bad"), F.round(F.col("b") / F.nullif("g", F.lit(0.0)), 4).alias("ratio"))


def height_by_attachment(rows: DataFrame) -> DataFrame:
    """Per height attribute: RMSE of all, detached and attached buildings."""
    d2 = F.col("difference") * F.col("difference")
    attached = F.col("has_attached_neighbour")
    part = lambda c, name: F.round(F.sqrt(F.avg(c)), 4).alias(name)
    return rows.where(F.col("attribute_name").isin(*HEIGHTS)).groupBy("attribute_name").agg(part(d2, "rmse_all"), part(F.when(~attached, d2), "rmse_detached"), part(F.when(attached, d2), "rmse_attached"))


def throughput(faces: DataFrame, seconds: float) -> DataFrame:
    return faces.groupBy("classname").agg(F.count("*").alias("n")).select("classname", "n", F.round(F.col("n") / F.lit(seconds), 2).alias("per_second"))


def r_squared(rows: DataFrame) -> DataFrame:
    """Per attribute: 1 - residual by total sum of squares (0 without variation), RMSE, mean, median and deviation."""
    t = F.col("thematic_value")
    sums = rows.groupBy("attribute_name").agg(F.avg(t).alias("m"))
    own = rows.join(F.broadcast(sums), "attribute_name")
    d = F.col("difference")
    out = own.groupBy("attribute_name").agg(F.sum(d * d).alias("res"), F.sum((t - F.col("m")) * (t - F.col("m"))).alias("tot"), _rmse(d).alias("rmse"), F.avg(d).alias("mean"), F.median(d).alias("median"), F.stddev_samp(d).alias("std"))
    r4 = lambda c: F.round(c, 4)
    r2 = F.when(F.col("tot") == 0, F.lit(0.0)).otherwise(1 - F.col("res") / F.nullif("tot", F.lit(0.0)))
    return out.select("attribute_name", r4(r2).alias("r_squared"), r4(F.col("rmse")).alias("rmse"), r4(F.col("mean")).alias("mean"), r4(F.col("median")).alias("median"), r4(F.col("std")).alias("std"))


def error_histogram(rows: DataFrame, bins: int = 30) -> DataFrame:
    """(attribute_name, bin from 0, n) over the range of each attribute's differences; the last bin holds the maximum."""
    span = rows.groupBy("attribute_name").agg(F.min("difference").alias("lo"), F.max("difference").alias("hi"))
    own = rows.join(F.broadcast(span), "attribute_name")
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col("difference") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * bins), F.lit(bins - 1)))
    return own.groupBy("attribute_name", at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


FAILED = ("failed", "error", "fail")


def batch_statuses(rows: DataFrame) -> DataFrame:
    """One row (total, retried, failed) from rows with a status and a number of retries."""
    status = F.lower(F.coalesce(F.col("status").cast("string"), F.lit("")))
    retries = F.coalesce(F.expr("try_cast(retries as int)"), F.lit(0)) if "retries" in rows.columns else F.lit(0)
    return rows.agg(F.count("*").alias("total"), F.count(F.when(retries > 0, 1)).alias("retried"), F.count(F.when(status.isin(*FAILED), 1)).alias("failed"))


def batch_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row (total, succeeded, retried, failed) from log lines: what starts, ends well, is tried again or fails with its batch."""
    line = F.lower(F.col(column))
    batch, any_of = line.contains("batch"), lambda *words: reduce(lambda a, b: a | b, (line.contains(w) for w in words))
    count = lambda c, name: F.count(F.when(c, 1)).alias(name)
    return lines.agg(count(batch & any_of("start"), "total"), count(batch & any_of("success", "complete", "done"), "succeeded"), count(any_of("retry", "retrying"), "retried"), count(batch & any_of("failed", "error"), "failed"))


def batch_log(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of a batch log: CSV with a status column, or plain lines."""
    return batch_statuses(spark.read.csv(path, header=True)) if path.endswith(".csv") else batch_lines(spark.read.text(path))


def area_strata(surfaces: DataFrame) -> DataFrame:
    """Per surface class: RMSE of the area over all, valid and planar, and other faces, with their counts."""
    good = F.coalesce(F.col("is_valid") & F.col("is_planar"), F.lit(False))
    d2 = F.col("difference") * F.col("difference")
    rmse = lambda c: F.sqrt(F.avg(c))
    own = surfaces.where(F.col("attribute_name") == "surface_area").groupBy("classname")
    return own.agg(rmse(d2).alias("rmse_all"), rmse(F.when(good, d2)).alias("rmse_good"), rmse(F.when(~good, d2)).alias("rmse_bad"), F.count(F.when(good, 1)).alias("n_good"), F.count(F.when(~good, 1)).alias("n_bad"))


def takeaway_rules(surfaces: DataFrame, buildings: DataFrame, failed: int = 0) -> DataFrame:
    """(rule, value, fires): the five threshold rules over the long tables of surfaces and buildings.

    A: the area error of walls that are not valid and planar is over 100 times that of the others. B: max_height is over 1 m
    too high on average. C: over 80 % of the roof areas are of faces not known to be planar. D: batches failed. E: no
    building is attached, so heights are those of detached buildings only. value is null where there is nothing to judge.
    """
    strata = area_strata(surfaces)
    walls = strata.where(F.col("classname") == WALL).agg(F.first(F.col("rmse_bad") / F.nullif("rmse_good", F.lit(0.0))).alias("value"))
    bias = buildings.where(F.col("attribute_name") == "max_height").agg(F.avg("difference").alias("value"))
    roofs = surfaces.where((F.col("classname") == ROOF) & (F.col("attribute_name") == "surface_area")).agg(F.avg(F.when(F.coalesce("is_planar", F.lit(False)), 0.0).otherwise(1.0)).alias("value"))
    batches = surfaces.sparkSession.range(1).select(F.lit(float(failed)).alias("value"))
    attached = buildings.agg(F.max(F.coalesce(F.col("has_attached_neighbour"), F.lit(False)).cast("double")).alias("value"))
    rule = lambda name, df, fires: df.select(F.lit(name).alias("rule"), "value", F.coalesce(fires, F.lit(False)).alias("fires"))
    value = F.col("value")
    parts = [rule("A", walls, value > 100), rule("B", bias, value > 1.0), rule("C", roofs, value > 0.8), rule("D", batches, value > 0), rule("E", attached, value == 0)]
    return reduce(DataFrame.unionByName, parts)


def takeaways(surfaces: DataFrame, buildings: DataFrame, failed: int = 0) -> list[str]:
    """Sentences from the strata and the rules that fire, which are a few rows."""
    out = []
    for r in area_strata(surfaces).orderBy("classname").collect():
        if r["rmse_bad"] is not None and r["rmse_good"]:
            out.append(f"{r['classname']}: the area error of faces that are not valid and planar is {r['rmse_bad']:.3f} m2 (n={r['n_bad']}), {r['rmse_bad'] / r['rmse_good']:.1f} times that of the others ({r['rmse_good']:.3f} m2, n={r['n_good']}).")
        elif r["rmse_all"] is not None:
            out.append(f"{r['classname']}: the area error is {r['rmse_all']:.3f} m2.")
    said = {
        "A": "Walls that are not valid and planar are {:.0f} times less exact: the source model is at fault, not the extraction.",
        "B": "Maximal heights are {:.2f} m too high on average against the thematic values.",
        "C": "{:.1%} of the roof faces are not planar, as the model's level of detail draws them.",
        "D": "{:.0f} batches failed in spite of all retries.",
        "E": "No building is attached: heights are those of detached buildings only.",
    }
    return out + [said[r["rule"]].format(r["value"]) for r in takeaway_rules(surfaces, buildings, failed).orderBy("rule").collect() if r["fires"]]


def latest_of(names: DataFrame, column: str) -> DataFrame:
    """The last run folder by name, of a table of names."""
    return names.where(F.col(column).startswith("validation_")).agg(F.max(column).alias(column))


def latest_run(names: list[str]) -> str:
    """The last run folder by name."""
    own = sorted(n for n in names if n.startswith("validation_"))
    if not own:
        raise FileNotFoundError("no validation run found")
    return own[-1]


def _cells(df: DataFrame) -> tuple[list[str], list[list[str]]]:
    """A small result's header and rows as text, in the order of its first columns."""
    rows = df.orderBy(*df.columns[:2]).collect()
    return df.columns, [["" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v) for v in r] for r in rows]


def markdown_table(df: DataFrame) -> str:
    head, rows = _cells(df)
    return "\n".join(["| " + " | ".join(head) + " |", "|" + " --- |" * len(head), *("| " + " | ".join(r) + " |" for r in rows)])


def latex_table(df: DataFrame) -> str:
    """The result as a LaTeX tabular."""
    clean = lambda v: "".join({"_": r"\_", "%": r"\%", "&": r"\&", "#": r"\#", "$": r"\$"}.get(c, c) for c in v)
    head, rows = _cells(df)
    line = lambda r: " & ".join(map(clean, r)) + r" \\"
    return "\n".join([rf"\begin{{tabular}}{{{'l' * len(head)}}}", r"\hline", line(head), r"\hline", *map(line, rows), r"\hline", r"\end{tabular}"])


def csv_sink(df: DataFrame, path: str) -> None:
    """One CSV folder with a header; for aggregates and exports alike, written by the executors."""
    df.write.mode("overwrite").option("header", True).csv(path)


def report(tables: dict[str, DataFrame], sentences: list[str], style: str = "markdown") -> str:
    """The validation report, in Markdown or LaTeX, from aggregates of a few rows."""
    if style == "latex":
        items = [r"\begin{itemize}", *(rf"\item {t}" for t in sentences), r"\end{itemize}"] if sentences else []
        return "\n".join([r"\section*{Validation report}", *items, *(rf"\subsection*{{{title}}}" + "\n" + latex_table(df) for title, df in tables.items())]) + "\n"
    return "\n".join(["# Validation report", *(f"- {t}" for t in sentences), *(f"\n## {title}\n\n{markdown_table(df)}" for title, df in tables.items())]) + "\n"
