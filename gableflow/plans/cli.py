"""Command line: create, reset, import, extract, find neighbours, link, validate. Commands may be combined; they run in this order."""

from __future__ import annotations

import argparse
import json
import logging
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import matching
from ..operators import spatial as S
from ..operators import validation as V
from ..operators.rows import upsert
from ..sources import readers
from ..staging import discard, written
from .pipeline import Config, Workspace, extract_features, link_buildings, validate

log = logging.getLogger("gableflow")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="gableflow", description=__doc__)
    out.add_argument("--database", default="gableflow")
    out.add_argument("--create-db", action="store_true", help="create all tables")
    out.add_argument("--reset-db", action="append", choices=("all", "source", "derived", "supplementary"), default=[], help="drop and create the tables of a scope; may be repeated and combined with imports and all other commands")
    out.add_argument("--import-model", metavar="PATH", help="city model: CityJSON, CityGML, a folder with both, or a folder of tables; {lod} stands for the level of detail")
    out.add_argument("--import-limit", type=int)
    out.add_argument("--import-archetypes", metavar="FOLDER", help="folder of <country>.csv")
    out.add_argument("--lod", type=int, action="append", choices=(2, 3), help="level of detail; may be repeated (else LODS, else 2)")
    out.add_argument("--extract-features", action="store_true")
    out.add_argument("--flag-neighbours", action="store_true", help="find attached neighbours and store them with the buildings")
    out.add_argument("--link", nargs=2, metavar=("RES", "OTH"), help="Parquet of the two link layers")
    out.add_argument("--validate", metavar="CONFIG", help="JSON of the attribute mapping; results go to --output")
    out.add_argument("--output", metavar="FOLDER", help="folder for validation results: CSV, Markdown and LaTeX")
    return out


def import_model(own: Workspace, path: str, lod: int, limit: int | None) -> None:
    spark = own.spark
    model = readers.city_model(spark, path.replace("{lod}", str(lod)), lod=lod, limit=limit, existing=own.read("feature", lod))
    if model is None:
        log.warning("no city model at %s: level of detail %d is skipped", path, lod)
        return
    model = {name: written(df, name) for name, df in model.items()}  # read in full before the first table grows
    for name in ("feature", "geometry_data", "property"):
        own.append(name, model[name], lod)
    own.replace("objectclass", model.get("objectclass", readers.objectclass(spark)), lod)
    readers.verify_ids(own.read("feature", lod))
    discard(*model.values())
    log.info("lod %d: %d features imported", lod, own.read("feature", lod).count())


def extract(own: Workspace, cfg: Config, lod: int) -> None:
    out = extract_features(own.model(lod), own.read("tabula_variant"), cfg, lod, done=own.read("building", lod), existing_surfaces=own.read("surface", lod))
    surface = written(out.surface, "surface")
    status = out.building.select("object_id", "country_code", F.lit(f"lod{lod}").alias("stage"), F.lit("extracted").alias("status"), F.current_timestamp().alias("updated_at"))
    for name, df in (("surface_raw", out.surface_raw), ("pipeline_status", written(status, "status")), ("building", out.building), ("surface", surface)):
        own.append(name, df, lod)
    log.info("lod %d extracted: %d buildings", lod, own.read("building", lod).count())


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    cfg = Config.from_env(dict(os.environ))
    spark = spark or SparkSession.builder.appName("gableflow").getOrCreate()
    own, lods = Workspace(spark, args.database), tuple(args.lod or cfg.lods)
    for scope in args.reset_db:
        own.reset(scope)
        log.info("%s tables are empty", scope)
    if args.create_db:
        own.create()
    if args.import_archetypes:
        sheet = readers.archetype_sheet(spark, args.import_archetypes, cfg.country.strip().lower().replace(" ", "_"))
        own.replace("tabula", sheet)
        own.replace("tabula_variant", matching.archetypes(own.read("tabula")))
    for lod in lods:
        if args.import_model:
            import_model(own, args.import_model, lod, args.import_limit or cfg.import_limit or None)
        if args.extract_features:
            extract(own, cfg, lod)
        if args.flag_neighbours:
            building = own.read("building", lod)
            pairs = written(S.neighbour_pairs(building, cfg.neighbour_tolerance, cfg.cell), "neighbours")
            own.replace("building_neighbours", pairs, lod)
            own.replace("building", S.flag_neighbours(building, cfg.neighbour_tolerance, cfg.cell, pairs), lod)
            log.info("lod %d: %d pairs of neighbours", lod, pairs.count())
    if args.link:
        links = link_buildings(own.read("building", lods[0]), *(spark.read.parquet(p) for p in args.link), cfg)
        own.replace("building_link", upsert(own.read("building_link"), links.select(*Workspace.SCHEMAS["building_link"].names), "object_id", "country_code", keep=("srid",)))
    if args.validate:
        with open(args.validate, encoding="utf-8") as file:
            config = json.load(file)
        for lod in lods:
            found = validate(own.read("building", lod), own.read("surface_raw", lod), own.read("property", lod), config, own.read("building_link"))
            folder = f"{args.output or '.'}/validation_lod{lod}"
            for title, df in {**found.tables, "detail buildings": found.buildings, "detail surfaces": found.surfaces, "problematic": V.problematic(found.surfaces)}.items():
                V.csv_sink(df, f"{folder}/{title.lower().replace(' ', '_')}.csv")
            for style in ("markdown", "latex"):
                spark.createDataFrame([(V.report(found.tables, found.sentences, style),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/report_{style}")
            for sentence in found.sentences:
                log.info("%s", sentence)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
