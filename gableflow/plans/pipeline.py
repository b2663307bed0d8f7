"""Whole jobs: ingest, extract, link, correct; incremental runs; the workspace that holds their tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.scalars import parse_srid, supported_country
from ..operators import buildings as B
from ..operators import faces as FA
from ..operators import matching as M
from ..operators import rows as R
from ..operators import spatial as S
from ..operators import validation as V
from ..staging import discard, written


def _positive(text: str) -> float:
    value = float(text)
    if not value > 0:
        raise ValueError(f"must be above 0, not {text!r}")
    return value


def _not_negative(text: str) -> int:
    value = int(text)
    if value < 0:
        raise ValueError(f"must not be below 0, not {text!r}")
    return value


def _lods(text: str) -> tuple[int, ...]:
    out = tuple(int(x) for x in text.replace(",", " ").split())
    if not out or not set(out) <= {2, 3}:
        raise ValueError(f"levels of detail are 2 and 3, not {text!r}")
    return out


#: Variables of the environment: the setting that each gives, and how it is read.
VARIABLES = {
    "COUNTRY": ("country", str), "SRID": ("srid", parse_srid), "SRS_NAME": ("srs_name", str), "LODS": ("lods", _lods), "ROOM_HEIGHT": ("room_height", _positive), "BUILDING_LIMIT": ("building_limit", _not_negative),
    "IMPORT_LIMIT": ("import_limit", _not_negative), "BATCH_SIZE": ("batch_size", _not_negative), "LINK_GRID_SIZE": ("link_grid_size", _positive), "NEIGHBOUR_TOLERANCE": ("neighbour_tolerance", _positive),
}


@dataclass(frozen=True)
class Config:
    """Settings of a run. A country outside the supported ones is an error."""

    country: str = "germany"
    srid: str | int = 25832
    srs_name: str = ""
    lods: tuple[int, ...] = (2,)
    room_height: float = B.ROOM_HEIGHT
    building_limit: int = 0
    import_limit: int = 0
    batch_size: int = 1000
    link_grid_size: float = 1000.0
    neighbour_tolerance: float = 0.5
    missing_ground_flip: float = -1.0
    int_division: bool = True
    link_threshold: float = 0.5
    cell: float = S.CELL
    options: dict[str, str] = field(default_factory=dict)

    @property
    def country_code(self) -> str:
        return supported_country(self.country)

    @property
    def srid_number(self) -> int:
        return parse_srid(str(self.srid))

    @classmethod
    def from_env(cls, env: dict[str, str]) -> Config:
        """From the VARIABLES that are set; others keep their default. All that is wrong is said at once."""
        given, wrong = {}, []
        for name, (setting, read) in VARIABLES.items():
            if env.get(name):
                try:
                    given[setting] = read(env[name])
                except ValueError as error:
                    wrong.append(f"{name}: {error}")
        out = cls(**given)
        try:
            out.country_code  # noqa: B018
        except ValueError as error:
            wrong.append(f"COUNTRY: {error}")
        if wrong:
            raise ValueError("; ".join(wrong))
        return out


@dataclass
class Extracted:
    surface_raw: DataFrame
    building: DataFrame
    surface: DataFrame


def source_pairs(model: dict[str, DataFrame], cfg: Config, lod: int, done: DataFrame | None = None) -> DataFrame:
    """(building_feature_id, surface_feature_id) by contact in space, for buildings that are not done yet, up to the limit."""
    solids = S.solids_of(model["feature"], model["geometry_data"], model["property"], lod)
    if done is not None:
        solids = R.unprocessed(solids, done, "feature_id", "building_feature_id")
    if cfg.building_limit > 0:
        solids = solids.join(R.limit_by_id(solids.select("feature_id").distinct(), "feature_id", cfg.building_limit), "feature_id", "left_semi")
    return S.assign_surfaces(S.surfaces_of(model["feature"], model["geometry_data"]), solids, cfg.cell)


def extract_features(model: dict[str, DataFrame], variants: DataFrame, cfg: Config, lod: int = 2, *, done: DataFrame | None = None, existing_surfaces: DataFrame | None = None) -> Extracted:
    """From source tables to faces, labelled buildings and resolved surfaces.

    done: buildings of earlier runs, which are skipped. The faces, which three consumers read, are written once.
    """
    child = FA.child_features(model["feature"], source_pairs(model, cfg, lod, done), model["geometry_data"], model["objectclass"], lod)
    raw = written(FA.face_attributes(FA.explode_faces(child), missing_ground_flip=cfg.missing_ground_flip), "surface-raw")
    own = B.storeys(B.volumes(B.aggregate_buildings(raw, cfg.country_code, cfg.room_height)))
    own = written(M.label_buildings(own, variants, int_division=cfg.int_division), "buildings")
    now = F.current_timestamp()
    return Extracted(raw, own.withColumns({"created_at": now, "updated_at": now}), R.resolved_surfaces(raw, existing_surfaces).withColumn("created_at", now))


def link_buildings(building: DataFrame, res: DataFrame, oth: DataFrame, cfg: Config, layer_srid: int = 3035) -> DataFrame:
    """building_link, computed in the layers' coordinate system."""
    own = S.reproject(building.where(F.col("building_footprint_geom").isNotNull()), "building_footprint_geom", cfg.srid_number, layer_srid)
    return S.link_footprints(own, res, oth, threshold=cfg.link_threshold, cell=cfg.cell, country=cfg.country_code, srid=layer_srid)


@dataclass
class Validated:
    """Long tables of a validation run, and the aggregates that its report shows."""

    buildings: DataFrame
    surfaces: DataFrame
    tables: dict[str, DataFrame]
    sentences: list[str]


def validate(building: DataFrame, surface_raw: DataFrame, prop: DataFrame, config: dict, links: DataFrame | None = None, *, failed: int = 0) -> Validated:
    """Computed attributes against the thematic ones that the configuration maps, with their errors and summaries."""
    labels = V.mapping(building.sparkSession, config)
    parent, child = labels.where("level = 'parent'"), labels.where("level <> 'parent'").dropDuplicates(["attribute_name", "source_label"])
    attributes = lambda df: sorted({r["attribute_name"] for r in df.select("attribute_name").distinct().collect()})  # noqa: E731  of the configuration
    own, faces = attributes(parent), attributes(child)
    buildings = written(V.validate_buildings(building, V.thematic_values(building, prop, parent, "building_feature_id"), own), "checked-buildings")
    surfaces = written(V.validate_surfaces(surface_raw, V.thematic_values(surface_raw, prop, child, "surface_feature_id"), faces), "checked-surfaces")
    tables = {
        "Building errors": V.error_summary(buildings), "Surface errors": V.error_summary(surfaces, "classname"), "Percentiles": V.error_percentiles(buildings), "Geometry quality": V.geometry_quality(surface_raw),
        "Area by validity": V.area_strata(surfaces), "Heights by attachment": V.height_by_attachment(buildings),
    }
    if links is not None:
        named = building.select("building_feature_id", "object_id").join(links.select("object_id", F.coalesce("source_layer", F.lit("none")).alias("match_source")), "object_id", "left")
        tables["Errors by match"] = V.error_breakdown(buildings.join(named.drop("object_id"), "building_feature_id", "left"))
    return Validated(buildings, surfaces, tables, V.takeaways(surfaces, buildings, failed))


#: What a run can do, in this order: name, and the tables that it writes.
STAGES = {
    "import": ("feature", "geometry_data", "property", "objectclass"), "archetypes": ("tabula", "tabula_variant"), "extract": ("surface_raw", "building", "surface", "pipeline_status"),
    "neighbours": ("building_neighbours", "building"), "link": ("building_link",), "validate": (),
}


class Workspace:
    """Tables of a warehouse folder: create, read, append, replace, reset by scope.

    Source and derived tables exist once for each level of detail, so that one level's run leaves another's alone.
    """

    SCOPES = {
        "source": ("feature", "geometry_data", "property", "objectclass"), "derived": ("surface_raw", "building", "surface", "building_neighbours", "building_link", "pipeline_status"),
        "supplementary": ("tabula", "tabula_variant"),
    }
    SCHEMAS = {
        "feature": schema.FEATURE, "geometry_data": schema.GEOMETRY_DATA, "property": schema.PROPERTY, "objectclass": schema.OBJECTCLASS, "surface_raw": schema.SURFACE_RAW, "building": schema.BUILDING,
        "surface": schema.SURFACE, "building_neighbours": schema.NEIGHBOURS, "building_link": schema.BUILDING_LINK, "pipeline_status": schema.PIPELINE_STATUS, "tabula": schema.TABULA, "tabula_variant": schema.TABULA_VARIANT,
    }
    SHARED = ("tabula", "tabula_variant", "building_link", "pipeline_status")

    def __init__(self, spark: SparkSession, database: str, lods: tuple[int, ...] = (2, 3)):
        self.spark, self.database, self.lods = spark, database, lods

    def name(self, table: str, lod: int = 2) -> str:
        return f"`{self.database}`.`{table if table in self.SHARED else f'lod{lod}_{table}'}`"

    def names(self, tables) -> list[tuple[str, str]]:
        """(table, full name) of the tables, of every level of detail."""
        return [(t, n) for t in tables for n in dict.fromkeys(self.name(t, lod) for lod in self.lods)]

    def create(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for table, name in self.names(self.SCHEMAS):
            if not self.spark.catalog.tableExists(name):
                self.spark.createDataFrame([], self.SCHEMAS[table]).write.format("parquet").saveAsTable(name)

    def reset(self, scope: str = "all") -> None:
        """Drop and create again the tables of a scope: all, source, derived or supplementary."""
        for _, name in self.names(self.SCHEMAS if scope == "all" else self.SCOPES[scope]):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.create()

    def read(self, table: str, lod: int = 2) -> DataFrame:
        return self.spark.table(self.name(table, lod))

    def model(self, lod: int = 2) -> dict[str, DataFrame]:
        return {name: self.read(name, lod) for name in self.SCOPES["source"]}

    def append(self, table: str, df: DataFrame, lod: int = 2) -> None:
        df.select(*self.SCHEMAS[table].names).write.insertInto(self.name(table, lod))

    def replace(self, table: str, df: DataFrame, lod: int = 2) -> None:
        """Overwrite a table with what may have been computed from it."""
        own = written(df.select(*self.SCHEMAS[table].names), table)
        own.write.insertInto(self.name(table, lod), overwrite=True)
        discard(own)

    def schemas(self, like: str = "lod") -> list[str]:
        """Databases that hold city models, by name: those whose name says so, and those with tables of a level of detail."""
        known = [d.name for d in self.spark.catalog.listDatabases()]
        return sorted(d for d in known if like in d or "city" in d or any(t.name.startswith(("lod2_", "lod3_")) for t in self.spark.catalog.listTables(d)))
