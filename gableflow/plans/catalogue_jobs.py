"""More of the query catalogue: import, jobs, workspace, configuration, reports and single kernels."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import geometry as G
from ..functions import kernels, scalars
from ..functions.scalars import r2
from ..operators import corrections as C
from ..operators import faces as FA
from ..operators import spatial as S
from ..operators import validation as V
from ..operators.batched import with_kernel
from ..operators.faces import row_id
from ..sources import readers
from ..staging import shared_dir, written
from . import cli, templates
from . import fixtures as X
from .catalogue import _CHECKED_B, _CHECKED_S, _KEYED, _PAIRS, _SURFACE, FACE_KEYS, _buildings, _checked_buildings, _checked_surfaces, _faces, _raw, _table, query
from .fixtures import with_chain
from .pipeline import STAGES, Config, Workspace, extract_features, source_pairs

# --- import ---

_BOX_CTE = """boxes AS (SELECT id, x0, y0, w, d, h FROM plots),
box_faces AS (SELECT id, 1 AS n, 710 AS objectclass_id, x0, x0 + w AS x1, y0, y0 + d AS y1, 0.0::DOUBLE AS z0, 0.0::DOUBLE AS z1 FROM boxes
  UNION ALL SELECT id, 2, 712, x0, x0 + w, y0, y0 + d, h, h FROM boxes
  UNION ALL SELECT id, 3, 709, x0, x0 + w, y0, y0, 0, h FROM boxes UNION ALL SELECT id, 4, 709, x0 + w, x0 + w, y0, y0 + d, 0, h FROM boxes
  UNION ALL SELECT id, 5, 709, x0, x0 + w, y0 + d, y0 + d, 0, h FROM boxes UNION ALL SELECT id, 6, 709, x0, x0, y0, y0 + d, 0, h FROM boxes)"""


def _imported(s: SparkSession, d: str) -> dict[str, DataFrame]:
    """Boxes written as CityJSON sequences, half metres as integers, and read again."""
    own = X.plots(s, d)
    whole = lambda e: f"cast(({e}) * 2 as bigint)"
    corners = ", ".join(f"array({whole(x)}, {whole(y)}, {whole(z)})" for z in ("0", "h") for x, y in (("x0", "y0"), ("x0 + w", "y0"), ("x0 + w", "y0 + d"), ("x0", "y0 + d")))
    kinds = ["GroundSurface", "RoofSurface", *["WallSurface"] * 4]
    meaning = ",".join(f'{{"type":"{k}"}}' for k in kinds)
    solid = f'{{"type":"Solid","lod":"2.0","boundaries":[[[[3,2,1,0]],[[4,5,6,7]],[[0,1,5,4]],[[1,2,6,5]],[[2,3,7,6]],[[3,0,4,7]]]],"semantics":{{"surfaces":[{meaning}],"values":[[0,1,2,3,4,5]]}}}}'
    line = F.concat(F.lit('{"type":"CityJSONFeature","vertices":'), F.to_json(F.expr(f"array({corners})")), F.lit(',"CityObjects":{"B'), F.col("id"), F.lit('":{"type":"Building","attributes":{"measuredHeight":'), F.col("h"), F.lit('},"geometry":[' + solid + "]}}}"))
    head = '{"type":"CityJSON","transform":{"scale":[0.5,0.5,0.5],"translate":[0.0,0.0,0.0]}}'
    folder = f"{shared_dir(s)}/city-{uuid.uuid4().hex}"
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0  # of a task's rows: every task writes a sequence of its own, which begins with the transform
    lines = own.select(F.when(first, F.concat(F.lit(head + "\n"), line)).otherwise(line).alias("value"))
    s.createDataFrame([(head,)], "value string").coalesce(1).unionByName(lines).write.text(f"{folder}/txt")
    place = s._jvm.org.apache.hadoop.fs.Path(f"{folder}/txt")
    fs = place.getFileSystem(s._jsparkSession.sessionState().newHadoopConf())
    for i, part in enumerate(f.getPath() for f in fs.listStatus(place) if f.getPath().getName().startswith("part")):
        fs.rename(part, s._jvm.org.apache.hadoop.fs.Path(f"{folder}/city{i}.jsonl"))
    fs.delete(place, True)
    return {name: written(df, name) for name, df in readers.city_model(s, folder).items()} | {"objectclass": readers.objectclass(s)}  # as an import does


@query("cityjson_import", with_chain("plots", """SELECT 'B' || id AS objectid, 901 AS objectclass_id, NULL::DOUBLE AS area, NULL::DOUBLE AS height FROM boxes
  UNION ALL SELECT 'B' || id || '_' || n, objectclass_id, (x1 - x0) * (y1 - y0), z1 - z0 FROM box_faces""", (_BOX_CTE,)))
def cityjson_import(s, d):
    model = _imported(s, d)
    geometry = model["geometry_data"].select(F.col("feature_id").alias("id"), G.area_2d(F.col("geometry")).alias("area"), G.height(F.flatten("geometry")).alias("height"))
    own = model["feature"].join(geometry, "id", "left")
    surface = lambda c: F.when(F.col("objectclass_id") != 901, F.col(c))
    return own.select("objectid", "objectclass_id", surface("area").alias("area"), surface("height").alias("height"))


@query("building_solids", with_chain("plots", "SELECT 'B' || id AS objectid, 6 AS faces, h AS height FROM boxes", (_BOX_CTE,)))
def building_solids(s, d):
    """Features with their geometry and the property that marks a solid."""
    model = _imported(s, d)
    own = S.solids_of(model["feature"], model["geometry_data"], model["property"])
    return own.join(model["feature"].select(F.col("id").alias("feature_id"), "objectid"), "feature_id").select("objectid", F.size("geometry").alias("faces"), G.height(F.flatten("geometry")).alias("height"))


_CONTACT = """contact AS (SELECT b.id AS building, f.id AS own, f.n, f.objectclass_id, f.x1 - f.x0 AS dx, f.y1 - f.y0 AS dy, f.z1 - f.z0 AS dz FROM box_faces f JOIN boxes b ON abs(f.id - b.id) <= 42
  AND f.x0 <= b.x0 + b.w AND b.x0 <= f.x1 AND f.y0 <= b.y0 + b.d AND b.y0 <= f.y1 AND f.z0 <= b.h AND 0 <= f.z1)"""


@query("contact_in_space", with_chain("plots", "SELECT 'B' || building AS building, 'B' || own || '_' || n AS surface, CASE objectclass_id WHEN 709 THEN 'WallSurface' WHEN 710 THEN 'GroundSurface' ELSE 'RoofSurface' END AS classname FROM contact", (_BOX_CTE, _CONTACT)))
def contact_in_space(s, d):
    """Surfaces that touch a building's solid, other buildings' among them, and never another building's solid."""
    model = _imported(s, d)
    child = FA.child_features(model["feature"], source_pairs(model, Config(), 2), model["geometry_data"], model["objectclass"])
    return child.select(F.col("building_objectid").alias("building"), F.col("surface_objectid").alias("surface"), "classname")


@query("extract_features", with_chain("plots", """SELECT 'B' || building AS object_id, round(sum(CASE WHEN objectclass_id = 710 THEN dx * dy END), 2) AS footprint_area, round(sum(CASE WHEN objectclass_id = 712 THEN dx * dy ELSE 0 END), 2) AS area_total_roof,
  round(sum(CASE WHEN objectclass_id = 709 THEN greatest(dx, dy) * dz ELSE 0 END), 2) AS area_total_wall, CAST(count(*) FILTER (objectclass_id = 712) AS INTEGER) AS surface_count_roof, CAST(count(*) FILTER (objectclass_id = 709) AS INTEGER) AS surface_count_wall,
  max(dz) FILTER (objectclass_id = 709) AS min_height, CAST(round_even(max(dz) FILTER (objectclass_id = 709) / 2.5, 0) AS INTEGER) AS number_of_storeys, 'DE' AS country_code FROM contact GROUP BY building""", (_BOX_CTE, _CONTACT)))
def extract(s, d):
    """The whole job: contact in space, faces with validity and planarity, roll-up, labels."""
    out = extract_features(_imported(s, d), s.createDataFrame([], schema.TABULA_VARIANT), Config())
    return out.building.select("object_id", "footprint_area", "area_total_roof", "area_total_wall", "surface_count_roof", "surface_count_wall", "min_height", "number_of_storeys", "country_code")


@query("archetype_csv", f"WITH {X.TABULA_CTE} SELECT id, Code_BuildingVariant AS code, Year1_Building AS year, CAST(V_C AS DOUBLE) AS volume, CAST(A_Roof_2 AS DOUBLE) AS roof_2 FROM tabula")
def archetype_csv(s, d):
    folder = f"{shared_dir(s)}/sheets-{uuid.uuid4().hex}"
    X.tabula(s, d).select(*schema.TABULA.names).write.option("header", True).csv(f"{folder}/austria.csv")
    own = readers.archetype_sheet(s, folder, "austria")
    return own.select("id", F.col("Code_BuildingVariant").alias("code"), F.col("Year1_Building").alias("year"), F.col("V_C").cast("double").alias("volume"), F.col("A_Roof_2").cast("double").alias("roof_2"))


# --- workspace, configuration, command line ---


@query("workspace_tables", with_chain("plots", "SELECT a AS building_id_a, b AS building_id_b FROM pairs WHERE distance <= 0.5", (_PAIRS,)))
def workspace_tables(s, d):
    """Created, filled by insert-select, overwritten from itself, and read again."""
    own = Workspace(s, f"gableflow_lod_{uuid.uuid4().hex[:8]}", (2,))
    own.create()
    own.append("building_neighbours", S.neighbour_pairs(X.footprints(s, d), 0.5, cell=48.0))
    own.replace("building_neighbours", own.read("building_neighbours"))
    out = own.read("building_neighbours")
    out = written(out, "neighbours")
    s.sql(f"DROP DATABASE `{own.database}` CASCADE")
    return out


@query("schema_listing", "SELECT unnest(['building', 'building_neighbours', 'feature', 'geometry_data', 'objectclass', 'property', 'surface', 'surface_raw']) AS tablename, unnest([2, 3]) AS lod WHERE false UNION ALL SELECT t, l FROM (SELECT unnest(['building', 'building_neighbours', 'feature', 'geometry_data', 'objectclass', 'property', 'surface', 'surface_raw']) AS t) CROSS JOIN (SELECT unnest([2, 3]) AS l)")
def schema_listing(s, d):
    """Tables of a database with city models, as the listing finds them."""
    own = Workspace(s, f"gableflow_lod_{uuid.uuid4().hex[:8]}")
    own.create()
    found = [t.name for name in own.schemas() if name == own.database for t in s.catalog.listTables(name)]
    s.sql(f"DROP DATABASE `{own.database}` CASCADE")
    return s.createDataFrame([(n[5:], int(n[3])) for n in found if n.startswith("lod")], "tablename string, lod int")


@query("derived_columns", """SELECT * FROM (VALUES ('surface', 'is_valid'), ('surface', 'is_planar'), ('surface', 'is_party_wall'), ('surface', 'neighbour_building_id'), ('surface', 'created_at'), ('building', 'total_attached_neighbour'), ('building', 'comment'),
  ('building', 'min_height_unit'), ('building', 'max_volume_unit'), ('building', 'area_total_roof_unit'), ('surface_raw', 'child_row_id'), ('surface_raw', 'attribute_calc_status'), ('surface_raw', 'neighbour_building_id')) t(tablename, columnname)""")
def derived_columns(s, d):
    asked = {"surface": ("is_valid", "is_planar", "is_party_wall", "neighbour_building_id", "created_at"), "building": ("total_attached_neighbour", "comment", "min_height_unit", "max_volume_unit", "area_total_roof_unit"), "surface_raw": ("child_row_id", "attribute_calc_status", "neighbour_building_id")}
    return s.createDataFrame([(t, c) for t, names in asked.items() for c in Workspace.SCHEMAS[t].names if c in names], "tablename string, columnname string")


@query("unit_columns", "SELECT p_partkey AS building_feature_id, 'm' AS min_height_unit, 'cbm' AS max_volume_unit, 'sqm' AS area_total_floor_unit FROM part")
def unit_columns(s, d):
    return _buildings(s, d).select("building_feature_id", "min_height_unit", "max_volume_unit", "area_total_floor_unit")


@query("srid_parse", "SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 25800 + n_nationkey WHEN 1 THEN 25800 + n_nationkey WHEN 2 THEN NULL ELSE NULL END AS srid FROM nation")
def srid_parse(s, d):
    text = F.expr("CASE n_nationkey % 4 WHEN 0 THEN concat('EPSG:', 25800 + n_nationkey) WHEN 1 THEN concat(' epsg:', 25800 + n_nationkey, ' ') WHEN 2 THEN 'EPSG:x' ELSE '0' END")
    return _table(s, d, "nation").select("n_nationkey", scalars.srid(text).alias("srid"))


@query("template_sql", "SELECT p_partkey AS id FROM part WHERE p_partkey IN (3, 5, 8)")
def template_sql(s, d):
    """One statement with ids and one without, which finds nothing."""
    statement = "SELECT p_partkey AS id FROM {part} WHERE p_partkey IN {ids} AND {column} > 0"
    own = _table(s, d, "part")
    some = templates.run(s, statement, {"part": own}, ids=[3, 5, 8], column="p_partkey")
    return some.unionByName(templates.run(s, statement, {"part": own}, ids=[], column="p_partkey"))


@query("stage_registry", "SELECT * FROM (VALUES (1, 'import', 4), (2, 'archetypes', 2), (3, 'extract', 4), (4, 'neighbours', 2), (5, 'link', 1), (6, 'validate', 0)) t(position, stage, tables_written)")
def stage_registry(s, d):
    return s.createDataFrame([(i, name, len(tables)) for i, (name, tables) in enumerate(STAGES.items(), 1)], "position int, stage string, tables_written int")


@query("config_from_env", "SELECT 'AT' AS country_code, 31256 AS srid, '2,3' AS lods, 2.8::DOUBLE AS room_height, 40 AS building_limit, 500.0::DOUBLE AS link_grid_size, 1000 AS batch_size")
def config_from_env(s, d):
    own = Config.from_env({"COUNTRY": "Austria", "SRID": "EPSG:31256", "LODS": "2,3", "ROOM_HEIGHT": "2.8", "BUILDING_LIMIT": "40", "LINK_GRID_SIZE": "500"})
    return s.createDataFrame([(own.country_code, own.srid_number, ",".join(map(str, own.lods)), own.room_height, own.building_limit, own.link_grid_size, own.batch_size)], "country_code string, srid int, lods string, room_height double, building_limit int, link_grid_size double, batch_size int")


@query("command_flags", "SELECT unnest(['create-db', 'database', 'extract-features', 'flag-neighbours', 'import-archetypes', 'import-limit', 'import-model', 'link', 'lod', 'output', 'reset-db', 'validate']) AS flag")
def command_flags(s, d):
    flags = {o.removeprefix("--") for a in cli.parser()._actions for o in a.option_strings if o.startswith("--")} - {"help"}
    return s.createDataFrame([(f,) for f in sorted(flags)], "flag string")


@query("config_mapping", "SELECT * FROM (VALUES ('parent', 'min_height', 'height', 'm'), ('parent', 'max_height', 'height', 'm'), ('parent', 'footprint_area', 'area', 'sqm'), ('child.roof', 'surface_area', 'area', 'sqm')) t(level, attribute_name, source_label, unit)")
def config_mapping(s, d):
    config = {"attributes": {
        "parent": {"h": {"computed_columns": ["min_height", "max_height"], "source_label": "height", "unit": "m"}, "f": {"computed_column": "footprint_area", "source_label": "area", "unit": "sqm"}, "none": {"computed_column": "x", "source_label": ""}},
        "child": {"roof": {"a": {"computed_column": "surface_area", "source_label": "area", "unit": "sqm"}}, "wall": None},
    }}
    return V.mapping(s, config)


# --- kernels ---


@query("max_pairwise_distance", with_chain("points", f"SELECT a.id AS building_feature_id, {_SURFACE.replace('id * 20', 'a.id * 20').replace('slot', 'a.slot').replace('AND id', 'AND a.id')}, round(max(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)), 6) AS distance FROM points a JOIN points b ON a.id = b.id AND a.slot = b.slot AND a.ring_idx = 1 AND b.ring_idx = 1 GROUP BY a.id, a.slot"))
def max_pairwise_distance(s, d):
    return _faces(s, d).select(*FACE_KEYS, F.round(G.max_distance_2d(F.element_at("geom", 1)), 6).alias("distance"))


@query("rotated_area", with_chain("units", f"SELECT id AS building_feature_id, {_SURFACE}, round(m / 2, 2) AS area FROM units"))
def rotated_area(s, d):
    """The exterior turned until it lies flat, and its area there."""
    own = FA.normals(_faces(s, d))
    turned = G.rotated(F.element_at("geom", 1), F.col("normal.x"), F.col("normal.y"), F.col("normal.z"))
    return own.select(*FACE_KEYS, r2(G.ring_area_2d(turned)).alias("area"))


@query("collapse_test", _KEYED.format("classname = 'WallSurface' AND slot <> 9 AS collapses"))
def collapse_test(s, d):
    return _faces(s, d).select(*FACE_KEYS, G.collapses_2d(F.element_at("geom", 1)).alias("collapses"))


@query("envelope", with_chain("plots", "SELECT id AS building_feature_id, x0 AS xmin, y0 AS ymin, x0 + w AS xmax, y0 + d AS ymax, w * d AS area FROM plots"))
def envelope(s, d):
    """The bounding rectangle of a triangle over half the plot, and of its far corner."""
    own = X.footprints(s, d)
    ring = F.element_at(F.element_at("building_footprint_geom", 1), 1)
    triangle = F.array(F.array(F.concat(F.slice(ring, 1, 3), F.slice(ring, 1, 1))))
    box = own.withColumn("e", G.envelope(triangle))
    e = F.element_at(F.element_at(F.element_at("e", 1), 1), 1)
    far = F.element_at(F.element_at(F.element_at("e", 1), 1), 3)
    return box.select("building_feature_id", e["x"].alias("xmin"), e["y"].alias("ymin"), far["x"].alias("xmax"), far["y"].alias("ymax"), G.area_2d(F.col("e")).alias("area"))


@query("union_of_overlaps", "SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 100.0 WHEN 1 THEN 150.0 ELSE 200.0 END::DOUBLE AS area, 1 AS polygons FROM part")
def union_of_overlaps(s, d):
    """Two squares of 100: the same twice, overlapping by half, or side by side; either way round."""
    from ..operators.buildings import footprint_union

    square = lambda x: "array(array(" + ", ".join(f"named_struct('x', {x} + {a}D, 'y', {b}D, 'z', 0D)" for a, b in ((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))) + "))"
    own = _table(s, d, "part").selectExpr("p_partkey as id", f"{square('0')} as a", f"{square('cast((p_partkey % 3) * 5 as double)')} as b")
    turned = F.when(F.col("id") % 2 == 0, F.transform("b", lambda r: F.reverse(r))).otherwise(F.col("b"))
    out = footprint_union(own.select("id", F.array(F.flatten(F.array("a")), F.flatten(F.array(turned))).alias("ground")))
    return out.select("id", r2(G.area_2d(F.col("footprint"))).alias("area"), F.size("footprint").alias("polygons"))


@query("same_outline", "SELECT p_partkey AS id, p_partkey % 3 <> 2 AS same FROM part")
def same_outline(s, d):
    """A plot against itself with a point more on an edge, turned round, or with a corner moved."""
    own = X.footprints(s, d).withColumn("ring", F.element_at(F.element_at("building_footprint_geom", 1), 1))
    a, b = F.element_at("ring", 1), F.element_at("ring", 2)
    middle = F.struct(((a["x"] + b["x"]) / 2).alias("x"), ((a["y"] + b["y"]) / 2).alias("y"), F.lit(0.0).alias("z"))
    more = F.concat(F.slice("ring", 1, 1), F.array(middle), F.slice("ring", 2, 4))
    moved = F.transform("ring", lambda p, i: F.struct((p["x"] + F.when(i == 2, 1.0).otherwise(0.0)).alias("x"), p["y"].alias("y"), p["z"].alias("z")))
    other = F.when(F.col("building_feature_id") % 3 == 0, more).when(F.col("building_feature_id") % 3 == 1, F.reverse("ring")).otherwise(moved)
    return own.select(F.col("building_feature_id").alias("id"), G.same_outline(F.array(F.array(other)), F.col("building_footprint_geom")).alias("same"))


_E2 = "0.006694380022903416"
_Q = f"(1 - {_E2}) * (sin({{p}}) / (1 - {_E2} * sin({{p}}) ** 2) - ln((1 - sqrt({_E2}) * sin({{p}})) / (1 + sqrt({_E2}) * sin({{p}}))) / (2 * sqrt({_E2})))"


@query("crs_forward", f"""WITH g AS (SELECT p_partkey AS id, radians(6 + (p_partkey % 61) * 0.1) AS lam, radians(47 + (p_partkey % 79) * 0.1) AS phi FROM part UNION ALL SELECT -1, radians(5.0), radians(50.0)),
k AS (SELECT {_Q.format(p='pi() / 2')} AS qp, asin(({_Q.format(p='radians(52.0)')}) / ({_Q.format(p='pi() / 2')})) AS b0, 6378137.0::DOUBLE AS a, (1 / 298.257222101) / (2 - 1 / 298.257222101) AS n),
l AS (SELECT g.*, k.*, a * sqrt(qp / 2) AS rq, asin(({_Q.format(p='phi')}) / qp) AS beta, lam - radians(10.0) AS dl FROM g, k),
m AS (SELECT *, a * cos(radians(52.0)) / sqrt(1 - {_E2} * sin(radians(52.0)) ** 2) / (rq * cos(b0)) AS dd, rq * sqrt(2 / (1 + sin(b0) * sin(beta) + cos(b0) * cos(beta) * cos(dl))) AS b, sinh(atanh(sin(phi)) - sqrt({_E2}) * atanh(sqrt({_E2}) * sin(phi))) AS t, lam - radians(9.0) AS d9 FROM l),
u AS (SELECT *, atan2(t, cos(d9)) AS xi, atanh(sin(d9) / sqrt(1 + t * t)) AS eta, a / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) AS ra, n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180 AS a1, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440 AS a2, 61 * n ** 3 / 240 - 103 * n ** 4 / 140 AS a3, 49561 * n ** 4 / 161280 AS a4 FROM m)
SELECT id, CASE WHEN id = -1 THEN 3962799.5 ELSE round(4321000 + b * dd * cos(beta) * sin(dl), 1) END AS e, CASE WHEN id = -1 THEN 2999718.9 ELSE round(3210000 + b / dd * (cos(b0) * sin(beta) - sin(b0) * cos(beta) * cos(dl)), 1) END AS n,
  round(500000 + 0.9996 * ra * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta) + a4 * cos(8 * xi) * sinh(8 * eta)), 2) AS x,
  round(0.9996 * ra * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta) + a4 * sin(8 * xi) * cosh(8 * eta)), 2) AS y FROM u""")
def crs_forward(s, d):
    """Longitudes and latitudes into LAEA Europe and UTM 32; row -1 is the published test point of LAEA Europe."""
    from pyspark.sql import types as T

    own = _table(s, d, "part").selectExpr("p_partkey as id", "radians(6 + (p_partkey % 61) * 0.1D) as lam", "radians(47 + (p_partkey % 79) * 0.1D) as phi").unionByName(s.range(1).selectExpr("-1L as id", "radians(5D) as lam", "radians(50D) as phi"))
    kind = T.StructType([T.StructField(c, T.DoubleType()) for c in "enxy"])
    out = with_kernel(own, "c", kind, lambda lam, phi: dict(zip("enxy", (*kernels.from_lonlat(lam, phi, 3035), *kernels.from_lonlat(lam, phi, 25832)), strict=True)), "lam", "phi")
    return out.select("id", F.round("c.e", 1).alias("e"), F.round("c.n", 1).alias("n"), F.round("c.x", 2).alias("x"), F.round("c.y", 2).alias("y"))


# --- rows, neighbours, reports ---


@query("row_ids", with_chain("points", f"SELECT building_feature_id, surface_feature_id, sha256('2:' || building_feature_id || ':' || surface_feature_id) AS id FROM (SELECT DISTINCT id AS building_feature_id, {_SURFACE.split(', CASE')[0]} FROM points)"))
def row_ids(s, d):
    own = X.child_features(s, d).select(F.lit(2).alias("lod"), "building_feature_id", "surface_feature_id")
    return own.select("building_feature_id", "surface_feature_id", row_id("lod", "building_feature_id", "surface_feature_id").alias("id"))


@query("touch_updated", "SELECT o_orderkey AS building_feature_id, o_orderkey % 4 = 0 OR o_orderkey % 5 = 0 AS moved FROM orders")
def touch_updated(s, d):
    """updated_at moves where a row differs in anything else, from and to null too."""
    stamp = F.lit("2001-01-01").cast("timestamp")
    before = _table(s, d, "orders").select(F.col("o_orderkey").alias("building_feature_id"), "o_totalprice", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("c"), stamp.alias("created_at"), stamp.alias("updated_at"))
    after = before.withColumn("o_totalprice", F.when(F.col("building_feature_id") % 4 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).withColumn("c", F.coalesce("c", F.lit(0)))
    return C.touched(before, after).select("building_feature_id", ((F.col("updated_at") > stamp) & (F.col("created_at") == stamp)).alias("moved"))


@query("neighbour_job", with_chain("plots", """SELECT id AS building_feature_id, coalesce(n, 0) > 0 AS has_attached_neighbour, CAST(coalesce(n, 0) AS INTEGER) AS total_attached_neighbour, CAST(least(coalesce(n, 0), 2) AS INTEGER) AS attached_neighbour_class
  FROM plots LEFT JOIN (SELECT k, count(*) AS n FROM (SELECT a AS k FROM pairs WHERE distance <= 2 UNION ALL SELECT b FROM pairs WHERE distance <= 2) GROUP BY k) ON id = k""", (_PAIRS,)))
def neighbour_job(s, d):
    """Old flags are overwritten."""
    own = X.footprints(s, d).withColumns({"has_attached_neighbour": F.lit(True), "attached_neighbour_id": F.array(F.lit(7).cast("bigint")), "total_attached_neighbour": F.lit(9), "attached_neighbour_class": F.lit(-1)})
    return S.flag_neighbours(own, 2.0, cell=48.0).select("building_feature_id", "has_attached_neighbour", "total_attached_neighbour", "attached_neighbour_class")


@query("grid_batches_limited", with_chain("plots", """SELECT count(*) AS cells, sum(n)::BIGINT AS members, max(last) AS last FROM (SELECT cx, cy, count(*) AS n, max(id) AS last FROM (
  SELECT id, cx, unnest(range(CAST(ceil(y0 / 50) AS BIGINT) - 1, CAST(floor((y0 + d) / 50) AS BIGINT) + 1)) AS cy FROM (SELECT *, unnest(range(CAST(ceil(x0 / 50) AS BIGINT) - 1, CAST(floor((x0 + w) / 50) AS BIGINT) + 1)) AS cx FROM (SELECT * FROM plots ORDER BY id LIMIT 60))) GROUP BY cx, cy)"""))
def grid_batches_limited(s, d):
    own = S.grid_cells(X.footprints(s, d), 50.0, limit=60)
    return own.agg(F.count("*").alias("cells"), F.sum(F.size("building_ids")).cast("bigint").alias("members"), F.max(F.array_max("building_ids")).alias("last"))


@query("large_boxes", with_chain("plots", "SELECT l.id AS l, r.id AS r FROM plots l JOIN plots r ON abs(l.id - r.id) > 0 AND l.id % 50 = 1 AND l.x0 <= r.x0 + r.w AND r.x0 <= l.x0 + 5000 AND l.y0 <= r.y0 + r.d AND r.y0 <= l.y0 + 30"))
def large_boxes(s, d):
    """Strips of 5 km against plots: boxes of very different sizes meet on a coarser grid."""
    own = X.footprints(s, d)
    corner = F.element_at(F.element_at(F.element_at("building_footprint_geom", 1), 1), 1)
    at = lambda dx, dy: F.struct((corner["x"] + dx).alias("x"), (corner["y"] + dy).alias("y"), F.lit(0.0).alias("z"))
    strip = F.array(F.array(F.array(at(0, 0), at(5000, 0), at(5000, 30), at(0, 30), at(0, 0))))
    left = own.where("building_feature_id % 50 = 1").select(F.col("building_feature_id").alias("l"), strip.alias("l_geom"))
    return S.box_pairs(left, own.select(F.col("building_feature_id").alias("r"), F.col("building_footprint_geom").alias("r_geom")), cell=12.0, order="!=")


@query("batch_statuses", "SELECT count(*) AS total, count(*) FILTER (o_orderkey % 5 > 1) AS retried, count(*) FILTER (o_orderstatus = 'F') AS failed FROM orders")
def batch_statuses(s, d):
    return V.batch_statuses(_table(s, d, "orders").selectExpr("if(o_orderstatus = 'F', element_at(array('Failed', 'error', 'FAIL'), cast(o_orderkey % 3 + 1 as int)), 'done') as status", "if(o_orderkey % 5 > 1, '2', if(o_orderkey % 5 = 1, null, '0')) as retries"))


@query("batch_lines", "SELECT count(*) FILTER (o_orderkey % 4 = 0) AS total, count(*) FILTER (o_orderkey % 4 = 1) AS succeeded, count(*) FILTER (o_orderkey % 4 = 2) AS retried, count(*) FILTER (o_orderkey % 4 = 3 AND o_custkey % 2 = 0) AS failed FROM orders")
def batch_lines(s, d):
    line = "CASE o_orderkey % 4 WHEN 0 THEN 'Batch 7 STARTED' WHEN 1 THEN 'batch 7 is done' WHEN 2 THEN 'Retrying step' ELSE if(o_custkey % 2 = 0, 'batch 7 FAILED', 'disk failed') END as value"
    return V.batch_lines(_table(s, d, "orders").selectExpr(line))


@query("latest_run", "SELECT max('validation_' || strftime(o_orderdate, '%Y%m%d')) AS run FROM orders")
def latest_run(s, d):
    names = _table(s, d, "orders").select(F.concat(F.lit("validation_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("run")).unionByName(s.createDataFrame([("zz_other",)], "run string"))
    return V.latest_of(names, "run")


_RULES = """SELECT 'A' AS rule, value, coalesce(value > 100, false) AS fires FROM (SELECT round(sqrt(avg(difference ** 2) FILTER (NOT (is_valid AND is_planar))) / nullif(sqrt(avg(difference ** 2) FILTER (is_valid AND is_planar)), 0), 4) AS value FROM checked_s WHERE classname = 'WallSurface' AND attribute_name = 'surface_area')
UNION ALL SELECT 'B', value, coalesce(value > 1, false) FROM (SELECT round(avg(difference), 4) AS value FROM checked WHERE attribute_name = 'max_height')
UNION ALL SELECT 'C', value, coalesce(value > 0.8, false) FROM (SELECT round(avg(CASE WHEN is_planar THEN 0.0 ELSE 1.0 END), 4) AS value FROM checked_s WHERE classname = 'RoofSurface' AND attribute_name = 'surface_area')
UNION ALL SELECT 'D', 2.0, true
UNION ALL SELECT 'E', value, value = 0 FROM (SELECT max(CASE WHEN has_attached_neighbour THEN 1.0 ELSE 0.0 END)::DOUBLE AS value FROM checked)"""
_BOTH = (*(c.replace("checked AS", "checked_s AS", 1) if c.startswith("checked AS") else c for c in _CHECKED_S), *(c.replace("labels0", "labels1") for c in _CHECKED_B[2:]))


@query("takeaways", with_chain("volumes", _RULES, _BOTH))
def takeaways(s, d):
    """The five rules over the long tables."""
    out = V.takeaway_rules(written(_checked_surfaces(s, d), "checked-surfaces"), written(_checked_buildings(s, d), "checked-buildings"), failed=2)
    return out.select("rule", F.round("value", 4).alias("value"), "fires")


@query("report_table", with_chain("faces", "SELECT '| classname | n |' AS line UNION ALL SELECT '| --- | --- |' UNION ALL SELECT '| ' || classname || ' | ' || count(*) || ' |' FROM faces GROUP BY classname"))
def report_table(s, d):
    """A small result as Markdown, a row for each line."""
    own = _raw(s, d).groupBy("classname").agg(F.count("*").alias("n"))
    return s.createDataFrame([(line,) for line in V.markdown_table(own).split("\n")], "line string")


@query("csv_round_trip", with_chain("faces", "SELECT surface_feature_id, classname, surface_area FROM faces"))
def csv_round_trip(s, d):
    """An export written as CSV, and read again."""
    path = f"{shared_dir(s)}/export-{uuid.uuid4().hex}.csv"
    V.csv_sink(_raw(s, d).select("surface_feature_id", "classname", "surface_area"), path)
    return s.read.csv(path, header=True, schema="surface_feature_id bigint, classname string, surface_area double")


@query("sql_functions", with_chain("plots", """SELECT id, w * d - w * d / 4 AS overlap, 0.0::DOUBLE AS distance, true AS meets, true AS valid, CAST(round_even(h / 2.5, 0) AS INTEGER) AS storeys, 'AT' AS code, 1 AS complexity, CASE WHEN id % 2 = 0 THEN 3.5 END::DOUBLE AS number, -20.0::DOUBLE AS turn FROM plots"""))
def sql_functions(s, d):
    """The registered functions in a statement: a plot against itself shifted by a quarter of its width."""
    from ..functions import sql as names

    names.register(s)
    own = X.footprints(s, d).join(X.plots(s, d), F.col("building_feature_id") == F.col("id"))
    shifted = F.transform("building_footprint_geom", lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.struct((q["x"] + F.col("w") / 4).alias("x"), q["y"].alias("y"), q["z"].alias("z")))))
    own = own.select("id", "h", F.col("building_footprint_geom").alias("a"), shifted.alias("b"))
    return s.sql(
        "SELECT id, overlap_area(a, b) AS overlap, distance_2d(a, b) AS distance, intersects_2d(a, b) AS meets, face_is_valid(a[0]) AS valid, half_even(h / 2.5D) AS storeys, country_code(' Austria') AS code, "
        "outline_complexity(size(a[0][0])) AS complexity, numeric_value(null, null, if(id % 2 = 0, '3.5', 'x')) AS number, circular_difference(350D, 10D) AS turn FROM {own}", own=own,
    )
