"""Query catalogue of the building operators: QUERIES by name and ORACLES, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import kernels, scalars
from ..functions.scalars import r2
from ..operators import buildings as B
from ..operators import corrections as C
from ..operators import faces as FA
from ..operators import matching as M
from ..operators import rows as R
from ..operators import spatial as S
from ..operators import validation as V
from ..operators.batched import with_kernel
from ..staging import written
from . import fixtures as X
from .fixtures import with_chain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

FACE_KEYS = ("building_feature_id", "surface_feature_id", "face_idx")


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


# --- pieces that several queries share ---


def _faces(s: SparkSession, d: str) -> DataFrame:
    return FA.explode_faces(X.child_features(s, d))


def _raw(s: SparkSession, d: str, validate: bool = False) -> DataFrame:
    return FA.face_attributes(_faces(s, d), validate=validate)


def _buildings(s: SparkSession, d: str) -> DataFrame:
    return B.storeys(B.volumes(B.aggregate_buildings(_raw(s, d))))


def _variants(s: SparkSession, d: str) -> DataFrame:
    return M.archetypes(X.tabula(s, d))


def _table(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


_SURFACE = "id * 20 + CASE WHEN slot = 7 AND id % 4 = 0 THEN 6 ELSE slot END AS surface_feature_id, CASE WHEN slot = 7 AND id % 4 = 0 THEN 1 ELSE 0 END AS face_idx"

# --- geometry ---


@query("newell_normals", with_chain("units", f"SELECT id AS building_feature_id, {_SURFACE}, round(px, 6) AS nx, round(py, 6) AS ny, round(pz, 6) AS nz FROM units"))
def newell_normals(s, d):
    return FA.normals(_faces(s, d)).select(*FACE_KEYS, *(F.round(F.col(f"newell.{c}"), 6).alias(f"n{c}") for c in "xyz"))


@query("vertex_edges", with_chain("edges", f"SELECT id AS building_feature_id, {_SURFACE}, CAST(ring_idx AS INTEGER) AS ring_idx, CAST(pt_idx AS INTEGER) AS pt_idx, x, y, z, next_x, next_y, next_z FROM edges"))
def vertex_edges(s, d):
    return FA.vertex_edges(FA.vertices(_faces(s, d), *FACE_KEYS), *FACE_KEYS)


@query("surface_area", with_chain("faces", "SELECT building_feature_id, surface_feature_id, face_idx, surface_area FROM faces"))
def surface_area(s, d):
    return FA.normals(_faces(s, d)).select(*FACE_KEYS, r2(G.surface_area(F.col("geom"), F.col("normal"))).alias("surface_area"))


@query("tilt_azimuth", with_chain("faces", "SELECT building_feature_id, surface_feature_id, face_idx, tilt, azimuth FROM faces"))
def tilt_azimuth(s, d):
    return _raw(s, d).select(*FACE_KEYS, "tilt", "azimuth")


@query("face_height", with_chain("points", f"SELECT id AS building_feature_id, {_SURFACE}, round(max(z) - min(z), 2) AS height FROM points GROUP BY id, slot"))
def face_height(s, d):
    return _faces(s, d).select(*FACE_KEYS, r2(G.height(F.col("geom"))).alias("height"))


@query("face_attributes", with_chain("faces", "SELECT building_feature_id, surface_feature_id, face_idx, classname, surface_area, tilt, azimuth, height, is_valid, is_planar FROM faces"))
def face_attributes(s, d):
    return _raw(s, d, validate=True).select(*FACE_KEYS, "classname", "surface_area", "tilt", "azimuth", "height", "is_valid", "is_planar")


@query("explode_multipolygon", with_chain("points", f"SELECT DISTINCT id AS building_feature_id, {_SURFACE}, classname, 3 AS coord_dim FROM points"))
def explode_multipolygon(s, d):
    return _faces(s, d).select(*FACE_KEYS, "classname", "coord_dim")


@query("polygon_area_2d", with_chain("rings", f"SELECT id AS building_feature_id, {_SURFACE}, round(sum(CASE WHEN ring_idx = 1 THEN 1 ELSE -1 END * abs(a2)), 2) AS area FROM rings GROUP BY id, slot"))
def polygon_area_2d(s, d):
    return _faces(s, d).select(*FACE_KEYS, r2(G.polygon_area_2d(F.col("geom"))).alias("area"))


@query("centroid_2d", with_chain("centroids", f"SELECT id AS building_feature_id, {_SURFACE}, round(cx, 6) AS cx, round(cy, 6) AS cy FROM centroids WHERE cx IS NOT NULL"))
def centroid_2d(s, d):
    own = _faces(s, d).withColumn("c", G.centroid_2d(F.array("geom")))
    return own.select(*FACE_KEYS, F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"))


@query("footprint_complexity", "SELECT p_partkey AS building_feature_id, CASE WHEN p_partkey % 19 = 0 AND p_partkey % 23 <> 0 THEN 10 ELSE 5 END AS points, 1 AS complexity FROM part WHERE p_partkey % 11 <> 0")
def footprint_complexity(s, d):
    own = B.footprint_union(B.rollup(_raw(s, d))).where(F.size("footprint") > 0).select("building_feature_id", G.points(F.col("footprint")).alias("points"))
    return own.withColumn("complexity", G.complexity(F.col("points")))


@query("footprint_union", with_chain("plots", "SELECT id AS building_feature_id, 1 AS polygons, round(w * d - CASE WHEN id % 19 = 0 AND id % 23 <> 0 THEN 4 ELSE 0 END, 2) AS area FROM plots WHERE id % 11 <> 0"))
def footprint_union(s, d):
    return B.footprint_union(B.rollup(_raw(s, d))).where(F.size("footprint") > 0).select("building_feature_id", F.size("footprint").alias("polygons"), r2(G.area_2d(F.col("footprint"))).alias("area"))


@query("interior_point", with_chain("plots", "SELECT id AS building_feature_id, x0 + CASE WHEN id % 23 = 0 THEN 0.75 * w ELSE w / 2 END AS x, y0 + d / 2 AS y FROM plots WHERE id % 11 <> 0"))
def interior_point(s, d):
    return FA.interior_points(_faces(s, d)).select("building_feature_id", "interior.x", "interior.y")


_KEYED = with_chain("points", f"SELECT DISTINCT id AS building_feature_id, {_SURFACE}, {{}} FROM points")


@query("face_validity", _KEYED.format("classname <> 'WallSurface' OR slot = 9 AS is_valid"))
def face_validity(s, d):
    return FA.with_checks(_faces(s, d)).select(*FACE_KEYS, "is_valid")


@query("face_planarity", _KEYED.format("slot <> 9 AS is_planar"))
def face_planarity(s, d):
    return FA.with_checks(_faces(s, d)).select(*FACE_KEYS, "is_planar")


@query("crs_transform", "SELECT p_partkey AS building_feature_id, true AS returned FROM part")
def crs_transform(s, d):
    """From UTM 32 to LAEA and back: within a tenth of a millimetre."""
    moved = X.footprints(s, d).withColumn("g", F.transform("building_footprint_geom", lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.struct((q["x"] + 450000).alias("x"), (q["y"] + 5400000).alias("y"), q["z"].alias("z"))))))
    there = S.reproject(S.reproject(moved.withColumn("h", F.col("g")), "h", 25832, 3035), "h", 3035, 25832)
    a, b = F.element_at(F.element_at(F.element_at("g", 1), 1), 3), F.element_at(F.element_at(F.element_at("h", 1), 1), 3)
    return there.select("building_feature_id", ((F.abs(a["x"] - b["x"]) < 1e-4) & (F.abs(a["y"] - b["y"]) < 1e-4)).alias("returned"))


@query("wkb_round_trip", "SELECT p_partkey AS building_feature_id, true AS same FROM part")
def wkb_round_trip(s, d):
    from ..sources import readers

    own = readers.with_wkb(X.footprints(s, d), "building_footprint_geom", 25832)
    back = readers.wkb_layer(own, "building_feature_id", "wkb")
    return own.join(back, "building_feature_id").select("building_feature_id", (F.col("geom") == F.col("building_footprint_geom")).alias("same"))


# --- buildings ---

_BUILT = "footprint_area, footprint_complexity, roof_complexity, area_total_roof, area_total_wall, {floor} AS area_total_floor, surface_count_roof, surface_count_wall, min_height, max_height, number_of_storeys"


@query("building_aggregate", with_chain("buildings", "SELECT building_feature_id, object_id, " + _BUILT.format(floor="area_total_floor0") + " FROM buildings"))
def building_aggregate(s, d):
    return B.aggregate_buildings(_raw(s, d)).select(
        "building_feature_id", "object_id", "footprint_area", "footprint_complexity", "roof_complexity", "area_total_roof", "area_total_wall", "area_total_floor", "surface_count_roof", "surface_count_wall", "min_height", "max_height", "number_of_storeys"
    )


@query("building_volume", with_chain("volumes", "SELECT building_feature_id, min_volume, max_volume FROM volumes"))
def building_volume(s, d):
    return B.volumes(B.aggregate_buildings(_raw(s, d))).select("building_feature_id", "min_volume", "max_volume")


@query("storeys_floor_area", with_chain("volumes", "SELECT building_feature_id, number_of_storeys, area_total_floor FROM volumes"))
def storeys_floor_area(s, d):
    return _buildings(s, d).select("building_feature_id", "number_of_storeys", "area_total_floor")


@query("tabula_extract", f"WITH {X.TABULA_CTE}, {X.VARIANTS_CTE} SELECT * FROM variants")
def tabula_extract(s, d):
    return _variants(s, d)


_ELIGIBLE_B = "footprint_area IS NOT NULL AND number_of_storeys IS NOT NULL AND area_total_roof IS NOT NULL AND area_total_wall IS NOT NULL AND area_total_floor IS NOT NULL"
_DIMS = ", ".join(M.DIMENSIONS)
_STATS = (
    X.TABULA_CTE, X.VARIANTS_CTE,
    f"both_sides AS (SELECT {_DIMS} FROM volumes WHERE {_ELIGIBLE_B} UNION ALL SELECT {_DIMS} FROM variants WHERE {_ELIGIBLE_B} AND max_volume IS NOT NULL)",
    "stats AS (SELECT " + ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in M.DIMENSIONS) + " FROM both_sides)",
)


def _match_sql(int_division: bool) -> tuple[str, ...]:
    div = lambda c: "//" if int_division and c in M.WHOLE else "/"
    norm = lambda t, c: f"coalesce(CAST(({t}.{c} - min_{c}) {div(c)} nullif(max_{c} - min_{c}, 0) AS DOUBLE), 0)"
    square = " + ".join(f"({norm('b', c)} - {norm('v', c)}) ** 2" for c in M.DIMENSIONS)
    return (
        *_STATS,
        f"""matched AS (SELECT building_feature_id, tabula_variant_code_id, tabula_variant_code, distance FROM (
  SELECT b.building_feature_id, v.tabula_variant_code_id, v.tabula_variant_code, sqrt({square}) AS distance FROM volumes b, variants v, stats WHERE {' AND '.join(f'b.{c} IS NOT NULL' for c in M.BUILDING_NEEDS)} AND {' AND '.join(f'v.{c} IS NOT NULL' for c in M.VARIANT_NEEDS)})
  QUALIFY row_number() OVER (PARTITION BY building_feature_id ORDER BY distance, tabula_variant_code_id) = 1)""",
    )


@query("feature_stats", with_chain("volumes", "SELECT * FROM stats", _STATS))
def feature_stats(s, d):
    return M.feature_stats(_buildings(s, d), _variants(s, d))


@query("variant_match", with_chain("volumes", "SELECT building_feature_id, tabula_variant_code_id, tabula_variant_code, round(distance, 6) AS distance FROM matched", _match_sql(True)))
def variant_match(s, d):
    return M.match_variants(_buildings(s, d), _variants(s, d)).withColumn("distance", F.round("distance", 6))


@query("match_documented_intent", with_chain("volumes", "SELECT building_feature_id, tabula_variant_code_id, tabula_variant_code, round(distance, 6) AS distance FROM matched", _match_sql(False)))
def match_documented_intent(s, d):
    return M.match_variants(_buildings(s, d), _variants(s, d), int_division=False).withColumn("distance", F.round("distance", 6))


@query("min_max_distance", with_chain("volumes", "SELECT building_feature_id, " + ", ".join(f"round(coalesce(CAST(({c} - min_{c}) {'//' if c in M.WHOLE else '/'} nullif(max_{c} - min_{c}, 0) AS DOUBLE), 0), 9) AS n_{c}" for c in M.DIMENSIONS) + f" FROM volumes, stats WHERE {_ELIGIBLE_B}", _STATS))
def min_max_distance(s, d):
    b, v = _buildings(s, d), _variants(s, d)
    one = M.feature_stats(b, v).select(F.struct("*").alias("stats"))
    scaled = M._eligible(b, M.BUILDING_NEEDS).crossJoin(F.broadcast(one))
    return scaled.select("building_feature_id", *(F.round(x, 9).alias(f"n_{c}") for c, x in zip(M.DIMENSIONS, M._normalised("stats", True), strict=True)))


_FLAG = "f.building_feature_id, f.object_id, f.footprint_area, f.footprint_complexity, f.roof_complexity, f.area_total_roof, f.area_total_wall, f.area_total_floor, f.min_height, f.max_height, f.min_volume, f.max_volume, f.number_of_storeys"


@query("building_features", with_chain("volumes", f"SELECT {_FLAG}, tabula_variant_code_id, tabula_variant_code FROM volumes f LEFT JOIN matched USING (building_feature_id)", _match_sql(True)))
def building_features(s, d):
    """The flagship: surfaces to labelled buildings."""
    return M.label_buildings(_buildings(s, d), _variants(s, d)).select(*(c.strip().removeprefix("f.") for c in _FLAG.split(",")), "tabula_variant_code_id", "tabula_variant_code")


# --- row sets ---

_PARTY = "(building_feature_id % 5 = 0 AND classname = 'WallSurface')"


def _party(df: DataFrame) -> DataFrame:
    flag = F.when((F.col("building_feature_id") % 5 == 0) & (F.col("classname") == FA.WALL), True).when(F.col("building_feature_id") % 5 == 1, False)
    return df.withColumn("is_party_wall", flag)


@query("resolve_surfaces", with_chain("faces", f"SELECT surface_feature_id, building_feature_id, classname AS surface_type, surface_area, tilt, azimuth, height FROM faces WHERE NOT {_PARTY} QUALIFY row_number() OVER (PARTITION BY surface_feature_id ORDER BY building_feature_id, face_idx) = 1"))
def resolve_surfaces(s, d):
    return R.resolved_surfaces(_party(_raw(s, d))).select("surface_feature_id", "building_feature_id", "surface_type", "surface_area", "tilt", "azimuth", "height")


@query("party_wall_filter", with_chain("faces", f"SELECT building_feature_id, surface_feature_id, face_idx FROM faces WHERE NOT {_PARTY}"))
def party_wall_filter(s, d):
    return _party(_raw(s, d)).where(~F.coalesce("is_party_wall", F.lit(False))).select(*FACE_KEYS)


@query("surface_dedup", "SELECT l_partkey AS surface, min(l_orderkey * 10 + l_linenumber) AS kept FROM lineitem GROUP BY l_partkey")
def surface_dedup(s, d):
    own = _table(s, d, "lineitem").select(F.col("l_partkey").alias("surface"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("kept"))
    return R.first_by(own, ["surface"], [F.col("kept")])


@query("unprocessed_ids", "SELECT p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45 AND l_partkey IS NOT NULL)")
def unprocessed_ids(s, d):
    done = _table(s, d, "lineitem").where("l_quantity > 45").select("l_partkey")
    return R.unprocessed(_table(s, d, "part").select(F.col("p_partkey").alias("id")), done, "id", "l_partkey")


@query("keyed_delete", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def keyed_delete(s, d):
    return R.keyed_delete(_table(s, d, "orders").select("o_orderkey"), _table(s, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("upsert", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer UNION ALL SELECT c_custkey + 10000000, c_acctbal * 2, 'NEW' FROM customer WHERE c_custkey % 3 = 1")
def upsert(s, d):
    old = _table(s, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    new = old.where("c_custkey % 3 < 2").selectExpr("if(c_custkey % 3 = 1, c_custkey + 10000000, c_custkey) as c_custkey", "c_acctbal * 2 as c_acctbal", "'NEW' as c_mktsegment")
    return R.upsert(old, new, "c_custkey", keep=("c_mktsegment",))


@query("insert_ignore", "SELECT s, min(k) AS k FROM (SELECT l_suppkey AS s, l_orderkey * 10 + l_linenumber AS k FROM lineitem) WHERE s % 2 = 1 GROUP BY s")
def insert_ignore(s, d):
    new = _table(s, d, "lineitem").selectExpr("l_suppkey as s", "l_orderkey * 10 + l_linenumber as k")
    existing = _table(s, d, "supplier").where("s_suppkey % 2 = 0").selectExpr("s_suppkey as s")
    return R.insert_ignore(new, existing, [("s",)], [F.col("k")])


@query("update_from", "SELECT c_custkey, CASE WHEN n IS NOT NULL THEN n::DOUBLE ELSE c_acctbal END AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey")
def update_from(s, d):
    counts = _table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").cast("double").alias("c_acctbal"))
    return R.update_from(_table(s, d, "customer").select("c_custkey", "c_acctbal"), counts, "c_custkey", ["c_acctbal"])


@query("building_limit", "SELECT p_partkey AS id FROM part ORDER BY p_partkey LIMIT 100")
def building_limit(s, d):
    return R.limit_by_id(_table(s, d, "part").select(F.col("p_partkey").alias("id")), "id", 100)


@query("building_ids", "SELECT p_partkey AS id FROM part WHERE 880 + p_size * 3 BETWEEN 900 AND 999")
def building_ids(s, d):
    return R.building_ids(_table(s, d, "part").selectExpr("p_partkey as id", "880 + p_size * 3 as objectclass_id"))


@query("building_classes", "SELECT DISTINCT 880 + p_size * 3 AS objectclass_id FROM part WHERE 880 + p_size * 3 BETWEEN 900 AND 999")
def building_classes(s, d):
    return R.building_classes(_table(s, d, "part").selectExpr("880 + p_size * 3 as objectclass_id"))


@query("id_batches", "SELECT p_partkey AS id, (row_number() OVER (ORDER BY p_partkey) - 1) // 64 AS batch FROM part")
def id_batches(s, d):
    return R.id_batches(_table(s, d, "part").select(F.col("p_partkey").alias("id")), "id", 64)


@query("sampled_eligible", "SELECT name AS attribute_name, feature_id FROM (SELECT DISTINCT name, feature_id FROM thematic_rows) QUALIFY row_number() OVER (PARTITION BY name ORDER BY (feature_id * 2654435761 + 7) % 4294967296, feature_id) <= 50".replace("thematic_rows", f"(WITH {X.PROPERTIES_CTE}, {X.THEMATIC_CTE} SELECT * FROM thematic WHERE v IS NOT NULL)"))
def sampled_eligible(s, d):
    prop = X.properties(s, d)
    own = prop.where(scalars.has_numeric(F.col("val_double"), F.col("val_int"), F.col("val_string"))).select(F.col("name").alias("attribute_name"), "feature_id").distinct()
    return V.sampled_eligible(own, "feature_id", 50, 7)


@query("row_changed", "SELECT o_orderkey, NOT (o_custkey % 5 <> 0 AND o_orderkey % 4 <> 0) AS changed FROM orders")
def row_changed(s, d):
    own = _table(s, d, "orders").selectExpr("o_orderkey", "struct(o_totalprice as p, nullif(o_custkey % 5, 0) as c) as old", "struct(if(o_orderkey % 4 = 0, o_totalprice + 1, o_totalprice) as p, o_custkey % 5 as c) as new")
    return own.select("o_orderkey", R.row_changed(["p", "c"], "old", "new").alias("changed"))


_NAMES = "'Austria', ' belgium', 'BULGARIA', 'Cyprus', 'Czechia', 'Czech Republic', 'denmark', 'Greece', 'hungary', 'Ireland', 'Italy', 'the netherlands', 'Netherlands', 'norway', 'poland', 'SERBIA', 'slovenia', 'Spain', 'sweden', 'united kingdom', 'united-kingdom'"
_CODES = "'AT', 'BE', 'BG', 'CY', 'CZ', NULL, 'DK', 'GR', 'HU', 'IE', 'IT', NULL, 'NL', 'NO', 'PL', 'RS', 'SI', 'ES', 'SE', 'GB', 'GB'"


@query("country_code", f"""SELECT n_nationkey, CASE n_name WHEN 'FRANCE' THEN 'FR' WHEN 'GERMANY' THEN 'DE' WHEN 'UNITED KINGDOM' THEN 'GB' END AS country_code FROM nation
  UNION ALL SELECT unnest(range(100, 121))::INTEGER, unnest([{_CODES}])""")
def country_code(s, d):
    """The nations' codes, and those of names as people write them."""
    more = s.range(1).selectExpr(f"posexplode(array({_NAMES})) as (n_nationkey, n_name)").selectExpr("n_nationkey + 100 as n_nationkey", "n_name")
    return _table(s, d, "nation").select("n_nationkey", "n_name").unionByName(more).select("n_nationkey", scalars.country_code(F.col("n_name")).alias("country_code"))


# --- spatial ---

_PAIRS = """pairs AS (SELECT a.id AS a, b.id AS b, sqrt(greatest(0, b.x0 - (a.x0 + a.w), a.x0 - (b.x0 + b.w)) ** 2 + greatest(0, b.y0 - (a.y0 + a.d), a.y0 - (b.y0 + b.d)) ** 2) AS distance
  FROM plots a JOIN plots b ON a.id < b.id AND abs(a.id - b.id) <= 42)"""


@query("neighbour_pairs", with_chain("plots", "SELECT a AS building_id_a, b AS building_id_b FROM pairs WHERE distance <= 0.5", (_PAIRS,)))
def neighbour_pairs(s, d):
    return S.neighbour_pairs(X.footprints(s, d), 0.5, cell=48.0)


@query("neighbour_flags", with_chain("plots", """SELECT id AS building_feature_id, coalesce(n, 0) > 0 AS has_attached_neighbour, ids AS attached_neighbour_ids, CAST(coalesce(n, 0) AS INTEGER) AS n_neighbours, CAST(least(coalesce(n, 0), 2) AS INTEGER) AS attached_neighbour_class
  FROM plots LEFT JOIN (SELECT k, count(*) AS n, string_agg(CAST(o AS VARCHAR), ',' ORDER BY o) AS ids FROM (SELECT a AS k, b AS o FROM pairs WHERE distance <= 2 UNION ALL SELECT b, a FROM pairs WHERE distance <= 2) GROUP BY k) ON id = k""", (_PAIRS,)))
def neighbour_flags(s, d):
    own = X.footprints(s, d)
    out = S.neighbour_flags(own, S.neighbour_pairs(own, 2.0, cell=48.0))
    return out.withColumn("attached_neighbour_ids", F.array_join(F.col("attached_neighbour_id").cast("array<string>"), ",")).withColumn("attached_neighbour_ids", F.when(F.col("n_neighbours") > 0, F.col("attached_neighbour_ids"))).drop("attached_neighbour_id")


@query("grid_batches", with_chain("plots", """SELECT cx, cy, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS building_ids FROM (
  SELECT id, cx, unnest(range(CAST(ceil(y0 / 50) AS BIGINT) - 1, CAST(floor((y0 + d) / 50) AS BIGINT) + 1)) AS cy FROM (SELECT *, unnest(range(CAST(ceil(x0 / 50) AS BIGINT) - 1, CAST(floor((x0 + w) / 50) AS BIGINT) + 1)) AS cx FROM plots)) GROUP BY cx, cy"""))
def grid_batches(s, d):
    return S.grid_cells(X.footprints(s, d), 50.0).select(F.col("cx").cast("long").alias("cx"), F.col("cy").cast("long").alias("cy"), F.array_join(F.col("building_ids").cast("array<string>"), ",").alias("building_ids"))


@query("surface_assignment", with_chain("plots", """SELECT b.id AS building_feature_id, a.id + 1000000 AS surface_feature_id FROM plots a JOIN plots b ON abs(a.id - b.id) <= 42
  AND a.x0 <= b.x0 + b.w AND b.x0 <= a.x0 + a.w AND a.y0 <= b.y0 + b.d AND b.y0 <= a.y0 + a.d"""))
def surface_assignment(s, d):
    """Every plot's ground against every plot's box."""
    own = X.footprints(s, d)
    ground = own.select((F.col("building_feature_id") + 1000000).alias("feature_id"), F.col("building_footprint_geom").alias("geometry"))
    ring = F.element_at(F.element_at("building_footprint_geom", 1), 1)
    side = lambda i: F.array(F.array(*(F.struct(F.element_at(ring, k)["x"].alias("x"), F.element_at(ring, k)["y"].alias("y"), F.lit(z).alias("z")) for k, z in ((i, 0.0), (i + 1, 0.0), (i + 1, 3.0), (i, 3.0), (i, 0.0)))))
    walls = F.array(*(side(i) for i in range(1, 5)))
    shell = F.concat("building_footprint_geom", F.flatten(F.transform(walls, lambda w: F.array(w))))
    return S.assign_surfaces(ground, own.select(F.col("building_feature_id").alias("feature_id"), shell.alias("geometry")), cell=48.0)


_LAYERS = """cand AS (SELECT a.id, b.layer, b.layer || b.id AS osm_id, greatest(0, least(a.x0 + a.w, b.x0 + b.s + b.w) - greatest(a.x0, b.x0 + b.s)) * greatest(0, least(a.y0 + a.d, b.y0 + b.d) - greatest(a.y0, b.y0)) / least(a.w * a.d, b.w * b.d) AS confidence
  FROM plots a JOIN (SELECT *, CAST(id % 5 AS DOUBLE) AS s, unnest(CASE WHEN id % 15 = 0 THEN ['R', 'O'] WHEN id % 3 = 0 THEN ['R'] WHEN id % 3 = 1 THEN ['O'] ELSE [] END) AS layer FROM plots) b
  ON abs(a.id - b.id) <= 42 AND a.x0 <= b.x0 + b.s + b.w AND b.x0 + b.s <= a.x0 + a.w AND a.y0 <= b.y0 + b.d AND b.y0 <= a.y0 + a.d)"""
_BEST = "best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY id, layer ORDER BY confidence DESC NULLS FIRST, osm_id) = 1)"
_LINKED = """linked AS (SELECT 'B' || plots.id AS object_id, osm_id, CAST(CASE WHEN osm_id IS NULL THEN 2 ELSE 1 END AS SMALLINT) AS match_type, round(confidence, 6) AS match_confidence, CASE layer WHEN 'R' THEN 'res' WHEN 'O' THEN 'oth' END AS source_layer
  FROM plots LEFT JOIN (SELECT * FROM best WHERE confidence >= 0.5 QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE layer WHEN 'R' THEN 0 ELSE 1 END) = 1) b ON plots.id = b.id)"""


def _layers(s: SparkSession, d: str) -> DataFrame:
    res, oth = X.layers(s, d)
    return res.withColumn("source_layer", F.lit("res")).unionByName(oth.withColumn("source_layer", F.lit("oth")))


@query("link_candidates", with_chain("plots", "SELECT 'B' || id AS object_id, osm_id, CASE layer WHEN 'R' THEN 'res' ELSE 'oth' END AS source_layer, round(confidence, 6) AS confidence FROM cand", (_LAYERS,)))
def link_candidates(s, d):
    return S.link_candidates(X.footprints(s, d), _layers(s, d), cell=48.0).withColumn("confidence", F.round("confidence", 6))


@query("best_candidate", with_chain("plots", "SELECT 'B' || id AS object_id, osm_id, CASE layer WHEN 'R' THEN 'res' ELSE 'oth' END AS source_layer, round(confidence, 6) AS confidence FROM best", (_LAYERS, _BEST)))
def best_candidate(s, d):
    return S.best_candidates(S.link_candidates(X.footprints(s, d), _layers(s, d), cell=48.0)).withColumn("confidence", F.round("confidence", 6))


@query("link_priority", with_chain("plots", "SELECT object_id, osm_id, match_type, source_layer FROM linked", (_LAYERS, _BEST, _LINKED)))
def link_priority(s, d):
    own = X.footprints(s, d)
    return S.link_priority(own, S.best_candidates(S.link_candidates(own, _layers(s, d), cell=48.0))).drop("match_confidence")


@query("footprint_link", with_chain("plots", "SELECT * FROM linked", (_LAYERS, _BEST, _LINKED)))
def footprint_link(s, d):
    out = S.link_footprints(X.footprints(s, d), *X.layers(s, d), cell=48.0, country="DE", srid=25832)
    return out.select("object_id", "osm_id", "match_type", F.round("match_confidence", 6).alias("match_confidence"), "source_layer")


@query("linked_buildings", with_chain("plots", "SELECT object_id, osm_id, source_layer FROM linked WHERE match_type = 1", (_LAYERS, _BEST, _LINKED)))
def linked_buildings(s, d):
    own = X.footprints(s, d)
    return own.select("object_id").join(S.link_footprints(own, *X.layers(s, d), cell=48.0).where("match_type = 1"), "object_id").select("object_id", "osm_id", "source_layer")


# --- corrections ---

_EDITED = "EXISTS (SELECT 1 FROM customer WHERE c_custkey = building_feature_id AND c_custkey % 3 = {})"


def _edits(s: SparkSession, d: str, kind: int) -> DataFrame:
    return _table(s, d, "customer").where(f"c_custkey % 3 = {kind}").select(F.col("c_custkey").alias("building_feature_id"))


@query("corr_footprint", with_chain("volumes", f"""SELECT building_feature_id, CASE WHEN e THEN 100.0 ELSE footprint_area END::DOUBLE AS footprint_area, CASE WHEN e THEN 1 ELSE footprint_complexity END AS footprint_complexity,
  CASE WHEN e THEN round(min_height * 100, 2) ELSE min_volume END AS min_volume, CASE WHEN e THEN round(max_height * 100, 2) ELSE max_volume END AS max_volume, CASE WHEN e THEN round(100.0 * number_of_storeys, 2) ELSE area_total_floor END::DOUBLE AS area_total_floor
  FROM (SELECT *, {_EDITED.format(0)} AS e FROM volumes)"""))
def corr_footprint(s, d):
    square = "array(array(array({})))".format(", ".join(f"named_struct('x', {x}D, 'y', {y}D, 'z', 0D)" for x, y in ((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))))
    out = C.footprint_correction(_buildings(s, d), _edits(s, d, 0).withColumn("new_footprint", F.expr(square)))
    return out.select("building_feature_id", "footprint_area", "footprint_complexity", "min_volume", "max_volume", "area_total_floor")


@query("corr_room_height", with_chain("volumes", f"""SELECT building_feature_id, n AS number_of_storeys, CASE WHEN n <> number_of_storeys THEN round(min_height / n, 2) WHEN e THEN 3.0 ELSE 2.5 END::DOUBLE AS room_height,
  CASE WHEN n <> number_of_storeys THEN round(footprint_area * n, 2) ELSE area_total_floor END AS area_total_floor
  FROM (SELECT *, CASE WHEN e THEN CAST(round_even(min_height / 3.0, 0) AS INTEGER) ELSE number_of_storeys END AS n FROM (SELECT *, {_EDITED.format(1)} AS e FROM volumes))"""))
def corr_room_height(s, d):
    out = C.room_height_correction(_buildings(s, d), _edits(s, d, 1).withColumn("new_room_height", F.lit(3.0)))
    return out.select("building_feature_id", "number_of_storeys", "room_height", "area_total_floor")


@query("corr_storeys", with_chain("volumes", f"""SELECT building_feature_id, CASE WHEN e THEN 3 ELSE number_of_storeys END AS number_of_storeys, CASE WHEN e AND number_of_storeys <> 3 THEN round(min_height / 3, 2) ELSE 2.5 END::DOUBLE AS room_height,
  CASE WHEN e THEN round(footprint_area * 3, 2) ELSE area_total_floor END AS area_total_floor FROM (SELECT *, {_EDITED.format(2)} AS e FROM volumes)"""))
def corr_storeys(s, d):
    out = C.storeys_correction(_buildings(s, d), _edits(s, d, 2).withColumn("new_storeys", F.lit(3)))
    return out.select("building_feature_id", "number_of_storeys", "room_height", "area_total_floor")


_AFTER = f"""volumes0 AS (SELECT * FROM volumes), after_edit AS (SELECT * EXCLUDE (number_of_storeys, area_total_floor), CASE WHEN {_EDITED.format(2)} THEN 3 ELSE number_of_storeys END AS number_of_storeys,
  CASE WHEN {_EDITED.format(2)} THEN round(footprint_area * 3, 2) ELSE area_total_floor END AS area_total_floor FROM volumes)"""
_REMATCH = tuple(c.replace("FROM volumes", "FROM after_edit") for c in _match_sql(True)[len(_STATS) - 2 :])


@query("corr_rematch", with_chain("volumes", """SELECT a.building_feature_id, CASE WHEN a.number_of_storeys IS DISTINCT FROM v.number_of_storeys OR a.area_total_floor IS DISTINCT FROM v.area_total_floor THEN tabula_variant_code_id ELSE 0 END AS tabula_variant_code_id
  FROM after_edit a JOIN volumes v USING (building_feature_id) LEFT JOIN matched USING (building_feature_id)""", (_AFTER, X.TABULA_CTE, X.VARIANTS_CTE, *_REMATCH)))
def corr_rematch(s, d):
    """Only rows whose dimensions changed get a new label; the others keep theirs, here 0."""
    before = _buildings(s, d).withColumn("tabula_variant_code_id", F.lit(0))
    after = C.storeys_correction(before, _edits(s, d, 2).withColumn("new_storeys", F.lit(3)))
    changed = after.join(before.select("building_feature_id", F.col("number_of_storeys").alias("n0"), F.col("area_total_floor").alias("a0")), "building_feature_id")
    changed = changed.withColumn("tabula_variant_code_id", F.when(F.col("number_of_storeys").eqNullSafe(F.col("n0")) & F.col("area_total_floor").eqNullSafe(F.col("a0")), F.lit(0)))
    return C.rematch(before, changed.drop("n0", "a0"), _variants(s, d)).select("building_feature_id", "tabula_variant_code_id")


# --- validation ---

_LABELS = [("area", "footprint_area"), ("height", "min_height"), ("height", "max_height")]
_SURFACE_LABELS = [("tilt", "tilt"), ("azimuth", "azimuth"), ("area", "surface_area")]


def _label_table(s: SparkSession, labels: list[tuple[str, str]]) -> DataFrame:
    return s.createDataFrame(labels, "source_label string, attribute_name string")


def _checked_buildings(s: SparkSession, d: str) -> DataFrame:
    """Long table of buildings against thematic values, attached where the id says so."""
    own = written(_buildings(s, d).select("building_feature_id", (F.col("building_feature_id") % 2 == 0).alias("has_attached_neighbour"), "footprint_area", "min_height", "max_height"), "measured-buildings")
    prop = X.properties(s, d).withColumnRenamed("feature_id", "id").withColumnRenamed("id", "feature_id")
    return V.validate_buildings(own, V.thematic_values(own, prop, _label_table(s, _LABELS), "building_feature_id"), ["footprint_area", "min_height", "max_height"])


def _checked_surfaces(s: SparkSession, d: str) -> DataFrame:
    """Long table of surfaces; a surface's thematic values are those of the part with its number, twentyfold."""
    own = written(_raw(s, d, validate=True).select(*FACE_KEYS, "classname", "is_valid", "is_planar", "surface_area", "tilt", "azimuth"), "measured-surfaces")  # read for its ids and for its measures
    prop = X.properties(s, d).withColumn("feature_id", F.col("feature_id") * 20 + 2)
    return V.validate_surfaces(own, V.thematic_values(own, prop, _label_table(s, _SURFACE_LABELS), "surface_feature_id"), ["surface_area", "tilt", "azimuth"])


_THEMATIC = (X.PROPERTIES_CTE, X.THEMATIC_CTE)
_CHECKED_B = (
    *_THEMATIC,
    "labels0 AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _LABELS) + ") t(source_label, attribute_name))",
    """checked AS (SELECT building_feature_id, has_attached_neighbour, attribute_name, calculated_value, v AS thematic_value, calculated_value - v AS difference, CASE WHEN v <> 0 THEN 100.0 * (calculated_value - v) / v END AS percent_error FROM (
  SELECT building_feature_id, building_feature_id % 2 = 0 AS has_attached_neighbour, 'footprint_area' AS attribute_name, footprint_area AS calculated_value FROM volumes
  UNION ALL SELECT building_feature_id, building_feature_id % 2 = 0, 'min_height', min_height FROM volumes UNION ALL SELECT building_feature_id, building_feature_id % 2 = 0, 'max_height', max_height FROM volumes)
  JOIN labels0 USING (attribute_name) JOIN thematic ON feature_id = building_feature_id AND name = source_label WHERE v IS NOT NULL)""",
)
_CHECKED_S = (
    *_THEMATIC,
    "labels0 AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _SURFACE_LABELS) + ") t(source_label, attribute_name))",
    """first_faces AS (SELECT * FROM faces QUALIFY row_number() OVER (PARTITION BY surface_feature_id ORDER BY building_feature_id, face_idx) = 1)""",
    """paired AS (SELECT surface_feature_id, classname, is_valid, is_planar, attribute_name, calculated_value, v AS thematic_value FROM (
  SELECT surface_feature_id, classname, is_valid, is_planar, 'surface_area' AS attribute_name, surface_area AS calculated_value FROM first_faces
  UNION ALL SELECT surface_feature_id, classname, is_valid, is_planar, 'tilt', tilt FROM first_faces UNION ALL SELECT surface_feature_id, classname, is_valid, is_planar, 'azimuth', azimuth FROM first_faces)
  JOIN labels0 USING (attribute_name) JOIN thematic ON feature_id * 20 + 2 = surface_feature_id AND name = source_label WHERE v IS NOT NULL)""",
    """checked AS (SELECT *, CASE WHEN attribute_name = 'azimuth' THEN fmod(fmod(calculated_value - thematic_value + 180, 360) + 360, 360) - 180 ELSE calculated_value - thematic_value END AS difference,
  CASE WHEN attribute_name <> 'azimuth' AND thematic_value <> 0 THEN 100.0 * (calculated_value - thematic_value) / thematic_value END AS percent_error FROM paired WHERE attribute_name <> 'azimuth' OR (calculated_value <> -1 AND thematic_value <> -1))""",
)


@query("numeric_coalesce", f"WITH {X.PROPERTIES_CTE}, {X.THEMATIC_CTE} SELECT feature_id, name, v AS value FROM thematic")
def numeric_coalesce(s, d):
    return X.properties(s, d).select("feature_id", "name", scalars.numeric(F.col("val_double"), F.col("val_int"), F.col("val_string")).alias("value"))


@query("thematic_values", "WITH " + ", ".join(_CHECKED_B[:3]) + " SELECT feature_id AS building_feature_id, attribute_name, v AS thematic_value FROM thematic JOIN labels0 ON name = source_label WHERE v IS NOT NULL AND feature_id % 2 = 0")
def thematic_values(s, d):
    own = _table(s, d, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("building_feature_id"))
    return V.thematic_values(own, X.properties(s, d), _label_table(s, _LABELS), "building_feature_id")


@query("validate_buildings", with_chain("volumes", "SELECT building_feature_id, attribute_name, calculated_value, thematic_value, has_attached_neighbour, round(difference, 4) AS difference, round(percent_error, 4) AS percent_error FROM checked", _CHECKED_B))
def validate_buildings(s, d):
    return _checked_buildings(s, d).select("building_feature_id", "attribute_name", "calculated_value", "thematic_value", "has_attached_neighbour", F.round("difference", 4).alias("difference"), F.round("percent_error", 4).alias("percent_error"))


@query("validate_surfaces", with_chain("faces", "SELECT surface_feature_id, classname, is_valid, is_planar, attribute_name, calculated_value, thematic_value, round(difference, 4) AS difference, round(percent_error, 4) AS percent_error FROM checked", _CHECKED_S))
def validate_surfaces(s, d):
    return _checked_surfaces(s, d).select("surface_feature_id", "classname", "is_valid", "is_planar", "attribute_name", "calculated_value", "thematic_value", F.round("difference", 4).alias("difference"), F.round("percent_error", 4).alias("percent_error"))


@query("plot_errors", with_chain("faces", """SELECT surface_feature_id, attribute_name, thematic_value, round(CASE WHEN attribute_name = 'azimuth' THEN abs(fmod(fmod(calculated_value - thematic_value + 180, 360) + 360, 360) - 180) ELSE calculated_value - thematic_value END, 4) AS error,
  round(CASE WHEN attribute_name NOT IN ('tilt', 'azimuth') THEN 100.0 * (calculated_value - thematic_value) / (thematic_value + 1e-6) END, 4) AS error_percent FROM checked""", _CHECKED_S))
def plot_errors(s, d):
    return V.plot_errors(_checked_surfaces(s, d)).select("surface_feature_id", "attribute_name", "thematic_value", F.round("error", 4).alias("error"), F.round("error_percent", 4).alias("error_percent"))


_SUMMARY = """attribute_name{by}, count(*) AS n, round(avg(difference), 4) AS mean_difference, round(stddev_samp(difference), 4) AS std_difference, round(sqrt(avg(difference * difference)), 4) AS rmse,
  round(avg(percent_error), 4) AS mean_percent, round(median(percent_error), 4) AS median_percent, round(stddev_samp(percent_error), 4) AS std_percent FROM checked GROUP BY attribute_name{by}"""


@query("error_summary", with_chain("volumes", "SELECT " + _SUMMARY.format(by=""), _CHECKED_B))
def error_summary(s, d):
    return V.error_summary(_checked_buildings(s, d))


@query("error_breakdown", with_chain("volumes", "SELECT attribute_name, has_attached_neighbour, count(*) AS n, round(sqrt(avg(difference * difference)), 4) AS rmse, round(avg(difference), 4) AS mean_difference FROM checked GROUP BY ALL", _CHECKED_B))
def error_breakdown(s, d):
    return V.error_breakdown(_checked_buildings(s, d), "has_attached_neighbour")


@query("geometry_quality", with_chain("faces", "SELECT classname, count(*) AS total, count(*) FILTER (NOT is_valid) AS invalid, round(100.0 * count(*) FILTER (NOT is_valid) / count(*), 2) AS invalid_percent, count(*) FILTER (NOT is_planar) AS non_planar, round(100.0 * count(*) FILTER (NOT is_planar) / count(*), 2) AS non_planar_percent FROM faces GROUP BY classname"))
def geometry_quality(s, d):
    return V.geometry_quality(_raw(s, d, validate=True))


@query("descriptive_stats", f"WITH {', '.join(_THEMATIC)} SELECT name AS attribute_name, count(*) AS n, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS least, max(v) AS most FROM thematic WHERE v IS NOT NULL GROUP BY name")
def descriptive_stats(s, d):
    return V.descriptive_stats(numeric_coalesce(s, d).select(F.col("name").alias("attribute_name"), F.col("value").alias("thematic_value")))


@query("problematic_surfaces", with_chain("faces", "SELECT surface_feature_id, attribute_name, thematic_value, round(difference, 4) AS difference FROM checked WHERE abs(percent_error) > 10 OR abs(difference) > 170", _CHECKED_S))
def problematic_surfaces(s, d):
    return V.problematic(_checked_surfaces(s, d)).select("surface_feature_id", "attribute_name", "thematic_value", F.round("difference", 4).alias("difference"))


@query("error_percentiles", with_chain("volumes", """SELECT attribute_name, round(quantile_cont(abs(difference), 0.05), 4) AS p5, round(quantile_cont(abs(difference), 0.25), 4) AS p25, round(quantile_cont(abs(difference), 0.75), 4) AS p75, round(quantile_cont(abs(difference), 0.95), 4) AS p95,
  round(100.0 * count(*) FILTER (abs(difference) > rmse) / count(*), 2) AS tail_percent FROM checked JOIN (SELECT attribute_name, sqrt(avg(difference * difference)) AS rmse FROM checked GROUP BY attribute_name) USING (attribute_name) GROUP BY attribute_name""", _CHECKED_B))
def error_percentiles(s, d):
    return V.error_percentiles(_checked_buildings(s, d))


@query("rmse_stratified", with_chain("faces", """SELECT attribute_name, round(g, 4) AS rmse_good, round(b, 4) AS rmse_bad, round(b / nullif(g, 0), 4) AS ratio FROM (
  SELECT attribute_name, sqrt(avg(difference * difference) FILTER (is_valid AND is_planar)) AS g, sqrt(avg(difference * difference) FILTER (NOT (is_valid AND is_planar))) AS b FROM checked GROUP BY attribute_name)""", _CHECKED_S))
def rmse_stratified(s, d):
    return V.rmse_stratified(_checked_surfaces(s, d))


@query("height_by_attachment", with_chain("volumes", """SELECT attribute_name, round(sqrt(avg(difference * difference)), 4) AS rmse_all, round(sqrt(avg(difference * difference) FILTER (NOT has_attached_neighbour)), 4) AS rmse_detached,
  round(sqrt(avg(difference * difference) FILTER (has_attached_neighbour)), 4) AS rmse_attached FROM checked WHERE attribute_name IN ('min_height', 'max_height') GROUP BY attribute_name""", _CHECKED_B))
def height_by_attachment(s, d):
    return V.height_by_attachment(_checked_buildings(s, d))


@query("throughput", with_chain("faces", "SELECT classname, count(*) AS n, round(count(*) / 8.0, 2) AS per_second FROM faces GROUP BY classname"))
def throughput(s, d):
    return V.throughput(_raw(s, d), 8.0)


@query("r_squared", with_chain("volumes", """SELECT attribute_name, round(CASE WHEN tot = 0 THEN 0 ELSE 1 - res / tot END, 4) AS r_squared, rmse, mean, median, std FROM (
  SELECT attribute_name, sum(difference * difference) AS res, sum((thematic_value - m) ** 2) AS tot, round(sqrt(avg(difference * difference)), 4) AS rmse, round(avg(difference), 4) AS mean, round(median(difference), 4) AS median, round(stddev_samp(difference), 4) AS std
  FROM checked JOIN (SELECT attribute_name, avg(thematic_value) AS m FROM checked GROUP BY attribute_name) USING (attribute_name) GROUP BY attribute_name)""", _CHECKED_B))
def r_squared(s, d):
    return V.r_squared(_checked_buildings(s, d))


@query("error_histogram", with_chain("volumes", """SELECT attribute_name, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((difference - lo) / nullif(hi - lo, 0) * 30), 29) END AS INTEGER) AS bin, count(*) AS n
  FROM checked JOIN (SELECT attribute_name, min(difference) AS lo, max(difference) AS hi FROM checked GROUP BY attribute_name) USING (attribute_name) GROUP BY ALL""", _CHECKED_B))
def error_histogram(s, d):
    return V.error_histogram(_checked_buildings(s, d))
