"""Synthetic city models derived from the star-schema tables, with the same arithmetic for Spark and for DuckDB.

Coordinates are integers and halves, so both engines agree bit for bit. One building stands for each part; a face is a
template of corner expressions that are valid SQL in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUND, WALL, ROOF = "GroundSurface", "WallSurface", "RoofSurface"
CLASS_IDS = {GROUND: 710, WALL: 709, ROOF: 712}

#: Building parameters by name, in terms of part's columns.
PARAMETERS = {
    "w": "cast(6 + p_size % 7 as double)", "d": "cast(8 + p_partkey % 5 as double)", "h": "cast(3 as double) + (p_partkey % 4) * cast(2.5 as double)", "r": "cast(p_partkey % 3 as double)",
    "x0": "cast((p_partkey % 20) * 12 as double)", "y0": "cast(floor(p_partkey / 20) as double) * 12",
}


def _ring(*corners: str) -> list[tuple[str, str, str]]:
    pts = [tuple(c.split(",")) for c in corners]
    return [*pts, pts[0]]


_X, _Y, _M = "x0+w", "y0+d", "x0+w/2"
#: (slot, class, condition, rings): corners as "x,y,z".
FACES = [
    (0, GROUND, "id % 11 <> 0 and id % 23 <> 0 and id % 19 <> 0", [_ring("x0,y0,0", f"{_X},y0,0", f"{_X},{_Y},0", f"x0,{_Y},0")]),
    (0, GROUND, "id % 11 <> 0 and id % 23 <> 0 and id % 19 = 0", [_ring("x0,y0,0", f"{_X},y0,0", f"{_X},{_Y},0", f"x0,{_Y},0"), _ring("x0+2,y0+2,0", "x0+2,y0+4,0", "x0+4,y0+4,0", "x0+4,y0+2,0")]),
    (0, GROUND, "id % 11 <> 0 and id % 23 = 0", [_ring("x0,y0,0", f"{_M},y0,0", f"{_M},{_Y},0", f"x0,{_Y},0")]),
    (1, GROUND, "id % 11 <> 0 and id % 23 = 0", [_ring(f"{_M},y0,0", f"{_X},y0,0", f"{_X},{_Y},0", f"{_M},{_Y},0")]),
    (2, WALL, "r = 0", [_ring("x0,y0,0", f"{_X},y0,0", f"{_X},y0,h", "x0,y0,h")]),
    (2, WALL, "r > 0", [_ring("x0,y0,0", f"{_X},y0,0", f"{_X},y0,h", f"{_M},y0,h+r", "x0,y0,h")]),
    (3, WALL, "r = 0", [_ring(f"{_X},{_Y},0", f"x0,{_Y},0", f"x0,{_Y},h", f"{_X},{_Y},h")]),
    (3, WALL, "r > 0", [_ring(f"{_X},{_Y},0", f"x0,{_Y},0", f"x0,{_Y},h", f"{_M},{_Y},h+r", f"{_X},{_Y},h")]),
    (4, WALL, "true", [_ring(f"x0,{_Y},0", "x0,y0,0", "x0,y0,h", f"x0,{_Y},h")]),
    (5, WALL, "true", [_ring(f"{_X},y0,0", f"{_X},{_Y},0", f"{_X},{_Y},h", f"{_X},y0,h")]),
    (6, ROOF, "r = 0", [_ring("x0,y0,h", f"{_X},y0,h", f"{_X},{_Y},h", f"x0,{_Y},h")]),
    (6, ROOF, "r > 0", [_ring("x0,y0,h", f"{_M},y0,h+r", f"{_M},{_Y},h+r", f"x0,{_Y},h")]),
    (7, ROOF, "r > 0", [_ring(f"{_M},y0,h+r", f"{_X},y0,h", f"{_X},{_Y},h", f"{_M},{_Y},h+r")]),
    (8, WALL, "id % 13 = 0", [_ring("x0,y0,0", "x0+1,y0,0", "x0+2,y0,0")]),
    (9, WALL, "id % 17 = 0", [_ring("x0,y0,0", f"{_X},y0,0", f"{_X},y0,h", "x0,y0+1,h")]),
]


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Plots in one task: their table is small, and what is made of it is not.
PLOTS_A_TASK = 8_192


def plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, w, d, h, r, x0, y0), dealt by id over tasks of a bounded size, so that what is grouped by id later stays where it is."""
    part = _load(spark, sf_dir, "part")
    own = part.selectExpr("p_partkey as id", *(f"{e} as {k}" for k, e in PARAMETERS.items()))
    return own.repartition(1 + part.count() // PLOTS_A_TASK, "id")


def _point(corner: tuple[str, str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{c}', cast({e} as double)" for c, e in zip("xyz", corner, strict=True)) + ")"


def _polygon(rings) -> str:
    own = ["array(" + ", ".join(map(_point, ring)) + ")" for ring in rings]
    return "array(" + ", ".join(f"if(id % 2 = 1, reverse({r}), {r})" for r in own) + ")"


def child_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surfaces that already know their building; the two faces of some gable roofs are one multipolygon."""
    faces = [f"named_struct('slot', {slot}, 'classname', '{name}', 'here', {when}, 'geom', {_polygon(rings)})" for slot, name, when, rings in FACES]
    own = plots(spark, sf_dir).selectExpr("id", f"filter(array({', '.join(faces)}), f -> f.here) as faces")
    # every plot has faces; of an inner explode, a filter on them would move below the dealing of plots() and make them in the scan's few tasks
    own = own.select("id", F.explode_outer("faces").alias("f")).select("id", F.expr("if(f.slot = 7 and id % 4 = 0, 6, f.slot)").alias("slot"), "f.classname", F.struct("f.slot", "f.geom").alias("part"))
    own = own.groupBy("id", "slot", "classname").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    class_id = F.create_map(*(F.lit(x) for kv in CLASS_IDS.items() for x in kv))
    return own.select(
        F.concat_ws(":", "id", "slot").alias("id"), F.lit(2).alias("lod"), F.col("id").alias("building_feature_id"), (F.col("id") * 20 + F.col("slot")).alias("surface_feature_id"),
        F.concat(F.lit("B"), F.col("id")).alias("building_objectid"), F.concat(F.lit("S"), F.col("id") * 20 + F.col("slot")).alias("surface_objectid"), F.element_at(class_id, F.col("classname")).alias("objectclass_id"), "classname",
        F.transform("parts", lambda p: p["geom"]).alias("geom"),
    )


def _vertex_sql() -> str:
    rows = []
    for slot, name, when, rings in FACES:
        for i, ring in enumerate(rings, 1):
            n = len(ring)
            at = f"SELECT plots.id, {slot} AS slot, '{name}' AS classname, {i} AS ring_idx, unnest(range(1, {n + 1})) AS k FROM plots WHERE {when}"
            pick = lambda axis: "CASE k " + " ".join(f"WHEN {k} THEN CAST({c[axis]} AS DOUBLE)" for k, c in enumerate(ring, 1)) + " END"  # noqa: B023, E731
            rows.append(f"SELECT f.id, f.slot, f.classname, f.ring_idx, CASE WHEN f.id % 2 = 1 THEN {n + 1} - k ELSE k END AS pt_idx, {pick(0)} AS x, {pick(1)} AS y, {pick(2)} AS z FROM ({at}) f JOIN plots USING (id)")
    return "\n  UNION ALL ".join(rows)


#: CTEs, each in terms of those before it.
PLOTS = f"plots AS (SELECT p_partkey AS id, {', '.join(f'{e} AS {k}' for k, e in PARAMETERS.items())} FROM part)"
POINTS = f"points AS ({_vertex_sql()})"
EDGES = """edges AS (SELECT * FROM (SELECT *, lead(x) OVER w AS next_x, lead(y) OVER w AS next_y, lead(z) OVER w AS next_z FROM points WINDOW w AS (PARTITION BY id, slot, ring_idx ORDER BY pt_idx)) WHERE next_x IS NOT NULL)"""
RINGS = """rings AS (SELECT id, slot, any_value(classname) AS classname, ring_idx, count(*) AS n,
    sum((y - next_y) * (z + next_z)) AS px, sum((z - next_z) * (x + next_x)) AS py, sum((x - next_x) * (y + next_y)) AS pz,
    sum(x * next_y - next_x * y) / 2 AS a2, sum((x + next_x) * (x * next_y - next_x * y)) / 6 AS mx, sum((y + next_y) * (x * next_y - next_x * y)) / 6 AS my,
    sum(sqrt((x - next_x) ** 2 + (y - next_y) ** 2)) AS len, sum((x + next_x) / 2 * sqrt((x - next_x) ** 2 + (y - next_y) ** 2)) AS lx, sum((y + next_y) / 2 * sqrt((x - next_x) ** 2 + (y - next_y) ** 2)) AS ly,
    min(z) AS z0, max(z) AS z1 FROM edges GROUP BY id, slot, ring_idx)"""
UNITS = """units AS (SELECT *, px / m AS ux, py / m AS uy, pz / m AS uz FROM (SELECT *, sqrt(px * px + py * py + pz * pz) AS m FROM rings WHERE ring_idx = 1) WHERE m > 1e-10)"""
CENTROIDS = """centroids AS (SELECT id, slot, CASE WHEN abs(sum(s * abs(a2))) > 1e-10 THEN sum(s * sign(a2) * mx) / sum(s * abs(a2)) ELSE sum(CASE WHEN ring_idx = 1 THEN lx END) / sum(CASE WHEN ring_idx = 1 THEN len END) END AS cx,
    CASE WHEN abs(sum(s * abs(a2))) > 1e-10 THEN sum(s * sign(a2) * my) / sum(s * abs(a2)) ELSE sum(CASE WHEN ring_idx = 1 THEN ly END) / sum(CASE WHEN ring_idx = 1 THEN len END) END AS cy
  FROM (SELECT *, CASE WHEN ring_idx = 1 THEN 1 ELSE -1 END AS s FROM rings) GROUP BY id, slot)"""
ORIENTED = """oriented AS (SELECT u.*, f, u.ux * f AS vx, u.uy * f AS vy, u.uz * f AS vz FROM (
    SELECT u.*, CASE WHEN classname = 'RoofSurface' THEN CASE WHEN uz < 0 THEN -1.0 ELSE 1.0 END
      WHEN classname = 'WallSurface' THEN CASE WHEN u.id % 11 <> 0 AND (cx - (x0 + CASE WHEN u.id % 23 = 0 THEN w * 0.75 ELSE w / 2 END)) * ux + (cy - (y0 + d / 2)) * uy >= 0 THEN 1.0 ELSE -1.0 END ELSE 1.0 END::DOUBLE AS f
    FROM units u JOIN centroids USING (id, slot) JOIN plots USING (id)) u)"""
FACES_SQL = """faces AS (SELECT o.id AS building_feature_id, o.id * 20 + CASE WHEN o.slot = 7 AND o.id % 4 = 0 THEN 6 ELSE o.slot END AS surface_feature_id, CASE WHEN o.slot = 7 AND o.id % 4 = 0 THEN 1 ELSE 0 END AS face_idx, o.classname,
    round((SELECT sum(CASE WHEN r.ring_idx = 1 THEN 1 ELSE -1 END * abs(r.px * o.vx + r.py * o.vy + r.pz * o.vz) / 2) FROM rings r WHERE r.id = o.id AND r.slot = o.slot), 2) AS surface_area,
    round(degrees(asin(least(abs(vz), 1.0))), 2) AS tilt,
    CASE WHEN abs(vz) > 0.985 THEN -1.0 ELSE round(fmod(450.0 - degrees(atan2(vy, vx)), 360.0), 2) END AS azimuth, round(z1 - z0, 2) AS height,
    (o.classname <> 'WallSurface' OR o.slot = 9) AS is_valid, o.slot <> 9 AS is_planar, o.id % 2 = 1 AS odd, o.slot
  FROM oriented o)"""
BUILDINGS = """buildings AS (SELECT building_feature_id, 'B' || building_feature_id AS object_id,
    round(sum(CASE WHEN classname = 'GroundSurface' THEN surface_area END), 2) AS footprint_area,
    CASE WHEN count(*) FILTER (classname = 'GroundSurface') = 0 THEN 2 WHEN building_feature_id % 19 = 0 AND building_feature_id % 23 <> 0 THEN 1 ELSE 1 END AS footprint_complexity,
    CASE WHEN count(*) FILTER (classname = 'RoofSurface') = 1 THEN 0 WHEN count(*) FILTER (classname = 'RoofSurface') BETWEEN 2 AND 4 THEN 1 ELSE 2 END AS roof_complexity,
    round(sum(CASE WHEN classname = 'RoofSurface' THEN surface_area ELSE 0 END), 2) AS area_total_roof, round(sum(CASE WHEN classname = 'WallSurface' THEN surface_area ELSE 0 END), 2) AS area_total_wall,
    round(sum(CASE WHEN classname = 'GroundSurface' THEN surface_area ELSE 0 END), 2) AS area_total_floor0,
    CAST(count(*) FILTER (classname = 'RoofSurface') AS INTEGER) AS surface_count_roof, CAST(count(*) FILTER (classname = 'WallSurface') AS INTEGER) AS surface_count_wall,
    max(height) FILTER (classname = 'WallSurface') AS min_height, round(max(height) FILTER (classname = 'WallSurface') + coalesce(max(height) FILTER (classname = 'RoofSurface'), 0), 2) AS max_height,
    CAST(round_even(max(height) FILTER (classname = 'WallSurface') / 2.5, 0) AS INTEGER) AS number_of_storeys
  FROM faces GROUP BY building_feature_id)"""
VOLUMES = """volumes AS (SELECT *, round(min_height * footprint_area, 2) AS min_volume, round(max_height * footprint_area, 2) AS max_volume, round(footprint_area * number_of_storeys, 2) AS area_total_floor FROM buildings)"""
CHAIN = [PLOTS, POINTS, EDGES, RINGS, UNITS, CENTROIDS, ORIENTED, FACES_SQL, BUILDINGS, VOLUMES]


def with_chain(last: str, body: str, more: tuple[str, ...] = ()) -> str:
    """WITH all CTEs up to the one named last, then more, then body."""
    names = [c.split(" ", 1)[0] for c in CHAIN]
    return "WITH " + ",\n".join([*CHAIN[: names.index(last) + 1], *more]) + "\n" + body


#: Archetype sheet, one row for each supplier and a fifth of the nations.
TABULA = {
    "id": "cast(s_suppkey * 100 + n_nationkey as int)", "Code_BuildingVariant": "CASE WHEN (s_suppkey + n_nationkey) % 13 = 0 THEN NULL ELSE concat('V.', s_suppkey * 100 + n_nationkey) END",
    "Number_BuildingVariant": "cast(CASE WHEN (s_suppkey * 100 + n_nationkey) % 3 = 0 THEN 2 ELSE 1 END as int)", "Year1_Building": "cast(1900 + n_nationkey as int)", "Year2_Building": "cast(1950 + n_nationkey as int)",
    "V_C": "cast(100 + (s_suppkey * 37 + n_nationkey) % 900 as float)", "A_C_National": "cast(50 + (s_suppkey * 7 + n_nationkey) % 400 as float)", "n_Storey": "cast((s_suppkey + n_nationkey) % 5 as float)",
    "Code_ComplexFootprint": "CASE n_nationkey % 4 WHEN 0 THEN 'Simple' WHEN 1 THEN 'Regular' WHEN 2 THEN 'Complex' ELSE 'Other' END", "Code_AttachedNeighbours": "CASE s_suppkey % 4 WHEN 0 THEN 'B_Alone' WHEN 1 THEN 'B_N1' WHEN 2 THEN 'B_N2' ELSE NULL END",
    "Code_ComplexRoof": "CASE s_suppkey % 4 WHEN 0 THEN 'Simple' WHEN 1 THEN 'Regular' WHEN 2 THEN 'Complex' ELSE 'None' END", "A_Roof_1": "cast(30 + s_suppkey % 70 as float)", "A_Roof_2": "CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE cast(10 as float) END",
    "A_Wall_1": "cast(40 + n_nationkey as float)", "A_Wall_2": "cast(35 + s_suppkey % 60 as float)", "A_Wall_3": "CASE WHEN n_nationkey % 3 = 0 THEN cast(20 as float) ELSE NULL END", "A_C_ExtDim": "CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE cast(60 + (s_suppkey * 3) % 300 as float) END",
    "Code_BuildingSizeClass": "CASE n_nationkey % 5 WHEN 0 THEN 'SFH' WHEN 1 THEN 'MFH' WHEN 2 THEN 'TH' WHEN 3 THEN 'AB' ELSE 'XX' END",
}
TABULA_CTE = f"tabula AS (SELECT {', '.join(f'{e} AS {k}' for k, e in TABULA.items())} FROM supplier JOIN nation ON s_suppkey % 5 = n_nationkey % 5)"
VARIANTS_CTE = """variants AS (SELECT id AS tabula_variant_code_id, Code_BuildingVariant AS tabula_variant_code, CAST(V_C AS DOUBLE) AS max_volume, CAST(A_C_National AS DOUBLE) AS total_area, Year1_Building AS construction_year_1, Year2_Building AS construction_year_2,
    CAST(CAST(CAST(A_C_National AS DOUBLE) / nullif(CAST(n_Storey AS DOUBLE), 0) AS FLOAT) AS DOUBLE) AS footprint_area, CAST(n_Storey AS INTEGER) AS number_of_storeys,
    CASE Code_ComplexFootprint WHEN 'Simple' THEN 0 WHEN 'Regular' THEN 1 WHEN 'Complex' THEN 2 ELSE -1 END AS footprint_complexity, CASE Code_AttachedNeighbours WHEN 'B_Alone' THEN 0 WHEN 'B_N1' THEN 1 WHEN 'B_N2' THEN 2 ELSE -1 END AS attached_neighbour_class,
    CASE Code_ComplexRoof WHEN 'Simple' THEN 0 WHEN 'Regular' THEN 1 WHEN 'Complex' THEN 2 ELSE -1 END AS roof_complexity, CAST(coalesce(A_Roof_1, 0) + coalesce(A_Roof_2, 0) AS DOUBLE) AS area_total_roof,
    CAST(coalesce(A_Wall_1, 0) + coalesce(A_Wall_2, 0) + coalesce(A_Wall_3, 0) AS DOUBLE) AS area_total_wall, CAST(coalesce(A_C_ExtDim, 0) AS DOUBLE) AS area_total_floor,
    CASE Code_BuildingSizeClass WHEN 'SFH' THEN 0 WHEN 'MFH' THEN 1 WHEN 'TH' THEN 2 WHEN 'AB' THEN 3 ELSE -1 END AS building_size_class
  FROM tabula WHERE Code_BuildingVariant IS NOT NULL AND Number_BuildingVariant = 1)"""


def tabula(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _load(spark, sf_dir, "supplier").join(F.broadcast(_load(spark, sf_dir, "nation")), F.expr("s_suppkey % 5 = n_nationkey % 5"))
    return own.selectExpr(*(f"{e} as {k}" for k, e in TABULA.items()))


def _polygon_of(ring) -> str:
    return "array(array(" + ", ".join(map(_point, ring)) + "))"  # one ring


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(building_feature_id, object_id, building_footprint_geom): every building's rectangle."""
    shape = F.array(F.expr(_polygon_of(_ring("x0,y0,0", f"{_X},y0,0", f"{_X},{_Y},0", f"x0,{_Y},0"))))
    return plots(spark, sf_dir).select(F.col("id").alias("building_feature_id"), F.concat(F.lit("B"), F.col("id")).alias("object_id"), shape.alias("building_footprint_geom"))


def layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two link layers: footprints shifted in x."""
    own = plots(spark, sf_dir).withColumn("s", F.expr("cast(id % 5 as double)"))
    shape = F.array(F.expr(_polygon_of(_ring("x0+s,y0,0", f"{_X}+s,y0,0", f"{_X}+s,{_Y},0", f"x0+s,{_Y},0"))))
    named = lambda p: own.select(F.concat(F.lit(p), F.col("id")).alias("osm_id"), shape.alias("geom"), "id")
    return named("R").where("id % 3 = 0 or id % 15 = 0").drop("id"), named("O").where("id % 3 = 1 or id % 15 = 0").drop("id")


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thematic properties of buildings, from lineitem: numbers as double, integer or string, some of them no numbers."""
    return _load(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey as feature_id", "element_at(array('height', 'area', 'tilt', 'azimuth'), cast(l_linenumber % 4 + 1 as int)) as name", "if(l_orderkey % 3 = 0, l_quantity, null) as val_double",
        "if(l_orderkey % 3 = 1, cast(l_quantity as bigint), null) as val_int", "if(l_orderkey % 3 = 2, if(l_orderkey % 7 = 0, 'n/a', concat(cast(cast(l_quantity as bigint) as string), '.5')), null) as val_string",
    )


PROPERTIES_CTE = """properties AS (SELECT l_partkey AS feature_id, ['height', 'area', 'tilt', 'azimuth'][l_linenumber % 4 + 1] AS name, CASE WHEN l_orderkey % 3 = 0 THEN l_quantity END AS val_double,
    CASE WHEN l_orderkey % 3 = 1 THEN CAST(l_quantity AS BIGINT) END AS val_int, CASE WHEN l_orderkey % 3 = 2 THEN CASE WHEN l_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(l_quantity AS BIGINT) || '.5' END END AS val_string FROM lineitem)"""
THEMATIC_CTE = """thematic AS (SELECT feature_id, name, CASE WHEN val_double IS NOT NULL THEN val_double WHEN val_int IS NOT NULL THEN CAST(val_int AS DOUBLE) ELSE TRY_CAST(val_string AS DOUBLE) END AS v FROM properties)"""
