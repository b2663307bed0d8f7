"""From surfaces to faces with their attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..functions import kernels
from ..functions.scalars import r2
from .batched import with_kernel

GROUND, WALL, ROOF = "GroundSurface", "WallSurface", "RoofSurface"
#: Object classes whose area counts.
AREA_CLASSES = (709, 710, 712)


def row_id(*keys: str) -> Column:
    """A stable id of a row from its keys."""
    return F.sha2(F.concat_ws(":", *(F.col(k).cast("string") for k in keys)), 256)


def child_features(feature: DataFrame, pairs: DataFrame, geometry: DataFrame, objectclass: DataFrame, lod: int = 2, *, dedupe: bool = False) -> DataFrame:
    """Surfaces with the building they were assigned to (pairs: building_feature_id, surface_feature_id), named by class.

    A surface with several geometry rows gives a row for each of them, unless dedupe is set.
    """
    building = feature.select(F.col("id").alias("building_feature_id"), F.col("objectid").alias("building_objectid"))
    surface = feature.select(F.col("id").alias("surface_feature_id"), F.col("objectid").alias("surface_objectid"), "objectclass_id")
    classes = objectclass.select(F.col("id").alias("objectclass_id"), "classname")
    out = pairs.join(building, "building_feature_id").join(surface, "surface_feature_id").join(classes, "objectclass_id")
    out = out.join(geometry.select(F.col("feature_id").alias("surface_feature_id"), F.col("geometry").alias("geom")), "surface_feature_id")
    if dedupe:
        out = out.dropDuplicates(["building_feature_id", "surface_feature_id"])
    return out.withColumn("lod", F.lit(lod)).withColumn("id", row_id("lod", "building_feature_id", "surface_feature_id"))


def explode_faces(child: DataFrame) -> DataFrame:
    """One row per polygon of a surface's multipolygon: face_idx from 0, coord_dim, has_z, geom."""
    out = child.where(F.col("geom").isNotNull()).select(*(c for c in child.columns if c != "geom"), F.posexplode("geom").alias("face_idx", "geom"))
    dims = child.schema["geom"].dataType
    while isinstance(dims, T.ArrayType):
        dims = dims.elementType
    return out.where(F.size("geom") > 0).withColumns({"coord_dim": F.lit(len(dims.fields)), "has_z": G.height(F.col("geom")) > 0})


def vertices(faces: DataFrame, *keys: str) -> DataFrame:
    """One row per point: keys, ring_idx, pt_idx (both from 1), x, y, z."""
    rings = faces.select(*keys, F.posexplode("geom").alias("ring_idx", "ring"))
    pts = rings.select(*keys, (F.col("ring_idx") + 1).alias("ring_idx"), F.posexplode("ring").alias("pt_idx", "p"))
    return pts.select(*keys, "ring_idx", (F.col("pt_idx") + 1).alias("pt_idx"), "p.x", "p.y", "p.z")


def vertex_edges(points: DataFrame, *keys: str) -> DataFrame:
    """Each point with the next one of its ring; the last, which repeats the first, has none and goes."""
    w = Window.partitionBy(*keys, "ring_idx").orderBy("pt_idx")
    return points.withColumns({f"next_{c}": F.lead(c).over(w) for c in "xyz"}).where("next_x is not null")


def newell_relational(faces: DataFrame, *keys: str) -> DataFrame:
    """Newell vectors of exteriors by exploding, lead and sums: the relational twin of geometry.newell, for tests."""
    own = vertex_edges(vertices(faces.withColumn("geom", F.slice("geom", 1, 1)), *keys), *keys)
    n = own.groupBy(*keys).agg(
        F.sum(F.expr("(y - next_y) * (z + next_z)")).alias("nx"), F.sum(F.expr("(z - next_z) * (x + next_x)")).alias("ny"), F.sum(F.expr("(x - next_x) * (y + next_y)")).alias("nz"), F.count("*").alias("edges")
    )
    return n.where((F.col("edges") >= 2) & (F.sqrt(F.expr("nx * nx + ny * ny + nz * nz")) > G.ZERO)).drop("edges")


def normals(faces: DataFrame, *, shift_origin: bool = True) -> DataFrame:
    """faces with newell and the unit normal of the exterior; degenerate faces are dropped."""
    out = faces.withColumn("__plane", G.plane(F.element_at("geom", 1), shift_origin)).where(F.col("__plane").isNotNull())
    return out.withColumns({"newell": F.col("__plane.newell"), "normal": F.col("__plane.normal")}).drop("__plane")


def interior_points(faces: DataFrame) -> DataFrame:
    """(building_feature_id, interior): a point inside the ground polygons of a building."""
    ground = faces.where(F.col("classname") == GROUND).groupBy("building_feature_id").agg(F.collect_list("geom").alias("ground"))
    return ground.select("building_feature_id", G.interior_point(F.col("ground")).alias("interior"))


def with_interior(faces: DataFrame) -> DataFrame:
    """faces with interior, the point of interior_points: one shuffle by building, and no second reading of the faces."""
    ground = F.collect_list(F.when(F.col("classname") == GROUND, F.col("geom"))).over(Window.partitionBy("building_feature_id"))
    own = faces.withColumn("__ground", ground)
    return own.withColumn("interior", F.when(F.size("__ground") > 0, G.interior_point(F.col("__ground")))).drop("__ground")


def oriented(classname: Column, normal: Column, centroid: Column, interior: Column, missing_ground_flip: float = -1.0) -> Column:
    """Roofs point up, walls away from the interior; without ground a wall is turned by missing_ground_flip."""
    outward = (centroid["x"] - interior["x"]) * normal["x"] + (centroid["y"] - interior["y"]) * normal["y"]
    wall = F.when(outward.isNull(), F.lit(missing_ground_flip)).when(outward >= 0, 1.0).otherwise(-1.0)
    roof = F.when(normal["z"] < 0, -1.0).otherwise(1.0)
    return F.when(classname == ROOF, G.scaled(normal, roof)).when(classname == WALL, G.scaled(normal, wall)).otherwise(normal)


def face_attributes(faces: DataFrame, *, missing_ground_flip: float = -1.0, convergence: float = 0.0, area_classes: tuple[int, ...] = AREA_CLASSES, validate: bool = True, planar_eps: float | None = None) -> DataFrame:
    """surface_raw: area, tilt, azimuth and height of every face that is not degenerate, with validity and planarity.

    planar_eps: test planarity natively, by the largest distance from the face's plane, instead of exactly.
    """
    own = normals(with_interior(faces)).withColumn("centroid", G.centroid_2d(F.array("geom")))
    own = own.withColumn("n", oriented(F.col("classname"), F.col("normal"), F.col("centroid"), F.col("interior"), missing_ground_flip))
    area = F.when(F.col("objectclass_id").isin(*area_classes), r2(G.surface_area(F.col("geom"), F.col("n"))))
    out = own.select(
        F.sha2(F.concat_ws(":", "id", "face_idx"), 256).alias("id"), "building_feature_id", "surface_feature_id", F.col("building_objectid").alias("building_object_id"), F.col("surface_objectid").alias("surface_object_id"),
        "objectclass_id", "classname", "face_idx", area.alias("surface_area"), F.lit("sqm").alias("surface_area_unit"), r2(G.tilt(F.col("n"))).alias("tilt"), F.lit("degrees").alias("tilt_unit"),
        G.azimuth(F.col("n"), convergence).alias("azimuth"), F.lit("degrees").alias("azimuth_unit"), r2(G.height(F.col("geom"))).alias("height"), F.lit("m").alias("height_unit"), F.col("n").alias("normal"), F.col("id").alias("child_row_id"), "geom",
    )
    if validate:
        out = with_checks(out, planar_eps)
    else:
        out = out.withColumns({"is_valid": F.lit(None).cast("boolean"), "is_planar": F.lit(None).cast("boolean")})
    return out.withColumns({"is_party_wall": F.lit(None).cast("boolean"), "neighbour_building_id": F.lit(None).cast("bigint"), "attribute_calc_status": F.lit(None).cast("string")})


def with_checks(faces: DataFrame, planar_eps: float | None = None) -> DataFrame:
    """is_valid and is_planar of geom: natively where that is certain, and by exact kernels for the faces that are left."""
    kind = T.StructType([T.StructField("valid", T.BooleanType()), T.StructField("planar", T.BooleanType())])
    out = faces.withColumn("__sure", G.certain_checks(F.col("geom")))
    open_ = F.col("__sure.valid").isNull() if planar_eps is not None else F.col("__sure.valid").isNull() | F.col("__sure.planar").isNull()
    out = with_kernel(out.withColumn("__ask", F.when(open_, F.col("geom"))), "__checks", kind, _checks, "__ask")
    planar = F.coalesce("__sure.planar", "__checks.planar")
    if planar_eps is not None:
        o = F.element_at(F.element_at("geom", 1), 1)
        off = F.transform(F.flatten("geom"), lambda p: F.abs(sum(((p[c] - o[c]) * F.col("normal")[c] for c in "xyz"), F.lit(0.0))))
        planar = F.array_max(off) <= planar_eps
    valid = F.coalesce("__sure.valid", "__checks.valid")
    return out.withColumns({"is_valid": valid, "is_planar": planar}).drop("__checks", "__sure", "__ask")


def _checks(geom):
    polygon = kernels.plain(geom)
    return None if polygon is None else {"valid": kernels.is_valid(polygon), "planar": kernels.is_planar(polygon)}
