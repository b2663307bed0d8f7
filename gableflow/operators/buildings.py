"""From faces to building records: roll-up, volume, storeys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import geometry as G
from ..functions import kernels
from ..functions.scalars import half_even, r2
from ..staging import written
from .batched import with_kernel
from .faces import GROUND, ROOF, WALL

ROOM_HEIGHT = 2.5
#: Units of the measures.
UNITS = {"min_height": "m", "max_height": "m", "room_height": "m", "min_volume": "cbm", "max_volume": "cbm", "area_total_roof": "sqm", "area_total_wall": "sqm", "area_total_floor": "sqm"}


def footprint_union(df: DataFrame, ground: str = "ground", name: str = "footprint") -> DataFrame:
    """The union of a building's ground polygons. One polygon is itself, natively; only the others see a Python worker."""
    single = df.where(F.size(ground) <= 1).withColumn(name, F.col(ground))
    several = with_kernel(df.where(F.size(ground) > 1), name, schema.MULTIPOLYGON, _union, ground)
    return single.unionByName(several)


def _union(ground):
    point = lambda p: dict(zip("xyz", p, strict=True))
    return [[[point(p) for p in ring] for ring in polygon] for polygon in kernels.union(kernels.plain(ground))]


def rollup(faces: DataFrame) -> DataFrame:
    """One row per building: sums, counts and heights by class, and its ground polygons in a fixed order."""
    own = lambda c, value: F.when(F.col("classname") == c, value)
    area = F.col("surface_area")
    total = lambda c: r2(F.sum(F.when(F.col("classname") == c, area).otherwise(0.0)))
    ground = F.sort_array(F.collect_list(own(GROUND, F.struct("surface_feature_id", "face_idx", "geom"))))
    grouped = faces.where(F.col("geom").isNotNull()).groupBy("building_feature_id").agg(
        F.min("building_object_id").alias("object_id"),
        r2(F.sum(own(GROUND, area))).alias("footprint_area"),
        total(ROOF).alias("area_total_roof"), total(WALL).alias("area_total_wall"), total(GROUND).alias("area_total_floor"),
        F.count(own(ROOF, F.lit(1))).cast("int").alias("surface_count_roof"), F.count(own(WALL, F.lit(1))).cast("int").alias("surface_count_wall"),
        F.max(own(WALL, F.col("height"))).alias("min_height"), F.max(own(ROOF, F.col("height"))).alias("roof_height"),
        F.transform(ground, lambda g: g["geom"]).alias("ground"),
    )
    return grouped


def roof_complexity(count: Column) -> Column:
    return F.when(count == 1, 0).when((count >= 2) & (count <= 4), 1).otherwise(2)


def aggregate_buildings(faces: DataFrame, country: str | None = None, room_height: float = ROOM_HEIGHT) -> DataFrame:
    """Building records from surface_raw, before volumes, the storeys step and matching."""
    own = footprint_union(written(rollup(faces), "rollup"))  # read twice below: the roll-up itself runs once
    some = F.when(F.size("footprint") > 0, F.col("footprint"))
    storeys = F.when(F.col("min_height") > 0, half_even(F.col("min_height") / room_height)).otherwise(1)
    return own.withColumn("fp", some).select(
        "building_feature_id", "object_id", F.lit(country).cast("string").alias("country_code"), F.lit(None).cast("int").alias("tabula_variant_code_id"), F.lit(None).cast("string").alias("tabula_variant_code"),
        F.lit(0).alias("construction_year"), F.lit(None).cast("string").alias("comment"), "footprint_area", G.complexity(G.points(F.col("fp"))).alias("footprint_complexity"), roof_complexity(F.col("surface_count_roof")).alias("roof_complexity"),
        F.lit(False).alias("has_attached_neighbour"), F.array().cast("array<bigint>").alias("attached_neighbour_id"), F.lit(0).alias("total_attached_neighbour"), F.lit(0).alias("attached_neighbour_class"),
        "area_total_roof", "area_total_wall", "area_total_floor", "surface_count_roof", "surface_count_wall", F.lit(0).alias("surface_count_floor"),
        "min_height", r2(F.col("min_height") + F.coalesce("roof_height", F.lit(0.0))).alias("max_height"), F.lit(None).cast("double").alias("min_volume"), F.lit(None).cast("double").alias("max_volume"),
        F.lit(room_height).alias("room_height"), storeys.alias("number_of_storeys"), *(F.lit(unit).alias(f"{c}_unit") for c, unit in UNITS.items()), G.centroid_2d(F.col("fp")).alias("building_centroid"), F.col("fp").alias("building_footprint_geom"),
    )


def volumes(buildings: DataFrame) -> DataFrame:
    """min_volume and max_volume = height times footprint, where both are known."""
    by = lambda h, old: F.when(F.col(h).isNotNull() & F.col("footprint_area").isNotNull(), r2(F.col(h) * F.col("footprint_area"))).otherwise(F.col(old))
    return buildings.withColumns({"min_volume": by("min_height", "min_volume"), "max_volume": by("max_height", "max_volume")})


def storeys(buildings: DataFrame) -> DataFrame:
    """number_of_storeys from the wall height; area_total_floor from the storeys before this step."""
    known = (F.col("min_height") > 0) & (F.col("room_height") > 0)
    return buildings.withColumns({
        "number_of_storeys": F.when(known, half_even(F.col("min_height") / F.col("room_height"))).otherwise(F.col("number_of_storeys")),
        "area_total_floor": r2(F.col("footprint_area") * F.col("number_of_storeys")),
    })


