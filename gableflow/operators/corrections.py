"""Manual corrections and what follows from them, as explicit functions instead of triggers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.scalars import half_even, r2
from .matching import DIMENSIONS, feature_stats, match_variants
from .rows import row_changed

#: Storeys are integers, so room height and storeys settle after two rounds; a third proves it.
ROUNDS = 3


def _positive(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & (F.col(c) > 0)
    return F.coalesce(out, F.lit(False))


def footprint_correction(buildings: DataFrame, edits: DataFrame) -> DataFrame:
    """edits (building_feature_id, new_footprint): a changed outline gives area, complexity, centroid, volumes and floor area anew."""
    own = buildings.join(edits, "building_feature_id", "left")
    changed = F.col("new_footprint").isNotNull() & ~F.coalesce(G.same_outline(F.col("new_footprint"), F.col("building_footprint_geom")), F.lit(False))
    new = lambda value, old: F.when(F.col("__changed"), value).otherwise(F.col(old))
    own = own.withColumn("__changed", changed)
    own = own.withColumns({
        "building_footprint_geom": F.coalesce("new_footprint", "building_footprint_geom"),
        "footprint_area": new(r2(G.area_2d(F.col("new_footprint"))), "footprint_area"),
        "footprint_complexity": new(G.complexity(G.points(F.col("new_footprint"))), "footprint_complexity"),
        "building_centroid": new(G.centroid_2d(F.col("new_footprint")), "building_centroid"),
    })
    floor = F.when(F.col("number_of_storeys").isNotNull(), r2(F.col("footprint_area") * F.col("number_of_storeys"))).otherwise(F.col("area_total_floor"))
    own = own.withColumns({c: F.when(F.col("__changed"), value).otherwise(F.col(c)) for c, value in (("min_volume", _volume("min_height", "min_volume")), ("max_volume", _volume("max_height", "max_volume")))})
    return own.withColumn("area_total_floor", new(floor, "area_total_floor")).select(*buildings.columns)


def _volume(height: str, old: str) -> Column:
    return F.when(F.col(height).isNotNull(), r2(F.col(height) * F.col("footprint_area"))).otherwise(F.col(old))


def room_height_correction(buildings: DataFrame, edits: DataFrame) -> DataFrame:
    """edits (building_feature_id, new_room_height): storeys follow, then what follows from storeys."""
    own = buildings.join(edits, "building_feature_id", "left")
    touched = F.col("new_room_height").isNotNull() & ~F.col("new_room_height").eqNullSafe(F.col("room_height"))
    own = own.withColumns({"__room": touched, "room_height": F.coalesce("new_room_height", "room_height")})
    return settled(own.withColumn("__storeys", F.lit(False))).select(*buildings.columns)


def storeys_correction(buildings: DataFrame, edits: DataFrame) -> DataFrame:
    """edits (building_feature_id, new_storeys): floor area and room height follow, then what follows from room height."""
    own = buildings.join(edits, "building_feature_id", "left")
    touched = F.col("new_storeys").isNotNull() & ~F.col("new_storeys").eqNullSafe(F.col("number_of_storeys"))
    own = own.withColumns({"__storeys": touched, "number_of_storeys": F.coalesce("new_storeys", "number_of_storeys")})
    return settled(own.withColumn("__room", F.lit(False))).select(*buildings.columns)


def settled(own: DataFrame) -> DataFrame:
    """Rounds of the two rules, for rows whose room height (__room) or storeys (__storeys) has just changed."""
    for _ in range(ROUNDS):
        n = F.when(F.col("__room") & _positive("min_height", "room_height"), half_even(F.col("min_height") / F.col("room_height"))).otherwise(F.col("number_of_storeys"))
        own = own.withColumn("__n", n)
        own = own.withColumns({"__storeys": F.col("__storeys") | ~F.col("__n").eqNullSafe(F.col("number_of_storeys")), "number_of_storeys": F.col("__n")})
        area = F.when(F.col("__storeys"), r2(F.col("footprint_area") * F.col("number_of_storeys"))).otherwise(F.col("area_total_floor"))
        room = F.when(F.col("__storeys") & _positive("number_of_storeys"), r2(F.col("min_height") / F.col("number_of_storeys"))).otherwise(F.col("room_height"))
        own = own.withColumns({"area_total_floor": area, "__r": room})
        own = own.withColumns({"__room": ~F.col("__r").eqNullSafe(F.col("room_height")), "room_height": F.col("__r"), "__storeys": F.lit(False)})
    return own


def rematch(before: DataFrame, after: DataFrame, variants: DataFrame, *, int_division: bool = True) -> DataFrame:
    """after with new labels for rows whose dimensions changed: statistics over the whole table, old labels where none is found."""
    old = before.select("building_feature_id", F.struct(*DIMENSIONS).alias("old"))
    paired = after.join(old, "building_feature_id").select("building_feature_id", "old", F.struct(*DIMENSIONS).alias("new"))
    changed = paired.where(row_changed(list(DIMENSIONS), "old", "new")).select("building_feature_id")
    found = match_variants(after.join(changed, "building_feature_id", "left_semi"), variants, feature_stats(after, variants), int_division=int_division)
    found = found.select("building_feature_id", F.col("tabula_variant_code_id").alias("__id"), F.col("tabula_variant_code").alias("__code"))
    out = after.join(found, "building_feature_id", "left")
    return out.withColumns({"tabula_variant_code_id": F.coalesce("__id", "tabula_variant_code_id"), "tabula_variant_code": F.coalesce("__code", "tabula_variant_code")}).select(*after.columns)


def touched(before: DataFrame, after: DataFrame, key: str = "building_feature_id", stamps: tuple[str, ...] = ("created_at", "updated_at")) -> DataFrame:
    """after with updated_at moved to now where any other column differs from before."""
    own = [c for c in after.columns if c not in (key, *stamps)]
    old = before.select(key, F.struct(*own).alias("__old"))
    paired = after.join(old, key, "left").withColumn("__new", F.struct(*own))
    return paired.withColumn("updated_at", F.when(F.col("__old").isNull() | row_changed(own, "__old", "__new"), F.current_timestamp()).otherwise(F.col("updated_at"))).select(*after.columns)


def apply_corrections(buildings: DataFrame, variants: DataFrame, *, footprints: DataFrame | None = None, room_heights: DataFrame | None = None, storeys: DataFrame | None = None) -> DataFrame:
    """The whole cascade: footprints, room heights and storeys as given, then labels of rows whose dimensions changed."""
    after = buildings
    if footprints is not None:
        after = footprint_correction(after, footprints)
    if room_heights is not None:
        after = room_height_correction(after, room_heights)
    if storeys is not None:
        after = storeys_correction(after, storeys)
    return rematch(buildings, after, variants)
