"""Table and geometry types.

A geometry is nested arrays: POINT struct(x, y, z), RING a closed array of points, POLYGON an array of rings with the
exterior first, MULTIPOLYGON an array of polygons; a solid's shell is a MULTIPOLYGON too.
"""

from __future__ import annotations

from pyspark.sql import types as T

POINT = T.StructType([T.StructField(c, T.DoubleType()) for c in "xyz"])
PLANE_POINT = T.StructType([T.StructField(c, T.DoubleType()) for c in "xy"])
RING = T.ArrayType(POINT)
POLYGON = T.ArrayType(RING)
MULTIPOLYGON = T.ArrayType(POLYGON)

_KINDS = {"l": T.LongType(), "i": T.IntegerType(), "h": T.ShortType(), "d": T.DoubleType(), "f": T.FloatType(), "s": T.StringType(), "b": T.BooleanType(), "t": T.TimestampType(), "a": T.ArrayType(T.LongType()), "p": PLANE_POINT, "g": POLYGON, "m": MULTIPOLYGON}


def table(spec: str) -> T.StructType:
    """'name:kind name:kind': kinds are l long, i int, h short, d double, f float, s string, b boolean, t timestamp, a array of long, p point in the plane, g polygon, m multipolygon."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (part.split(":") for part in spec.split())])


FEATURE = table("id:l objectid:s objectclass_id:i")
GEOMETRY_DATA = table("feature_id:l geometry:m")
PROPERTY = table("feature_id:l name:s val_double:d val_int:l val_string:s")
OBJECTCLASS = table("id:i classname:s")
CHILD_FEATURE = table("id:s lod:i building_feature_id:l surface_feature_id:l building_objectid:s surface_objectid:s objectclass_id:i classname:s geom:m")
FACE = table("id:s child_row_id:s lod:i building_feature_id:l surface_feature_id:l building_objectid:s surface_objectid:s objectclass_id:i classname:s face_idx:i coord_dim:i has_z:b geom:g")
SURFACE_RAW = table(
    "id:s building_feature_id:l surface_feature_id:l building_object_id:s surface_object_id:s objectclass_id:i classname:s face_idx:i "
    "surface_area:d surface_area_unit:s tilt:d tilt_unit:s azimuth:d azimuth_unit:s height:d height_unit:s is_valid:b is_planar:b is_party_wall:b neighbour_building_id:l "
    "child_row_id:s attribute_calc_status:s geom:g"
)
BUILDING = table(
    "building_feature_id:l object_id:s country_code:s tabula_variant_code_id:i tabula_variant_code:s construction_year:i comment:s footprint_area:d footprint_complexity:i roof_complexity:i "
    "has_attached_neighbour:b attached_neighbour_id:a total_attached_neighbour:i attached_neighbour_class:i area_total_roof:d area_total_wall:d area_total_floor:d surface_count_roof:i surface_count_wall:i surface_count_floor:i "
    "min_height:d max_height:d min_volume:d max_volume:d room_height:d number_of_storeys:i min_height_unit:s max_height_unit:s room_height_unit:s min_volume_unit:s max_volume_unit:s area_total_roof_unit:s "
    "area_total_wall_unit:s area_total_floor_unit:s building_centroid:p building_footprint_geom:m created_at:t updated_at:t"
)
SURFACE = table("surface_object_id:s building_object_id:s building_feature_id:l surface_feature_id:l surface_type:s surface_area:d tilt:d azimuth:d height:d is_valid:b is_planar:b is_party_wall:b neighbour_building_id:l geom:g created_at:t")
BUILDING_LINK = table("object_id:s osm_id:s match_type:h match_confidence:d source_layer:s country_code:s srid:i geom:m")
PIPELINE_STATUS = table("object_id:s country_code:s stage:s status:s updated_at:t")
TABULA = table(
    "id:i Code_BuildingVariant:s Number_BuildingVariant:i Year1_Building:i Year2_Building:i V_C:f A_C_National:f n_Storey:f Code_ComplexFootprint:s Code_AttachedNeighbours:s "
    "Code_ComplexRoof:s A_Roof_1:f A_Roof_2:f A_Wall_1:f A_Wall_2:f A_Wall_3:f A_C_ExtDim:f Code_BuildingSizeClass:s"
)
TABULA_VARIANT = table(
    "tabula_variant_code_id:i tabula_variant_code:s max_volume:d total_area:d construction_year_1:i construction_year_2:i footprint_area:d number_of_storeys:i footprint_complexity:i "
    "attached_neighbour_class:i roof_complexity:i area_total_roof:d area_total_wall:d area_total_floor:d building_size_class:i"
)
NEIGHBOURS = table("building_id_a:l building_id_b:l")
OSM_LAYER = table("osm_id:s geom:m")
