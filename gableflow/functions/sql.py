"""The library's functions under names for SQL: scalars as SQL expressions, geometry kernels as Arrow functions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .. import schema
from ..operators.batched import row_function
from ..shipping import ship
from . import kernels
from .scalars import COUNTRIES, NUMERIC

_CODES = ", ".join(f"'{k}', '{v}'" for k, v in COUNTRIES.items())
#: Name, parameters, type and expression of each scalar.
SCALARS = {
    "half_even": ("x DOUBLE", "INT", "cast(rint(x) as int)"),
    "circular_difference": ("a DOUBLE, b DOUBLE", "DOUBLE", "pmod(a - b + 180.0D, 360.0D) - 180.0D"),
    "country_code": ("name STRING", "STRING", f"try_element_at(map({_CODES}), regexp_replace(lower(trim(name)), '[ -]', '_'))"),
    "numeric_value": ("d DOUBLE, i BIGINT, s STRING", "DOUBLE", f"coalesce(d, cast(i as double), case when s rlike r'{NUMERIC}' then cast(s as double) end)"),
    "outline_complexity": ("points INT", "INT", "case when points <= 4 then 0 when points between 5 and 10 then 1 else 2 end"),
}


def _points(geom):
    return None if geom is None else [[[dict(zip("xyz", p, strict=True)) for p in ring] for ring in polygon] for polygon in geom]


def _strict(kernel):
    return lambda *values: None if any(v is None for v in values) else kernel(*map(kernels.plain, values))


#: Name, type and kernel of each geometry function; its arguments are multipolygons, or one polygon for the first two.
KERNELS = {
    "face_is_valid": (T.BooleanType(), kernels.is_valid), "face_is_planar": (T.BooleanType(), kernels.is_planar), "distance_2d": (T.DoubleType(), kernels.distance_2d),
    "overlap_area": (T.DoubleType(), kernels.overlap_area), "intersects_2d": (T.BooleanType(), kernels.intersects_2d), "intersects_3d": (T.BooleanType(), kernels.intersects_3d),
    "geometry_union": (schema.MULTIPOLYGON, lambda g: _points(kernels.union(g))), "as_wkb": (T.BinaryType(), kernels.to_wkb),
}


def register(spark: SparkSession) -> list[str]:
    """Make all functions known to the session's SQL; null in, null out. Returns their names."""
    ship(spark)
    for name, (parameters, kind, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    for name, (kind, kernel) in KERNELS.items():
        spark.udf.register(name, row_function(kind, _strict(kernel)))
    return [*SCALARS, *KERNELS]
