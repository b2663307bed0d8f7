"""Spatial joins as equi-joins over grid cells.

Both sides are spread over the cells that their boxes meet; rows meet in a cell, boxes are compared, and a pair is kept in
one cell only, the first that both share. Only ids and boxes travel through that join; they are made once and written.
Geometries are fetched for the pairs that are left, and an exact kernel decides. These joins are merges: a geometry made of a
few columns looks small to the planner, and must not be sent to the driver as a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions import kernels
from ..staging import written
from .batched import with_kernel
from .rows import BUILDING_CLASSES, first_by, limit_by_id

CELL = 50.0


#: A box spreads over at most SPREAD + 1 cells in each direction: a larger one is put on a grid with cells four times as wide, and so on.
SPREAD, STEP = 4, 4


def _levels(box, cell: float, pad: float):
    """The coarsening at which a box spreads over few cells: 0 for all but large ones."""
    wide = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"]) + 2 * pad
    return F.greatest(F.ceil(F.log(wide / (cell * SPREAD)) / F.log(F.lit(float(STEP)))), F.lit(0)).cast("int")


def box_pairs(left: DataFrame, right: DataFrame, cell: float = CELL, pad: float = 0.0, *, space: bool = False, order: str | None = None) -> DataFrame:
    """left (l, l_geom), right (r, r_geom), both multipolygons -> (l, r) whose boxes are within pad of each other.

    Boxes spread over the cells of their own level and, as every box is small there, of all coarser levels that exist: two
    boxes meet on the coarser one's level, where at least one of them is at home. space: boxes must meet in height too.
    order: '<' keeps l < r, '!=' drops l = r.
    """

    def boxes(df: DataFrame, k: str, grow: float) -> DataFrame:
        own = df.select(k, F.explode(F.array(G.bbox(F.col(f"{k}_geom")))).alias(f"{k}_box"))  # no filter moves below an explode, so a box is made once; one of nothing is null
        own = own.where(F.col(f"{k}_box.xmin").isNotNull()).withColumn(f"{k}_level", F.when(F.col(f"{k}_box.xmax") > F.col(f"{k}_box.xmin") - 1, _levels(F.col(f"{k}_box"), cell, grow)).otherwise(0))
        return written(own, "boxes")

    a, b = boxes(left, "l", pad), boxes(right, "r", 0.0)
    most = max((df.agg(F.max(f"{k}_level")).first()[0] or 0) for df, k in ((a, "l"), (b, "r")))
    sizes = F.array(*(F.lit(cell * STEP**i) for i in range(most + 1)))
    size = F.element_at(sizes, F.col("level") + 1)

    def spread(df: DataFrame, k: str, grow: float) -> DataFrame:
        at = df.withColumn("level", F.explode(F.sequence(F.col(f"{k}_level"), F.lit(most)))) if most else df.withColumn("level", F.lit(0))
        return at.withColumn("cell", F.explode(G.cells(F.col(f"{k}_box"), size, grow)))

    near = lambda c: (F.col(f"l_box.{c}min") - pad <= F.col(f"r_box.{c}max")) & (F.col(f"r_box.{c}min") <= F.col(f"l_box.{c}max") + pad)
    first = lambda c: F.greatest(F.floor((F.col(f"l_box.{c}min") - pad) / size), F.floor(F.col(f"r_box.{c}min") / size)) == F.col(f"cell.c{c}")
    out = spread(a, "l", pad).join(spread(b, "r", 0.0).hint("merge"), ["level", "cell"])
    out = out.where((F.greatest("l_level", "r_level") == F.col("level")) & near("x") & near("y") & first("x") & first("y"))
    if space:
        out = out.where(near("z"))
    if order:
        out = out.where(F.col("l") < F.col("r") if order == "<" else F.col("l") != F.col("r"))
    return out.select("l", "r")


def spatial_join(left: DataFrame, right: DataFrame, kernel, name: str, kind: T.DataType, *, if_touching=None, **how) -> DataFrame:
    """(l, r, name): kernel(l_geom, r_geom) on the pairs of box_pairs. if_touching: the kernel's value for geometries with a common corner, which are not sent to it."""
    pairs = box_pairs(left, right, **how).join(left.hint("merge"), "l").join(right.hint("merge"), "r")
    own = lambda a, b: None if a is None else kernel(kernels.plain(a), kernels.plain(b))
    if if_touching is None:
        return with_kernel(pairs, name, kind, own, "l_geom", "r_geom").select("l", "r", name)
    corners = lambda g: F.flatten(F.flatten(g))
    pairs = pairs.withColumn("__common", F.arrays_overlap(corners("l_geom"), corners("r_geom")))
    asked = pairs.withColumns({f"__{k}": F.when(~F.col("__common"), F.col(f"{k}_geom")) for k in "lr"})
    found = with_kernel(asked, "__found", kind, own, "__l", "__r")
    return found.select("l", "r", F.when(F.col("__common"), F.lit(if_touching)).otherwise(F.col("__found")).alias(name))


def assign_surfaces(surfaces: DataFrame, solids: DataFrame, cell: float = CELL) -> DataFrame:
    """(building_feature_id, surface_feature_id) of surfaces that share a point with a solid's shell, in space.

    A surface that touches two solids belongs to both; a feature is never its own surface.
    """
    left, right = surfaces.select(F.col("feature_id").alias("l"), F.col("geometry").alias("l_geom")), solids.select(F.col("feature_id").alias("r"), F.col("geometry").alias("r_geom"))
    own = spatial_join(left, right, kernels.intersects_3d, "meets", T.BooleanType(), if_touching=True, cell=cell, space=True, order="!=")
    return own.where("meets").select(F.col("r").alias("building_feature_id"), F.col("l").alias("surface_feature_id"))


def solids_of(feature: DataFrame, geometry: DataFrame, prop: DataFrame, lod: int = 2) -> DataFrame:
    """(feature_id, geometry) of building features that have a solid of the level of detail."""
    marked = prop.where(F.col("name") == f"lod{lod}Solid").select("feature_id").distinct()
    building = feature.where(F.col("objectclass_id").between(*BUILDING_CLASSES)).select(F.col("id").alias("feature_id"))
    return building.join(marked, "feature_id").join(geometry, "feature_id").select("feature_id", "geometry")


def surfaces_of(feature: DataFrame, geometry: DataFrame) -> DataFrame:
    """(feature_id, geometry) of features that are no buildings: another building's solid is never a surface."""
    own = feature.where(~F.col("objectclass_id").between(*BUILDING_CLASSES)).select(F.col("id").alias("feature_id"))
    return geometry.join(own, "feature_id", "left_semi").select("feature_id", "geometry")


def neighbour_pairs(buildings: DataFrame, tolerance: float = 0.5, cell: float = CELL) -> DataFrame:
    """(building_id_a, building_id_b), a < b, whose footprints are within tolerance in the plane."""
    own = buildings.where(F.size("building_footprint_geom") > 0)
    side = lambda k: own.select(F.col("building_feature_id").alias(k), F.col("building_footprint_geom").alias(f"{k}_geom"))
    found = spatial_join(side("l"), side("r"), kernels.distance_2d, "distance", T.DoubleType(), if_touching=0.0, cell=cell, pad=tolerance, order="<")
    return found.where(F.col("distance") <= tolerance).select(F.col("l").alias("building_id_a"), F.col("r").alias("building_id_b"))


def flag_neighbours(buildings: DataFrame, tolerance: float = 0.5, cell: float = CELL, pairs: DataFrame | None = None) -> DataFrame:
    """buildings with their four neighbour columns anew, whatever they held. pairs: those of neighbour_pairs, where known."""
    found = neighbour_flags(buildings, neighbour_pairs(buildings, tolerance, cell) if pairs is None else pairs).withColumnRenamed("n_neighbours", "total_attached_neighbour")
    columns = [c for c in found.columns if c != "building_feature_id"]
    return buildings.drop(*columns).join(found, "building_feature_id").select(*buildings.columns)


def neighbour_flags(buildings: DataFrame, pairs: DataFrame) -> DataFrame:
    """(building_feature_id, has_attached_neighbour, attached_neighbour_id, n_neighbours, attached_neighbour_class): both sides of every pair count."""
    both = pairs.select(F.col("building_id_a").alias("building_feature_id"), F.col("building_id_b").alias("other"))
    both = both.unionByName(pairs.select(F.col("building_id_b").alias("building_feature_id"), F.col("building_id_a").alias("other")))
    counts = both.groupBy("building_feature_id").agg(F.count("*").cast("int").alias("n"), F.sort_array(F.collect_list("other")).alias("attached_neighbour_id"))
    n = F.coalesce("n", F.lit(0))
    out = buildings.select("building_feature_id").join(counts, "building_feature_id", "left")
    return out.select("building_feature_id", (n > 0).alias("has_attached_neighbour"), "attached_neighbour_id", n.alias("n_neighbours"), F.least(n, F.lit(2)).alias("attached_neighbour_class"))


def grid_cells(buildings: DataFrame, size: float, limit: int = 0) -> DataFrame:
    """(cx, cy, building_ids): sorted ids of the buildings whose footprint meets a cell; a touch counts. limit: buildings at most, by id."""
    own = buildings.where((F.size("building_footprint_geom") > 0) & F.col("object_id").isNotNull()).select("building_feature_id", F.col("building_footprint_geom").alias("geom"))
    own = limit_by_id(own, "building_feature_id", limit)
    spread = own.withColumn("box", G.bbox(F.col("geom")))
    # a box that ends on a line touches the cell before as well
    low = lambda c: F.ceil(F.col(f"box.{c}min") / size).cast("int") - 1
    high = lambda c: F.floor(F.col(f"box.{c}max") / size).cast("int")
    spread = spread.withColumn("cx", F.explode(F.sequence(low("x"), high("x")))).withColumn("cy", F.explode(F.sequence(low("y"), high("y"))))
    rectangle = (F.size("geom") == 1) & (F.size(F.element_at("geom", 1)) == 1) & (G.area_2d(F.col("geom")) == F.expr("(box.xmax - box.xmin) * (box.ymax - box.ymin)"))
    exact = spread.where(rectangle)  # its box is the footprint
    other = with_kernel(spread.where(~rectangle), "meets", T.BooleanType(), lambda g, x, y: kernels.intersects_2d(kernels.plain(g), _cell(x, y, size)), "geom", "cx", "cy").where("meets")
    both = exact.select("building_feature_id", "cx", "cy").unionByName(other.select("building_feature_id", "cx", "cy"))
    return both.groupBy("cx", "cy").agg(F.sort_array(F.collect_list("building_feature_id")).alias("building_ids"))


def _cell(cx: int, cy: int, size: float):
    x0, y0, x1, y1 = cx * size, cy * size, (cx + 1) * size, (cy + 1) * size
    return [[[(x0, y0, 0.0), (x1, y0, 0.0), (x1, y1, 0.0), (x0, y1, 0.0), (x0, y0, 0.0)]]]


def reproject(df: DataFrame, column: str, source: int, target: int) -> DataFrame:
    """df with a multipolygon column in another coordinate system; the same system costs nothing."""
    if source == target:
        return df
    point = lambda p: dict(zip("xyz", p, strict=True))
    shape = lambda g: None if g is None else [[[point(p) for p in ring] for ring in polygon] for polygon in g]
    out = with_kernel(df, "__out", df.schema[column].dataType, lambda g: shape(kernels.transformed(kernels.plain(g), source, target)), column)
    return out.withColumn(column, F.col("__out")).drop("__out")


def link_candidates(buildings: DataFrame, layers: DataFrame, cell: float = CELL) -> DataFrame:
    """(object_id, osm_id, source_layer, confidence): overlap area by the smaller area, for footprints that meet a layer's polygons.

    layers: osm_id, source_layer, geom. A pair that only touches has confidence 0; a zero smaller area gives null.
    """
    left = buildings.where(F.size("building_footprint_geom") > 0).select(F.col("object_id").alias("l"), F.col("building_footprint_geom").alias("l_geom"))
    right = layers.select(F.struct("source_layer", "osm_id").alias("r"), F.col("geom").alias("r_geom"))
    kind = T.StructType([T.StructField("meets", T.BooleanType()), T.StructField("area", T.DoubleType())])
    found = spatial_join(left, right, lambda a, b: {"meets": (area := kernels.overlap_area(a, b)) > 0 or kernels.intersects_2d(a, b), "area": area}, "o", kind, cell=cell)
    sized = found.where("o.meets").join(left.select("l", G.area_2d(F.col("l_geom")).alias("la")), "l").join(right.select("r", G.area_2d(F.col("r_geom")).alias("ra")), "r")
    return sized.select(F.col("l").alias("object_id"), "r.osm_id", "r.source_layer", (F.col("o.area") / F.nullif(F.least("la", "ra"), F.lit(0.0))).alias("confidence"))


def best_candidates(candidates: DataFrame) -> DataFrame:
    """The best candidate of every object and layer: by confidence, nulls first, then by osm_id."""
    return first_by(candidates, ["object_id", "source_layer"], [F.col("confidence").desc_nulls_first(), F.col("osm_id")])


def link_priority(buildings: DataFrame, best: DataFrame, layers: tuple[str, ...] = ("res", "oth"), threshold: float = 0.5) -> DataFrame:
    """(object_id, osm_id, match_type, match_confidence, source_layer): the first layer whose best reaches the threshold.

    match_type 1 is a match, 2 none.
    """
    rank = F.array_position(F.array(*map(F.lit, layers)), F.col("source_layer"))
    good = first_by(best.where(F.col("confidence") >= threshold), ["object_id"], [rank])
    out = buildings.select("object_id").distinct().join(good, "object_id", "left")
    return out.select("object_id", "osm_id", F.when(F.col("osm_id").isNull(), 2).otherwise(1).cast("short").alias("match_type"), F.col("confidence").alias("match_confidence"), "source_layer")


def link_footprints(buildings: DataFrame, res: DataFrame, oth: DataFrame, *, threshold: float = 0.5, cell: float = CELL, country: str | None = None, srid: int | None = None) -> DataFrame:
    """building_link of buildings to two layers, the first preferred."""
    layers = res.withColumn("source_layer", F.lit("res")).unionByName(oth.withColumn("source_layer", F.lit("oth")))
    own = buildings.where(F.col("building_footprint_geom").isNotNull() & F.col("object_id").isNotNull())
    links = link_priority(own, best_candidates(link_candidates(own, layers, cell)), threshold=threshold)
    geom = own.select("object_id", F.col("building_footprint_geom").alias("geom"))
    return links.join(geom, "object_id").withColumns({"country_code": F.lit(country).cast("string"), "srid": F.lit(srid).cast("int")})
