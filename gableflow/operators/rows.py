"""Row-set operators: what inserts, updates, deletes, limits and samples do, as plain transformations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import written

BUILDING_CLASSES = (900, 999)


def building_ids(feature: DataFrame) -> DataFrame:
    """Ids of features of a building class."""
    return feature.where(F.col("objectclass_id").between(*BUILDING_CLASSES)).select("id")


def building_classes(feature: DataFrame) -> DataFrame:
    return feature.where(F.col("objectclass_id").between(*BUILDING_CLASSES)).select("objectclass_id").distinct()


def unprocessed(ids: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """Rows of ids that done does not hold yet; null keys of done are ignored."""
    other = done.select(F.col(done_key or key).alias(key)).where(F.col(key).isNotNull())
    return ids.join(other, key, "left_anti")


def keyed_delete(df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_anti")


def upsert(old: DataFrame, new: DataFrame, *on: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """old with the rows of new in place of those with the same key; the columns in keep stay as they were in old."""
    if keep:
        former = old.select(*on, *(F.col(c).alias(f"__{c}") for c in keep))
        new = new.join(former, list(on), "left").withColumns({c: F.coalesce(f"__{c}", c) for c in keep}).select(*old.columns)
    return keyed_delete(old, new, *on).unionByName(new.select(*old.columns))


def insert_ignore(new: DataFrame, existing: DataFrame | None, keys: list[tuple[str, ...]], order: list[Column]) -> DataFrame:
    """Rows of new that may be inserted: the first by order for each of the unique keys, unless existing has the key."""
    out = new
    for key in keys:
        out = first_by(out, list(key), order)
        if existing is not None:
            out = keyed_delete(out, existing, *key)
    return out


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first by order."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def update_from(df: DataFrame, new: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """UPDATE ... FROM: columns of df taken from new where it has a row for the key."""
    other = new.select(on, F.lit(True).alias("__hit"), *(F.col(c).alias(f"__{c}") for c in columns))
    out = df.join(other, on, "left")
    return out.withColumns({c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}).select(*df.columns)


def limit_by_id(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest keys; n <= 0 means all."""
    return df if n <= 0 else df.orderBy(key).limit(n)


def id_batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """(key, batch): batches of size consecutive keys, numbered from 0; size <= 0 is one batch.

    Keys are numbered over ranges, each with its own count, so that no task sees them all.
    """
    if size <= 0:
        return df.select(key, F.lit(0).cast("long").alias("batch"))
    # written once: another run of the sort could cut the ranges elsewhere
    ranged = written(df.select(key).repartitionByRange(F.col(key)).withColumn("part", F.spark_partition_id()), "ranged-keys")
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"), F.min(key).alias("least"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("least")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(key)) - 1
    return ranged.withColumn("place", place).join(F.broadcast(before), "part").select(key, F.floor((F.col("before") + F.col("place")) / size).alias("batch"))


def sample_by_hash(df: DataFrame, key: str, n: int, seed: int = 0, within: list[str] | None = None) -> DataFrame:
    """n rows that a hash of the key picks, the same ones every time; within: n for each of these columns' values."""
    mixed = F.pmod(F.col(key).cast("long") * F.lit(2654435761) + F.lit(seed), F.lit(4294967296))
    if not within:
        return df.withColumn("__mixed", mixed).orderBy("__mixed", key).limit(n).drop("__mixed")
    rank = F.row_number().over(Window.partitionBy(*within).orderBy(mixed, key))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def row_changed(columns: list[str], old: str, new: str) -> Column:
    """Whether two row images differ in any of the columns; nulls are equal."""
    return reduce(lambda a, b: a | b, (~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in columns))


def resolved_surfaces(faces: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Surfaces that are no party walls, one face for each surface: the first building's first face."""
    own = faces.where(~F.coalesce("is_party_wall", F.lit(False)) & F.col("surface_object_id").isNotNull() & F.col("building_object_id").isNotNull())
    own = own.select("surface_object_id", "building_object_id", "building_feature_id", "surface_feature_id", F.col("classname").alias("surface_type"), "surface_area", "tilt", "azimuth", "height", "is_valid", "is_planar", "is_party_wall", "neighbour_building_id", "face_idx", "geom")
    return insert_ignore(own, existing, [("surface_object_id",)], [F.col("building_feature_id"), F.col("face_idx")]).drop("face_idx")
