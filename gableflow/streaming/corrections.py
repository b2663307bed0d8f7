"""Corrections and new models as streams: each micro-batch goes through the same functions as a batch job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.corrections import apply_corrections
from ..operators.rows import first_by


def split_edits(edits: DataFrame) -> dict[str, DataFrame]:
    """edits (building_feature_id, kind, number, footprint, at) -> the last edit of each building and kind, by kind."""
    last = first_by(edits, ["building_feature_id", "kind"], [F.col("at").desc_nulls_last(), F.col("number").desc_nulls_last()])
    of = lambda kind, column, name: last.where(F.col("kind") == kind).select("building_feature_id", F.col(column).alias(name))
    return {
        "footprints": of("footprint", "footprint", "new_footprint"),
        "room_heights": of("room_height", "number", "new_room_height"),
        "storeys": last.where("kind = 'storeys'").select("building_feature_id", F.col("number").cast("int").alias("new_storeys")),
    }


def correct_stream(edits: DataFrame, read: Callable[[], DataFrame], write: Callable[[DataFrame], None], variants: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
    """Apply a stream of edits to the building table: read gives the current table, write replaces it.

    A batch that is run again gives the same table, as an edit sets values and adds nothing.
    """

    def batch(df: DataFrame, _: int) -> None:
        write(apply_corrections(read(), variants, **split_edits(df)))

    return edits.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def extract_stream(source: DataFrame, work: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Incremental extraction: work gets every batch of new rows once, up to what is there now."""
    return source.writeStream.foreachBatch(lambda df, _: work(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
