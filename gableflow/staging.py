"""Tables between the stages of a job, written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session may go without the setting."""
    here = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not here:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        here = "file://" + tempfile.mkdtemp(prefix="gableflow-")
        spark.conf.set("spark.checkpoint.dir", here)
    return here.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it again: the lineage ends at files that outlive executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by written() whose readers have all been written themselves; other DataFrames are left alone."""
    for df in tables:
        path = getattr(df, "staged", None)
        if path:
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
