"""Getting the library's own code to the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def safe_unions(spark: SparkSession) -> SparkSession:
    """Spark 4.1 lets a union of children that are partitioned alike claim that partitioning although it puts out the partitions of one child after
    another's, so a window, grouping or join above it takes one key for several. Off, such a step shuffles again and is right."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a Spark application: they need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_gridloom_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="gridloom-code-"), "gridloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("gridloom", os.path.relpath(full, top)))
    sc.addPyFile(path)
    sc._gridloom_shipped = True


def kept(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the folder the cluster shares: lineage ends there, so steps that follow one another don't repeat those before."""
    spark = df.sparkSession
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", top)
    path = f"{top.rstrip('/')}/gridloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
