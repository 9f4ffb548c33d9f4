"""Reading the supplied Parquet tables, and small helpers that all operators share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that surrounds ids and is not part of them.
ID_SPACE = " \t\r\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` below `sf_dir`."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def clean_id(col):
    """An id without surrounding white space and letter case; null when nothing is left."""
    return F.nullif(F.lower(F.btrim(col, F.lit(ID_SPACE))), F.lit(""))


def spread(df: DataFrame) -> DataFrame:
    """`df` in as many partitions as the cluster has cores, if a small input came in fewer; for work in Python on texts.

    Large inputs have more partitions than that and are left as they are, without a shuffle, as is what comes from one.
    """
    cores, plan = df.sparkSession.sparkContext.defaultParallelism, df._jdf.queryExecution()
    if "Exchange" in plan.executedPlan().toString():  # asking for its partitions would run it
        return df
    return df.repartition(cores) if plan.toRdd().getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, of spark.checkpoint.dir.

    Only a local session without one, as in tests, gets a temporary folder, which is deleted when Python ends; a cluster
    without one is an error, since its executors could not see such a folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if named is None:
            named = tempfile.mkdtemp(prefix="tessella-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` written to the reliable checkpoint folder and read again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
