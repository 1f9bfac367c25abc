"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from rosterline.session import scratch_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark's reader touches the path.

    Python workers are told where this package lies, for sessions that were
    started elsewhere; a cluster gets the package with its job.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    Cuts the lineage and lets several consumers share one evaluation; the files
    lie where all executors see them, so a lost executor costs a re-read only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, os.path.join("llm", f"{label}-{uuid.uuid4().hex}"))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
