"""Reading the corpus tables and cutting a plan by a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from muster.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read back.

    It cuts the lineage: a lost executor costs a re-read of files, not a re-run of the steps before.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
