"""Catalog access (O11, P13): tables served by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_table(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame under a catalog name for SQL users."""
    df.createOrReplaceTempView(name)
    return df


def catalog_select_all(spark: SparkSession, name: str) -> DataFrame:
    """``SELECT * FROM <name>`` on a catalog table or view."""
    return spark.sql("SELECT * FROM IDENTIFIER(:t)", args={"t": name})
