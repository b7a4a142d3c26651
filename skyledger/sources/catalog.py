"""Satellite-catalog CSV to bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.text import joined_fields


def read_catalog_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Catalog CSV with the columns its header names, all as text.

    `multi_line` allows line breaks inside quotes, at the price of one task per file.
    """
    return spark.read.csv(
        path, header=True, inferSchema=False, mode="PERMISSIVE", multiLine=multi_line, escape='"'
    )


def bronze_rows(catalog: DataFrame, snapshot_group: Column, snapshot_date: Column) -> DataFrame:
    """One bronze row per catalog line: the joined line and the record as JSON.

    Empty and missing fields are empty strings in both.
    """
    fields = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in catalog.columns]
    return catalog.select(
        snapshot_group.alias("snapshot_group"),
        snapshot_date.cast("date").alias("snapshot_date"),
        joined_fields(fields).alias("raw_csv_row"),
        F.to_json(F.struct(*fields)).alias("parsed_record"),
    )
