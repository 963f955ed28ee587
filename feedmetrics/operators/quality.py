"""Data quality scores and table checks."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedmetrics.schemas import QUALITY_TABLES, SILVER


def filled_cells(schema: T.StructType) -> Column:
    """How many cells of a row hold a value: not null and, for text, not empty."""

    def filled(field: T.StructField) -> Column:
        cell = F.col(f"`{field.name}`")
        present = cell.isNotNull()
        if isinstance(field.dataType, T.StringType):
            present = present & (cell != "")
        return present.cast("bigint")

    return reduce(lambda left, right: left + right, map(filled, schema))


def score(totals: DataFrame, columns: int | Column) -> DataFrame:
    """Completes row_count and non_null_cell_count to a full score.

    The score is 0-100 and rounds half to even; a table without rows has no
    columns, no cells and a score of zero.
    """
    width = columns if isinstance(columns, Column) else F.lit(columns)
    width = F.when(F.col("row_count") > 0, width).otherwise(0).cast("bigint")
    cells = F.col("row_count") * width
    share = F.bround(F.col("non_null_cell_count") / F.nullif(cells, F.lit(0)) * 100, 2)
    return totals.withColumns({"column_count": width, "total_cell_count": cells,
                               "data_quality_score": F.coalesce(share, F.lit(0.0))})


def quality_score(df: DataFrame) -> DataFrame:
    """One row with the score of a table, by one pass of partial sums."""
    totals = df.agg(F.count(F.lit(1)).alias("row_count"),
                    F.coalesce(F.sum(filled_cells(df.schema)), F.lit(0)).alias("non_null_cell_count"))
    return score(totals, len(df.columns))


def _report_columns(scored: DataFrame, platform: str, data_date: str, ingest_date: str,
                    processed_at: str) -> DataFrame:
    return scored.withColumns({
        "platform": F.lit(platform), "data_date": F.lit(data_date), "ingest_date": F.lit(ingest_date),
        "silver_processed_at_utc": F.lit(processed_at)}).select(*SILVER["data_quality_report"].names)


def quality_report(tables: Mapping[str, DataFrame], platform: str, data_date: str,
                   ingest_date: str, processed_at: str) -> DataFrame:
    """One row per silver table, also for an empty one."""
    scored = reduce(DataFrame.unionByName, (
        quality_score(tables[name]).withColumn("table_name", F.lit(name)) for name in QUALITY_TABLES))
    return _report_columns(scored, platform, data_date, ingest_date, processed_at)


def report_of_writes(spark: SparkSession, written: Mapping[str, Mapping], platform: str, data_date: str,
                     ingest_date: str, processed_at: str) -> DataFrame:
    """The same report out of the counts the silver writes took themselves."""
    totals = spark.createDataFrame(
        [(name, written[name]["row_count"], written[name]["non_null_cell_count"], len(SILVER[name]))
         for name in QUALITY_TABLES],
        "table_name string, row_count bigint, non_null_cell_count bigint, width bigint")
    return _report_columns(score(totals, F.col("width")), platform, data_date, ingest_date, processed_at)


def column_contract(df: DataFrame, schema: T.StructType) -> tuple[list[str], list[str]]:
    """(missing, extra) column names against the expected layout."""
    actual, expected = set(df.columns), set(schema.names)
    return sorted(expected - actual), sorted(actual - expected)


def check_columns(name: str, df: DataFrame, schema: T.StructType) -> None:
    missing, extra = column_contract(df, schema)
    if missing or extra:
        raise ValueError(f"{name} has other columns than its layout: without {missing}, with {extra}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the layout: absent ones null, others dropped."""
    return df.select(*(
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema))
