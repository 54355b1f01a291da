"""Catalog operators: listings, primary keys, table statistics, views.

All of them are joins and aggregations over catalog DataFrames; none pulls
rows to the driver.  Catalog frames are tiny next to the data, so Catalyst's
size-checked broadcast (``autoBroadcastJoinThreshold``) picks the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.functions.fixed import (
    EXCLUDED_TABLE_PATTERNS,
    EXCLUDED_VIEW_PATTERNS,
    ROWVERSION_TYPES,
    SYSTEM_SCHEMAS,
)
from snapvault.operators.projections import filter_pattern
from snapvault.sources.catalog import Catalog


def list_schemas(sys_schemas: DataFrame, system=SYSTEM_SCHEMAS) -> DataFrame:
    """Names of non-system schemas."""
    return sys_schemas.where(~F.col("name").isin(*system)).select(F.col("name").alias("schema_name"))


def list_tables(info_tables: DataFrame, exclude=EXCLUDED_TABLE_PATTERNS, schema: str | None = None) -> DataFrame:
    """Base tables, minus names matching the exclusion patterns."""
    df = info_tables.where(F.col("table_type") == "BASE TABLE")
    if schema is not None:
        df = df.where(F.col("table_schema") == schema)
    return filter_pattern(df, "table_name", exclude).select("table_schema", "table_name")


def list_columns(info_columns: DataFrame, schema: str | None = None, table: str | None = None) -> DataFrame:
    """Column names and types of one table (or of all tables when not given)."""
    df = info_columns
    if schema is not None:
        df = df.where(F.col("table_schema") == schema)
    if table is not None:
        df = df.where(F.col("table_name") == table)
    return df.select("table_schema", "table_name", "column_name", "data_type", "ordinal_position")


def rowversion_columns(info_columns: DataFrame, schema: str | None = None, table: str | None = None) -> DataFrame:
    """Columns holding binary row-version counters, in the table's own schema."""
    df = list_columns(info_columns, schema, table)
    return df.where(F.lower("data_type").isin(*ROWVERSION_TYPES)).select("table_schema", "table_name", "column_name")


def primary_keys(cat: Catalog, schema: str | None = None, exclude=EXCLUDED_TABLE_PATTERNS) -> DataFrame:
    """Every base table with its ordered primary-key columns (empty if keyless).

    indexes(is_primary_key) ⋈ index_columns ⋈ columns ⋈ tables ⋈ schemas,
    then a left join from all tables, so keyless tables keep an empty list.
    """
    key_cols = (
        cat.sys_indexes.where(F.col("is_primary_key"))
        .join(cat.sys_index_columns, ["object_id", "index_id"])
        .join(cat.sys_columns.withColumnRenamed("name", "column_name"), ["object_id", "column_id"])
        .join(cat.sys_tables.withColumnRenamed("name", "table_name"), "object_id")
        .join(cat.sys_schemas.withColumnRenamed("name", "table_schema"), "schema_id")
    )
    key_cols = filter_pattern(key_cols, "table_name", exclude)
    ordered = key_cols.groupBy("table_schema", "table_name").agg(
        # ordered key list: sort (ordinal, name) pairs, keep names; bounded by key width
        F.transform(
            F.array_sort(F.collect_list(F.struct("key_ordinal", "column_name"))),
            lambda s: s["column_name"],
        ).alias("primary_key")
    )
    tables = list_tables(cat.info_tables, exclude, schema)
    return tables.join(ordered, ["table_schema", "table_name"], "left").select(
        "table_schema", "table_name",
        F.coalesce("primary_key", F.array().cast("array<string>")).alias("primary_key"),
    )


def key_string(df: DataFrame, column: str = "primary_key", alias: str = "source_primary_key") -> DataFrame:
    """Add the ``", "``-joined key list (empty text for keyless tables)."""
    return df.withColumn(alias, F.array_join(F.col(column), ", "))


def table_stats(cat: Catalog) -> DataFrame:
    """Row count per table from storage partitions of the heap or clustered index.

    tables ⋈ indexes(index_id <= 1) ⋈ partitions ⋈ allocation_units ⋈ schemas.
    The unit join fans out (several units per partition), so partitions are
    made distinct before the per-table sum; two partitions with equal counts
    are both counted.
    """
    joined = (
        cat.sys_tables.withColumnRenamed("name", "table_name")
        .join(cat.sys_indexes.where(F.col("index_id") <= 1), "object_id")
        .join(cat.sys_partitions, ["object_id", "index_id"])
        .join(cat.sys_allocation_units.select(F.col("container_id").alias("partition_id")).distinct(),
              "partition_id")
        .join(cat.sys_schemas.withColumnRenamed("name", "table_schema"), "schema_id")
    )
    per_partition = joined.select("table_schema", "table_name", "partition_id", "rows").distinct()
    return per_partition.groupBy("table_schema", "table_name").agg(
        F.sum("rows").cast("long").alias("original_row_count")
    )


def view_definitions(sys_views: DataFrame, sql_modules: DataFrame, exclude=EXCLUDED_VIEW_PATTERNS) -> DataFrame:
    """View names with their definition text, excluding the patterns, by name."""
    views = filter_pattern(sys_views, "name", exclude)
    return (views.join(sql_modules, "object_id")
            .select(F.col("name").alias("view_name"), F.col("definition").alias("view_definition"))
            .orderBy("view_name"))


def catalog_columns_union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
