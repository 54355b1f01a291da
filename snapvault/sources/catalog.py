"""Catalog metadata as DataFrames.

The export planner needs the same facts a relational catalog offers: schemas,
base tables, columns and types, primary-key indexes, row counts per storage
partition and space used.  ``Catalog`` holds one DataFrame per catalog view,
with the column names of those views.  A JDBC source fills it from the
server's catalog views; a Parquet source derives it from the files themselves
(``catalog_from_tables``): names and types from the Parquet schema, row counts
and sizes by aggregating the data, so the catalog always describes what is
really there.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.session import local_frame



class Catalog:
    """One DataFrame per catalog view, built on first use.

    Views (columns as in ``CATALOG_SCHEMAS``): sys_schemas, info_tables,
    sys_tables, sys_columns, sys_indexes, sys_index_columns, sys_partitions,
    sys_allocation_units, info_columns, space_used, sys_views,
    sys_sql_modules.  Each is given as a DataFrame or as a function that
    builds one, so a listing that needs one view builds (or, over JDBC,
    queries) only that view.
    """

    def __init__(self, **views):
        unknown = set(views) - set(CATALOG_SCHEMAS)
        if unknown:
            raise TypeError(f"unknown catalog views: {sorted(unknown)}")
        self._views = dict(views)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in CATALOG_SCHEMAS:
            raise AttributeError(name)
        view = self._views.get(name)
        if view is None:
            raise AttributeError(f"catalog view {name} was not provided")
        if not isinstance(view, DataFrame):
            view = view()
            self._views[name] = view
        return view


CATALOG_SCHEMAS = {
    "sys_schemas": "schema_id int, name string",
    "info_tables": "table_schema string, table_name string, table_type string",
    "sys_tables": "object_id int, schema_id int, name string",
    "sys_columns": "object_id int, column_id int, name string",
    "sys_indexes": "object_id int, index_id int, is_primary_key boolean",
    "sys_index_columns": "object_id int, index_id int, column_id int, key_ordinal int",
    "sys_partitions": "partition_id long, object_id int, index_id int, rows long",
    "sys_allocation_units": "container_id long, type_desc string",
    "info_columns": "table_schema string, table_name string, column_name string, data_type string, ordinal_position int",
    "space_used": "table_schema string, table_name string, rows string, reserved string, data string",
    "sys_views": "object_id int, name string",
    "sys_sql_modules": "object_id int, definition string",
}


def catalog_from_rows(spark: SparkSession, **rows) -> Catalog:
    """Build a catalog from literal rows (tests, or metadata fetched elsewhere)."""
    def build(name, schema):
        return lambda: local_frame(spark, rows.get(name, []), schema)
    return Catalog(**{name: build(name, schema) for name, schema in CATALOG_SCHEMAS.items()})


# ---------------------------------------------------------------- Spark type -> source type names

def source_type_name(dt: T.DataType) -> str:
    """The relational type a Spark column would have had in the source."""
    if isinstance(dt, T.BooleanType):
        return "bit"
    if isinstance(dt, T.ByteType):
        return "tinyint"
    if isinstance(dt, T.ShortType):
        return "smallint"
    if isinstance(dt, T.IntegerType):
        return "int"
    if isinstance(dt, T.LongType):
        return "bigint"
    if isinstance(dt, T.FloatType):
        return "real"
    if isinstance(dt, T.DoubleType):
        return "float"
    if isinstance(dt, T.DecimalType):
        return "decimal"
    if isinstance(dt, T.StringType):
        return "nvarchar"
    if isinstance(dt, T.BinaryType):
        return "varbinary"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "datetime2"
    return "varbinary"  # arrays, maps, structs: no relational counterpart


#: Stored bytes of a value of these types.
_WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


def fixed_width(dt: T.DataType) -> int:
    """Stored bytes of one value of a fixed-width type; 0 for the others."""
    return next((width for kind, width in _WIDTHS.items() if isinstance(dt, kind)), 0)


def value_bytes(field: T.StructField):
    """Stored bytes of one value; NULL takes none.  Used for space estimates."""
    c, dt = F.col(field.name), field.dataType
    if fixed_width(dt):
        return F.when(c.isNull(), 0).otherwise(fixed_width(dt)).cast("long")
    if isinstance(dt, T.StringType):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    if isinstance(dt, T.BinaryType):
        return F.coalesce(F.length(c), F.lit(0)).cast("long")
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, (T.FloatType, T.IntegerType)):
        return F.coalesce(F.size(c) * 4, F.lit(0)).cast("long")
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, (T.DoubleType, T.LongType)):
        return F.coalesce(F.size(c) * 8, F.lit(0)).cast("long")
    return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("long")


def row_bytes(df: DataFrame):
    """Stored bytes of one row of ``df`` (sum over its columns)."""
    return reduce(lambda a, b: a + b, [value_bytes(f) for f in df.schema.fields], F.lit(0).cast("long"))


def tagged_rows(df: DataFrame, tags: dict, measure=None) -> DataFrame:
    """Every row of ``df`` as (tag columns..., n = 1, bytes).

    ``tags`` maps output column -> literal or Column (a table name, a
    snapshot).  With ``measure=None`` no column of ``df`` is read (Parquet
    then reads no column data, only row counts).
    """
    return df.select(
        *[(v if isinstance(v, Column) else F.lit(v)).cast("string").alias(k) for k, v in tags.items()],
        F.lit(1).cast("long").alias("n"),
        (measure if measure is not None else F.lit(0)).cast("long").alias("bytes"),
    )


PROFILES = ("exact", "files", "none")
UNION_BATCH = 64


def grouped_counts(frames: list[DataFrame], keys: list[str], expected=None) -> DataFrame:
    """Row count and bytes per key over many tagged tables, in one aggregate.

    ``frames`` come from ``tagged_rows``; ``expected`` is a small frame of
    key tuples that must appear even when they have no rows (an empty table
    counts 0).  All tables feed one map stage; partial aggregation leaves
    one row per key and task before the single shuffle, so a table holding
    a third of all rows reaches the exchange as one row per task.
    """
    parts = list(frames)
    if expected is not None:
        parts.append(expected.select(*keys, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bytes")))
    union = reduce(DataFrame.unionByName, parts)
    return union.groupBy(*keys).agg(F.sum("n").cast("long").alias("rows"),
                                    F.sum("bytes").cast("long").alias("bytes"))


def grouped_counts_in_batches(spark: SparkSession, frames: list[DataFrame], keys: list[str],
                              expected_rows: list[tuple], batch: int = UNION_BATCH) -> list:
    """``grouped_counts`` collected ``batch`` tables per job.

    The result is one row per key (metadata).  A union over thousands of
    tables would be one huge plan; batches keep every plan small while each
    job still scans its tables in parallel.  ``expected_rows`` line up with
    ``frames`` (the keys each table must report).
    """
    schema = ", ".join(f"{k} string" for k in keys)
    rows = []
    for i in range(0, len(frames), batch):
        expected = local_frame(spark, expected_rows[i:i + batch], schema)
        rows.extend(grouped_counts(frames[i:i + batch], keys, expected).collect())
    return rows


def _profile_mode(profile) -> str:
    if profile is True:
        return "exact"
    if profile in (False, None):
        return "none"
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}")
    return profile


def catalog_from_tables(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    keys: dict[str, list[str]] | None = None,
    schema: str = "dbo",
    views: dict[str, str] | None = None,
    profile="exact",
    stored_bytes: dict[str, int] | None = None,
    measured: dict[str, tuple[int, int]] | None = None,
) -> Catalog:
    """Derive a catalog for DataFrames (usually Parquet tables) in one schema.

    ``keys`` declares primary keys (table -> ordered key columns).  Row counts
    and space figures depend on ``profile``:

    * ``exact``: one aggregation per table (all union-ed into a single job)
      adds up the stored bytes of every value: exact, but reads all data;
    * ``files``: row counts from Parquet footers and sizes from the bytes the
      files take on storage (``stored_bytes``): no column data is read, so
      planning stays cheap at any scale;
    * ``none``: left empty (listings only).

    ``measured`` gives (rows, bytes) of every table where the source has found
    them itself.
    """
    mode = _profile_mode(profile)
    if mode == "files" and stored_bytes is None and measured is None:
        raise ValueError("no stored sizes are known for the profile 'files': use 'exact', which reads all data")
    keys = keys or {}
    views = views or {}
    schema_rows = [(1, schema), (3, "INFORMATION_SCHEMA"), (4, "sys")]
    table_rows, sys_table_rows, col_rows, info_col_rows = [], [], [], []
    index_rows, index_col_rows, unit_rows = [], [], []
    for i, (name, df) in enumerate(sorted(tables.items())):
        object_id = 1000 + i
        table_rows.append((schema, name, "BASE TABLE"))
        sys_table_rows.append((object_id, 1, name))
        positions = {}
        for j, field in enumerate(df.schema.fields, start=1):
            positions[field.name] = j
            col_rows.append((object_id, j, field.name))
            info_col_rows.append((schema, name, field.name, source_type_name(field.dataType), j))
        pk = keys.get(name, [])
        index_rows.append((object_id, 1 if pk else 0, bool(pk)))
        for ordinal, column in enumerate(pk, start=1):
            index_col_rows.append((object_id, 1, positions[column], ordinal))
    view_rows, module_rows = [], []
    for k, (vname, definition) in enumerate(sorted(views.items())):
        view_rows.append((5000 + k, vname))
        module_rows.append((5000 + k, definition))

    def frame(name, rows):
        return lambda: local_frame(spark, rows, CATALOG_SCHEMAS[name])

    part_rows, space_rows = [], []
    if mode != "none" and tables:
        exact = mode == "exact"
        names = sorted(tables)
        if measured is None:
            tagged = [tagged_rows(tables[n], {"table_name": n}, row_bytes(tables[n]) if exact else None)
                      for n in names]
            # one job per batch of tables scans them all in parallel; the result
            # is one row per table (catalog metadata, bounded by the table
            # count), so it is materialised once and every view below reuses it
            counted = grouped_counts_in_batches(spark, tagged, ["table_name"], [(n,) for n in names])
            measured = {r["table_name"]: (r["rows"], r["bytes"] if exact else int(stored_bytes.get(r["table_name"], 0)))
                        for r in counted}
        for i, name in enumerate(sorted(tables)):
            object_id = 1000 + i
            rows, nbytes = measured[name]
            has_key = bool(keys.get(name))
            partition_id = object_id * 100 + 1  # one storage partition per table
            part_rows.append((partition_id, object_id, 1 if has_key else 0, rows))
            unit_rows.append((partition_id, "IN_ROW_DATA"))
            if any(isinstance(f.dataType, T.StringType) for f in tables[name].schema.fields):
                unit_rows.append((partition_id, "LOB_DATA"))  # text lives in large-object pages
            kb = f"{math.ceil(nbytes / 1024.0):,} KB"
            space_rows.append((schema, name, str(rows), kb, kb))
    sys_tables = frame("sys_tables", sys_table_rows)
    sys_indexes = frame("sys_indexes", index_rows)
    partitions = frame("sys_partitions", part_rows)
    space = frame("space_used", space_rows)
    return Catalog(
        sys_schemas=frame("sys_schemas", schema_rows),
        info_tables=frame("info_tables", table_rows),
        sys_tables=sys_tables,
        sys_columns=frame("sys_columns", col_rows),
        sys_indexes=sys_indexes,
        sys_index_columns=frame("sys_index_columns", index_col_rows),
        sys_partitions=partitions,
        sys_allocation_units=frame("sys_allocation_units", unit_rows),
        info_columns=frame("info_columns", info_col_rows),
        space_used=space,
        sys_views=frame("sys_views", view_rows),
        sys_sql_modules=frame("sys_sql_modules", module_rows),
    )
