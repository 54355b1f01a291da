"""Catalog operators on the catalog fixture (FIXTURES.md §2)."""

from pyspark.sql import functions as F

from snapvault.operators import metadata as M


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_list_schemas(catalog):
    assert rows(M.list_schemas(catalog.sys_schemas), "schema_name") == [("dbo",), ("hr",)]


def test_list_tables_excludes_views_and_patterns_any_case(catalog):
    got = rows(M.list_tables(catalog.info_tables), "table_schema", "table_name")
    assert got == [("dbo", "Customers"), ("dbo", "Huge"), ("dbo", "Notes"), ("dbo", "OrderLines"),
                   ("hr", "Customers"), ("hr", "Employees")]
    assert rows(M.list_tables(catalog.info_tables, schema="hr"), "table_name") == [("Customers",), ("Employees",)]


def test_list_columns(catalog):
    got = rows(M.list_columns(catalog.info_columns, "dbo", "OrderLines"), "column_name", "data_type")
    assert got == [("LineNo", "int"), ("OrderId", "bigint"), ("Qty", "decimal")]


def test_rowversion_columns_use_real_schema(catalog):
    got = rows(M.rowversion_columns(catalog.info_columns), "table_schema", "table_name", "column_name")
    assert got == [("dbo", "AllTypes", "c_ts"), ("hr", "Employees", "rv")]
    assert rows(M.rowversion_columns(catalog.info_columns, "hr", "Employees"), "column_name") == [("rv",)]


def test_primary_keys_ordered_by_key_ordinal(catalog):
    pk = {(r["table_schema"], r["table_name"]): list(r["primary_key"]) for r in M.primary_keys(catalog).collect()}
    assert pk == {
        ("dbo", "Customers"): ["CustomerId"],
        ("dbo", "OrderLines"): ["OrderId", "LineNo"],   # key order, not column order
        ("dbo", "Notes"): [],                          # heap: keyless, still listed
        ("dbo", "Huge"): ["HugeId"],
        ("hr", "Employees"): ["EmpId"],
        ("hr", "Customers"): ["Id"],
    }


def test_key_string(catalog):
    ks = {r["table_name"]: r["source_primary_key"]
          for r in M.key_string(M.primary_keys(catalog, schema="dbo")).collect()}
    assert ks["OrderLines"] == "OrderId, LineNo" and ks["Notes"] == ""


def test_table_stats_sums_distinct_partitions(catalog):
    got = {(r["table_schema"], r["table_name"]): r["original_row_count"]
           for r in M.table_stats(catalog).collect()}
    assert got[("dbo", "Customers")] == 1000      # 700 + 300, despite two allocation units
    assert got[("dbo", "OrderLines")] == 100      # two equal partitions both counted
    assert got[("dbo", "Notes")] == 0             # empty heap
    assert got[("dbo", "aspnet_Users")] == 5      # counted, though never exported


def test_view_definitions_patterns_and_nulls(catalog):
    got = [tuple(r) for r in M.view_definitions(catalog.sys_views, catalog.sys_sql_modules).collect()]
    # 'vw_aspnet_X' and 'vwXaspnet_Y' both match 'vw_aspnet%' ('_' is a wildcard)
    assert got == [("vw_Null", None), ("vw_Summary", "SELECT 1 AS one")]


def test_catalog_from_parquet_tables(spark):
    from snapvault.sources.tables import ParquetSource
    src = ParquetSource(spark, "/root/testdata/sf0.001", keys={"orders": ["o_orderkey"],
                                                              "conversations": ["conv_id", "turn"]})
    cat = src.catalog(["orders", "conversations", "lineitem"])
    stats = {r["table_name"]: r["original_row_count"] for r in M.table_stats(cat).collect()}
    direct = {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").count()
              for t in ("orders", "conversations", "lineitem")}
    assert stats == direct
    pk = {r["table_name"]: list(r["primary_key"]) for r in M.primary_keys(cat).collect()}
    assert pk == {"orders": ["o_orderkey"], "conversations": ["conv_id", "turn"], "lineitem": []}
    types = {r["column_name"]: r["data_type"] for r in
             M.list_columns(cat.info_columns, "dbo", "orders").collect()}
    assert types["o_orderkey"] == "bigint" and types["o_totalprice"] == "float"
    assert types["o_orderstatus"] == "nvarchar" and types["o_orderdate"] == "datetime2"
    space = cat.space_used.where(F.col("table_name") == "orders").first()
    assert space["rows"] == str(direct["orders"]) and space["reserved"].endswith(" KB")
