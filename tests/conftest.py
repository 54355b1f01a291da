import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="sv-test-ckpt-")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("snapvault-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", ckpt)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="sv-test-wh-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sv-test-")


@pytest.fixture(scope="session")
def catalog(spark):
    """Catalog fixture (FIXTURES.md §2): literal rows shaped like catalog views."""
    from snapvault.sources.catalog import catalog_from_rows
    return catalog_from_rows(
        spark,
        sys_schemas=[(1, "dbo"), (5, "hr"), (4, "sys"), (3, "INFORMATION_SCHEMA")],
        info_tables=[
            ("dbo", "Customers", "BASE TABLE"), ("dbo", "OrderLines", "BASE TABLE"),
            ("dbo", "Notes", "BASE TABLE"), ("dbo", "vw_Summary", "VIEW"),
            ("dbo", "aspnet_Users", "BASE TABLE"), ("dbo", "ASPNET_Roles", "BASE TABLE"),
            ("hr", "Employees", "BASE TABLE"), ("hr", "Customers", "BASE TABLE"),
            ("dbo", "Huge", "BASE TABLE"),
        ],
        sys_tables=[(101, 1, "Customers"), (102, 1, "OrderLines"), (103, 1, "Notes"),
                    (104, 1, "aspnet_Users"), (105, 1, "ASPNET_Roles"), (201, 5, "Employees"),
                    (202, 5, "Customers"), (106, 1, "Huge")],
        sys_columns=[(101, 1, "CustomerId"), (101, 2, "Name"),
                     (102, 1, "LineNo"), (102, 2, "OrderId"), (102, 3, "Qty"),
                     (103, 1, "Body"), (104, 1, "UserId"), (105, 1, "RoleId"),
                     (201, 1, "EmpId"), (201, 2, "rv"), (202, 1, "Id"), (106, 1, "HugeId")],
        sys_indexes=[(101, 1, True), (102, 1, True), (102, 2, False), (103, 0, False),
                     (104, 1, True), (105, 1, True), (201, 1, True), (202, 1, True), (106, 1, True)],
        sys_index_columns=[(101, 1, 1, 1), (102, 1, 2, 1), (102, 1, 1, 2), (102, 2, 3, 1),
                           (104, 1, 1, 1), (105, 1, 1, 1), (201, 1, 1, 1), (202, 1, 1, 1), (106, 1, 1, 1)],
        sys_partitions=[(1001, 101, 1, 700), (1002, 101, 1, 300),      # two partitions, different sizes
                        (1003, 102, 1, 50), (1004, 102, 1, 50),        # two equal partitions
                        (1005, 103, 0, 0),                             # empty heap
                        (1006, 102, 2, 100),                           # secondary index: ignored
                        (1007, 104, 1, 5), (1008, 106, 1, 2)],
        sys_allocation_units=[(1001, "IN_ROW_DATA"), (1001, "LOB_DATA"), (1002, "IN_ROW_DATA"),
                              (1003, "IN_ROW_DATA"), (1004, "IN_ROW_DATA"), (1005, "IN_ROW_DATA"),
                              (1006, "IN_ROW_DATA"), (1007, "IN_ROW_DATA"), (1008, "IN_ROW_DATA")],
        info_columns=[
            ("dbo", "Customers", "CustomerId", "int", 1), ("dbo", "Customers", "Name", "nvarchar", 2),
            ("dbo", "OrderLines", "LineNo", "int", 1), ("dbo", "OrderLines", "OrderId", "bigint", 2),
            ("dbo", "OrderLines", "Qty", "decimal", 3), ("dbo", "Notes", "Body", "text", 1),
            ("hr", "Employees", "EmpId", "int", 1), ("hr", "Employees", "rv", "rowversion", 2),
            ("dbo", "AllTypes", "c_bit", "bit", 1), ("dbo", "AllTypes", "c_tiny", "tinyint", 2),
            ("dbo", "AllTypes", "c_small", "smallint", 3), ("dbo", "AllTypes", "c_int", "int", 4),
            ("dbo", "AllTypes", "c_big", "bigint", 5), ("dbo", "AllTypes", "c_float", "float", 6),
            ("dbo", "AllTypes", "c_real", "real", 7), ("dbo", "AllTypes", "c_dec", "decimal", 8),
            ("dbo", "AllTypes", "c_num", "numeric", 9), ("dbo", "AllTypes", "c_char", "char", 10),
            ("dbo", "AllTypes", "c_varchar", "varchar", 11), ("dbo", "AllTypes", "c_nvarchar", "nvarchar", 12),
            ("dbo", "AllTypes", "c_text", "text", 13), ("dbo", "AllTypes", "c_date", "date", 14),
            ("dbo", "AllTypes", "c_dt", "datetime", 15), ("dbo", "AllTypes", "c_dt2", "datetime2", 16),
            ("dbo", "AllTypes", "c_sdt", "smalldatetime", 17), ("dbo", "AllTypes", "c_ts", "timestamp", 18),
            ("dbo", "AllTypes", "c_guid", "uniqueidentifier", 19), ("dbo", "AllTypes", "c_xml", "xml", 20),
        ],
        space_used=[("dbo", "Customers", "1000", "1,024 KB", "1,000 KB"),
                    ("dbo", "OrderLines", "100", "0 KB", "0 KB"),
                    ("dbo", "Notes", "0", "0 KB", "0 KB"),
                    ("dbo", "Huge", "2", "40,960 KB", "40,960 KB"),
                    ("hr", "Employees", "10", "16 KB", "8 KB")],
        sys_views=[(301, "vw_Summary"), (302, "vw_aspnet_X"), (303, "vwXaspnet_Y"), (304, "vw_Null")],
        sys_sql_modules=[(301, "SELECT 1 AS one"), (302, "SELECT 2"), (303, "SELECT 3"), (304, None)],
    )
