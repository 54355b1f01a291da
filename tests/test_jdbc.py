"""JDBC source against an in-process, in-memory Derby database (no port)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF
from snapvault.plans.jobs import ExportConfig, run_export
from snapvault.sources.tables import JdbcSource

URL = "jdbc:derby:memory:svtest;create=true"
PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture(scope="module")
def derby(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.write.mode("overwrite").jdbc(URL, "ORDERS", properties=PROPS)
    region = spark.read.parquet(f"{SF}/region.parquet")
    region.write.mode("overwrite").jdbc(URL, "REGION", properties=PROPS)
    return JdbcSource(spark, URL, PROPS, database="derbydb", dialect="generic", schema="APP",
                      table_list=["ORDERS", "REGION"], keys={"ORDERS": ["o_orderkey"]})


def test_partitioned_read_covers_table(spark, derby):
    df = derby.table_for_export("APP", "ORDERS", ["o_orderkey"], 4)
    assert df.rdd.getNumPartitions() == 4
    src = spark.read.parquet(f"{SF}/orders.parquet")
    assert df.count() == src.count()
    assert df.select(F.sum("o_orderkey")).first()[0] == src.select(F.sum("o_orderkey")).first()[0]


def test_query_pushdown(derby):
    row = derby.query("SELECT COUNT(*) AS n FROM APP.ORDERS WHERE \"o_orderkey\" > 100").first()
    assert row[0] >= 0


def test_export_from_jdbc(spark, derby, tmp_dir):
    cfg = ExportConfig(database="derbydb", output_root=tmp_dir, snapshot="20240101000000Z",
                       target_mb=0.02, mode="incremental")
    res = run_export(derby, cfg)
    rows = {r["table_name"]: (r["original_row_count"], r["exported_row_count"], r["status"])
            for r in res.validation.collect()}
    assert rows == {"ORDERS": (1500, 1500, "MATCH"), "REGION": (5, 5, "MATCH")}
    files = [f for f in os.listdir(os.path.join(tmp_dir, "derbydb", "ORDERS", "extraction_timestamp=20240101000000Z"))
             if f.endswith(".parquet")]
    assert len(files) > 1  # several chunk files


def test_hash_split_for_composite_keys(spark, derby):
    # Derby has no CHECKSUM: use MOD over the key for the split predicate
    src = JdbcSource(spark, URL, PROPS, dialect="generic", schema="APP",
                     hash_predicate='MOD("o_orderkey" + "o_custkey", {n}) = {i}')
    df = src.table_for_export("APP", "ORDERS", ["o_custkey", "o_orderkey"], 3)
    assert df.rdd.getNumPartitions() == 3   # leading key column is numeric: range split
    assert df.count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    capped = JdbcSource(spark, URL, PROPS, dialect="generic", schema="APP", max_hash_splits=2,
                        hash_predicate='MOD(LENGTH(CAST("o_orderstatus" AS VARCHAR(8))), {n}) = {i}')
    df = capped.table_for_export("APP", "ORDERS", ["o_orderstatus"], 50)  # text key: hash split, capped
    assert df.rdd.getNumPartitions() == 2
    assert df.count() == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_hash_split_for_keyless_tables(spark, derby):
    from snapvault.plans.jobs import task_partitions
    # a keyless table is planned as one chunk, but its tasks follow its size
    cfg = ExportConfig(database="d", output_root="/unused", target_mb=10, partition_mb=100)
    assert task_partitions({"n_chunks": 1, "rows": 1000, "rows_per_chunk": 10}, cfg) == 10  # 100 chunks of 10 MB / 100 MB
    assert task_partitions({"n_chunks": 1, "rows": 1000, "rows_per_chunk": 1}, cfg) == 100
    assert task_partitions({"n_chunks": 1, "rows": 0, "rows_per_chunk": 0}, cfg) == 1
    src = JdbcSource(spark, URL, PROPS, dialect="generic", schema="APP", max_hash_splits=4,
                     hash_predicate='MOD(ABS("o_orderkey"), {n}) = {i} AND \'{cols}\' <> \'\'')
    df = src.table_for_export("APP", "ORDERS", [], 10)  # declared keyless: every column is hashed
    assert df.rdd.getNumPartitions() == 4
    want = spark.read.parquet(f"{SF}/orders.parquet")
    assert df.count() == want.count()
    assert df.select(F.sum("o_orderkey")).first()[0] == want.select(F.sum("o_orderkey")).first()[0]
    plain = JdbcSource(spark, URL, PROPS, dialect="generic", schema="APP")
    assert plain.table_for_export("APP", "ORDERS", [], 10).rdd.getNumPartitions() == 1  # no predicate: one statement


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_and_sizes_are_computed_by_the_server(spark, derby, tmp_dir):
    plan = _plan(derby.profile_plan("APP", "ORDERS"))
    assert "PushedAggregates: [COUNT(*)" in plan and "PushedGroupByExpressions: []" in plan
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    rows, size = derby.profile("APP", "ORDERS")
    exact = {r["table_name"]: r for r in derby.catalog(["ORDERS"], profile="exact").space_used.collect()}["ORDERS"]
    assert rows == orders.count() == int(exact["rows"])
    assert abs(size / 1024 - int(exact["data"].replace(",", "").split()[0])) <= 1  # ASCII text: characters are bytes
    # planning asks the server for counts only: no table is read
    listed = {r["table_name"]: r["rows"] for r in derby.catalog(profile="files").space_used.collect()}
    assert listed == {"ORDERS": "1500", "REGION": "5"}
    from snapvault.plans.jobs import plan_export
    chunks = plan_export(derby, ExportConfig(database="d", output_root=tmp_dir, target_mb=0.02)).tables
    assert {m["table_name"]: m["rows"] for m in chunks} == {"ORDERS": 1500, "REGION": 5}
    with pytest.raises(ValueError, match="exact"):
        from snapvault.sources.catalog import catalog_from_tables
        catalog_from_tables(spark, {"r": derby.table("APP", "REGION")}, profile="files")


def _split_read(source, name, pk, n):
    """Each statement's rows, by key."""
    df = source.table_for_export("APP", name, pk, n)
    parts = df.select(F.spark_partition_id().alias("p"), *[F.col(c) for c in pk]).collect()
    return df, parts


def test_text_and_composite_keys_split_without_a_predicate(spark, derby):
    words = ["", "a", "A", "é", "ß", "日本", "z'z", "zz", "Ω", "~"]
    rows = [("hot" if k % 3 else words[k % 10] + str(k), k, f"v{k}") for k in range(600)]  # two thirds share a leading value
    keyed = spark.createDataFrame(rows, "code string, part int, val string")
    keyed.write.mode("overwrite").option("createTableColumnTypes", "code VARCHAR(40), val VARCHAR(40)").jdbc(URL, "CODES", properties=PROPS)
    plain = JdbcSource(spark, URL, PROPS, dialect="generic", schema="APP")
    for pk in (["code", "part"], ["val"]):
        df, parts = _split_read(plain, "CODES", pk, 6)
        assert df.rdd.getNumPartitions() == 6
        assert sorted(map(tuple, df.collect())) == sorted(rows)
        sizes = {}
        for r in parts:
            sizes[r["p"]] = sizes.get(r["p"], 0) + 1
        assert len(sizes) == 6 and max(sizes.values()) <= 110  # the hot leading value is split
    # moments and numbers as keys of several columns
    moments = spark.sql("SELECT CAST(id % 2 AS INT) AS g, timestampadd(MICROSECOND, CAST(id AS INT), TIMESTAMP'2024-01-01 00:00:00') AS t, "
                        "CAST(id AS DECIMAL(10, 2)) / 4 AS x FROM range(50)")
    moments.write.mode("overwrite").jdbc(URL, "MOMENTS", properties=PROPS)
    for pk in (["g", "t"], ["g", "x"]):
        df, _ = _split_read(plain, "MOMENTS", pk, 4)
        assert df.rdd.getNumPartitions() == 4 and df.count() == 50 and df.select("t").distinct().count() == 50


def test_rows_with_nulls_in_a_declared_key_are_read_once(spark, derby):
    rows = [(None if k % 5 == 0 else k % 7, k) for k in range(60)]
    spark.createDataFrame(rows, "grp int, part int").write.mode("overwrite").jdbc(URL, "HOLES", properties=PROPS)
    plain = JdbcSource(spark, URL, PROPS, dialect="generic", schema="APP")
    df = plain.table_for_export("APP", "HOLES", ["grp", "part"], 4)
    assert sorted(r["part"] for r in df.collect()) == list(range(60)) and df.rdd.getNumPartitions() == 4
    spark.createDataFrame([], "code string, part int").write.mode("overwrite").option(
        "createTableColumnTypes", "code VARCHAR(40)").jdbc(URL, "NONE_YET", properties=PROPS)
    assert plain.table_for_export("APP", "NONE_YET", ["code"], 4).count() == 0


def test_text_literals_keep_their_characters_on_sql_server():
    from snapvault.sources.tables import key_range_predicates, sql_literal
    assert sql_literal("日本's", "sqlserver") == "N'日本''s'" and sql_literal("x") == "'x'"
    assert sql_literal(b"\x01\xff", "sqlserver") == "0x01ff" and sql_literal(b"\x01", "generic") == "X'01'"
    first, last = key_range_predicates(["[code]"], [["é"]], "sqlserver")
    assert "N'é'" in first and "N'é'" in last
