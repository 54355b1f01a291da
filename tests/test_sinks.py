"""Writers and table entries."""

import os

from pyspark.sql import functions as F

from conftest import SF
from snapvault.operators.projections import add_snapshot, project_strings
from snapvault.sinks import writers as W
from snapvault.sinks.filesize import cut_by_bytes
from snapvault.sources.tables import scan_exported


def _orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


def test_write_full_replaces(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders")
    df = add_snapshot(project_strings(_orders(spark)), "20240101000000Z")
    W.write_full(df, path)
    W.write_full(df, path)
    back = spark.read.parquet(path)
    assert back.count() == df.count()
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_write_incremental_is_idempotent_and_keeps_snapshots(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders")
    src = project_strings(_orders(spark))
    for snap in ("20240101000000Z", "20240101000000Z", "20240201000000Z"):
        W.write_incremental(src, path, snap)
    back = scan_exported(spark, path)
    counts = {r[0]: r[1] for r in back.groupBy("extraction_timestamp").count().collect()}
    n = src.count()
    assert counts == {"20240101000000Z": n, "20240201000000Z": n}
    assert dict(back.dtypes)["extraction_timestamp"] == "string"


def test_snapshot_filter_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders")
    src = project_strings(_orders(spark))
    W.write_incremental(src, path, "20240101000000Z")
    W.write_incremental(src, path, "20240201000000Z")
    df = scan_exported(spark, path, "20240201000000Z")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extraction_timestamp" in plan
    assert df.count() == src.count()


def test_max_records_per_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "li")
    W.write_full(spark.read.parquet(f"{SF}/lineitem.parquet").coalesce(1), path, 1000)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(per_file) == 6 and max(r["count"] for r in per_file) <= 1000


def _sizes(path):
    return sorted(os.path.getsize(os.path.join(path, n)) for n in os.listdir(path) if n.endswith(".parquet"))


def test_files_have_the_target_size_in_bytes(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    target = 24_000
    # far too small files, one far too large, and a record limit that fits the average row only
    for n, (df, limit) in enumerate([(docs.repartition(60), None), (docs.coalesce(1), None), (docs, 20)]):
        path = os.path.join(tmp_dir, f"docs{n}")
        W.write_full(df, path, limit, target_bytes=target)
        back = spark.read.schema(docs.schema).parquet(path)
        assert back.exceptAll(docs).count() == 0 and back.count() == docs.count()
        # a row longer than the target is a file of its own
        sizes = _sizes(path)
        assert len(sizes) > 4 and all(target / 2 <= s <= 2 * target for s in sizes[1:]), sizes
    path = os.path.join(tmp_dir, "inc")
    for _ in range(2):
        W.write_incremental(docs.repartition(40), path, "20240101000000Z", target_bytes=target)
    assert scan_exported(spark, path).count() == docs.count()
    W.write_full(docs.limit(0), os.path.join(tmp_dir, "none"), target_bytes=target)
    assert spark.read.parquet(os.path.join(tmp_dir, "none")).count() == 0


def test_cut_files_keep_their_order_across_blocks(spark, tmp_dir):
    path = os.path.join(tmp_dir, "li")
    src = spark.read.parquet(f"{SF}/lineitem.parquet").coalesce(1).withColumn("n", F.monotonically_increasing_id())
    src.write.parquet(path)
    files = [(n, os.path.getsize(os.path.join(path, n))) for n in os.listdir(path) if n.endswith(".parquet")]
    cut, pieces = cut_by_bytes(spark, path, files, files[0][1] // 7, block_rows=500)
    got = [(r["p"], r["n"]) for r in cut.select(F.spark_partition_id().alias("p"), "n").collect()]
    assert pieces == 7 and len({p for p, _ in got}) == 7
    assert [n for _, n in got] == list(range(src.count()))


def test_added_columns_and_moves_change_the_entry_in_place(spark, tmp_dir):
    db = "sv_test_in_place"
    W.ensure_database(spark, db, location=os.path.join(tmp_dir, "db"))
    one, two = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    W.write_full(df, one)
    W.write_full(df.selectExpr("k", "v", "'y' AS w"), two)
    W.register_table(spark, db, "t", [("k", "int"), ("v", "string")], one, "full")
    created = _created(spark, db)
    wider = [("k", "int"), ("v", "string"), ("w", "string")]
    assert W.register_table(spark, db, "t", wider, one, "full") == "updated"
    assert [tuple(r) for r in spark.table(f"{db}.t").collect()] == [(1, "x", None)]
    assert W.register_table(spark, db, "t", wider, two, "full", description="moved") == "updated"
    assert [tuple(r) for r in spark.table(f"{db}.t").collect()] == [(1, "x", "y")]
    assert _created(spark, db) == created  # never dropped
    # a column that goes needs a new entry; files stay
    assert W.register_table(spark, db, "t", wider[:1] + wider[2:], two, "full") == "updated"
    assert spark.table(f"{db}.t").columns == ["k", "w"]
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db}").collect()] == ["t"]


def _created(spark, db):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.t").where("col_name = 'Created Time'").collect()
    return rows[0]["data_type"]


def test_a_replacement_killed_between_its_renames_is_finished(spark, tmp_dir):
    db, path = "sv_test_swap", os.path.join(tmp_dir, "t")
    W.ensure_database(spark, db, location=os.path.join(tmp_dir, "db"))
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    W.write_incremental(df, path, "20240101000000Z")
    old = [("k", "int"), ("v", "string"), ("extraction_timestamp", "string")]
    new = [("k", "bigint"), ("extraction_timestamp", "string")]
    for renamed in (False, True):
        W.register_table(spark, db, "t", old, path, "incremental")
        W._create(spark, db, "t" + W.NEXT, new, path, "incremental", "", None)
        if renamed:
            spark.sql(f"ALTER TABLE {db}.t RENAME TO {db}.t{W.FORMER}")
        assert W.register_table(spark, db, "t", old if not renamed else new, path, "incremental") == "unchanged"
        assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db}").collect()] == ["t"]
        assert spark.sql(f"SHOW PARTITIONS {db}.t").count() == 1
    assert dict(spark.table(f"{db}.t").dtypes)["k"] == "bigint"


def test_database_and_table_entries(spark, tmp_dir):
    db = "sv_test_entries"
    W.ensure_database(spark, db, comment="Catalog for shop", location=os.path.join(tmp_dir, "db"))
    W.ensure_database(spark, db, comment="Catalog for shop")  # exists: fine
    path = os.path.join(tmp_dir, "orders")
    df = add_snapshot(project_strings(_orders(spark)), "20240101000000Z")
    W.write_incremental(df, path)
    cols = W.table_columns(df, "incremental")
    assert W.register_table(spark, db, "orders", cols, path, "incremental", "o_orderkey", "Imported") == "created"
    assert spark.table(f"{db}.orders").count() == df.count()
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {db}.orders").collect()}
    assert props["source_primary_key"] == "o_orderkey" and props["extraction_key"] == "extraction_timestamp"
    assert W.register_table(spark, db, "orders", cols, path, "incremental", "o_orderkey") == "unchanged"
    # a new snapshot appears after refreshing partitions
    W.write_incremental(df, path, "20240301000000Z")
    W.refresh_partitions(spark, db, "orders")
    assert spark.table(f"{db}.orders").count() == 2 * df.count()
    # drift: a column added at the source
    wider = cols[:-1] + [("o_comment", "string"), cols[-1]]
    assert W.register_table(spark, db, "orders", wider, path, "incremental", "o_orderkey") == "updated"
    assert "o_comment" in spark.table(f"{db}.orders").columns
    assert W.drop_table_and_data(spark, db, "orders") == "dropped"
    assert not spark.catalog.tableExists(f"{db}.orders") and not os.path.exists(path)
    assert W.drop_table_and_data(spark, db, "orders") == "not_found"


def test_small_targets_take_few_tasks(spark, tmp_dir):
    """Many new files are written by as many tasks as the data asks for, not one each."""
    path, df = os.path.join(tmp_dir, "t"), spark.range(0, 200_000, 1, 3).selectExpr("id", "sha2(string(id), 256) AS s")
    W.write_full(df, path, target_bytes=64 << 10)
    back = spark.read.parquet(path)
    per_file = back.selectExpr("_metadata.file_name AS f", "_metadata.file_size AS size", "id").groupBy("f").agg({"size": "max", "id": "count"}).collect()
    assert len(per_file) > 50 and sum(r["count(id)"] for r in per_file) == 200_000 == back.distinct().count()
    assert sum(r["max(size)"] < 32 << 10 for r in per_file) <= 1 and all(r["max(size)"] <= 128 << 10 for r in per_file)
    # a task's files have one name behind their number
    assert len({r["f"].split("-part-", 1)[1].split("-", 2)[2] for r in per_file}) <= spark.sparkContext.defaultParallelism
    assert back.columns == ["id", "s"]
