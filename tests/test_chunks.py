"""Chunk planning and distributed row numbering."""

from pyspark.sql import functions as F

from conftest import SF
from snapvault.operators.metadata import primary_keys
from snapvault.operators.numbering import key_ordered, row_number_pk, scan_chunked
from snapvault.operators.projections import chunk_bounds, filter_row_range
from snapvault.plans.chunks import check_ranges, chunk_files, distinct_tables, file_ranges, plan_chunks, table_sizes


def test_plan_chunks_on_fixture(catalog):
    plan = plan_chunks(table_sizes(catalog.space_used), primary_keys(catalog, schema="dbo"), "db", 0.5)
    by = {}
    for r in plan.collect():
        by.setdefault(r["table_name"], []).append((r["chunk_index"], r["start_row"], r["end_row"], r["rows_per_chunk"]))
    # Customers: 1000 rows, 1024 KB -> 1.024 KB/row -> 500 rows per 0.5 MB -> 2 chunks
    assert sorted(by["Customers"]) == [(0, 1, 500, 500), (1, 501, 1000, 500)]
    # OrderLines: size 0 KB -> no row limit -> one chunk with everything
    assert by["OrderLines"] == [(0, 1, 100, 0)]
    # Notes: keyless and empty -> one empty chunk, so an empty table is still written
    assert by["Notes"] == [(0, 1, 0, 0)]
    # Huge: a row bigger than the target -> one row per chunk, never skipped
    assert sorted(by["Huge"]) == [(0, 1, 1, 1), (1, 2, 2, 1)]
    assert sorted(r["table_name"] for r in distinct_tables(plan).collect()) == [
        "Customers", "Huge", "Notes", "OrderLines"]


def test_chunks_tile_rows_exactly(spark):
    sizes = spark.createDataFrame([("dbo", "t", 10007, 977.0)], "table_schema string, table_name string, rows long, size_kb double")
    keys = spark.createDataFrame([("dbo", "t", ["id"])], "table_schema string, table_name string, primary_key array<string>")
    plan = plan_chunks(sizes, keys, "db", 0.01).orderBy("chunk_index").collect()
    covered = []
    for r in plan:
        covered.extend(range(r["start_row"], r["end_row"] + 1))
    assert covered == list(range(1, 10008))


def test_files_hold_planned_chunks_and_others_are_told(spark, tmp_dir):
    n, per = 1003, 100
    rows = spark.range(n).selectExpr("id + 1 AS rn", "id * 7 AS k")
    plan = spark.createDataFrame([(i, i * per + 1, min((i + 1) * per, n)) for i in range(11)],
                                 "chunk_index int, start_row long, end_row long")
    for tasks in (1, 3, 50):
        path = f"{tmp_dir}/bound{tasks}"
        chunk_files(rows.repartition(5), per, 11, tasks).write.option("maxRecordsPerFile", per).parquet(path)
        got = check_ranges(plan, file_ranges(spark.read.parquet(path), ["k"])).collect()
        assert len(got) == 11 and {r["status"] for r in got} == {"BOUND"}
        assert all(r["first_key"]["k"] == 7 * (r["start_row"] - 1) for r in got)
    # files cut elsewhere: the first chunk's file is too long, the second one's rows lie in it, one begins in between
    path = f"{tmp_dir}/loose"
    rows.coalesce(1).sortWithinPartitions("rn").write.option("maxRecordsPerFile", 150).parquet(path)
    loose = [r["status"] for r in check_ranges(plan, file_ranges(spark.read.parquet(path), ["k"])).collect()]
    assert loose.count("SPLIT") == 4 and loose.count("UNPLANNED") == 3 and loose.count("MISSING") == 7
    # an empty range needs no file
    none = spark.createDataFrame([(0, 1, 0)], plan.schema)
    assert [r["status"] for r in check_ranges(none, file_ranges(rows.limit(0), ["k"])).collect()] == ["BOUND"]


def test_row_number_range_equals_window(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    a = row_number_pk(orders, ["o_orderkey"], num_partitions=6)
    b = row_number_pk(orders, ["o_orderkey"], method="window")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    a = row_number_pk(conv, ["conv_id", "turn"], num_partitions=5)
    b = row_number_pk(conv, ["conv_id", "turn"], method="window")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_row_number_spreads_a_hot_key(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    hot = li.withColumn("k", F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_orderkey")))
    numbered = row_number_pk(hot, ["k"], num_partitions=8)
    sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.3 * sum(sizes)  # the hot key (about a third) is split across tasks
    stats = numbered.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
    assert tuple(stats) == (1, li.count(), li.count())
    win = row_number_pk(hot, ["k"], method="window")
    assert numbered.select("k", "rn").exceptAll(win.select("k", "rn")).count() == 0


def test_row_number_plan_keeps_data_distributed(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    numbered = row_number_pk(orders, ["o_orderkey"], num_partitions=6)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan           # offsets: one row per partition
    assert numbered.rdd.getNumPartitions() == 6  # the table itself never collapses to one task


def test_scan_chunked_and_filter_row_range(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    chunked = scan_chunked(orders, ["o_orderkey"], 400)
    start, end = chunk_bounds(2, 400)
    assert (start, end) == (801, 1200)
    third = filter_row_range(chunked, start, end)
    assert third.count() == 400
    assert {r[0] for r in third.select("chunk_index").distinct().collect()} == {2}
    expected = orders.orderBy("o_orderkey").collect()[800:1200]
    assert [r["o_orderkey"] for r in third.orderBy("rn").collect()] == [r["o_orderkey"] for r in expected]


def test_key_ordered_files_hold_contiguous_ranges(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    parts = key_ordered(orders, ["o_orderkey"], 4)
    ranges = parts.groupBy(F.spark_partition_id().alias("p")).agg(
        F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).orderBy("lo").collect()
    assert len(ranges) == 4
    assert all(a["hi"] < b["lo"] for a, b in zip(ranges, ranges[1:]))


def test_numbers_are_the_same_after_a_retried_task_and_nothing_is_checkpointed(spark, tmp_dir):
    import os
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    before = set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:"))) if spark.sparkContext.getCheckpointDir() else set()
    numbered = row_number_pk(orders, ["o_orderkey"], num_partitions=7)
    first = {r["o_orderkey"]: r["rn"] for r in numbered.collect()}
    # a second job over the same frame, through other operators, and a frame built anew
    again = {r["o_orderkey"]: r["rn"] for r in numbered.where("o_orderkey % 3 = 0").collect()}
    anew = {r["o_orderkey"]: r["rn"] for r in row_number_pk(orders, ["o_orderkey"], num_partitions=5).collect()}
    assert first == anew and all(first[k] == v for k, v in again.items())
    assert sorted(first.values()) == list(range(1, len(first) + 1))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan  # from the source, not from a copy
    root = spark.sparkContext.getCheckpointDir()
    assert {n for n in (os.listdir(root.removeprefix("file:")) if root else [])} - before <= {"scratch"}
    small = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(os.path.join(root.removeprefix("file:"), "scratch"))
                if "splitters" in d or "range-offsets" in d for f in fs)
    assert small < 200_000

    # tasks that fail once after their rows were numbered: the retry gives the same numbers
    marks = os.path.join(tmp_dir, "marks")
    os.makedirs(marks)

    def fail_once(batches):
        import os as o
        from pyspark import TaskContext
        mark = o.path.join(marks, str(TaskContext.get().partitionId()))
        for b in batches:
            yield b
        if not o.path.exists(mark):
            open(mark, "w").close()
            raise RuntimeError("lost")
    got, failures = None, 0
    for _ in range(20):  # local masters don't retry tasks: run the job until none fails
        try:
            got = {r["o_orderkey"]: r["rn"] for r in numbered.mapInArrow(fail_once, numbered.schema).collect()}
            break
        except Exception as lost:
            assert "lost" in str(lost), lost
            failures += 1
    assert failures and got == first


def test_numbering_awkward_keys(spark):
    rows = [(None, "a", 1), (None, None, 2), (2, "b", 3), (2, "B", 4), (1, "", 5), (1, None, 6), (-5, "é", 7), (3, "z" * 5000, 8)]
    df = spark.createDataFrame([(k, s, v, 0) for k, s, v in rows], "k long, s string, v int, rn0 int")
    for n in (1, 3, 8, 40):
        got = row_number_pk(df, ["k", "s"], num_partitions=n)
        want = row_number_pk(df, ["k", "s"], method="window")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        assert got.columns == want.columns
    assert row_number_pk(df.limit(0), ["k"], num_partitions=4).count() == 0
    same = spark.range(100).selectExpr("1 AS k", "id")  # one key only: split by position
    got = row_number_pk(same, ["k"], num_partitions=4)
    assert sorted(r["rn"] for r in got.collect()) == list(range(1, 101))
    import datetime as dt
    from decimal import Decimal
    moments = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 0, k), dt.date(2024, 1, 1 + k % 28), Decimal(k) / 7, bytes([k]), k / 3, k) for k in range(50)],
        "t timestamp, d date, c decimal(12,4), b binary, f double, v int")
    for key in (["t"], ["d", "t"], ["c"], ["b"], ["f"]):
        got = row_number_pk(moments, key, num_partitions=6)
        want = row_number_pk(moments, key, method="window")
        assert sorted((r["v"], r["rn"]) for r in got.collect()) == sorted((r["v"], r["rn"]) for r in want.collect())
        assert got.groupBy(F.spark_partition_id()).count().count() > 2
