"""Scalar functions against plain-Python definitions (FIXTURES.md §3)."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from snapvault.functions import values as V


def py_decode(b, order=("cp1252", "utf-8", "latin1")):
    if b is None:
        return None
    for enc in order:
        try:
            return bytes(b).decode(enc)
        except UnicodeDecodeError:
            continue
    raise AssertionError("latin1 never fails")


def _text_bytes():
    rng = random.Random(7)
    rows = [
        (1, b"plain ascii"), (2, b"caf\xe9"), (3, b"\x80uro"), (4, b"a\xc2\x81"),
        (5, b"\x81\xff"), (6, "€".encode("utf-8")), (7, b""), (8, None),
        (9, "naïve – “quotes”".encode("utf-8")), (10, "日本語".encode("utf-8")),
    ]
    for i in range(3000):
        n = rng.randint(0, 12)
        rows.append((100 + i, bytes(rng.randint(0, 255) for _ in range(n))))
    return rows


@pytest.mark.parametrize("prefer,order", [
    ("cp1252", ("cp1252", "utf-8", "latin1")),
    ("utf-8", ("utf-8", "cp1252", "latin1")),
])
def test_decode_text_matches_python_chain(spark, prefer, order):
    rows = _text_bytes()
    df = spark.createDataFrame(rows, "id int, b binary")
    got = {r["id"]: r["t"] for r in df.select("id", V.decode_text("b", prefer=prefer).alias("t")).collect()}
    bad = [(i, b) for i, b in rows if got[i] != py_decode(b, order)]
    assert not bad, bad[:5]


def test_decode_text_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, b"x")], "id int, b binary").select(V.decode_text("b").alias("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_rowversion_hex(spark):
    rows = [(1, bytes(8)), (2, b"\xff" * 8), (3, None), (4, bytes.fromhex("00000000000007d1"))]
    df = spark.createDataFrame(rows, "id int, rv binary")
    got = {r["id"]: r["h"] for r in df.select("id", V.rowversion_hex("rv").alias("h")).collect()}
    assert got == {1: "0" * 16, 2: "f" * 16, 3: None, 4: "00000000000007d1"}


def test_long_to_rowversion_roundtrip(spark):
    df = spark.range(0, 2000, 37).select("id", V.rowversion_hex(V.long_to_rowversion("id")).alias("h"))
    for r in df.collect():
        assert r["h"] == f"{r['id']:016x}"


def test_parse_and_format_size(spark):
    df = spark.createDataFrame([("1,024 KB",), ("0 KB",), ("40,960 KB",), ("7 kb",)], "s string")
    assert [r[0] for r in df.select(V.parse_size_kb("s")).collect()] == [1024.0, 0.0, 40960.0, 7.0]
    df2 = spark.createDataFrame([(1024,), (0,), (1234567,)], "n long")
    assert [r[0] for r in df2.select(V.format_size_kb("n")).collect()] == ["1,024 KB", "0 KB", "1,234,567 KB"]


def py_rows_per_chunk(rows, kb, mb, at_least_one=True):
    if rows == 0 or kb == 0:
        return 0
    n = int((mb * 1024) / (kb / rows))
    return max(n, 1) if at_least_one else n


def py_num_chunks(rows, n):
    return (rows + n - 1) // n if n else 1


def test_rows_per_chunk_and_num_chunks_property(spark):
    rng = random.Random(11)
    cases = [(0, 10.0, 10.0), (10, 0.0, 10.0), (1000, 1024.0, 10.0), (1001, 1024.0, 1.0),
             (2, 40960.0, 10.0), (10240, 10240.0, 10.0), (10241, 10240.0, 10.0)]
    cases += [(rng.randint(0, 10**7), float(rng.randint(0, 10**7)), rng.choice([0.25, 1.0, 10.0, 64.0]))
              for _ in range(500)]
    df = spark.createDataFrame(cases, "rows long, kb double, mb double")
    out = df.select("rows", "kb", "mb",
                    V.rows_per_chunk("rows", "kb", F.col("mb")).alias("n"),
                    V.rows_per_chunk("rows", "kb", F.col("mb"), at_least_one=False).alias("raw")).collect()
    for r in out:
        assert r["n"] == py_rows_per_chunk(r["rows"], r["kb"], r["mb"]), r
        assert r["raw"] == py_rows_per_chunk(r["rows"], r["kb"], r["mb"], False), r
    # a row bigger than the target: 0 chunks rows originally (table skipped), 1 with at_least_one
    big = [r for r in out if r["rows"] == 2 and r["kb"] == 40960.0][0]
    assert big["raw"] == 0 and big["n"] == 1
    chunks = df.select("rows", V.rows_per_chunk("rows", "kb", F.col("mb")).alias("n")) \
        .select("rows", "n", V.num_chunks("rows", "n").alias("c")).collect()
    for r in chunks:
        assert r["c"] == py_num_chunks(r["rows"], r["n"])
        if r["n"] and r["rows"]:
            # chunks tile 1..rows: no gap, no overlap
            assert (r["c"] - 1) * r["n"] < r["rows"] <= r["c"] * r["n"]


def test_map_type(spark, catalog):
    got = {r["column_name"]: r["t"] for r in
           catalog.info_columns.where("table_name = 'AllTypes'")
           .select("column_name", V.map_type("data_type").alias("t")).collect()}
    assert got == {
        "c_bit": "boolean", "c_tiny": "int", "c_small": "int", "c_int": "int", "c_big": "bigint",
        "c_float": "double", "c_real": "double", "c_dec": "decimal", "c_num": "decimal",
        "c_char": "string", "c_varchar": "string", "c_nvarchar": "string", "c_text": "string",
        "c_date": "timestamp", "c_dt": "timestamp", "c_dt2": "timestamp", "c_sdt": "timestamp",
        "c_ts": "string", "c_guid": "string", "c_xml": "string",
    }


def test_split_name(spark):
    df = spark.createDataFrame([("dbo.Orders",), ("hr.my.table",), ("plain",), (None,)], "n string")
    s, t = V.split_name("n")
    assert [tuple(r) for r in df.select(s, t).collect()] == [
        ("dbo", "Orders"), ("hr", "my.table"), (None, "plain"), (None, None)]


def test_snapshot_id_is_utc(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "ts timestamp_ntz")
    assert df.select(V.snapshot_id("ts")).first()[0] == "20240102030405Z"


def test_is_landing_key_target_path_failure_message(spark):
    df = spark.createDataFrame([("db/backup.BAK",), ("x.bak.gz",), ("y.bak",)], "k string")
    assert [r[0] for r in df.select(V.is_landing_key("k")).collect()] == [True, False, True]
    one = spark.range(1).select(
        V.target_path("s3a://bucket/", "shop", "orders").alias("p"),
        V.failure_message(F.lit("orders")).alias("m")).first()
    assert one["p"] == "s3a://bucket/shop/orders/"
    assert one["m"] == "Failed to extract data for orders table."


def test_row_size_kb(spark):
    df = spark.createDataFrame([(0, 10.0), (4, 10.0), (4, 0.0)], "r long, k double")
    got = [r[0] for r in df.select(V.row_size_kb("r", "k")).collect()]
    assert got[0] == 0.0 and math.isclose(got[1], 2.5) and got[2] == 0.0


def test_project_typed_keeps_source_decimals(spark):
    from decimal import Decimal
    from snapvault.operators.projections import project_typed
    df = spark.createDataFrame([(Decimal("123456789012345678901234.56"), "12.5", "1")],
                               "d decimal(30,2), t string, b string")
    out = project_typed(df, {"d": "decimal", "t": "decimal", "b": "boolean"}, decimals={"t": (10, 3)})
    assert dict(out.dtypes) == {"d": "decimal(30,2)", "t": "decimal(10,3)", "b": "boolean"}
    row = out.first()
    assert row["d"] == Decimal("123456789012345678901234.56") and row["t"] == Decimal("12.500") and row["b"] is True


def test_project_strings_null_policies(spark):
    import datetime as dt
    from decimal import Decimal
    from snapvault.operators.projections import project_strings
    rows = [(1, 2.5, True, Decimal("3.10"), dt.datetime(2024, 1, 2, 3, 4, 5), "x", None),
            (None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "i int, d double, b boolean, m decimal(10,2), ts timestamp_ntz, s string, n string")
    keep = project_strings(df).collect()
    assert tuple(keep[0]) == ("1", "2.5", "true", "3.10", "2024-01-02 03:04:05", "x", None)
    assert all(v is None for v in keep[1])
    lit = project_strings(df, null_policy="literal").collect()
    assert all(v == "None" for v in lit[1]) and lit[0]["n"] == "None"


def test_project_strings_odd_column_names(spark):
    from snapvault.operators.projections import project_strings
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    out = project_strings(df)
    assert out.columns == ["a.b", "c`d"] and tuple(out.first()) == ("1", "2")
