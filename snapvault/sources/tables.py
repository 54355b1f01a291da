"""Sources: where snapshot rows come from.

``ParquetSource`` reads a folder of Parquet tables (``<root>/<table>.parquet``
or ``<root>/<table>/``); ``JdbcSource`` reads a relational server over JDBC
with partitioned reads.  Both expose the same small surface:

* ``table(schema, name)``      -> DataFrame   (``scan_full``)
* ``query(sql)``               -> DataFrame   (``scan_query``)
* ``catalog()``                -> Catalog     (metadata DataFrames)
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import math
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.commits import FOREIGN_GLOB, committed
from snapvault.functions.fixed import SNAPSHOT_COLUMN
from snapvault.sources.catalog import Catalog, catalog_from_tables, fixed_width


def whole_bounds(lo, hi) -> tuple:
    """Bounds as Spark's range splits take them: fractions go outwards to whole numbers."""
    if isinstance(lo, (float, Decimal)) and isinstance(hi, (float, Decimal)):
        return math.floor(lo), math.ceil(hi)
    return lo, hi


def sql_literal(value, dialect: str | None = None) -> str:
    """A key value as an SQL literal of the server's dialect.

    On SQL Server text is written as ``N'...'``: without the prefix characters
    outside the code page become question marks, and bounds lose their order.
    """
    if isinstance(value, bool):
        return str(value).upper() if dialect == "generic" else str(int(value))
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'" if dialect == "generic" else "0x" + bytes(value).hex()
    if isinstance(value, dt.datetime):
        # standard SQL has a space and microseconds; SQL Server's older type reads neither
        standard = dialect == "generic"
        return f"'{value.isoformat(sep=' ' if standard else 'T', timespec='microseconds' if standard else 'milliseconds')}'"
    text = "'" + str(value).replace("'", "''") + "'"
    return "N" + text if dialect == "sqlserver" else text


def key_after(columns: list[str], values: list, dialect: str | None = None) -> str:
    """Rows whose key (``columns``, quoted already) comes after ``values``: compared column by column."""
    terms, equal = [], ""
    for c, v in zip(columns, values):
        literal = sql_literal(v, dialect)
        terms.append(f"({equal}{c} > {literal})")
        equal += f"{c} = {literal} AND "
    return "(" + " OR ".join(terms) + ")"


def key_range_predicates(columns: list[str], bounds: list, dialect: str | None = None) -> list[str]:
    """Predicates that put every row into one range between neighbouring ``bounds`` (in key order).

    All key columns are compared, so a leading value that holds much of the
    table is split as well.  Rows with a NULL in the key are in the first.
    """
    if not bounds:
        return []
    whole = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    after = [key_after(columns, b, dialect) for b in bounds]
    first = f"NOT {after[0]} OR NOT ({whole})"
    middle = [f"{whole} AND {a} AND NOT {b}" for a, b in zip(after, after[1:])]
    return [first, *middle, f"{whole} AND {after[-1]}"]


def with_rest(predicates: list[str]) -> list[str]:
    """The last predicate made to take every row that none of the others takes, NULL results included."""
    if len(predicates) < 2:
        return predicates
    others = " OR ".join(f"({p})" for p in predicates[:-1])
    return [*predicates[:-1], f"CASE WHEN {others} THEN 0 ELSE 1 END = 1"]


@dataclass
class ParquetSource:
    spark: SparkSession
    root: str
    schema: str = "dbo"
    keys: dict[str, list[str]] = field(default_factory=dict)
    views: dict[str, str] = field(default_factory=dict)
    database: str = "source"

    def table_names(self) -> list[str]:
        """Table names under the root, listed by the file system that holds it."""
        fs, root = self._file_system(self.root)
        entries = sorted(s.getPath().getName() for s in fs.listStatus(root))
        return [e.removesuffix(".parquet") for e in entries if not e.startswith(("_", "."))]

    def path(self, name: str) -> str:
        single = f"{self.root.rstrip('/')}/{name}.parquet"
        fs, found = self._file_system(single)
        return single if fs.exists(found) else f"{self.root.rstrip('/')}/{name}"

    def _file_system(self, path: str):
        sc = self.spark.sparkContext
        hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath

    def table(self, schema: str | None, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def table_for_export(self, schema: str | None, name: str, pk: list[str], n_chunks: int) -> DataFrame:
        """Parquet splits already parallelise the read."""
        return self.table(schema, name)

    def tables(self, names: list[str] | None = None) -> dict[str, DataFrame]:
        """Open several tables at once (schema discovery reads footers: I/O bound)."""
        names = list(names or self.table_names())
        with ThreadPoolExecutor(max_workers=min(8, max(1, len(names)))) as pool:
            frames = list(pool.map(lambda n: self.table(self.schema, n), names))
        return dict(zip(names, frames))

    def stored_bytes(self, names: list[str]) -> dict[str, int] | None:
        """Bytes each table takes on storage, from the file system (no data read)."""
        try:
            jvm = self.spark.sparkContext._jvm
            conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        except Exception:  # no JVM handle (remote session): measure the data instead
            return None
        def size(n):
            path = jvm.org.apache.hadoop.fs.Path(self.path(n))
            return n, int(path.getFileSystem(conf).getContentSummary(path).getLength())

        # listings are I/O bound (object stores especially): run them concurrently
        with ThreadPoolExecutor(max_workers=min(16, max(1, len(names)))) as pool:
            return dict(pool.map(size, names))

    def query(self, sql: str) -> DataFrame:
        """Run SQL over the source tables (each visible under its own name).

        Only tables that the text names are opened.
        """
        for name in self.table_names():
            if re.search(rf"(?<!\w){re.escape(name)}(?!\w)", sql, re.IGNORECASE):
                self.table(self.schema, name).createOrReplaceTempView(name)
        return self.spark.sql(sql)

    def catalog(self, names: list[str] | None = None, profile="exact") -> Catalog:
        tables = self.tables(names)
        stored = self.stored_bytes(list(tables)) if profile == "files" else None
        return catalog_from_tables(self.spark, tables, self.keys, self.schema, self.views, profile, stored)


@dataclass
class JdbcSource:
    """A relational server read over JDBC.

    Reads are split into ``num_partitions`` tasks, either on a numeric/date
    ``partition_column`` between bounds or on explicit ``predicates``; each
    task is one JDBC statement (its own transaction: read from a snapshot or
    replica when the source is live).
    """

    spark: SparkSession
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    database: str = "source"
    fetchsize: int = 10000
    dialect: str = "sqlserver"       # "sqlserver": catalog views; "generic": derived from tables
    schema: str = "dbo"
    table_list: list[str] = field(default_factory=list)   # generic dialect: tables to catalog
    keys: dict[str, list[str]] = field(default_factory=dict)
    # opt-in split for keys whose leading column is not numeric or a date,
    # and for keyless tables (then {cols} lists every column), e.g.
    # "ABS(CAST(CHECKSUM({cols}) AS BIGINT)) % {n} = {i}" on SQL Server.
    # Rows for which none of the first n - 1 predicates holds (a NULL or
    # negative residue) are read by the last split.  Such a predicate cannot use
    # an index: every split statement scans the whole table at the source;
    # max_hash_splits bounds their number (None: as many as the size asks for).
    hash_predicate: str | None = None
    max_hash_splits: int | None = None

    def quoted(self, name: str) -> str:
        """An identifier as the server's dialect quotes it."""
        if self.dialect == "sqlserver":
            return "[" + name.replace("]", "]]") + "]"
        return '"' + name.replace('"', '""') + '"'

    def qualified(self, schema: str | None, name: str) -> str:
        return ".".join(self.quoted(x) for x in (schema, name) if x)

    def _reader(self):
        reader = self.spark.read.format("jdbc").option("url", self.url).option("fetchsize", self.fetchsize)
        for k, v in self.properties.items():
            reader = reader.option(k, v)
        return reader

    def table(self, schema: str | None, name: str, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None,
              predicates: list[str] | None = None) -> DataFrame:
        qualified = self.qualified(schema, name)
        if predicates:
            props = dict(self.properties, fetchsize=str(self.fetchsize))
            return self.spark.read.jdbc(self.url, qualified, predicates=predicates, properties=props)
        reader = self._reader().option("dbtable", qualified)
        if partition_column and num_partitions and num_partitions > 1:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                      .option("numPartitions", str(num_partitions)))
        return reader.load()

    def _rangeable(self, schema: str | None, name: str, column: str) -> bool:
        """Whether ``column`` is numeric or a date/time (schema probe, no rows read)."""
        fields = {f.name: f.dataType for f in self.table(schema, name).schema.fields}
        kind = fields.get(column)
        return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                               T.DoubleType, T.DecimalType, T.DateType, T.TimestampType,
                               T.TimestampNTZType))

    def key_bounds(self, schema: str | None, name: str, column: str) -> tuple:
        """Min and max of one key column, computed by the server (one row)."""
        quoted = self.quoted(column)
        row = self.query(f"SELECT MIN({quoted}) AS lo, MAX({quoted}) AS hi FROM {self.qualified(schema, name)}").first()
        return whole_bounds(row[0], row[1])  # alias case differs by engine

    def key_splits(self, schema: str | None, name: str, pk: list[str], n: int) -> list[str]:
        """Predicates of ``n`` ranges of whole key tuples with about equally many rows.

        The server numbers the key (an index scan) and returns the last key of
        each range: ``n - 1`` rows.
        """
        cols = ", ".join(self.quoted(c) for c in pk)
        ranges = (f"SELECT {cols}, NTILE({int(n)}) OVER (ORDER BY {cols}) AS sv_range "
                  f"FROM {self.qualified(schema, name)}")
        # the last row of each range: the one before the next range begins
        last = (f"SELECT {cols}, sv_range, LEAD(sv_range) OVER (ORDER BY {cols}) AS sv_next FROM ({ranges}) r")
        rows = self.query(f"SELECT {cols}, sv_range FROM ({last}) b WHERE sv_next <> sv_range").collect()
        bounds = [list(r)[:-1] for r in sorted(rows, key=lambda r: r[len(pk)])]
        return key_range_predicates([self.quoted(c) for c in pk], bounds, self.dialect)

    def paged_key_splits(self, schema: str | None, name: str, pk: list[str], n: int) -> list[str]:
        """``key_splits`` for servers without NTILE: key-set paging with standard SQL.

        Each statement starts after the last bound and returns the key that
        many rows further on (an index range scan; together one pass over the
        index).  The driver holds ``n - 1`` keys.
        """
        columns = [self.quoted(c) for c in pk]
        cols, whole = ", ".join(columns), " AND ".join(f"{c} IS NOT NULL" for c in columns)
        total = int(self.row_count(schema, name))
        step = max(1, -(-total // max(1, int(n))))
        bounds: list[list] = []
        while len(bounds) < n - 1:
            where = whole + (f" AND {key_after(columns, bounds[-1], self.dialect)}" if bounds else "")
            row = self.query(f"SELECT {cols} FROM {self.qualified(schema, name)} WHERE {where} ORDER BY {cols} "
                             f"OFFSET {step - 1} ROWS FETCH NEXT 1 ROWS ONLY").first()
            if row is None:
                break
            bounds.append(list(row))
        return key_range_predicates(columns, bounds, self.dialect)

    def server_table(self, schema: str | None, name: str) -> DataFrame:
        """The table through Spark's JDBC catalog, which pushes aggregates down to the server."""
        options = {"url": self.url, "pushDownAggregate": "true", "fetchsize": str(self.fetchsize), **self.properties}
        catalog = "sv_jdbc_" + hashlib.sha256(json.dumps(options, sort_keys=True).encode()).hexdigest()[:16]
        prefix = f"spark.sql.catalog.{catalog}"
        if self.spark.conf.get(prefix, None) is None:
            for key, value in options.items():
                self.spark.conf.set(f"{prefix}.{key}", value)
            self.spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
        parts = [catalog, *([schema] if schema else []), name]
        return self.spark.table(".".join("`" + p.replace("`", "``") + "`" for p in parts))

    def profile_plan(self, schema: str | None, name: str) -> DataFrame:
        """Rows, and values of every column, counted by the server (one row)."""
        table = self.server_table(schema, name)
        return table.agg(F.count(F.lit(1)).alias("n"), *[F.count(f"`{c}`").alias(f"c{i}") for i, c in enumerate(table.columns)])

    def row_count(self, schema: str | None, name: str) -> int:
        """Rows of a table, counted by the server."""
        return self.server_table(schema, name).agg(F.count(F.lit(1)).alias("n")).first()["n"]

    def profile(self, schema: str | None, name: str) -> tuple[int, int]:
        """(rows, about how many bytes) of a table, from aggregates that the server computes.

        Fixed-width values count their width; text and binary ones the sum of
        their lengths.
        """
        fields = self.table(schema, name).schema.fields
        counts = self.profile_plan(schema, name).first()
        size = sum(counts[f"c{i}"] * fixed_width(f.dataType) for i, f in enumerate(fields))
        wide = [f.name for f in fields if not fixed_width(f.dataType)]
        if wide:
            length = "DATALENGTH" if self.dialect == "sqlserver" else "LENGTH"
            sums = ", ".join(f"SUM(CAST({length}({self.quoted(c)}) AS BIGINT)) AS s{i}" for i, c in enumerate(wide))
            size += sum(v or 0 for v in self.query(f"SELECT {sums} FROM {self.qualified(schema, name)}").first())
        return int(counts["n"]), int(size)

    def query(self, sql: str) -> DataFrame:
        return self._reader().option("query", sql).load()

    def table_for_export(self, schema: str | None, name: str, pk: list[str], n_chunks: int) -> DataFrame:
        """Read a table in ``n_chunks`` parallel JDBC statements when the key allows it.

        A key of one numeric or date column splits on its value range (bounds
        from one MIN/MAX statement; the splits are index range scans).  Text,
        GUID and composite keys split between whole key tuples that the server
        finds.  Keyless tables, and text keys where one is configured, split on
        ``hash_predicate`` (each statement a full scan at the source).  The
        splits are disjoint and together read the whole table.
        """
        if n_chunks > 1 and pk and self.dialect == "sqlserver" and (
                len(pk) > 1 or not self._rangeable(schema, name, pk[0])):
            return self.table(schema, name, predicates=self.key_splits(schema, name, pk, n_chunks))
        if n_chunks > 1 and pk and self.dialect != "sqlserver" and (
                len(pk) > 1 or not self.hash_predicate and not self._rangeable(schema, name, pk[0])):
            return self.table(schema, name, predicates=self.paged_key_splits(schema, name, pk, n_chunks))
        if n_chunks > 1 and pk and self._rangeable(schema, name, pk[0]):
            # the leading key column orders the clustered index: range splits
            # on it are index seeks at the source (composite keys included)
            lo, hi = self.key_bounds(schema, name, pk[0])
            if lo is not None and lo != hi:
                return self.table(schema, name, partition_column=pk[0], lower_bound=lo,
                                  upper_bound=hi, num_partitions=n_chunks)
        if n_chunks > 1 and self.hash_predicate:
            n = min(n_chunks, max(1, int(self.max_hash_splits or n_chunks)))
            if pk:
                cols = ", ".join(self.quoted(c) for c in pk)
            else:
                # a keyless table hashes every column (schema probe, no rows
                # read); equal rows land in the same split, so each row is
                # read exactly once
                fields = self.table(schema, name).schema.fieldNames()
                cols = ", ".join(self.quoted(c) for c in fields)
            preds = with_rest([self.hash_predicate.format(cols=cols, n=n, i=i) for i in range(n)])
            return self.table(schema, name, predicates=preds)
        return self.table(schema, name)

    def catalog(self, names: list[str] | None = None, profile="exact") -> Catalog:
        """Catalog of the source.

        ``sqlserver``: read from the server's catalog views (needs that
        driver; not exercised by the tests here).  ``generic``: derived from
        the listed tables like a Parquet source, keys as declared; with the
        profile ``files`` (a server has none: its counterpart) rows and sizes
        are aggregates that the server computes, with ``exact`` Spark reads all
        rows and measures them.
        """
        if self.dialect == "generic":
            tables = {n: self.table(self.schema, n) for n in (names or self.table_list)}
            measured = None
            if profile == "files":
                # each statement returns one row: the server does the work, so tables are asked at the same time
                with ThreadPoolExecutor(max_workers=min(8, max(1, len(tables)))) as pool:
                    measured = dict(zip(tables, pool.map(lambda n: self.profile(self.schema, n), tables)))
            return catalog_from_tables(self.spark, tables, self.keys, self.schema, profile=profile, measured=measured)
        q = self.query
        return Catalog(
            sys_schemas=lambda: q("SELECT schema_id, name FROM sys.schemas"),
            info_tables=lambda: q("SELECT TABLE_SCHEMA AS table_schema, TABLE_NAME AS table_name, "
                          "TABLE_TYPE AS table_type FROM INFORMATION_SCHEMA.TABLES"),
            sys_tables=lambda: q("SELECT object_id, schema_id, name FROM sys.tables"),
            sys_columns=lambda: q("SELECT object_id, column_id, name FROM sys.columns"),
            sys_indexes=lambda: q("SELECT object_id, index_id, CAST(is_primary_key AS bit) AS is_primary_key FROM sys.indexes"),
            sys_index_columns=lambda: q("SELECT object_id, index_id, column_id, key_ordinal FROM sys.index_columns"),
            sys_partitions=lambda: q("SELECT partition_id, object_id, index_id, rows FROM sys.partitions"),
            sys_allocation_units=lambda: q("SELECT container_id, type_desc FROM sys.allocation_units"),
            info_columns=lambda: q("SELECT TABLE_SCHEMA AS table_schema, TABLE_NAME AS table_name, "
                           "COLUMN_NAME AS column_name, DATA_TYPE AS data_type, "
                           "ORDINAL_POSITION AS ordinal_position FROM INFORMATION_SCHEMA.COLUMNS"),
            space_used=lambda: q(
                # rows and pages are summed apart: a partition has several allocation units
                "SELECT s.name AS table_schema, t.name AS table_name, CAST(n.n_rows AS varchar(32)) AS rows, "
                "CONCAT(FORMAT(u.total_pages * 8, 'N0'), ' KB') AS reserved, "
                "CONCAT(FORMAT(u.data_pages * 8, 'N0'), ' KB') AS data "
                "FROM sys.tables t JOIN sys.schemas s ON s.schema_id = t.schema_id "
                "JOIN (SELECT object_id, SUM(rows) AS n_rows FROM sys.partitions WHERE index_id IN (0, 1) "
                "GROUP BY object_id) n ON n.object_id = t.object_id "
                "JOIN (SELECT p.object_id, SUM(a.total_pages) AS total_pages, SUM(a.data_pages) AS data_pages "
                "FROM sys.allocation_units a JOIN sys.partitions p ON p.partition_id = a.container_id "
                "GROUP BY p.object_id) u ON u.object_id = t.object_id"),
            sys_views=lambda: q("SELECT object_id, name FROM sys.views"),
            sys_sql_modules=lambda: q("SELECT object_id, definition FROM sys.sql_modules"),
        )


def scan_full(source, table: str, schema: str | None = None) -> DataFrame:
    """Whole read of one table."""
    return source.table(schema, table)


def scan_query(source, sql: str) -> DataFrame:
    """Read the result of an arbitrary query against the source."""
    return source.query(sql)


def scan_exported(spark: SparkSession, path: str, snapshot: str | None = None,
                  merge_schema: bool = False) -> DataFrame:
    """Read an exported table back; with ``snapshot`` only that partition is read.

    Snapshot ids such as ``20240101000000Z`` end in a letter, so partition
    discovery keeps them as text.  Only committed files are read
    (``snapvault.commits``): what a write that runs, failed or was killed left
    there is passed over.  ``merge_schema`` unions the columns of snapshots
    taken before and after a schema change (it reads every footer, so it is off
    unless asked for).
    """
    root = path.rstrip("/")
    state = committed(spark, root)

    def read(glob: str, *paths: str) -> DataFrame:
        return (spark.read.option("basePath", root).option("mergeSchema", str(bool(merge_schema)).lower())
                .option("pathGlobFilter", glob).parquet(*paths))

    if not state.newest:
        df = read(FOREIGN_GLOB, root)
    else:
        df = read(state.glob(), root)
        if state.unlogged and not state.full:  # snapshots of writers without a log
            df = df.unionByName(read(FOREIGN_GLOB, *[f"{root}/{SNAPSHOT_COLUMN}={s}" for s in state.unlogged]),
                                allowMissingColumns=bool(merge_schema))
    if snapshot is not None:
        df = df.where(F.col(SNAPSHOT_COLUMN) == F.lit(snapshot))
    return df
