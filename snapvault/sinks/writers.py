"""Writers and table management for exported snapshots.

Full mode replaces a table; incremental mode adds (or replaces) one snapshot
partition and keeps the others.  Writes are staged and committed through the
table's log (``snapvault.commits``): a failed or killed write leaves the earlier
snapshot as it was, and re-running a table or a snapshot never duplicates rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault import commits
from snapvault.functions.fixed import ROW_NUMBER_COLUMN, SNAPSHOT_COLUMN, table_properties
from snapvault.sinks.filesize import fit_files


def _writer(df: DataFrame, max_records: int | None):
    w = df.write.format("parquet")
    if max_records and max_records > 0:
        w = w.option("maxRecordsPerFile", int(max_records))
    return w


def _staged(df: DataFrame, max_records: int | None, target_bytes: int | None):
    """Write ``df`` into a staging folder, then bring its files to the target size if one is named."""
    def write(stage: str) -> list:
        _writer(df, max_records).save(stage)
        return fit_files(df.sparkSession, stage, int(target_bytes)) if target_bytes else []

    return write


def write_full(df: DataFrame, path: str, max_records_per_file: int | None = None,
               target_bytes: int | None = None) -> str:
    """Replace everything at ``path`` with ``df``, once all of it is written.

    ``target_bytes``: files off that size by more than a factor of two are cut
    anew before the commit (``snapvault.sinks.filesize``).
    """
    commits.replace(df.sparkSession, path, _staged(df, max_records_per_file, target_bytes), None)
    return path


def write_incremental(df: DataFrame, path: str, snapshot: str | None = None,
                      max_records_per_file: int | None = None, expected_version: int | None = None,
                      target_bytes: int | None = None) -> str:
    """Write ``df`` as snapshot partition(s) under ``path``; other snapshots stay.

    Exactly the snapshots present in ``df`` (or the one named, which an empty
    frame replaces too) are replaced, so a retried write does not duplicate
    rows.  ``expected_version`` fails the write (``CommitConflict``) if another
    writer has committed the named snapshot since that version was read.
    ``target_bytes`` is as in ``write_full`` and needs a named snapshot.
    """
    if target_bytes and snapshot is None:
        raise ValueError("target_bytes needs a named snapshot")
    if snapshot is not None:
        one = df.drop(SNAPSHOT_COLUMN)
        commits.replace(df.sparkSession, path, _staged(one, max_records_per_file, target_bytes), [snapshot],
                        expected_version)
        return path
    if SNAPSHOT_COLUMN not in df.columns:
        raise ValueError(f"incremental writes need a {SNAPSHOT_COLUMN} column")
    commits.replace(df.sparkSession, path,
                    lambda stage: _writer(df, max_records_per_file).partitionBy(SNAPSHOT_COLUMN).save(stage), [])
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def write_views(df: DataFrame, path: str) -> str:
    """Replace the view-definition table."""
    return write_full(df, path)


def target_records_per_file(rows_per_chunk: int | None) -> int | None:
    """The record limit a file-size target becomes (``None``: no limit)."""
    return int(rows_per_chunk) if rows_per_chunk and rows_per_chunk > 0 else None


# ---------------------------------------------------------------- catalog entries

#: Endings of the names that an entry has while it is replaced.
NEXT, FORMER = "__sv_next", "__sv_former"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, database: str, comment: str | None = None,
                    location: str | None = None) -> None:
    """Create the catalog database if it does not exist."""
    sql = f"CREATE DATABASE IF NOT EXISTS {_q(database)}"
    if comment:
        sql += f" COMMENT {_lit(comment)}"
    if location:
        sql += f" LOCATION {_lit(location)}"
    spark.sql(sql)


def _column_ddl(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"{_q(n)} {t}" for n, t in columns)


def table_columns(df: DataFrame, mode: str) -> list[tuple[str, str]]:
    """(name, type) list a table entry declares for an export of ``df``.

    The snapshot column comes last in both modes: an ordinary column in a
    full export, the partition column in an incremental one.
    """
    cols = [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name != SNAPSHOT_COLUMN]
    return cols + [(SNAPSHOT_COLUMN, "string")]


def current_columns(spark: SparkSession, database: str, table: str) -> list[tuple[str, str]] | None:
    """Declared (name, type) of an existing entry, or None."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return None
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(f"{database}.{table}")]


def register_table(spark: SparkSession, database: str, table: str, columns: list[tuple[str, str]],
                   location: str, mode: str, primary_key: str = "", description: str | None = None) -> str:
    """Create (or refresh after drift) the external table entry of an export.

    Returns ``created``, ``unchanged`` or ``updated``.  Incremental tables are
    partitioned by the snapshot column.
    """
    _finish_swap(spark, database, table)
    existing = current_columns(spark, database, table)
    if existing is not None:
        drifted = _normal(existing) != _normal(columns)  # two short lists: no job
        parted = any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{table}"))
        same_place = _same_path(spark, table_location(spark, database, table), location)
        if parted == (mode == "incremental") and same_place and not drifted:
            # files were replaced: forget the listing that the session holds
            spark.sql(f"REFRESH TABLE {_q(database)}.{_q(table)}")
            return "unchanged"
        update_metadata(spark, database, table, columns, location, mode, primary_key, description)
        return "updated"
    _create(spark, database, table, columns, location, mode, primary_key, description)
    return "created"


def _normal(columns: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Names and types as drift compares them (``schema_drift``): lower case, any order, no row number."""
    return sorted((n.lower(), t.lower()) for n, t in columns if n.lower() != ROW_NUMBER_COLUMN)


def _same_path(spark: SparkSession, a: str | None, b: str) -> bool:
    """Whether two locations are one, whatever their scheme or trailing slash."""
    def plain(x):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return a is not None and plain(a) == plain(b)


def _create(spark, database, table, columns, location, mode, primary_key, description):
    props = table_properties(primary_key)
    prop_sql = ", ".join(f"{_lit(k)} = {_lit(v)}" for k, v in props.items())
    sql = f"CREATE TABLE IF NOT EXISTS {_q(database)}.{_q(table)} ({_column_ddl(columns)}) USING parquet"
    if mode == "incremental":
        sql += f" PARTITIONED BY ({_q(SNAPSHOT_COLUMN)})"
    sql += f" LOCATION {_lit(location)}"
    if description:
        sql += f" COMMENT {_lit(description)}"
    sql += f" TBLPROPERTIES ({prop_sql})"
    spark.sql(sql)
    if mode == "incremental":
        refresh_partitions(spark, database, table)


def update_metadata(spark: SparkSession, database: str, table: str, columns, location, mode,
                    primary_key: str = "", description: str | None = None) -> None:
    """Change an external table's declared columns, location or mode (data files are untouched).

    Added columns, the commonest drift, and a new location of a full table
    change the entry in place, so readers find it all the time.  The catalog
    cannot drop or retype columns in place: there the new entry, with all its
    partitions, is made beside the old one and takes its name by two renames;
    one that was killed between them is finished by the next registration.
    """
    name = f"{_q(database)}.{_q(table)}"
    _finish_swap(spark, database, table)
    now = spark.catalog.listColumns(f"{database}.{table}") if spark.catalog.tableExists(f"{database}.{table}") else None
    if now is None:
        _create(spark, database, table, columns, location, mode, primary_key, description)
        return
    held = {c.name.lower(): c.dataType.lower() for c in now}
    same_mode = any(c.isPartition for c in now) == (mode == "incremental")
    moved = not _same_path(spark, table_location(spark, database, table), location)
    kept = set(_normal([(c.name, c.dataType) for c in now])) <= set(_normal(columns))
    if same_mode and kept and not (moved and mode == "incremental"):
        new = [(n, t) for n, t in columns if n.lower() not in held]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_column_ddl(new)})")
        if moved:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_lit(location)}")
        props = ", ".join(f"{_lit(k)} = {_lit(v)}" for k, v in table_properties(primary_key).items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")
        if description:
            spark.sql(f"COMMENT ON TABLE {name} IS {_lit(description)}")
        spark.sql(f"REFRESH TABLE {name}")
        if mode == "incremental":
            refresh_partitions(spark, database, table)
        return
    following, former = table + NEXT, table + FORMER
    _create(spark, database, following, columns, location, mode, primary_key, description)
    spark.sql(f"ALTER TABLE {name} RENAME TO {_q(database)}.{_q(former)}")
    _finish_swap(spark, database, table)


def _finish_swap(spark: SparkSession, database: str, table: str) -> None:
    """Bring a replaced entry to its end: the new one takes the free name, otherwise it never counted."""
    def exists(name: str) -> bool:
        return spark.catalog.tableExists(f"{database}.{name}")

    following, former = table + NEXT, table + FORMER
    if exists(following):
        if exists(former) and not exists(table):
            spark.sql(f"ALTER TABLE {_q(database)}.{_q(following)} RENAME TO {_q(database)}.{_q(table)}")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {_q(database)}.{_q(following)}")
    if exists(former):
        spark.sql(f"DROP TABLE IF EXISTS {_q(database)}.{_q(former)}")


def refresh_partitions(spark: SparkSession, database: str, table: str) -> None:
    """Make newly written snapshot partitions visible in the catalog."""
    spark.sql(f"ALTER TABLE {_q(database)}.{_q(table)} RECOVER PARTITIONS")


def table_location(spark: SparkSession, database: str, table: str) -> str | None:
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(database)}.{_q(table)}").where(
        F.col("col_name") == "Location").select("data_type").collect()
    return rows[0][0] if rows else None


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through the Hadoop file system API."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath) and fs.delete(hpath, True))


def drop_table_and_data(spark: SparkSession, database: str, table: str, path: str | None = None) -> str:
    """Drop the entry and its files.  Returns ``dropped`` or ``not_found``."""
    location = table_location(spark, database, table) or path
    existed = spark.catalog.tableExists(f"{database}.{table}")
    spark.sql(f"DROP TABLE IF EXISTS {_q(database)}.{_q(table)}")
    deleted = delete_path(spark, location) if location else False
    return "dropped" if (existed or deleted) else "not_found"
