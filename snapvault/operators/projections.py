"""Row filters and column projections applied on the way to the sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.functions.fixed import ROW_NUMBER_COLUMN, SNAPSHOT_COLUMN
from snapvault.functions.values import decode_text, rowversion_hex

NULL_POLICIES = ("preserve", "literal")


def _quoted(name: str) -> Column:
    """A column by its exact name (dots, spaces or backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


# ---------------------------------------------------------------- filters

def filter_pattern(df: DataFrame, column: str, patterns) -> DataFrame:
    """Drop rows whose ``column`` matches any LIKE pattern, ignoring case.

    ``%`` and ``_`` are wildcards, as in SQL LIKE.
    """
    patterns = list(patterns or [])
    if not patterns:
        return df
    hit = reduce(lambda a, b: a | b, [F.col(column).ilike(p) for p in patterns])
    return df.where(~F.coalesce(hit, F.lit(False)))


def filter_allowlist(df: DataFrame, names, schema_col: str = "table_schema", table_col: str = "table_name") -> DataFrame:
    """Keep ``schema.table`` names in the list; an empty list keeps everything.

    The list is a driver-side parameter (a handful of names), so it becomes
    an ``isin`` over (schema, table) pairs and is pushed into the scan.
    """
    names = list(names or [])
    if not names:
        return df
    pairs = []
    for n in names:
        schema, _, table = n.partition(".")
        pairs.append((schema, table) if table else (None, schema))
    conds = [
        ((F.col(schema_col) == s) if s is not None else F.lit(True)) & (F.col(table_col) == t)
        for s, t in pairs
    ]
    return df.where(reduce(lambda a, b: a | b, conds))


def filter_row_range(df: DataFrame, start_row, end_row, column: str = ROW_NUMBER_COLUMN) -> DataFrame:
    """Rows with ``start_row <= rn <= end_row`` (1-based, inclusive)."""
    return df.where(F.col(column).between(start_row, end_row))


def chunk_bounds(chunk_index: int, rows_per_chunk: int) -> tuple[int, int]:
    """Inclusive 1-based row range of one chunk."""
    start = chunk_index * rows_per_chunk + 1
    return start, start + rows_per_chunk - 1


def filter_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    """Equality on the snapshot column; a partition filter on exported tables."""
    return df.where(F.col(SNAPSHOT_COLUMN) == F.lit(snapshot))


# ---------------------------------------------------------------- projections

def _to_text(col: Column, dt: T.DataType, null_policy: str) -> Column:
    if isinstance(dt, T.BinaryType):
        text = decode_text(col)
    elif isinstance(dt, T.StringType):
        text = col
    else:
        text = col.cast("string")
    if null_policy == "literal":
        return F.coalesce(text, F.lit("None"))
    return text


def project_strings(df: DataFrame, null_policy: str = "preserve", rowversion_cols=(),
                    exclude=()) -> DataFrame:
    """Every column to text.

    Binary columns are decoded (``decode_text``) unless listed in
    ``rowversion_cols``, which become lower-case hex.  ``null_policy``:
    ``preserve`` keeps NULL; ``literal`` writes the text ``None``.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    rv = {c.lower() for c in rowversion_cols}
    out = []
    for f in df.schema.fields:
        col = _quoted(f.name)
        if f.name in exclude:
            out.append(col)
        elif f.name.lower() in rv:
            hexed = rowversion_hex(col)
            out.append((F.coalesce(hexed, F.lit("None")) if null_policy == "literal" else hexed).alias(f.name))
        else:
            out.append(_to_text(col, f.dataType, null_policy).alias(f.name))
    return df.select(*out)


def project_typed(df: DataFrame, columns: dict[str, str], decimals: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Cast text (or raw) columns to typed ones; ``columns`` maps column -> target type.

    Target types are the names ``map_type`` yields (boolean, int, bigint,
    double, decimal, string, timestamp).  A column that already is a decimal
    keeps its own precision and scale; text columns become ``decimals[col]``
    (default 38,18).
    """
    decimals = decimals or {}
    out = []
    for f in df.schema.fields:
        target = columns.get(f.name)
        col = _quoted(f.name)
        if target is None:
            out.append(col)
        elif target == "decimal" and isinstance(f.dataType, T.DecimalType) and f.name not in decimals:
            out.append(col)  # already decimal: keep the source's precision and scale
        elif target == "decimal":
            p, s = decimals.get(f.name, (38, 18))
            out.append(col.cast(T.DecimalType(p, s)).alias(f.name))
        elif target == "boolean" and isinstance(f.dataType, T.StringType):
            # bit columns arrive as 0/1 or true/false text
            low = F.lower(F.trim(col))
            out.append(F.when(low.isin("1", "true"), True).when(low.isin("0", "false"), False).alias(f.name))
        else:
            out.append(col.cast(target).alias(f.name))
    return df.select(*out)


def add_snapshot(df: DataFrame, snapshot) -> DataFrame:
    """Stamp every row with the snapshot id (a literal, or a column)."""
    value = snapshot if isinstance(snapshot, Column) else F.lit(snapshot)
    return df.withColumn(SNAPSHOT_COLUMN, value.cast("string"))


def drop_row_number(df: DataFrame, column: str = ROW_NUMBER_COLUMN) -> DataFrame:
    """Drop the helper row-number column, whatever its letter case."""
    return df.drop(*[c for c in df.columns if c.lower() == column.lower()])
