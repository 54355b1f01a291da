"""Scalar column functions (Column -> Column), all native Spark expressions.

No Python UDF is used: every function stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapvault.functions.fixed import (
    CP1252_UNDEFINED_BYTES,
    CP1252_HIGH_BYTES,
    CP1252_HIGH_CHARS,
    SNAPSHOT_FORMAT,
    FAILURE_MESSAGE_FORMAT,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- decoding

def decode_text(c, prefer: str = "cp1252") -> Column:
    """Bytes -> text, trying Windows-1252, then UTF-8, then Latin-1.

    Spark's ``decode`` has no windows-1252 charset and fails on malformed
    UTF-8, so the chain is built from pieces that never fail:

    * Latin-1 decoding maps every byte to the code point of the same value.
    * Windows-1252 differs from Latin-1 only in bytes 80-9F; 27 of those map
      to other characters (a ``translate``), five are undefined.  A value is
      therefore valid cp1252 exactly when its Latin-1 text has none of the
      five undefined code points.
    * ``is_valid_utf8`` tells whether the UTF-8 reading is clean.

    ``prefer="utf-8"`` tries UTF-8 first (valid UTF-8 text round-trips).
    Text is not told from bytes here: callers pass binary columns only.
    """
    col = _col(c)
    latin1 = F.decode(col, "ISO-8859-1")
    cp1252_ok = ~latin1.rlike("[" + "".join(CP1252_UNDEFINED_BYTES) + "]")
    cp1252 = F.translate(latin1, "".join(CP1252_HIGH_BYTES), "".join(CP1252_HIGH_CHARS))
    as_utf8 = col.cast("string")
    utf8_ok = F.is_valid_utf8(as_utf8)
    if prefer == "cp1252":
        return F.when(col.isNull(), F.lit(None).cast("string")) \
            .when(cp1252_ok, cp1252) \
            .when(utf8_ok, as_utf8) \
            .otherwise(latin1)
    if prefer in ("utf-8", "utf8"):
        return F.when(col.isNull(), F.lit(None).cast("string")) \
            .when(utf8_ok, as_utf8) \
            .when(cp1252_ok, cp1252) \
            .otherwise(latin1)
    raise ValueError(f"prefer must be 'cp1252' or 'utf-8', got {prefer!r}")


def rowversion_hex(c) -> Column:
    """Binary row-version counter -> lower-case hex; NULL stays NULL."""
    return F.lower(F.hex(_col(c)))


def long_to_rowversion(c) -> Column:
    """8-byte big-endian binary of a long (how row-version counters are stored)."""
    return F.unhex(F.lpad(F.hex(_col(c).cast("long")), 16, "0"))


# ---------------------------------------------------------------- sizing

def parse_size_kb(c) -> Column:
    """``"1,024 KB"`` -> 1024.0 (thousands separators and unit removed)."""
    return F.regexp_replace(F.regexp_replace(_col(c), r"(?i)\s*KB\s*$", ""), ",", "").cast("double")


def format_size_kb(c) -> Column:
    """1024 -> ``"1,024 KB"``: the text form a space-usage report prints."""
    return F.concat(F.format_number(_col(c).cast("long"), 0), F.lit(" KB"))


def row_size_kb(rows, kb) -> Column:
    """Average row size in KB; 0.0 when rows or size is zero."""
    r, k = _col(rows).cast("double"), _col(kb).cast("double")
    return F.when((r > 0) & (k > 0), k / r).otherwise(F.lit(0.0))


def rows_per_chunk(rows, kb, target_mb, at_least_one: bool = True) -> Column:
    """Rows fitting in ``target_mb``: ``int(target_mb*1024 / row_kb)``.

    0 when rows or size is 0.  A row bigger than the target yields 0 in the
    original arithmetic; with ``at_least_one`` (default) it yields 1 so the
    table is still exported, one row per chunk.
    """
    r, k = _col(rows).cast("double"), _col(kb).cast("double")
    target = (target_mb if isinstance(target_mb, Column) else F.lit(float(target_mb))).cast("double")
    raw = F.floor(target * 1024.0 / (k / r)).cast("long")
    fitted = F.greatest(raw, F.lit(1).cast("long")) if at_least_one else raw
    return F.when((r > 0) & (k > 0), fitted).otherwise(F.lit(0).cast("long"))


def num_chunks(rows, per_chunk) -> Column:
    """Ceiling division; one chunk when there is no row limit."""
    r, n = _col(rows).cast("long"), _col(per_chunk).cast("long")
    return F.when(n > 0, ((r + n - 1) / n).cast("long")).otherwise(F.lit(1).cast("long")).cast("int")


# ---------------------------------------------------------------- names, ids

def map_type(c) -> Column:
    """Source SQL type name -> target type name (first matching rule wins).

    bit -> boolean; tinyint/smallint/int -> int; bigint -> bigint;
    float/real/double -> double; decimal/numeric -> decimal;
    char/text -> string; date/time -> timestamp, except the binary
    row-version types which become their hex string; anything else string.
    """
    t = F.lower(F.trim(_col(c)))
    return (
        F.when(t == "bit", "boolean")
        .when(t.isin("tinyint", "smallint", "int"), "int")
        .when(t == "bigint", "bigint")
        .when(t.contains("float") | t.contains("real") | t.contains("double"), "double")
        .when(t.contains("decimal") | t.contains("numeric"), "decimal")
        .when(t.contains("char") | t.contains("text"), "string")
        .when(t.isin("timestamp", "rowversion"), "string")
        .when(t.contains("date") | t.contains("time"), "timestamp")
        .otherwise("string")
    )


def split_name(c) -> tuple[Column, Column]:
    """``"schema.table"`` -> (schema, table), split at the first dot only."""
    col = _col(c)
    has_dot = F.instr(col, ".") > 0
    schema = F.when(has_dot, F.substring_index(col, ".", 1))
    table = F.when(has_dot, col.substr(F.instr(col, ".") + 1, F.length(col))).otherwise(col)
    return schema, table


def snapshot_id(c) -> Column:
    """Timestamp -> snapshot id text, UTC (session time zone must be UTC)."""
    return F.date_format(_col(c), SNAPSHOT_FORMAT)


def is_landing_key(c, suffix: str = ".bak") -> Column:
    """True when the key ends with ``suffix``, any letter case."""
    return F.lower(_col(c)).endswith(suffix.lower())


def target_path(root, database, table) -> Column:
    """``root/database/table/`` as a column."""
    parts = [p if isinstance(p, Column) else F.lit(p) for p in (root, database, table)]
    return F.concat(F.concat_ws("/", *[F.regexp_replace(p, "/+$", "") for p in parts]), F.lit("/"))


def failure_message(table) -> Column:
    """The message recorded when one table's export fails."""
    return F.format_string(FAILURE_MESSAGE_FORMAT, _col(table))
