"""Fixed values that must equal the behaviour being reproduced.

Fixed values (do not edit):
  * snapshot id format: UTC ``yyyyMMddHHmmss`` followed by a literal ``Z``
  * failure message: ``Failed to extract data for {table} table.``
  * system schemas never exported: ``sys``, ``INFORMATION_SCHEMA``
  * name patterns never exported: tables ``aspnet%``, views ``vw_aspnet%``
  * row-version source types: ``timestamp``, ``rowversion``
  * failed run states: ``FAILED``, ``TIMED_OUT``, ``ABORTED``
  * status-event detail type: ``Step Functions Execution Status Change``
  * snapshot retention: infrequent tier after 90 days, archive after 365,
    expiry after 730
  * table properties written with every exported table (below)

The Windows-1252 byte table is not written out by hand: it is derived from
Python's standard ``cp1252`` codec, the public definition of that charset.
"""

from __future__ import annotations

SNAPSHOT_FORMAT = "yyyyMMddHHmmss'Z'"
SNAPSHOT_FORMAT_PY = "%Y%m%d%H%M%SZ"
FAILURE_MESSAGE_FORMAT = "Failed to extract data for %s table."
SYSTEM_SCHEMAS = ("sys", "INFORMATION_SCHEMA")
EXCLUDED_TABLE_PATTERNS = ("aspnet%",)
EXCLUDED_VIEW_PATTERNS = ("vw_aspnet%",)
ROWVERSION_TYPES = ("timestamp", "rowversion")
FAILED_STATES = ("FAILED", "TIMED_OUT", "ABORTED")
STATUS_DETAIL_TYPE = "Step Functions Execution Status Change"
RETENTION_INFREQUENT_DAYS = 90
RETENTION_ARCHIVE_DAYS = 365
RETENTION_EXPIRE_DAYS = 730
SNAPSHOT_COLUMN = "extraction_timestamp"
ROW_NUMBER_COLUMN = "rn"
DEFAULT_TARGET_FILE_MB = 10.0
DEFAULT_MAX_CONCURRENCY = 5


def table_properties(primary_key: str) -> dict[str, str]:
    """Properties stored with every exported table."""
    return {
        "classification": "parquet",
        "source_primary_key": primary_key,
        "extraction_key": SNAPSHOT_COLUMN,
        "extraction_timestamp_column_name": SNAPSHOT_COLUMN,
        "extraction_timestamp_column_dtype": "string",
    }


def _cp1252_high_range():
    """Bytes 0x80-0x9F: which are undefined in cp1252, and what the rest mean."""
    undefined, defined_bytes, defined_chars = [], [], []
    for b in range(0x80, 0xA0):
        try:
            ch = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            undefined.append(chr(b))
            continue
        if ch != chr(b):
            defined_bytes.append(chr(b))
            defined_chars.append(ch)
    return tuple(undefined), tuple(defined_bytes), tuple(defined_chars)


CP1252_UNDEFINED_BYTES, CP1252_HIGH_BYTES, CP1252_HIGH_CHARS = _cp1252_high_range()
