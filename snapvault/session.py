"""Session helpers: UTC clock, shared scratch folder, checkpoint directory.

Everything the library writes for its own bookkeeping (checkpoints, scratch
exports in tests) lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local runs,
tests) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str = "local[*]", app: str = "snapvault", **conf) -> SparkSession:
    """Build (or reuse) a session configured the way the library expects."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")  # concurrent table exports share the cluster
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session clock to UTC; snapshot ids and string casts depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Read from the session; set our own only where the cluster named none.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the setting
        configured = spark.conf.get(_CHECKPOINT_KEY, None)
        if not configured:
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a shared folder for this session")
        return configured.removeprefix("file:")
    current = sc.getCheckpointDir()
    if current:
        return current.removeprefix("file:")
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        # executors of a cluster could not see a folder of the driver's own
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="snapvault-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).removeprefix("file:")


def local_frame(spark: SparkSession, rows, schema) -> DataFrame:
    """A small DataFrame of driver-side rows (catalog metadata, run status).

    Built from an Arrow table, so Spark plans it as a ``LocalRelation`` with
    exact size statistics: joins against it are broadcast by Catalyst's own
    size check (``autoBroadcastJoinThreshold``), and broadcasting it runs no
    job.  ``createDataFrame`` from a Python list instead yields an RDD scan
    of unknown size, which Catalyst must shuffle like a large table.  Above
    ``spark.sql.execution.arrow.localRelationThreshold`` Spark itself
    switches to a distributed relation, so the rows' size stays checked.
    """
    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    rows = [tuple(r) for r in rows]
    try:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow_schema = to_arrow_schema(struct)
        columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow_schema)]
        table = pa.Table.from_arrays(columns, schema=arrow_schema)
        return spark.createDataFrame(table, schema=struct)
    except ImportError:  # no pyarrow: the plain (RDD-backed) path
        return spark.createDataFrame(rows, struct)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    root = shared_root(spark)
    return os.path.join(root, "scratch", f"{label}-{uuid.uuid4().hex[:12]}")
