"""Session helpers.

The library never creates its own cluster settings when a session exists: it reads
``spark.checkpoint.dir`` from the session (the shared folder the cluster names) and only
falls back to a fresh scratch folder when that setting is unset, as in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "letwise") -> SparkSession:
    """Session for local runs and tests (UI off, AQE on, UTC)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LETWISE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session. A scratch one is made only where none is set and the
    master is local; on a cluster a missing setting is an error."""
    conf = spark.sparkContext.getCheckpointDir()
    if conf:
        return conf.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="letwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context, so that their functions import wherever they
    run and whenever the session was made. Spark itself serves the file from the driver."""
    sc = spark.sparkContext
    if getattr(sc, "_letwise_shipped", False):
        return
    here = Path(__file__).resolve().parent
    packed = Path(tempfile.mkdtemp(prefix="letwise-ship-")) / f"{here.name}.zip"
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    sc.addPyFile(str(packed))
    sc._letwise_shipped = True


def literal_frame(spark: SparkSession, rows, schema):
    """A small DataFrame of literal rows built inside the JVM (an inline array of
    literal structs), so using it never needs a Python worker. ``schema`` is a
    StructType or DDL string; meant for fixed dimensions of a few dozen rows."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    st = schema if isinstance(schema, T.StructType) else T.DataType.fromDDL(schema)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, st.fields)])
        for row in rows
    ]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    return spark.range(1).select(F.inline(F.array(*structs))).select(*[f.name for f in st.fields])
