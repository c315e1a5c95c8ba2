"""Session helpers: building a session for local runs and finding shared scratch space.

On a cluster the session is created by the platform; the library only reads settings
from it. ``spark.checkpoint.dir`` names the shared folder used for reliable checkpoints
and for scratch tables; a private directory is chosen only when the setting is unset
(local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tilerank") -> SparkSession:
    """Local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return tune(spark)


# Runtime SQL settings the library relies on. Constraint propagation is switched off because
# the scoring plans stack many aliased arithmetic columns, and inferring IS NOT NULL
# constraints over them grows combinatorially in the optimizer (minutes for a 20-row top-k).
RUNTIME_CONF = {
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings above to an existing session."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tilerank-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for an intermediate table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared checkpoint folder, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    For tables of many rows: a checkpoint writes whole rows as they lie in memory and reads them whole, Parquet
    writes columns packed and reads those a step asks for. Columns are numbered in the file, so any names will do;
    types that Parquet cannot hold are checkpointed.
    """
    if any(t in df.schema.simpleString() for t in ("void", "interval")):
        return cut_lineage(df)
    path = scratch_path(df.sparkSession, "table")
    names = df.columns
    numbered = df.toDF(*[f"c{i}" for i in range(len(names))])
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path).toDF(*names)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application.

    Python functions reach tasks by module name, so workers must be able to import the package
    wherever the driver was started.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tilerank_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tilerank-zip-"), "tilerank_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._tilerank_shipped = True
