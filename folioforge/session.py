"""Session helper and the shared folder for cut lineages.

A cluster names its shared folder in ``spark.checkpoint.dir``. The engine
reads that setting and only picks a folder of its own where it is unset
(local runs and tests).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: Defaults of :func:`local_session`; a cluster brings its own settings.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the engine's defaults (UTC, AQE, small shuffles)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("folioforge")
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    spark = (
        b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where the session has none (a local run) a temporary folder is made,
    set on the context and removed at exit.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = getattr(sc, "_folioforge_dir", None)
    if held is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        held = tempfile.mkdtemp(prefix="folioforge-")
        atexit.register(shutil.rmtree, held, ignore_errors=True)
        sc.setCheckpointDir(held)
        sc._folioforge_dir = held
    return held


def reachable(spark: SparkSession) -> None:
    """Let Python workers import the package from where the driver has it.

    Workers started later get its folder in their PYTHONPATH, whatever the
    directory that the driver was started in. A cluster without a shared file
    system is given the package with --py-files instead.
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


#: Tables that were written and not discarded yet; they are removed when the application ends.
_HELD: set[str] = set()


def _remove(path: str) -> None:
    gateway = SparkContext._gateway
    if gateway is None:
        return
    p = gateway.jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(gateway.jvm.org.apache.hadoop.conf.Configuration()).delete(p, True)


@atexit.register
def _remove_held() -> None:
    """Results may still read the tables behind them as long as the application runs; none outlives it."""
    for path in sorted(_HELD):
        try:
            _remove(path)
        except Exception:  # the driver is going down; what is left is in the shared folder
            break
    _HELD.clear()


def materialize(df: DataFrame, label: str, **options: int | str) -> DataFrame:
    """Cut the lineage: write *df* as a table in the shared folder, read it back.

    The table survives the loss of executors, is column-pruned and compressed
    when read again, and is what every loop of the engine iterates on. It is
    removed by :func:`discard`, else when the application ends. *options* are the
    writer's.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").option("compression", "zstd").options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folioforge_path = path
    _HELD.add(path)
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the table behind a DataFrame that :func:`materialize` returned."""
    path = getattr(df, "_folioforge_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        _HELD.discard(path)
