"""Session construction and the shared working folder.

Library code never invents its own local scratch space on a cluster: anything
that must outlive a stage (streaming checkpoints, materialised tables, cut
lineage) goes under ``spark.checkpoint.dir``, which the cluster names. Only when
that setting is unset (local tests, a laptop) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# RocksDB keeps keyed state off-heap and spills to local disk; required by
# transformWithState and the right choice for large windowed state anyway.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "keyflow") -> SparkSession:
    """Session for tests, bench and local runs (a cluster passes its own)."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or cpus
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KEYFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        # commit state changes as a changelog instead of a snapshot per batch
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _spark_context(spark: SparkSession):
    """The SparkContext of a classic session; None on Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _spark_context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        # local runs and tests only: one machine, so its temp folder is shared
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="keyflow-ckpt-"))
        root = sc.getCheckpointDir()
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the cluster's shared checkpoint dir."""
    root = _checkpoint_root(spark).rstrip("/")
    return f"{root}/keyflow/{name}-{uuid.uuid4().hex[:12]}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, written under the shared checkpoint dir and read back: for what several branches
    of a plan use. Unlike a cache it outlives the executors that made it."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_dir(spark: SparkSession, store: str) -> str:
    """The folder of a named store (Materialized.as): the same for all who name it."""
    return f"{_checkpoint_root(spark).rstrip('/')}/keyflow/stores/{store}"


def ensure_streaming_state(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB state store provider."""
    current = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    if current != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``keyflow`` importable in Python workers (``--py-files``).

    Operators that run Python on executors (``transformWithStateInPandas``
    processors) unpickle classes from this package there. The package is
    zipped once per application and added with ``addPyFile``, which ships it
    to every executor, now and for executors added later; driver-side Python
    runners find it through ``PYTHONPATH``.
    """
    sc = _spark_context(spark)
    app = sc.applicationId if sc is not None else f"connect-{spark.session_id}"
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="keyflow-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    if sc is None:  # Spark Connect: ship as a Python artifact of the session
        spark.addArtifacts(path, pyfile=True)
        _SHIPPED.add(app)
        return
    sc.addPyFile(path)
    # Driver-side Python runners (the transformWithState pre-init worker)
    # do not read addPyFile includes but do take PYTHONPATH from the
    # environment passed with each Python function.
    env = sc.environment
    env["PYTHONPATH"] = os.pathsep.join(p for p in (path, env.get("PYTHONPATH")) if p)
    _SHIPPED.add(app)
