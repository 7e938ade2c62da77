"""Session helpers: building a local session for tests/bench and finding the
shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every martline job expects. On a cluster these come from the
# submit config; here they are the defaults for a fresh session.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run over ``input_bytes`` of Parquet on
    ``cores`` executor cores: scan splits and shuffle partitions of about
    ``partition_bytes`` (so a task's input fits executor memory and spills
    rarely), at least two waves of tasks, AQE coalescing small partitions and
    splitting skewed ones (a key with a third of the rows), broadcasts only
    under Spark's size check."""
    # Shuffled bytes are ~2x the compressed Parquet. Map x reduce shuffle
    # blocks grow quadratically, so past ~50k reducers partitions grow
    # instead (sorts and aggregations spill rather than fail).
    shuffle = min(50_000, max(2 * cores, -(-input_bytes * 2 // partition_bytes)))
    return {
        **DEFAULT_CONF,
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "martline", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; cluster jobs get theirs from
    spark-submit and only need ``ensure_checkpoint_dir``."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism",
                              spark.conf.get("spark.sql.shuffle.partitions", "200")))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by the deployment (a shared file system);
    only a local-mode session without one gets a fresh private folder.
    """
    sc = _context(spark)
    current = (sc.getCheckpointDir() if sc is not None else None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return (sc.getCheckpointDir() if sc is not None else None) or current
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="martline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None:
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for one job's
    intermediate table, stream checkpoint or sink."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/martline/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once to a fresh folder under the shared checkpoint folder
    and read back: later plans start from the table, whatever executors are
    lost. ``options`` of the Parquet writer."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever the driver
    was started: a zip of its sources goes to each executor, once a context."""
    sc = _context(spark)
    if sc is None or getattr(sc, "_martline_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="martline-src-"), "martline.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._martline_shipped = True


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
