"""Session helpers: a session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings without which results are wrong: UTC wall clock for the TIMESTAMP_NTZ <-> epoch
# conversions, and JSON documents that repeat a key keep its last value.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}
# What our own sessions add for speed; a session that somebody else built keeps its own.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A whole-stage method above HotSpot's 8000-byte JIT limit runs interpreted; let Spark
    # fall back to per-operator codegen instead (wide JSON projections hit this).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "govlake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local session used by tests and bench.py (a cluster job gets its own)."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    shared = os.environ.get("GOVLAKE_CHECKPOINT_DIR") or (tempfile.mkdtemp(prefix="govlake-ckpt-") if is_local(master) else None)
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("GOVLAKE_DRIVER_MEMORY", "8g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    folder = {"spark.checkpoint.dir": shared} if shared else {}  # on a cluster without one, checkpoint_dir raises
    for k, v in {**folder, **TUNING_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_conf(spark)
    return spark


def ensure_session_conf(spark: SparkSession) -> None:
    """Apply the settings that results depend on; raises where the session does not take them."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
        if spark.conf.get(k) != v:
            raise RuntimeError(f"{k} must be {v}")


def is_local(master: str) -> bool:
    """True when driver and executors are one process on one machine."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Read from the session. When it is unset, a scratch folder of this machine is
    created in local mode only; on a cluster every machine would see another
    folder, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not is_local(sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines share (master {sc.master})")
        d = tempfile.mkdtemp(prefix="govlake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; any other trouble with the store is an error."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none when it isn't there."""
    fs, p = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise RuntimeError(f"could not delete {path}")


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the given folders/files (file-system metadata only, no data read)."""
    total = 0
    for p in paths:
        fs, path = _file_system(spark, p)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def size_shuffle_partitions(spark: SparkSession, paths: list[str], target_bytes: int = 256 << 20,
                            floor: int = 200) -> int:
    """Set spark.sql.shuffle.partitions from the input size (about ``target_bytes`` per partition).

    AQE then coalesces small partitions and splits skewed ones at run time; the
    initial count only has to be large enough that no partition must spill.
    """
    n = max(floor, -(-input_bytes(spark, paths) // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return n
