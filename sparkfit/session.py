"""Session helpers: building a session, and finding shared scratch space.

Everything that writes intermediate data (checkpoints, round-trip files) goes
under the folder the cluster names in ``spark.checkpoint.dir``. A local folder
is only created when that setting is missing *and* the master is local, as in
tests; on a cluster a missing setting is an error rather than a silent write to
one machine's disk.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import weakref
import zipfile
import zlib

from pyspark.sql import DataFrame, SparkSession

# Settings for a single-machine run; a cluster run keeps its own defaults and
# only needs AQE on (it is on by default since Spark 3.2).
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Contexts whose Python workers have this package.
_shipped: weakref.WeakSet = weakref.WeakSet()

# Tables behind the frames that write_table returned.
_written: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "sparkfit", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:           # sessions without a local JVM context
        return None


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per context.

    Functions run by ``mapInArrow`` refer to the package by name, so the workers
    must be able to import it. The archive that Spark copies is removed when the
    driver ends.
    """
    context = spark.sparkContext
    if context in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    handle, path = tempfile.mkstemp(prefix="sparkfit-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    atexit.register(lambda: os.path.exists(path) and os.remove(path))
    _shipped.add(context)


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set only if unset, locally)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if sc is None or not sc.master.startswith("local"):
        raise ValueError(
            "spark.checkpoint.dir is not set; point it at a folder every "
            "executor can reach (HDFS, S3, ...) before running sparkfit jobs")
    base = tempfile.mkdtemp(prefix="sparkfit-ckpt-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Resolve the shared folder once, and hand it to the context's checkpoints."""
    base = checkpoint_base(spark)
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_database(spark: SparkSession) -> str:
    """The database of written intermediate tables. Its files are in the shared
    folder, so dropping a table removes them, and ``clear_scratch`` removes all
    that is left."""
    base = ensure_checkpoint_dir(spark)
    name = f"sparkfit_{zlib.crc32(base.encode()):08x}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{base}/sparkfit-scratch'")
    return name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder of the scratch database's location, for files
    that are not a table."""
    scratch_database(spark)
    return f"{checkpoint_base(spark)}/sparkfit-scratch/{name}-{uuid.uuid4().hex}"


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh, unique name of a table in the scratch database."""
    return f"{scratch_database(spark)}.{name.replace('-', '_')}_{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage in one job: unlike ``DataFrame.checkpoint()``, which computes
    the data once for its action and again to write the files (unless it was
    persisted first). The files live on shared storage, so a lost executor
    loses nothing. ``drop_table`` removes them once nothing reads them.
    """
    spark = df.sparkSession
    table = scratch_table(spark, name)
    df.write.format("parquet").saveAsTable(table)
    out = spark.table(table)
    _written[out] = table
    return out


def drop_table(df: DataFrame) -> None:
    """Remove a ``write_table`` result with its files (no-op for other frames)."""
    table = _written.pop(df, None)
    if table is not None:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")


def clear_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table and file of this shared folder. Frames
    that queries returned may read them: call it once results are consumed."""
    spark.sql(f"DROP DATABASE IF EXISTS {scratch_database(spark)} CASCADE")
