"""Session helpers.

The library never creates a session inside an operator; callers pass one in.
``get_session`` is for scripts and tests.  ``checkpoint_dir`` reads the
cluster's ``spark.checkpoint.dir`` and only falls back to a private folder when
the session runs in local mode and nothing is configured (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "mercato", extra: dict | None = None,
                driver_memory: str = "8g") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.driver.memory"] = driver_memory
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application.

    Workers import the functions of Arrow UDFs by module name, and start in
    folders of their own.  Spark serves the archive from the driver.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="mercato-src-")) / "mercato_src.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent).as_posix())
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the session's ``spark.checkpoint.dir``.  When it is unset and the
    master is local (tests, benches) a private folder is created; on a cluster
    an unset value is an error, because a machine-local folder would be lost
    with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="mercato-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.  The shuffle files of the job that writes it are removed at its end:
    nothing reads them again, and they would stay on disk until the driver happens to collect its garbage."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    was = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if was is None else spark.conf.set(_FREE_SHUFFLES, was)
    return spark.read.schema(df.schema).parquet(path)


def remove_written(df: DataFrame) -> None:
    """Deletes the tables of ``written_once`` that ``df`` reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
