"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}


def build_session(name: str = "musterline", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the jobs rely on; sizes stay with the cluster's defaults."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may go without; it gets a folder of its own below the warehouse, which goes when Python ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch-{app}"
        atexit.register(shutil.rmtree, urlparse(_local_dirs[app]).path, ignore_errors=True)
    return _local_dirs[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def hadoop(spark: SparkSession, folder: str):
    """File system of a folder, wherever it is stored, and the class of its paths."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    fs, path = hadoop(spark, folder)
    return fs.exists(path(folder))


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds; none if it does not exist."""
    fs, path = hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path(folder))) if fs.exists(path(folder)) else []


def read_small(spark: SparkSession, file: str) -> str:
    """Text of a small file, whatever its name."""
    fs, path = hadoop(spark, file)
    source = fs.open(path(file))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_small(spark: SparkSession, file: str, text: str, replace: bool = False) -> None:
    """A small file as a whole; unless it may be replaced, one that exists is an error."""
    fs, path = hadoop(spark, file)
    out = fs.create(path(file), replace)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def discard(spark: SparkSession, *folders: str) -> None:
    """Remove intermediate folders that ``scratch`` handed out, wherever they are stored."""
    base = shared_dir(spark).rstrip("/") + "/"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        if not folder.startswith(base):
            raise ValueError(f"not below the shared folder: {folder}")
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
