"""Session helpers: a tuned SparkSession and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, *, app: str = "boxwise",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew-join handling and no UI.

    On a cluster pass ``master=None`` and let the launcher decide; the
    shuffle-partition count should then be sized so that one partition is
    around 128-256 MB of shuffle data (AQE coalesces small ones).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def zip_package(path: str) -> None:
    """Write the sources to the archive ``path``.  Imports from an archive find a folder only
    if it has an ``__init__.py`` or an entry of its own, so folders are entries too."""
    package = os.path.dirname(os.path.abspath(__file__))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            sources = [n for n in sorted(names) if n.endswith(".py")]
            for name in ["", *sources] if sources else []:
                full = os.path.join(folder, name)
                z.write(full, os.path.join("boxwise", os.path.relpath(full, package)))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the workers of ``spark``, once per
    application: needed where it is not installed there.  The zipped sources
    go through Spark's own file distribution."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="boxwise-src-"), "boxwise.zip")
    zip_package(path)
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only where it is unset and the master is local (tests,
    single-machine runs) a private temporary folder is created and registered; on
    a cluster that would be a folder of one machine, so it raises instead.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or \
            sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="boxwise-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side file APIs accept the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover
        return os.cpu_count() or 8


PARTITION_ROWS = 1_000_000         # rows a sort or join should hold at a time: some hundred MB


def partitions_for(spark: SparkSession, rows: int, per: int = PARTITION_ROWS) -> int:
    """Partitions for a shuffle of ``rows`` rows: the session's, or more where these would
    hold over ``per`` rows each, so that what a task holds does not grow with the table."""
    return max(default_parallelism(spark), -(-rows // per))


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What runs inside has its shuffle files deleted when it ends, not when the driver's
    memory is next collected: behind a write nothing reads them any more."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def materialize(df, name: str, codec: str | None = None):
    """Cut the lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back: the plan runs once, the copy is columnar and
    compressed, and a lost executor re-reads files instead of re-running the
    upstream plan.  (``Dataset.checkpoint`` serialises rows and may compute the
    plan a second time for its write.)  The write's shuffle files go with it.  ``codec`` compresses
    a large copy better than the session's."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folder (materialized intermediates,
    written views) through the Hadoop filesystem.  Call it at the end of a job:
    DataFrames that still read from the folder become invalid afterwards."""
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        return
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(d)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    from boxwise import fixtures  # forget views written into the deleted folder
    app = spark.sparkContext.applicationId
    for key in [k for k in fixtures._MATERIALIZED if k[0] == app]:
        del fixtures._MATERIALIZED[key]
