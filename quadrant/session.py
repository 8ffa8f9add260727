"""Session helpers: one place for the configs every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "quadrant") -> SparkSession:
    """Build (or reuse) a session with AQE, UTC and Arrow enabled.

    On a cluster the master and the checkpoint folder come from the launcher;
    locally we fill them in only when they are unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Where none is set, a local folder is
    made for a local master only; on a cluster the launcher must name one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quadrant-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one sink / stream run, under the shared checkpoint dir.

    Sinks and streaming checkpoints must live on storage every executor sees, so
    they go next to the checkpoint folder the cluster names, never in a
    machine-local temp folder.
    """
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/quadrant/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    _MADE.append((spark.sparkContext.applicationId, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to a fresh table in the shared folder and read it back: cuts the
    lineage, survives lost executors, and gives the planner the real size."""
    path = work_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_MADE: list[tuple[str, str]] = []


def clean_work_dirs(spark: SparkSession) -> None:
    """Remove the folders that `work_dir` handed out in this application. Results
    still to be read must have been read before."""
    sc = spark.sparkContext
    for app, path in [x for x in _MADE if x[0] == sc.applicationId]:
        place = sc._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)
        _MADE.remove((app, path))


def python_ready(spark: SparkSession) -> None:
    """Bound the Arrow batches sent to Python workers where the session keeps
    Spark's defaults: rows of long texts would otherwise make huge batches."""
    for key, default, ours in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"),
                               ("spark.sql.execution.arrow.maxBytesPerBatch", None, "16m")):
        now = spark.conf.get(key, None)
        if default is None or now == default:
            spark.conf.set(key, ours)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `quadrant` importable in the Python workers (once per context).

    Functions handed to mapInPandas / applyInPandas are pickled by reference
    to their module, so every executor must be able to import the package;
    when it is not installed there, it is zipped and shipped with addPyFile
    (Spark distributes the file and puts it on the workers' path).
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="quadrant-pyfiles-"), "quadrant.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, names in os.walk(pkg_dir):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
