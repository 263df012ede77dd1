"""Session settings the jobs rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_made: dict[str, list[str]] = {}  # folders of each application's runs


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, which goes when Python ends.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="ticketmill-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one; `clear_runs` removes it."""
    folder = f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def clear_runs(spark: SparkSession) -> int:
    """Removes the folders this application's runs have made; results not yet written elsewhere are gone then."""
    folders = _made.pop(spark.sparkContext.applicationId, [])
    settings = spark._jsparkSession.sessionState().newHadoopConf()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(settings).delete(path, True)
    return len(folders)


def spread(df: DataFrame) -> DataFrame:
    """Deal out a scan that has fewer tasks than the cluster has cores.

    A small table, one unsplittable file or one row group would leave heavy
    per-row work to a few tasks. A scan with enough tasks is left alone, so
    nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def local_session(cores: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ticketmill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
