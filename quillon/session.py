"""Session defaults, and shipping the package to Python workers that cannot import it."""

from __future__ import annotations

import os
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()
_SCRATCH: dict[str, str] = {}


def session(name: str = "quillon", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; ``conf`` overrides, dots written as double underscores."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    Only a local master, whose executors are the driver, may leave it unset and get a folder of its own.
    """
    import tempfile

    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = "file://" + tempfile.mkdtemp(prefix="quillon-")
    return _SCRATCH[app]


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


class Step:
    """A written table: ``df`` reads it, ``drop()`` deletes it once nothing needs it any more; else it goes with the driver."""

    def __init__(self, df: DataFrame, name: str = "step") -> None:
        self.spark = df.sparkSession
        self.path = f"{scratch_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        files, place = file_system(self.spark, self.path)
        files.deleteOnExit(place)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        files, place = file_system(self.spark, self.path)
        files.delete(place, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write to the scratch folder and read back: cuts the lineage of an iteration and survives lost executors."""
    return Step(df).df


def spread(df: DataFrame) -> DataFrame:
    """Rows of few partitions (one small file, say) dealt out to all cores; a table of many stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship_package(spark: SparkSession) -> None:
    """Give the package to workers whose path lacks it (once an application)."""
    paths = [os.path.abspath(p or ".") for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if str(_ROOT) in paths or app in _SHIPPED:
        return
    import tempfile

    target = Path(tempfile.mkdtemp(prefix="quillon-")) / "quillon.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(_ROOT.glob("quillon/**/*.py")):
            archive.write(file, file.relative_to(_ROOT))
    spark.sparkContext.addPyFile(str(target))  # the driver serves it to all executors
    _SHIPPED.add(app)
