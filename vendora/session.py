"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on.  Skewed joins are split even where that
# costs one more shuffle: a third of all rows may share one join key.  Stored tables
# take about a quarter less room by zstd than by snappy.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vendora")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def work_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder named by ``spark.checkpoint.dir``.

    A machine-local folder is taken only by a local-mode session that names
    none; executors on other machines could not read it.  It goes when the
    process ends.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        own = tempfile.mkdtemp(prefix="vendora-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
        base = context.getCheckpointDir()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for paths in _SCRATCH:
        paths.append(path)
    return path


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove all working folders that are made inside, at the end.

    Results are lazy and read what was settled on the way, so write or collect
    them inside."""
    paths: list[str] = []
    _SCRATCH.append(paths)
    try:
        yield
    finally:
        _SCRATCH[:] = [p for p in _SCRATCH if p is not paths]
        for path in paths:
            remove(spark, path)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several later passes need the same rows: the lineage ends at
    durable files, so a lost executor costs a re-read and not a re-run, and
    values such as partition numbers stay what they were when written.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(settled: DataFrame) -> None:
    """Remove the files of a settled table that nothing will read again."""
    for path in {f.rsplit("/", 1)[0] for f in settled.inputFiles()}:
        remove(settled.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whichever store it is; a missing one is no error."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
