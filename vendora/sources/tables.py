"""Materialised tables on Parquet: full rebuild, partition replacement, publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vendora.session import exists


def write_table(df: DataFrame, path: str, partition_by: str | None = None, gathered: bool = False) -> DataFrame:
    """Rebuild the table at ``path`` and return it.

    ``rebalance`` lets AQE merge small and split large write partitions, so a
    month with a third of all rows becomes several files and not one task; rows that are ``gathered``
    have been through it.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        spread = df if gathered else df.hint("rebalance", partition_by)
        spread.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read with the declared schema: partition values keep their type."""
    return spark.read.schema(schema).parquet(path)


def append_rows(df: DataFrame, path: str, partition_by: str) -> None:
    df.hint("rebalance", partition_by).write.mode("append").partitionBy(partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: str, stored_at: str | None = None) -> None:
    """Replace the partitions present in ``df`` and leave the others alone.

    ``df`` must not read the table at ``path``; :func:`settle` rows that do.  If ``df`` is all that lies in the folder
    ``stored_at`` by the same partitions, those are moved and not written again; a call that was cut off is
    finished by another one."""
    if stored_at is not None:
        return _move_partitions(df.sparkSession, stored_at, path, partition_by)
    (
        df.hint("rebalance", partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )


def _move_partitions(spark: SparkSession, folder: str, path: str, partition_by: str) -> None:
    """One renaming a partition, as Spark itself ends a dynamic overwrite."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source = hadoop.Path(folder)
    store = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(source):
        return
    for entry in store.listStatus(source):
        name = entry.getPath().getName()
        if name.startswith(f"{partition_by}="):
            place = hadoop.Path(f"{path}/{name}")
            store.delete(place, True)
            if not store.rename(entry.getPath(), place):
                raise OSError(f"{name} could not be moved to {path}")


def take_partitions(spark: SparkSession, folder: str, place: str, names: list[str]) -> None:
    """Move partitions of one folder to another that has none of them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    store = hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(hadoop.Path(place))
    for name in names:
        if not store.rename(hadoop.Path(f"{folder}/{name}"), hadoop.Path(f"{place}/{name}")):
            raise OSError(f"{name} could not be moved to {place}")


def add_files(spark: SparkSession, folder: str, path: str) -> None:
    """Move the data files of a folder's partitions into the same partitions at ``path``, beside what is there.

    Names of files are unique, and each is moved in one step, so a call that was cut off is finished by another one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source = hadoop.Path(folder)
    store = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(source):
        return
    for partition in store.listStatus(source):
        name = partition.getPath().getName()
        if not partition.isDirectory() or name[0] in "._":
            continue
        place = hadoop.Path(f"{path}/{name}")
        store.mkdirs(place)
        for entry in store.listStatus(partition.getPath()):
            if not store.rename(entry.getPath(), hadoop.Path(f"{path}/{name}/{entry.getPath().getName()}")):
                raise OSError(f"{entry.getPath().getName()} could not be moved to {path}")


def files_of(spark: SparkSession, folder: str) -> int:
    """The number of data files in a folder; 0 if it is missing."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.getContentSummary(place).getFileCount() if store.exists(place) else 0


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's entries; none if it is missing."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in store.listStatus(place)] if store.exists(place) else []


def holds_rows(spark: SparkSession, path: str) -> bool:
    """Whether a folder has data files or partitions; markers and folders with a leading
    underscore are none, so this holds on stores and for writers that leave no marker."""
    return any(name[0] not in "._" for name in names_in(spark, path))


VERSIONS = "version long, path string"


def publish(spark: SparkSession, root: str, version_path: str) -> int:
    """Make ``version_path`` the newest published version below ``root``; returns its number.

    Publishing adds one small row that names the version; no data is copied or
    moved, and a reader sees either the old or the new version.  One process
    publishes at a time.
    """
    version = newest_version(spark, root)[0] + 1
    spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(version_path).alias("path")).write.mode(
        "append"
    ).json(f"{root}/_versions")
    return version


def newest_version(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number and path of the newest version; 0 and None before the first one."""
    if not exists(spark, f"{root}/_versions"):
        return 0, None
    versions = spark.read.schema(VERSIONS).json(f"{root}/_versions")
    row = versions.agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path")).first()
    return row["version"] or 0, row["path"]


def published(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The newest version, or an empty table before the first one."""
    _, path = newest_version(spark, root)
    return spark.createDataFrame([], schema) if path is None else read_table(spark, path, schema)
