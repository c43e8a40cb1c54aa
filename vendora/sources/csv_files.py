"""Raw CSV tables in, mart CSV files out."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vendora.functions.unions import union_all
from vendora.sources.contracts import CONTRACTS, Contract


Paths = str | list[str]


def read_csv(spark: SparkSession, path: Paths, free_text: bool = False) -> DataFrame:
    """Header CSV with every column as text, so leading zeros survive.

    Fields of ``free_text`` may hold line breaks; see :func:`read_free_text`.  The schema
    is that of the first header, declared, so that Spark checks the header of every further file
    against it and fails on a different one; it would else bind their columns by position."""
    if free_text:
        return read_free_text(spark, path)
    plain = spark.read.option("header", True).option("escape", '"')
    names = plain.csv(path if isinstance(path, str) else path[0]).columns
    schema = StructType([StructField(c, StringType()) for c in names])
    return plain.option("enforceSchema", False).schema(schema).csv(path)


def read_free_text(spark: SparkSession, path: Paths) -> DataFrame:
    """Header CSV whose quoted fields may hold line breaks, read in as many tasks as the files have blocks.

    Spark cuts files into blocks at line ends and cannot know whether a block begins inside quotes.  The
    parity of the quotes tells: a line begins a record if the lines before it in its file hold an
    even number of quotes.  Each block counts its own; a running XOR over one row for each block gives
    the parity at its start.  Records of one line, nearly all, are parsed where they are; the
    lines of others are brought together by the place where their record begins, which may lie
    blocks before.  Every file needs the same header, as in :func:`read_csv`."""
    lines = (
        block_lines(spark, path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        .withColumn("nth", F.monotonically_increasing_id())
        .withColumn("odd", F.length(F.regexp_replace("value", '[^"]', "")) % 2)
    )
    # Within a block; a block is what one task reads.
    in_block = W.partitionBy("file", "block").orderBy("nth")
    before = F.coalesce(F.sum("odd").over(in_block.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = lines.withColumn("before", before % 2)

    blocks = placed.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("odd"),
        # The last line before which the block's own quotes are even, and odd.
        *[F.max(F.when(F.col("before") == x, F.struct("block", "nth"))).alias(f"last_{x}") for x in (0, 1)],
    )
    # One row for each block of a file.
    along = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        blocks.withColumn("start", F.coalesce(F.sum("odd").over(along), F.lit(0)) % 2)
        .withColumn("last", F.when(F.col("start") == 0, F.col("last_0")).otherwise(F.col("last_1")))
        .withColumn("open", F.last("last", ignorenulls=True).over(along))
        .select("file", "block", "start", "open")
    )
    begins = (F.col("before") + F.col("start")) % 2 == 0
    own = F.last(F.when(begins, F.struct("block", "nth")), ignorenulls=True).over(in_block)
    # Both ends of the record: where it begins, and whether its quotes are closed on this line.
    owned = (
        placed.join(carried, ["file", "block"])
        .withColumn("begins", begins)
        .withColumn("record", F.coalesce(own, "open"))
        .withColumn("whole", F.col("begins") & (F.col("odd") == 0))
    )
    single = owned.filter("whole").select("file", "record", F.col("value").alias("text"))
    several = (
        owned.filter("NOT whole")
        .groupBy("file", "record")
        .agg(F.sort_array(F.collect_list(F.struct("block", "nth", "value"))).alias("parts"))
        .select("file", "record", F.array_join(F.transform("parts", lambda x: x["value"]), "\n").alias("text"))
    )
    names = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path if isinstance(path, str) else path[0]).columns
    tops = placed.filter(F.col("block") == 0).groupBy("file").agg(F.min("nth").alias("top"), F.min_by("value", "nth").alias("head"))
    if tops.select("head").distinct().limit(2).count() > 1:
        raise ValueError(f"files of {path} differ in their headers")
    options = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    records = single.unionByName(several).withColumn("text", F.regexp_replace("text", "\r$", ""))
    # A file's first record is its header; blank lines are no records.
    first = (F.col("record.block") == 0) & (F.col("record.nth") == F.col("top"))
    # One row for each file.
    rows = records.join(F.broadcast(tops.drop("head")), "file", "left").filter(~F.coalesce(first, F.lit(False)) & (F.col("text") != ""))
    ddl = ", ".join(f"`{c}` string" for c in names)
    return rows.select(F.from_csv("text", ddl, options).alias("r")).select("r.*")


def block_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """Lines by block; a file of any size is several tasks."""
    return spark.read.option("lineSep", "\n").text(path)


def align_columns(df: DataFrame, old_names: dict[str, str]) -> DataFrame:
    """Rename an earlier column name where the contract's name is absent."""
    renames = {old: new for old, new in old_names.items() if old in df.columns and new not in df.columns}
    return df.withColumnsRenamed(renames)


def load_raw(spark: SparkSession, raw_path: str, table: str, prefix: str | None = None) -> DataFrame:
    """One raw table in its contract's columns; a missing optional file is empty.

    ``prefix`` is what the publisher puts before the file name; without it the
    only file with any prefix is taken.  Several files of the name (deliveries)
    are read by their own headers, those with the same one together, and put together by name."""
    contract = CONTRACTS[table]
    pattern = contract.file if prefix is None else contract.file.replace("*_", prefix)
    paths = matching(spark, f"{raw_path}/{pattern}")
    if not paths:
        if contract.optional:
            return empty(spark, contract)
        raise FileNotFoundError(f"PATH_NOT_FOUND: {raw_path}/{pattern}")
    found = [
        _in_contract(read_csv(spark, group, contract.free_text), contract, group[0]) for group in by_header(spark, paths)
    ]
    return reduce(DataFrame.unionByName, found)


# Files whose first lines are fetched at a time.
OPENED = 16


def by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The paths in groups of files with the same first line, so that a read, its plan and its
    jobs are one for each kind of header, however many files there are.  A folder is a group of its own."""
    if len(paths) < 2:
        return [[p] for p in paths]
    with ThreadPoolExecutor(OPENED) as pool:
        heads = list(pool.map(lambda p: first_line(spark, p), paths))
    groups: dict[tuple, list[str]] = {}
    for path, head in zip(paths, heads, strict=True):
        groups.setdefault((path, None) if head is None else ("", head), []).append(path)
    return list(groups.values())


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, in whichever store it is; None for folders, empty and packed files."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(conf)
    packed = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place) is not None
    if packed or store.getFileStatus(place).isDirectory():
        return None
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(store.open(place), "UTF-8"))
    try:
        return lines.readLine()
    finally:
        lines.close()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Files or folders that match, in whichever store they are."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    store = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(str(status.getPath()) for status in store.globStatus(glob) or [])


def _in_contract(df: DataFrame, contract: Contract, path: str) -> DataFrame:
    aligned = align_columns(df, contract.old_names)
    missing = [c for c in contract.columns if c not in aligned.columns]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return aligned.select(*contract.columns)


def empty(spark: SparkSession, contract: Contract) -> DataFrame:
    return spark.createDataFrame([], contract.schema)


def load_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and columns of each loaded table."""
    rows = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(",".join(df.columns)).alias("column_names")
        )
        for name, df in tables.items()
    ]
    return union_all(rows)


MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def export_csv(df: DataFrame, path: str) -> None:
    """Header CSV.  Blanks inside text and all digits of times survive; an empty text reads back as NULL."""
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("timestampFormat", MICROS)
        .option("timestampNTZFormat", MICROS)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_export(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
