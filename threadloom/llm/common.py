"""Shared pieces: scratch tables, word patterns, byte files through Spark's own writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.session import Scratch, configure

# The white space of the contracts and A-Z.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# The same for bytes in Python workers.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())

ARROW_ROWS = 1000  # rows per Arrow batch: texts are long, a batch has to stay small


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of these jobs: bounded Arrow batches on top of the library's settings.

    Spark 4.1 takes a union of bucketed tables for partitioned by the bucket columns without pairing their
    buckets, and then leaves out an exchange that the aggregation needs; so that rule is off.
    """
    configure(spark)
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns evaluated once per row: a generator's output is not copied into later expressions."""
    kept = [F.col(name) for name in df.columns if name not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(column) -> list:
    """An Arrow string column as a list of ``bytes`` (``None`` for null) without decoding."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def write_blobs(df: DataFrame, column: str, path: str, rows_per_file: int) -> None:
    """Write binary rows as files of raw bytes, each row followed by one line feed.

    The bytes go through Spark's text writer, which passes them on unchanged. So the commit protocol of the
    writer holds (retried or speculative tasks leave no half files) on every file system Spark can write.
    """
    (df.select(F.col(column).cast("string").alias("value")).write
     .option("lineSep", "\n").option("maxRecordsPerFile", rows_per_file).text(path))


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """(path, content): whole files, which the writer kept small."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")


def scratch(spark: SparkSession, name: str) -> Scratch:
    return Scratch(spark, name)
