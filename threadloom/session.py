"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Runtime settings every job here relies on. All of them can be set on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Lookup joins meet hot keys (popular threads, hub users): let the runtime plan split them,
    # also where the split costs a further exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort joins where the measured partitions are small enough.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # This rule of Spark 4.1 takes unions of bucketed tables for partitioned and leaves out a needed exchange.
    "spark.sql.unionOutputPartitioning": "false",
    # Loop state is small in bytes but expands in the next join: do not pack its files into few tasks.
    "spark.sql.files.openCostInBytes": "524288",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting for the jobs inside only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("threadloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: list[str] = []  # the one temporary folder of this process, for a local master without a setting


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for a local master without a setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_roots:
        _local_roots.append(tempfile.mkdtemp(prefix="threadloom-"))
    return _local_roots[0]


class Scratch:
    """Tables written under the shared folder.

    Writing a table computes the plan once, cuts its lineage, survives lost executors and gives the
    optimizer real file sizes for its broadcast decisions.
    """

    def __init__(self, spark: SparkSession, name: str = "run"):
        self.spark = spark
        self.base = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.base}/{self.count:04d}-{name}"

    def table(self, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path, compression=codec)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path  # known to ``release`` without listing the files
        return table

    def bucketed(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """As ``table``, in buckets of ``key``: joins on it read the table in place."""
        path, known = self.path(name), f"threadloom_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(known)
        table = self.spark.table(known)
        table._scratch_path, table._scratch_name = path, known
        return table

    def dealt(self, df: DataFrame, name: str, keys: list[str], buckets: int, codec: str | None = None) -> DataFrame:
        """In buckets of all ``keys``, unsorted: grouping by them and joining on them need no exchange."""
        path, known = self.path(name), f"threadloom_{uuid.uuid4().hex}"
        writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).format("parquet").option("path", path)
        (writer.option("compression", codec) if codec else writer).saveAsTable(known)
        table = self.spark.table(known)
        table._scratch_path, table._scratch_name = path, known
        return table

    def measured(
        self, df: DataFrame, name: str, key: str | None = None, buckets: int | None = None, **metrics: Column
    ) -> tuple[DataFrame, dict]:
        """As ``table`` (``bucketed`` with a key), with aggregates observed while writing, so that a loop round is a single job."""
        seen = Observation()
        df = df.observe(seen, *[value.alias(metric) for metric, value in metrics.items()])
        table = self.bucketed(df, name, key, buckets) if key else self.table(df, name)
        found = seen.get
        return table, {metric: found.get(metric) or 0 for metric in metrics}

    def release(self, *tables: DataFrame | None) -> None:
        """Drop tables of earlier loop rounds, which nothing reads any more."""
        for table in tables:
            if table is not None:
                if hasattr(table, "_scratch_name"):
                    self.spark.sql(f"DROP TABLE IF EXISTS {table._scratch_name}")
                self.drop(table._scratch_path)

    def drop(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)

    def close(self) -> None:
        """Drop all tables; only after every result built on them has been written."""
        self.drop(self.base)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        self.close()
