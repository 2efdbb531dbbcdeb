"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.schemas import DUMP
from threadloom.session import Scratch


def raw_json_scan(spark: SparkSession, path: str | list[str], one_per_line: bool = False) -> DataFrame:
    """Nested dumps with a declared schema. A malformed dump or value stops the run instead of vanishing.

    A pretty-printed document is one unit of work; ``one_per_line`` reads the splittable layout with one
    document, or one video in a document, per line.
    """
    reader = spark.read.schema(DUMP).option("mode", "FAILFAST").option("multiLine", not one_per_line)
    docs = reader.json(path)
    return docs.withColumn("videos", F.coalesce("videos", F.array().cast(DUMP["videos"].dataType)))


def raw_variant_scan(spark: SparkSession, path: str | list[str], one_per_line: bool = False) -> DataFrame:
    """Nested dumps whose videos stay as written: any keys, nulls told from absent keys, counters of any type."""
    schema = T.StructType([T.StructField("videos", T.ArrayType(T.VariantType())) if f.name == "videos" else f for f in DUMP])
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", not one_per_line)
    docs = reader.json(path)
    return docs.withColumn("videos", F.coalesce("videos", F.array().cast(schema["videos"].dataType)))


# A JSON string; in a document one never goes over the end of a line.
_STRING = r'"(?:[^"\\]|\\.)*+"'


def raw_indented_scan(spark: SparkSession, path: str | list[str], scratch: Scratch) -> DataFrame:
    """Indented dumps of any size, one row per video instead of one per document.

    For documents with an element of ``videos`` beginning on a line of its own, as indenting writers leave them. The
    lines are read in splits like any text; the depth of brackets at each line is a running sum within its split plus
    the sums of the splits before, and so are the numbers of the videos. So only the lines of one video come together,
    never those of a document. A document without videos gives one row with none.
    """
    where = ["_file", "_block"]
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"), "value")
    bare = F.regexp_replace("value", _STRING, '""')
    lines = scratch.table(lines.withColumns({
        "_up": F.length(F.regexp_replace(bare, r"[^\[{]", "")), "_down": F.length(F.regexp_replace(bare, r"[^\]}]", ""))}), "lines")

    def running(rows: DataFrame, **steps: Column) -> DataFrame:
        """Sums up to and with each line of its file. A split's lines are in order; its totals are one row."""
        rows = rows.withColumns({f"_step_{name}": step for name, step in steps.items()})
        totals = rows.groupBy(*where).agg(*[F.sum(f"_step_{name}").alias(f"_sum_{name}") for name in steps])
        earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select(*where, *[F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in steps])
        inside = Window.partitionBy(*where).orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
        found = rows.join(totals, where).withColumns({name: F.col(f"_before_{name}") + F.sum(f"_step_{name}").over(inside) for name in steps})
        return found.drop(*[f"{part}_{name}" for name in steps for part in ("_step", "_before")])

    lines = running(lines, _depth=F.col("_up") - F.col("_down")).withColumn("_from", F.col("_depth") - F.col("_up") + F.col("_down"))
    # An element begins at depth two; a short one also ends on its line.
    array, video = (F.col("_from") == 1) & (F.col("_depth") == 2), (F.col("_from") == 2) & (F.col("_up") > 0)
    lines = running(lines, _array=array.cast("int"), _video=video.cast("int"))
    lines = scratch.table(lines, "placed")
    # Which of a document's lists holds the videos: at most one row a file.
    held = lines.filter((F.col("_from") == 1) & (F.col("_depth") == 2) & F.col("value").rlike(r'^\s*"videos"\s*:')).groupBy("_file").agg(
        F.max("_array").alias("_held"))
    lines = lines.join(held, "_file", "left")
    inside = (F.col("_array") == F.col("_held")) & ((F.col("_depth") > 2) | (F.col("_from") > 2) | video)
    texts = lines.withColumn("_video", F.when(inside, F.col("_video"))).groupBy("_file", "_video").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_line", "value"))).alias("_rows"))
    texts = texts.select("_file", "_video", F.array_join("_rows.value", "\n").alias("_text"))
    options = {"mode": "FAILFAST"}
    outer = texts.filter(F.col("_video").isNull() & (F.trim("_text") != "")).select(
        F.col("_file").alias("_of"), F.from_json("_text", DUMP, options).alias("doc"))
    element = DUMP["videos"].dataType.elementType
    videos = texts.filter(F.col("_video").isNotNull()).select(
        "_file", "_video", F.from_json(F.regexp_replace("_text", r",\s*$", ""), element, options).alias("video"))
    joined = outer.join(videos, F.col("_of") == F.col("_file"), "left")
    found = F.when(F.col("video").isNotNull(), F.array("video")).otherwise(F.coalesce("doc.videos", F.array().cast(DUMP["videos"].dataType)))
    return joined.select(*[F.col(f"doc.{f.name}") for f in DUMP if f.name != "videos"], found.alias("videos")).select(*DUMP.names)


def require_columns(df: DataFrame, names: list[str], what: str = "table") -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
    return df


def table_scan(
    spark: SparkSession,
    path: str,
    required: list[str] | None = None,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Read a table; a missing file or column stops the run before any work. CSV needs its schema."""
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV scan needs a declared schema")
        df = (
            spark.read.schema(schema)
            .option("header", True).option("multiLine", True).option("escape", '"').option("mode", "FAILFAST")
            .csv(path)
        )
    else:
        df = spark.read.format(fmt).load(path)
    return require_columns(df, required or [], path)


def table_sink(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_by_method(df: DataFrame, path: str, method: str) -> None:
    """One table for all scoring methods, one folder per method; a second run replaces the method's rows."""
    (df.withColumn("method", F.lit(method)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("method").parquet(path))


def read_method(spark: SparkSession, path: str, method: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("method") == method)


def graph_export(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node and edge lists of every game's directed graph."""
    kept = edges.filter(F.col("gameLabel").isNotNull())
    ends = kept.select(F.col("gameLabel").alias("game"), F.explode(F.array("source", "target")).alias("id"))
    return ends.distinct(), kept.select(F.col("gameLabel").alias("game"), "source", "target", "weight")


def write_graph(edges: DataFrame, path: str) -> None:
    nodes, links = graph_export(edges)
    table_sink(nodes, f"{path}/nodes", partition_by=["game"])
    table_sink(links, f"{path}/edges", partition_by=["game"])
