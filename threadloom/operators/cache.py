"""Score cache: results of earlier runs by comment id and clean text, in generations.

A result is found by its comment id and the md5 of its clean text; whole texts are stored, but are no part of any
exchange or join key. ``ScoreCache`` keeps the results as a base, bucketed and sorted by that key with one row a key,
and segments, one per append. A manifest lists what is live. A writer adds folders first and then the next manifest,
in one atomic step, so that readers see either all of an append or compaction or nothing of it, and a run that breaks
off leaves at most a folder that no manifest names. After ``compact_after`` segments they are merged into a new base,
which keeps the number of files and the work of a read bounded.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions.ranking import first_n
from threadloom.operators.preprocess import union_games
from threadloom.schemas import SCORE_KEY, S, TS
from threadloom.session import Scratch
from threadloom.sources.files import Folder

COMPACT_AFTER = 16
ROWS_PER_BUCKET = 2_000_000
GRACE_SECONDS = 86_400  # folders without a manifest are removed when they are older
KEY = ["commentId", "textDigest"]


def cache_schema(outputs: T.StructType) -> T.StructType:
    key = [T.StructField(name, S) for name in [*SCORE_KEY, "textDigest"]]
    return T.StructType([*key, *outputs.fields, T.StructField("scored_at", TS)])


def text_digest(df: DataFrame) -> Column:
    return F.col("textDigest") if "textDigest" in df.columns else F.md5(F.coalesce("textClean", F.lit("")).cast("binary"))


def _keyed(df: DataFrame) -> DataFrame:
    """Keys without nulls, so that equality finds them, and the digest of the text."""
    plain = {name: F.coalesce(F.col(name), F.lit("")) for name in SCORE_KEY if name in df.columns}
    return df.withColumns({**plain, "textDigest": text_digest(df)})


def _latest(rows: DataFrame, outputs: T.StructType) -> DataFrame:
    """One row a key: the last written, of several at one time the first by its values."""
    return first_n(rows, KEY, ["-scored_at", *sorted(outputs.names)], 1)


def score_cache_read(cache: DataFrame, outputs: T.StructType) -> DataFrame:
    """Last written result per key; a cache without the needed columns counts as empty."""
    wanted = [*SCORE_KEY, *outputs.names]
    if not set(wanted) <= set(cache.columns):
        return cache.sparkSession.createDataFrame([], T.StructType([f for f in cache_schema(outputs) if f.name in wanted]))
    return _latest(_keyed(cache), outputs).select(*wanted)


def _known(cache: DataFrame) -> DataFrame:
    """The cache with its key columns renamed and without texts."""
    rows = _keyed(cache)
    return rows.withColumnsRenamed({name: f"_{name}" for name in KEY}).drop("textClean", "scored_at")


def _match(df: DataFrame) -> list[Column]:
    digest = F.md5(F.coalesce(df["textClean"], F.lit("")).cast("binary"))
    return [F.coalesce(df["commentId"], F.lit("")) == F.col("_commentId"), digest == F.col("_textDigest")]


def score_cache_lookup(df: DataFrame, cache: DataFrame) -> DataFrame:
    """All rows with their cached results and a hit flag."""
    joined = df.join(_known(cache), _match(df), "left").drop(*[f"_{name}" for name in KEY])
    return joined.withColumn("cache_hit", F.col("sentiment_label").isNotNull())


def cache_report(looked_up: DataFrame) -> DataFrame:
    return looked_up.agg(F.count_if("cache_hit").alias("hits"), F.count("*").alias("total"))


def select_uncached(df: DataFrame, cache: DataFrame) -> DataFrame:
    """Rows whose key has no label in the cache."""
    known = _known(cache.filter(F.col("sentiment_label").isNotNull())).select(*[f"_{name}" for name in KEY])
    return df.join(known, _match(df), "left_anti")


def merge_scored(looked_up: DataFrame, scored: DataFrame) -> DataFrame:
    """Cached and new results in one table; rows keep their own keys, order is a matter of the sink."""
    return union_games([looked_up.filter("cache_hit").drop("cache_hit"), scored])


# --- generations ----------------------------------------------------------------------------------


@dataclass
class Manifest:
    number: int = 0
    base: str | None = None  # folder of the base, and its buckets
    buckets: int = 0
    segments: list[str] = field(default_factory=list)

    def folders(self) -> set[str]:
        return {*self.segments, *([self.base] if self.base else [])}


class ScoreCache:
    """The results of one method under a path. One writer at a time compacts; appends may meet."""

    def __init__(self, spark: SparkSession, path: str, outputs: T.StructType, compact_after: int = COMPACT_AFTER):
        self.spark, self.path, self.outputs, self.compact_after = spark, path.rstrip("/"), outputs, compact_after
        self.schema = cache_schema(outputs)
        self.folder = Folder(spark, self.path)

    def manifest(self, number: int | None = None) -> Manifest:
        """The newest manifest, or an older one. Plain files from before there were manifests are one segment."""
        if number is None:
            known = [int(name[:-5]) for name in self.folder.children("manifests") if name.endswith(".json") and name[0] != "."]
            if not known:
                plain = any(name.endswith(".parquet") for name in self.folder.children())
                return Manifest(segments=[""] if plain else [])
            number = max(known)
        return Manifest(**json.loads(self.folder.read(f"manifests/{number:09d}.json")))

    def commit(self, change: Callable[[Manifest], Manifest]) -> Manifest:
        """Write the next manifest; if another writer was first, apply the change to its manifest."""
        while True:
            now = self.manifest()
            after = change(now)
            after.number = now.number + 1
            if self.folder.create(f"manifests/{after.number:09d}.json", json.dumps(asdict(after))):
                return after

    def append(self, scored: DataFrame, scored_at: Column | None = None) -> None:
        """Add results; the latest one per key wins at the next read."""
        at = F.current_timestamp() if scored_at is None else scored_at
        rows = _keyed(scored.withColumn("scored_at", at)).select(*self.schema.names)
        name = f"segment-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        after = self.commit(lambda now: Manifest(base=now.base, buckets=now.buckets, segments=[*now.segments, name]))
        if len(after.segments) >= self.compact_after:
            self.compact()

    def _recent(self, manifest: Manifest) -> DataFrame:
        """All rows of the segments, with their digests."""
        read = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{name}" if name else f"{self.path}/*.parquet" for name in manifest.segments])
        return read.withColumn("textDigest", F.coalesce("textDigest", F.md5(F.coalesce("textClean", F.lit("")).cast("binary"))))

    def _base(self, manifest: Manifest) -> DataFrame:
        """The base as a bucketed table: joins on the key read it in place."""
        name = "score_" + manifest.base.replace("-", "_")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        keys = ", ".join(KEY)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                       f"INTO {manifest.buckets} BUCKETS LOCATION '{self.path.replace(chr(39), chr(92) + chr(39))}/{manifest.base}'")
        return self.spark.table(name)

    def rows(self, manifest: Manifest | None = None) -> DataFrame:
        """One row a key, with text, digest, results and time. Only the segments' rows are shuffled."""
        manifest = manifest or self.manifest()
        if not manifest.folders():
            return self.spark.createDataFrame([], self.schema)
        recent = _latest(self._recent(manifest), self.outputs) if manifest.segments else None
        if manifest.base is None:
            return recent.select(*self.schema.names)
        base = self._base(manifest)
        if recent is None:
            return base
        values = [name for name in self.schema.names if name not in KEY]
        pairs = base.select(*KEY, F.struct(*values).alias("old")).join(
            recent.select(*KEY, F.struct(*values).alias("new")), KEY, "full_outer")

        def place(row: str) -> Column:
            return F.struct(-F.coalesce(F.unix_micros(f"{row}.scored_at"), F.lit(-(2**62))), *[F.col(f"{row}.{c}") for c in sorted(self.outputs.names)])

        newer = F.col("old").isNull() | (F.col("new").isNotNull() & (place("new") <= place("old")))
        return pairs.select(*KEY, F.when(newer, F.col("new")).otherwise(F.col("old")).alias("row")).select(*KEY, "row.*").select(*self.schema.names)

    def read(self) -> DataFrame:
        """Last written result per key."""
        return self.rows().select(*SCORE_KEY, "textDigest", *self.outputs.names)

    def compact(self) -> None:
        """Merge base and segments into a new base, then switch to it. Segments added meanwhile stay."""
        done = self.manifest()
        if not done.segments:
            return
        buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-self.rows(done).count() // ROWS_PER_BUCKET))
        name = f"base-{uuid.uuid4().hex}"
        (self.rows(done).repartition(buckets, *KEY).write.bucketBy(buckets, *KEY).sortBy(*KEY).format("parquet")
         .option("path", f"{self.path}/{name}").saveAsTable("score_" + name.replace("-", "_")))
        self.commit(lambda now: Manifest(base=name, buckets=buckets, segments=[s for s in now.segments if s not in done.segments]))
        self.clean()

    def clean(self, grace: float = GRACE_SECONDS) -> None:
        """Remove what neither of the last two manifests names: readers of the one before may still be at work."""
        names = sorted(name for name in self.folder.children("manifests") if name.endswith(".json") and name[0] != ".")
        live = set().union(*[self.manifest(int(name[:-5])).folders() for name in names[-2:]])
        listed = set().union(*[self.manifest(int(name[:-5])).folders() for name in names[:-2]])
        for name, changed in self.folder.children().items():
            if name not in live and name.startswith(("segment-", "base-")) and (name in listed or changed < 1000 * (time.time() - grace)):
                if name.startswith("base-"):
                    self.spark.sql(f"DROP TABLE IF EXISTS score_{name.replace('-', '_')}")
                self.folder.delete(name)
        if "" in listed - live:  # the plain files are in a base now
            for name in self.folder.children():
                if name.endswith(".parquet"):
                    self.folder.delete(name)
        for name in names[:-2]:
            self.folder.delete(f"manifests/{name}")


def open_cache(spark: SparkSession, path: str, outputs: T.StructType) -> DataFrame:
    """The cache at a path; one that does not exist yet is empty."""
    return ScoreCache(spark, path, outputs).read()


def score_cache_upsert(
    scored: DataFrame, path: str, outputs: T.StructType, scored_at: Column | None = None
) -> None:
    """Append results as a generation; the latest one per key wins at the next read."""
    ScoreCache(scored.sparkSession, path, outputs).append(scored, scored_at)


def score_with_cache(
    df: DataFrame, scorer: Callable[[DataFrame], DataFrame], path: str, outputs: T.StructType, batches: int = 1,
    compact_after: int = COMPACT_AFTER,
) -> DataFrame:
    """Score what the cache lacks, in ``batches`` commits, then read everything from the cache.

    A run that stops between commits resumes with the keys that are still missing.
    """
    spark = df.sparkSession
    cache = ScoreCache(spark, path, outputs, compact_after)
    missing = _keyed(select_uncached(df, cache.read()).select(*SCORE_KEY)).dropDuplicates(KEY)
    part = F.pmod(F.xxhash64(*KEY), F.lit(batches)).cast("int")
    waiting = Scratch(spark, "uncached")
    rows = waiting.path("keys")
    missing.select(*SCORE_KEY, part.alias("part")).write.partitionBy("part").parquet(rows)
    schema = T.StructType([*[T.StructField(n, S) for n in SCORE_KEY], T.StructField("part", T.IntegerType())])
    for number in range(batches):
        todo = spark.read.schema(schema).parquet(rows).filter(F.col("part") == number).drop("part")
        cache.append(scorer(todo))
    waiting.close()
    return score_cache_lookup(df, cache.read()).drop("cache_hit")
