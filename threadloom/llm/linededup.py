"""Line deduplication over levelled sorted runs of line hashes.

A run holds, per line key, the number of documents seen and the largest doc_id among them, hashed into
buckets and sorted in each. Lines are hashed once, into a table with a part per batch of documents; batches come
in order of descending doc_id and grow, so that their number follows the logarithm of the rows. A batch's keys are
merge-anti-joined with the runs: keys that a run has already settled (enough documents, and a larger doc_id
than any in the batch) are not added again; the rest becomes a new run of level 0. When a level has
``fanout`` runs they are compacted into one run of the next level. So a line that is in every document enters
the runs a few times only. Runs are bucketed tables in the shared folder: joins read them in place and
shuffle the new batch only.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import LOWER_BYTES, as_bytes, partitions, scratch
from threadloom.session import Scratch

MIN_CHARS = 20
MIN_DOCS = 3
BATCH_ROWS = 100_000  # rows of the first batch
GROWTH = 2  # each batch is so many times as large as the one before
MIN_BATCHES = 3
FANOUT = 3
STRIP = b" \t\n\x0b\x0c\r"  # fixed value: the contract's white space
KEY = ["hi", "lo"]


def line_key(line: bytes) -> bytes:
    return line.strip(STRIP).translate(LOWER_BYTES)


def key_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the line's key, or ``None`` if the key has fewer than ``min_chars`` code points."""
    key = line_key(line)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, hi, lo): the distinct long lines of every row."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, hi, lo = [], [], []
            for i, text in enumerate(as_bytes(batch.column(1))):
                found = {key_hash(line, min_chars) for line in (text or b"").split(b"\n")}
                found.discard(None)
                for a, b in map(halves, found):
                    take.append(i)
                    hi.append(a)
                    lo.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(take, pa.int32())), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())],
                names=["doc_id", "hi", "lo"])

    return rows.mapInArrow(run, f"doc_id {kind}, hi bigint, lo bigint")


class LineRuns:
    """The levels of runs; each run is a table (hi, lo, docs, top) bucketed and sorted by key."""

    def __init__(self, store: Scratch, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.store, self.min_docs, self.fanout = store, min_docs, fanout
        self.spark, self.buckets = store.spark, partitions(store.spark)
        self.levels: list[list[tuple[str, str]]] = []

    def write(self, keys: DataFrame, level: int) -> None:
        name, path = f"line_run_{uuid.uuid4().hex}", self.store.path(f"run{level}")
        (keys.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .format("parquet").option("path", path).saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (doc_id, hi, lo)."""
        keys = lines.groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("doc_id").alias("top"))
        for run in self.tables():
            settled = run.filter(F.col("docs") >= self.min_docs).select("hi", "lo", F.col("top").alias("_top"))
            older = F.col("top").isNull() | (F.col("_top") >= F.col("top"))
            same = (keys["hi"] == settled["hi"]) & (keys["lo"] == settled["lo"])
            keys = keys.join(settled, same & older, "left_anti")
        self.write(keys, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self.compact(level)
            level += 1

    @staticmethod
    def merged(runs: list[DataFrame]) -> DataFrame:
        rows = reduce(lambda a, b: a.unionByName(b), runs)
        return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))

    def compact(self, level: int) -> None:
        runs, self.levels[level] = self.levels[level], []
        self.write(self.merged([self.spark.table(name) for name, _ in runs]), level + 1)
        self.forget(runs)

    def forget(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.store.drop(path)

    def frequent(self) -> DataFrame:
        """(hi, lo, top) of keys in at least ``min_docs`` documents, as a table of its own."""
        rows = self.merged(self.tables()).filter(F.col("docs") >= self.min_docs).select("hi", "lo", "top")
        return self.store.table(rows, "frequent")

    def close(self) -> None:
        self.forget([run for level in self.levels for run in level])
        self.levels = []


def batch_count(rows: int, first: int = BATCH_ROWS) -> int:
    """Batches that hold so many rows if the first holds ``first`` and each next one ``GROWTH`` times as many."""
    count, size, held = 0, first, 0
    while held < rows:
        count, held, size = count + 1, held + size, GROWTH * size
    return max(MIN_BATCHES, count)


def batch_numbers(docs: DataFrame, count: int) -> tuple[Column, int]:
    """(number of a row's batch by its doc_id, number of batches): ranges in descending order, null ids in the last.

    The borders are estimates; every row is in one batch.
    """
    shares = [GROWTH**i for i in range(count)]
    places = [1 - sum(shares[:i]) / sum(shares) for i in range(1, count)]
    cuts = docs.select(F.percentile_approx("doc_id", places, 10_000)).first()[0] if count > 1 else None
    cuts = sorted(set(cuts or []), reverse=True)
    if not cuts:
        return F.lit(0), 1
    below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: F.col("doc_id") <= c))
    return F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(below), len(cuts) + 1


def drop_lines(text: bytes, drop: list[bytes], min_chars: int) -> tuple[bytes, int, int]:
    lines = text.split(b"\n")
    gone = set(drop)
    kept = [line for line in lines if key_hash(line, min_chars) not in gone] if gone else lines
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None,
    fanout: int = FANOUT, batch_rows: int = BATCH_ROWS, store: Scratch | None = None,
) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): every row's text without the lines that other documents hold.

    Texts are split at line feeds; null or empty text is one empty line. A line's key is the line without
    leading and trailing ASCII white space, A-Z lower-cased. Keys of at least ``min_chars`` code points in at
    least ``min_docs`` rows lose all their lines except in the rows with the largest doc_id that holds them.
    Each row is a document; a null doc_id ranks below all others (if all holders are null, all keep the line).
    Repeats inside a document count once and stay or go together. Other columns play no part. The number of
    ``batches`` follows from the rows, the first with about ``batch_rows``, so levels and compactions grow with the
    input. Texts are read twice, whatever that number: to hash the lines, and to rebuild the texts. An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    store = store or scratch(spark, "lines")
    rows = docs.select("doc_id", "text")
    number, count = batch_numbers(rows, batches or batch_count(rows.count(), batch_rows))
    hashed, path = line_hashes(rows, min_chars).withColumn("batch", number), store.path("hashed")
    hashed.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(hashed.schema).parquet(path)
    runs = LineRuns(store, min_docs, fanout)
    for batch in range(count):
        runs.add(lines.filter(F.col("batch") == batch).drop("batch"))
    frequent = runs.frequent()
    runs.close()

    lost = lines.join(frequent, KEY).filter(F.coalesce(F.col("doc_id") < F.col("top"), F.col("top").isNotNull()))
    drops = lost.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set(F.struct(*KEY)).alias("_drop"))
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "_drop")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def rebuild(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            out = []
            for text, drop in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                digests = [d[k].to_bytes(8, "little", signed=True) for d in drop or () for k in KEY]
                pairs = [a + b for a, b in zip(digests[::2], digests[1::2], strict=True)]
                out.append(drop_lines(text or b"", pairs, min_chars))
            texts, total, gone = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()),
                 pa.array(gone, pa.int64())], names=["doc_id", "text", "n_lines", "n_dropped"])

    return joined.mapInArrow(rebuild, f"doc_id {kind}, text string, n_lines bigint, n_dropped bigint")
