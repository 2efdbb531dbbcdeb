"""Target-distribution importance resampling over hashed word runs, with a head-tail vocabulary.

Features of a text are all runs of one to three consecutive words; a feature's bucket is its crc32 modulo
``BUCKETS``. The ratio of a bucket's shares in the target and in all documents gives the bucket's gain, a
document's weight is the sum of the gains of its features, and documents are drawn by weight plus Gumbel noise,
which is sampling without replacement in proportion to exp(weight).

The head of the vocabulary travels to all tasks: the crc states of frequent words and the crcs, so the buckets,
of frequent pairs. Everything else is the tail and takes its crc directly: a word by one call per batch, a longer
run by extending the crc of its first words. crc32(A + B) is linear in crc32(A), so that a whole batch of runs is
extended by table look-ups; words too long for the tables are read byte by byte. Head and tail give the same exact
crcs; which words are in the head (found in a pass over all texts, a bounded list from each task) only decides
how fast. Tasks sum their buckets before anything is shuffled.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import LOWER_BYTES, as_bytes, scratch
from threadloom.session import Scratch

BUCKETS = 10_000
SHARE = 5  # per cent of the documents that can be drawn
MIN_WORDS = 20
SEED = 42
SCALE = 1000
# Bounds of the head: words, their length, pairs, words that can be in pairs; and what a task keeps and lists.
HEAD_WORDS, HEAD_BYTES, HEAD_PAIRS, PAIR_WORDS = 4096, 64, 1 << 16, 1024
TASK_WORDS, TASK_PAIRS, TASK_KEPT = 4096, 4096, 100_000
GROUP_BYTES = 1 << 22  # texts worked on together; a longer text is a group of its own

# Bytes of words (0-9, A-Z, a-z and all from 0x80), A-Z lower-cased; others 0.
WORD_BYTES = np.array([b if chr(b).isalnum() and b < 128 or b > 127 else 0 for b in LOWER_BYTES], np.uint8)


def shift_tables(longest: int) -> np.ndarray:
    """(length, byte, value): what a byte of a crc becomes when ``length`` more bytes follow, as one flat array."""
    step = np.array([zlib.crc32(bytes([v])) for v in range(256)], np.uint32) ^ np.uint32(zlib.crc32(b"\0"))
    table = np.zeros((longest + 1, 4, 256), np.uint32)
    table[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, longest + 1):
        table[n] = (table[n - 1] >> np.uint32(8)) ^ step[table[n - 1] & np.uint32(255)]
    return table.ravel()


@dataclass
class Head:
    """Frequent words, most frequent first, and frequent pairs of the first ``PAIR_WORDS`` of them by place."""

    words: list[bytes]
    pairs: list[tuple[int, int]]


class Features:
    """Crcs of all features of texts."""

    def __init__(self, head: Head):
        self.shift = shift_tables(HEAD_BYTES + 1)
        self.place = {word: i for i, word in enumerate(head.words)}
        self.head_state = np.array([zlib.crc32(w) for w in head.words], np.uint32)
        self.head_after = np.array([zlib.crc32(b" " + w) for w in head.words], np.uint32)
        self.pair_crc = np.full(PAIR_WORDS * PAIR_WORDS, -1, np.int64)
        for a, b in head.pairs:
            self.pair_crc[a * PAIR_WORDS + b] = zlib.crc32(b" " + head.words[b], int(self.head_state[a]))

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words: crc, crc with a space in front, length with the space, place in the head or -1."""
        place = np.fromiter((self.place.get(w, -1) for w in words), np.int64, len(words))
        state, after = np.zeros(len(words), np.uint32), np.zeros(len(words), np.uint32)
        known = place >= 0
        state[known], after[known] = self.head_state[place[known]], self.head_after[place[known]]
        for i in np.flatnonzero(~known).tolist():
            state[i] = zlib.crc32(words[i])
            after[i] = zlib.crc32(b" " + words[i])
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        return state, after, size, place

    def extend(self, crc: np.ndarray, code: np.ndarray, words: list[bytes], after: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Crcs of runs after a space and one more word each."""
        n = size[code]
        short = n <= HEAD_BYTES + 1
        base = np.where(short, n, 0) * 1024
        out = after[code].copy()
        for byte in range(4):
            out ^= self.shift[base + (256 * byte + ((crc >> np.uint32(8 * byte)) & np.uint32(255)).astype(np.int64))]
        for i in np.flatnonzero(~short).tolist():
            out[i] = zlib.crc32(words[code[i]], zlib.crc32(b" ", int(crc[i])))
        return out

    def crcs(self, texts: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """For runs of one, two, three words: (crcs, text of each); and the number of words per text."""
        code, words, counts = cut(texts)
        state, after, size, place = self.look_up(words)
        text = np.repeat(np.arange(len(texts)), counts)
        one = state[code]
        found = [(one, text)]
        run, first = one, np.arange(len(code))
        for length in (2, 3):
            first = first[first + length <= len(code)]
            first = first[text[first] == text[first + length - 1]]
            if length == 2:
                a, b = place[code[first]], place[code[first + 1]]
                both = (a >= 0) & (a < PAIR_WORDS) & (b >= 0) & (b < PAIR_WORDS)
                crc = np.full(len(first), -1, np.int64)
                crc[both] = self.pair_crc[a[both] * PAIR_WORDS + b[both]]
                tail = crc < 0
                crc[tail] = self.extend(one[first[tail]], code[first[tail] + 1], words, after, size)
                crc = crc.astype(np.uint32)
                run = np.zeros(len(code), np.uint32)
                run[first] = crc
            else:
                crc = self.extend(run[first], code[first + 2], words, after, size)
            found.append((crc, text[first]))
        return found, counts


def cut(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(code of every word, the distinct words, words per text) of all texts behind each other."""
    data = WORD_BYTES[np.frombuffer(b" ".join(texts), np.uint8)]
    inside = np.concatenate(([False], data != 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[data != 0].tobytes())])
    coded = column.dictionary_encode()
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist(), counts


def grouped(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of texts of about ``GROUP_BYTES`` together."""
    low, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= GROUP_BYTES:
            yield low, i + 1
            low, held = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def texts_of(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in as_bytes(column)]


# --- the head ----------------------------------------------------------------------------------------


def task_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frequent words and pairs of a task with their counts, from bounded counters."""
    seen = [Counter(), Counter()]
    for batch in batches:
        texts = texts_of(batch.column(0))
        for low, high in grouped(texts):
            code, words, counts = cut(texts[low:high])
            n = np.bincount(code, minlength=len(words))
            top = np.argsort(-n, kind="stable")[:TASK_WORDS]
            seen[0].update({words[i]: int(n[i]) for i in top.tolist() if len(words[i]) <= HEAD_BYTES})
            # Pairs of words that are frequent here.
            place = np.full(len(words), -1, np.int64)
            place[top[:PAIR_WORDS]] = np.arange(min(len(top), PAIR_WORDS))
            text = np.repeat(np.arange(high - low), counts)
            a, b = place[code[:-1]], place[code[1:]]
            keys = (a * PAIR_WORDS + b)[(a >= 0) & (b >= 0) & (text[:-1] == text[1:])]
            keys, times = np.unique(keys, return_counts=True)
            best = np.argsort(-times, kind="stable")[:TASK_PAIRS]
            seen[1].update({words[top[k // PAIR_WORDS]] + b" " + words[top[k % PAIR_WORDS]]: t
                            for k, t in zip(keys[best].tolist(), times[best].tolist(), strict=True)})
            for kind, counter in enumerate(seen):
                if len(counter) > 2 * TASK_KEPT:
                    seen[kind] = Counter(dict(counter.most_common(TASK_KEPT)))
    for kind, limit in enumerate((TASK_WORDS, TASK_PAIRS)):
        rows = seen[kind].most_common(limit)
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind + 1] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.binary()),
             pa.array([r[1] for r in rows], pa.int64())], names=["size", "run", "n"])


def find_head(docs: DataFrame) -> Head:
    """The most frequent words and pairs over all texts; bounded by ``HEAD_WORDS`` and ``HEAD_PAIRS``."""
    listed = docs.select("text").mapInArrow(task_head, "size int, run binary, n bigint").groupBy("size", "run").agg(F.sum("n").alias("n"))
    listed = scratch(docs.sparkSession, "head").table(listed, "runs")

    def top(size: int, limit: int) -> list[bytes]:
        return [bytes(r["run"]) for r in listed.filter(F.col("size") == size).orderBy(F.desc("n"), "run").limit(limit).collect()]

    words = top(1, HEAD_WORDS)
    place = {w: i for i, w in enumerate(words[:PAIR_WORDS])}
    pairs = [tuple(place.get(w) for w in run.split(b" ")) for run in top(2, HEAD_PAIRS)]
    return Head(words, [(a, b) for a, b in pairs if a is not None and b is not None])


# --- bucket totals and weights -------------------------------------------------------------------------


def bucket_totals(docs: DataFrame, head: Head, buckets: int = BUCKETS) -> list[int]:
    """Features per bucket over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, totals = Features(head), np.zeros(buckets, np.int64)
        for batch in batches:
            texts = texts_of(batch.column(0))
            for low, high in grouped(texts):
                for crc, _ in features.crcs(texts[low:high])[0]:
                    totals += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        full = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(totals[full])], names=["bucket", "n"])

    counts = [0] * buckets
    for row in docs.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]  # one row a bucket
    return counts


def gains_of(source: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares of each bucket in the target and in the source)."""
    size, s_all, t_all = len(source), sum(source), sum(target)
    return np.array([
        math.floor(SCALE * math.log((t + 1.0) * (s_all + float(size)) / ((s + 1.0) * (t_all + float(size)))))
        for s, t in zip(source, target, strict=True)], np.int64)


def weigh(docs: DataFrame, head: Head, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, limit = Features(head), np.uint32(len(gains))
        for batch in batches:
            texts = texts_of(batch.column(1))
            words, number, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for low, high in grouped(texts):
                found, words[low:high] = features.crcs(texts[low:high])
                for crc, text in found:
                    n = np.bincount(text, minlength=high - low)
                    sums = np.concatenate(([0], np.cumsum(gains[crc % limit])))
                    ends = np.cumsum(n)
                    number[low:high] += n
                    weight[low:high] += sums[ends] - sums[ends - n]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(number), pa.array(weight)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(
    docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
    seed: int = SEED, store: Scratch | None = None,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): one row per row of ``docs`` (doc_id, text).

    ``target`` has a text column. Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Of
    the documents with at least ``min_words`` words, ``share`` per cent (rounded down) with the highest scores are
    drawn and ranked 1, 2, 3...; all others have a null rank. Score: weight plus floor(1000 Gumbel), the noise drawn
    by the sha256 of ``seed:doc_id`` (a null id counts as empty). Ties go to the smaller doc_id, null ids last; rows
    with one doc_id are documents of their own, ordered by their features and weight. Null and empty texts have no
    features and weight 0. Other columns play no part. An empty ``docs`` gives an empty result, an empty target a
    target in which all buckets are alike.
    """
    spark = docs.sparkSession
    store = store or scratch(spark, "importance")
    head = find_head(docs)
    gains = gains_of(bucket_totals(docs, head, buckets), bucket_totals(target, head, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = (F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    noise = F.floor(-SCALE * F.log(-F.log(draw)))
    weighed = weigh(docs, head, gains).select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score"), F.monotonically_increasing_id().alias("_row"))
    scored, seen = store.measured(weighed, "scored", n=F.count_if(F.col("n_words") >= min_words))
    able = F.col("n_words") >= min_words

    # Ranks over all partitions: sorted by ranges, numbered within each, plus the rows of the ranges before. Equal
    # rows are told apart by their place, so that no range has to hold all of them.
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight", "_row"]
    placed = store.table(scored.filter(able).orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_m", 33)
    offsets, total = [], 0
    for row in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect():  # one row a range
        offsets.append((row["p"], total))
        total += row["n"]
    table = spark.createDataFrame(offsets, "_p bigint, _before bigint")
    rank = F.col("_before") + F.col("_m") - F.shiftleft(F.col("_p"), 33) + 1
    limit = share * seen["n"] // 100
    ranked = placed.join(F.broadcast(table), part == F.col("_p")).withColumn("rank", F.when(rank <= limit, rank))
    rest = scored.filter(~able).withColumn("rank", F.lit(None).cast("bigint"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))


def drawn_documents(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The documents whose doc_id has a rank, unchanged."""
    ids = decisions.filter("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    wanted = docs.select(F.struct("*").alias("_row"))
    return wanted.join(ids, F.col("_row.doc_id").eqNullSafe(F.col("_drawn")), "left_semi").select("_row.*")
