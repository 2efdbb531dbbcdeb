"""Language-model scores by stupid backoff over character n-grams, computed relationally.

Counting: every document's n-grams of the highest order, framed by padding at its start, are summed into one
table, partitioned by the hash of the n-gram. Counts of lower orders and of contexts are sums over that table.
Scoring: each distinct n-gram gets its backoff score from these tables; documents are exploded into their
distinct n-grams with frequencies, joined to the scores, and summed per document.

The score table is broadcast up to ``BROADCAST_ROWS`` rows (about 40 MB); beyond, both sides are shuffled and
the runtime plan splits hot n-grams, as the table has one row an n-gram.

``score_words`` is the same model over words: bigrams that back off to single words. Its tables grow with the
input; it has no broadcast of its own, and keys are 64-bit hashes of words and of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import LOWER_BYTES, as_bytes, once, scratch
from threadloom.llm.fingerprints import text_words
from threadloom.session import Scratch

ORDER = 3
MIN_COUNT = 2  # an n-gram seen less often backs off; single characters never do
BACKOFF = 0.4  # fixed value: the published factor
UNIT = 21  # bits of a code point: three fit in a long, so keys are exact
PAD = (1 << UNIT) - 1
BROADCAST_ROWS = 1_000_000


def normal(text: bytes | None) -> str:
    """A-Z lower-cased, runs of ASCII white space as one space, none at the ends."""
    return b" ".join((text or b"").translate(LOWER_BYTES).split()).decode()


def grams(text: bytes | None, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, one ending at each character, as packed code points, and their frequencies."""
    codes = np.frombuffer(normal(text).encode("utf-32-le"), "<u4").astype(np.int64)
    if not len(codes):
        return codes, codes
    framed = np.concatenate((np.full(order - 1, PAD, np.int64), codes))
    keys = np.zeros(len(codes), np.int64)
    for k in range(order):
        keys = keys << UNIT | framed[k: k + len(codes)]
    return np.unique(keys, return_counts=True)


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, n) over all documents; batches are summed in the worker, tasks before the exchange."""
    if not 1 <= order <= 63 // UNIT:
        raise ValueError(f"order has to be from 1 to {63 // UNIT}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grams(t, order) for t in as_bytes(batch.column(0))]
            if found:
                keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in found]), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], names=["key", "n"])

    return docs.select("text").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def exploded(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, key, tf): the distinct n-grams of each row, and one row with a null key and no weight."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Slices bound the exploded batch, as a long text has many n-grams.
            for low in range(0, batch.num_rows, 100):
                part = batch.slice(low, 100)
                found = [grams(t, order) for t in as_bytes(part.column(1))]
                sizes = [len(k) for k, _ in found]
                at = np.concatenate((np.repeat(np.arange(len(sizes)), sizes), np.arange(len(sizes))))
                keys = np.concatenate([k for k, _ in found])
                tf = np.concatenate([*(c for _, c in found), np.zeros(len(sizes), np.int64)])
                keys = pa.concat_arrays([pa.array(keys.astype(np.int64)), pa.nulls(len(sizes), pa.int64())])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at)), keys, pa.array(tf.astype(np.int64))], names=["doc_id", "key", "tf"])

    return rows.mapInArrow(run, f"doc_id {kind}, key bigint, tf bigint")


def gram_scores(wanted: DataFrame, counts: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT) -> DataFrame:
    """(key, log_s) for the n-grams of ``wanted`` (key) by the counts of the training corpus.

    log_s is ln(count / count of the context) at the longest suffix seen ``min_count`` times, plus ln 0.4 per
    order backed off. A character the corpus does not hold gets 1 / (characters + 1) at the lowest order.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    scored, choices = wanted.select("key").distinct(), []
    for level in range(order, 0, -1):
        mask = F.lit((1 << UNIT * level) - 1).cast("bigint")
        own = F.col("key").bitwiseAND(mask)
        n = counts.groupBy(own.alias(f"k{level}")).agg(F.sum("n").alias(f"n{level}"))
        context = F.shiftright(own, UNIT)
        around = counts.groupBy(context.alias(f"c{level}")).agg(F.sum("n").alias(f"m{level}"))
        scored = scored.withColumns({f"k{level}": own, f"c{level}": context})
        scored = scored.join(n, f"k{level}", "left").join(around, f"c{level}", "left")
        chance = F.log(F.col(f"n{level}") / F.col(f"m{level}")) + (order - level) * math.log(BACKOFF)
        choices.append(F.when(F.col(f"n{level}") >= (min_count if level > 1 else 1), chance))
    unseen = F.lit(-math.log(total + 1) + (order - 1) * math.log(BACKOFF))
    return scored.select("key", F.coalesce(*choices, unseen).alias("log_s"))


def score_documents(
    docs: DataFrame, corpus: DataFrame | None = None, order: int = ORDER, min_count: int = MIN_COUNT,
    broadcast_rows: int = BROADCAST_ROWS, store: Scratch | None = None,
) -> DataFrame:
    """(doc_id, n_units, log_score, mean_log_score) of whole texts under a model of ``corpus`` (default: ``docs``).

    ``n_units`` is the number of characters scored. Rows that share a doc_id (also null) are one document. Null,
    empty and blank texts have 0 units, score 0 and a null mean. An empty corpus knows no character. Other
    columns play no part.
    """
    store = store or scratch(docs.sparkSession, "lm")
    own = store.table(gram_counts(docs, order), "counts")
    counts = own if corpus is None else store.table(gram_counts(corpus, order), "corpus")
    scores = store.table(gram_scores(own, counts, order, min_count), "scores")
    if scores.count() <= broadcast_rows:
        scores = F.broadcast(scores)
    parts = exploded(docs, order).join(scores, "key", "left")
    sums = parts.groupBy("doc_id").agg(
        F.sum("tf").alias("n_units"), F.coalesce(F.sum(F.col("tf") * F.col("log_s")), F.lit(0.0)).alias("log_score")
    )
    return sums.withColumn("mean_log_score", F.try_divide("log_score", "n_units"))


def word_pairs(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, before, word, n) of the distinct word pairs of a text, from its words' hashes; 0 stands before the first."""
    if not len(hashes):
        return (hashes,) * 4
    before = np.concatenate((np.zeros(1, np.int64), hashes[:-1]))
    mixed = before.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + hashes.view(np.uint64)  # wraps
    keys, at, n = np.unique(mixed.view(np.int64), return_index=True, return_counts=True)
    return keys, before[at], hashes[at], n.astype(np.int64)


def word_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, hashes): the hash of every word of the lower-cased (A-Z) text, in order."""
    return once(docs.select("doc_id", text_words(F.col("text")).alias("_w")),
                hashes=F.coalesce(F.transform("_w", lambda w: F.xxhash64(w)), F.array().cast("array<bigint>"))).drop("_w")


def pair_lists(column) -> list[tuple[np.ndarray, ...]]:
    """The word pairs of every row of an Arrow column of hash lists."""
    values, ends = np.array(column.values, np.int64), np.array(column.offsets)
    return [word_pairs(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def pair_counts(docs: DataFrame) -> DataFrame:
    """(key, before, word, n) over all documents; batches are summed in the worker, tasks before the exchange."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pair_lists(batch.column(0))
            if found:
                keys, before, word, n = (np.concatenate(x) for x in zip(*found, strict=True))
                keys, first, at = np.unique(keys, return_index=True, return_inverse=True)
                n = np.bincount(at, n, len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, before[first], word[first], n)],
                                                 names=["key", "before", "word", "n"])

    found = word_hashes(docs).select("hashes").mapInArrow(run, "key bigint, before bigint, word bigint, n bigint")
    return found.groupBy("key").agg(F.min("before").alias("before"), F.min("word").alias("word"), F.sum("n").alias("n"))


def exploded_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, key, tf): the distinct word pairs of each row, and one row with a null key and no weight."""
    rows = word_hashes(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 100):
                part = batch.slice(low, 100)
                found = pair_lists(part.column(1))
                sizes = [len(f[0]) for f in found]
                at = np.concatenate((np.repeat(np.arange(len(sizes)), sizes), np.arange(len(sizes))))
                keys = pa.concat_arrays([pa.array(np.concatenate([f[0] for f in found])), pa.nulls(len(sizes), pa.int64())])
                tf = np.concatenate([*(f[3] for f in found), np.zeros(len(sizes), np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at)), keys, pa.array(tf.astype(np.int64))], names=["doc_id", "key", "tf"])

    return rows.mapInArrow(run, f"doc_id {kind}, key bigint, tf bigint")


def score_words(
    docs: DataFrame, corpus: DataFrame | None = None, min_count: int = MIN_COUNT, store: Scratch | None = None
) -> DataFrame:
    """(doc_id, n_units, log_score, mean_log_score) under a word model of ``corpus`` (default: ``docs``).

    A word scores ln(count of the pair / count of the word before), if the pair was seen ``min_count`` times, else
    ln 0.4 + ln(count of the word / words); a word the corpus does not hold scores as if seen once in words + 1.
    Otherwise as ``score_documents``; ``n_units`` is the number of words.
    """
    store = store or scratch(docs.sparkSession, "words")
    own = store.table(pair_counts(docs), "pairs")
    counts = own if corpus is None else store.table(pair_counts(corpus), "corpus")
    total = counts.agg(F.sum("n")).first()[0] or 0
    pair = counts.select("key", F.col("n").alias("n2"))
    around = counts.groupBy("before").agg(F.sum("n").alias("m2"))
    word = counts.groupBy("word").agg(F.sum("n").alias("n1"))
    wanted = own.withColumn("n2", F.col("n")) if corpus is None else own.join(pair, "key", "left")
    back = math.log(BACKOFF)
    scores = wanted.join(around, "before", "left").join(word, "word", "left").select("key", F.coalesce(
        F.when(F.col("n2") >= min_count, F.log(F.col("n2") / F.col("m2"))),
        F.log(F.col("n1") / F.lit(float(max(1, total)))) + back, F.lit(back - math.log(total + 1)),
    ).alias("log_s"))
    parts = exploded_pairs(docs).join(store.table(scores, "scores"), "key", "left")
    sums = parts.groupBy("doc_id").agg(
        F.sum("tf").alias("n_units"), F.coalesce(F.sum(F.col("tf") * F.col("log_s")), F.lit(0.0)).alias("log_score")
    )
    return sums.withColumn("mean_log_score", F.try_divide("log_score", "n_units"))
