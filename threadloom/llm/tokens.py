"""Token ids of documents in binary files of Simple-8b segments.

Documents are sorted by doc_id over all partitions. A partition writes its documents as segments; a segment
is a header, the table of its documents, the offsets of its blocks and its words (all little-endian):

    magic 8 bytes | partition u32 | reserved u32 | ids before it in the partition u64 | documents u32 |
    ids u64 | blocks u32 | words u64 | doc_id i64 and null flag u8 and n_tokens u64, each for all documents |
    block offsets u32 | words u64 | crc32 of all this u32

Segments follow each other with one line feed between them. The first id of a document in the whole set is
the ids of earlier partitions (one number per partition) plus the ids before it in its partition.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import simple8b
from threadloom.llm.common import LOWER_BYTES, as_bytes, partitions, read_blobs, write_blobs

MAGIC = b"S8BIDS01"
HEAD = struct.Struct("<8sIIQIQIQ")
SEGMENT_IDS = 1 << 18  # a segment closes at so many ids; a document is never split
SEGMENTS_PER_FILE = 16
CACHED_WORDS = 300_000  # per generation of a Python worker's cache
WORD_END = "</w>"
TOGETHER = 64  # unknown words per call: calls cost little, and long texts more for each word
PUNCTUATION = b".,;:!?#$%&*()+-/=@[]^_{}~\"\\`"  # without the apostrophe, which can start a token, and < | >


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return Tokenizer.from_file(path)


class WordEncoder:
    """Ids of whole texts. A batch is split into words by Arrow, its distinct words are looked up in a cache, and
    the ids of all words are gathered by numpy. Words not in the cache go to the tokenizer together.

    Right for tokenizers that drop white space, lower-case A-Z, mark word ends, and never join characters across
    white space or between a letter or digit and ASCII punctuation. ``probe`` checks this on the tokenizer before
    use; where it fails, texts go to the tokenizer whole. The cache holds ids as little-endian 32-bit bytes.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}  # the generation before; a word in use moves back to the young one
        self.by_word = self.probe()

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def probe(self) -> bool:
        text = "The CAT, sat!\n on\tThe Élan. x2; don't?? stop: 9."
        parts = [p for w in text.lower().split() for p in (w.rstrip(".,;:!?"), w[len(w.rstrip(".,;:!?")):]) if p]
        whole, *pieces = self.plain([text, *parts])
        return np.array_equal(whole, np.concatenate(pieces))

    def stands_alone(self, last: str) -> bool:
        """Whether a word may be cut after this character. Some letters are normalised to a letter and a mark, and
        the mark then belongs with the punctuation."""
        if last.isascii():
            return last.isalnum()
        found = self.tokenizer.normalizer.normalize_str(last) if self.tokenizer.normalizer else last
        return last.isalpha() and len(found) == 1 and found.isalpha()

    def keep(self, word: bytes, ids: bytes) -> bytes:
        if len(word) <= 64:
            if len(self.young) >= CACHED_WORDS:
                self.young, self.old = {}, self.young
            self.young[word] = ids
        return ids

    def ids(self, word: bytes) -> bytes:
        found = self.young.get(word)
        if found is not None:
            return found
        found = self.old.get(word)
        if found is None:
            stem = word.rstrip(PUNCTUATION)
            last = stem[-4:].decode(errors="ignore")[-1:]
            if len(stem) < len(word) and self.stands_alone(last):
                found = self.ids(stem) + self.ids(word[len(stem):])
            else:
                found = self.plain([word.decode()])[0].tobytes()
        return self.keep(word, found)

    def learn(self, words: list[bytes]) -> None:
        """Bring unknown words of letters into the cache. They go to the tokenizer many at a time: their ids part
        at word ends. Where some word has several parts, all of that call are left to ``ids``."""
        old, young = self.old, self.young
        stems = {w.rstrip(PUNCTUATION) for w in words if w not in old}
        fresh = [s for s in stems if s not in young and s not in old and s.decode().isalpha()]
        groups = [fresh[low: low + TOGETHER] for low in range(0, len(fresh), TOGETHER)]
        for group, found in zip(groups, self.plain([b" ".join(g).decode() for g in groups]), strict=True):
            stops = np.flatnonzero(self.ends[found]) + 1
            if len(stops) == len(group):
                flat, stops = found.tobytes(), (4 * stops).tolist()
                for word, a, b in zip(group, [0, *stops], stops):
                    self.keep(word, flat[a:b])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the ids of all texts behind each other, and the number of ids of each text."""
        if not self.by_word:
            found = self.plain(texts.to_pylist())
            return np.concatenate([np.zeros(0, "<u4"), *found]), np.array([len(f) for f in found], np.int64)
        # A special token's string is matched before lower-casing.
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(texts)  # may give empty words, which have no ids
        coded = split.flatten().dictionary_encode()
        words = as_bytes(coded.dictionary)
        found = list(map(self.young.get, words))
        if None in found:
            self.learn([w for w, x in zip(words, found, strict=True) if x is None])
            found = list(map(self.young.get, words))
            found = [self.ids(w) if x is None else x for w, x in zip(words, found, strict=True)]
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start = np.cumsum(size) - size
        word = coded.indices.to_numpy()
        n = size[word]
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
        ids = flat[np.arange(ends[-1]) + np.repeat(start[word] - ends[:-1], n)]
        last = np.cumsum(pc.list_value_length(split).to_numpy(), dtype=np.int64)
        return ids, np.diff(ends[last], prepend=0)


def pack_segment(part: int, before: int, doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    words, offsets = simple8b.encode(ids)
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], "u1")
    body = b"".join((
        HEAD.pack(MAGIC, part, 0, before, len(doc_ids), len(ids), len(offsets), len(words)),
        keys.tobytes(), nulls.tobytes(), np.array(lengths, "<u8").tobytes(),
        offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes(),
    ))
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_segments(content: bytes) -> Iterator[tuple]:
    """(partition, ids before, doc_ids, lengths, ids) of every segment of a file; checks sums and magic."""
    at = 0
    while at < len(content):
        magic, part, _, before, docs, n, blocks, words = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        place, arrays = at + HEAD.size, []
        for kind, count in (("<i8", docs), ("u1", docs), ("<u8", docs), ("<u4", blocks), ("<u8", words)):
            arrays.append(np.frombuffer(content, kind, count, place))
            place += arrays[-1].nbytes
        if struct.unpack_from("<I", content, place)[0] != zlib.crc32(memoryview(content)[at:place]):
            raise ValueError(f"damaged segment at byte {at}")
        keys, nulls, lengths, offsets, coded = arrays
        ids = simple8b.decode(coded, offsets, n)
        yield part, before, [None if e else int(k) for k, e in zip(keys, nulls, strict=True)], lengths, ids
        at = place + 5  # the sum and the line feed


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Tokenise whole texts (null as empty), append ``end_id`` to each document, write the files under ``path``.

    Order: doc_id ascending, nulls first; equal ids by the hash of the text. ``tokenizer`` is the file's path,
    which every executor can read. The doc_id is an integer; other columns play no part.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keys = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = WordEncoder(tokenizer), TaskContext.get().partitionId()
        before, doc_ids, lengths, ids, held = 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            blob = pack_segment(part, before, doc_ids, lengths, np.concatenate(ids))
            return pa.RecordBatch.from_pydict({"segment": pa.array([blob], pa.binary())})

        for batch in batches:
            found, sizes = encoder.encode(batch.column(1))
            found = np.insert(found, np.cumsum(sizes), end_id)
            ends = np.cumsum(sizes + 1).tolist()
            for doc, low, high in zip(batch.column(0).to_pylist(), [0, *ends], ends):
                doc_ids.append(doc)
                lengths.append(high - low)
                ids.append(found[low:high])
                held += high - low
                if held >= SEGMENT_IDS:
                    yield close()
                    before, doc_ids, lengths, ids, held = before + held, [], [], [], 0
        if doc_ids:
            yield close()

    write_blobs(rows.mapInArrow(segments, "segment binary"), "segment", path, SEGMENTS_PER_FILE)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), decoded from the files; ``start`` counts over all documents.

    The crc32 is over the ids as little-endian unsigned 32-bit integers.
    """
    schema = "part int, before bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                for part, before, doc_ids, lengths, ids in unpack_segments(content.as_py()):
                    small = ids.astype("<u4")
                    ends = np.cumsum(lengths.astype(np.int64))
                    starts = ends - lengths.astype(np.int64)
                    sums = [zlib.crc32(small[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(doc_ids), part, np.int32)), pa.array(before + starts),
                        pa.array(doc_ids, pa.int64()), pa.array(lengths.astype(np.int64)), pa.array(sums, pa.int64()),
                    ], names=["part", "before", "doc_id", "n_tokens", "ids_crc32"])

    rows = read_blobs(spark, path).mapInArrow(parse, schema)
    heads = read_blobs(spark, path).mapInArrow(segment_sizes, "part int, n bigint")
    totals = heads.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # one row per partition
    offsets, total = [], 0
    for row in totals:
        offsets.append((row["part"], total))
        total += row["n"]
    table = spark.createDataFrame(offsets, "part int, earlier bigint")
    return rows.join(F.broadcast(table), "part").select(
        "doc_id", (F.col("earlier") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def segment_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(partition, ids) of every segment, from the headers alone."""
    for batch in batches:
        for content in batch.column(1):
            content, at, parts, sizes = content.as_py(), 0, [], []
            while at < len(content):
                _, part, _, _, docs, n, blocks, words = HEAD.unpack_from(content, at)
                parts.append(part)
                sizes.append(n)
                at += HEAD.size + 17 * docs + 4 * blocks + 8 * words + 5
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(sizes, pa.int64())], names=["part", "n"])
