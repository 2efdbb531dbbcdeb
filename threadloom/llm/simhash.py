"""SimHash near-duplicates by anchor-point covering.

Fingerprints: 64 bits over hashed word shingles. Two fingerprints within ``max_bits`` differ in at most one
bit on at least one of ``parts`` equal sections (pigeonhole, parts = max_bits // 2 + 1). In each section the
code words of a perfect Hamming code are the anchors: its covering radius is 1, so each fingerprint has an
anchor within 1 and any partner, one bit away, is within 2 of the same anchor. Every fingerprint is therefore
replicated to all anchors within covering radius plus threshold, 1 + 1 (16 of them at 31 bits), and
fingerprints are compared per anchor over all their bits. Equal fingerprints are merged first. An anchor
reports a spanning forest of its links, never all pairs; connected components follow from these.

An anchor with more than ``BLOCK`` members is not compared in one go: its members are handed on in blocks and
pairs of blocks are compared as separate groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import LOWER_BYTES, as_bytes, partitions, scratch
from threadloom.session import Scratch

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BLOCK = 4096  # members of an anchor compared together


def fingerprint(text: bytes | None, words: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, bit i set if it is set in over half of the shingles' XXH64 hashes; 0 without words."""
    parts = (text or b"").translate(LOWER_BYTES).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return digest(joined, seed)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1:].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 16):
        part = hashes[low: low + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): one row per input row, the fingerprint as a signed long. Null text counts as empty."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words, seed) for t in as_bytes(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, fp bigint")


def sections(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, coded bits) of each section; the coded bits are the longest 2^r - 1 that fit in it."""
    parts = max_bits // 2 + 1
    length = 64 // parts
    coded = (1 << (length + 1).bit_length() - 1) - 1
    return [(i * length, coded) for i in range(parts)]


def anchors(fps: np.ndarray, section: int, coded: int) -> np.ndarray:
    """(n, (coded + 1) / 2): the code words within 2 of each section value.

    The syndrome s is the xor of the numbers (from 1) of the set bits. Flipping the bits i and i xor s gives a
    code word, where bit 0 stands for no flip. A value that is a code word has itself only; it fills its row.
    """
    values = (fps >> np.uint64(section)) & np.uint64((1 << coded) - 1)
    numbers = np.arange(1, coded + 1)
    syndrome = np.zeros(len(fps), np.int64)
    for k in range(coded.bit_length()):
        mask = np.uint64(sum(1 << (int(i) - 1) for i in numbers if i >> k & 1))
        syndrome |= (np.bitwise_count(values & mask).astype(np.int64) & 1) << k
    flips = np.concatenate(([0], 1 << (numbers - 1))).astype(np.uint64)
    one = np.arange(coded + 1)[None, :]
    other = one ^ syndrome[:, None]
    low = one < other
    out = np.repeat(values[:, None], (coded + 1) // 2, axis=1)
    moved = syndrome > 0
    pairs = (flips[one] ^ flips[other])[moved][low[moved]].reshape(-1, (coded + 1) // 2)
    out[moved] ^= pairs
    return out


def placed(fps: DataFrame, max_bits: int) -> DataFrame:
    """(cell, fp): every fingerprint once per anchor; a cell is an anchor of a section."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for number, (first, coded) in enumerate(sections(max_bits)):
                codes = anchors(values, first, coded)
                home = np.zeros(codes.shape, bool)
                home[:, 0] = True
                keep = home | (codes != codes[:, :1])  # a code word has one anchor
                cells = (codes[keep] | np.uint64(number << 60)).view(np.int64)
                owners = np.repeat(values, keep.sum(axis=1)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(owners)], names=["cell", "fp"])

    return fps.mapInArrow(run, "cell bigint, fp bigint")


class Forest:
    """Union-find over positions 0..n-1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def cell_links(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one set of distinct fingerprints."""
    forest, links = Forest(len(values)), []
    for i in range(len(values) - 1):
        near = np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= max_bits)
        links += [(i, i + 1 + j) for j in near.tolist() if forest.join(i, i + 1 + j)]
    return links


def small_links(cells: np.ndarray, values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in sorted runs of equal cells, by comparing each row with the k-th after it, k = 1, 2, ..."""
    left, right, k = [], [], 1
    at = np.arange(len(cells))
    while True:
        at = at[at + k < len(cells)]
        at = at[cells[at] == cells[at + k]]
        if not len(at):
            break
        near = at[np.bitwise_count(values[at] ^ values[at + k]) <= max_bits]
        left.append(near)
        right.append(near + k)
        k += 1
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = np.concatenate(left), np.concatenate(right)
    forest = Forest(len(cells)) if len(left) else None
    keep = np.array([forest.join(a, b) for a, b in zip(left.tolist(), right.tolist(), strict=True)], bool)
    return left[keep], right[keep]


def links(fps: DataFrame, max_bits: int, store: Scratch, block: int = BLOCK) -> DataFrame:
    """(a, b) of linked distinct fingerprints: enough links to give all connected components."""
    spark = fps.sparkSession
    n = partitions(spark)
    rows = placed(fps, max_bits).repartition(n, "cell").sortWithinPartitions("cell", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with a null cell are links; the others are members of large cells, with their block."""

        def out(a, b, cell=None, part=None):
            size = len(a)
            return pa.RecordBatch.from_arrays([
                pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                pa.array(np.full(size, cell, np.int64)) if cell is not None else pa.nulls(size, pa.int64()),
                pa.array(part) if part is not None else pa.nulls(size, pa.int32()),
            ], names=["a", "b", "cell", "part"])

        cells, values, passed = np.zeros(0, np.int64), np.zeros(0, np.uint64), None  # passed: (cell, rows handed on)
        for batch in chain_end(batches):
            if batch is not None:
                cells = np.concatenate((cells, batch.column(0).to_numpy(zero_copy_only=False)))
                values = np.concatenate((values, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            # The last cell may go on in the next batch.
            cut = len(cells) if batch is None else int(np.searchsorted(cells, cells[-1])) if len(cells) else 0
            if len(cells) - cut > block:
                cut = len(cells)
            if not cut:
                continue
            now, cells = cells[:cut], cells[cut:]
            own, values = values[:cut], values[cut:]
            edges = np.flatnonzero(np.diff(now)) + 1
            starts = np.concatenate(([0], edges))
            sizes = np.diff(np.concatenate((starts, [cut])))
            small = np.ones(cut, bool)
            large = sizes > block
            if passed:
                large |= now[starts] == passed[0]
            for s, size in zip(starts[large].tolist(), sizes[large].tolist(), strict=True):
                cell = int(now[s])
                done = passed[1] if passed and passed[0] == cell else 0
                part = ((done + np.arange(size)) // block).astype(np.int32)
                yield out(own[s: s + size], own[s: s + size], cell, part)
                passed = (cell, done + size)
                small[s: s + size] = False
            now, own = now[small], own[small]
            a, b = small_links(now, own, max_bits)
            if len(a):
                yield out(own[a], own[b])

    found = store.table(rows.mapInArrow(compare, "a bigint, b bigint, cell bigint, part int"), "compared")
    large = found.filter("cell is not null").select("cell", "part", F.col("a").alias("fp"))
    parts = large.groupBy("cell").agg((F.max("part") + 1).alias("parts"))
    pairs = large.join(parts, "cell").select(
        "cell", "fp", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with")
    ).select("cell", "fp", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"))

    def compare_blocks(frame):
        import pandas as pd

        values = frame["fp"].to_numpy(np.int64).view(np.uint64)
        edges = cell_links(values, max_bits)
        signed = values.view(np.int64)
        return pd.DataFrame({"a": signed[[a for a, _ in edges]], "b": signed[[b for _, b in edges]]}, dtype="int64")

    more = pairs.groupBy("cell", "low", "high").applyInPandas(compare_blocks, "a bigint, b bigint")
    both = found.filter("cell is null").select("a", "b").unionByName(more)
    return store.table(both.distinct(), "links")


def chain_end(items: Iterator) -> Iterator:
    yield from items
    yield None


def components(edges: DataFrame, store: Scratch) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b): the smallest vertex it reaches.

    Alternating stars: every vertex hands its larger neighbours, then its smaller ones, to its smallest
    neighbour, until the links are stars. Minima are aggregated before the exchange; the joins that follow
    have one row per vertex on one side and are left to the runtime plan to split.
    """
    arcs = store.table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .filter("u <> v").distinct(), "stars")
    while True:
        both = arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store.table(large.filter("u <> v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*").filter("u <> v").distinct()
        before = arcs
        key = F.xxhash64("u", "v").cast("decimal(38,0)")
        arcs, seen = store.measured(small, "stars", n=F.count(F.lit(1)), s=F.sum(key))
        old = before.agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("s")).first()
        store.release(before, large)
        if seen["n"] == old["n"] and seen["s"] == (old["s"] or 0):
            break
    roots = arcs.select(F.col("v").alias("v"), F.col("v").alias("root")).distinct()
    return arcs.select(F.col("u").alias("v"), F.col("v").alias("root")).unionByName(roots)


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED, block: int = BLOCK,
    store: Scratch | None = None,
) -> DataFrame:
    """(doc_id, fp, component_id, root), one row per input row; ``root`` is the group's smallest fingerprint.

    Documents link if their fingerprints differ in at most ``max_bits`` bits; ``component_id`` is the smallest
    doc_id of all documents reachable over links. Null and empty texts have fingerprint 0. Rows with a null
    doc_id take part and carry the group's smallest id, which is null only if all its ids are. Repeated rows
    stay as they are. Other columns play no part. Empty tables give no rows.
    """
    store = store or scratch(docs.sparkSession, "simhash")
    rows = store.table(fingerprints(docs, words, seed), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    edges = links(distinct.select("fp"), max_bits, store, block)
    named = components(edges, store)
    labels = distinct.join(named.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    labels = store.table(labels, "labels")
    groups = labels.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = labels.join(groups, "root").select("fp", "component_id", "root")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, store: Scratch | None = None, **options) -> DataFrame:
    """One document of each group, with the columns of ``docs``: that with the smallest doc_id.

    Of several rows with that doc_id, and of a group that has null ids only, the row with the smallest text
    stays (null before all others; equal rows: any).
    """
    store = store or scratch(docs.sparkSession, "simhash")
    groups = store.table(near_duplicates(docs, store=store, **options), "groups")
    named = groups.filter("component_id is not null").select(F.col("component_id").alias("doc_id")).distinct()
    kept = docs.join(named, "doc_id", "left_semi")
    repeated = groups.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id")
    row = F.struct(*docs.columns).alias("_row")
    if not repeated.isEmpty():
        first = F.min_by(row, F.struct(F.coalesce("text", F.lit("")), F.col("text").isNotNull()))
        one = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(first.alias("_row")).select("_row.*")
        kept = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(one)
    nameless = groups.filter("component_id is null").select("fp", "root").distinct()
    if not nameless.isEmpty():
        rows = docs.filter("doc_id is null")
        texts = fingerprints(rows.select(F.col("text").alias("doc_id"), "text")).withColumnRenamed("doc_id", "_t")
        choice = F.min_by(F.struct("_t"), F.struct(F.coalesce("_t", F.lit("")), F.col("_t").isNotNull()))
        chosen = texts.join(nameless, "fp").groupBy("root").agg(choice.alias("_c")).select("_c._t")
        one = rows.join(chosen, F.col("text").eqNullSafe(F.col("_t"))).groupBy("_t").agg(F.first(row).alias("_row"))
        kept = kept.select(*docs.columns).unionByName(one.select("_row.*"))
    return kept.select(*docs.columns)
