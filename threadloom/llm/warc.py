"""WARC archives of pages, and their index by an external merge of locally sorted capture runs.

Writing: a page whose payload is long enough and equal to that of a page with a smaller id becomes a revisit
record, which names the digest and the page it repeats; all others are responses. Every task writes its
records as archive files of bounded size; a record is a gzip member of its own, so that its offset and length
in the archive are enough to read it.

Index: each archive is read back record by record and gives a run of captures, sorted by (URL key, time,
page id) and kept as a table. Ranges of that order, cut so that each holds a bounded number of captures even
if all are of one URL, take their slices of all runs; a loser tree merges the k sorted slices of a range.
So range after range, in order, is the globally ordered capture history.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm.common import as_bytes, partitions, read_blobs, scratch, write_blobs
from threadloom.session import Scratch

MIN_BYTES = 100  # smaller payloads are never revisits
RECORDS_PER_FILE = 2000
STEP = 1 << 14  # bytes handed to the decompressor at once
RANGE_ROWS = 200_000  # captures per merge task
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)

ENTRY = ("run string, urlkey string, ts string, page_id bigint, payload_bytes bigint, payload_digest string, "
         "record_type string, refers_to bigint, offset bigint, length bigint")
FIELDS = [f.split(" ")[0] for f in ENTRY.split(", ")]


def url_key(url: str) -> str:
    """Sort key of a URL: scheme dropped, host labels reversed, then the rest: ``com,example)/path?query``."""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    end = min([i for i in map(rest.find, "/?") if i >= 0], default=len(rest))
    host, tail = rest[:end].lower(), rest[end:] or "/"
    return ",".join(reversed(host.split("."))) + ")" + tail


def digests(pages: DataFrame) -> DataFrame:
    """(page_id, payload_digest, payload_bytes)."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select("page_id", F.sha2(payload, 256).alias("payload_digest"),
                        F.octet_length(payload).cast("bigint").alias("payload_bytes"))


def revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages that repeat a page with a smaller id; one row a page and payload.

    Null ids neither lead nor follow.
    """
    rows = digests(pages).filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    first = rows.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    again = rows.join(first.filter("n > 1").drop("n"), "payload_digest").filter("page_id > refers_to")
    return again.select("page_id", "payload_digest", "refers_to").distinct()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record without the two line ends that close it."""
    digest = hashlib.sha256(payload).hexdigest()
    when = EPOCH + timedelta(seconds=(page_id or 0) % 10**9)
    kind = "response" if refers_to is None else "revisit"
    # A header ends at the line; percent-encode what would break it.
    target = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        f"WARC-Type: {kind}", f"WARC-Target-URI: {target}", f"WARC-Date: {when:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}", "Content-Type: text/html",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + payload


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, bytes) of every gzip member; the writer parts them by a line feed."""
    view, at = memoryview(content), 0
    while at < len(content):
        reader, parts, end = zlib.decompressobj(zlib.MAX_WBITS | 16), [], at
        while not reader.eof:
            if end >= len(content):
                raise ValueError(f"the record at byte {at} is cut off")
            parts.append(reader.decompress(view[end: end + STEP]))
            end = min(end + STEP, len(content))
        end -= len(reader.unused_data)
        yield at, end - at, b"".join(parts)
        at = end + 1


def records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record of an archive."""
    for at, length, data in members(content):
        stop = data.index(b"\r\n\r\n")
        lines = data[:stop].decode().split("\r\n")
        if lines[0].encode() != VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        block = data[stop + 4: -4]
        if len(block) != int(headers["Content-Length"]) or data[-4:] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield at, length, headers, block


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, per_file: int = RECORDS_PER_FILE) -> None:
    """One record per row of ``pages`` (page_id, url, html); null html is an empty payload, null url an empty one."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    seen = revisits(rows, min_bytes)
    # Rows that share an id may differ in their payloads, so the payload is part of the key.
    digest = F.sha2(F.coalesce("html", F.lit("")), 256).alias("payload_digest")
    joined = rows.select("*", digest).join(seen, ["page_id", "payload_digest"], "left").select("page_id", "url", "html", "refers_to")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, refs = (batch.column(i).to_pylist() for i in (0, 1, 3))
            out = [gzip.compress(record(i, u, h or b"", r) + b"\r\n\r\n", mtime=0) for i, u, h, r in
                   zip(ids, urls, as_bytes(batch.column(2)), refs, strict=True)]
            yield pa.RecordBatch.from_pydict({"record": pa.array(out, pa.binary())})

    write_blobs(joined.mapInArrow(pack, "record binary"), "record", path, per_file)


def identity(name: str) -> int | None:
    value = name.strip("<>").rsplit(":", 1)[-1]
    return None if value == "none" else int(value)


def order(entry: tuple) -> tuple:
    """Captures in order of URL key, time and page id, null ids first; then by place."""
    return entry[1], entry[2], entry[3] is not None, entry[3] or 0, entry[0], entry[8]


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives, sorted within each; payloads of responses are checked by their digests."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                run, found = name.rsplit("/", 1)[-1], []
                for offset, length, head, block in records(content.as_py()):
                    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].split(":", 1)[1]
                    if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                        raise ValueError(f"payload at byte {offset} of {name} does not fit its digest")
                    refers = identity(head["WARC-Refers-To"]) if kind == "revisit" else None
                    url = head["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                    found.append((run, url_key(url), head["WARC-Date"], identity(head["WARC-Record-ID"]),
                                  int(head["X-Payload-Length"]), digest, kind, refers, offset, length))
                found.sort(key=order)
                yield as_batch(found)

    return read_blobs(spark, path).mapInArrow(parse, ENTRY)


def as_batch(entries: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    types = [kinds[f.split(" ")[1]] for f in ENTRY.split(", ")]
    columns = list(zip(*entries, strict=True)) if entries else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=FIELDS)


class LoserTree:
    """Merge of k sorted iterators: the root is the smallest head, inner nodes keep the losers of their matches."""

    def __init__(self, sources: list[Iterator], key):
        self.sources, self.key, self.k = sources, key, len(sources)
        self.heads: list = [None] * self.k
        self.keys: list = [None] * self.k  # None: exhausted, loses to everything
        for i in range(self.k):
            self.pull(i)
        self.tree = [-1] * max(1, self.k)  # node 0: the winner; 1..k-1: losers
        for i in range(self.k):
            self.play(i)

    def pull(self, i: int) -> None:
        self.heads[i] = next(self.sources[i], None)
        self.keys[i] = None if self.heads[i] is None else self.key(self.heads[i])

    def beats(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def play(self, i: int) -> None:
        """Lead leaf ``i`` to the root; while the tree is built, the first to reach an empty node waits there."""
        node = (i + self.k) // 2
        while node:
            if self.tree[node] == -1:
                self.tree[node] = i
                return
            if self.beats(self.tree[node], i):
                self.tree[node], i = i, self.tree[node]
            node //= 2
        self.tree[0] = i

    def __iter__(self) -> Iterator:
        while self.k and self.keys[self.tree[0]] is not None:
            i = self.tree[0]
            yield self.heads[i]
            self.pull(i)
            self.play(i)


def merged_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures in global order: by partition, and by row within it. ``runs`` is a written table."""
    spark = runs.sparkSession
    total = runs.count()
    ranges = max(partitions(spark), -(-total // range_rows))
    keys = ["urlkey", "ts", F.asc_nulls_first("page_id"), "run", "offset"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        for batch in batches:
            for entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slices.setdefault(entry[0], []).append(entry)
        for entries in slices.values():
            entries.sort(key=order)  # in order already unless the exchange has mixed a run's blocks
        out: list[tuple] = []
        for entry in LoserTree([iter(slices[name]) for name in sorted(slices)], order):
            out.append(entry)
            if len(out) == 10_000:
                yield as_batch(out)
                out = []
        if out:
            yield as_batch(out)

    return runs.select(*FIELDS).repartitionByRange(ranges, *keys).mapInArrow(merge, ENTRY)


def archive(pages: DataFrame, min_bytes: int = MIN_BYTES, store: Scratch | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Write the archives, read them back, and return the merged index: one row per row of ``pages``.

    Equal payloads of at least ``min_bytes`` bytes: the smallest page_id is the response and all rows with a
    larger id are revisits of it; rows that share the smallest id are all responses, and so are rows with a
    null id. Other columns of ``pages`` play no part. An empty table gives an empty index.
    """
    store = store or scratch(pages.sparkSession, "warc")
    path = store.path("archives")
    write_archives(pages, path, min_bytes)
    runs = store.table(capture_runs(pages.sparkSession, path), "runs")
    return merged_index(runs, range_rows)
