"""URL filters, fingerprints, decontamination: against plain Python."""

import hashlib
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from threadloom.llm import decontaminate as D
from threadloom.llm import fingerprints as P
from threadloom.llm import queries as Q
from threadloom.llm import urls as U

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


# --- URL filters ------------------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "http://COM/", "http://a.com/x", "https://example.com/en/1?q#f", "x://www.EXAMPLE.com/en/2",
        "http://b.www.example.com/en/", "http://example.com/en", "http://c.net/es/1", "http://c.net/fr/", "http://net/fr/#x",
        "http://net?/fr/", "http://xcom/", "http://a..com/", "http://u@h:80/p", "http://a.com/x://y/", "http://a.com/x", "p\n://ä.com/ü/\n"]


def judge_plain(url, rules, unlisted="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    host, path = raw.translate(LOW), re.match(r"[^?#]*", rest[len(raw):])[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, unlisted))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("blocks", [1, U.MAX_BLOCKS])
def test_judge(ready, blocks):
    rules = [*Q.RULES, ("a.com", "", "block"), ("ä.com", "/ü", "block")] + [(f"h{i}.org", f"/{i}", "block") for i in range(300)]
    urls = URLS + [f"http://www.h{i}.org/{i}/x" for i in range(0, 300, 7)] + [f"http://h{i}.org/x" for i in range(9)]
    pages = ready.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id int, url string, host string")
    pages = pages.select("*", *[F.lit("x").alias(c) for c in ("best", "page", "s", "block", "suffixes")])
    listed = ready.createDataFrame([*rules, (None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge(pages, listed, max_blocks=blocks).collect()}
    assert got == {i: judge_plain(u, rules) for i, u in enumerate(urls)}


def test_judge_empty_and_repeated(ready):
    none = ready.createDataFrame([], "page_id int, url string")
    rules = ready.createDataFrame([("a", "/", "allow"), ("a", "/", "block"), ("b", None, None)], "host string, path string, verdict string")
    assert U.judge(none, rules).count() == 0
    pages = ready.createDataFrame([(1, "x://a/"), (1, "x://a/"), (2, "x://b")], "page_id int, url string")
    assert sorted(tuple(r) for r in U.judge(pages, rules).select("page_id", "rule", "verdict").collect()) == [
        (1, "a/", "block"), (1, "a/", "block"), (2, "b", "block")]
    nothing = U.judge(pages, rules.filter("false"), unlisted="block")
    assert {(r["rule"], r["verdict"]) for r in nothing.collect()} == {(None, "block")}


def test_bloom_has_no_false_negatives(ready):
    keys = ready.range(5000).select(F.concat(F.lit("k"), "id").alias("rule"))
    rows, blocks = U.bloom_blocks(keys, 5000)
    assert blocks == 118 and rows.count() <= blocks
    assert rows.agg(F.max(F.size("bits"))).first()[0] == 8


# --- fingerprints -----------------------------------------------------------------------------------


def chain(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def fingerprint_plain(text):
    w = split_words(text)
    if not w:
        return ""
    hashes = {chain(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {chain(w)}
    bins = {}
    for h in hashes:
        b = (h >> (64 - P.BIN_BITS)) + P.BINS // 2
        bins[b] = min(bins.get(b, h), h)
    out = []
    for b in range(P.BINS):
        value = bins[b] if b in bins else bins[min(bins, key=lambda other: ORDER[b, other])]
        out.append(f"{value & 15:x}")
    return "".join(out)


# Order of the filled bins for an empty one, as the fixture finds it.
ORDER = {}


@pytest.fixture(scope="module")
def order(ready):
    pairs = ready.range(P.BINS).select(F.col("id").cast("int").alias("a")).crossJoin(ready.range(P.BINS).select(F.col("id").cast("int").alias("b")))
    ORDER.update({(r[0], r[1]): r[2] for r in pairs.select("a", "b", F.xxhash64("a", "b")).collect()})


def likeness_plain(a, b):
    if not a or not b:
        return float(a == b)
    share = sum(x == y for x, y in zip(a, b)) / P.BINS
    return max(0.0, (share - 1 / 16) / (15 / 16))


def ring(rows):
    def place(row):
        return (row[0] is None, -(row[0] or 0), chain([row[1] or ""]))
    return sorted(rows, key=place)


@pytest.mark.parametrize("ranges", [1, 7])
def test_edited_fingerprints(odd, odd_rows, order, ranges):
    rows = [(r[0], r[1] or "") for r in ring(odd_rows)]
    want = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        f, e, n = map(fingerprint_plain, (text, edited, after))
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e,
                     round(likeness_plain(f, e), 9), round(likeness_plain(f, n), 9)))
    got = [(*tuple(r)[:5], round(r[5], 9), round(r[6], 9)) for r in P.edited_fingerprints(odd, ranges).collect()]
    assert Counter(got) == Counter(want)


def test_edited_fingerprints_edges(none, ready):
    assert P.edited_fingerprints(none).count() == 0
    one = ready.createDataFrame([(1, "a b c d e f g")], "doc_id bigint, text string")
    row = P.edited_fingerprints(one).first()
    assert row["edited_sha256"] == hashlib.sha256(b"a b c da b c ").hexdigest() and row["near_next"] == 1.0
    kept = P.fingerprint_documents(one.withColumn("fingerprint", F.lit("old")))
    assert kept.columns == ["doc_id", "text", "fingerprint"] and len(kept.first()["fingerprint"]) == P.BINS


def test_likeness_estimates_jaccard(ready):
    rows = []
    for shared in (100, 300, 500):
        a = [f"w{shared}x{i}" for i in range(600)]
        rows.append((shared, " ".join(a), " ".join(a[:shared] + [f"v{shared}y{i}" for i in range(600 - shared)])))
    df = ready.createDataFrame(rows, "shared int, a string, b string")
    df = P.fingerprinted(P.fingerprinted(df, "a", "fa"), "b", "fb").select("shared", P.likeness("fa", "fb").alias("s"))
    for row in df.collect():
        true = (row["shared"] - 4) / (2 * 596 - (row["shared"] - 4))
        assert abs(row["s"] - true) < 0.17


# --- decontamination --------------------------------------------------------------------------------


def contained_plain(docs, items, size=5, t=0.8):
    out = {}
    for item, text in set(items):
        w = split_words(text)
        if not w:
            continue
        k = min(size, len(w))
        own = {tuple(w[i: i + k]) for i in range(len(w) - k + 1)}
        for doc, body in docs:
            b = split_words(body)
            found = len(own & {tuple(b[i: i + k]) for i in range(len(b) - k + 1)})
            if found >= t * len(own) - 1e-9:
                new = (found / len(own), len(own), found)
                out[doc, item] = max(out.get((doc, item), new), new)
    return {(d, i, n, f, round(c, 9)) for (d, i), (c, n, f) in out.items()}


def test_contained_items(odd, odd_rows, ready):
    docs = [(r[0], r[1]) for r in odd_rows]
    long = max((r[1] for r in odd_rows if r[1]), key=len).split()
    items = [(0, " ".join(long[100:140])), (1, " ".join([*long[200:230], "q1", "q2", *long[232:240]])), (2, odd_rows[0][1].upper()),
             (3, "é"), (4, "absent words only here and there"), (5, None), (6, ""), (7, "12 34"), (0, " ".join(long[100:140])),
             (2, "a line that many documents share, with some words"), (None, odd_rows[20][1]), (8, " ".join(long[300:330] + ["z"] * 9))]
    table = ready.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit("x"))
    got = {(*tuple(r)[:4], round(r[4], 9)) for r in D.contained_items(odd, table).collect()}
    assert got == contained_plain(docs, items)
    assert any(r[1] is None for r in got) and any(r[1] == 3 for r in got)
    hit = {r[0] for r in got}
    kept = D.clean_documents(odd, table)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(d for d, _ in docs if d not in hit)


def test_contained_items_empty(odd, none, ready):
    empty = ready.createDataFrame([], "item_id bigint, text string")
    assert D.contained_items(odd, empty).count() == 0
    assert D.contained_items(none, ready.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")).count() == 0
