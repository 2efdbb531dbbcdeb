"""Centroid clustering and importance resampling: against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import centroids, importance

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- centroid clustering ----------------------------------------------------------------------------


def clusters_plain(rows, k, rounds, size, seed=1):
    vectors = []
    for vec_id, e in rows:
        if e is not None and len(e) == size and all(x is not None and math.isfinite(x) for x in e):
            vectors.append((vec_id, [math.floor(64 * float(np.float32(x))) for x in e]))
    start = sorted(vectors, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(v) for _, v in start[:k]]

    def assign():
        out = []
        for _, v in vectors:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centers]
            out.append((min(range(len(d)), key=lambda i: (d[i], i)), min(d)))
        return out

    for _ in range(rounds):
        of = assign()
        for n in range(len(centers)):
            own = [v for (_, v), (c, _) in zip(vectors, of) if c == n]
            if own:
                centers[n] = [sum(x) // len(own) for x in zip(*own)]
    of = assign()
    per = Counter()
    for c, d in of:
        per[c] += d
    return Counter((i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest())
                   for (i, _), (c, d) in zip(vectors, of))


def odd_vectors(size, n=300):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(rng.choice([-2, 0, 3]), 0.7) for _ in range(size)]) for i in range(n)]
    rows += [rows[3], rows[3], (4, rows[5][1]), (None, rows[9][1]), (None, rows[9][1])] + [(900 + i, rows[7][1]) for i in range(80)]
    rows += [(1000, None), (1001, []), (1002, rows[0][1][:-1]), (1003, rows[0][1] + [0.0]), (1004, [None] + rows[0][1][1:]),
             (1005, [float("nan")] + rows[0][1][1:]), (1006, [float("-inf")] + rows[0][1][1:]), (1007, [0.0] * size), (1008, [0.0] * size)]
    return rows


@pytest.mark.parametrize("k,rounds", [(16, 3), (3, 5), (1, 1), (2, 0)])
def test_cluster_vectors(ready, k, rounds):
    rows = odd_vectors(8)
    df = ready.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    clash = df.select("*", *[F.lit("x").alias(c) for c in ("v", "dots", "cluster", "distance", "label", "e", "inertia")])
    got = Counter(tuple(r) for r in centroids.cluster_vectors(clash, k, rounds, 8).collect())
    assert got == clusters_plain(rows, k, rounds, 8)


def test_few_and_no_vectors(ready):
    schema = "vec_id bigint, embedding array<float>"
    assert centroids.cluster_vectors(ready.createDataFrame([], schema)).collect() == []
    assert centroids.cluster_vectors(ready.createDataFrame([(1, [1.0]), (2, None)], schema)).collect() == []
    rows = [(i, [float(i)] * 64) for i in range(3)]
    got = centroids.cluster_vectors(ready.createDataFrame(rows, schema)).collect()
    assert sorted((r["vec_id"], r["distance"], r["inertia"]) for r in got) == [(0, 0, 0), (1, 0, 0), (2, 0, 0)]
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_vectors(ready.createDataFrame([(1, [1e30] * 64)], schema)).collect()


def test_a_move_touches_changed_components_only():
    rng = np.random.default_rng(3)
    v, old = rng.integers(-99, 99, (50, 6)), rng.integers(-99, 99, (4, 6))
    new = old.copy()
    new[1, 2] += 7
    new[3, [0, 5]] -= 9
    spoiled = v.copy()
    spoiled[:, [1, 3, 4]] = 0  # components that no centroid changes
    dots = v @ old.T
    got, cluster, distance = centroids.Move(new, new - old).apply(v, dots.copy())
    assert (got == v @ new.T).all()
    assert (centroids.Move(new, new - old).apply(spoiled, dots.copy())[0] == got).all()
    plain = ((v[:, None] - new) ** 2).sum(axis=2)
    assert (cluster == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


# --- importance resampling ------------------------------------------------------------------------------


def features_plain(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    return len(w), [" ".join(w[i: i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def resample_plain(docs, target, share=5, min_words=20, buckets=10_000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in features_plain(t)[1])
    t = Counter(bucket(f) for x in target for f in features_plain(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for doc, text in docs:
        n, found = features_plain(text)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        rows.append((doc, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = share * len(able) // 100
    return Counter([(*r, i + 1 if i < drawn else None) for i, r in enumerate(able)] + [(*r, None) for r in rows if r[1] < min_words])


@pytest.mark.parametrize("share", [5, 60])
def test_resample(odd, odd_rows, ready, share):
    extra = [(500, "y" * 64 + " " + "z" * 65 + " w " + "é" * 40 + " " + "y" * 3000 + " q\x00r_s'T 9"), (501, "ß" * 33 + " A" * 40), (502, "a b")]
    docs = odd.select("doc_id", "text", F.lit("x").alias("rank"), F.lit(1).alias("n_words"), F.lit(2).alias("_row")).unionByName(
        ready.createDataFrame([(i, t, "x", 1, 2) for i, t in extra], "doc_id bigint, text string, rank string, n_words int, _row int"))
    target = [" ".join(t.split()[:30]) for _, t, *_ in odd_rows[:12]] + [None, "", "é Ü 12", extra[0][1]]
    table = ready.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = importance.resample(docs, table, share=share)
    assert Counter(tuple(r) for r in got.collect()) == resample_plain([(r[0], r[1]) for r in odd_rows] + extra, target, share)
    drawn = {r["doc_id"] for r in got.filter("rank is not null").collect()}
    kept = importance.drawn_documents(docs, got)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == drawn


@pytest.mark.parametrize("head", [
    importance.Head([], []), importance.Head([b"a", b"b", b"\xc3\xa9"], [(0, 1), (1, 0), (2, 2)]),
    importance.Head([f"a{i}".encode() for i in range(2000)], [(i, i + 1) for i in range(1023)])])
def test_head_and_tail_agree(head):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "B", "é", "a1", "a7", "a8", "a1500", "x" * 64, "x" * 65, "x" * 200, "--", "\n"]) for _ in range(n))
             for n in (0, 1, 2, 3, 40, 400)] + ["", "..", "a"]
    found, counts = importance.Features(head).crcs([t.encode() for t in texts])
    for i, text in enumerate(texts):
        n, want = features_plain(text)
        got = [int(c) for crc, of in found for c in crc[of == i]]
        assert counts[i] == n and got == [zlib.crc32(f.encode()) for f in want]


def test_found_head(ready):
    docs = ready.createDataFrame([("the cat, the dog. " * 5 + f"w{i}" + "v" * 70,) for i in range(50)] + [(None,)], "text string").repartition(3)
    head = importance.find_head(docs)
    assert set(head.words[:3]) == {b"the", b"cat", b"dog"} and head.words[0] == b"the"
    assert all(len(w) <= importance.HEAD_BYTES for w in head.words)
    pairs = {(head.words[a], head.words[b]) for a, b in head.pairs}
    assert {(b"the", b"cat"), (b"cat", b"the"), (b"the", b"dog"), (b"dog", b"the")} <= pairs


def test_resample_edges(none, ready):
    table = ready.createDataFrame([("a b c",)], "text string")
    assert importance.resample(none, table).count() == 0
    docs = ready.createDataFrame([(1, "a b " * 20), (2, "a b " * 20), (3, None)], "doc_id bigint, text string")
    empty = ready.createDataFrame([], "text string")
    got = Counter(tuple(r) for r in importance.resample(docs, empty, share=100).collect())
    assert got == resample_plain([(1, "a b " * 20), (2, "a b " * 20), (3, None)], [], 100)
