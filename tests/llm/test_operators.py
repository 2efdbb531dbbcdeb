"""Line dedup, mixing, WARC, LM scores, SimHash, token files, language ID: against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from threadloom.llm import langid, linededup, lm, mixing, simhash, simple8b, tokens, warc
from threadloom.llm.common import scratch
from threadloom.llm.queries import tokenizer_path

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


# --- line dedup -------------------------------------------------------------------------------------


def lines_plain(rows, min_docs=3):
    def key(line):
        return line.strip(SPACE).translate(LOW)

    holders = defaultdict(list)
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(doc)
    top = {k: max((d for d in ds if d is not None), default=None) for k, ds in holders.items() if len(ds) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in top or top[key(x)] is None or doc == top[key(x)]]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


@pytest.mark.parametrize("batches,fanout", [(1, 3), (5, 2)])
def test_dedup_lines(odd, odd_rows, batches, fanout):
    got = linededup.dedup_lines(odd, batches=batches, fanout=fanout)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert Counter(tuple(r) for r in got.collect()) == lines_plain([(r[0], r[1]) for r in odd_rows])


def test_runs_hold_a_hot_line_a_few_times(ready, none):
    docs = ready.createDataFrame([(i, "the same line in every one of the documents") for i in range(60)], "doc_id bigint, text string")
    runs = linededup.LineRuns(scratch(ready, "t"), fanout=100)
    number, count = linededup.batch_numbers(docs, 3)
    assert count == 3
    for batch in range(count):
        runs.add(linededup.line_hashes(docs.filter(number == batch), 20))
    assert sum(t.count() for t in runs.tables()) == 1 and runs.frequent().first()["top"] == 59
    assert linededup.dedup_lines(none).count() == 0


def test_texts_are_hashed_once(odd, odd_rows, monkeypatch):
    """Many batches: three levels of runs, while the texts are read as often as with a single batch."""
    levels, compact, calls, hashes = [], linededup.LineRuns.compact, [], linededup.line_hashes
    monkeypatch.setattr(linededup.LineRuns, "compact", lambda self, level: (levels.append(level), compact(self, level)))
    monkeypatch.setattr(linededup, "line_hashes", lambda *a: (calls.append(1), hashes(*a))[1])
    monkeypatch.setattr(linededup, "GROWTH", 1)
    got = linededup.dedup_lines(odd, fanout=2, batch_rows=-(-len(odd_rows) // 8))
    assert Counter(tuple(r) for r in got.collect()) == lines_plain([r[:2] for r in odd_rows])
    assert levels == [0, 0, 1, 0, 0, 1, 2] and len(calls) == 1


def test_batches_grow(ready):
    assert [linededup.batch_count(n, 10) for n in (0, 10, 71, 151, 10**6)] == [3, 3, 4, 5, 17]
    docs = ready.range(10_000).select(F.col("id").alias("doc_id"))
    number, count = linededup.batch_numbers(docs, 5)
    sizes = [r["count"] for r in docs.select(number.alias("b")).groupBy("b").count().orderBy("b").collect()]
    assert count == 5 and sum(sizes) == 10_000 and all(1.6 < b / a < 2.5 for a, b in zip(sizes, sizes[1:]))


# --- mixing -----------------------------------------------------------------------------------------


def targets_plain(sizes, repeat=3, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, free, left = sum(sizes.values()), {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= repeat * sizes[s]}
        if not full or not total:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = float(repeat * sizes[s])
            left -= target[s]
        free -= full
    return target


def test_mix(odd, odd_rows):
    first = mixing.mix(odd, blocks=2000, shard_docs=8).drop("pieces")
    got = [tuple(r) for r in first.collect()]
    again = mixing.mix(odd.repartition(2), blocks=2000, shard_docs=8).drop("pieces")
    assert Counter(got) == Counter(tuple(r) for r in again.collect())
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += len(split_words(r[1]))
    want = targets_plain(sizes)
    assert Counter((r[0], r[1]) for r in got) == Counter((r[0], len(split_words(r[1]))) for r in odd_rows)
    by_target = {(sizes[s], round(t, 6)): s for s, t in want.items()}
    assert len(by_target) == len(want)
    taken = Counter()
    for _, size, source_size, target, took, passes in got:
        source = by_target[source_size, round(target, 6)]
        assert passes * size <= took <= 3 * size
        taken[source] += took
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.03 * target + 10


def test_mixed_documents(odd, none, ready):
    rows = mixing.mix(odd, blocks=500, shard_docs=8, carry=("text",)).collect()
    want = Counter()
    for r in rows:
        want[r["doc_id"], r["_c_text"]] += r["passes"]
        if r["pieces"]:
            w = re.findall(r"[^\x20\x09-\x0D]+", r["_c_text"])
            want[r["doc_id"], " ".join(" ".join(w[p["from"]: p["to"]]) for p in r["pieces"])] += 1
    mixed = mixing.mixed_documents(odd, blocks=500, shard_docs=8)
    assert mixed.columns == odd.columns
    assert Counter((r["doc_id"], r["text"]) for r in mixed.collect()) == +want
    assert mixing.mix(none).count() == 0
    blank = ready.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert {tuple(r)[1:5] for r in mixing.mix(blank).collect()} == {(0, 0, 0.0, 0)}


def test_mix_keeps_tiny_sources(ready):
    """One huge source (ten million words) and tiny ones: every source meets its target to the word."""
    rows = [(i, " ".join(["w"] * 50_000), "huge") for i in range(200)]
    rows += [(1000 + i, " ".join(["w"] * n), f"tiny{i}") for i, n in enumerate([1, 2, 3, 7, 90, 900])]
    got = mixing.mix(ready.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += text.count("w")
    want = targets_plain(sizes)
    source, taken = {r[0]: r[2] for r in rows}, Counter()
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - t) <= 1 for s, t in want.items()) and taken["tiny0"] == 3
    # The last pass is runs of a block, not of a few words.
    runs = [p["to"] - p["from"] for r in got if r["size"] > 1000 for p in r["pieces"]]
    assert not runs or sum(runs) / len(runs) >= 200


@pytest.mark.parametrize("quota", [0, 1, 7, 50, 333, 10_000])
def test_apportion(ready, quota):
    rng = random.Random(quota)
    votes = [rng.choice([0, 1, 5, 40, 900]) * rng.random() for _ in range(30)]
    most = [rng.choice([0, 3, 100, 10_000]) for _ in votes]
    seats = [0] * len(votes)
    for _ in range(quota):
        open_ = [i for i, v in enumerate(votes) if seats[i] < most[i] and v > 0]
        if not open_:
            break
        seats[max(open_, key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))] += 1
    rows = [(g, i, v, m, quota) for g in (0, 1) for i, (v, m) in enumerate(zip(votes, most))]
    cells = ready.createDataFrame(rows, "g int, cell bigint, votes double, most bigint, quota bigint")
    got = mixing.apportion(cells, ["g"], scratch(ready, "t"), "cells").select("g", "cell", "seats").collect()
    assert {(r[0], r[1]): r[2] for r in got} == {(g, i): s for g in (0, 1) for i, s in enumerate(seats)}


# --- WARC -------------------------------------------------------------------------------------------


def test_archive(ready):
    html = ["<p>" + "x" * 200 + "\r\n\r\nWARC/1.1\r\n</p>", "short", None, "", "é" * 100, "\n" * 150]
    rows = [(i, f"http://{'abc'[i % 3]}.example.com/{i % 4}?q#f", html[i % 6]) for i in range(60)]
    rows += [(6, "dup id", html[0]), (0, None, html[0]), (None, "x\r\ny %0A", html[0]), (None, None, None), (99, "://", html[4])]
    rows += [(200, "one id", html[0]), (200, "and another text", html[4]), (200, "alone", "z" * 120), (200, "alone too", "short")]
    pages = ready.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4).withColumn("run", F.lit("x"))
    got = warc.archive(pages, range_rows=7).collect()
    want, first = Counter(), {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    for i, u, h in rows:
        b = (h or "").encode()
        again = i is not None and b in first and i > first[b]
        want[i, warc.url_key(u or ""), len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None] += 1
    assert Counter((r["page_id"], r["urlkey"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    assert [warc.order(tuple(r)) for r in got] == sorted(warc.order(tuple(r)) for r in got)
    assert warc.archive(pages.filter("false")).count() == 0


def test_loser_tree():
    rng = random.Random(1)
    for k in range(0, 12):
        lists = [sorted(rng.choices(range(50), k=rng.choice([0, 1, 5, 30]))) for _ in range(k)]
        assert list(warc.LoserTree([iter(x) for x in lists], lambda x: x)) == sorted(sum(lists, []))


# --- LM scores --------------------------------------------------------------------------------------


def lm_plain(docs, corpus, order=3, least=2):
    def text(t):
        return " ".join(split_words(t))

    def grams(t):
        framed = "\0" * (order - 1) + text(t)
        return [framed[i: i + order] for i in range(len(text(t)))]

    full = Counter(g for t in corpus for g in grams(t))
    own, around = Counter(), Counter()
    for g, n in full.items():
        for k in range(1, order + 1):
            own[k, g[-k:]] += n
            around[k, g[-k:-1]] += n
    total = sum(full.values())

    def log_s(g):
        for k in range(order, 0, -1):
            if own[k, g[-k:]] >= (least if k > 1 else 1):
                return math.log(own[k, g[-k:]] / around[k, g[-k:-1]]) + (order - k) * math.log(0.4)
        return -math.log(total + 1) + (order - 1) * math.log(0.4)

    sums = defaultdict(lambda: [0, 0.0])
    for doc, t in docs:
        sums[doc][0] += len(text(t))
        sums[doc][1] += sum(map(log_s, grams(t)))
    return {d: (n, round(s, 6)) for d, (n, s) in sums.items()}


@pytest.mark.parametrize("limit", [0, 10**6])
def test_score_documents(odd, odd_rows, ready, none, limit):
    docs = [(r[0], r[1]) for r in odd_rows]
    got = {r[0]: (r[1], round(r[2], 6)) for r in lm.score_documents(odd, broadcast_rows=limit).collect()}
    assert got == lm_plain(docs, [t for _, t in docs])
    corpus = ready.createDataFrame([("abc abd",), (None,)], "text string")
    got = {r[0]: (r[1], round(r[2], 6)) for r in lm.score_documents(odd, corpus, broadcast_rows=limit).collect()}
    assert got == lm_plain(docs, ["abc abd", None])
    assert lm.score_documents(none).count() == 0
    empty = lm.score_documents(odd, none).filter("doc_id = 0").first()
    assert empty["mean_log_score"] == pytest.approx(2 * math.log(0.4))


def test_score_words(odd, odd_rows, ready, none):
    def pairs(t):
        w = split_words(t)
        return list(zip([None, *w], w))

    corpus_rows = odd_rows[::2]
    half = ready.createDataFrame([r[:2] for r in corpus_rows], "doc_id bigint, text string")
    for corpus, rows in ((None, odd_rows), (odd, odd_rows), (half, corpus_rows)):
        seen = [p for r in rows for p in pairs(r[1])]
        n2, m2, n1 = Counter(seen), Counter(a for a, _ in seen), Counter(b for _, b in seen)
        want = defaultdict(lambda: [0, 0.0])
        for r in odd_rows:
            want[r[0]]
            for a, b in pairs(r[1]):
                s = (math.log(n2[a, b] / m2[a]) if n2[a, b] >= 2 else
                     math.log(0.4) + (math.log(n1[b] / len(seen)) if n1[b] else -math.log(len(seen) + 1)))
                want[r[0]] = [want[r[0]][0] + 1, want[r[0]][1] + s]
        got = {r[0]: (r[1], r[2]) for r in lm.score_words(odd, corpus).collect()}
        assert {k: (n, round(l, 6)) for k, (n, l) in got.items()} == {k: (n, pytest.approx(l, abs=1e-5)) for k, (n, l) in want.items()}
    assert lm.score_words(none).count() == 0


# --- SimHash ----------------------------------------------------------------------------------------


def fingerprint_plain(text):
    w = split_words(text)
    if not w:
        return 0
    shingles = [" ".join(w[i: i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_plain(fps, bits):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


def component_ids(rows, bits=2):
    fps = [fingerprint_plain(t) for _, t in rows]
    roots = groups_plain(fps, bits)
    low = defaultdict(list)
    for (doc, _), r in zip(rows, roots):
        if doc is not None:
            low[r].append(doc)
    return fps, [min(low[r], default=None) for r in roots]


def test_near_duplicates(odd, odd_rows, none):
    rows = [(r[0], r[1]) for r in odd_rows]
    fps, ids = component_ids(rows)
    got = Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(odd).collect())
    assert got == Counter((d, f, c) for (d, _), f, c in zip(rows, fps, ids))
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(set(ids))
    assert simhash.keep_one(none).count() == 0
    nameless = odd.withColumn("doc_id", F.lit(None).cast("bigint"))
    assert simhash.keep_one(nameless).count() == len(set(groups_plain(fps, 2)))


@pytest.mark.parametrize("bits,block", [(0, 9), (1, 9), (2, 9), (2, 4096), (3, 9), (5, 4096)])
def test_links_cover_all_pairs(ready, bits, block):
    rng = random.Random(bits)
    centers = [rng.getrandbits(64) for _ in range(30)]
    fps = {c for c in centers} | {0, 2**64 - 1}
    for _ in range(400):
        c = centers[0] if rng.random() < 0.5 else rng.choice(centers)
        for _ in range(rng.randrange(7)):
            c ^= 1 << rng.randrange(64)
        fps.add(c)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = ready.createDataFrame([(f,) for f in signed], "fp bigint").repartition(4)
    store = scratch(ready, "t")
    edges = simhash.links(df, bits, store, block)
    pairs = [(r[0] % 2**64, r[1] % 2**64) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in pairs)
    roots = {r[0] % 2**64: r[1] for r in simhash.components(edges, store).collect()}
    want = defaultdict(set)
    for f, r in zip(fps, groups_plain(fps, bits)):
        want[r].add(f)
    got = defaultdict(set)
    for f in fps:
        got[roots.get(f, f if f < 2**63 else f - 2**64)].add(f)
    assert set(map(frozenset, got.values())) == set(map(frozenset, want.values()))


# --- token files ------------------------------------------------------------------------------------


def test_simple8b():
    rng = np.random.default_rng(0)
    for draw in (lambda n: rng.integers(0, 49408, n), lambda n: rng.integers(0, 2, n) * rng.integers(0, 2**40, n), np.zeros,
                 lambda n: rng.integers(2**59, 2**63, n) * 2 + 1, lambda n: rng.integers(0, 3, n)):
        for n in (0, 1, 239, 240, 4095, 4096, 4097, 20_000):
            values = draw(n).astype(np.uint64)
            words, offsets = simple8b.encode(values)
            assert (simple8b.decode(words, offsets, n) == values).all()
            if n > 4096:
                assert (simple8b.decode_block(words, offsets, n, 1) == values[4096:8192]).all()


def test_words_part_where_the_tokenizer_parts_them():
    """Every letter, before an ASCII mark: as whole calls. Letters that are normalised to a letter and a mark count."""
    encoder = tokens.WordEncoder(tokenizer_path())
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    marks = tokens.PUNCTUATION.decode()
    words = [f"x{c}{marks[i % len(marks)]}" for i, c in enumerate(letters)]
    words += [f"{c}{m}" for c in "İißΣςŉǰΐกé\u0958\u09dc\ufb2a" for m in [*marks, "}'", "...", "'s."]]
    for low in range(0, len(words), 10_000):
        part = words[low: low + 10_000]
        for word, want in zip(part, encoder.plain(part), strict=True):
            assert encoder.ids(word.encode()) == want.astype("<u4").tobytes(), word


def test_token_files(odd, odd_rows, ready, none, monkeypatch):
    tokenizer = tokens.load_tokenizer(tokenizer_path())
    special = ["a<|endoftext|>B", "<|ENDOFTEXT|> x", "don't. Stop,, 'S x's", "İstanbul. É́  nb\x1csp", "﻿\x00 ok?!"]
    rows = [(r[0], r[1]) for r in odd_rows] + [(1000 + i, t) for i, t in enumerate(special)] + [(-5, "negative id")]
    docs = ready.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    monkeypatch.setattr(tokens, "SEGMENT_IDS", 500)
    path = scratch(ready, "t").path("ids")
    tokens.write_ids(docs, path, tokenizer_path())
    got = sorted((tuple(r) for r in tokens.read_documents(ready, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    want, start = Counter(), 0
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want[doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r[0], r[2], r[3]) for r in got) == want
    for _, at, n, _ in got:
        assert at == start
        start += n
    empty = scratch(ready, "t").path("none")
    tokens.write_ids(none, empty, tokenizer_path())
    assert tokens.read_documents(ready, empty).count() == 0


# --- language ID ------------------------------------------------------------------------------------


def test_gradients():
    rng = np.random.default_rng(3)
    model = langid.new_model(["a", "b"], 3, rng)
    way = model.ways[0]
    steps = rng.integers(97, 100, (5, 4)).astype(np.uint8)
    weight = rng.standard_normal((5, 4, 3)).astype(np.float32)
    _, trail = langid.run_way(way, steps)
    for part, grad in zip(way.parts(), langid.back_way(way, steps, trail, weight), strict=True):
        for at in [tuple(rng.integers(0, n) for n in part.shape) for _ in range(10)] + [(k, 98, 0) if part.shape[1:] == (256, 3) else (k,) + (0,) * (part.ndim - 1) for k in range(3)]:
            old, found = part[at], []
            for step in (1e-2, -1e-2):
                part[at] = old + step
                found.append(float((langid.run_way(way, steps)[0].astype(np.float64) * weight).sum()))
            part[at] = old
            assert (found[0] - found[1]) / 2e-2 == pytest.approx(float(grad[at]), abs=2e-2)


def test_reader_matches_training_network():
    rng = np.random.default_rng(1)
    model = langid.new_model(["a", "b", "c"], 4, rng)
    model.ways[0].bias += 0.1
    texts = [b"one", bytes(range(32, 127)) * 3, b"x" * 64, b"y" * 65]
    got = langid.Reader(model).documents(texts)
    for text, row in zip(texts, got):
        windows, sizes, _ = langid.cut([text])
        ahead, _ = langid.run_way(model.ways[0], windows.T)
        behind, _ = langid.run_way(model.ways[1], windows.T[::-1])
        chance = np.exp(np.concatenate((ahead, behind[::-1]), axis=2) @ model.out + model.shift)
        chance /= chance.sum(axis=2, keepdims=True)
        mask = np.arange(langid.WINDOW)[:, None] < sizes
        assert (chance * mask[:, :, None]).sum(axis=(0, 1)) / len(text) == pytest.approx(row, abs=1e-4)


def test_language_held_out(ready):
    docs = ready.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.fit(docs.filter(~held))
    found = langid.identify(docs.filter(held).select("doc_id", "text", "lang"), model)
    right, total, low = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*"), F.min("score")).first()
    assert total > 200 and right / total > 0.97 and low > 0.2


def test_language_edges(odd, odd_rows, none, ready):
    model = langid.fit(odd, steps=3)
    assert model.labels == ["de", "en"]
    got = langid.identify(odd, model)
    assert got.columns == [c for c in odd.columns if c not in ("score", "lang_pred")] + ["lang_pred", "score"]
    rows = got.select("text", "lang_pred", "score").collect()
    assert len(rows) == len(odd_rows)
    for text, lang, score in rows:
        assert (lang == "und") == (not re.search(r"[^\W\d_]", text or "")) and 0 <= score <= 1
    assert langid.identify(none, model).count() == 0
    assert langid.fit(none) is None and langid.fit(odd.filter("lang is null")) is None
    assert {r[0] for r in langid.identify(odd, None).select("lang_pred").collect()} == {"und"}
