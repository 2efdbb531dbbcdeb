import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.functions import columns as C
from threadloom.functions import lexicon as X
from threadloom.operators import cache as S
from threadloom.operators import compare as M
from threadloom.operators import distribution as D
from threadloom.operators import sentiment as T
from threadloom.operators import terms as K
from threadloom.schemas import LEXICON_SCORES
from threadloom.sources import star_views as V

LISTS = X.Lexicon(words={"good": 1.9, "bad": -2.5, "win": 2.8}, boosters={"very": 0.293, "slightly": -0.293},
                  negations=("not", "never"))


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


CASES = {
    "": 0.0,
    "nothing here": 0.0,
    "good": 1.9,
    "good.": 1.9,
    "'good'": 0.0,  # two marks: not the bare word
    "very good": 1.9 + 0.293,
    "very much good": 1.9 + 0.293 * 0.95,
    "very much indeed good": 1.9 + 0.293 * 0.9,
    "slightly bad": -2.5 + 0.293,
    "not good": 1.9 * -0.74,
    "not at all good": 1.9 * -0.74,
    "isn't good": 1.9 * -0.74,
    "never so good": 1.9 * 1.5,
    "this is GOOD": 1.9 + 0.733,
    "ALL GOOD": 1.9,
    "VERY good": 1.9 + 0.293 + 0.733,
    "good but bad": 1.9 * 0.5 - 2.5 * 1.5,
    "least good": 1.9 * -0.74,
    "at least good": 1.9,
    "good!!!": 1.9 + 3 * 0.292,
    "good!!!!!!": 1.9 + 4 * 0.292,
    "bad??": -2.5 - 2 * 0.18,
    "bad ?????": -2.5 - 0.96,
    "bad good": -2.5 + 1.9,
}


def table(rows):
    return rows([(str(i), text) for i, text in enumerate(CASES)], "commentId string, textClean string")


def test_rules(rows):
    # "good!!!!!!" has six marks, which the word rule does not strip, so only the marks remain without a word.
    got = {r.textClean: r.vader_compound for r in T.lexicon_sentiment(table(rows), LISTS).collect()}
    want = {text: compound(total) for text, total in CASES.items()}
    want["good!!!!!!"] = 0.0
    assert got == want


def test_shares_sum_to_one(rows):
    for r in T.lexicon_sentiment(table(rows), LISTS).collect():
        total = r.vader_neg + r.vader_neu + r.vader_pos
        assert total == 0 if not r.textClean else abs(total - 1) < 0.002


def test_large_table_is_joined(rows, monkeypatch):
    entries = [(w, v, "word") for w, v in LISTS.words.items()] + [(w, v, "booster") for w, v in LISTS.boosters.items()]
    lexicon = rows(entries + [(w, 0.0, "negation") for w in LISTS.negations], "term string, valence double, kind string")
    small = T.lexicon_sentiment(table(rows), lexicon).select("commentId", *LEXICON_SCORES.names).orderBy("commentId")
    monkeypatch.setattr(X, "PLAN_LIMIT", 5)
    large = T.lexicon_sentiment(table(rows), lexicon).select("commentId", *LEXICON_SCORES.names).orderBy("commentId")
    assert small.collect() == large.collect()


PHRASES = X.Lexicon(
    words={"good": 1.9, "bad": -2.5, "kiss of death": -1.5, "kiss": 1.0, "death": -2.9, "of death row": 3.0, "not bad at all": 2.0,
           "a b": 1.0, "a b c": -1.0, "b c d": 2.0, "😀": 2.1, "❤️": 3.0, ":)": 1.4, "x x": 0.5},
    boosters={"very": 0.293, "kind of": -0.293, "of": 0.1}, negations=("not", "by no means"))
PHRASE_CASES = {
    "the kiss of death": -1.5, "Kiss Of Death!": -1.5 - 0.292, "not the kiss of death": -1.5 * -0.74, "very kiss of death": -1.5 - 0.293,
    "kiss of death row": -1.5, "kiss death": 1.0 - 2.9, "kind of good": 1.9 - 0.293, "kind of very good": 1.9 + 0.293 - 0.293 * 0.95,
    "by no means good": 1.9 * -0.74, "by no good": 1.9, "not bad at all good": 2.0 + 1.9, "aa a b cc": 0.0, "😀": 2.1, "good 😀": 1.9 + 2.1,
    "so 🙂 good": 1.9, "❤️ :)": 3.0 + 1.4, "xx x": 0.0, "bad kind of": -2.5, "KISS OF DEATH here": -1.5 - 0.733, "of death row": 3.0,
}


def both_ways(rows, monkeypatch, df, table):
    """Scores with the lists in the plan, then with the table joined."""
    out = []
    for limit in (X.PLAN_LIMIT, 3):
        monkeypatch.setattr(X, "PLAN_LIMIT", limit)
        found = T.lexicon_sentiment(df, table).select("commentId", *LEXICON_SCORES.names)
        out.append({r.commentId: r.asDict() for r in found.collect()})
    return out


def test_phrases_and_emoji(rows, monkeypatch):
    df = rows(list(PHRASE_CASES.items()), "commentId string, x double").withColumn("textClean", F.col("commentId"))
    lists = {r.commentId: r.vader_compound for r in T.lexicon_sentiment(df, PHRASES).collect()}
    assert lists == {text: compound(total) for text, total in PHRASE_CASES.items()}
    table = rows([row for kind in X.KINDS for row in PHRASES.rows(kind)], "term string, valence double, kind string")
    plan, joined = both_ways(rows, monkeypatch, df, table)
    assert plan == joined and {k: v["vader_compound"] for k, v in plan.items()} == lists


def phrases_plain(words, terms):
    """Left to right, the longest first: (place, term)."""
    at, out = 0, []
    while at < len(words):
        size = max((n for n in range(2, 5) if " ".join(words[at: at + n]) in terms and at + n <= len(words)), default=0)
        if size:
            out.append((at, " ".join(words[at: at + size])))
        at += size or 1
    return out


def test_overlapping_phrases(rows, monkeypatch):
    rng = random.Random(4)
    words = ["aa", "bb", "cc"]
    terms = {" ".join(rng.choice(words) for _ in range(rng.randrange(2, 5))): rng.choice([1.5, -0.5, 2.0]) for _ in range(14)}
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 25))) for _ in range(200)]
    df = rows([(str(i), t) for i, t in enumerate(texts)], "commentId string, textClean string")
    entries = [(t, v, "word") for t, v in terms.items()] + [("zz", 0.2, "booster"), ("yy", None, "negation")]
    plan, joined = both_ways(rows, monkeypatch, df, rows(entries, "term string, valence double, kind string"))
    assert plan == joined
    for i, text in enumerate(texts):
        assert plan[str(i)]["vader_compound"] == compound(sum(terms[t] for _, t in phrases_plain(text.split(), terms))), text


def test_repeated_and_odd_rows(rows, monkeypatch):
    entries = [("Good", 1.0, "word"), ("good", -3.0, "word"), ("good", 3.0, "word"), (" kiss  of\tdeath", -1.5, "word"), ("", 1.0, "word"),
               (None, 1.0, "word"), ("bad", None, "word"), ("good", 1.0, "noun"), ("very", 0.5, "booster"), ("VERY", 0.2, "booster")]
    df = rows([(t, t) for t in ("good", "very good", "kiss of death", "bad", "not good")], "commentId string, textClean string")
    plan, joined = both_ways(rows, monkeypatch, df, rows(entries, "term string, valence double, kind string"))
    assert plan == joined
    assert {k: v["vader_compound"] for k, v in plan.items()} == {
        "good": compound(3.0), "very good": compound(3.5), "kiss of death": compound(-1.5), "bad": 0.0, "not good": compound(3.0 * -0.74)}


def test_default_words(rows):
    df = rows([("a", "what a great song"), ("b", "this is terrible")], "commentId string, textClean string")
    assert {r.commentId: r.sentiment_label for r in T.lexicon_sentiment(df).collect()} == {"a": "Positive", "b": "Negative"}


def test_compound_bounds(rows):
    df = rows([(0.05,), (-0.05,), (0.0,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(C.label_from_compound(F.col("x"))).collect()]
    assert got == ["Positive", "Negative", "Neutral", "Neutral", "Neutral"]


def test_classifier_lengths(rows):
    """The maximum length reaches the model, batches hold texts alike in length, and results stay with their keys."""
    def make_model(max_length):
        """Reads so many words, and tells how much longer the longest text of the batch is."""
        def predict(texts):
            sizes = [min(max_length, len(t.split())) for t in texts]
            return {"label": np.array([f"{s} words" for s in sizes]), "score": np.array([float(max(sizes) - s) for s in sizes])}

        return predict

    rng = random.Random(6)
    texts = [" ".join(["w"] * rng.randrange(1, 60)) for _ in range(400)] + [None, ""]
    df = rows([(str(i), t) for i, t in enumerate(texts)], "commentId string, textClean string").repartition(2)
    found = T.batch_classifier(df, make_model, batch_size=8, max_length=50).collect()
    assert {r.commentId: r.roberta_raw_label for r in found} == {
        str(i): f"{min(50, len((t or '').split()))} words" for i, t in enumerate(texts)}
    assert sum(r.sentiment_score for r in found) / len(found) < 2  # 16 or so in batches of texts as they come


def test_partial_cache_keeps_rows_apart(spark, rows, tmp_path):
    """Scores belong to their key, however many rows the cache already knows."""
    df = table(rows)
    path = str(tmp_path / "cache")
    want = {r.commentId: r.vader_compound for r in T.lexicon_sentiment(df, LISTS).collect()}
    seen = []

    def scorer(part):
        seen.append(part.count())
        return T.lexicon_sentiment(part, LISTS)

    S.score_with_cache(df.filter(F.col("commentId").cast("int") % 3 == 0), scorer, path, LEXICON_SCORES)
    got = S.score_with_cache(df, scorer, path, LEXICON_SCORES, batches=3)
    assert {r.commentId: r.vader_compound for r in got.collect()} == want
    assert seen[0] == 8 and sum(seen) == len(CASES)
    S.score_with_cache(df, scorer, path, LEXICON_SCORES)
    assert sum(seen) == len(CASES)
    store = S.ScoreCache(spark, path, LEXICON_SCORES)
    store.compact()
    assert store.manifest().segments == [] and store.read().count() == len(CASES)


def results(rows, ids, label, score, at):
    """Results as a scorer gives them; the text of a comment is its id twice."""
    df = rows([(str(i), f"{i} {i}") for i in ids], "commentId string, textClean string")
    values = {f.name: F.lit(score).cast(f.dataType) if f.dataType.simpleString() == "double" else F.lit(label) for f in LEXICON_SCORES}
    return df.withColumns({**values, "scored_at": F.lit(at).cast("timestamp")})


def scores_of(df):
    found = [(r.commentId, r.textClean, r.sentiment_label, r.sentiment_score) for r in df.collect()]
    assert len(found) == len({f[:2] for f in found})
    return {f[0]: f[2:] for f in found}


def test_cache_generations(spark, rows, tmp_path, monkeypatch):
    """Many appends: the latest result wins, files stay few, and a break leaves the last generation as it was."""
    store = S.ScoreCache(spark, str(tmp_path / "c"), LEXICON_SCORES, compact_after=3)
    want = {}
    for n in range(8):
        ids, at = range(n % 3, 12, 2), f"2024-01-{10 + (n * 5) % 8} 00:00:00"
        store.append(results(rows, ids, f"L{n}", n / 10, at), F.col("scored_at"))
        for i in map(str, ids):
            want[i] = max(want.get(i, ("", None, None)), (at, f"L{n}", n / 10))
        assert len(store.manifest().segments) < 3
        assert scores_of(store.read()) == {i: v[1:] for i, v in want.items()}
    live = store.manifest().folders()
    folders = [f for f in store.folder.children() if f.startswith(("segment-", "base-"))]
    assert len(folders) <= 3 + len(live) + 1 and len(store.folder.children("manifests")) <= 6
    # An open reader goes on over the next compaction, which keeps the generation before.
    store.append(results(rows, [50], "new", 0.5, "2024-03-01"), F.col("scored_at"))
    reader, before = store.read(), scores_of(store.read())
    store.compact()
    assert scores_of(reader) == before == scores_of(store.read())

    # The writer dies after the data is written and before the manifest: nothing of it is seen, and it can run again.
    def dies(*_):
        raise OSError("lost")

    store.append(results(rows, [51], "new", 0.5, "2024-03-01"), F.col("scored_at"))
    before = scores_of(store.read())
    with monkeypatch.context() as broken:
        broken.setattr(S.Folder, "create", dies)
        for step in (store.compact, lambda: store.append(results(rows, [52], "x", 0.1, "2024-03-02"), F.col("scored_at"))):
            with pytest.raises(OSError):
                step()
    assert scores_of(S.open_cache(spark, store.path, LEXICON_SCORES)) == before
    store.append(results(rows, [52], "x", 0.1, "2024-03-02"), F.col("scored_at"))
    store.compact()
    assert scores_of(store.read()) == {**before, "52": ("x", 0.1)}
    store.clean(grace=-60)
    assert {f for f in store.folder.children() if f.startswith(("segment-", "base-"))} == set().union(
        *[store.manifest(k).folders() for k in (store.manifest().number, store.manifest().number - 1)])


def test_two_writers_meet(spark, rows, tmp_path):
    """A manifest that exists is never overwritten: the second writer applies its change to the first one's."""
    one, two = (S.ScoreCache(spark, str(tmp_path / "c"), LEXICON_SCORES) for _ in range(2))
    old = one.manifest()
    two.append(results(rows, [1], "a", 0.1, "2024-01-01"), F.col("scored_at"))
    assert not one.folder.create(f"manifests/{old.number + 1:09d}.json", "{}")
    one.append(results(rows, [2], "b", 0.2, "2024-01-01"), F.col("scored_at"))
    assert scores_of(two.read()) == {"1": ("a", 0.1), "2": ("b", 0.2)} and two.manifest().number == 2


def test_plain_files_are_a_first_segment(spark, rows, tmp_path):
    path = str(tmp_path / "c")
    results(rows, range(5), "old", 0.3, "2023-01-01").write.parquet(path)
    store = S.ScoreCache(spark, path, LEXICON_SCORES)
    assert scores_of(store.read()) == {str(i): ("old", 0.3) for i in range(5)}
    store.append(results(rows, [1, 9], "new", 0.4, "2024-01-01"), F.col("scored_at"))
    store.compact()
    assert scores_of(store.read()) == {**{str(i): ("old", 0.3) for i in (0, 2, 3, 4)}, "1": ("new", 0.4), "9": ("new", 0.4)}


def test_texts_are_no_exchange_keys(spark, rows, tmp_path):
    store = S.ScoreCache(spark, str(tmp_path / "c"), LEXICON_SCORES)
    for n in (1, 2):
        store.append(results(rows, range(9), "x", 0.1, f"2024-01-0{n}"), F.col("scored_at"))
        store.compact() if n == 1 else None
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = rows([("1", "1 1"), ("77", "z")], "commentId string, textClean string")
        for found in (S.score_cache_lookup(df, store.read()), S.select_uncached(df, store.read())):
            plan = found._jdf.queryExecution().executedPlan().toString()
            keys = [line for line in plan.splitlines() if "hashpartitioning(" in line]
            assert keys and not any("textClean#" in k and "md5" not in k for k in keys), keys
            assert "Bucketed: true" in plan and not any("score_base" in k for k in keys)
        assert [r.cache_hit for r in S.score_cache_lookup(df, store.read()).orderBy("commentId").collect()] == [True, False]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cache_without_columns_is_empty(rows):
    assert S.score_cache_read(rows([("1", "x")], "commentId string, textClean string"), LEXICON_SCORES).count() == 0


def test_null_keys_hit(rows):
    cache = rows([("", "x", "Positive")], "commentId string, textClean string, sentiment_label string")
    df = rows([(None, "x"), (None, "y")], "commentId string, textClean string")
    assert [tuple(r) for r in S.cache_report(S.score_cache_lookup(df, cache)).collect()] == [(1, 2)]
    assert [r.textClean for r in S.select_uncached(df, cache).collect()] == ["y"]


def test_distribution(rows):
    df = rows([("g", "Positive"), ("g", "Positive"), ("g", "Neutral"), (None, "Neutral"), ("g", None)],
              "gameLabel string, sentiment_label string")
    got = D.sentiment_distribution(df, ["gameLabel"]).collect()
    assert [r.asDict() for r in got] == [dict(gameLabel="g", Positive=2, Neutral=1, Negative=0, total=3,
                                              positive_pct=66.67, neutral_pct=33.33, negative_pct=0.0)]


def test_terms(rows):
    texts = ["Alpha beta gamma", "alpha beta delta", "beta alpha", "the epsilon of zeta"]
    df = rows([(1, str(i), t) for i, t in enumerate(texts)] + [(2, "a", "alpha"), (2, "b", "alpha")]
              + [(3, str(i), "same same") for i in range(3)] + [(4, str(i), "the of") for i in range(3)],
              "g int, commentId string, textClean string")
    got = {r.g: r.top_terms for r in K.top_terms(df, ["g"]).collect()}
    # Group 2 is too small, group 3 has only terms above the upper limit, group 4 only stop words.
    assert got == {1: "alpha, beta, alpha beta", 2: "", 3: "", 4: ""}


def test_terms_in_blocks(spark, rows, monkeypatch):
    """Groups of several blocks; no table has a row per text and term, and the scores are those of a plain count."""
    draw, words = random.Random(7), [a + b for a in "abcdefgh" for b in "xyz"]
    texts = [("big", str(i), " ".join(draw.choices(words, k=30))) for i in range(150)]
    texts += [("small", str(i), " ".join(draw.choices(words[:9], k=8))) for i in range(6)] + [("two", "1", "ax"), ("two", "2", "ax")]
    texts += [("big", "0", "ax bx ax"), ("big", None, "cx dy"), ("big", None, "dy cx"), ("big", "z", "?"), ("big", "y", " "),
              (None, "1", "ax bx"), (None, "2", "ax bx"), (None, "3", "ax cx"), ("blank", "1", "  "), ("blank", "2", None)]
    pairs, n, df, x, lengths, expected = [], Counter(), Counter(), {}, Counter(), Counter()
    for g, doc, text in texts:
        if g is not None and (text or "").strip():
            n[g] += 1
            kept = [w for w in text.split() if w != "?"]
            pairs.append((g, doc, Counter(kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])])))
            df.update((g, t) for t in pairs[-1][2])
    for i, (g, doc, found) in enumerate(pairs):
        known = {t: c for t, c in found.items() if n[g] >= 3 and 2 <= df[g, t] <= 0.85 * n[g]}
        x[i] = {t: c * (math.log((1 + n[g]) / (1 + df[g, t])) + 1) for t, c in known.items()}
        lengths[g, doc] += sum(v * v for v in x[i].values())
    for i, (g, doc, _) in enumerate(pairs):
        for t, v in x[i].items():
            expected[g, t] += v / math.sqrt(lengths[g, doc])

    written = []
    for name in ("table", "dealt"):
        def kept_in_mind(self, *args, before=getattr(K.Scratch, name)):
            written.append(before(self, *args))
            return written[-1]
        monkeypatch.setattr(K.Scratch, name, kept_in_mind)
    monkeypatch.setattr(K, "BLOCK", 400, raising=False)
    df = rows(texts, "g string, commentId string, textClean string")
    got = {(r.g, r.term): r.score for r in K.term_scores(df, ["g"], "commentId", "textClean", []).collect()}
    assert got.keys() == expected.keys() and all(abs(got[k] - v) < 1e-9 for k, v in expected.items())
    assert max(table.count() for table in written) < sum(len(found) for _, _, found in pairs) / 2
    top = {r.g: r.top_terms for r in K.top_terms(df, ["g"], stop_words=[]).collect()}
    best = sorted((k for k in expected if k[0] == "big"), key=lambda k: (-round(expected[k], 10), k[1]))[:8]
    assert top.keys() == {"big", "small", "two", "blank", None} and top["big"] == ", ".join(t for _, t in best)
    assert top["two"] == top["blank"] == top[None] == ""
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_terms_keep_glued_words_out(rows):
    got = rows([("日本go ok it's x1_y a",)], "t string").select(K.tokens(F.col("t"), [])).first()[0]
    assert got == ["ok", "it's", "x1_y"]


@pytest.fixture()
def merged(rows):
    left = rows([("1", "g", "2023-12-31T23:59:00Z", "Positive", 0.9), ("2", "g", "bad", "Neutral", 0.0),
                 ("3", "h", "2024-04-01T00:00:00Z", None, -0.7), ("4", "h", "2024-04-02T00:00:00Z", "Negative", -0.8),
                 ("5", "g", "2024-01-01T00:00:00Z", "Positive", 0.1), ("only", "g", None, "Positive", 0.5)],
                "commentId string, gameLabel string, publishedAt string, sentiment_label string, vader_compound double")
    left = left.withColumns({c: F.lit(c) for c in ("videoId", "videoTitle", "authorChannelId", "textClean")})
    left = left.withColumns({"vader_label": F.col("sentiment_label"), "sentiment_score": F.col("vader_compound")})
    right = rows([("1", "Positive", 0.5), ("2", "Positive", 0.6), ("3", "Negative", 0.7), ("4", "odd", 0.8), ("5", "Positive", 1.0)],
                 "commentId string, sentiment_label string, sentiment_score double")
    right = right.withColumns({"roberta_label": F.col("sentiment_label"), "roberta_confidence": F.col("sentiment_score")})
    return M.compare(left, right)


def test_comparison(merged):
    got = {r.commentId: (r.models_agree, r.month, r.quarter) for r in merged.collect()}
    assert got == {"1": (True, "2023-12", "2023Q4"), "2": (False, None, None), "3": (False, "2024-04", "2024Q2"),
                   "4": (False, "2024-04", "2024Q2"), "5": (True, "2024-01", "2024Q1")}
    rate = {r.gameLabel: (r.total_comments, r.agreements, r.agreement_rate_pct) for r in M.agreement_rate(merged).collect()}
    assert rate == {"Overall": (5, 2, 40.0), "g": (3, 2, 66.67), "h": (2, 0, 0.0)}
    cross = {r.VADER: (r.Positive, r.Neutral, r.Negative) for r in M.label_crosstab(merged).collect()}
    assert cross == {"Positive": (2, 0, 0), "Neutral": (1, 0, 0), "Negative": (0, 0, 0)}
    month = M.monthly_counts(merged)
    assert month.filter("month is null").count() == 0 and month.agg(F.sum("count")).first()[0] == 7
    overall = {(r.model, r.sentiment): r["count"] for r in M.overall_distribution(merged).collect()}
    assert overall[("RoBERTa", None)] == 1 and overall[("VADER", "Positive")] == 2
    dense = M.distribution_dense(M.overall_distribution(merged), ["model"])
    assert dense.count() == 6 and dense.filter("percentage is null").count() == 0
    top = [r.vader_compound for r in M.top_disagreements(merged, 2).collect()]
    assert top == [-0.8, -0.7]
    assert M.disagreement_types(M.top_disagreements(merged)).count() == 2


def test_label_order(rows):
    df = rows([("Negative",), ("odd",), ("Positive",), ("Neutral",)], "sentiment string").withColumn("model", F.lit("m"))
    assert [r.sentiment for r in M.ordered(df, ["model"]).collect()] == ["Positive", "Neutral", "Negative", "odd"]


def test_texts_stay_in_the_set_number_of_partitions(spark, tmp_path):
    """Merged by size, the texts of a table lie in one or two partitions a core."""
    spark.range(64).selectExpr("id AS doc_id", "'some text' AS text", "'en' AS lang", "'src1' AS source").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.range(9).selectExpr("id AS event_id", "timestamp'2024-01-02' AS ts", "id AS user_id", "1L AS value").write.parquet(
        f"{tmp_path}/events.parquet")
    rows = V.comments(spark, str(tmp_path)).select("textOriginal", "text", F.spark_partition_id().alias("p"))
    assert len({r["p"] for r in rows.collect()}) == 4


def test_only_words_with_a_value_are_scored(spark):
    """Effects are looked up where a valued word asks for them, not laid out for all words."""
    text = spark.createDataFrame([("1", "one two good")], "commentId string, textClean string")
    plan = T.lexicon_sentiment(text)._jdf.queryExecution().analyzed().toString()
    assert "_places" in plan and "_values" not in plan and "_single" not in plan


def test_words_by_split_and_by_pattern(spark):
    """A text with a tab goes through the patterns, one with plain spaces only is split first."""
    texts = ["(good) bad! !bad !bad! ok?!? a. ab. .ab 'tis -x- é! éé! !!!", " so  !! good", "a", "", "x!y! .. ab.. été;"]
    rows = spark.createDataFrame([(t, t.replace(" ", "\t")) for t in texts], "a string, b string")
    for row in rows.select(T.words_of(F.col("a")).alias("x"), T.words_of(F.col("b")).alias("y")).collect():
        assert row["x"] == row["y"]


def test_terms_are_read_in_place(rows):
    """Counting texts and joining the vocabulary read one table dealt by term: no exchange of all terms for either."""
    texts = rows([("g", str(i), f"alpha beta word{i % 4}") for i in range(8)] + [(None, "9", "alpha")], "g string, id string, text string")
    scores = K.term_scores(texts, ["g"], "id", "text")
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 2
    # Both words are in all texts; of the pairs those with beta are in two texts each, as are the last words.
    assert {r["term"] for r in scores.collect()} == {f"word{i}" for i in range(4)} | {f"beta word{i}" for i in range(4)}


def test_terms_of_texts_use_the_set_partitions(rows):
    texts = rows([("g", str(i), f"alpha beta{i}") for i in range(200)], "g string, id string, text string").coalesce(1)
    found = K.doc_terms(texts, ["g"], "id", "text").select(F.spark_partition_id().alias("p")).distinct()
    assert found.count() > 8
