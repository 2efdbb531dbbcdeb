import datetime as dt
import html
import json
import random
from collections import Counter
from html.entities import html5

import pytest

from pyspark.sql import functions as F

from threadloom.functions import columns as C
from threadloom.functions import ranking
from threadloom.functions.ranking import first_n, numbered
from threadloom.operators import collect as K
from threadloom.operators import preprocess as P
from threadloom.operators import sample as U
from threadloom.session import Scratch
from threadloom.sources import tables as T


def values(df, *names):
    return [tuple(row) for row in df.select(*names).collect()]


def test_clean_text(rows):
    cases = {
        None: "", "": "", " http://a.b/c?d ": "", "see https://x.y WWW.z.w now": "see now", "&amp;lt;b&gt;": "&lt;b>",
        "a　b\x1cc": "a b c", "NA": "NA", "Tom &amp; Jerry&#39;s": "Tom & Jerry's", "AT&T": "AT&T", "x &copy y": "x © y",
    }
    df = rows([(k, v) for k, v in cases.items()], "raw string, want string")
    got = df.select("want", C.clean_text(F.col("raw")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


DUMP = """{"gameLabel":"g","videos":[
 {"gameLabel":"g","title":"one","videoId":"v1","channelId":"c1","viewCount":5,"comments":[
  {"gameLabel":"g","videoId":"other","commentId":"a","isTopLevel":true,"text":"hello","publishedAt":"2024-01-01T00:00:00Z"},
  {"gameLabel":"g","commentId":"b","isTopLevel":false,"text":null,"textOriginal":"orig","totalReplyCount":2}]},
 {"gameLabel":"g","title":"none","videoId":"v2","comments":[]}]}"""


def test_scan_flatten_conform(spark, tmp_path):
    (tmp_path / "a.json").write_text(DUMP)
    (tmp_path / "b.json").write_text('{"gameLabel": "empty"}')
    docs = T.raw_json_scan(spark, str(tmp_path / "*.json"))
    flat = P.conform_schema(P.flatten_comments(docs), keep=["ord"])
    assert len(flat.columns) == 25
    got = values(flat.orderBy("ord"), "commentId", "videoId", "videoTitle", "videoViewCount", "totalReplyCount", "ord")
    assert got == [("a", "other", "one", 5, None, 0), ("b", "v1", "one", 5, 2, 1)]
    assert values(P.text_fallback(flat).orderBy("ord"), "text") == [("hello",), ("orig",)]
    summary = P.preprocess_summary(P.clean_comments(flat), games=docs.select(F.col("gameLabel").alias("game")))
    assert sorted(values(summary, "game", "raw_comments_replies", "videos"), key=str) == [("empty", 0, None), ("g", 2, 2)]


def test_indented_dumps_are_read_in_splits(spark, tmp_path, monkeypatch):
    """The rows of the whole-document scan, from many tasks: brackets and quotes in texts, empty lists, other lists."""
    rng = random.Random(12)
    odd = ["plain", 'quote " and \\ back', "brackets ]}{[ here", '\\"}', "line\nbreak", "ü 😀", ""]

    def comment(n):
        return {"commentId": f"c{n}", "text": rng.choice(odd), "isTopLevel": n % 2 == 0, "likeCount": n}

    def video(n):
        return {"title": rng.choice(odd), "videoId": f"v{n}", "viewCount": n, "comments": [comment(i) for i in range(n % 40)]}

    for name, count in (("a", 60), ("b", 3), ("c", 0)):
        doc = {"gameLabel": name, "searchQueries": ["x", "y ]"], "videos": [video(i) for i in range(count)],
               "other": [{"videos": [{"a": 1}]}, {}], "last": {"k": [1, 2]}, "collectedAtUtc": f"t{name}"}
        text = json.dumps(doc, indent=rng.choice([1, 2, 4]), ensure_ascii=name == "a")
        (tmp_path / f"{name}.json").write_text(text.replace('"videos": [\n', '"videos": [\n{"videoId": "short", "comments": []},\n', 1)
                                               if name == "b" else text)
    (tmp_path / "d.json").write_text('{\n "gameLabel": "none"\n}\n')
    path = str(tmp_path / "*.json")
    whole = T.raw_json_scan(spark, path)
    want = whole.select("gameLabel", "searchQueries", "collectedAtUtc", F.explode_outer("videos").alias("video"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        cut = T.raw_indented_scan(spark, path, Scratch(spark, "indented"))
        assert cut.schema["videos"].dataType == whole.schema["videos"].dataType
        got = cut.select("gameLabel", "searchQueries", "collectedAtUtc", F.explode_outer("videos").alias("video"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert spark.read.text(path).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
        spark.conf.set("spark.sql.files.openCostInBytes", "524288")


def test_variants_keep_nulls_and_all_keys(spark, tmp_path):
    """A present null and undeclared keys of a comment win; counters as text are read; places differ over dumps."""
    (tmp_path / "a.json").write_text(DUMP)
    (tmp_path / "b.json").write_text("""{"gameLabel":"h","videos":[{"title":"t","channelTitle":"ch","viewCount":"12","likeCount":"no","comments":[
      {"commentId":"x","videoTitle":null,"channelTitle":"mine","likeCount":"7","isTopLevel":"False"},
      {"commentId":"y","likeCount":"many","videoViewCount":3.0,"isTopLevel":true,"extra":{"a":1}}, {"commentId":"z","likeCount":null}]},
      {"title":"u"}, {"comments":null}, {"comments":[]}]}""")
    (tmp_path / "c.json").write_text('{"gameLabel": "empty"}')
    docs = P.number_documents(T.raw_variant_scan(spark, str(tmp_path / "*.json")), Scratch(spark, "t"))
    flat = P.flatten_comments(docs)
    got = {r.commentId: r for r in flat.collect()}
    assert sorted(got) == ["a", "b", "x", "y", "z"] and len({r.ord for r in got.values()}) == 5
    assert got["a"].ord + 1 == got["b"].ord and got["x"].ord + 1 == got["y"].ord == got["z"].ord - 1
    assert (got["a"].videoId, got["b"].videoId, got["a"].videoTitle, got["a"].videoViewCount) == ("other", "v1", "one", 5)
    x, y, z = (got[k] for k in "xyz")
    assert (x.videoTitle, x.channelTitle, x.likeCount, x.isTopLevel, x.videoViewCount) == (None, "mine", 7, False, 12)
    assert (y.videoTitle, y.channelTitle, y.likeCount, y.isTopLevel, y.videoViewCount) == ("t", "ch", None, True, 3)
    assert (z.likeCount, z.videoLikeCount, z.gameLabel, z.videoTitle) == (None, None, None, "t")
    counts = {r.commentId: r.likeCount for r in K.count_defaults(flat, ["likeCount"]).collect()}
    assert counts == {"a": 0, "b": 0, "x": 7, "y": 0, "z": 0}
    typed = P.conform_schema(P.flatten_comments(T.raw_json_scan(spark, str(tmp_path / "a.json"))))
    assert sorted(map(str, typed.collect())) == sorted(map(str, P.conform_schema(flat.filter("commentId in ('a', 'b')")).collect()))


def test_missing_columns_stop(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t"))
    try:
        T.table_scan(spark, str(tmp_path / "t"), ["id", "name"])
    except ValueError as error:
        assert "name" in str(error)
    else:
        raise AssertionError("no error")


FLAT = "gameLabel string, commentId string, text string, textOriginal string, isTopLevel boolean, authorChannelId string, replyToAuthorChannelId string, videoId string, ord long"


def test_dedupe_and_summary(rows):
    df = rows([
        ("g", None, "x", None, True, "a", None, "v", 0), ("g", None, "x", None, False, "b", "a", "v", 1),
        ("g", "1", "x", None, False, "b", "a", "v", 2), ("g", "1", "x ", None, False, "c", "a", "v", 3),
        ("g", "1", "y", None, False, "a", "a", "w", 4), ("g", "2", "", "orig", True, "a", None, "v", 5),
        ("h", "9", "www.a.b", None, True, "a", None, "v", 6),
    ], FLAT)
    cleaned = P.clean_comments(df)
    kept = P.dedupe_comments(P.drop_empty_text(cleaned))
    assert sorted(values(kept, "ord")) == [(0,), (2,), (4,)]
    got = {r["game"]: r.asDict() for r in P.preprocess_summary(cleaned).collect()}
    assert got["g"] == dict(game="g", raw_comments_replies=6, removed_empty_text=1, removed_duplicates=2,
                            final_analysis_comments=3, top_level_comments=1, replies=2, unique_users=2,
                            final_reply_edges=1, videos=2)
    assert got["h"]["final_analysis_comments"] == 0 and got["h"]["removed_empty_text"] == 1


def test_reply_edges(rows):
    data = [("g", "False", "a", "b")] * 3 + [("g", "0", "b", "a"), ("g", "false", "a", "a"), ("g", "False", None, "a"),
            ("g", "False", "a", None), ("g", "True", "a", "b"), (None, "False", "x", "y"), ("g", None, "a", "b")]
    df = rows(data, "gameLabel string, isTopLevel string, authorChannelId string, replyToAuthorChannelId string")
    got = values(P.sorted_edges(P.reply_edges(df)), "gameLabel", "source", "target", "weight")
    assert got == [(None, "x", "y", 1), ("g", "a", "b", 3), ("g", "b", "a", 1)]


def stamp(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_window_ends_and_nulls(rows):
    df = rows([(1, stamp(1)), (2, stamp(2)), (3, stamp(3)), (4, stamp(4)), (5, None)], "id int, publishedAt timestamp")
    got = K.date_window(df, F.lit("2024-01-02").cast("timestamp"), F.lit("2024-01-03").cast("timestamp"))
    assert sorted(values(got, "id")) == [(2,), (3,), (5,)]
    assert K.date_window(df, None, None).count() == 5


def test_collect_threads(rows):
    top = rows([("v", "t1", "1", "A", "ida", stamp(9)), ("v", "t2", "2", "B", "idb", stamp(8)),
                ("v", "t3", "3", "C", "idc", stamp(7)), ("v", "t4", "4", "D", "idd", stamp(20))],
               "videoId string, threadId string, commentId string, authorDisplayName string, authorChannelId string, publishedAt timestamp")
    replies = rows([("v", f"t{t}", f"r{i}", "X", "idx", stamp(d), i) for i, (t, d) in
                    enumerate([(1, 9), (1, 1), (1, 10), (1, 10), (2, 9), (3, 9), (4, 9)])],
                   "videoId string, threadId string, commentId string, authorDisplayName string, authorChannelId string, publishedAt timestamp, ord long")
    got = K.collect_threads(top, replies, F.lit(stamp(5)), F.lit(stamp(15)), top_per_video=2, replies_per_thread=2)
    # t4 lies outside the window but its replies stay; the cap ends the listing after t2; r1 is outside and uses no place.
    assert sorted(r[0] for r in values(got, "commentId")) == ["1", "2", "r0", "r2", "r4", "r6"]
    target = {r.commentId: r.replyToAuthorChannelId for r in got.collect()}
    assert target["r6"] == "idd" and target["1"] is None
    assert K.min_comments_per_video(got, 7).count() == 0 and K.min_comments_per_video(got, 6).count() == 6


def test_counts_and_author(rows):
    df = rows([("5",), ("x",), (None,)], "likeCount string")
    assert values(K.count_defaults(df, ["likeCount"]), "likeCount") == [(5,), (0,), (0,)]
    df = rows([(("id",),), (None,)], "authorChannelId struct<value string>")
    assert values(K.author_id_extract(df), "authorChannelId") == [("id",), (None,)]
    assert values(K.author_id_extract(rows([("id",)], "authorChannelId string")), "authorChannelId") == [(None,)]


def cut_plain(rows, n):
    """First ``n`` of each group by (x descending, nulls last; y ascending, nulls first; the rest as counts)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    for own in groups.values():
        own.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[2] is not None, r[2] or 0))
    return {k: [r[1:] for r in own[:n]] for k, own in groups.items()}


@pytest.mark.parametrize("n", [3, 20, 41])
def test_first_n_over_the_limit(rows, monkeypatch, n):
    """As the window does it, without one: nulls, hot groups, groups below the cap, a null group, repeated rows."""
    monkeypatch.setattr(ranking, "PRELIMIT", 2)
    rng = random.Random(n)
    data = [(g, rng.choice([None, *range(4)]), rng.choice([None, *range(500)])) for g in ["hot"] * 300 + ["a"] * 40 + [None] * 25 + ["b"] * 2]
    data += [("same", 1, 1)] * 60 + [("near", 2, 2)] * 15 + [("near", 1, i) for i in range(30)]
    df = rows(data, "g string, x int, y int").repartition(5)
    cut = first_n(df, ["g"], ["-x", "y"], n)
    got = {}
    for g, *rest in cut.collect():
        got.setdefault(g, []).append(tuple(rest))
    want = cut_plain(data, n)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in want.items()}
    assert {k: Counter(v) for k, v in got.items()} == {k: Counter(v) for k, v in want.items()}


def test_large_cap_gathers_no_group(spark):
    df = spark.range(20000).select((F.col("id") % 20 > 0).cast("int").alias("k"), F.col("id"))
    cut = first_n(df, ["k"], ["-id"], 5000)
    assert "Window" not in cut._jdf.queryExecution().executedPlan().toString()
    got = cut.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    want = sorted(i for i in range(20000) if i % 20 > 0)[-5000]
    assert {r.k: (r.n, r.low) for r in got.collect()} == {0: (1000, 0), 1: (5000, want)}


def test_numbered(spark):
    df = spark.range(1000).repartition(5).select((F.col("id") % 3).alias("g"), "id")
    got = numbered(df, ["g"], [F.desc("id")], Scratch(spark, "t"), "place")
    assert got.filter(F.col("place") != F.floor((F.lit(999) - F.col("id")) / 3)).filter("g = 0").count() == 0
    assert got.groupBy("g").agg(F.count_distinct("place").alias("n"), F.max("place").alias("m")).filter("n != m + 1").count() == 0


def test_samples(rows):
    df = rows([(i, i % 2) for i in range(10)], "ord int, x int")
    assert values(U.head_per_group(df, 3), "ord") == [(i,) for i in range(6)]
    edges = rows([("g", "a", "b", 2), ("g", "c", "d", 2), ("g", "e", "f", 9), (None, "q", "r", 99)],
                 "gameLabel string, source string, target string, weight long")
    assert sorted(values(U.top_edges_per_group(edges, 2), "source")) == [("a",), ("e",)]


def test_truncated_dump_raises(spark, tmp_path):
    from threadloom.sources import tables

    (tmp_path / "good.json").write_text('{"gameLabel": "g", "videos": []}')
    (tmp_path / "bad.json").write_text('{"gameLabel": "g", "videos": [{"videoId": ')
    with pytest.raises(Exception):
        tables.raw_json_scan(spark, str(tmp_path)).collect()


def test_method_layout_runs_twice(spark, tmp_path):
    from threadloom.sources import tables

    path = str(tmp_path / "scores")
    for method in ("a", "b", "a"):
        tables.write_by_method(spark.range(3), path, method)
    assert tables.read_method(spark, path, "a").count() == 3 and tables.read_method(spark, path, "b").count() == 3


def test_first_of_equal_positions_is_the_same_everywhere(spark):
    from threadloom.operators import preprocess

    rows = [("g", "c", "text", 0, "v", "t", None, f"user{i}") for i in range(6)]
    schema = ("gameLabel string, commentId string, textClean string, ord bigint, videoId string, threadId string, "
              "publishedAt timestamp, authorChannelId string")
    for parts in (1, 4):
        kept = preprocess.dedupe_comments(spark.createDataFrame(rows, schema).repartition(parts)).collect()
        assert [r["authorChannelId"] for r in kept] == ["user0"]


def test_entities(spark, rows):
    """As the standard library reads them: all names, whole and cut, all odd numbers, and random pieces."""
    rng = random.Random(9)
    pieces = ["&", "&amp", "&amp;", "&#", "&#x", "&#39;", "&#039", "&#x27;", "&#X1F600;", "&#128512", "&#0;", "&#x80;", "&#129;", "&#xD800;",
              "&#1114112;", "&#99999999999999999999;", "&#x0000000000041;", "&#xfffe;", "&#x1ffff;", "&#11;", "&#13;", "&#127;", "&#xfdd0;",
              "&notit;", "&notin;", "&noti", "&lt", "&ltx", "&copy2", "&é", "&😀;", "&unknown;", "& ", "&;", "&&", "&#;", "&#x;", "&#xg", "amp;",
              ";", "x", " ", "\t", "ß", "😀", "&AMP", "&quot", "&acE;", "&NotEqualTilde;", "&CounterClockwiseContourIntegral;",
              "&" + "a" * 40 + ";", "&amp" + "b" * 40, "&#1e;"]
    texts = [f"&{name}" for name in html5] + [f"x&{name.rstrip(';')}y" for name in html5] + [f"&{name[:-1]}" for name in html5]
    texts += [f"&#{n};" for n in [*range(0, 300), 0xFDCF, 0xFDF0, 0xFFFD, 0x10000, 0x10FFFE, 0x10FFFF]] + [f"&#x{n:x}" for n in range(0x7E, 0xA2)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) for _ in range(10_000)]
    df = rows([(t,) for t in texts] + [(None,)], "t string").repartition(8)
    found = df.select("t", C.unescape(F.col("t")).alias("u"))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    wrong = [(r.t, r.u) for r in found.collect() if r.u != (None if r.t is None else html.unescape(r.t))]
    assert not wrong, wrong[:5]
