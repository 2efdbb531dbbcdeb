"""Scans, collection rules, preprocessing and samples over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from threadloom.functions import columns as C
from threadloom.operators import collect as K
from threadloom.operators import preprocess as P
from threadloom.operators import sample as U
from threadloom.plans import views_sql as Q
from threadloom.plans.registry import query
from threadloom.schemas import struct, L, S
from threadloom.session import Scratch
from threadloom.sources import star_views as V
from threadloom.sources import tables as T

ZULU = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({0}) % 1000000 <> 0 THEN strftime({0}, '.%f') ELSE '' END || 'Z'"
DUMP_SQL = """
turns AS (
  SELECT *, 'g' || (conv_id % 4) AS game, conv_id || '-' || turn AS id,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ord,
         count(*) OVER (PARTITION BY conv_id) AS n FROM conversations
)"""

# --- scans and sinks ----------------------------------------------------------------------------


@query("raw_json_scan", f"""{Q.with_(DUMP_SQL)}
SELECT game AS "gameLabel", count(DISTINCT conv_id) AS docs, count(*) AS comments FROM turns GROUP BY ALL""")
def raw_json_scan(spark, sf):
    path = Scratch(spark, "dump").path("json")
    V.raw_dump(spark, sf).write.json(path)
    docs = T.raw_json_scan(spark, path, one_per_line=True)
    sizes = F.transform("videos", lambda v: F.size(v["comments"]))
    comments = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda total, n: total + n)
    return docs.groupBy("gameLabel").agg(F.count("*").alias("docs"), F.sum(comments).alias("comments"))


@query("raw_indented_scan", f"""{Q.with_(DUMP_SQL)}
SELECT 'v' || conv_id AS "videoId", 'g' AS "gameLabel", n AS comments, conv_id * 10 AS "viewCount" FROM turns WHERE ord = 0""")
def raw_indented_scan(spark, sf):
    store = Scratch(spark, "dump")
    path = store.path("json")
    text = F.regexp_replace("value", r'"likeCount":"[a-z0-9]*"', '"likeCount":0').alias("value")
    V.text_dump(spark, sf, videos=25, line="\n").select(text).write.option("maxRecordsPerFile", 1).text(path)
    docs = T.raw_indented_scan(spark, path, store).select("gameLabel", F.explode("videos").alias("video"))
    return docs.select("video.videoId", "gameLabel", F.size("video.comments").cast("bigint").alias("comments"), "video.viewCount")


@query("table_scan", "SELECT doc_id, lang, source, n_chars FROM documents")
def table_scan(spark, sf):
    wanted = ["doc_id", "lang", "source", "n_chars"]
    return T.table_scan(spark, f"{sf}/documents.parquet", required=wanted).select(*wanted)


@query("table_sink", "SELECT doc_id, lang, text, md5(text) AS digest FROM documents")
def table_sink(spark, sf):
    path = Scratch(spark, "sink").path("csv")
    T.table_sink(V.read(spark, sf, "documents").select("doc_id", "lang", "text"), path, fmt="csv")
    back = T.table_scan(spark, path, ["doc_id", "text"], struct(doc_id=L, lang=S, text=S), fmt="csv")
    return back.withColumn("digest", F.md5(F.col("text").cast("binary")))


@query("method_layout", f"""{Q.with_(Q.SECOND)}
SELECT 'second' AS method, sentiment_label, count(*) AS n FROM second GROUP BY ALL""")
def method_layout(spark, sf):
    path = Scratch(spark, "methods").path("scores")
    second = V.second_labels(spark, sf).select("commentId", "sentiment_label")
    T.write_by_method(second, path, "second")
    T.write_by_method(second.withColumn("sentiment_label", F.lit("Neutral")), path, "other")
    return T.read_method(spark, path, "second").groupBy("method", "sentiment_label").agg(F.count("*").alias("n"))


@query("graph_export", f"""{Q.with_(Q.EVENTS, Q.edges("revents"), Q.GRAPH)}
SELECT game, node AS id, NULL AS target, NULL::BIGINT AS weight FROM verts
UNION ALL SELECT "gameLabel", source, target, weight FROM edges""")
def graph_export(spark, sf):
    path = Scratch(spark, "export").path("graph")
    T.write_graph(P.reply_edges(V.reply_events(spark, sf)), path)
    nodes = spark.read.parquet(f"{path}/nodes").withColumn("game", F.col("game").cast("string"))
    links = spark.read.parquet(f"{path}/edges").select(
        F.col("game").cast("string").alias("game"), "source", "target", "weight"
    )
    none = F.lit(None)
    nodes = nodes.select("game", "id", none.cast("string").alias("target"), none.cast("bigint").alias("weight"))
    return nodes.union(links)


# --- collection ---------------------------------------------------------------------------------


@query("parse_utc", f"""SELECT event_id, CASE WHEN event_id % 10 > 0 THEN {ZULU.format("ts")} END AS zulu FROM events""")
def parse_utc(spark, sf):
    ts = F.col("ts").cast("timestamp")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    text = (
        F.when(F.col("event_id") % 10 == 0, F.when(F.col("event_id") % 20 == 0, "soon"))
        .when(F.col("event_id") % 2 == 0, F.concat(F.date_format(ts, iso), F.lit("Z")))
        .otherwise(F.concat(F.date_format(ts + F.expr("interval 2 hours"), iso), F.lit("+02:00")))
    )
    rows = V.read(spark, sf, "events").select("event_id", text.alias("text"))
    return rows.select("event_id", C.to_zulu(C.parse_utc(F.col("text"))).alias("zulu"))


WINDOW = ("2024-03-01 00:00:00", "2024-09-15 12:00:00")


@query("date_window", f"""{Q.with_(Q.COMMENTS)}
SELECT "commentId", "gameLabel" FROM comments
WHERE ord % 13 = 0 OR "publishedAt" BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'""")
def date_window(spark, sf):
    rows = V.comments(spark, sf, text=False).withColumn("publishedAt", F.when(F.col("ord") % 13 != 0, F.col("publishedAt")))
    ends = [F.lit(text).cast("timestamp") for text in WINDOW]
    return K.date_window(rows, *ends).select("commentId", "gameLabel")


@query("author_id_extract", """SELECT event_id, CASE WHEN user_id % 7 > 0 THEN 'u' || user_id END AS "authorChannelId"
FROM events""")
def author_id_extract(spark, sf):
    author = F.when(F.col("user_id") % 7 > 0, F.struct(V.user_id(F.col("user_id")).alias("value")))
    rows = V.read(spark, sf, "events").select("event_id", author.alias("authorChannelId"))
    return K.author_id_extract(rows)


@query("count_defaults", """SELECT event_id,
  CASE WHEN event_id % 5 = 0 OR event_type = 'error' THEN 0
       ELSE CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS "likeCount" FROM events""")
def count_defaults(spark, sf):
    count = F.when(F.col("event_id") % 5 == 0, "n/a").when(
        F.col("event_type") != "error", F.regexp_extract("props", "[0-9]+", 0)
    )
    rows = V.read(spark, sf, "events").select("event_id", count.alias("likeCount"))
    return K.count_defaults(rows, ["likeCount"])


HITS_SQL = """
hits AS (
  SELECT event_type AS "gameLabel", 'v' || (user_id % 40) AS "videoId", event_id % 5 AS "queryRank",
         event_id AS "resultRank" FROM events
),
found AS (
  SELECT * FROM hits
  QUALIFY row_number() OVER (PARTITION BY "gameLabel", "videoId" ORDER BY "queryRank", "resultRank") = 1
)"""


def hits(spark, sf):
    return V.read(spark, sf, "events").select(
        F.col("event_type").alias("gameLabel"),
        F.concat(F.lit("v"), (F.col("user_id") % 40).cast("string")).alias("videoId"),
        (F.col("event_id") % 5).alias("queryRank"), F.col("event_id").alias("resultRank"),
    )


@query("first_query_wins", f"{Q.with_(HITS_SQL)} SELECT * FROM found")
def first_query_wins(spark, sf):
    return K.first_query_wins(hits(spark, sf))


@query("cap_videos_per_game", f"""{Q.with_(HITS_SQL)} SELECT * FROM found
QUALIFY row_number() OVER (PARTITION BY "gameLabel" ORDER BY "queryRank", "resultRank", "videoId") <= 25""")
def cap_videos_per_game(spark, sf):
    return K.cap_videos_per_game(K.first_query_wins(hits(spark, sf)))


@query("cap_top_level_per_video", f"""{Q.with_(Q.EVENTS)}
SELECT "gameLabel" AS "videoId", "commentId" FROM revents
QUALIFY row_number() OVER (PARTITION BY "gameLabel" ORDER BY "publishedAt" DESC, "commentId") <= 1500""")
def cap_top_level_per_video(spark, sf):
    rows = V.reply_events(spark, sf).withColumn("videoId", F.col("gameLabel"))
    return K.cap_top_level_per_video(rows, 1500).select("videoId", "commentId")


@query("cap_replies_per_thread", f"""{Q.with_(Q.EVENTS)}
SELECT "threadId", "commentId" FROM revents
WHERE NOT "isTopLevel" AND "publishedAt" BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'
QUALIFY row_number() OVER (PARTITION BY "threadId" ORDER BY ord) <= 2""")
def cap_replies_per_thread(spark, sf):
    replies = V.reply_events(spark, sf).filter(~F.col("isTopLevel"))
    ends = [F.lit(text).cast("timestamp") for text in ("2024-01-05", "2024-01-25")]
    return K.cap_replies_per_thread(replies, 2, *ends).select("threadId", "commentId")


@query("min_comments_per_video", f"""{Q.with_(Q.EVENTS)}
SELECT "threadId" AS "videoId", "commentId" FROM revents QUALIFY count(*) OVER (PARTITION BY "threadId") >= 4""")
def min_comments_per_video(spark, sf):
    rows = V.reply_events(spark, sf).withColumnRenamed("threadId", "videoId")
    return K.min_comments_per_video(rows, 4).select("videoId", "commentId")


def split_threads(spark, sf):
    rows = V.reply_events(spark, sf).withColumn("authorDisplayName", F.upper("authorChannelId"))
    top = rows.filter("isTopLevel").withColumn("totalReplyCount", F.lit(1).cast("bigint"))
    return top.drop("replyToAuthorChannelId"), rows.filter("not isTopLevel").drop("replyToAuthorChannelId")


@query("resolve_reply_target", f"""{Q.with_(Q.EVENTS)}
SELECT "commentId", "parentCommentId", "replyToAuthorChannelId", upper("replyToAuthorChannelId") AS "replyToAuthorDisplayName"
FROM revents WHERE NOT "isTopLevel" """)
def resolve_reply_target(spark, sf):
    top, replies = split_threads(spark, sf)
    return K.resolve_reply_target(replies, top).select(
        "commentId", "parentCommentId", "replyToAuthorChannelId", "replyToAuthorDisplayName"
    )


@query("thread_union", f"""{Q.with_(Q.EVENTS)}
SELECT "commentId", "parentCommentId", "isTopLevel", "replyToAuthorChannelId",
       CASE WHEN "isTopLevel" THEN 1::BIGINT END AS "totalReplyCount" FROM revents""")
def thread_union(spark, sf):
    top, replies = split_threads(spark, sf)
    rows = K.thread_union(top, K.resolve_reply_target(replies, top))
    return rows.select("commentId", "parentCommentId", "isTopLevel", "replyToAuthorChannelId", "totalReplyCount")


# --- preprocessing ------------------------------------------------------------------------------


@query("flatten_comments", f"""{Q.with_(DUMP_SQL)}
SELECT id AS "commentId", game AS "gameLabel", 'q' || (conv_id % 7) AS "queryUsed", 'v' || conv_id AS "videoId",
       'Conversation ' || conv_id AS "videoTitle", 'c' || (conv_id % 9) AS "channelId",
       conv_id * 10 AS "videoViewCount", n AS "videoCommentCount", turn = 0 AS "isTopLevel", turn AS "likeCount", ord
FROM turns""")
def flatten_comments(spark, sf):
    return P.flatten_comments(V.raw_dump(spark, sf)).select(
        "commentId", "gameLabel", "queryUsed", "videoId", "videoTitle", "channelId", "videoViewCount",
        "videoCommentCount", "isTopLevel", "likeCount", "ord",
    )


@query("flatten_variants", f"""{Q.with_(DUMP_SQL)}
SELECT id AS "commentId", game AS "gameLabel", 'v' || conv_id AS "videoId", NULL::VARCHAR AS "channelTitle",
       CASE WHEN turn % 4 = 0 THEN 'own ' || conv_id WHEN turn % 4 <> 1 THEN 'Conversation ' || conv_id END AS "videoTitle",
       CASE WHEN turn % 4 = 2 THEN 77 WHEN turn % 4 <> 1 THEN conv_id * 10 END AS "videoViewCount",
       CASE WHEN turn % 4 IN (0, 2) THEN turn ELSE 0 END AS "likeCount", turn = 0 AS "isTopLevel", text,
       1::BIGINT AS "sameOrd", row_number() OVER (PARTITION BY conv_id // 3 ORDER BY conv_id, turn)::INT AS place FROM turns""")
def flatten_variants(spark, sf):
    store = Scratch(spark, "dump")
    path = store.path("json")
    V.text_dump(spark, sf).write.text(path)
    docs = P.number_documents(T.raw_variant_scan(spark, path, one_per_line=True), store)
    flat = store.table(K.count_defaults(P.flatten_comments(docs), ["likeCount"]), "flat")
    doc = F.floor(F.substring("videoId", 2, 20).cast("bigint") / 3)
    places = flat.groupBy("ord").agg(F.count("*").alias("sameOrd"), F.min(doc).alias("doc")).withColumn(
        "place", F.row_number().over(Window.partitionBy("doc").orderBy("ord")))
    return flat.join(places, "ord").select("commentId", "gameLabel", "videoId", "channelTitle", "videoTitle", "videoViewCount", "likeCount",
                                           "isTopLevel", "text", "sameOrd", "place")


@query("conform_schema", f"""{Q.with_(DUMP_SQL)}
SELECT id AS "commentId", NULL::VARCHAR AS "channelTitle", NULL::BIGINT AS "totalReplyCount",
       '2024-01-05T10:00:00Z' AS "publishedAt", '2024-01-01T00:00:00Z' AS "videoPublishedAt", 24 AS columns FROM turns""")
def conform_schema(spark, sf):
    flat = P.conform_schema(P.flatten_comments(V.raw_dump(spark, sf)).drop("channelTitle", "totalReplyCount"))
    return flat.select(
        "commentId", "channelTitle", "totalReplyCount", C.to_zulu(F.col("publishedAt")).alias("publishedAt"),
        C.to_zulu(F.col("videoPublishedAt")).alias("videoPublishedAt"), F.lit(len(flat.columns)).alias("columns"),
    )


@query("text_fallback", f"""{Q.with_(DUMP_SQL)} SELECT id AS "commentId", text FROM turns""")
def text_fallback(spark, sf):
    return P.text_fallback(P.flatten_comments(V.raw_dump(spark, sf))).select("commentId", "text")


@query("clean_text", f"""SELECT page_id, {Q.clean("html")} AS "textClean" FROM pages""")
def clean_text(spark, sf):
    return V.read(spark, sf, "pages").select("page_id", C.clean_text(F.col("html")).alias("textClean"))


ONLY_LINK = "  www.example.org/a?b "


@query("drop_empty_text", f"""SELECT doc_id, {Q.clean("text")} AS "textClean" FROM documents WHERE doc_id % 9 > 1""")
def drop_empty_text(spark, sf):
    text = F.when(F.col("doc_id") % 9 == 0, ONLY_LINK).when(F.col("doc_id") % 9 > 1, F.col("text"))
    rows = V.read(spark, sf, "documents").select("doc_id", text.alias("text"), F.lit(None).cast("string").alias("textOriginal"))
    return P.drop_empty_text(P.clean_comments(rows)).select("doc_id", "textClean")


@query("dedupe_comments", f"""SELECT min(doc_id) AS ord, lang AS "gameLabel", md5({Q.clean("text")}) AS digest
FROM documents GROUP BY lang, {Q.clean("text")}""")
def dedupe_comments(spark, sf):
    none = F.lit(None).cast("string")
    rows = V.read(spark, sf, "documents").select(
        F.col("lang").alias("gameLabel"), none.alias("commentId"), "text", none.alias("textOriginal"),
        F.col("doc_id").alias("ord"),
    )
    kept = P.dedupe_comments(P.clean_comments(rows))
    return kept.select("ord", "gameLabel", F.md5(F.col("textClean").cast("binary")).alias("digest"))


@query("parse_bool", """SELECT event_id, coalesce(lower(f) IN ('false', '0'), false) AS reply,
  coalesce(lower(f) IN ('true', '1'), false) AS top, coalesce(lower(f) IN ('true', '1', 'yes'), false) AS top_or_yes
FROM (SELECT event_id, ['False', '0', 'true', '1', 'Yes', 'No', NULL, 'FALSE'][event_id % 8 + 1] AS f FROM events)""")
def parse_bool(spark, sf):
    flags = F.array(*[F.lit(x) for x in ("False", "0", "true", "1", "Yes", "No", None, "FALSE")])
    flag = F.get(flags, (F.col("event_id") % 8).cast("int"))
    rows = V.read(spark, sf, "events").select("event_id", flag.alias("f"))
    f = F.col("f")
    return rows.select(
        "event_id", C.is_reply(f).alias("reply"), C.is_top_level(f).alias("top"),
        C.is_top_level(f, ("true", "1", "yes")).alias("top_or_yes"),
    )


@query("reply_filter", f"""{Q.with_(Q.EVENTS)} SELECT "commentId" FROM revents
WHERE NOT "isTopLevel" AND "authorChannelId" <> "replyToAuthorChannelId" """)
def reply_filter(spark, sf):
    return P.reply_filter(V.reply_events(spark, sf)).select("commentId")


@query("reply_edges", f"""{Q.with_(Q.EVENTS, Q.edges("revents"))} SELECT * FROM edges""")
def reply_edges(spark, sf):
    return P.reply_edges(V.reply_events(spark, sf))


SUMMARY_ROWS = """
shaped AS (
  SELECT *, CASE WHEN ord % 17 = 0 THEN '' ELSE "textClean" END AS clean, 'same' AS id FROM comments
),
firsts AS (SELECT * FROM shaped WHERE clean <> '' QUALIFY row_number() OVER (PARTITION BY "gameLabel", clean ORDER BY ord) = 1)
"""


@query("preprocess_summary", f"""{Q.with_(Q.COMMENTS, SUMMARY_ROWS)}
SELECT r.*, raw_comments_replies - removed_empty_text - final_analysis_comments AS removed_duplicates, f.* EXCLUDE (g)
FROM (SELECT "gameLabel" AS game, count(*) AS raw_comments_replies, count(*) FILTER (clean = '') AS removed_empty_text
      FROM shaped GROUP BY ALL) r
JOIN (SELECT "gameLabel" AS g, count(*) AS final_analysis_comments, count(*) FILTER ("isTopLevel") AS top_level_comments,
        count(*) FILTER (NOT "isTopLevel") AS replies, count(DISTINCT "authorChannelId") AS unique_users,
        count(DISTINCT CASE WHEN "authorChannelId" <> "replyToAuthorChannelId"
                            THEN "authorChannelId" || '>' || "replyToAuthorChannelId" END) AS final_reply_edges,
        count(DISTINCT "videoId") AS videos FROM firsts GROUP BY ALL) f ON f.g = r.game""")
def preprocess_summary(spark, sf):
    rows = V.comments(spark, sf).withColumns({
        "commentId": F.lit("same"), "text": F.when(F.col("ord") % 17 != 0, F.col("text")),
    })
    return P.preprocess_summary(P.clean_comments(rows))


@query("union_games", f"""{Q.with_(Q.EVENTS, Q.edges("revents"))}
SELECT * FROM edges""")
def union_games(spark, sf):
    rows = V.reply_events(spark, sf)
    games = [r[0] for r in rows.select("gameLabel").distinct().orderBy("gameLabel").collect()]  # one table per game
    games = [rows.filter(F.col("gameLabel").eqNullSafe(F.lit(game))) for game in games]
    return P.reply_edges(P.union_games(games))


# --- samples ------------------------------------------------------------------------------------


@query("head_per_group", f"""{Q.with_(Q.EVENTS)} SELECT "gameLabel", "commentId" FROM revents
QUALIFY row_number() OVER (PARTITION BY "gameLabel" ORDER BY ord) <= 50""")
def head_per_group(spark, sf):
    return U.head_per_group(V.reply_events(spark, sf)).select("gameLabel", "commentId")


@query("top_edges_per_group", f"""{Q.with_(Q.EVENTS, Q.edges("revents"))} SELECT * FROM edges
QUALIFY row_number() OVER (PARTITION BY "gameLabel" ORDER BY weight DESC, source, target) <= 75""")
def top_edges_per_group(spark, sf):
    return U.top_edges_per_group(P.reply_edges(V.reply_events(spark, sf)))


@query("head_rows", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 100")
def head_rows(spark, sf):
    return U.head_rows(V.read(spark, sf, "documents").select("doc_id", "lang", "source"), ["doc_id"])


@query("truncate_nested", f"""{Q.with_(DUMP_SQL)}
SELECT 'v' || conv_id AS "videoId", least(count(*), 50) AS kept, min(id) FILTER (turn = 0) AS "firstId" FROM turns
GROUP BY conv_id QUALIFY row_number() OVER (PARTITION BY conv_id // 3 ORDER BY conv_id) = 1""")
def truncate_nested(spark, sf):
    path = Scratch(spark, "dump").path("json")
    V.text_dump(spark, sf).select(F.regexp_replace("value", r'"likeCount":"[a-z0-9]*"', '"likeCount":0').alias("value")).write.text(path)
    docs = U.truncate_nested(T.raw_json_scan(spark, path, one_per_line=True))
    videos = docs.select(F.explode("videos").alias("video")).filter(F.col("video.sample_note").isNotNull())
    return videos.select("video.videoId", F.size("video.comments").cast("bigint").alias("kept"),
                         F.col("video.comments")[0]["commentId"].alias("firstId"))
