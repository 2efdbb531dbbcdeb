"""Collection rules over raw search hits, threads and replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import columns as C
from threadloom.functions.ranking import first_n
from threadloom.operators.preprocess import union_games

LAST = (1 << 63) - 1  # place of comments without a time: after all others


def date_window(df: DataFrame, after: Column | None, before: Column | None, ts: str = "publishedAt") -> DataFrame:
    return df.filter(C.in_window(F.col(ts), after, before))


def author_id_extract(df: DataFrame, column: str = "authorChannelId") -> DataFrame:
    """The id inside ``{value}``; any other shape has no id."""
    kind = df.schema[column].dataType
    inside = kind.typeName() == "struct" and "value" in kind.names
    value = F.col(f"{column}.value") if inside else F.lit(None).cast("string")
    return df.withColumn(column, value)


def count_defaults(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({name: C.count_or_zero(F.col(name)) for name in columns})


def first_query_wins(hits: DataFrame) -> DataFrame:
    return first_n(hits, ["gameLabel", "videoId"], ["queryRank", "resultRank"], 1)


def cap_videos_per_game(videos: DataFrame, n: int | None = 25) -> DataFrame:
    return first_n(videos, ["gameLabel"], ["queryRank", "resultRank", "videoId"], n)


def cap_top_level_per_video(top: DataFrame, n: int | None = 500) -> DataFrame:
    return first_n(top, ["videoId"], ["-publishedAt", "commentId"], n)


def cap_replies_per_thread(
    replies: DataFrame, n: int | None, after: Column | None = None, before: Column | None = None
) -> DataFrame:
    """The first ``n`` replies inside the window; those outside do not use up the cap."""
    return first_n(date_window(replies, after, before), ["threadId"], ["ord"], n)


def min_comments_per_video(comments: DataFrame, n: int | None) -> DataFrame:
    if n is None:
        return comments
    full = comments.groupBy("videoId").agg(F.count("*").alias("n")).filter(F.col("n") >= n)
    return comments.join(full, "videoId", "left_semi")


def resolve_reply_target(replies: DataFrame, top: DataFrame) -> DataFrame:
    """Every reply answers its thread's top-level author, also when that comment is outside the window."""
    target = top.select(
        "threadId",
        F.col("commentId").alias("parentCommentId"),
        F.col("authorDisplayName").alias("replyToAuthorDisplayName"),
        F.col("authorChannelId").alias("replyToAuthorChannelId"),
    )
    rows = replies.drop("parentCommentId", "replyToAuthorDisplayName", "replyToAuthorChannelId")
    return rows.join(target, "threadId", "left")


def thread_union(top: DataFrame, replies: DataFrame) -> DataFrame:
    own = top.drop("parentCommentId", "replyToAuthorDisplayName", "replyToAuthorChannelId").withColumns(
        {"isTopLevel": F.lit(True), "parentCommentId": F.lit(None).cast("string")}
    )
    return union_games([own, replies.drop("totalReplyCount").withColumn("isTopLevel", F.lit(False))])


def visited_threads(top: DataFrame, kept: DataFrame, n: int | None) -> DataFrame:
    """Threads reached before the cap on top-level comments ended a video's listing (newest first)."""
    if n is None:
        return top
    place = F.struct(F.coalesce(-F.unix_micros("publishedAt"), F.lit(LAST)).alias("at"), "commentId")
    last = kept.groupBy("videoId").agg(F.count("*").alias("_n"), F.max(place).alias("_last")).filter(F.col("_n") >= n)
    reached = F.col("_last").isNull() | (place <= F.col("_last"))
    return top.join(last, "videoId", "left").filter(reached).drop("_n", "_last")


def collect_threads(
    top: DataFrame,
    replies: DataFrame,
    after: Column | None = None,
    before: Column | None = None,
    top_per_video: int | None = 500,
    replies_per_thread: int | None = None,
    min_per_video: int | None = None,
) -> DataFrame:
    """All rules for one set of threads: targets, windows, caps, union and the size filter."""
    answered = resolve_reply_target(replies, top)
    kept = cap_top_level_per_video(date_window(top, after, before), top_per_video)
    reached = visited_threads(top, kept, top_per_video).select("threadId")
    answers = answered.join(reached, "threadId", "left_semi")
    answers = cap_replies_per_thread(answers, replies_per_thread, after, before)
    return min_comments_per_video(thread_union(kept, answers), min_per_video)
