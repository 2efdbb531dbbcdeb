"""The shapes of the engine seen over the star-schema test tables.

comments      documents, with time and user of the event of the same number where there is one:
              language as game, source as video
reply events  events: type as game, one thread per type and hour
second labels the quality and toxicity labels as a second model's output
raw dump      conversations as nested documents, one conversation per document
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.labels import NEGATIVE, NEUTRAL, POSITIVE
from threadloom.schemas import DUMP

MONTHS = 18  # publication times are spread over this many months


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def answered(rows: DataFrame, thread: list[str], order: list[str], author: str, ident: str) -> DataFrame:
    """Mark each thread's first row as top level and the target of all others."""
    first = rows.groupBy(*thread).agg(F.min(F.struct(*order, author)).alias("_first"))
    first = first.select(*thread, F.col(f"_first.{ident}").alias("_top"), F.col(f"_first.{author}").alias("_target"))
    top = F.col(ident) == F.col("_top")
    return rows.join(first, thread).select(
        "*",
        top.alias("isTopLevel"),
        F.when(~top, F.col("_top").cast("string")).alias("parentCommentId"),
        F.when(~top, F.col("_target")).alias("replyTo"),
    )


def user_id(col: Column) -> Column:
    return F.concat(F.lit("u"), col.cast("string"))


def user_name(col: Column) -> Column:
    return F.concat(F.lit("Name "), (col % 400).cast("string"))


def comments(spark: SparkSession, sf_dir: str, text: bool = True) -> DataFrame:
    """Threads are resolved on narrow rows; the texts move once, for the join by document."""
    documents, events = read(spark, sf_dir, "documents"), read(spark, sf_dir, "events")
    rows = documents.select("doc_id", "lang", "source").join(
        events.select(F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("ts"), "user_id", "value"),
        "doc_id", "left",
    ).withColumns({
        "ts": F.coalesce("ts", F.lit("2024-01-01").cast("timestamp")),
        "user_id": F.coalesce("user_id", F.col("doc_id") % 1000), "value": F.coalesce("value", F.lit(0)),
    }).withColumn("week", F.date_trunc("week", "ts"))
    rows = answered(rows, ["lang", "source", "week"], ["ts", "doc_id"], "user_id", "doc_id")
    if text:
        # A broadcast of texts would leave all later text work to the few tasks that read the narrow rows; a
        # sorted join spills where a hashed side could not. The number of partitions is fixed, as partitions merged to
        # 64 MB of packed text leave one or two tasks a core, and cores idle while the last ones run.
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = documents.select("doc_id", "text").repartition(parts, "doc_id").join(rows.hint("merge"), "doc_id")
    published = F.col("ts") + F.make_interval(months=(F.col("doc_id") % MONTHS).cast("int"))
    return rows.select(
        F.col("lang").alias("gameLabel"),
        F.concat(F.lit("query "), F.substring("source", 4, 9)).alias("queryUsed"),
        F.col("source").alias("videoId"),
        F.concat(F.lit("Thread collection of the public source number "), "source").alias("videoTitle"),
        F.col("doc_id").cast("string").alias("commentId"),
        "parentCommentId",
        F.concat_ws("/", "lang", "source", F.date_format("week", "yyyy-MM-dd")).alias("threadId"),
        "isTopLevel",
        user_name(F.col("user_id")).alias("authorDisplayName"),
        user_id(F.col("user_id")).alias("authorChannelId"),
        user_name(F.col("replyTo")).alias("replyToAuthorDisplayName"),
        user_id(F.col("replyTo")).alias("replyToAuthorChannelId"),
        *(["text", F.lit(None).cast("string").alias("textOriginal")] if text else []),
        published.alias("publishedAt"),
        F.col("value").cast("bigint").alias("likeCount"),
        F.col("doc_id").alias("ord"),
    )


def reply_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select(
        "event_id", "event_type", "user_id", F.col("ts").cast("timestamp").alias("ts"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"),
    )
    rows = answered(rows, ["event_type", "hour"], ["ts", "event_id"], "user_id", "event_id")
    return rows.select(
        F.col("event_type").alias("gameLabel"),
        F.col("event_id").cast("string").alias("commentId"),
        F.concat_ws("/", "event_type", F.date_format("hour", "yyyy-MM-dd HH")).alias("threadId"),
        "isTopLevel",
        user_id(F.col("user_id")).alias("authorChannelId"),
        user_id(F.col("replyTo")).alias("replyToAuthorChannelId"),
        F.col("ts").alias("publishedAt"),
        F.col("event_id").alias("ord"),
    )


def second_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("toxic") == 1, NEGATIVE).when(F.col("quality") == 1, POSITIVE).otherwise(NEUTRAL)
    confidence = (50 + F.col("doc_id") % 50) / F.lit(100.0)
    return read(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("commentId"),
        label.alias("sentiment_label"),
        confidence.alias("sentiment_score"),
        label.alias("roberta_label"),
        confidence.alias("roberta_confidence"),
    )


def raw_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document with one video per conversation; the first turn is the top-level comment."""
    turns = read(spark, sf_dir, "conversations")
    conv = F.col("conv_id").cast("string")
    comment = {
        "gameLabel": F.concat(F.lit("g"), (F.col("conv_id") % 4).cast("string")),
        "queryUsed": F.concat(F.lit("q"), (F.col("conv_id") % 7).cast("string")),
        "videoId": F.concat(F.lit("v"), conv),
        "threadId": F.concat(F.lit("t"), conv),
        "commentId": F.concat_ws("-", conv, F.col("turn").cast("string")),
        "parentCommentId": F.when(F.col("turn") > 0, F.concat(conv, F.lit("-0"))),
        "isTopLevel": F.col("turn") == 0,
        "authorDisplayName": F.col("role"),
        "authorChannelId": F.concat_ws("-", "role", (F.col("conv_id") % 50).cast("string")),
        "replyToAuthorDisplayName": F.when(F.col("turn") > 0, F.lit("first")),
        "replyToAuthorChannelId": F.when(
            F.col("turn") > 0, F.concat_ws("-", F.lit("user"), (F.col("conv_id") % 50).cast("string"))
        ),
        "text": F.when(F.col("turn") % 5 < 4, F.col("text")),
        "textOriginal": F.col("text"),
        "publishedAt": F.lit("2024-01-05T10:00:00Z"),
        "updatedAt": F.lit(None),
        "likeCount": F.col("turn"),
        "totalReplyCount": F.lit(None),
    }
    fields = {f.name: f.dataType for f in DUMP["videos"].dataType.elementType["comments"].dataType.elementType}
    row = F.struct("turn", *[comment[name].cast(kind).alias(name) for name, kind in fields.items()])
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    video = {
        "gameLabel": F.concat(F.lit("g"), (F.col("conv_id") % 4).cast("string")),
        "queryUsed": F.lit("q"),
        "title": F.concat(F.lit("Conversation "), conv),
        "videoId": F.concat(F.lit("v"), conv),
        "channelTitle": F.lit("channel"),
        "channelId": F.concat(F.lit("c"), (F.col("conv_id") % 9).cast("string")),
        "publishedAt": F.lit("2024-01-01T00:00:00Z"),
        "viewCount": F.col("conv_id") * 10,
        "likeCount": F.col("conv_id"),
        "commentCount": F.size("turns"),
        "comments": F.transform("turns", lambda t: t.dropFields("turn")),
    }
    kinds = {f.name: f.dataType for f in DUMP["videos"].dataType.elementType}
    return grouped.select(
        video["gameLabel"].alias("gameLabel"),
        F.array(F.lit("q")).alias("searchQueries"),
        F.lit("2024-02-01T00:00:00Z").alias("collectedAtUtc"),
        F.array(F.struct(*[video[n].cast(k).alias(n) for n, k in kinds.items()])).alias("videos"),
    )


def text_dump(spark: SparkSession, sf_dir: str, videos: int = 3, line: str = "") -> DataFrame:
    """One JSON document per row (``value``), some conversations as its videos; ``line`` parts its elements.

    Of the comments some name keys of their video again, with a value or a null, and some write counters as text.
    """
    turns = read(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id").cast("string"), F.col("turn")
    plain = F.to_json(F.struct(
        F.concat(F.lit("g"), (F.col("conv_id") % 4).cast("string")).alias("gameLabel"),
        F.concat_ws("-", conv, turn.cast("string")).alias("commentId"), (turn == 0).alias("isTopLevel"),
        F.col("role").alias("authorChannelId"), F.col("text"), F.lit("2024-01-05T10:00:00Z").alias("publishedAt"),
    ))
    more = (F.when(turn % 4 == 0, F.concat(F.lit('"videoTitle":"own '), conv, F.lit('","likeCount":"'), turn.cast("string"), F.lit('"')))
            .when(turn % 4 == 1, '"videoTitle":null,"videoViewCount":null,"likeCount":"many"')
            .when(turn % 4 == 2, F.concat(F.lit('"videoViewCount":"77","note":{"a":[1]},"likeCount":'), turn.cast("string")))
            .otherwise('"likeCount":null'))
    row = F.struct("turn", F.concat(F.expr("left(x, length(x) - 1)"), F.lit(","), more, F.lit("}")).alias("json"))
    rows = turns.withColumn("x", plain).groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns")).select(
        "conv_id", F.concat(
            F.lit('{"videoId":"v'), conv, F.lit('","title":"Conversation '), conv, F.lit('","viewCount":'), (F.col("conv_id") * 10).cast("string"),
            F.lit(',"comments":['), F.array_join("turns.json", ","), F.lit("]}")).alias("json"))
    docs = rows.groupBy(F.floor(F.col("conv_id") / videos).alias("doc")).agg(F.array_sort(F.collect_list(F.struct("conv_id", "json"))).alias("videos"))
    head = f'{{{line}"gameLabel":"g","searchQueries":["q"],"collectedAtUtc":"2024-02-01T00:00:00Z",{line}"videos":[{line}'
    return docs.select(F.concat(F.lit(head), F.array_join("videos.json", f",{line}"), F.lit(f"{line}]{line}}}")).alias("value"))
