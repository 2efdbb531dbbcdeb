"""From the nested dump to clean, distinct comments and reply edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions import columns as C
from threadloom.functions.ranking import first_n
from threadloom.schemas import FLAT, S, TS
from threadloom.session import Scratch

# Flat column -> video attribute it repeats.
VIDEO_COLUMNS = {
    "videoTitle": "title",
    "videoId": "videoId",
    "channelId": "channelId",
    "channelTitle": "channelTitle",
    "videoPublishedAt": "publishedAt",
    "videoViewCount": "viewCount",
    "videoLikeCount": "likeCount",
    "videoCommentCount": "commentCount",
}
# Of rows with one position (two dumps of a game), these decide which is first.
FIRST_BY = ["videoId", "threadId", "publishedAt", "authorChannelId"]


def dedupe_key() -> list:
    """Game, comment and a digest of the clean text: texts are too long for exchange and sort keys."""
    return [F.col("gameLabel"), F.col("commentId"), F.md5(F.col("textClean").cast("binary")).alias("textDigest")]


def first_order(df: DataFrame, order: str = "ord") -> list[str]:
    return [order, *[name for name in FIRST_BY if name in df.columns]]


def flatten_comments(docs: DataFrame) -> DataFrame:
    """One row per comment with its video's attributes; a field of the comment wins over the video's of that name.

    In documents read as variants every key of the comment counts, and one that is present with a null wins too.
    ``ord`` is the position in the dump; over numbered documents it is unique.
    """
    numbers = [c for c in ("_doc", "_video_bits", "_comment_bits") if c in docs.columns]
    videos = docs.select(*numbers, F.posexplode("videos").alias("_v", "video"))
    rows = videos.select(*numbers, "_v", "video", F.posexplode(_comments(docs, F.col("video"))).alias("_c", "comment"))
    if _as_variants(docs):
        flat = _from_variant(rows)
    else:
        fields = set(rows.schema["comment"].dataType.names)
        attributes = set(rows.schema["video"].dataType.names)
        flat = []
        for column in FLAT:
            choices = [F.col(f"comment.{column.name}")] if column.name in fields else []
            if VIDEO_COLUMNS.get(column.name) in attributes:
                choices.append(F.col(f"video.{VIDEO_COLUMNS[column.name]}"))
            if choices:
                flat.append(F.coalesce(*choices).alias(column.name))
    video = F.col("_v").cast("bigint")
    ordinal = F.shiftleft(video, 32) + F.col("_c")
    if numbers:
        above = F.call_function("shiftleft", F.col("_doc"), F.col("_video_bits")) + video
        ordinal = F.call_function("shiftleft", above, F.col("_comment_bits")) + F.col("_c")
    return rows.select(*flat, ordinal.alias("ord"))


def number_documents(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents, written once, with what makes the places of their comments unique over all of them.

    ``_doc`` counts the documents in the order of the scan; ``_video_bits`` and ``_comment_bits`` are what the longest
    lists need. Only counts per partition come to the driver.
    """
    table = scratch.table(docs.withColumn("_m", F.monotonically_increasing_id()), "documents")
    longest = F.array_max(F.transform("videos", lambda v: F.coalesce(F.size(_comments(docs, v)), F.lit(0))))
    part = F.shiftright("_m", 33)
    rows = table.groupBy(part.alias("p")).agg(
        F.count("*").alias("n"), F.max(F.size("videos")).alias("v"), F.max(longest).alias("c")).orderBy("p").collect()
    offsets, total = [], 0
    for row in rows:
        offsets.append((row["p"], total))
        total += row["n"]
    bits = [max([row[k] or 0 for row in rows], default=0).bit_length() for k in ("v", "c")]
    if total.bit_length() + sum(bits) > 63:
        raise ValueError("places of comments do not fit 64 bits")
    starts = docs.sparkSession.createDataFrame(offsets, "_p bigint, _start bigint")
    place = F.col("_start") + F.col("_m") - F.shiftleft(F.col("_p"), 33)
    return table.join(F.broadcast(starts), part == F.col("_p")).withColumns(
        {"_doc": place, "_video_bits": F.lit(bits[0]), "_comment_bits": F.lit(bits[1])}).drop("_m", "_p", "_start")


def _as_variants(docs: DataFrame) -> bool:
    return docs.schema["videos"].dataType.elementType.typeName() == "variant"


def _comments(docs: DataFrame, video: Column) -> Column:
    return F.try_variant_get(video, "$.comments", "array<variant>") if _as_variants(docs) else video["comments"]


def _from_variant(rows: DataFrame) -> list[Column]:
    """The flat columns of (video, comment) variants: a key of the comment wins, also with a null, over the video's."""
    def get(source: str, key: str, kind: T.DataType) -> Column:
        # By way of text, so that a number or flag written as text is read as well; others become null.
        return F.try_variant_get(source, f"$.{key}", "string").try_cast(kind)

    flat = []
    for column in FLAT:
        kind = S if column.dataType == TS else column.dataType
        value = get("comment", column.name, kind)
        if column.name in VIDEO_COLUMNS:
            present = F.try_variant_get("comment", f"$.{column.name}", "variant").isNotNull()
            value = F.when(present, value).otherwise(get("video", VIDEO_COLUMNS[column.name], kind))
        flat.append(value.alias(column.name))
    return flat


def conform_schema(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The fixed 24 columns in order and type; absent ones become null."""
    columns = []
    for column in FLAT:
        if column.name not in df.columns:
            value = F.lit(None)
        elif column.dataType.typeName() == "timestamp" and dict(df.dtypes)[column.name] == "string":
            value = C.parse_utc(F.col(column.name))
        else:
            value = F.col(column.name)
        columns.append(value.cast(column.dataType).alias(column.name))
    return df.select(*columns, *(keep or []))


def text_fallback(df: DataFrame) -> DataFrame:
    """``text``, or the original text where it is null; an empty text stays."""
    return df.withColumn("text", F.coalesce("text", "textOriginal"))


def clean_comments(df: DataFrame) -> DataFrame:
    return C.computed(df, textClean=C.clean_text(F.coalesce("text", "textOriginal")))


def drop_empty_text(df: DataFrame) -> DataFrame:
    return df.filter(F.col("textClean") != "")


def dedupe_comments(df: DataFrame, order: list | None = None) -> DataFrame:
    """First row per game, comment id and clean text. Copies are cut before the exchange."""
    return first_n(df, dedupe_key(), order or first_order(df), 1)


def reply_filter(df: DataFrame) -> DataFrame:
    """Replies with both authors known and different."""
    author, target = F.col("authorChannelId"), F.col("replyToAuthorChannelId")
    return df.filter(C.is_reply(F.col("isTopLevel")) & author.isNotNull() & target.isNotNull() & (author != target))


def reply_edges(df: DataFrame) -> DataFrame:
    """Directed edges weighted by the number of replies; a null game is a group of its own."""
    ends = reply_filter(df).select(
        "gameLabel", F.col("authorChannelId").alias("source"), F.col("replyToAuthorChannelId").alias("target")
    )
    return ends.groupBy("gameLabel", "source", "target").agg(F.count("*").alias("weight"))


def sorted_edges(edges: DataFrame) -> DataFrame:
    return edges.orderBy("gameLabel", F.desc("weight"), "source", "target")


def union_games(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def preprocess(flat: DataFrame) -> DataFrame:
    """Clean, non-empty, distinct comments."""
    return dedupe_comments(drop_empty_text(clean_comments(flat)))


def preprocess_summary(cleaned: DataFrame, order: str = "ord", games: DataFrame | None = None) -> DataFrame:
    """Counts per game from rows that carry ``textClean`` but are neither filtered nor deduplicated.

    One pass: copies collapse on the dedupe key before the counting, so a hot group of copies shrinks
    on the map side.
    """
    first = F.min_by(
        F.struct("isTopLevel", "authorChannelId", "replyToAuthorChannelId", "videoId"), F.struct(*first_order(cleaned, order))
    ).alias("first")
    distinct = (
        cleaned.groupBy(*dedupe_key()).agg(F.count("*").alias("copies"), first, F.max(F.col("textClean") != "").alias("kept"))
        .select(F.col("gameLabel").alias("game"), "copies", "kept", "first.*")
    )
    kept = F.col("kept")
    top = C.is_top_level(F.col("isTopLevel"))
    author, target = F.col("authorChannelId"), F.col("replyToAuthorChannelId")
    edge = kept & C.is_reply(F.col("isTopLevel")) & (author != target)
    summary = distinct.groupBy("game").agg(
        F.sum("copies").alias("raw_comments_replies"),
        F.sum(F.when(kept, 0).otherwise(F.col("copies"))).alias("removed_empty_text"),
        F.sum(F.when(kept, F.col("copies") - 1).otherwise(0)).alias("removed_duplicates"),
        F.count_if(kept).alias("final_analysis_comments"),
        F.count_if(kept & top).alias("top_level_comments"),
        F.count_if(kept & ~top).alias("replies"),
        F.count_distinct(F.when(kept, author)).alias("unique_users"),
        F.count_distinct(F.when(edge, F.struct(author, target))).alias("final_reply_edges"),
        F.count_distinct(F.when(kept, F.col("videoId"))).alias("videos"),
    )
    if games is None:
        return summary
    known = games.select("game").distinct().join(summary, "game", "left")
    return known.withColumn("raw_comments_replies", F.coalesce("raw_comments_replies", F.lit(0).cast("bigint")))
