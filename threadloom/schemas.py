"""Declared schemas: the nested dump, the flat comment table and the score tables."""

from pyspark.sql import types as T

S, L, D, B, TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


COMMENT = struct(
    gameLabel=S, queryUsed=S, videoId=S, threadId=S, commentId=S, parentCommentId=S, isTopLevel=B,
    authorDisplayName=S, authorChannelId=S, replyToAuthorDisplayName=S, replyToAuthorChannelId=S,
    text=S, textOriginal=S, publishedAt=S, updatedAt=S, likeCount=L, totalReplyCount=L,
)

VIDEO = struct(
    gameLabel=S, queryUsed=S, title=S, videoId=S, channelTitle=S, channelId=S, publishedAt=S,
    viewCount=L, likeCount=L, commentCount=L, comments=T.ArrayType(COMMENT),
)

DUMP = struct(gameLabel=S, searchQueries=T.ArrayType(S), collectedAtUtc=S, videos=T.ArrayType(VIDEO))

# The fixed 24 columns of the flat comment table, in order.
FLAT = struct(
    gameLabel=S, queryUsed=S, videoId=S, videoTitle=S, channelId=S, channelTitle=S,
    commentId=S, parentCommentId=S, threadId=S, isTopLevel=B, authorDisplayName=S, authorChannelId=S,
    replyToAuthorDisplayName=S, replyToAuthorChannelId=S, text=S, textOriginal=S,
    publishedAt=TS, updatedAt=TS, likeCount=L, totalReplyCount=L,
    videoPublishedAt=TS, videoViewCount=L, videoLikeCount=L, videoCommentCount=L,
)

EDGES = struct(gameLabel=S, source=S, target=S, weight=L)

SCORE_KEY = ["commentId", "textClean"]
LEXICON_SCORES = struct(
    sentiment_method=S, vader_neg=D, vader_neu=D, vader_pos=D, vader_compound=D, vader_label=S,
    sentiment_label=S, sentiment_score=D,
)
CLASSIFIER_SCORES = struct(
    sentiment_method=S, roberta_raw_label=S, roberta_label=S, roberta_confidence=D,
    sentiment_label=S, sentiment_score=D,
)
