"""Sentiment scores, the score cache and label distributions over the test tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from threadloom.functions import columns as C
from threadloom.operators import cache as S
from threadloom.operators import distribution as D
from threadloom.operators import preprocess as P
from threadloom.operators import sentiment as T
from threadloom.plans import views_sql as Q
from threadloom.plans.registry import query
from threadloom.schemas import CLASSIFIER_SCORES, LEXICON_SCORES, SCORE_KEY
from threadloom.session import Scratch
from threadloom.sources import star_views as V


def clean(spark, sf):
    return P.clean_comments(V.comments(spark, sf))


def scored(spark, sf):
    return T.lexicon_sentiment(clean(spark, sf), Q.TEST_LEXICON)


VADER = ["vader_neg", "vader_neu", "vader_pos", "vader_compound"]
SCORED_SQL = Q.with_(Q.COMMENTS, Q.SCORED)


@query("lexicon_sentiment", f"""{SCORED_SQL}
SELECT "commentId", {", ".join(VADER)}, sentiment_label, sentiment_label AS vader_label,
       vader_compound AS sentiment_score, 'vader' AS sentiment_method FROM scored""")
def lexicon_sentiment(spark, sf):
    return scored(spark, sf).select("commentId", *LEXICON_SCORES.names)


@query("label_from_compound", """
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'Neutral' WHEN x >= 0.05 THEN 'Positive' WHEN x <= -0.05 THEN 'Negative'
                      ELSE 'Neutral' END AS label FROM (SELECT event_id, (event_id % 41 - 20) / 200.0 AS x FROM events)""")
def label_from_compound(spark, sf):
    score = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise((F.col("event_id") % 41 - 20) / 200.0)
    rows = V.read(spark, sf, "events").select("event_id", score.alias("x"))
    return rows.select("event_id", C.label_from_compound(F.col("x")).alias("label"))


RAW_LABELS = ["LABEL_2", "label_0", "LABEL_1", "Very Positive", "slightly NEGATIVE", "label_22", None]


@query("normalise_label", f"""
SELECT event_id, CASE WHEN r LIKE '%positive%' OR r = 'label_2' THEN 'Positive'
                      WHEN r LIKE '%negative%' OR r = 'label_0' THEN 'Negative' ELSE 'Neutral' END AS label
FROM (SELECT event_id, lower([{", ".join("NULL" if x is None else repr(x) for x in RAW_LABELS)}][event_id % 7 + 1]) AS r
      FROM events)""")
def normalise_label(spark, sf):
    raw = F.get(F.array(*[F.lit(x) for x in RAW_LABELS]), (F.col("event_id") % 7).cast("int"))
    rows = V.read(spark, sf, "events").select("event_id", raw.alias("r"))
    return rows.select("event_id", C.normalise_label(F.col("r")).alias("label"))


def make_stub():
    """A model that looks at the length of a text only."""

    def predict(texts: np.ndarray):
        sizes = np.array([len(t) for t in texts])
        return {"label": np.array([f"LABEL_{n % 3}" for n in sizes]), "score": (sizes % 100) / 100.0}

    return predict


@query("batch_classifier", f"""{Q.with_(Q.COMMENTS)}
SELECT "commentId", 'roberta' AS sentiment_method, 'LABEL_' || (n % 3) AS roberta_raw_label,
       ['Negative', 'Neutral', 'Positive'][n % 3 + 1] AS roberta_label,
       ['Negative', 'Neutral', 'Positive'][n % 3 + 1] AS sentiment_label,
       (n % 100) / 100.0::DOUBLE AS roberta_confidence, (n % 100) / 100.0::DOUBLE AS sentiment_score
FROM (SELECT "commentId", length("textClean") AS n FROM comments)""")
def batch_classifier(spark, sf):
    return T.batch_classifier(clean(spark, sf), make_stub).select("commentId", *CLASSIFIER_SCORES.names)


# --- cache: two write times, so that some keys occur twice --------------------------------------

CACHE_SQL = """
cached AS (
  SELECT "commentId", "textClean", CASE WHEN ord % 4 = 0 THEN 'LABEL_2' ELSE 'LABEL_1' END AS raw,
         CASE WHEN ord % 4 = 0 THEN 'Positive' ELSE 'Neutral' END AS label,
         CASE WHEN ord % 4 = 0 THEN 0.9 ELSE 0.6 END::DOUBLE AS score, ord FROM comments WHERE ord % 2 = 0
)"""


def stored(spark, sf, rows, raw: str, score: float, at: str):
    label = C.normalise_label(F.lit(raw))
    score = F.lit(score)
    return rows.select(
        *SCORE_KEY, F.lit("roberta").alias("sentiment_method"), F.lit(raw).alias("roberta_raw_label"),
        label.alias("roberta_label"), score.alias("roberta_confidence"), label.alias("sentiment_label"),
        score.alias("sentiment_score"), F.lit(at).cast("timestamp").alias("scored_at"),
    )


def two_writes(spark, sf):
    rows = clean(spark, sf)
    first = stored(spark, sf, rows.filter("ord % 2 = 0"), "LABEL_1", 0.6, "2024-01-01")
    return first.union(stored(spark, sf, rows.filter("ord % 4 = 0"), "LABEL_2", 0.9, "2024-01-02"))


def cache(spark, sf):
    return S.score_cache_read(two_writes(spark, sf), CLASSIFIER_SCORES)


@query("score_cache_read", f"""{Q.with_(Q.COMMENTS, CACHE_SQL)}
SELECT "commentId", raw AS roberta_raw_label, label AS sentiment_label, score AS sentiment_score FROM cached""")
def score_cache_read(spark, sf):
    return cache(spark, sf).select("commentId", "roberta_raw_label", "sentiment_label", "sentiment_score")


@query("score_cache_lookup", f"""{Q.with_(Q.COMMENTS, CACHE_SQL)}
SELECT count(*) FILTER (ord % 2 = 0) AS hits, count(*) AS total FROM comments""")
def score_cache_lookup(spark, sf):
    return S.cache_report(S.score_cache_lookup(clean(spark, sf), cache(spark, sf)))


@query("select_uncached", f"""{Q.with_(Q.COMMENTS)} SELECT "commentId" FROM comments WHERE ord % 2 = 1""")
def select_uncached(spark, sf):
    return S.select_uncached(clean(spark, sf), cache(spark, sf)).select("commentId")


@query("merge_scored", f"""{Q.with_(Q.COMMENTS, CACHE_SQL)}
SELECT c."commentId", coalesce(label, ['Negative', 'Neutral', 'Positive'][length(c."textClean") % 3 + 1]) AS sentiment_label
FROM comments c LEFT JOIN cached k USING ("commentId")""")
def merge_scored(spark, sf):
    rows, known = clean(spark, sf), cache(spark, sf)
    new = T.batch_classifier(S.select_uncached(rows, known), make_stub)
    return S.merge_scored(S.score_cache_lookup(rows, known), new).select("commentId", "sentiment_label")


@query("score_cache_upsert", f"""{Q.with_(Q.COMMENTS, CACHE_SQL)}
SELECT c."commentId", CASE WHEN ord % 3 = 0 THEN 0.75 ELSE k.score END::DOUBLE AS sentiment_score
FROM comments c LEFT JOIN cached k USING ("commentId", ord) WHERE ord % 3 = 0 OR k.score IS NOT NULL""")
def score_cache_upsert(spark, sf):
    path = Scratch(spark, "cache").path("scores")
    for at, rows in (("2024-01-02", two_writes(spark, sf)), ("2024-01-03", None)):
        if rows is None:
            later = clean(spark, sf).filter("ord % 3 = 0")
            S.score_cache_upsert(stored(spark, sf, later, "LABEL_0", 0.75, at), path, CLASSIFIER_SCORES,
                                 F.lit(at).cast("timestamp"))
        else:
            S.score_cache_upsert(rows, path, CLASSIFIER_SCORES, F.col("scored_at"))
    return S.open_cache(spark, path, CLASSIFIER_SCORES).select("commentId", "sentiment_score")


# --- distributions ------------------------------------------------------------------------------


@query("sentiment_distribution", f"""{SCORED_SQL} {Q.distribution("scored", ["gameLabel"])}""")
def sentiment_distribution(spark, sf):
    return D.sentiment_distribution(scored(spark, sf), ["gameLabel"])


VIDEO = ["gameLabel", "videoId", "videoTitle"]


@query("sentiment_by_video", f"""{SCORED_SQL} {Q.distribution("scored", VIDEO)}""")
def sentiment_by_video(spark, sf):
    return D.sentiment_distribution(scored(spark, sf), VIDEO)


@query("top_videos", f"""{SCORED_SQL}
SELECT *, "gameLabel" || ': ' || substr("videoTitle", 1, 45) AS video_label FROM ({Q.distribution("scored", VIDEO)})
ORDER BY total DESC, "gameLabel", "videoId", "videoTitle" LIMIT 20""")
def top_videos(spark, sf):
    return D.top_videos(sentiment_by_video(spark, sf))


@query("comment_volume", f"""{Q.with_(Q.COMMENTS)}
SELECT "gameLabel", count(*) FILTER ("isTopLevel") AS "Top-level", count(*) FILTER (NOT "isTopLevel") AS "Reply"
FROM comments GROUP BY ALL""")
def comment_volume(spark, sf):
    return D.comment_volume(V.comments(spark, sf, text=False))
