"""Terms, combined tables and model comparison over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import columns as C
from threadloom.labels import LABELS
from threadloom.operators import combined as B
from threadloom.operators import compare as M
from threadloom.operators import distribution as D
from threadloom.operators import graph as G
from threadloom.operators import terms as K
from threadloom.plans import network_queries as N
from threadloom.plans import sentiment_queries as T
from threadloom.plans import views_sql as Q
from threadloom.plans.registry import query
from threadloom.session import Scratch
from threadloom.sources import star_views as V

# --- terms: language and source as the group ----------------------------------------------------

TERMS_SQL = rf"""
texts AS (SELECT "gameLabel", "videoId", "commentId", lower("textClean") AS t FROM comments WHERE trim("textClean") <> ''),
uni AS (
  SELECT "gameLabel", "videoId", "commentId", list_filter(
    list_transform(list_filter(
      regexp_extract_all(t, '[\p{{L}}\p{{N}}\p{{M}}_'']+'),
      lambda w: regexp_full_match(w, '''*[a-z][a-z0-9_'']*[a-z0-9_]''*')), lambda w: trim(w, '''')),
    lambda w: w NOT IN ({", ".join(f"'{w}'" for w in Q.STOP_WORDS)})) AS u FROM texts
),
occ AS (
  SELECT "gameLabel", "videoId", "commentId", unnest(u) AS term FROM uni
  UNION ALL
  SELECT "gameLabel", "videoId", "commentId", unnest(list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1]))
  FROM uni WHERE len(u) > 1
),
tf AS (SELECT "gameLabel", "videoId", "commentId", term, count(*) AS tf FROM occ GROUP BY ALL),
docs AS (SELECT "gameLabel", "videoId", count(*) AS n FROM texts GROUP BY ALL),
vocab AS (
  SELECT * FROM (SELECT "gameLabel", "videoId", term, count(*) AS df FROM tf GROUP BY ALL)
  JOIN docs USING ("gameLabel", "videoId") WHERE df >= {K.MIN_DOCS} AND df <= {K.MAX_SHARE} * n
),
weighed AS (
  SELECT tf."gameLabel", tf."videoId", "commentId", term, tf.tf * (ln((1 + n) / (1 + df)) + 1) AS x
  FROM tf JOIN vocab USING ("gameLabel", "videoId", term) WHERE n >= {K.MIN_TEXTS}
),
scores AS (
  SELECT "gameLabel", "videoId", term, round(sum(x / norm), {K.SCORE_DIGITS}) AS score FROM weighed
  JOIN (SELECT "gameLabel", "videoId", "commentId", sqrt(sum(x * x)) AS norm FROM weighed GROUP BY ALL)
  USING ("gameLabel", "videoId", "commentId") GROUP BY ALL
)"""
GROUP = ["gameLabel", "videoId"]
TERMS = Q.with_(Q.COMMENTS, TERMS_SQL)


@query("tfidf_tokens", f"""{TERMS} SELECT "commentId", term, tf FROM tf""")
def tfidf_tokens(spark, sf):
    return K.doc_terms(T.clean(spark, sf), GROUP, "commentId", "textClean", Q.STOP_WORDS).drop(*GROUP)


@query("tfidf_vocabulary", f"""{TERMS} SELECT "gameLabel", "videoId", term, df, n FROM vocab""")
def tfidf_vocabulary(spark, sf):
    rows = texts(spark, sf)
    terms = K.doc_terms(rows, GROUP, "commentId", "textClean", Q.STOP_WORDS)
    return K.tfidf_vocabulary(terms, K.group_texts(rows, GROUP, "textClean"), GROUP)


@query("tfidf_scores", f"""{TERMS} SELECT "gameLabel", "videoId", term, round(score, 6) AS score FROM scores""")
def tfidf_scores(spark, sf):
    scores = K.term_scores(T.clean(spark, sf), GROUP, "commentId", "textClean", Q.STOP_WORDS)
    return K.stored_scores(scores).withColumn("score", F.round("score", 6))


def texts(spark, sf):
    """Clean comments as a table, as between the stages: vocabulary and scores both read them."""
    columns = [*GROUP, "commentId", "textClean"]
    return Scratch(spark, "texts").table(T.clean(spark, sf).select(*columns), "comments")


def top_terms_sql(group: str) -> str:
    return f"""
ranked AS (SELECT {group}, term, row_number() OVER (PARTITION BY {group} ORDER BY score DESC, term) AS place FROM scores),
lists AS (SELECT {group}, string_agg(term, ', ' ORDER BY place) AS top_terms FROM ranked
          WHERE place <= {K.TOP_TERMS} GROUP BY ALL)"""


@query("top_terms", f"""{Q.with_(Q.COMMENTS, TERMS_SQL, top_terms_sql('"gameLabel", "videoId"'))}
SELECT "gameLabel", "videoId", coalesce(top_terms, '') AS top_terms
FROM (SELECT DISTINCT "gameLabel", "videoId" FROM comments) LEFT JOIN lists USING ("gameLabel", "videoId")""")
def top_terms(spark, sf):
    return K.top_terms(T.clean(spark, sf), GROUP, stop_words=Q.STOP_WORDS)


# --- communities --------------------------------------------------------------------------------

ENRICHED = Q.with_(Q.COMMENTS, Q.SCORED, *N.COMMENTS_GRAPH[1:], N.communities_sql(), N.rank_sql(), N.CENTRAL, f"""
enriched AS (
  SELECT s.*, p.community AS community_id, c.pagerank, c.centrality_group FROM scored s
  LEFT JOIN part p ON p.game = s."gameLabel" AND p.node = s."authorChannelId"
  LEFT JOIN central c ON c.game = s."gameLabel" AND c.node = s."authorChannelId"
),
valid AS (SELECT * FROM enriched WHERE community_id IS NOT NULL),
users AS (SELECT "gameLabel", community_id, count(DISTINCT "authorChannelId") AS users FROM valid GROUP BY ALL),
names AS (
  SELECT "gameLabel", community_id, string_agg("authorDisplayName", ', ' ORDER BY place) AS top_central_users FROM (
    SELECT *, row_number() OVER (PARTITION BY "gameLabel", community_id ORDER BY p DESC, "authorDisplayName") AS place FROM (
      SELECT "gameLabel", community_id, "authorDisplayName", round(max(pagerank), {B.RANK_DIGITS}) AS p FROM valid GROUP BY ALL)) WHERE place <= 5 GROUP BY ALL
)""")


ENRICHED_COLUMNS = ["gameLabel", "commentId", "authorChannelId", "authorDisplayName", "textClean", "sentiment_label"]


def enriched(spark, sf):
    """Scored comments with the network columns, written once: the tables below read it several times.

    No table below reads the betweenness, so it is not computed for them. The users are a table of their own, so that
    the planner knows their size: if they are few, the texts need not move to meet them.
    """
    graph, scratch = N.comments_graph(spark, sf), Scratch(spark, "enriched")
    central = G.centrality_group(N.measured_users(graph, betweenness=False), graph.games)
    central = scratch.table(central, "users")
    comments = T.scored(spark, sf).select(*ENRICHED_COLUMNS)
    return scratch.table(G.network_enrich(comments, central), "comments", K.TEXT_CODEC)


@query("community_users", f"{ENRICHED} SELECT * FROM users")
def community_users(spark, sf):
    return B.community_users(enriched(spark, sf).filter("community_id is not null"))


@query("top_central_users", f"{ENRICHED} SELECT * FROM names")
def top_central_users(spark, sf):
    return B.top_central_users(enriched(spark, sf).filter("community_id is not null"))


COMMUNITY_TERMS = TERMS_SQL.replace('"videoId"', "community_id").replace("FROM comments", "FROM valid")
SUMMARY = (
    ENRICHED.rstrip() + ",\n" + COMMUNITY_TERMS.strip() + "," + top_terms_sql('"gameLabel", community_id') + f""",
summary AS (
  SELECT d.* EXCLUDE ("gameLabel"), d."gameLabel" AS game, users, coalesce(top_terms, '') AS top_terms, top_central_users
  FROM ({Q.distribution("valid", ["gameLabel", "community_id"], "comments")}) d
  JOIN users USING ("gameLabel", community_id) LEFT JOIN lists USING ("gameLabel", community_id)
  LEFT JOIN names USING ("gameLabel", community_id)
)
"""
)


@query("community_summary", f"{SUMMARY} SELECT * FROM summary")
def community_summary(spark, sf):
    return B.community_summary(enriched(spark, sf), Q.STOP_WORDS)


@query("top_communities_by_users", f"""{SUMMARY} SELECT *, game || ' C' || community_id AS community_label FROM summary
QUALIFY row_number() OVER (PARTITION BY game ORDER BY users DESC, community_id) <= 8""")
def top_communities_by_users(spark, sf):
    return B.top_communities_by_users(community_summary(spark, sf))


@query("sentiment_by_centrality", f"""{ENRICHED}
SELECT *, "gameLabel" || ': ' || centrality_group AS group_label
FROM ({Q.distribution("enriched", ["gameLabel", "centrality_group"], "comments")})""")
def sentiment_by_centrality(spark, sf):
    return D.sentiment_by_centrality(enriched(spark, sf))


# --- two models ---------------------------------------------------------------------------------

MERGED = Q.with_(Q.COMMENTS, Q.SCORED, Q.SECOND, Q.MERGED)


def compared(spark, sf):
    return M.compare(T.scored(spark, sf), V.second_labels(spark, sf))


@query("join_models", f"""{MERGED}
SELECT "commentId", "gameLabel", "videoTitle", vader AS vader_label_final, roberta AS roberta_label_final,
       vader_compound, vader_compound AS vader_score, roberta_confidence, roberta_confidence AS roberta_score FROM merged""")
def join_models(spark, sf):
    return M.join_models(T.scored(spark, sf), V.second_labels(spark, sf)).select(
        "commentId", "gameLabel", "videoTitle", "vader_label_final", "roberta_label_final", "vader_compound",
        "vader_score", "roberta_confidence", "roberta_score",
    )


@query("models_agree", f"""{MERGED} SELECT "commentId", agree AS models_agree FROM merged""")
def models_agree(spark, sf):
    return compared(spark, sf).select("commentId", "models_agree")


@query("time_buckets", f"""{Q.with_(Q.COMMENTS)}
SELECT "commentId", CASE WHEN bad THEN NULL ELSE strftime("publishedAt", '%Y-%m') END AS month,
       CASE WHEN bad THEN NULL ELSE year("publishedAt") || 'Q' || quarter("publishedAt") END AS quarter
FROM (SELECT *, ord % 19 = 0 AS bad FROM comments)""")
def time_buckets(spark, sf):
    text = F.when(F.col("ord") % 19 == 0, "not a time").otherwise(C.to_zulu(F.col("publishedAt")))
    rows = V.comments(spark, sf, text=False).withColumn("publishedAt", text)
    return M.time_buckets(rows).select("commentId", "month", "quarter")


def shares_sql(keys: str) -> str:
    over = f"PARTITION BY {keys}" if keys else ""
    by = f"{keys}, sentiment" if keys else "sentiment"
    return f"""SELECT *, round(100.0 * count / sum(count) OVER ({over}), 2)::DOUBLE AS percentage FROM (
  SELECT {by}, count(*) AS count FROM bymodel GROUP BY {by})"""


@query("label_distribution", f"""{MERGED}
SELECT "gameLabel", sentiment, count, percentage, model FROM ({shares_sql('"gameLabel", model')}) WHERE model = 'VADER' """)
def label_distribution(spark, sf):
    return M.label_distribution(compared(spark, sf), "vader_label_final", "VADER", ["gameLabel"])


@query("overall_distribution", f"{MERGED} {shares_sql('model')}")
def overall_distribution(spark, sf):
    return M.overall_distribution(compared(spark, sf))


@query("game_distribution", f"""{MERGED} {shares_sql('"gameLabel", model')}""")
def game_distribution(spark, sf):
    return M.game_distribution(compared(spark, sf))


@query("label_order", f"""{MERGED}
SELECT "commentId", CASE roberta WHEN 'Positive' THEN 1 WHEN 'Neutral' THEN 2 END::BIGINT AS place FROM merged""")
def label_order(spark, sf):
    shown = F.when(F.col("roberta_label_final") == "Negative", "other").otherwise(F.col("roberta_label_final"))
    return compared(spark, sf).select("commentId", C.label_rank(shown).alias("place"))


@query("label_crosstab", f"""{MERGED}
SELECT l.label AS "VADER", {", ".join(f'''count(*) FILTER (roberta = '{x}') AS "{x}"''' for x in LABELS)}
FROM (VALUES ('Positive'), ('Neutral'), ('Negative')) AS l(label) LEFT JOIN merged ON vader = l.label GROUP BY ALL""")
def label_crosstab(spark, sf):
    return M.label_crosstab(compared(spark, sf))


@query("agreement_rate", f"""{MERGED}
SELECT coalesce("gameLabel", 'Overall') AS "gameLabel", count(*) AS total_comments, count(*) FILTER (agree) AS agreements,
       round(avg(agree::INT), 10) AS agreement_rate, round(100 * avg(agree::INT), 2) AS agreement_rate_pct
FROM merged GROUP BY ROLLUP ("gameLabel")""")
def agreement_rate(spark, sf):
    return M.agreement_rate(compared(spark, sf)).withColumn("agreement_rate", F.round("agreement_rate", 10))


@query("monthly_counts", f"{MERGED} SELECT month, sentiment, model, count(*) AS count FROM bymodel GROUP BY ALL")
def monthly_counts(spark, sf):
    return M.monthly_counts(compared(spark, sf))


@query("quarterly_counts", f"{MERGED} SELECT quarter, sentiment, model, count(*) AS count FROM bymodel GROUP BY ALL")
def quarterly_counts(spark, sf):
    return M.quarterly_counts(compared(spark, sf))


@query("trend_wide", f"""{MERGED}
SELECT model, strftime(date_trunc('quarter', "publishedAt"), '%Y-%m-%d') AS period,
       {", ".join(f'''count(*) FILTER (sentiment = '{x}') AS "{x}"''' for x in LABELS)} FROM bymodel GROUP BY ALL""")
def trend_wide(spark, sf):
    table = M.trend_wide(compared(spark, sf), "quarter")
    return table.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


@query("distribution_dense", f"""{MERGED}
SELECT g."gameLabel", g.model, l.label AS sentiment, coalesce(percentage, 0) AS percentage
FROM (SELECT DISTINCT "gameLabel", model FROM bymodel) g
JOIN (VALUES ('Positive'), ('Neutral'), ('Negative')) AS l(label) ON true
LEFT JOIN ({shares_sql('"gameLabel", model')}) s ON s."gameLabel" = g."gameLabel" AND s.model = g.model AND s.sentiment = l.label""")
def distribution_dense(spark, sf):
    return M.distribution_dense(game_distribution(spark, sf), ["gameLabel", "model"])


EXAMPLES = """
examples AS (
  SELECT "gameLabel", "videoTitle", 'VADER ' || vader || ' / RoBERTa ' || roberta AS disagreement_type, vader_compound,
         roberta_confidence, "textClean" FROM merged WHERE NOT agree
  ORDER BY abs(vader_compound) DESC, roberta_confidence DESC, "commentId", "gameLabel" LIMIT 20
)"""


@query("top_disagreements", f"{MERGED.rstrip()}, {EXAMPLES} SELECT * FROM examples")
def top_disagreements(spark, sf):
    return M.top_disagreements(compared(spark, sf))


@query("disagreement_types", f"""{MERGED.rstrip()}, {EXAMPLES}
SELECT disagreement_type, count(*) AS count FROM examples GROUP BY ALL ORDER BY count DESC, disagreement_type LIMIT 10""")
def disagreement_types(spark, sf):
    return M.disagreement_types(top_disagreements(spark, sf))
