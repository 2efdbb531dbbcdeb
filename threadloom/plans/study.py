"""The stages in order: dumps to tables for one scoring method, then the comparison of two methods.

Tables between the stages are parquet; every stage reads what the one before has written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators import cache as S
from threadloom.operators import combined as B
from threadloom.operators import communities as K
from threadloom.operators import compare as M
from threadloom.operators import distribution as D
from threadloom.operators import graph as G
from threadloom.operators import paths as W
from threadloom.operators import preprocess as P
from threadloom.operators import sample as U
from threadloom.operators import sentiment as T
from threadloom.schemas import CLASSIFIER_SCORES, LEXICON_SCORES
from threadloom.session import Scratch, configure
from threadloom.sources import tables as IO


def preprocess(spark: SparkSession, dumps: list[str], out: str, one_per_line: bool = False) -> None:
    """Clean comments, reply edges and the summary."""
    docs = P.number_documents(IO.raw_variant_scan(spark, dumps, one_per_line), Scratch(spark, "dumps"))
    flat = P.conform_schema(P.flatten_comments(docs), keep=["ord"])
    cleaned = Scratch(spark, "cleaned").table(P.clean_comments(flat), "comments")
    IO.table_sink(P.dedupe_comments(P.drop_empty_text(cleaned)), f"{out}/comments_clean")
    comments = spark.read.parquet(f"{out}/comments_clean")
    IO.table_sink(P.reply_edges(comments), f"{out}/edges")
    games = docs.select(F.col("gameLabel").alias("game"))
    IO.table_sink(P.preprocess_summary(cleaned, games=games), f"{out}/tables/preprocessing_summary")


def score(
    spark: SparkSession, out: str, method: str, cache: str, make_predict_fn: Callable | None = None,
    lexicon=None, batches: int = 1, batch_size: int = T.BATCH_SIZE, max_length: int = T.MAX_LENGTH,
) -> None:
    """Scores through the cache, sentiment by game and by video. Without a model the lexicon scores."""
    comments = IO.table_scan(spark, f"{out}/comments_clean", ["commentId", "textClean", "gameLabel"])
    if make_predict_fn is None:
        outputs, scorer = LEXICON_SCORES, lambda rows: T.lexicon_sentiment(rows, lexicon)
    else:
        outputs, scorer = CLASSIFIER_SCORES, lambda rows: T.batch_classifier(
            rows, make_predict_fn, batch_size=batch_size, max_length=max_length)
    scored = S.score_with_cache(comments, scorer, cache, outputs, batches)
    IO.table_sink(scored, f"{out}/{method}/comments_scored")
    scored = spark.read.parquet(f"{out}/{method}/comments_scored")
    by_video = D.sentiment_distribution(scored, ["gameLabel", "videoId", "videoTitle"])
    IO.table_sink(D.sentiment_distribution(scored, ["gameLabel"]), f"{out}/{method}/tables/sentiment_summary")
    IO.table_sink(by_video, f"{out}/{method}/tables/sentiment_by_video")
    IO.table_sink(D.top_videos(by_video), f"{out}/{method}/tables/top_videos")


def network(spark: SparkSession, out: str, method: str) -> None:
    """Network tables and the comments enriched with them."""
    edges = IO.table_scan(spark, f"{out}/edges", ["gameLabel", "source", "target", "weight"])
    comments = IO.table_scan(spark, f"{out}/{method}/comments_scored", ["gameLabel", "authorChannelId"])
    graph = G.build_graph(edges)
    components, partition = W.connected_components(graph), K.communities(graph)
    partition = graph.scratch.table(partition, "communities")
    central = G.centrality_table(graph, partition, W.pagerank(graph), W.betweenness(graph))
    tables = f"{out}/{method}/tables"
    IO.table_sink(G.centrality_group(central, graph.games), f"{tables}/centrality_by_user")
    central = spark.read.parquet(f"{tables}/centrality_by_user")
    IO.table_sink(G.network_summary(graph, components, partition), f"{tables}/network_summary")
    sizes = G.community_sizes(graph, partition)
    IO.table_sink(sizes, f"{tables}/network_community_sizes")
    IO.table_sink(D.top_groups(sizes, "game", "users", "community_id", 10), f"{tables}/top_network_communities")
    IO.table_sink(G.network_enrich(comments, central), f"{out}/{method}/comments_with_network")
    IO.write_graph(edges, f"{out}/{method}/graph")


def combine(spark: SparkSession, out: str, method: str, stop_words: list[str] | None = None) -> None:
    comments = spark.read.parquet(f"{out}/{method}/comments_with_network")
    tables = f"{out}/{method}/tables"
    IO.table_sink(B.community_summary(comments, stop_words), f"{tables}/community_summary")
    summary = spark.read.parquet(f"{tables}/community_summary")
    IO.table_sink(B.top_communities_by_users(summary), f"{tables}/top_communities")
    IO.table_sink(D.sentiment_by_centrality(comments), f"{tables}/sentiment_by_centrality_group")
    IO.table_sink(D.comment_volume(comments), f"{tables}/comment_volume")


def analyse(
    spark: SparkSession, dumps: list[str], out: str, method: str = "vader", cache: str | None = None,
    make_predict_fn: Callable | None = None, lexicon=None, stop_words: list[str] | None = None,
    one_per_line: bool = False,
) -> None:
    """All stages for one method."""
    configure(spark)
    preprocess(spark, dumps, out, one_per_line)
    score(spark, out, method, cache or f"{out}/cache/{method}", make_predict_fn, lexicon)
    network(spark, out, method)
    combine(spark, out, method, stop_words)


def compare_methods(spark: SparkSession, out: str, lexicon: str = "vader", classifier: str = "roberta") -> None:
    """All comparison tables from the results of two methods."""
    configure(spark)
    left = spark.read.parquet(f"{out}/{lexicon}/comments_with_network")
    right = spark.read.parquet(f"{out}/{classifier}/comments_with_network")
    base = f"{out}/sentiment_comparison"
    IO.table_sink(M.compare(left, right), f"{base}/merged_comment_labels")
    merged = spark.read.parquet(f"{base}/merged_comment_labels")
    by_game = M.game_distribution(merged)
    examples = M.top_disagreements(merged)
    results: dict[str, DataFrame] = {
        "overall_sentiment_distribution_by_model": M.ordered(M.overall_distribution(merged), ["model"]),
        "sentiment_distribution_by_game_and_model": M.ordered(by_game, ["gameLabel", "model"]),
        "sentiment_distribution_by_game_and_model_dense": M.distribution_dense(by_game, ["gameLabel", "model"]),
        "label_crosstab": M.label_crosstab(merged),
        "model_agreement_by_game": M.agreement_rate(merged),
        "monthly_sentiment_counts_by_model": M.ordered(M.monthly_counts(merged), ["model", "month"]),
        "quarterly_sentiment_counts_by_model": M.ordered(M.quarterly_counts(merged), ["model", "quarter"]),
        "monthly_trend": M.trend_wide(merged, "month"),
        "quarterly_trend": M.trend_wide(merged, "quarter"),
        "strongest_model_disagreements": examples,
        "disagreement_types": M.disagreement_types(examples),
    }
    for name, table in results.items():
        IO.table_sink(table, f"{base}/{name}")


def sample_package(spark: SparkSession, dumps: list[str], out: str, target: str, methods: list[str]) -> None:
    """Short versions of the dumps, comments and edges."""
    configure(spark)
    U.truncate_nested(IO.raw_json_scan(spark, dumps)).write.mode("overwrite").json(f"{target}/raw")
    IO.table_sink(U.top_edges_per_group(spark.read.parquet(f"{out}/edges")), f"{target}/edges", "csv")
    for method in methods:
        for name in ("comments_scored", "comments_with_network"):
            rows = U.head_per_group(spark.read.parquet(f"{out}/{method}/{name}"))
            IO.table_sink(rows, f"{target}/{method}/{name}", "csv")
