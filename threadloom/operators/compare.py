"""Two models over the same comments: agreement, shares, trends, disagreements."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import columns as C
from threadloom.labels import LABELS, MODELS, OVERALL
from threadloom.sources.tables import require_columns

LEFT = ["gameLabel", "videoId", "videoTitle", "authorChannelId", "publishedAt", "textClean",
        "vader_compound", "vader_label"]
RIGHT = ["roberta_label", "roberta_confidence"]


def join_models(lexicon: DataFrame, classifier: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Inner join on the comment id (or on game and comment id)."""
    key = key or ["commentId"]
    scores = ["sentiment_label", "sentiment_score"]
    require_columns(lexicon, [*key, *LEFT, *scores], "lexicon output")
    require_columns(classifier, [*key, *RIGHT, *scores], "classifier output")
    left = lexicon.select(
        *key, *[c for c in LEFT if c not in key],
        F.col("sentiment_label").alias("vader_label_final"), F.col("sentiment_score").alias("vader_score"),
    )
    right = classifier.select(
        *key, *RIGHT,
        F.col("sentiment_label").alias("roberta_label_final"), F.col("sentiment_score").alias("roberta_score"),
    )
    return left.join(right, key)


def models_agree(df: DataFrame) -> DataFrame:
    same = F.col("vader_label_final") == F.col("roberta_label_final")
    return df.withColumn("models_agree", F.coalesce(same, F.lit(False)))


def time_buckets(df: DataFrame) -> DataFrame:
    if dict(df.dtypes)["publishedAt"] == "string":
        df = df.withColumn("publishedAt", C.parse_utc(F.col("publishedAt")))
    ts = F.col("publishedAt")
    return df.withColumns({"month": C.month_of(ts), "quarter": C.quarter_of(ts)})


def compare(lexicon: DataFrame, classifier: DataFrame, key: list[str] | None = None) -> DataFrame:
    return time_buckets(models_agree(join_models(lexicon, classifier, key)))


def by_model(df: DataFrame) -> DataFrame:
    """One row per comment and model, so that both models are counted in one scan."""
    pair = F.array(
        F.struct(F.lit(MODELS[0]).alias("model"), F.col("vader_label_final").alias("sentiment")),
        F.struct(F.lit(MODELS[1]).alias("model"), F.col("roberta_label_final").alias("sentiment")),
    )
    return df.select("*", F.inline(pair)).filter(F.col("sentiment").isNotNull())


def label_distribution(df: DataFrame, label: str, model: str, keys: list[str] | None = None) -> DataFrame:
    rows = df.withColumn("model", F.lit(model)).withColumnRenamed(label, "sentiment")
    return _shares(rows.dropna(subset=["sentiment"]), keys or [])


def _shares(rows: DataFrame, keys: list[str]) -> DataFrame:
    counts = rows.dropna(subset=keys).groupBy(*keys, "model", "sentiment").agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(*keys, "model"))
    return counts.withColumn("percentage", C.percent(F.col("count"), total))


def ordered(df: DataFrame, before: list[str]) -> DataFrame:
    return df.orderBy(*before, C.label_rank(F.col("sentiment")).asc_nulls_last(), "sentiment")


def overall_distribution(df: DataFrame) -> DataFrame:
    return _shares(by_model(df), []).withColumn("sentiment", C.known_label(F.col("sentiment")))


def game_distribution(df: DataFrame) -> DataFrame:
    return _shares(by_model(df), ["gameLabel"]).withColumn("sentiment", C.known_label(F.col("sentiment")))


def label_crosstab(df: DataFrame) -> DataFrame:
    """All label pairs, also those that do not occur."""
    counts = df.groupBy(F.col("vader_label_final").alias("VADER")).agg(
        *[F.count_if(F.col("roberta_label_final") == x).alias(x) for x in LABELS]
    )
    rows = df.sparkSession.createDataFrame([(x,) for x in LABELS], "VADER string")
    return rows.join(counts, "VADER", "left").na.fill(0)


def agreement_rate(df: DataFrame) -> DataFrame:
    """Per game, with an overall row that also counts rows without a game."""
    agree = F.col("models_agree")
    table = df.rollup("gameLabel").agg(
        F.grouping("gameLabel").alias("_all"),
        F.count("*").alias("total_comments"),
        F.count_if(agree).alias("agreements"),
    )
    rate = F.col("agreements") / F.col("total_comments")
    return (
        table.filter((F.col("_all") == 1) | F.col("gameLabel").isNotNull())
        .withColumn("gameLabel", F.when(F.col("_all") == 1, OVERALL).otherwise(F.col("gameLabel")))
        .drop("_all")
        .withColumns({"agreement_rate": rate, "agreement_rate_pct": F.round(rate * 100, 2)})
    )


def _period_counts(df: DataFrame, period: str) -> DataFrame:
    rows = by_model(df.filter(F.col("publishedAt").isNotNull()))
    counts = rows.groupBy(period, "sentiment", "model").agg(F.count("*").alias("count"))
    return counts.withColumn("sentiment", C.known_label(F.col("sentiment")))


def monthly_counts(df: DataFrame) -> DataFrame:
    return _period_counts(df, "month")


def quarterly_counts(df: DataFrame) -> DataFrame:
    return _period_counts(df, "quarter")


def trend_wide(df: DataFrame, unit: str = "month") -> DataFrame:
    """Period by label, per model, the period as its first day."""
    rows = by_model(df.filter(F.col("publishedAt").isNotNull()))
    start = C.period_start(F.col("publishedAt"), unit).alias("period")
    return rows.groupBy("model", start).agg(
        *[F.count_if(F.col("sentiment") == x).alias(x) for x in LABELS]
    )


def distribution_dense(table: DataFrame, keys: list[str]) -> DataFrame:
    """All three labels for every model (and game); a missing one has 0 percent."""
    groups = table.select(*keys).distinct()
    grid = groups.withColumn("sentiment", F.explode(F.array(*[F.lit(x) for x in LABELS])))
    filled = grid.join(table.select(*keys, "sentiment", "percentage"), [*keys, "sentiment"], "left")
    return filled.withColumn("percentage", F.coalesce("percentage", F.lit(0.0)))


def top_disagreements(df: DataFrame, n: int = 20) -> DataFrame:
    kind = F.concat(F.lit(f"{MODELS[0]} "), "vader_label_final", F.lit(f" / {MODELS[1]} "), "roberta_label_final")
    return (
        df.filter(~F.col("models_agree"))
        .withColumn("disagreement_type", kind)
        .orderBy(F.desc(F.abs("vader_compound")), F.desc("roberta_confidence"), "commentId", "gameLabel")
        .limit(n)
        .select("gameLabel", "videoTitle", "disagreement_type", "vader_compound", "roberta_confidence", "textClean")
    )


def disagreement_types(examples: DataFrame, n: int = 10) -> DataFrame:
    counts = examples.dropna(subset=["disagreement_type"]).groupBy("disagreement_type")
    return counts.agg(F.count("*").alias("count")).orderBy(F.desc("count"), "disagreement_type").limit(n)
