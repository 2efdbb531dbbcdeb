"""Degree quantiles and distinct users from mergeable sketches, for tables that grow run by run.

A run keeps one small binary per game or community; sketches of several runs merge into that of all their rows,
without reading the rows again. The exact measures stay the default; these are estimates with known errors:
ranks of a quantile are off by less than ``RANK_ERROR`` and counts of distinct users by less than ``COUNT_ERROR``
with 99 % confidence (published bounds of KLL sketches with k = 400 and HyperLogLog with 2^14 registers).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.labels import HIGH, PERIPHERAL

KLL_K = 400
RANK_ERROR = 0.01
HLL_BITS = 14
COUNT_ERROR = 0.021  # 2.58 standard errors of 1.04 / sqrt(2^14)
CENTRAL_SHARE = 0.9


def degree_sketches(centrality: DataFrame) -> DataFrame:
    """(game, sketch) of the weighted degrees."""
    return centrality.groupBy("game").agg(F.kll_sketch_agg_bigint("weighted_degree", KLL_K).alias("sketch"))


def user_sketches(comments: DataFrame, group: list[str]) -> DataFrame:
    """(group, sketch) of the distinct authors; comments without an author do not count."""
    known = comments.groupBy(*group).agg(F.hll_sketch_agg("authorChannelId", F.lit(HLL_BITS)).alias("sketch"))
    return known


def merged_degrees(runs: list[DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, runs)
    return rows.groupBy("game").agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))


def merged_users(runs: list[DataFrame], group: list[str]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, runs)
    return rows.groupBy(*group).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_users(sketches: DataFrame, group: list[str]) -> DataFrame:
    return sketches.select(*group, F.hll_sketch_estimate("sketch").alias("users"))


def degree_quantile(sketch: Column, share: float) -> Column:
    """A degree whose rank is about ``share``."""
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(share))


def estimated_centrality_group(centrality: DataFrame, sketches: DataFrame, share: float = CENTRAL_SHARE) -> DataFrame:
    """As the exact group, with the bound of the game's sketch, which may cover earlier runs as well."""
    bounds = sketches.select("game", degree_quantile(F.col("sketch"), share).alias("_bound"))
    group = F.when(F.col("weighted_degree") >= F.col("_bound"), HIGH).otherwise(PERIPHERAL)
    return centrality.join(bounds, "game").withColumn("centrality_group", group).drop("_bound")
