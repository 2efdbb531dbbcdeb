"""Samples that show the structure of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.ranking import first_n, sort_key

NOTE = "Shortened sample: it shows the structure, not the full data."


def head_rows(df: DataFrame, order: list, n: int = 100) -> DataFrame:
    return df.orderBy(*map(sort_key, order)).limit(n)


def head_per_group(df: DataFrame, n: int = 50, key: str = "gameLabel", order: str = "ord") -> DataFrame:
    """First ``n`` rows per group in table order; without the key column the first ``2 n`` rows."""
    if key not in df.columns:
        return head_rows(df, [order], 2 * n)
    return first_n(df.filter(F.col(key).isNotNull()), [key], [order], n)


def top_edges_per_group(edges: DataFrame, n: int = 75, key: str = "gameLabel") -> DataFrame:
    order = ["-weight", "source", "target"]
    if key not in edges.columns:
        return head_rows(edges, order, 2 * n)
    return first_n(edges.filter(F.col(key).isNotNull()), [key], order, n)


def truncate_nested(docs: DataFrame, videos: int = 1, comments: int = 50) -> DataFrame:
    cut = F.transform(
        F.slice("videos", 1, videos),
        lambda v: v.withField("sample_note", F.lit(NOTE)).withField(
            "comments", F.slice(F.coalesce(v["comments"], F.array()), 1, comments)
        ),
    )
    return docs.withColumns({"videos": F.coalesce(cut, F.array()), "sample_note": F.lit(NOTE)})
