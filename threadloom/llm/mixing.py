"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets: every source's share of all tokens by its weight, stopped at ``repeat`` times what the source has;
the excess is shared again by weight. Blocks: documents of a source are dealt to shards and laid end to end
in a seeded order; each shard is cut into blocks of (nearly) equal tokens, about ``BLOCK_WORDS`` whatever the
size of the table, so that their number grows with it. Quotas: the highest quotients votes / (2 * seats + 1)
give each source its number of words and, in the same way, each shard of a source its integer quota. Selection:
a shard takes all its blocks as often as its quota allows and the rest of the quota by a seeded choice of
blocks, of which the last is cut to the words left. So a source of a few words meets its target like a huge one.

A shard holds about ``shard_docs`` documents whatever the size of its source, so a source with a third of
all rows is spread over as many tasks as it needs. Tables of sources and shards stay distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions.ranking import numbered
from threadloom.llm.common import WORD, scratch
from threadloom.session import Scratch

WEIGHTS = (5, 2, 1)
REPEAT = 3
BLOCK_WORDS = 256  # fixed value: some paragraphs; a shorter shard is one block
SHARD_DOCS = 256
SEED = 42
PIECES = "array<struct<from:bigint,to:bigint>>"


def word_count(text: str):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def water_level(sources: DataFrame, repeat: int) -> float:
    """The level L for which sum(min(repeat * size, L * weight)) equals the sum of sizes.

    One aggregation per round. A source that is full at some level stays full, as levels only rise; so there
    are at most as many rounds as distinct ratios of size to weight, in practice a handful.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while total:
        most = repeat * F.col("source_size")
        is_full = most <= F.lit(level) * F.col("weight")
        row = sources.agg(
            F.count_if(is_full).alias("full"), F.sum(F.when(is_full, most).otherwise(0)).alias("held"),
            F.sum(F.when(is_full, 0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if row["full"] == full or not row["free"]:
            break
        full, level = row["full"], (total - row["held"]) / row["free"]
    return level


def apportion(cells: DataFrame, group: list[str], store: Scratch, name: str) -> DataFrame:
    """``seats``: the highest quotients votes / (2 k + 1) of each group take its ``quota`` seats.

    ``cells`` has the group columns, ``cell`` (unique in the group, breaks ties, smaller first), ``votes``,
    ``most`` (upper bound of its seats) and ``quota`` (equal within the group). Seats start from the quotient
    rule at the divisor votes per seat; the difference to the quota is then settled by ranking the next (or
    last) quotients. If all cells of a group are full, seats fall short of the quota.
    """
    total = cells.groupBy(*group).agg(F.sum("votes").alias("all_votes"))
    start = F.floor(F.try_divide(F.col("votes") * F.col("quota"), F.col("all_votes")) + 0.5)
    seats = F.least("most", F.coalesce(start, F.lit(0)).cast("bigint"))
    state = store.table(cells.join(total, group).withColumn("seats", seats).drop("all_votes"), name)
    while True:
        sums = state.groupBy(*group).agg(
            (F.max("quota") - F.sum("seats")).alias("lack"), F.count("*").alias("n"),
            F.sum(F.when(F.col("seats") < F.col("most"), F.col("votes")).otherwise(0)).alias("open_votes"),
            F.sum("votes").alias("all_votes"),
        ).filter("lack <> 0 and (lack < 0 or open_votes > 0)")
        if sums.isEmpty():
            return state
        open_rows = state.join(sums, group)
        # No cell gains or loses more than its share of the difference, and of one seat per cell by rounding.
        share = F.col("votes") / F.when(F.col("lack") > 0, F.col("open_votes")).otherwise(F.col("all_votes"))
        reach = (F.ceil(share * (F.abs("lack") + F.col("n"))) + 1).cast("bigint")
        room = F.when(F.col("lack") > 0, F.col("most") - F.col("seats")).otherwise(F.col("seats"))
        steps = F.when(F.least(reach, room) > 0, F.sequence(F.lit(1), F.least(reach, room).cast("int")))
        offers = open_rows.select(*group, "cell", "votes", "seats", "lack", F.explode(steps).alias("step"))
        up = F.col("lack") > 0
        quotient = F.col("votes") / (2 * F.col("seats") + F.when(up, 2 * F.col("step") - 1).otherwise(1 - 2 * F.col("step")))
        offers = offers.select(*group, "cell", "lack", F.when(up, -quotient).otherwise(quotient).alias("order"),
                               F.when(up, F.col("cell")).otherwise(-F.col("cell")).alias("tie"), "step")
        ranked = numbered(offers, group, ["order", "tie", "step"], store, f"{name}_rank")
        moved = ranked.filter(F.col(f"{name}_rank") < F.abs("lack")).groupBy(*group, "cell").agg(
            F.sum(F.signum("lack")).cast("bigint").alias("moved")
        )
        before = state
        state = store.table(
            state.join(moved, [*group, "cell"], "left")
            .withColumn("seats", F.col("seats") + F.coalesce("moved", F.lit(0))).drop("moved"), name,
        )
        store.release(before)


def choose(rows: pd.DataFrame, seed: int) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Whole passes and further word ranges for the documents of one shard, which are in their seeded order."""
    size = rows["_size"].to_numpy(np.int64)
    total, blocks, quota = int(size.sum()), int(rows["_blocks"].iloc[0]), int(rows["_quota"].iloc[0])  # quota: words
    passes = np.zeros(len(rows), np.int64)
    pieces: list[list[tuple[int, int]]] = [[] for _ in range(len(rows))]
    if not total or not quota:
        return passes, pieces
    passes[size > 0] = quota // total
    rest = quota % total
    if rest:
        shard = [seed, int(rows["_sid"].iloc[0]), int(rows["_shard"].iloc[0])]
        order = np.random.default_rng(shard).permutation(blocks)
        lows, highs = order * total // blocks, (order + 1) * total // blocks
        filled = np.cumsum(highs - lows)
        last = int(np.searchsorted(filled, rest))
        highs[last] -= filled[last] - rest
        ends = np.cumsum(size)
        starts = ends - size
        for low, high in sorted(zip(lows[: last + 1].tolist(), highs[: last + 1].tolist(), strict=True)):
            at = int(np.searchsorted(ends, low, "right"))
            while at < len(size) and starts[at] < high:
                if size[at]:
                    a, b = max(low, int(starts[at])) - int(starts[at]), min(high, int(ends[at])) - int(starts[at])
                    if pieces[at] and pieces[at][-1][1] == a:
                        pieces[at][-1] = (pieces[at][-1][0], b)
                    else:
                        pieces[at].append((a, b))
                at += 1
    return passes, pieces


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeat: int = REPEAT, blocks: int | None = None,
    shard_docs: int = SHARD_DOCS, seed: int = SEED, carry: tuple[str, ...] = (), store: Scratch | None = None,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, passes, pieces, and ``carry`` columns.

    ``size`` is the number of words (null or empty text: 0). Sources stand in code point order with null last
    and take the weights in turn. ``passes`` is how often the whole document is taken, ``pieces`` the word
    ranges [from, to) taken once more; ``taken`` counts the words of both and is at most ``repeat`` times the
    size. The words taken of a source are its target, rounded to a whole number. ``blocks`` cuts the table into
    about so many blocks in place of blocks of ``BLOCK_WORDS`` words. Every input row is a document of its own, also where doc_id is null or repeated; equal rows are
    interchangeable. The choice depends on the rows, ``seed`` and the parameters only, not on partitions.
    Documents without words, and all documents of a table without words, take 0.
    """
    store = store or scratch(docs.sparkSession, "mix")
    size = word_count("text")
    sized = docs.select("doc_id", "source", size.alias("_size"))
    sources = sized.groupBy("source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("docs"))
    sources = store.table(sources.withColumn("g", F.lit(0)), "sources")
    sources = numbered(sources, ["g"], [F.asc_nulls_last("source")], store, "sid")
    turn = F.array(*[F.lit(w) for w in weights])
    sources = store.table(sources.withColumn(
        "weight", F.element_at(turn, (F.col("sid") % len(weights) + 1).cast("int"))
    ), "weighted")
    level = water_level(sources, repeat)
    target = F.least(repeat * F.col("source_size").cast("double"), F.lit(level) * F.col("weight"))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    each = max(1.0, total / blocks) if blocks else float(BLOCK_WORDS)
    sources = sources.select(
        "source", "sid", "source_size", target.alias("target"),
        F.ceil(F.col("docs") / F.lit(shard_docs)).cast("bigint").alias("_shards"), "g",
    )

    kept = [F.col(c).alias(f"_c_{c}") for c in carry]
    rows = docs.select("doc_id", F.col("source").alias("_source"), size.alias("_size"), *kept)
    shard = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("_shards"))
    named = sources.select("source", F.col("sid").alias("_sid"), "source_size", "target", "_shards")
    dealt = rows.join(named, F.col("_source").eqNullSafe(F.col("source"))).withColumn("_shard", shard)

    cells = dealt.groupBy("_sid", "_shard").agg(F.sum("_size").alias("tokens")).withColumn(
        "blocks", F.when(F.col("tokens") > 0, F.greatest(F.lit(1), F.round(F.col("tokens") / each))).otherwise(0).cast("bigint")
    )
    cells = store.table(cells, "cells")
    # A seat is a word: a quota in blocks would round small sources to nothing.
    quotas = apportion(
        sources.select("g", F.col("sid").alias("cell"), F.col("target").alias("votes"),
                       (repeat * F.col("source_size")).alias("most"), F.lit(total).cast("bigint").alias("quota")),
        ["g"], store, "quota",
    )
    shares = cells.join(quotas.select(F.col("cell").alias("_sid"), F.col("seats").alias("quota")), "_sid")
    shares = apportion(
        shares.select("_sid", F.col("_shard").alias("cell"), F.col("tokens").cast("double").alias("votes"),
                      (repeat * F.col("tokens")).alias("most"), "quota"), ["_sid"], store, "share",
    )
    plan = shares.select("_sid", F.col("cell").alias("_shard"), F.col("seats").alias("_quota")).join(
        cells.select("_sid", "_shard", F.col("blocks").alias("_blocks")), ["_sid", "_shard"]
    )
    ready = dealt.join(plan, ["_sid", "_shard"]).withColumn("_order", F.xxhash64(F.lit(seed + 1), "doc_id"))

    fields = [docs.schema["doc_id"], T.StructField("size", T.LongType()), T.StructField("source_size", T.LongType()),
              T.StructField("target", T.DoubleType()), T.StructField("taken", T.LongType()),
              T.StructField("passes", T.LongType()), T.StructField("pieces", T._parse_datatype_string(PIECES))]
    fields += [T.StructField(f"_c_{c}", docs.schema[c].dataType) for c in carry]
    names = [f.name for f in fields]

    def pick(frames: Iterator[pd.DataFrame] | pd.DataFrame) -> pd.DataFrame:
        group = frames.sort_values(["_order", "doc_id", "_size"], kind="stable").reset_index(drop=True)
        passes, pieces = choose(group, seed)
        extra = np.array([sum(b - a for a, b in p) for p in pieces], np.int64)
        group["size"] = group["_size"]
        group["passes"], group["taken"] = passes, passes * group["_size"].to_numpy(np.int64) + extra
        group["pieces"] = [[{"from": a, "to": b} for a, b in p] for p in pieces]
        return group[names]

    return ready.groupBy("_sid", "_shard").applyInPandas(pick, T.StructType(fields))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, in the columns of ``docs``: one row per whole pass, one more for all pieces.

    The words of the pieces are joined by single spaces; ``n_chars``, where it exists, follows the new text.
    Documents of which nothing is taken do not appear.
    """
    columns = docs.columns
    carry = tuple(c for c in columns if c != "doc_id")
    mixed = mix(docs, carry=carry, **options)
    words = F.filter(F.split("_c_text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.array_join(F.flatten(F.transform(
        "pieces", lambda p: F.slice(F.col("_words"), (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int"))
    )), " ")
    part = F.when(F.size("pieces") > 0, F.array(cut)).otherwise(F.array().cast("array<string>"))
    texts = F.concat(F.array_repeat(F.col("_c_text"), F.col("passes").cast("int")), part)
    rows = mixed.filter("taken > 0").withColumn("_words", words).withColumn("_text", F.explode(texts))
    out = {c: F.col("doc_id" if c == "doc_id" else f"_c_{c}") for c in columns} | {"text": F.col("_text")}
    if "n_chars" in columns:
        out["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[out[c].alias(c) for c in columns])
