"""Top rows per group without ever gathering a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import Scratch

# Up to this rank the optimizer itself keeps only the first rows of each group before the exchange
# (the default of spark.sql.optimizer.windowGroupLimitThreshold).
PRELIMIT = 1000


def sort_key(name: str | Column) -> Column:
    """A column, ascending with nulls first; ``-name``: descending with nulls last."""
    if not isinstance(name, str):
        return name
    return F.desc_nulls_last(name[1:]) if name.startswith("-") else F.asc_nulls_first(name)


def first_n(df: DataFrame, keys: list, order: list, n: int | None, scratch=None) -> DataFrame:
    """The first ``n`` rows of each group; ``None`` keeps all. ``order``: names, ``-name`` for descending.

    Beyond ``PRELIMIT`` no group is brought together: the order's columns alone are sorted over all partitions and
    counted, which gives each large group's n-th place, and a filter keeps what does not come after it. Rows with equal
    places are told apart by all their columns; of equal rows as many stay as there is room for.
    """
    if n is None:
        return df
    if n <= PRELIMIT:
        window = Window.partitionBy(*keys).orderBy(*map(sort_key, order))
        return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")
    if n <= 0:
        return df.limit(0)
    scratch = scratch or Scratch(df.sparkSession, "places")
    names, columns = [name.lstrip("-") for name in order], df.columns
    rows = df.withColumn("_tie", F.xxhash64(*columns))
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_size")).filter(F.col("_size") > n)
    sizes = scratch.table(sizes.select(F.struct(*keys).alias("_big")), "large")
    narrow = rows.select(F.struct(*keys).alias("_group"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(names)], "_tie")
    narrow = narrow.join(sizes, F.col("_group").eqNullSafe(F.col("_big")), "left_semi")
    place = [f"-_{i}" if name.startswith("-") else f"_{i}" for i, name in enumerate(order)]
    placed = numbered(narrow, ["_group"], [*map(sort_key, place), "_tie"], scratch, "_place")
    last = placed.filter(F.col("_place") == n - 1).select(
        F.col("_group").alias("_g"), *[F.col(f"_{i}").alias(f"_last{i}") for i in range(len(order))], F.col("_tie").alias("_last"))
    last = scratch.table(last, "last")

    before, same = F.col("_tie") < F.col("_last"), F.col("_tie") == F.col("_last")
    for i in reversed(range(len(order))):
        here, there = F.col(names[i]), F.col(f"_last{i}")
        if order[i].startswith("-"):
            ahead = F.coalesce(here > there, here.isNotNull() & there.isNull())
        else:
            ahead = F.coalesce(here < there, here.isNull() & there.isNotNull())
        equal = here.eqNullSafe(there)
        before, same = ahead | (equal & before), equal & same
    joined = rows.join(last, F.struct(*keys).eqNullSafe(F.col("_g")), "left")
    kept = joined.filter(F.col("_g").isNull() | before).select(*columns)
    # Rows at the n-th place itself: the equal ones are counted, and as many as there is room for come back.
    at = joined.filter(F.col("_g").isNotNull() & same).groupBy(*columns).agg(F.first("_g").alias("_g"), F.first("_last").alias("_t"))
    room = placed.groupBy("_group", *[f"_{i}" for i in range(len(order))], "_tie").agg(
        F.min("_place").alias("_from"), F.max("_place").alias("_to")).filter(f"_from < {n} and _to >= {n - 1}")
    room = room.select(F.col("_group").alias("_g2"), (F.lit(n) - F.col("_from")).alias("_room"))
    back = at.join(room, F.col("_g").eqNullSafe(F.col("_g2"))).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_room").cast("int"))))
    return kept.unionByName(back.select(*columns))


def ranked_first_n(df: DataFrame, keys: list, order: list, n: int, rank: str) -> DataFrame:
    """As ``first_n``, with the rank kept; for the small ``n`` of report tables."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def joined_names(rank: str, value: str) -> Column:
    """Aggregate: the values of an already limited group, by rank, separated by a comma."""
    rows = F.array_sort(F.collect_list(F.struct(rank, value)))
    return F.array_join(F.transform(rows, lambda r: r[value]), ", ")


def numbered(df: DataFrame, group: list[str], order: list, scratch, name: str) -> DataFrame:
    """``name``: 0, 1, 2, ... within each group, for groups of any size.

    Rows are sorted across all partitions; a row's place is its partition's offset plus its place in the
    partition. The offsets are one number per partition.
    """
    placed = scratch.table(df.orderBy(*group, *order).withColumn("_m", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_m", 33)
    counts = placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["p"], total))
        total += row["n"]
    table = df.sparkSession.createDataFrame(offsets, "_p bigint, _offset bigint")
    indexed = placed.join(F.broadcast(table), part == F.col("_p")).withColumn(
        "_index", F.col("_offset") + F.col("_m") - F.shiftleft(F.col("_p"), 33)
    )
    first = indexed.groupBy(*group).agg(F.min("_index").alias("_first"))
    return indexed.join(first, group).withColumn(name, F.col("_index") - F.col("_first")).drop(
        "_m", "_p", "_offset", "_index", "_first"
    )
