"""The reply network as tables, and its direct (loop-free) measures.

All games are worked on at once. Vertices get a long number in (game, node) order, so that the loops move
and compare single longs, and a smaller number means a smaller name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.ranking import first_n
from threadloom.labels import HIGH, PERIPHERAL
from threadloom.session import Scratch

BROADCAST_GAMES = 100_000  # per-game tables up to this many rows are sent to all executors
HUB_ROWS = 200_000  # a vertex with more arcs is cut into slices of about this size
BROADCAST_HUBS = 500_000  # so many rows of (vertex, slices) are sent to all executors; more are joined by hash
BLOCK = 2_000  # links of one vertex that meet as many others of it in one join key
ROWS_PER_PARTITION = 2_000_000


@dataclass
class ReplyGraph:
    vertices: DataFrame  # vid, game, node
    arcs: DataFrame  # src, dst, weight: directed
    links: DataFrame  # u < v, weight: undirected
    games: int
    scratch: Scratch

    def per_game(self, df: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
        """Join a table with one row per game; broadcast only when the number of games allows it."""
        return df.join(F.broadcast(table) if self.games <= BROADCAST_GAMES else table, "game", how)

    def both_ways(self) -> DataFrame:
        ends = F.array(
            F.struct(F.col("u").alias("src"), F.col("v").alias("dst")),
            F.struct(F.col("v").alias("src"), F.col("u").alias("dst")),
        )
        return self.links.select(F.inline(ends), "weight")

    def named(self, df: DataFrame, vid: str = "vid") -> DataFrame:
        """Replace the vertex number by game and node."""
        return df.join(self.vertices.withColumnRenamed("vid", vid), vid).drop(vid)


def graph_vertices(edges: DataFrame) -> DataFrame:
    """Every end of an edge; rows without a game belong to no graph."""
    kept = edges.filter(F.col("gameLabel").isNotNull())
    ends = kept.select(F.col("gameLabel").alias("game"), F.explode(F.array("source", "target")).alias("node"))
    return ends.distinct()


def build_graph(edges: DataFrame, scratch: Scratch | None = None, policy: str = "last") -> ReplyGraph:
    scratch = scratch or Scratch(edges.sparkSession, "graph")
    vertices = scratch.table(
        graph_vertices(edges).orderBy("game", "node").withColumn("vid", F.monotonically_increasing_id())
        .select("vid", "game", "node"),
        "vertices",
    )
    source = vertices.select(F.col("vid").alias("src"), F.col("game").alias("gameLabel"), F.col("node").alias("source"))
    target = vertices.select(F.col("vid").alias("dst"), F.col("game").alias("gameLabel"), F.col("node").alias("target"))
    arcs = scratch.table(
        edges.join(source, ["gameLabel", "source"]).join(target, ["gameLabel", "target"])
        .select("src", "dst", F.col("weight").cast("bigint").alias("weight")),
        "arcs",
    )
    links = scratch.table(undirected_edges(arcs, policy), "links")
    games = vertices.select("game").distinct().count()
    return ReplyGraph(vertices, arcs, links, games, scratch)


def undirected_edges(arcs: DataFrame, policy: str = "last") -> DataFrame:
    """One link per pair of vertices.

    ``sum`` adds the weights of both directions. ``last`` takes one of them: arcs are listed by weight
    descending, source, target, vertices by first appearance in that list, and the arc that starts at the
    later vertex gives the weight.
    """
    forward = F.col("src") < F.col("dst")
    pairs = arcs.groupBy(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).agg(
        F.sum(F.when(forward, F.col("weight"))).alias("up"), F.sum(F.when(~forward, F.col("weight"))).alias("down")
    )
    if policy == "sum":
        return pairs.select("u", "v", (F.coalesce("up", F.lit(0)) + F.coalesce("down", F.lit(0))).alias("weight"))
    one_way = F.col("up").isNull() | F.col("down").isNull()
    single = pairs.filter(one_way).select("u", "v", F.coalesce("up", "down").alias("weight"))
    mutual = pairs.filter(~one_way)
    place = F.struct(-F.col("weight"), F.col("src"), F.col("dst"))
    first = arcs.select(
        F.inline(F.array(
            F.struct(F.col("src").alias("vid"), F.struct(place, F.lit(0)).alias("place")),
            F.struct(F.col("dst").alias("vid"), F.struct(place, F.lit(1)).alias("place")),
        ))
    )
    members = mutual.select(F.explode(F.array("u", "v")).alias("vid")).distinct()
    first = first.join(members, "vid", "left_semi").groupBy("vid").agg(F.min("place").alias("place"))
    at_u = first.select(F.col("vid").alias("u"), F.col("place").alias("place_u"))
    at_v = first.select(F.col("vid").alias("v"), F.col("place").alias("place_v"))
    weight = F.when(F.col("place_u") > F.col("place_v"), F.col("up")).otherwise(F.col("down"))
    return single.union(mutual.join(at_u, "u").join(at_v, "v").select("u", "v", weight.alias("weight")))


class Adjacency:
    """Arcs laid out by their start for repeated expansion, hubs cut into slices.

    A row that meets a hub is copied once per slice, so no task holds all arcs of one vertex. The layout is
    cached (and spills to disk); lost parts are rebuilt from the written tables.
    """

    def __init__(self, arcs: DataFrame, scratch: Scratch, hub_rows: int = HUB_ROWS):
        self.total = total = arcs.count()
        self.hubs = None
        if total > hub_rows:
            degree = arcs.groupBy("src").agg(F.count("*").alias("n")).filter(F.col("n") > hub_rows)
            slices = F.ceil(F.col("n") / hub_rows).cast("int").alias("slices")
            hubs, seen = scratch.measured(degree.select("src", slices), "hubs", n=F.count(F.lit(1)))
            if seen["n"]:
                self.hubs = F.broadcast(hubs) if seen["n"] <= BROADCAST_HUBS else hubs
        self.keys = ["src"]
        if self.hubs is not None:
            self.keys = ["src", "slice"]
            slices = F.coalesce("slices", F.lit(1))
            arcs = arcs.join(self.hubs, "src", "left").withColumn("slice", F.pmod(F.xxhash64("dst"), slices).cast("int"))
            arcs = arcs.drop("slices")
        usual = int(arcs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = max(1, min(usual, total // 20_000), total // ROWS_PER_PARTITION)
        self.parts = parts
        self.arcs = arcs.repartition(parts, *self.keys).persist(StorageLevel.MEMORY_AND_DISK)

    def expand(self, rows: DataFrame) -> DataFrame:
        """Rows (with ``src``) next to every arc that starts there."""
        if self.hubs is not None:
            slices = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
            rows = rows.join(self.hubs, "src", "left").withColumn("slice", F.explode(slices)).drop("slices")
        return rows.join(self.arcs, self.keys)

    def close(self) -> None:
        self.arcs.unpersist()


# --- degrees ------------------------------------------------------------------------------------


def weighted_degrees(graph: ReplyGraph) -> DataFrame:
    """Weighted in-, out- and total degree."""
    zero = F.lit(0).cast("bigint")
    ends = F.array(
        F.struct(F.col("src").alias("vid"), zero.alias("i"), F.col("weight").alias("o")),
        F.struct(F.col("dst").alias("vid"), F.col("weight").alias("i"), zero.alias("o")),
    )
    return graph.arcs.select(F.inline(ends)).groupBy("vid").agg(
        (F.sum("i") + F.sum("o")).alias("weighted_degree"),
        F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"),
    )


def undirected_degrees(graph: ReplyGraph) -> DataFrame:
    return graph.both_ways().groupBy(F.col("src").alias("vid")).agg(
        F.count("*").alias("degree"), F.sum("weight").alias("strength")
    )


def centrality_group(centrality: DataFrame, games: int = BROADCAST_GAMES + 1) -> DataFrame:
    """At or above the game's 90th percentile of the weighted degree (linear interpolation) is central.

    The percentile runs over degree counts, and a game has few distinct degrees.
    """
    counts = centrality.groupBy("game", "weighted_degree").agg(F.count("*").alias("n"))
    bound = counts.groupBy("game").agg(F.percentile("weighted_degree", 0.9, F.col("n")).alias("_bound"))
    bound = F.broadcast(bound) if games <= BROADCAST_GAMES else bound
    group = F.when(F.col("weighted_degree") >= F.col("_bound"), HIGH).otherwise(PERIPHERAL)
    return centrality.join(bound, "game").withColumn("centrality_group", group).drop("_bound")


# --- whole-graph measures -----------------------------------------------------------------------


def _vertex_counts(graph: ReplyGraph) -> DataFrame:
    return graph.vertices.groupBy("game").agg(F.count("*").alias("nodes"))


def _game_of(graph: ReplyGraph, rows: DataFrame, vid: str) -> DataFrame:
    return rows.join(graph.vertices.select(F.col("vid").alias(vid), "game"), vid)


def _sizes(graph: ReplyGraph) -> DataFrame:
    arcs = _game_of(graph, graph.arcs, "src").groupBy("game").agg(F.count("*").alias("edges"))
    return graph.per_game(_vertex_counts(graph), arcs)


def graph_density(graph: ReplyGraph) -> DataFrame:
    n = F.col("nodes")
    density = F.when(n > 1, F.round(F.col("edges") / (n * (n - 1)), 6)).otherwise(0.0)
    return _sizes(graph).withColumn("density", density)


def average_degree(graph: ReplyGraph) -> DataFrame:
    """Unweighted, of the undirected graph."""
    links = _game_of(graph, graph.links, "u").groupBy("game").agg(F.count("*").alias("links"))
    degree = F.round(2 * F.col("links") / F.col("nodes"), 4)
    return graph.per_game(_vertex_counts(graph), links).select("game", degree.alias("average_degree"))


def reciprocity(graph: ReplyGraph) -> DataFrame:
    """Share of arcs whose reverse exists."""
    back = graph.arcs.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(1).alias("hit"))
    rows = _game_of(graph, graph.arcs.join(back, ["src", "dst"], "left"), "src")
    share = F.round(F.count("hit") / F.count("*"), 6)
    return rows.groupBy("game").agg(share.alias("reciprocity"))


def local_clustering(graph: ReplyGraph, block: int = BLOCK) -> DataFrame:
    """Weighted local clustering per vertex with a triangle: cube root of the three scaled weights, summed.

    Links point from the vertex of lower degree to the one of higher degree, so that a vertex of any degree
    starts at most sqrt(2m) of them, and the pairs of links with a common start stay few. A vertex with more
    than ``block`` such links meets itself in pairs of blocks, so no join key makes more than about block² rows.
    """
    degree = undirected_degrees(graph).select("vid", "degree")
    at_u = degree.select(F.col("vid").alias("u"), F.col("degree").alias("du"))
    at_v = degree.select(F.col("vid").alias("v"), F.col("degree").alias("dv"))
    ranked = graph.links.join(at_u, "u").join(at_v, "v").filter((F.col("du") > 1) & (F.col("dv") > 1))
    low = F.struct(F.col("du"), F.col("u")) < F.struct(F.col("dv"), F.col("v"))
    out = graph.scratch.table(
        ranked.select(
            F.when(low, F.col("u")).otherwise(F.col("v")).alias("a"),
            F.when(low, F.col("v")).otherwise(F.col("u")).alias("b"), "weight",
        ), "oriented",
    )
    one = out.select("a", F.col("b").alias("x"), F.col("weight").alias("w1"))
    two = out.select("a", F.col("b").alias("y"), F.col("weight").alias("w2"))
    keys = ["a"]
    wide = out.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    wide, seen = graph.scratch.measured(
        wide.select("a", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "wide", n=F.count(F.lit(1))
    )
    if seen["n"]:
        keys = ["a", "i", "j"]
        blocks = F.coalesce("blocks", F.lit(1))
        every = F.explode(F.sequence(F.lit(0), blocks - 1))
        one = one.join(wide, "a", "left").withColumn("i", F.pmod(F.xxhash64("x"), blocks).cast("int")).withColumn("j", every)
        two = two.join(wide, "a", "left").withColumn("j", F.pmod(F.xxhash64("y"), blocks).cast("int")).withColumn("i", every)
        one, two = one.drop("blocks"), two.drop("blocks")
    closing = out.select(
        F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), F.col("weight").alias("w3")
    )
    triangles = one.join(two, keys).filter(F.col("x") < F.col("y")).join(closing, ["x", "y"])
    corners = triangles.select(
        F.explode(F.array("a", "x", "y")).alias("vid"),
        F.cbrt(F.col("w1").cast("double") * F.col("w2") * F.col("w3")).alias("t"),
    )
    per_vertex = corners.groupBy("vid").agg(F.sum("t").alias("t")).join(degree, "vid")
    d = F.col("degree")
    return per_vertex.select("vid", (2 * F.col("t") / (d * (d - 1))).alias("raw_clustering"))


def average_clustering(graph: ReplyGraph) -> DataFrame:
    """Mean over all vertices; weights are scaled by the graph's largest one."""
    total = _game_of(graph, local_clustering(graph), "vid").groupBy("game").agg(F.sum("raw_clustering").alias("c"))
    largest = _game_of(graph, graph.links, "u").groupBy("game").agg(F.max("weight").alias("w"))
    table = graph.per_game(graph.per_game(_vertex_counts(graph), largest), total, "left")
    mean = F.round(F.coalesce(F.col("c") / F.col("w") / F.col("nodes"), F.lit(0.0)), 6)
    return table.select("game", mean.alias("clustering"))


def modularity(graph: ReplyGraph, partition: DataFrame, digits: int | None = 6) -> DataFrame:
    """Weighted modularity of a partition (vid, community); 0 for a single community."""
    at_u = partition.select(F.col("vid").alias("u"), F.col("community").alias("cu"))
    at_v = partition.select(F.col("vid").alias("v"), F.col("community").alias("cv"))
    ends = _game_of(graph, graph.links.join(at_u, "u").join(at_v, "v"), "u").select(
        "game",
        F.inline(F.array(
            F.struct(F.col("cu").alias("c"), "weight", F.when(F.col("cu") == F.col("cv"), F.col("weight")).alias("inside")),
            F.struct(F.col("cv").alias("c"), "weight", F.lit(None).cast("bigint").alias("inside")),
        )),
    )
    each = ends.groupBy("game", "c").agg(F.sum("weight").alias("d"), F.coalesce(F.sum("inside"), F.lit(0)).alias("l"))
    total = each.groupBy("game").agg((F.sum("d") / 2).alias("w"))
    q = F.col("l") / F.col("w") - F.pow(F.col("d") / (2 * F.col("w")), 2)
    score = F.when(F.count("*") > 1, F.sum(q)).otherwise(0.0)
    score = F.round(score, digits) if digits is not None else score
    return graph.per_game(each, total).groupBy("game").agg(score.alias("modularity"))


# --- joined tables ------------------------------------------------------------------------------


def network_summary(graph: ReplyGraph, components: DataFrame, partition: DataFrame) -> DataFrame:
    """One row per game. ``components``: (vid, component); ``partition``: (vid, community)."""
    sizes = _game_of(graph, components, "vid").groupBy("game", "component").agg(F.count("*").alias("n"))
    comps = sizes.groupBy("game").agg(
        F.count("*").alias("components"), F.max("n").alias("largest_component_size")
    )
    groups = _game_of(graph, partition, "vid").select("game", "community").distinct()
    groups = groups.groupBy("game").agg(F.count("*").alias("communities"))
    table = graph_density(graph)
    for part in (comps, average_degree(graph), average_clustering(graph), reciprocity(graph), groups,
                 modularity(graph, partition)):
        table = graph.per_game(table, part, "left")
    return table


def centrality_table(
    graph: ReplyGraph, partition: DataFrame, pagerank: DataFrame, betweenness: DataFrame | None = None
) -> DataFrame:
    """One row per (game, user). Without ``betweenness`` its column is left out."""
    table = graph.vertices
    for part in (partition, weighted_degrees(graph), pagerank, betweenness):
        table = table if part is None else table.join(part, "vid", "left")
    measures = ["pagerank"] if betweenness is None else ["pagerank", "betweenness"]
    return table.select(
        "game", F.col("node").alias("authorChannelId"), F.col("community").cast("int").alias("community_id"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("weighted_degree", "in_degree", "out_degree")],
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in measures],
    )


def community_sizes(graph: ReplyGraph, partition: DataFrame) -> DataFrame:
    members = graph.vertices.join(partition, "vid").join(undirected_degrees(graph), "vid", "left")
    return members.groupBy("game", F.col("community").cast("int").alias("community_id")).agg(
        F.count("*").alias("users"), F.coalesce(F.sum("strength"), F.lit(0)).alias("weighted_degree_sum")
    )


def comment_community(comments: DataFrame, members: DataFrame) -> DataFrame:
    """The author's community on every comment; null for authors outside the game's graph."""
    ids = members.select(F.col("game").alias("gameLabel"), "authorChannelId", "community_id")
    return comments.join(ids, ["gameLabel", "authorChannelId"], "left")


def network_enrich(comments: DataFrame, centrality: DataFrame) -> DataFrame:
    """Centrality columns on every comment. The columns exist, as nulls, for an empty graph too."""
    columns = ["weighted_degree", "in_degree", "out_degree", "pagerank", "betweenness", "centrality_group"]
    found = [c for c in ["community_id", *columns] if c in centrality.columns and c not in comments.columns]
    table = centrality.select(F.col("game").alias("gameLabel"), "authorChannelId", *found)
    return comments.join(table, ["gameLabel", "authorChannelId"], "left")


def display_subgraph(
    graph: ReplyGraph, components: DataFrame, limit: int = 250
) -> tuple[DataFrame, DataFrame]:
    """Largest component per game, cut to the heaviest nodes; nodes with their drawing size, and links."""
    member = _game_of(graph, components, "vid")
    sizes = member.groupBy("game", "component").agg(F.count("*").alias("n"))
    largest = first_n(sizes, ["game"], ["-n", "component"], 1).select("component")
    inside = member.join(largest, "component", "left_semi").join(weighted_degrees(graph), "vid")
    nodes = graph.scratch.table(first_n(inside, ["game"], ["-weighted_degree", "vid"], limit), "shown")
    ids = nodes.select("vid")
    links = graph.links.join(ids.withColumnRenamed("vid", "u"), "u", "left_semi")
    links = links.join(ids.withColumnRenamed("vid", "v"), "v", "left_semi")
    strength = links.select(F.explode(F.array("u", "v")).alias("vid"), "weight").groupBy("vid")
    strength = strength.agg(F.sum("weight").alias("s"))
    size = 40 + 8 * F.sqrt(F.coalesce("s", F.lit(0)))
    shown = nodes.select("vid").join(strength, "vid", "left").select("vid", size.alias("node_size"))
    return graph.named(shown), links
