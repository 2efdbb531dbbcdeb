"""Reply-network measures over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.operators import communities as K
from threadloom.operators import distribution as D
from threadloom.operators import graph as G
from threadloom.operators import paths as W
from threadloom.operators import preprocess as P
from threadloom.operators import sketches as E
from threadloom.plans import views_sql as Q
from threadloom.plans.registry import query
from threadloom.sources import star_views as V

BASE = (Q.EVENTS, Q.edges("revents"), Q.GRAPH)
# Unrolled rounds of the SQL twins. A loop that has not come to its own end by then raises an error in the twin.
RANK_ROUNDS = W.MAX_ROUNDS
MERGE_ROUNDS = 16
HOPS = 30
FEW_PIVOTS = 7


def ended(unless: str, loop: str) -> str:
    """One row, or an error if the condition on the last round's tables holds."""
    return f"(SELECT CASE WHEN {unless} THEN error('{loop} goes on after its last round') END AS ended)"


def events_graph(spark, sf):
    return G.build_graph(P.reply_edges(V.reply_events(spark, sf)))


def given_partition(graph):
    """A partition that SQL can name as well: the user number modulo 7."""
    return graph.vertices.select("vid", (F.substring("node", 2, 20).cast("bigint") % 7).alias("community"))


def found_partition(graph):
    """The graph's communities as a table: several measures read them."""
    return graph.scratch.table(K.communities(graph), "communities")


def measured_users(graph, betweenness=True):
    """The centrality table from the loops themselves."""
    between = W.betweenness(graph) if betweenness else None
    return G.centrality_table(graph, found_partition(graph), W.pagerank(graph), between)


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("graph_vertices", f"{Q.with_(*BASE)} SELECT game, node FROM verts")
def graph_vertices(spark, sf):
    return G.graph_vertices(P.reply_edges(V.reply_events(spark, sf)))


@query("undirected_edges", f"{Q.with_(*BASE)} SELECT game, u, v, weight FROM links")
def undirected_edges(spark, sf):
    graph = events_graph(spark, sf)
    names = graph.vertices
    at_u = names.select(F.col("vid").alias("u"), "game", F.col("node").alias("nu"))
    at_v = names.select(F.col("vid").alias("v"), F.col("node").alias("nv"))
    rows = graph.links.join(at_u, "u").join(at_v, "v")
    return rows.select("game", F.col("nu").alias("u"), F.col("nv").alias("v"), "weight")


@query("weighted_degrees", f"{Q.with_(*BASE)} SELECT * FROM wdeg")
def weighted_degrees(spark, sf):
    graph = events_graph(spark, sf)
    return graph.named(G.weighted_degrees(graph))


def rank_sql() -> str:
    parts = ["""outs AS (SELECT "gameLabel" AS game, source AS node, sum(weight) AS o FROM edges GROUP BY ALL)""",
             "counts AS (SELECT game, count(*) AS n FROM verts GROUP BY ALL)",
             "r0 AS MATERIALIZED (SELECT game, node, 1.0::DOUBLE / n AS r, 1.0::DOUBLE AS moved FROM verts JOIN counts USING (game))"]
    for i in range(1, RANK_ROUNDS + 1):
        parts.append(f"""
got{i} AS (SELECT e."gameLabel" AS game, e.target AS node, sum(r * weight / o) AS g FROM edges e
           JOIN r{i - 1} p ON p.game = e."gameLabel" AND p.node = e.source
           JOIN outs q ON q.game = e."gameLabel" AND q.node = e.source GROUP BY ALL),
sunk{i} AS (SELECT p.game, sum(CASE WHEN o IS NULL THEN r ELSE 0 END) AS s, sum(moved) AS gap
            FROM r{i - 1} p LEFT JOIN outs USING (game, node) GROUP BY ALL),
r{i} AS MATERIALIZED (SELECT game, node, new AS r, abs(new - old) AS moved FROM (
  SELECT game, node, r AS old, CASE WHEN gap < n * {W.TOLERANCE} THEN r
    ELSE {1 - W.DAMPING:.2f} / n + {W.DAMPING} * (coalesce(g, 0) + s / n) END AS new
  FROM r{i - 1} JOIN counts USING (game) JOIN sunk{i} USING (game) LEFT JOIN got{i} USING (game, node)))""")
    unsettled = f"""EXISTS (SELECT game FROM r{RANK_ROUNDS} JOIN counts USING (game) GROUP BY game, n
  HAVING sum(moved) >= n * {W.TOLERANCE})"""
    parts.append(f"settled AS (SELECT game, node, r FROM r{RANK_ROUNDS} CROSS JOIN {ended(unsettled, 'PageRank')})")
    return ",\n".join(parts)


@query("pagerank", f"{Q.with_(*BASE, rank_sql())} SELECT game, node, round(r, 6) AS pagerank FROM settled")
def pagerank(spark, sf):
    graph = events_graph(spark, sf)
    return rounded(graph.named(W.pagerank(graph)), "pagerank")


def paths_sql(pivots: int | None = None) -> str:
    """All pairs: distances, then path counts hop by hop. Sources are all vertices, or the first so many per game."""
    parts = ["d0 AS MATERIALIZED (SELECT game, node AS s, node AS t, 0 AS d FROM verts)"]
    for i in range(1, HOPS + 1):
        parts.append(f"""d{i} AS MATERIALIZED (SELECT game, s, t, min(d) AS d FROM (
  SELECT * FROM d{i - 1} UNION ALL
  SELECT p.game, p.s, b.dst, p.d + b.weight FROM d{i - 1} p JOIN both_ways b ON b.game = p.game AND b.src = p.t) GROUP BY ALL)""")
    parts.append(f"""steps AS MATERIALIZED (SELECT a.game, a.s, a.t AS u, b.dst AS v FROM d{HOPS} a
  JOIN both_ways b ON b.game = a.game AND b.src = a.t
  JOIN d{HOPS} c ON c.game = a.game AND c.s = a.s AND c.t = b.dst AND c.d = a.d + b.weight)""")
    parts.append("n0 AS MATERIALIZED (SELECT game, node AS s, node AS t, 1.0::DOUBLE AS x FROM verts)")
    for i in range(1, HOPS + 1):
        parts.append(f"""n{i} AS MATERIALIZED (SELECT p.game, p.s, q.v AS t, sum(x) AS x FROM n{i - 1} p
  JOIN steps q ON q.game = p.game AND q.s = p.s AND q.u = p.t GROUP BY ALL)""")
    union = " UNION ALL ".join(f"SELECT * FROM n{i}" for i in range(HOPS + 1))
    parts.append(f"""sigma AS MATERIALIZED (SELECT game, s, t, sum(x) AS x, any_value(d) AS d FROM ({union})
  JOIN d{HOPS} USING (game, s, t) GROUP BY ALL)""")
    parts.append(f"""pivots AS (SELECT game, node AS s FROM verts QUALIFY
  row_number() OVER (PARTITION BY game ORDER BY md5('{W.SEED}:' || node), node) <= {pivots or 'count(*) OVER (PARTITION BY game)'})""")
    parts.append("""between_sum AS (SELECT a.game, a.t AS node, sum(a.x * b.x / c.x) AS b FROM sigma a
  JOIN pivots p ON p.game = a.game AND p.s = a.s
  JOIN sigma b ON b.game = a.game AND b.s = a.t JOIN sigma c ON c.game = a.game AND c.s = a.s AND c.t = b.t
  WHERE a.s <> a.t AND b.t <> a.t AND a.s <> b.t AND a.d + b.d = c.d GROUP BY ALL)""")
    more = f"""EXISTS (FROM n{HOPS}) OR EXISTS (SELECT game, s, t, d FROM d{HOPS} EXCEPT SELECT game, s, t, d FROM d{HOPS - 1})"""
    parts.append(f"""betw AS (SELECT game, node, coalesce(b, 0) / ((least(n, {pivots or 'n'}) - (p.s IS NOT NULL)::INT) * (n - 2)) AS b
  FROM verts v JOIN (SELECT game, count(*) AS n FROM verts GROUP BY ALL) USING (game)
  LEFT JOIN between_sum USING (game, node) LEFT JOIN pivots p ON p.game = v.game AND p.s = v.node
  CROSS JOIN {ended(more, 'the search for paths')})""")
    return ",\n".join(parts)


@query("betweenness", f"{Q.with_(*BASE, paths_sql())} SELECT game, node, round(b, 6) AS betweenness FROM betw")
def betweenness(spark, sf):
    graph = events_graph(spark, sf)
    return rounded(graph.named(W.betweenness(graph)), "betweenness")


@query("betweenness_few_pivots", f"""{Q.with_(*BASE, paths_sql(FEW_PIVOTS))}
SELECT game, node, round(b, 6) AS betweenness FROM betw""")
def betweenness_few_pivots(spark, sf):
    graph = events_graph(spark, sf)
    return rounded(graph.named(W.betweenness(graph, k=FEW_PIVOTS)), "betweenness")


COMMENTS_GRAPH = (Q.COMMENTS, Q.edges("comments"), Q.GRAPH)
REACH = """
reach AS (
  SELECT game, node, node AS root FROM verts
  UNION SELECT r.game, b.dst, r.root FROM reach r JOIN both_ways b ON b.game = r.game AND b.src = r.node
),
comp AS (SELECT game, node, min(root) AS component FROM reach GROUP BY ALL)"""


def comments_graph(spark, sf):
    return G.build_graph(P.reply_edges(V.comments(spark, sf, text=False)))


@query("connected_components", f"""{Q.with_(*COMMENTS_GRAPH, REACH, recursive=True)}
SELECT game, node, component FROM comp""")
def connected_components(spark, sf):
    graph = comments_graph(spark, sf)
    found = graph.named(W.connected_components(graph))
    names = graph.vertices.select(F.col("vid").alias("component"), F.col("node").alias("name"))
    return found.join(names, "component").select("game", "node", F.col("name").alias("component"))


SIZES = """
sizes AS (SELECT game, count(*) AS nodes FROM verts GROUP BY ALL),
arcs AS (SELECT "gameLabel" AS game, count(*) AS edges FROM edges GROUP BY ALL),
dens AS (SELECT game, nodes, edges, CASE WHEN nodes > 1 THEN round(edges / (nodes * (nodes - 1)), 6) ELSE 0 END AS density
         FROM sizes JOIN arcs USING (game)),
avgd AS (SELECT game, round(2 * l / nodes, 4) AS average_degree FROM sizes
         JOIN (SELECT game, count(*) AS l FROM links GROUP BY ALL) USING (game)),
recip AS (SELECT a."gameLabel" AS game, round(count(b.source) / count(*), 6) AS reciprocity FROM edges a
          LEFT JOIN edges b ON b."gameLabel" = a."gameLabel" AND b.source = a.target AND b.target = a.source GROUP BY ALL),
maxw AS (SELECT game, max(weight) AS w FROM links GROUP BY ALL),
tri AS (
  SELECT a.game, a.src AS node, sum(pow(a.weight * b.weight * c.weight, 1.0 / 3)) AS t
  FROM both_ways a JOIN both_ways b ON b.game = a.game AND b.src = a.src AND b.dst > a.dst
  JOIN links c ON c.game = a.game AND c.u = a.dst AND c.v = b.dst GROUP BY ALL
),
clus AS (SELECT game, round(coalesce(c, 0) / w / nodes, 6) AS clustering FROM sizes JOIN maxw USING (game)
         LEFT JOIN (SELECT game, sum(2 * t / (degree * (degree - 1))) AS c FROM tri JOIN udeg USING (game, node) GROUP BY ALL)
         USING (game)),
modu AS (
  SELECT game, round(sum(l / w - pow(d / (2 * w), 2)), 6) AS modularity FROM (
    SELECT game, community, sum(strength) AS d FROM udeg JOIN part USING (game, node) GROUP BY ALL)
  JOIN (SELECT game, sum(weight) AS w FROM links GROUP BY ALL) USING (game)
  JOIN (SELECT k.game, p.community, sum(CASE WHEN p.community = q.community THEN weight ELSE 0 END) AS l FROM links k
        JOIN part p ON p.game = k.game AND p.node = k.u JOIN part q ON q.game = k.game AND q.node = k.v GROUP BY ALL) i
  USING (game, community) GROUP BY ALL
)"""
SIZED = Q.with_(*BASE, Q.PART, SIZES)


def communities_sql() -> str:
    """The agglomeration round by round on names; ``part`` holds the numbered communities."""
    parts = ["""
w2 AS (SELECT game, CAST(sum(strength) AS BIGINT) AS w2 FROM udeg GROUP BY ALL),
draws AS MATERIALIZED (SELECT DISTINCT node AS id, CAST('0x' || substr(md5(node), 1, 7) AS BIGINT) AS draw FROM verts),
alone AS (SELECT game, src AS node, min(dst) AS near FROM both_ways GROUP BY ALL HAVING count(*) = 1),
cp0 AS MATERIALIZED (
  SELECT v.game, v.node, CASE WHEN o.near IS NULL THEN v.node WHEN n.degree = 1 THEN least(v.node, o.near) ELSE o.near END AS id
  FROM verts v LEFT JOIN alone o ON o.game = v.game AND o.node = v.node
  LEFT JOIN udeg n ON n.game = v.game AND n.node = o.near),
cg0 AS MATERIALIZED (SELECT p.game, p.id, CAST(coalesce(sum(strength), 0) AS BIGINT) AS d FROM cp0 p
  LEFT JOIN udeg u ON u.game = p.game AND u.node = p.node GROUP BY ALL),
cl0 AS MATERIALIZED (SELECT k.game, least(x.id, y.id) AS a, greatest(x.id, y.id) AS b, CAST(sum(weight) AS BIGINT) AS weight
  FROM links k JOIN cp0 x ON x.game = k.game AND x.node = k.u JOIN cp0 y ON y.game = k.game AND y.node = k.v
  WHERE x.id <> y.id GROUP BY ALL)"""]
    for i in range(MERGE_ROUNDS):
        parts.append(f"""
cand{i} AS MATERIALIZED (
  SELECT l.game, l.a, l.b, w2 * weight AS reward, w2 * weight - x.d * y.d AS gain, x.d AS da, y.d AS db,
         (p.draw + q.draw) * {K.turn_factor(i)} % {K.PRIME} AS turn
  FROM cl{i} l JOIN w2 ON w2.game = l.game JOIN cg{i} x ON x.game = l.game AND x.id = l.a
  JOIN cg{i} y ON y.game = l.game AND y.id = l.b JOIN draws p ON p.id = l.a JOIN draws q ON q.id = l.b
  WHERE w2 * weight > x.d * y.d),
pick{i} AS MATERIALIZED (
  SELECT game, id, pick, reward, d FROM (
    SELECT game, a AS id, b AS pick, reward, da AS d, gain, turn, a, b FROM cand{i}
    UNION ALL SELECT game, b, a, reward, db, gain, turn, a, b FROM cand{i})
  QUALIFY row_number() OVER (PARTITION BY game, id ORDER BY gain DESC, turn, a, b) = 1),
pair{i} AS MATERIALIZED (
  SELECT x.game, x.id, least(x.id, x.pick) AS head, x.d + y.d AS core FROM pick{i} x
  JOIN pick{i} y ON y.game = x.game AND y.id = x.pick AND y.pick = x.id),
suit{i} AS (
  SELECT s.*, h.head, h.core, sum(s.d) OVER (PARTITION BY s.game, h.head) AS crowd FROM pick{i} s
  JOIN pair{i} h ON h.game = s.game AND h.id = s.pick LEFT JOIN pair{i} z ON z.game = s.game AND z.id = s.id
  WHERE z.id IS NULL),
move{i} AS MATERIALIZED (
  SELECT game, id AS was, head AS now FROM pair{i} WHERE id <> head
  UNION ALL SELECT game, id, head FROM suit{i} WHERE 2 * reward > d * (2 * core + crowd - d)),
cg{i + 1} AS MATERIALIZED (SELECT g.game, coalesce(m.now, g.id) AS id, CAST(sum(g.d) AS BIGINT) AS d FROM cg{i} g
  LEFT JOIN move{i} m ON m.game = g.game AND m.was = g.id GROUP BY ALL),
cp{i + 1} AS MATERIALIZED (SELECT p.game, p.node, coalesce(m.now, p.id) AS id FROM cp{i} p
  LEFT JOIN move{i} m ON m.game = p.game AND m.was = p.id),
cl{i + 1} AS MATERIALIZED (
  SELECT game, least(a, b) AS a, greatest(a, b) AS b, CAST(sum(weight) AS BIGINT) AS weight FROM (
    SELECT l.game, coalesce(m.now, l.a) AS a, coalesce(n.now, l.b) AS b, weight FROM cl{i} l
    LEFT JOIN move{i} m ON m.game = l.game AND m.was = l.a LEFT JOIN move{i} n ON n.game = l.game AND n.was = l.b)
  WHERE a <> b GROUP BY ALL)""")
    more = f"""EXISTS (SELECT 1 FROM cl{MERGE_ROUNDS} l JOIN w2 ON w2.game = l.game JOIN cg{MERGE_ROUNDS} x ON x.game = l.game AND x.id = l.a
  JOIN cg{MERGE_ROUNDS} y ON y.game = l.game AND y.id = l.b WHERE w2 * weight > x.d * y.d)"""
    parts.append(f"""
part AS MATERIALIZED (
  SELECT game, node, CAST(number AS INTEGER) AS community FROM cp{MERGE_ROUNDS} JOIN (
    SELECT game, id, row_number() OVER (PARTITION BY game ORDER BY count(*) DESC, min(node)) - 1 AS number
    FROM cp{MERGE_ROUNDS} GROUP BY game, id) USING (game, id) CROSS JOIN {ended(more, 'the agglomeration')})""")
    return ",".join(parts)


@query("graph_density", f"{SIZED} SELECT * FROM dens")
def graph_density(spark, sf):
    return G.graph_density(events_graph(spark, sf))


@query("average_degree", f"{SIZED} SELECT * FROM avgd")
def average_degree(spark, sf):
    return G.average_degree(events_graph(spark, sf))


@query("avg_clustering", f"{SIZED} SELECT * FROM clus")
def avg_clustering(spark, sf):
    return G.average_clustering(events_graph(spark, sf))


@query("reciprocity", f"{SIZED} SELECT * FROM recip")
def reciprocity(spark, sf):
    return G.reciprocity(events_graph(spark, sf))


@query("communities", f"{Q.with_(*BASE, communities_sql())} SELECT game, node, CAST(community AS BIGINT) AS community FROM part")
def communities(spark, sf):
    graph = events_graph(spark, sf)
    return graph.named(K.communities(graph))


@query("modularity", f"{SIZED} SELECT * FROM modu")
def modularity(spark, sf):
    graph = events_graph(spark, sf)
    return G.modularity(graph, given_partition(graph))


@query("network_summary", f"""{Q.with_(*COMMENTS_GRAPH, REACH, communities_sql(), SIZES, recursive=True)}
SELECT * FROM dens JOIN avgd USING (game) JOIN clus USING (game) JOIN recip USING (game) JOIN modu USING (game)
JOIN (SELECT game, count(*) AS components, max(n) AS largest_component_size FROM (
        SELECT game, component, count(*) AS n FROM comp GROUP BY ALL) GROUP BY ALL) USING (game)
JOIN (SELECT game, count(DISTINCT community) AS communities FROM part GROUP BY ALL) USING (game)""")
def network_summary(spark, sf):
    graph = comments_graph(spark, sf)
    return G.network_summary(graph, W.connected_components(graph), found_partition(graph))


@query("centrality_table", f"""{Q.with_(*BASE, communities_sql(), rank_sql(), paths_sql())}
SELECT game, node AS "authorChannelId", community AS community_id, weighted_degree, in_degree, out_degree,
       round(r, 6) AS pagerank, round(b, 6) AS betweenness
FROM verts JOIN part USING (game, node) JOIN wdeg USING (game, node) JOIN settled USING (game, node)
JOIN betw USING (game, node)""")
def centrality_table(spark, sf):
    graph = events_graph(spark, sf)
    return rounded(measured_users(graph), "pagerank", "betweenness")


@query("community_sizes", f"""{Q.with_(*BASE, Q.PART)}
SELECT game, community AS community_id, count(*) AS users, CAST(sum(strength) AS BIGINT) AS weighted_degree_sum
FROM part JOIN udeg USING (game, node) GROUP BY ALL""")
def community_sizes(spark, sf):
    graph = events_graph(spark, sf)
    return G.community_sizes(graph, given_partition(graph))


@query("comment_community", f"""{Q.with_(*COMMENTS_GRAPH, Q.PART)}
SELECT "commentId", community AS community_id FROM comments
LEFT JOIN part ON game = "gameLabel" AND node = "authorChannelId" """)
def comment_community(spark, sf):
    graph = comments_graph(spark, sf)
    members = graph.vertices.join(given_partition(graph), "vid").select(
        "game", F.col("node").alias("authorChannelId"), F.col("community").cast("int").alias("community_id")
    )
    return G.comment_community(V.comments(spark, sf, text=False), members).select("commentId", "community_id")


CENTRAL_GROUP = """CASE WHEN weighted_degree >= quantile_cont(weighted_degree, 0.9) OVER (PARTITION BY game)
              THEN 'High centrality' ELSE 'Peripheral' END AS centrality_group"""
CENTRAL = f"""
central AS (SELECT w.*, r AS pagerank, {CENTRAL_GROUP} FROM wdeg w JOIN settled USING (game, node))"""


@query("centrality_group", f"""{Q.with_(*BASE)}
SELECT game, node AS "authorChannelId", weighted_degree, {CENTRAL_GROUP} FROM wdeg""")
def centrality_group(spark, sf):
    graph = events_graph(spark, sf)
    degrees = graph.named(G.weighted_degrees(graph)).withColumnRenamed("node", "authorChannelId")
    return G.centrality_group(degrees, graph.games).select("game", "authorChannelId", "weighted_degree", "centrality_group")


@query("degree_sketches", f"""{Q.with_(*BASE)}
SELECT game, count(*) AS rows, true AS near FROM wdeg GROUP BY game""")
def degree_sketches(spark, sf):
    """Sketches of two halves, merged: the share of users below their 90 % bound is near that."""
    graph = events_graph(spark, sf)
    degrees = graph.scratch.table(graph.named(G.weighted_degrees(graph)), "degrees")
    half = F.xxhash64("node") % 2 == 0
    sketches = E.merged_degrees([E.degree_sketches(degrees.filter(half)), E.degree_sketches(degrees.filter(~half))])
    bounds = sketches.select("game", E.degree_quantile(F.col("sketch"), E.CENTRAL_SHARE).alias("bound"))
    below = F.avg((F.col("weighted_degree") < F.col("bound")).cast("int"))
    most = F.avg((F.col("weighted_degree") <= F.col("bound")).cast("int"))
    ranks = degrees.join(bounds, "game").groupBy("game").agg(F.count("*").alias("rows"), below.alias("below"), most.alias("most"))
    near = (F.col("below") <= E.CENTRAL_SHARE + E.RANK_ERROR) & (F.col("most") >= E.CENTRAL_SHARE - E.RANK_ERROR)
    return ranks.select("game", "rows", near.alias("near"))


@query("user_sketches", f"""{Q.with_(Q.EVENTS)}
SELECT "gameLabel", count(DISTINCT "authorChannelId") AS users, true AS near FROM revents GROUP BY ALL""")
def user_sketches(spark, sf):
    """Distinct users of two runs from their merged sketches, next to the exact count."""
    rows, group = V.reply_events(spark, sf), ["gameLabel"]
    runs = [E.user_sketches(rows.filter(F.col("ord") % 3 == 0), group), E.user_sketches(rows.filter(F.col("ord") % 3 != 0), group)]
    found = E.estimated_users(E.merged_users(runs, group), group).withColumnRenamed("users", "estimate")
    exact = rows.groupBy(*group).agg(F.count_distinct("authorChannelId").alias("users"))
    return exact.join(found, group).select("gameLabel", "users", (F.abs(F.col("estimate") - F.col("users")) <= F.col("users") * E.COUNT_ERROR + 1).alias("near"))


@query("network_enrich", f"""{Q.with_(*COMMENTS_GRAPH, communities_sql(), rank_sql(), paths_sql(), CENTRAL)}
SELECT "commentId", community AS community_id, weighted_degree, in_degree, out_degree, round(pagerank, 6) AS pagerank,
       round(b, 6) AS betweenness, centrality_group
FROM comments LEFT JOIN (SELECT * FROM central JOIN part USING (game, node) JOIN betw USING (game, node))
ON game = "gameLabel" AND node = "authorChannelId" """)
def network_enrich(spark, sf):
    graph = comments_graph(spark, sf)
    central = G.centrality_group(rounded(measured_users(graph), "pagerank", "betweenness"), graph.games)
    return G.network_enrich(V.comments(spark, sf, text=False), central).select(
        "commentId", "community_id", "weighted_degree", "in_degree", "out_degree", "pagerank", "betweenness",
        "centrality_group",
    )


@query("top_communities", f"""{Q.with_(*BASE, communities_sql())}
SELECT *, game || ' C' || community_id AS label FROM (
  SELECT game, community AS community_id, count(*) AS users, CAST(coalesce(sum(strength), 0) AS BIGINT) AS weighted_degree_sum
  FROM part LEFT JOIN udeg USING (game, node) GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY game ORDER BY users DESC, community_id) <= 10""")
def top_communities(spark, sf):
    graph = events_graph(spark, sf)
    return D.top_groups(G.community_sizes(graph, found_partition(graph)), "game", "users", "community_id", 10)


@query("display_subgraph", f"""{Q.with_(*COMMENTS_GRAPH, REACH, '''
shown AS (
  SELECT game, node FROM (
    SELECT *, row_number() OVER (PARTITION BY game ORDER BY weighted_degree DESC, node) AS place FROM comp JOIN wdeg USING (game, node)
    WHERE (game, component) IN (
      SELECT (game, component) FROM (SELECT game, component, count(*) AS n FROM comp GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY game ORDER BY n DESC, component) = 1)) WHERE place <= 250
),
kept AS (SELECT b.* FROM both_ways b JOIN shown s ON s.game = b.game AND s.node = b.src
         JOIN shown t ON t.game = b.game AND t.node = b.dst)''', recursive=True)}
SELECT game, node, round(40 + 8 * sqrt(coalesce(s, 0)), 6) AS node_size FROM shown
LEFT JOIN (SELECT game, src AS node, sum(weight) AS s FROM kept GROUP BY ALL) USING (game, node)""")
def display_subgraph(spark, sf):
    graph = comments_graph(spark, sf)
    nodes, _ = G.display_subgraph(graph, W.connected_components(graph))
    return rounded(nodes, "node_size")
