"""Network measures against brute force in plain Python on small graphs."""

import hashlib
import heapq
import itertools
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from threadloom.labels import HIGH, PERIPHERAL
from threadloom.operators import combined as B
from threadloom.operators import communities as K
from threadloom.operators import graph as G
from threadloom.operators import paths as W
from threadloom.operators import pivots as V
from threadloom.operators import sketches as E
from threadloom.plans import table_queries
from threadloom.session import Scratch

SCHEMA = "gameLabel string, source string, target string, weight long"


def pairs(game, *ends):
    return [(game, a, b, w) for a, b, w in ends]


def shapes():
    clique = lambda names: list(itertools.combinations(names, 2))
    bridge = [*clique("abcd"), *clique("efgh"), ("d", "e")]
    rng = random.Random(7)
    messy = {(f"n{rng.randrange(25)}", f"n{rng.randrange(25)}") for _ in range(60)}
    data = pairs("path", ("a", "b", 1), ("b", "c", 1), ("c", "d", 1))
    data += pairs("star", *[(f"l{i}", "hub", 1) for i in range(5)])
    data += pairs("triangle", ("a", "b", 1), ("b", "c", 8), ("c", "a", 1), ("a", "c", 5))
    data += pairs("two", ("a", "b", 3), ("b", "a", 1), ("x", "y", 1))
    data += pairs("pair", ("a", "b", 2))
    data += pairs("bridge", *[(a, b, 1) for a, b in bridge])
    data += pairs("messy", *[(a, b, rng.randrange(1, 4)) for a, b in sorted(messy) if a != b])
    return data + [(None, "q", "r", 1)]


DATA = shapes()
GAMES = sorted({row[0] for row in DATA if row[0]})


@pytest.fixture(scope="module")
def graph(spark):
    return G.build_graph(spark.createDataFrame(DATA, SCHEMA).repartition(3))


def by_node(graph, df, column):
    return {(r.game, r.node): r[column] for r in graph.named(df).collect()}


def arcs_of(game):
    return {(a, b): w for g, a, b, w in DATA if g == game}


def links_of(game):
    """Weight of the arc whose start appears later in the list by (weight desc, source, target)."""
    arcs = arcs_of(game)
    listed = sorted(arcs, key=lambda e: (-arcs[e], e))
    seen = list(dict.fromkeys(itertools.chain(*listed)))
    return {tuple(sorted(e)): arcs[max([x for x in (e, e[::-1]) if x in arcs], key=lambda x: seen.index(x[0]))] for e in arcs}


def neighbours(game):
    near = {}
    for (a, b), w in links_of(game).items():
        near.setdefault(a, {})[b] = w
        near.setdefault(b, {})[a] = w
    return near


def test_links(graph):
    names = {r.vid: r.node for r in graph.vertices.collect()}
    game = {r.vid: r.game for r in graph.vertices.collect()}
    got = {(game[r.u], *sorted((names[r.u], names[r.v]))): r.weight for r in graph.links.collect()}
    assert got == {(g, *pair): w for g in GAMES for pair, w in links_of(g).items()}
    total = G.undirected_edges(graph.arcs, "sum").agg(F.sum("weight")).first()[0]
    assert total == sum(r[3] for r in DATA if r[0])


def brute_pagerank(game):
    arcs = arcs_of(game)
    nodes = sorted(set(itertools.chain(*arcs)))
    out = {n: sum(w for (a, _), w in arcs.items() if a == n) for n in nodes}
    rank = {n: 1 / len(nodes) for n in nodes}
    for _ in range(100):
        sunk = sum(rank[n] for n in nodes if not out[n])
        new = {n: 0.15 / len(nodes) + 0.85 * sunk / len(nodes) for n in nodes}
        for (a, b), w in arcs.items():
            new[b] += 0.85 * rank[a] * w / out[a]
        gap = sum(abs(new[n] - rank[n]) for n in nodes)
        rank = new
        if gap < len(nodes) * 1e-6:
            return rank
    raise AssertionError


@pytest.mark.parametrize("hub_rows", [W.HUB_ROWS, 2])
def test_pagerank(graph, hub_rows):
    got = by_node(graph, W.pagerank(graph, hub_rows=hub_rows), "pagerank")
    want = {(g, n): r for g in GAMES for n, r in brute_pagerank(g).items()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_pagerank_must_settle(graph):
    with pytest.raises(RuntimeError):
        W.pagerank(graph, max_rounds=2)


def brute_betweenness(game, k=W.PIVOTS, inverse=False):
    near = neighbours(game)
    if inverse:
        near = {v: {w: Fraction(1, length) for w, length in out.items()} for v, out in near.items()}
    nodes, n = sorted(near), len(near)
    score = dict.fromkeys(nodes, 0.0)
    if n <= 2:
        return score
    drawn = sorted(nodes, key=lambda v: (hashlib.md5(f"{W.SEED}:{v}".encode()).hexdigest(), v))[:k]
    for s in drawn:
        dist, count, before, order, heap = {s: 0}, {s: 1.0}, {s: []}, [], [(0, s)]
        done = set()
        while heap:
            d, v = heapq.heappop(heap)
            if v in done:
                continue
            done.add(v)
            order.append(v)
            for w, length in near[v].items():
                if w not in dist or d + length < dist[w]:
                    dist[w], count[w], before[w] = d + length, count[v], [v]
                    heapq.heappush(heap, (d + length, w))
                elif d + length == dist[w] and w not in done:
                    count[w] += count[v]
                    before[w].append(v)
        dep = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for v in before[w]:
                dep[v] += count[v] / count[w] * (1 + dep[w])
            if w != s:
                score[w] += dep[w]
    return {v: x / max(1, (min(k, n) - (v in drawn)) * (n - 2)) for v, x in score.items()}


@pytest.mark.parametrize("hub_rows,k,inverse", [(W.HUB_ROWS, W.PIVOTS, False), (2, 3, False), (W.HUB_ROWS, 5, True), (3, 1, False)])
def test_betweenness(graph, monkeypatch, hub_rows, k, inverse):
    monkeypatch.setattr(V, "HELD_BYTES", 8 * k * 16)  # several batches of messages in a task
    found = W.betweenness(graph, k, length="inverse" if inverse else "weight", hub_rows=hub_rows)
    got = by_node(graph, found, "betweenness")
    want = {(g, n): x for g in GAMES for n, x in brute_betweenness(g, k, inverse).items()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_state_is_joined_and_updated_in_place(graph, spark):
    """A hop exchanges what the front sends and nothing of the state; the update exchanges the changed rows only."""
    pivots = graph.vertices.filter("game = 'messy'").limit(4).withColumn("slot", F.row_number().over(Window.orderBy("vid")) - 1)
    links = graph.both_ways().select("src", "dst", F.col("weight").cast("double").alias("cost"))
    arcs = G.Adjacency(links, graph.scratch)
    arcs.parts = 3  # a graph this small would have a single bucket
    work = V.Pivots(graph.scratch, pivots.select("vid", "slot"), arcs, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        def exchanges(df):
            return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

        state = work.distances()
        front = graph.scratch.table(state, "front")
        sent = work.arriving(front)
        assert exchanges(sent.join(state.select("vid", F.col("dist").alias("old")), "vid", "left")) == exchanges(sent) + 1
        changed = front.select("vid", F.col("dist").alias("new"))
        assert exchanges(state.join(changed, "vid", "full_outer")) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        arcs.close()


def test_vectors_cross_once_per_vertex_and_bucket(spark):
    """12 hubs with 300 vertices each time: the exchange carries no vector per arc, and none of the state."""
    edges = [("g", f"v{i:03}", f"hub{j:02}", 1) for i in range(300) for j in range(12)]
    graph = G.build_graph(spark.createDataFrame(edges, SCHEMA))
    links = graph.both_ways().select("src", "dst", F.col("weight").cast("double").alias("cost"))
    arcs = G.Adjacency(links, graph.scratch)
    arcs.parts = 3
    pivots = graph.vertices.limit(4).withColumn("slot", F.row_number().over(Window.orderBy("vid")) - 1)
    work = V.Pivots(graph.scratch, pivots.select("vid", "slot"), arcs, 4)
    arcs.close()
    state = work.distances()
    assert state.count() == 312
    sent = work.messages(state)
    assert sent.count() <= 300 + 12 * 3 and sent.select("vid").distinct().count() == 312
    met = work.arriving(state, own=state.select("vid", F.col("dist").alias("own")))
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("hub_rows", [W.HUB_ROWS, 2])
def test_components(graph, hub_rows):
    names = {r.vid: r.node for r in graph.vertices.collect()}
    got = by_node(graph, W.connected_components(graph, hub_rows), "component")
    for game in GAMES:
        near, seen = neighbours(game), {}
        for start in sorted(near):
            stack = [start]
            while stack:
                v = stack.pop()
                if v not in seen:
                    seen[v] = start
                    stack.extend(near[v])
        assert {n: names[got[(game, n)]] for n in near} == seen


def brute_modularity(game, label):
    links = links_of(game)
    total = sum(links.values())
    score = 0.0
    for c in set(label.values()):
        inside = sum(w for (a, b), w in links.items() if label[a] == label[b] == c)
        ends = sum(w * ((label[a] == c) + (label[b] == c)) for (a, b), w in links.items())
        score += inside / total - (ends / (2 * total)) ** 2
    return score


def test_communities(graph, spark):
    found = K.communities(graph)
    label = by_node(graph, found, "community")
    modularity = {r.game: r.modularity for r in G.modularity(graph, found, digits=None).collect()}
    for game in GAMES:
        own = {n: c for (g, n), c in label.items() if g == game}
        sizes = [list(own.values()).count(c) for c in range(len(set(own.values())))]
        assert sizes == sorted(sizes, reverse=True) and sum(sizes) == len(own)  # numbered by size, no gaps
        score = brute_modularity(game, own) if len(sizes) > 1 else 0.0
        assert modularity[game] == pytest.approx(score, abs=1e-12)
        # No two communities gain from a merge.
        for a, b in itertools.combinations(range(len(sizes)), 2):
            assert brute_modularity(game, {n: a if c == b else c for n, c in own.items()}) <= brute_modularity(game, own) + 1e-12
    assert len({c for (g, n), c in label.items() if g == "bridge"}) == 2
    assert len({c for (g, n), c in label.items() if g == "star"}) == 1
    assert modularity["messy"] > 0.25
    # Neither the order nor the partitioning of the input matters.
    shuffled = random.Random(3).sample(DATA, len(DATA))
    again = G.build_graph(spark.createDataFrame(shuffled, SCHEMA).repartition(7))
    assert by_node(again, K.communities(again), "community") == label


def test_summary(graph):
    table = G.network_summary(graph, W.connected_components(graph), K.communities(graph))
    got = {r.game: r for r in table.collect()}
    assert (got["path"].nodes, got["path"].edges, got["path"].density, got["path"].average_degree) == (4, 3, 0.25, 1.5)
    assert (got["two"].components, got["two"].largest_component_size) == (2, 2)
    assert got["two"].reciprocity == round(2 / 3, 6)
    weights = links_of("triangle")
    product = (weights["a", "b"] * weights["b", "c"] * weights["a", "c"]) ** (1 / 3)
    assert got["triangle"].clustering == round(product / max(weights.values()), 6)
    assert got["star"].clustering == 0.0 and got["pair"].modularity == 0.0


def test_degrees_and_groups(graph, rows):
    got = {(r.game, r.node): (r.weighted_degree, r.in_degree, r.out_degree)
           for r in graph.named(G.weighted_degrees(graph)).collect()}
    assert got["triangle", "a"] == (7, 1, 6) and got["star", "hub"] == (5, 5, 0)
    table = rows([("g", i) for i in range(11)] + [("same", 4)] * 3, "game string, weighted_degree long")
    groups = {(r.game, r.weighted_degree): r.centrality_group for r in G.centrality_group(table).collect()}
    assert groups["g", 9] == HIGH and groups["g", 8] == PERIPHERAL and groups["same", 4] == HIGH


def test_sketches_merge_over_runs(spark):
    """Three runs of unequal size: as near to the exact measures as stated, and the same for any order of the runs."""
    table = spark.range(60_000).select(
        F.concat(F.lit("g"), F.col("id") % 2).alias("game"), (F.pmod(F.xxhash64("id"), F.lit(70)) * F.pmod(F.xxhash64("id", F.lit(1)), F.lit(70))).alias("weighted_degree"),
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(20_000))).alias("authorChannelId"), "id")
    parts = [table.filter("id < 1000"), table.filter("id between 1000 and 19999"), table.filter("id >= 20000")]
    sketches = E.merged_degrees([E.degree_sketches(p) for p in parts])
    found = E.estimated_centrality_group(table, sketches)
    high = {r.game: r.share for r in found.groupBy("game").agg(F.avg((F.col("centrality_group") == HIGH).cast("int")).alias("share")).collect()}
    exact = {r.game: r.share for r in G.centrality_group(table).groupBy("game").agg(
        F.avg((F.col("centrality_group") == HIGH).cast("int")).alias("share")).collect()}
    assert set(high) == {"g0", "g1"} and all(abs(high[g] - exact[g]) < 2 * E.RANK_ERROR for g in high)
    users = [E.user_sketches(p, ["game"]) for p in parts]
    for runs in (users, users[::-1]):
        got = {r.game: r.users for r in E.estimated_users(E.merged_users(runs, ["game"]), ["game"]).collect()}
        want = {r.game: r.n for r in table.groupBy("game").agg(F.count_distinct("authorChannelId").alias("n")).collect()}
        assert all(abs(got[g] - want[g]) <= E.COUNT_ERROR * want[g] for g in want)


def test_enrich_without_graph(spark, rows):
    comments = rows([("g", "a"), ("g", "z")], "gameLabel string, authorChannelId string")
    empty = G.build_graph(rows([], SCHEMA), Scratch(spark, "none"))
    zero = empty.vertices.select("vid", F.lit(0).alias("community"))
    values = empty.vertices.select("vid", F.lit(0.0).alias("pagerank"))
    central = G.centrality_table(empty, zero, values, values.withColumnRenamed("pagerank", "betweenness"))
    table = G.network_enrich(comments, G.centrality_group(central, empty.games))
    assert table.count() == 2 and "centrality_group" in table.columns
    assert K.communities(empty).count() == 0 and W.pagerank(empty).count() == 0 and W.betweenness(empty).count() == 0


def test_display_subgraph(graph):
    nodes, links = G.display_subgraph(graph, W.connected_components(graph), limit=3)
    sizes = {(r.game, r.node): r.node_size for r in nodes.collect()}
    assert sum(1 for game, _ in sizes if game == "star") == 3
    assert sizes["star", "hub"] == pytest.approx(40 + 8 * 2 ** 0.5)
    assert sizes["two", "a"] == pytest.approx(40 + 8 * links_of("two")["a", "b"] ** 0.5)


def test_enriched_comments_carry_the_clean_text_only(spark, tmp_path):
    """The table under the community summaries holds one text per comment, and the users are a table of known size."""
    spark.range(60).selectExpr("id AS doc_id", "concat('good word', id % 3, ' again http://a.b') AS text", "'en' AS lang", "'src1' AS source").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.range(60).selectExpr("id AS event_id", "timestamp'2024-01-02' + make_interval(0, 0, 0, id % 20) AS ts", "id % 7 AS user_id",
                               "1L AS value").write.parquet(f"{tmp_path}/events.parquet")
    rows = table_queries.enriched(spark, str(tmp_path))
    assert "textClean" in rows.columns and not {"text", "textOriginal"} & set(rows.columns)
    assert rows.count() == 60 and rows.filter("textClean like '%http%' or sentiment_label is null").count() == 0
    summary = B.top_communities_by_users(B.community_summary(rows)).collect()
    assert summary and sum(r.comments for r in summary) == rows.filter("community_id is not null").count() > 0
