import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from qaspark.operators import graph
from qaspark.operators.centrality import betweenness_centrality
from qaspark.operators.communities import communities, modularity

EDGE = "language string, source string, target string, weight long"


def edges_of(spark, edges, language="g"):
    rows = [(language, min(a, b), max(a, b), w) for a, b, w in edges]
    return spark.createDataFrame(rows, EDGE)


def brute_betweenness(edges, weighted=True):
    """Enumerate all simple paths of every pair."""
    near = {}
    for a, b, w in edges:
        near.setdefault(a, {})[b] = w if weighted else 1
        near.setdefault(b, {})[a] = w if weighted else 1
    nodes = sorted(near)
    score = dict.fromkeys(nodes, 0.0)
    for s, t in itertools.combinations(nodes, 2):
        paths = []
        stack = [(s, (s,), 0)]
        while stack:
            at, path, d = stack.pop()
            if at == t:
                paths.append((d, path))
                continue
            stack += [(n, path + (n,), d + w) for n, w in near[at].items() if n not in path]
        if not paths:
            continue
        best = min(d for d, _ in paths)
        shortest = [p for d, p in paths if d == best]
        for p in shortest:
            for v in p[1:-1]:
                score[v] += 1 / len(shortest)
    n = len(nodes)
    return {v: x * 2 / ((n - 1) * (n - 2)) if n > 2 else 0.0 for v, x in score.items()}


GRAPHS = {
    "triangle": [("a", "b", 1), ("b", "c", 1), ("a", "c", 5)],
    "star": [("m", x, 2) for x in "abcd"],
    "path": [("a", "b", 1), ("b", "c", 2), ("c", "d", 3)],
    "pair": [("a", "b", 4)],
    "two parts": [("a", "b", 1), ("b", "c", 1), ("x", "y", 1), ("y", "z", 1)],
    "square": [("a", "b", 1), ("b", "c", 1), ("c", "d", 1), ("a", "d", 1)],
}


def random_graph(seed, n=9):
    rng = random.Random(seed)
    return [(f"n{i}", f"n{j}", rng.randint(1, 4)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4]


@pytest.mark.parametrize("weighted", [True, False])
def test_betweenness_against_path_enumeration(spark, weighted):
    graphs = {**GRAPHS, "random 1": random_graph(1), "random 2": random_graph(2)}
    rows = [(name, min(a, b), max(a, b), w) for name, e in graphs.items() for a, b, w in e]
    found = betweenness_centrality(spark.createDataFrame(rows, EDGE), weighted, digits=None).collect()
    got = {(r.language, r.id): r.betweenness_centrality for r in found}
    expected = {(name, v): x for name, e in graphs.items() for v, x in brute_betweenness(e, weighted).items()}
    assert got == pytest.approx(expected)


def test_betweenness_from_pivots_is_scaled(spark):
    star = edges_of(spark, [("hub", f"n{i:02d}", 1) for i in range(30)])
    got = {r.id: r.betweenness_centrality for r in betweenness_centrality(star, max_pivots=10, digits=None).collect()}
    assert got["hub"] == pytest.approx(1.0, rel=0.1) and got["n00"] == 0.0


def test_betweenness_in_batches_keeps_one_row_per_node(spark, tmp_path, monkeypatch):
    from qaspark import session

    monkeypatch.setattr(session, "checkpoint_folder", lambda _: str(tmp_path))
    graphs = {"tree": [("hub1", "hub2", 2)] + [(f"hub{1 + i % 2}", f"n{i:02d}", 1 + i % 3) for i in range(20)], "random": random_graph(1)}
    rows = [(name, min(a, b), max(a, b), w) for name, e in graphs.items() for a, b, w in e]
    links = {name: 2 * len(e) for name, e in graphs.items()}
    ends = {name: len({v for a, b, _ in e for v in (a, b)}) for name, e in graphs.items()}
    state = sum(links[g] * ends[g] for g in graphs)
    found = betweenness_centrality(spark.createDataFrame(rows, EDGE), digits=None, state_rows=state // 3 + 1).collect()
    got = {(r.language, r.id): r.betweenness_centrality for r in found}
    assert got == pytest.approx({(name, v): x for name, e in graphs.items() for v, x in brute_betweenness(e, True).items()})
    # What is left is the links, the nodes, the sources and one row per node that lies on a path; three batches left nothing.
    left = sorted(x.name.split("-")[0] for x in (tmp_path / "qaspark").iterdir())
    assert left == ["betweenness", "ends", "links", "sources"]
    assert spark.read.parquet(str(next((tmp_path / "qaspark").glob("betweenness-*")))).count() <= sum(ends.values())


def test_pairs_within_rows(spark):
    rng = random.Random(3)
    baskets = [(rng.choice("xy"), rng.choices("abcdefg", k=rng.randint(0, 6))) for _ in range(300)]
    df = spark.createDataFrame(baskets, "language string, tags array<string>")
    expected = Counter((k, *p) for k, tags in baskets for p in itertools.combinations(sorted(tags), 2))
    got = {(r.language, r.source, r.target): r.weight for r in graph.tag_pairs(df).collect()}
    assert got == expected
    distinct = Counter((k, *p) for k, tags in baskets for p in itertools.combinations(sorted(set(tags)), 2))
    assert {(r.language, r.source, r.target): r.weight for r in graph.tag_pairs(df, True).collect()} == distinct


def test_cooccurrence_graph_cuts_tags_before_pairs(spark):
    rng = random.Random(4)
    baskets = [("x", sorted(set(rng.choices("aaabbbccdefghij", k=4)))) for _ in range(200)] + [("x", ["lonely"])] * 90 + [("y", None)]
    df = spark.createDataFrame(baskets, "language string, tags array<string>")
    nodes, edges = graph.cooccurrence_graph(df, min_weight=12, top_n=6)
    frequency = Counter(t for _, tags in baskets for t in tags or [])
    top = sorted(frequency, key=lambda t: (-frequency[t], t))[:6]
    pairs = Counter(p for _, tags in baskets for p in itertools.combinations([t for t in tags or [] if t in top], 2))
    expected = {p: w for p, w in pairs.items() if w >= 12}
    assert {(r.source, r.target): r.weight for r in edges.collect()} == expected
    ends = {t for p in expected for t in p}
    assert "lonely" in top and "lonely" not in ends
    assert {r.id: r.frequency for r in nodes.collect()} == {t: frequency[t] for t in ends}


def test_degree_neighbors_and_trimming(spark):
    edges = edges_of(spark, [("a", "b", 3), ("a", "c", 4), ("a", "d", 5), ("c", "d", 3)])
    degree = {r.id: (r.degree, r.degree_centrality) for r in graph.degree_centrality(edges).collect()}
    assert degree == {"a": (3, 1.0), "b": (1, 0.3333), "c": (2, 0.6667), "d": (2, 0.6667)}
    assert sorted(r.neighbor for r in graph.neighbors(edges, "c").collect()) == ["a", "d"]
    nodes = spark.createDataFrame([("g", x, 1, b) for x, b in zip("abcd", [0.9, 0.0, 0.1, 0.1])],
                                  "language string, id string, frequency long, betweenness_centrality double")
    best, inner = graph.trim_network(nodes, edges, 2)
    assert sorted(r.id for r in best.collect()) == ["a", "c"]
    assert [(r.source, r.target) for r in inner.collect()] == [("a", "c")]
    kept, _ = graph.trim_network(nodes, edges, 2, keep=["b"])
    assert sorted(r.id for r in kept.collect()) == ["a", "b"]


def test_node_defaults_and_profiles(spark):
    nodes = spark.createDataFrame([("g", "a", 5), ("g", "b", 7)], "language string, id string, frequency long")
    some = spark.createDataFrame([("g", "a", 3, 0.5, 0.25)], "language string, id string, community int, degree_centrality double, betweenness_centrality double")
    full = graph.network_nodes(nodes, some, some, some)
    assert {tuple(r) for r in full.collect()} == {("g", "a", 5, 3, 0.5, 0.25), ("g", "b", 7, 0, 0.0, 0.0)}
    assert {(r.community, r["size"], r.members) for r in graph.community_profile(full).collect()} == {(3, 1, "a(5)"), (0, 1, "b(7)")}
    summary = graph.network_summary(full, edges_of(spark, [("a", "b", 1)])).first()
    assert (summary.nodes, summary.edges, summary.communities) == (2, 1, 2)


def brute_modularity(edges, label):
    two_m = 2 * sum(w for *_, w in edges)
    inner, degree = Counter(), Counter()
    for a, b, w in edges:
        degree[label[a]] += w
        degree[label[b]] += w
        if label[a] == label[b]:
            inner[label[a]] += 2 * w
    return sum(inner[c] / two_m - (degree[c] / two_m) ** 2 for c in degree)


def planted(groups=4, size=10, seed=1):
    rng = random.Random(seed)
    n = groups * size
    return [
        (f"n{i:02d}", f"n{j:02d}", rng.randint(3, 9)) for i in range(n) for j in range(i + 1, n)
        if rng.random() < (0.8 if i // size == j // size else 0.04)
    ]


def test_communities_of_planted_groups_and_cliques(spark):
    cliques = [(f"{g}{i}", f"{g}{j}", 3) for g in "xy" for i in range(5) for j in range(i + 1, 5)] + [("x0", "y0", 3)]
    graphs = {"planted": planted(), "cliques": cliques}
    rows = [(name, min(a, b), max(a, b), w) for name, e in graphs.items() for a, b, w in e]
    edges = spark.createDataFrame(rows, EDGE)
    labels = communities(edges)
    got = {}
    for r in labels.collect():
        got.setdefault(r.language, {})[r.id] = r.community
    quality = {r.language: r.modularity for r in modularity(edges, labels).collect()}
    for name, e in graphs.items():
        assert quality[name] == pytest.approx(brute_modularity(e, got[name]))
        truth = {v: (v[0] if name == "cliques" else int(v[1:]) // 10) for v in got[name]}
        assert quality[name] >= 0.95 * brute_modularity(e, truth)
    assert len(set(got["cliques"].values())) == 2
    assert sorted(set(got["planted"].values())) == list(range(len(set(got["planted"].values()))))
    shuffled = edges.where(F.col("language") == "cliques").repartition(5, "source")
    assert {r.id: r.community for r in communities(shuffled).collect()} == got["cliques"]


def sequential_louvain(edges):
    """Plain Louvain: nodes in order, each to its best community, until nothing moves; then the communities are the nodes."""
    links, member = [(a, b, w) for a, b, w in edges], {v: v for a, b, _ in edges for v in (a, b)}
    two_m = 2 * sum(w for *_, w in edges)
    while True:
        around, degree = {}, Counter()
        for a, b, w in links:
            degree[a] += w
            degree[b] += w
            if a != b:
                around.setdefault(a, Counter())[b] += w
                around.setdefault(b, Counter())[a] += w
        label, total = {v: v for v in degree}, Counter(degree)
        moved, ever = True, False
        while moved:
            moved = False
            for v in sorted(degree):
                near = Counter()
                for u, w in around.get(v, {}).items():
                    near[label[u]] += w
                total[label[v]] -= degree[v]
                gain = {c: near[c] - degree[v] * total[c] / two_m for c in {*near, label[v]}}
                best = max(sorted(gain), key=lambda c: (round(gain[c], 9), c == label[v]))
                moved |= best != label[v]
                label[v] = best
                total[best] += degree[v]
            ever |= moved
        if len(set(label.values())) == len(label):
            return member
        member = {v: label[c] for v, c in member.items()}
        merged = Counter()
        for a, b, w in links:
            merged[tuple(sorted((label[a], label[b])))] += w
        links = [(a, b, w) for (a, b), w in merged.items()]


def test_communities_run_until_nobody_wants_to_move(spark):
    rng = random.Random(11)
    edges = [(f"n{i:03d}", f"n{j:03d}", rng.randint(1, 4)) for i in range(150) for j in range(i + 1, 150) if rng.random() < (0.2 if i % 10 == j % 10 else 0.06)]
    labels = {r.id: r.community for r in communities(edges_of(spark, edges)).collect()}
    plain = brute_modularity(edges, sequential_louvain(edges))
    assert brute_modularity(edges, labels) >= 0.97 * plain


def test_betweenness_is_exact_beyond_a_hundred_nodes(spark):
    tree = [("hub1", "hub2", 2)] + [(f"hub{1 + i % 2}", f"n{i:03d}", 1 + i % 3) for i in range(128)]
    got = {r.id: r.betweenness_centrality for r in betweenness_centrality(edges_of(spark, tree), digits=None).collect()}
    assert got == pytest.approx(brute_betweenness(tree, True))


def test_communities_can_be_switched_off(spark):
    labels = communities(edges_of(spark, GRAPHS["path"]), "none").collect()
    assert {(r.id, r.community) for r in labels} == {(x, 0) for x in "abcd"}


def test_empty_graph(spark):
    empty = spark.createDataFrame([], EDGE)
    assert betweenness_centrality(empty).count() == 0
    assert communities(empty).count() == 0
    assert graph.degree_centrality(empty).count() == 0


def test_rounds_leave_only_the_last_table(spark, tmp_path, monkeypatch):
    import os

    from qaspark import session

    monkeypatch.setattr(session, "checkpoint_folder", lambda _: str(tmp_path))
    rounds = session.Rounds("numbers")
    table, _ = rounds.write(spark.range(5))
    for _ in range(4):
        table, seen = rounds.write(table.withColumn("id", F.col("id") + 1), rows=F.count(F.lit(1)))
    assert sorted(r.id for r in table.collect()) == [4, 5, 6, 7, 8] and seen["rows"] == 5
    assert len([x for x in os.listdir(tmp_path / "qaspark") if x.startswith("numbers-")]) == 1
