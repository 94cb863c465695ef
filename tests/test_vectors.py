import functools
import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from qaspark.operators import density, neighbors, tfidf, vectors
from qaspark.session import write_through

VECTORS = "language string, doc_id long, vector array<double>"


def docs(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rng = np.random.default_rng(2)
    rows = [(lang, i, " ".join(rng.choice(words[:k], 12))) for lang, k in (("x", 10), ("y", 6)) for i in range(25)]
    return spark.createDataFrame(rows + [("x", 99, "")], "language string, doc_id long, text string"), rows


def test_tfidf_against_the_formula(spark):
    df, rows = docs(spark)
    vocab, weights = tfidf.fit(df, min_df=3, max_features=30)
    got = {(r.language, r.doc_id, r.term): r.weight for r in weights.collect()}
    expected = {}
    for lang in "xy":
        texts = {i: t.split() for k, i, t in rows if k == lang}
        if lang == "x":
            texts[99] = []
        counts = {i: Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]) for i, w in texts.items()}
        df_ = Counter(t for c in counts.values() for t in c)
        ctf = Counter()
        for c in counts.values():
            ctf.update(c)
        chosen = sorted((t for t in df_ if df_[t] >= 3), key=lambda t: (-ctf[t], t))[:30]
        idf = {t: math.log((1 + len(texts)) / (1 + df_[t])) + 1 for t in chosen}
        for i, c in counts.items():
            raw = {t: (1 + math.log(n)) * idf[t] for t, n in c.items() if t in idf}
            norm = math.sqrt(sum(v * v for v in raw.values()))
            expected.update({(lang, i, t): v / norm for t, v in raw.items()})
    assert got == pytest.approx(expected)
    assert vocab.count() == 60


def test_unknown_terms_drop_out(spark):
    df, _ = docs(spark)
    vocab, _ = tfidf.fit(df)
    new = spark.createDataFrame([("x", 1, "alpha unseen"), ("x", 2, "unseen")], "language string, doc_id long, text string")
    got = tfidf.transform(tfidf.term_counts(new), vocab).collect()
    assert [(r.doc_id, r.term) for r in got] == [(1, "alpha")] and got[0].weight == pytest.approx(1.0)


def test_terms_are_counted_in_tasks_of_bounded_text(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "TEXT_BYTES", 64)
    rows = [("x", 1, "bb aa bb"), ("x", 1, "aa bb"), (None, None, "cc"), (None, None, "cc cc"), ("x", 2, None), ("y", 1, "aa bb bb bb")] + [("z", i, "dd ee") for i in range(200)]
    counts = tfidf.term_counts(spark.createDataFrame(rows, "language string, doc_id long, text string"))
    got = {(r.language, r.doc_id, r.term): r.tf for r in counts.where("language is null or language != 'z'").collect()}
    assert got == {
        ("x", 1, "aa"): 2, ("x", 1, "bb"): 3, ("x", 1, "bb aa"): 1, ("x", 1, "aa bb"): 2, (None, None, "cc"): 3, (None, None, "cc cc"): 1,
        ("y", 1, "aa"): 1, ("y", 1, "bb"): 3, ("y", 1, "aa bb"): 1, ("y", 1, "bb bb"): 2,
    }
    alone = tfidf.term_counts(spark.createDataFrame(rows[-200:], "language string, doc_id long, text string"))
    assert alone.rdd.getNumPartitions() == math.ceil(200 * 5 / 64)
    assert alone.count() == 600


def test_rows_of_terms_as_a_matrix():
    used, dense = vectors._dense(pd.Series([np.array([7, 2]), np.array([2, 2])]), pd.Series([np.array([1.0, 2.0]), np.array([3.0, 4.0])]))
    assert used.tolist() == [2, 7] and dense.tolist() == [[2.0, 1.0], [7.0, 0.0]]


def test_svd_and_vectors_against_numpy(spark):
    df, _ = docs(spark)
    vocab, weights = tfidf.fit(df)
    k = 5
    values = {(r.language, r.component): r.singular_value for r in vectors.svd_energy(weights, vocab, k).collect()}
    found = {(r.language, r.doc_id): np.array(r.vector) for r in vectors.vectorize(df, vocab, weights, k).collect()}
    assert not found["x", 99].any()
    for lang in "xy":
        table = weights.where(F.col("language") == lang).toPandas().pivot(index="doc_id", columns="term", values="weight").fillna(0)
        u, s, _ = np.linalg.svd(table.to_numpy(), full_matrices=False)
        assert [values[lang, i + 1] for i in range(k)] == pytest.approx(list(s[:k]))
        scores = u[:, :k] * s[:k]
        scores /= np.linalg.norm(scores, axis=1, keepdims=True)
        ours = np.array([found[lang, i] for i in table.index])
        # Directions may point either way; inner products do not change.
        assert ours @ ours.T == pytest.approx(scores @ scores.T, abs=1e-8)


@pytest.mark.parametrize("kept, recounted", [(3, True), (400, False)])
def test_vocabulary_without_the_rare_terms_of_a_slice_is_exact(spark, monkeypatch, kept, recounted):
    """Rare terms do not leave their task, and documents are weighed where they are cut up: no join, nothing gathered."""
    monkeypatch.setattr(tfidf, "WORDS", 200)
    monkeypatch.setattr(tfidf, "RARE", 40)
    asked = []
    known = tfidf._counted_known
    monkeypatch.setattr(tfidf, "_counted_known", lambda *a: asked.append(1) or known(*a))
    rng = np.random.default_rng(6)
    common, odd = ["red", "blue", "green"], [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(common if rng.random() < 0.7 else odd) for _ in range(30)) for _ in range(60)]
    rows = [(lang, i, t) for lang in "xy" for i, t in enumerate(texts)]
    rows += [("x", 7, "green green"), ("x", None, "blue red"), ("x", None, "red"), ("x", 900, None), (None, 1, "red red"), ("y", 901, "")]
    df = spark.createDataFrame(rows, "language string, doc_id long, text string").repartition(3)
    vocab, weights = tfidf.fit(df, min_df=3, max_features=kept)
    expected = tfidf.vocabulary(tfidf.term_counts(df), df, 3, kept)
    assert sorted(vocab.collect()) == sorted(expected.collect())
    assert bool(asked) == recounted
    whole = {(r.language, r.doc_id, r.term): r for r in tfidf.transform(tfidf.term_counts(df), expected).collect()}
    got = {(r.language, r.doc_id, r.term): r for r in weights.collect()}
    assert got.keys() == whole.keys() and all(got[k].tf == whole[k].tf and got[k].weight == pytest.approx(whole[k].weight, rel=1e-12) for k in whole)
    alone = tfidf.fit(df.where("doc_id < 7 and language is not null"), min_df=3, max_features=kept)[1]
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_sums_of_a_pass_do_not_grow_with_the_rows(spark):
    """Rows travel as packs of bytes, read by one task per core, and each pass sends one sum per task."""
    rng = np.random.default_rng(3)
    matrix = np.where(rng.random((700, 40)) < 0.2, rng.random((700, 40)), 0.0)
    rows = [("xy"[i % 2], i, [int(j) for j in np.flatnonzero(r)], [float(v) for v in r[r != 0]]) for i, r in enumerate(matrix)]
    df = spark.createDataFrame(rows, "language string, doc_id long, positions array<int>, values array<double>")
    packs = write_through(vectors._packed(df.repartition(30)).repartition(30))
    assert packs.count() <= 60
    model = rng.standard_normal((40, 5))
    got = vectors._gram_times(packs, {"x": model, "y": model})
    for k, part in (("x", matrix[::2]), ("y", matrix[1::2])):
        assert got[k] == pytest.approx(part.T @ (part @ model))


def test_normalize_keeps_zero(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(vectors.l2_normalize("v")).collect()] == [[0.6, 0.8], [0.0, 0.0]]


# --- density clusters against a plain top-down version ------------------------------------

def brute_labels(x, min_cluster_size, min_samples):
    """All distances, the tree by Kruskal with ties in order of the ends, then the cut from the top."""
    n = len(x)
    square = np.zeros((n, n))
    for column in x.T:
        square += (column[:, None] - column[None]) ** 2
    d = np.sqrt(square)
    core = np.sort(d, axis=1)[:, min_samples]
    m = np.maximum(d, np.maximum(core[:, None], core[None]))
    comp, tree = list(range(n)), []
    for w, a, b in sorted((m[a, b], a, b) for a in range(n) for b in range(a + 1, n)):
        if comp[a] != comp[b]:
            tree.append((w, a, b))
            old, new = comp[b], comp[a]
            comp = [new if c == old else c for c in comp]

    def parts(nodes, edges):
        cut = max(edges)
        rest = [e for e in edges if e is not cut]
        near = {v: [] for v in nodes}
        for e in rest:
            near[e[1]].append(e[2])
            near[e[2]].append(e[1])
        seen, stack = {cut[1]}, [cut[1]]
        while stack:
            for v in near[stack.pop()]:
                if v not in seen:
                    seen.add(v)
                    stack.append(v)
        left = [v for v in nodes if v in seen]
        right = [v for v in nodes if v not in seen]
        return cut[0], [(p, [e for e in rest if e[1] in set(p)]) for p in (left, right)]

    def grow(nodes, edges, birth):
        """Stability of the cluster and the best choice at or below it."""
        members, stability = list(nodes), 0.0
        while True:
            if not edges:
                return 0.0, [members]
            w, pieces = parts(nodes, edges)
            lam = 1 / max(w, 1e-12)
            big = [p for p in pieces if len(p[0]) >= min_cluster_size]
            if len(big) == 2:
                stability += len(nodes) * (lam - birth)
                below = [grow(p, e, lam) for p, e in big]
                total = sum(s for s, _ in below)
                if stability >= total:
                    return stability, [members]
                return total, [c for _, cs in below for c in cs]
            if not big:
                return stability + len(nodes) * (lam - birth), [members]
            stability += (len(nodes) - len(big[0][0])) * (lam - birth)
            nodes, edges = big[0]

    nodes, edges, chosen = list(range(n)), tree, []
    while edges:  # the root itself is never chosen
        w, pieces = parts(nodes, edges)
        big = [p for p in pieces if len(p[0]) >= min_cluster_size]
        if len(big) == 2:
            chosen = [c for p, e in big for c in grow(p, e, 1 / max(w, 1e-12))[1]]
            break
        if not big:
            break
        nodes, edges = big[0]
    labels = np.full(n, -1)
    for i, members in enumerate(sorted(chosen, key=lambda c: (-len(c), min(c)))):
        labels[members] = i
    return labels


def clouds(seed):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(c, s, (n, 4)) for c, s, n in ((0, 0.4, 40), (4, 0.6, 30), (4.9, 0.3, 25), (-5, 1.0, 35))] + [rng.uniform(-9, 9, (20, 4))])
    return x[rng.permutation(len(x))]


@pytest.fixture(scope="module")
def built(spark):
    """All data sets as languages of one run: clouds, many cells, copies, tiny groups."""
    rng = np.random.default_rng(8)
    data = {f"s{seed}": clouds(seed) for seed in (1, 2, 3)}
    data["cells"] = np.vstack([rng.normal(c, 0.5, (150, 6)) for c in rng.uniform(-6, 6, (5, 6))])
    # A good half are copies of one vector.
    data["copies"] = np.vstack([np.zeros((40, 2)), rng.normal(5, 0.3, (30, 2)), rng.uniform(20, 90, (5, 2))])
    data["few"] = np.arange(8.0).reshape(4, 2)
    data["single"] = np.ones((1, 2))
    data["same"] = np.ones((2, 2))
    df = spark.createDataFrame([(k, i, [float(v) for v in r]) for k, x in data.items() for i, r in enumerate(x)], VECTORS)
    points = write_through(density.distinct_points(df.repartition(6)))
    # Small blocks, so that blocks and crowded cells of every kind come about.
    layout = neighbors.lay_out(points, block=100)
    near = neighbors.nearest_neighbors(layout, 3)
    cores = write_through(neighbors.core_distances(points, near, 3))
    return data, points, layout, near, cores, neighbors.spanning_tree(layout, near, cores)


def labels_of(built, per_step=density.EDGES_PER_STEP):
    _, points, _, _, cores, tree = built
    return {(r.language, r.pid): r.cluster_id for r in density.label_points(points, cores, tree, 10, per_step).collect()}


def test_density_clusters_against_plain_version(built):
    data, labels = built[0], labels_of(built)
    for k in ("s1", "s2", "s3", "cells"):
        assert [labels[k, i] for i in range(len(data[k]))] == list(brute_labels(data[k], 10, 3)), k
    assert max(labels.values()) >= 2


def test_hierarchy_in_steps_gives_the_same_clusters(built):
    assert labels_of(built, per_step=300) == labels_of(built)


def test_copies_and_tiny_groups(built):
    labels = labels_of(built)
    assert labels["copies", 0] == 0 and not any(("copies", i) in labels for i in range(1, 40))
    assert {labels["copies", i] for i in range(40, 70)} == {1}
    assert {labels["copies", i] for i in range(70, 75)} == {-1}
    assert {v for (k, _), v in labels.items() if k in ("few", "single", "same")} == {-1}


def test_neighbors_and_tree_across_many_cells(built):
    data, _, layout, near, cores, tree = built
    x = data["cells"]
    assert len(layout.pivots["cells"]) > 5
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    got = {}
    for r in near.where("language = 'cells'").collect():
        got.setdefault(r.pid, []).append(r.d)
    assert all(sorted(got[i]) == pytest.approx(list(np.sort(d[i])[1:4])) for i in range(len(x)))
    core = np.sort(d, axis=1)[:, 3]
    found = {r.pid: r.core for r in cores.where("language = 'cells'").collect()}
    assert [found[i] for i in range(len(x))] == pytest.approx(list(core))
    m = np.maximum(d, np.maximum(core[:, None], core[None]))
    inside, best, total = np.zeros(len(x), bool), np.full(len(x), np.inf), 0.0
    best[0] = 0
    for _ in range(len(x)):
        i = np.where(inside, np.inf, best).argmin()
        total += best[i]
        inside[i] = True
        best = np.minimum(best, m[i])
    n, weight = tree.where("language = 'cells'").agg(F.count("*"), F.sum("w")).first()
    assert n == len(x) - 1 and weight == pytest.approx(total)


def test_more_listed_neighbours_give_the_same_tree_and_leave_few_points_to_ask(built, monkeypatch):
    data, points, layout, _, cores, tree = built
    seen = []
    monkeypatch.setattr(density, "nearest_neighbors", lambda _, k: seen.append(k) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        density.density_clusters(points.select("language", F.col("pid").alias("doc_id"), "vector"))
    near = neighbors.nearest_neighbors(layout, seen[0])
    wide = write_through(neighbors.core_distances(points, near, 3, seen[0]))
    core = lambda table: {(r.language, r.pid): r.core for r in table.collect()}
    assert core(wide) == core(cores)
    assert sorted(neighbors.spanning_tree(layout, near, wide).collect()) == sorted(tree.collect())
    found = wide.where("language = 'cells'").agg(F.count_if(F.col("reach") <= F.col("core") * 1.1), F.count("*")).first()
    assert found[0] < found[1] / 4  # with as many as core distances need, all of them


def test_blocks_of_a_shelf_are_searched_together_and_exactly(spark):
    rng = np.random.default_rng(11)
    data = rng.standard_normal((1500, 24))
    data[700:720] = 1e4 + 1e-6 * data[700:720]  # near each other, far from the origin
    rows = [("flat", i, v.tolist(), 1) for i, v in enumerate(data)]
    points = write_through(spark.createDataFrame(rows, "language string, pid long, vector array<double>, mult long"))
    layout = neighbors.lay_out(points, block=50)
    shelves = layout.blocks.select("shelf").distinct().count()
    assert 8 <= shelves <= 16 < layout.blocks.count()
    near = neighbors.nearest_neighbors(layout, 4)
    d = np.sqrt(((data[:, None] - data[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    got = {}
    for r in near.collect():
        got.setdefault(r.pid, []).append((r.d, r.nbr))
    assert all([n for _, n in sorted(got[i])] == np.argsort(d[i], kind="stable")[:4].tolist() for i in range(len(data)))
    cores = write_through(neighbors.core_distances(points, near, 4))
    core = np.array([r.core for r in cores.orderBy("pid").collect()])
    w = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    best, total, inside = w[0].copy(), [], np.zeros(len(data), bool)
    inside[0] = True
    for _ in range(len(data) - 1):
        to = np.where(inside, np.inf, best).argmin()
        total.append(best[to])
        inside[to], best = True, np.minimum(best, w[to])
    tree = [r.w for r in neighbors.spanning_tree(layout, near, cores).collect()]
    assert sorted(tree) == pytest.approx(sorted(total))


def test_clustering_can_be_switched_off(spark):
    df = spark.createDataFrame([("x", 1, [1.0])], VECTORS)
    assert density.density_clusters(df, method="none").first().cluster_id == 0


def test_svd_runs_until_it_is_steady_and_restarts_its_space(spark, monkeypatch):
    import numpy as np

    from qaspark.operators import vectors

    monkeypatch.setattr(vectors, "_MOST_BLOCKS", 3)
    rng = np.random.default_rng(5)
    matrix = np.where(rng.random((260, 180)) < 0.15, rng.random((260, 180)), 0.0) @ np.diag(1.0 / np.sqrt(1 + np.arange(180)))
    rows = [("x", i, [int(j) for j in np.flatnonzero(r)], [float(v) for v in r[r != 0]]) for i, r in enumerate(matrix)]
    df = spark.createDataFrame(rows, "language string, doc_id long, positions array<int>, values array<double>")
    found, directions = vectors.truncated_svd(df, {"x": 180}, k=5)["x"]
    exact = np.linalg.svd(matrix, compute_uv=False)[:5]
    assert np.abs(found - exact).max() <= 1e-6 * exact[0]
    assert np.abs(directions.T @ directions - np.eye(5)).max() < 1e-8


# --- the hierarchy over trees of any shape and with ties ----------------------------------


SHAPES = {"chain": "id - 1", "star": "0L", "random": "pmod(xxhash64(id), id)"}


def tree_tables(spark, n, shape, lengths):
    """Points 0 to n - 1 of one language, core distances and a tree, made from row numbers alone."""
    language = F.lit(f"{shape} {lengths}").alias("language")
    points = spark.range(n).select(language, F.col("id").alias("pid"), F.lit(1).cast("long").alias("mult"))
    tree = spark.range(1, n).select(language, F.expr(SHAPES[shape]).alias("a"), F.col("id").alias("b"), F.expr(lengths).cast("double").alias("w"))
    return points, points.withColumn("core", F.lit(1.0)).drop("mult"), tree


def test_hierarchy_with_ties_is_the_same_in_any_number_of_steps(spark):
    mixed = "1 + pmod(xxhash64(id, 5), 40) * pmod(xxhash64(id), 7)"
    kinds = [("chain", "1"), ("star", "1"), ("random", "1"), ("random", "1 + id % 3"), ("chain", mixed)]
    parts = [tree_tables(spark, 300, *k) for k in kinds]
    points, cores, tree = (write_through(functools.reduce(lambda x, y: x.union(y), p)) for p in zip(*parts))

    def outcome(per_step):
        return {(r.language, r.pid): r.cluster_id for r in density.label_points(points, cores, tree, 10, per_step).collect()}

    whole = outcome(10_000)
    assert outcome(120) == whole and len(set(whole.values())) > 2


def test_hierarchy_of_a_million_points_of_one_language_and_length(spark):
    """A task refuses more than ``per_step`` edges, so this passes only in bounded memory."""
    points, cores, tree = tree_tables(spark, 1_000_000, "random", "1")
    labels = write_through(density.label_points(points, cores, tree, 25, 400_000))
    assert labels.count() == 1_000_000 and labels.agg(F.count_distinct("pid")).first()[0] == 1_000_000


def test_components(spark):
    from qaspark.operators.components import connected

    rng = np.random.default_rng(4)
    links = [(k, int(a), int(b)) for k in "pq" for a, b in rng.integers(0, 300, (220, 2))] + [("p", i, i + 1) for i in range(1000, 1400)] + [("p", 2000, i) for i in range(2001, 2200)]
    got = {(r.k, r.node): r.root for r in connected(spark.createDataFrame(links, "k string, a long, b long"), ["k"]).collect()}
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for k, a, b in links:
        if a != b:
            up[top((k, a))] = top((k, b))
    assert set(got) == set(up)
    names = {}
    for node, root in got.items():
        assert names.setdefault(top(node), root) == root
    assert len(set(names.values())) <= len(names) and len({(k, r) for (k, _), r in got.items()}) == len(names)
