import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import edges_df, triangle
from netstream.operators import cluster as C
from netstream.operators import graph as G
from netstream.operators import spectrum as S

TINY = {
    "triangle": (triangle(0), [0, 1.5, 1.5], 2, 1),
    "two_triangles": (triangle(0) + triangle(3), [0, 0, 1.5, 1.5, 1.5, 1.5], 2, 2),
    "three_triangles": (triangle(0) + triangle(3) + triangle(6), [0] * 3 + [1.5] * 6, 3, 3),
    "barbell": (triangle(0) + triangle(3) + [(2, 3)],
                [0, 0.204666, 1.166667, 1.5, 1.5, 1.628667], 2, 2),
    "path4": ([(0, 1), (1, 2), (2, 3)], [0, 0.5, 1.5, 2], 2, 2),
}


@pytest.mark.parametrize("name", list(TINY))
def test_tiny_spectra(spark, name):
    pairs, expect, k_nb, k_sc = TINY[name]
    e = G.canonical_edges(edges_df(spark, pairs))
    n = len(expect)
    spec, vec, info = S.eigenpairs(e, n, which="smallest")
    got = [r.eigenvalue for r in spec.orderBy("pos").collect()]
    np.testing.assert_allclose(got, expect, atol=1e-6)
    # the notebook and script rules on the computed spectrum
    assert S.eigengap_k(spec).first().k == k_nb
    assert S.eigengap_first_peak(spec).first().k == k_sc
    # eigenvectors: L v = lambda v
    lap = {(r.i, r.j): r.v for r in G.normalized_laplacian(e).collect()}
    m = np.zeros((n, n))
    for (i, j), v in lap.items():
        m[i, j] = v
    x = np.zeros((n, n))
    for r in vec.collect():
        x[r.id] = r.features
    np.testing.assert_allclose(m @ x, x * np.array(got)[None, :], atol=1e-6)


def test_largest_eigenvalues(spark):
    e = G.canonical_edges(edges_df(spark, [(0, 1), (1, 2), (2, 3)]))
    spec, _, _ = S.eigenpairs(e, 2, which="largest")
    np.testing.assert_allclose([r.eigenvalue for r in spec.orderBy("pos").collect()], [1.5, 2.0],
                               atol=1e-6)


@pytest.mark.parametrize("values,k_nb,k_sc", [
    ([0.5], 1, None), ([0, 0.3], 1, None), ([0, 0.1, 0.2, 0.9, 1.0], 3, 3), ([0, 1, 3, 6], 2, None)])
def test_eigengap_rules(spark, values, k_nb, k_sc):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "pos INT, eigenvalue DOUBLE")
    assert S.eigengap_k(df).first().k == k_nb
    assert S.eigengap_first_peak(df).first().k == k_sc


def test_eigengap_empty_gives_no_row(spark):
    df = spark.createDataFrame([], "g INT, pos INT, eigenvalue DOUBLE")
    assert S.eigengap_k(df, group=["g"]).count() == 0


def test_eigengap_sorts_and_groups(spark):
    rows = [(1, 0.9), (1, 0.0), (1, 1.0), (1, 0.1), (1, 0.2), (2, 0.5)]
    df = spark.createDataFrame(rows, "g INT, eigenvalue DOUBLE")
    got = {r.g: r.k for r in S.eigengap_k(df, group=["g"], sort=True).collect()}
    assert got == {1: 3, 2: 1}


def planted(layout="unequal"):
    blocks = [(0, 40), (40, 120)] if layout == "unequal" else [(0, 60), (60, 120)]
    pairs = []
    for a, b in blocks:
        for i in range(a, b):
            for j in range(i + 1, b):
                if (7 * i + 3 * j) % 4 != 0:
                    pairs.append((i, j))
    return pairs + [(0, 60), (5, 77)], blocks


def _same_partition(labels, blocks):
    groups = [{labels[i] for i in range(a, b)} for a, b in blocks]
    return all(len(g) == 1 for g in groups) and groups[0] != groups[1]


def test_planted_partition_spectral(spark):
    pairs, blocks = planted("unequal")
    e = G.canonical_edges(edges_df(spark, pairs))
    spec, vec, info = S.eigenpairs(e, 3, which="smallest", tol=1e-7)
    lam = [r.eigenvalue for r in spec.orderBy("pos").collect()]
    dense = np.linalg.eigvalsh(__import__("test_graph").dense_laplacian(pairs, 120))
    np.testing.assert_allclose(lam, dense[:3], atol=1e-6)
    sign = {r.id: r.features[1] > 0 for r in vec.collect()}
    assert _same_partition(sign, blocks)
    km = {r.id: r.cluster for r in C.kmeans_clusters(vec, 2, n_columns=2, seed=3).collect()}
    assert _same_partition(km, blocks)
    emb = {r.id: r.cluster for r in
           C.kmeans_clusters(C.degree_scaled(vec, e), 2, n_columns=2, seed=3).collect()}
    assert _same_partition(emb, blocks)


def test_planted_partition_pic(spark):
    pairs, blocks = planted("unequal")
    e = G.canonical_edges(edges_df(spark, pairs))
    labels = {r.id: r.cluster for r in C.pic_clusters(e, k=2, max_iter=10).collect()}
    assert len(labels) == 120
    assert _same_partition(labels, blocks)


def test_cluster_tables(spark):
    labels = spark.createDataFrame([(i, i % 3) for i in range(10)], "id LONG, cluster INT")
    sizes = {r.cluster: r.n_nodes for r in C.cluster_sizes(labels).collect()}
    assert sizes == {0: 4, 1: 3, 2: 3}
    mem = C.cluster_members(labels).where(F.col("cluster") == 1).orderBy("member_pos").collect()
    assert [r.id for r in mem] == [1, 4, 7] and [r.member_pos for r in mem] == [0, 1, 2]


def test_stars_converge_and_hubs_are_split(spark):
    """Known spectrum, verified residuals; a hub's column is cut into salts of
    bounded size, and no pass shuffles the matrix."""
    leaves = {0: 300, 1: 40, 2: 7}
    pairs = [(hub, 1000 * (hub + 1) + i) for hub, n in leaves.items() for i in range(n)]
    e = G.canonical_edges(edges_df(spark, pairs))
    for which, value in (("smallest", 0.0), ("largest", 2.0)):
        spec, vec, info = S.eigenpairs(e, 3, which=which, hub_entries=50)
        np.testing.assert_allclose([r.eigenvalue for r in spec.collect()], [value] * 3, atol=1e-6)
        assert max(info["residuals"]) <= 1e-6
        assert all(r.residual <= 1e-5 for r in S.residuals(e, spec, vec).collect())
    salted, columns = S._salted(G.normalized_adjacency(e), 50)
    assert salted.groupBy("j", "s").count().agg(F.max("count")).first()[0] <= 90
    matrix, drop = S.materialize_bucketed(salted, ["j", "s"], 4, "test")
    block = columns.select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        plan = S._multiply(matrix, columns, block, 2, 0.5, 1.0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = lines[scan].index("FileScan")
    above = []
    for line in reversed(lines[:scan]):  # the scan's ancestors up to the join
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            depth = at
            above.append(line)
            if "Join" in line:
                break
    assert "Join" in above[-1] and not any("Exchange" in line for line in above)
    drop()


def test_solver_deletes_the_blocks_it_went_through(spark):
    import os

    from netstream.session import checkpoint_base
    base = os.path.join(checkpoint_base(spark), "netstream")

    def blocks():
        return {d for d in os.listdir(base) if d.startswith("block-")} if os.path.isdir(base) else set()
    before = blocks()
    e = G.canonical_edges(edges_df(spark, [(h, 100 * (h + 1) + i) for h in range(2) for i in range(9)]))
    spec, vec, _ = S.eigenpairs(e, 2)
    assert blocks() <= before and vec.count() == 20
    with pytest.raises(S.NotConverged):
        S.eigenpairs(G.canonical_edges(edges_df(spark, [(i, i + 1) for i in range(60)])), 3, max_rounds=1)
    assert blocks() <= before


def test_solver_raises_when_it_does_not_converge(spark):
    pairs = [(i, i + 1) for i in range(400)]
    with pytest.raises(S.NotConverged):
        S.eigenpairs(G.canonical_edges(edges_df(spark, pairs)), 3, max_rounds=1)


def test_eigengap_empty_ungrouped_gives_no_row(spark):
    df = spark.createDataFrame([], "pos INT, eigenvalue DOUBLE")
    assert S.eigengap_k(df).count() == 0 and S.eigengap_first_peak(df).count() == 0


def test_optimal_cuts_against_all_partitions():
    import itertools
    rng = np.random.default_rng(2)
    for trial in range(30):
        m, k = int(rng.integers(1, 9)), int(rng.integers(1, 5))
        place, count = np.sort(rng.choice(40, m, replace=False)), rng.integers(1, 5, m)

        def cost(ends):
            total = 0.0
            for a, b in zip([0, *ends], ends):
                x, w = place[a:b], count[a:b]
                total += (w * (x - (w * x).sum() / w.sum()) ** 2).sum()
            return total

        best = min(cost([*c, m]) for c in itertools.combinations(range(1, m), min(k, m) - 1))
        got = C.optimal_cuts(place, count, k)
        assert got[-1] == m and len(got) == min(k, m) and abs(cost(got) - best) < 1e-9


def test_interval_clusters_cases(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.1), (3, 5.0), (4, 5.1), (5, 9.9), (6, None)], "id LONG, v DOUBLE")
    got = {r.id: r.cluster for r in C.interval_clusters(df, 3).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 1, 5: 2, 6: None}
    same = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, None)], "id LONG, v DOUBLE")
    assert {r.id: r.cluster for r in C.interval_clusters(same, 3).collect()} == {1: 0, 2: 0, 3: None}
    assert C.interval_clusters(df.limit(0), 3).count() == 0
    few = {r.id: r.cluster for r in C.interval_clusters(df, 20).collect()}
    assert len(set(few.values()) - {None}) <= 5 and few[1] < few[3] < few[5]


def test_power_iteration_stops_as_mllib_does(spark):
    """A graph on which the change settles after a few steps: the vector is that
    of the step at which the rule stops, not of the last one allowed."""
    pairs = [(i, j) for i in range(12) for j in range(i + 1, 12) if (i + j) % 5] + [(0, 12), (12, 13)]
    n = 14
    a = np.zeros((n, n))
    for i, j in pairs:
        a[i, j] = a[j, i] = 1
    w = a / a.sum(1, keepdims=True)
    v = a.sum(1) / a.sum()
    change, steps = np.inf, 0
    for steps in range(1, 200):
        new = w @ v
        new /= new.sum()
        last, change, v = change, np.abs(new - v).sum(), new
        if abs(change - last) <= S.stop_tolerance(n):
            break
    assert 3 < steps < 199
    got = {r.id: r.v for r in S.power_iteration_vector(G.canonical_edges(edges_df(spark, pairs)), 40 if steps < 40 else steps + 20,
                                                       early_stop=True).collect()}
    np.testing.assert_allclose([got[i] for i in range(n)], v, rtol=1e-9)


def test_planted_partition_pic_intervals(spark):
    pairs, blocks = planted("unequal")
    e = G.canonical_edges(edges_df(spark, pairs))
    assert _same_partition({r.id: r.cluster for r in C.pic_interval_clusters(e, 2).collect()}, blocks)


def test_power_iteration_step_neither_sorts_nor_shuffles_the_matrix(spark, monkeypatch):
    """A step reads a row per column and salt (a hub has several) and meets the
    vector in a hash table; the vector is the plain one."""
    plans, pairs = [], [(0, 100 + i) for i in range(300)] + triangle(0) + triangle(7) + [(2, 7), (101, 102)]

    def kept(df, name, f=S.cut_lineage):
        if name == "vector":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString())
        return f(df, name=name)

    monkeypatch.setattr(S, "cut_lineage", kept)
    e = G.canonical_edges(edges_df(spark, pairs))
    got = {r.id: r.v for r in S.power_iteration_vector(e, 6, hub_entries=50, early_stop=True).collect()}
    assert all("SortMergeJoin" not in p and "near" in p for p in plans)
    assert any("ShuffledHashJoin" in p for p in plans)
    ids = sorted(got)
    at = {x: k for k, x in enumerate(ids)}
    a = np.zeros((len(ids), len(ids)))
    for x, y in pairs:
        a[at[x], at[y]] = a[at[y], at[x]] = 1
    v = a.sum(1)
    for _ in range(6):
        v = a @ v / a.sum(1)
    np.testing.assert_allclose([got[x] for x in ids], v / v.sum(), rtol=1e-12)
