import gzip
import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from conftest import edges_df, triangle
from netstream.operators import graph as G
from netstream.operators import spectrum as S
from netstream.sources import graph_files as GF


def dense_laplacian(pairs, n):
    a = np.zeros((n, n))
    for i, j in pairs:
        a[i, j] = a[j, i] = 1.0
    d = a.sum(axis=1)
    r = np.where(d > 0, 1 / np.sqrt(np.where(d > 0, d, 1)), 0.0)
    return np.diag((d > 0).astype(float)) - r[:, None] * a * r[None, :]


def test_canonical_edges_and_nodes(spark):
    e = G.canonical_edges(edges_df(spark, [(0, 1), (1, 0), (2, 2), (1, 2), (3, 4)]))
    assert sorted(map(tuple, e.collect())) == [(0, 1), (1, 2), (2, 2), (3, 4)]
    assert sorted(r.id for r in G.graph_nodes(e).collect()) == [0, 1, 2, 3, 4]


def test_degree_counts_self_loop_once(spark):
    e = G.canonical_edges(edges_df(spark, [(0, 1), (1, 1), (1, 2)]))
    deg = {r.id: r.degree for r in G.degrees(e).collect()}
    assert deg == {0: 1.0, 1: 3.0, 2: 1.0}


def test_node_index_dense(spark):
    e = G.canonical_edges(edges_df(spark, [(10, 30), (30, 20), (50, 10)]))
    idx = {r.id: r.idx for r in G.node_index(e).collect()}
    assert idx == {10: 0, 20: 1, 30: 2, 50: 3}


def test_barbell_laplacian_rows(spark):
    pairs = triangle(0) + triangle(3) + [(2, 3)]
    lap = G.normalized_laplacian(G.canonical_edges(edges_df(spark, pairs)))
    m = np.zeros((6, 6))
    for r in lap.collect():
        m[r.i, r.j] = r.v
    np.testing.assert_allclose(m[0], [1, -0.5, -0.408248, 0, 0, 0], atol=1e-6)
    np.testing.assert_allclose(m[2], [-0.408248, -0.408248, 1, -0.333333, 0, 0], atol=1e-6)
    np.testing.assert_allclose(m, dense_laplacian(pairs, 6), atol=1e-12)


def test_laplacian_with_self_loop_matches_dense_rule(spark):
    pairs = [(0, 1), (1, 1), (1, 2)]
    lap = G.normalized_laplacian(G.canonical_edges(edges_df(spark, pairs)))
    m = np.zeros((3, 3))
    for r in lap.collect():
        m[r.i, r.j] = r.v
    a = np.array([[0, 1, 0], [1, 1, 1], [0, 1, 0]], float)
    d = a.sum(1)
    expect = np.eye(3) - a / np.sqrt(np.outer(d, d))
    np.testing.assert_allclose(m, expect, atol=1e-12)


def test_power_iteration_vector_barbell(spark):
    e = G.canonical_edges(edges_df(spark, triangle(0) + triangle(3) + [(2, 3)]))
    one = {r.id: r.v for r in S.power_iteration_vector(e, iterations=1).collect()}
    np.testing.assert_allclose([one[i] for i in range(6)],
                               [0.170455, 0.170455, 0.159091, 0.159091, 0.170455, 0.170455],
                               atol=1e-6)
    ten = {r.id: r.v for r in S.power_iteration_vector(e, iterations=10).collect()}
    np.testing.assert_allclose([ten[i] for i in range(6)], [1 / 6] * 6, atol=1e-6)
    assert abs(sum(ten.values()) - 1) < 1e-12


def test_edge_list_and_csv_scans(spark, tmp_path):
    p = tmp_path / "g.txt.gz"
    with gzip.open(p, "wt") as f:
        f.write("# comment line\n1 2\n2\t3  # trailing\n\n3 1 extra\nx y\n")
    e = GF.read_edge_list(spark, str(p))
    assert sorted(map(tuple, e.collect())) == [(1, 2), (2, 3), (3, 1)]
    named = GF.read_edge_list(spark, str(p), numeric=False)
    ids, nodes = G.index_named_edges(named)
    assert ids.count() == 4 and nodes.count() == 5
    c = tmp_path / "g.csv.gz"
    with gzip.open(c, "wt") as f:
        f.write("1,2\n2,3\n")
    e2 = GF.read_edge_csv(spark, str(c))
    assert sorted(map(tuple, e2.collect())) == [(1, 2), (2, 3)]


def test_edge_list_roundtrip(spark):
    e = G.canonical_edges(edges_df(spark, triangle(0) + [(5, 9)]))
    d = tempfile.mkdtemp(prefix="ns-edges-")
    GF.write_edge_list(e, os.path.join(d, "el"))
    back = G.canonical_edges(GF.read_edge_list(spark, os.path.join(d, "el")))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, e.collect()))
    GF.write_edge_csv(e, os.path.join(d, "csv"))
    back2 = G.canonical_edges(GF.read_edge_csv(spark, os.path.join(d, "csv")))
    assert sorted(map(tuple, back2.collect())) == sorted(map(tuple, e.collect()))


def test_purchase_graph_is_linear_in_lineitem(spark):
    from conftest import SF001
    from netstream.plans.graph_plans import purchase_graph
    from netstream.sources.tables import read_table
    li = read_table(spark, SF001, "lineitem")
    e = purchase_graph(spark, SF001)
    assert e.count() <= li.count()
    assert e.where(F.col("src") > F.col("dst")).count() == 0


def test_csv_rejects_and_short_first_row(spark, tmp_path):
    """Rows with a missing column, text or a fraction are counted; the first row
    of a file does not decide how many columns are read."""
    from netstream.sources import graph_files as GF
    (tmp_path / "a.csv").write_text("1\n2,3,x\n4,5\nx,6\n7,8.5\n,9\n10,11\n")
    kinds = {r["kind"]: r["n"] for r in GF.csv_line_counts(spark, str(tmp_path)).collect()}
    assert kinds == {"edge": 3, "rejected": 4}
    assert sorted(map(tuple, GF.read_edge_csv(spark, str(tmp_path)).collect())) == [(2, 3), (4, 5), (10, 11)]
    third = GF.csv_line_counts(spark, str(tmp_path), 0, 2).collect()
    assert {r["kind"]: r["n"] for r in third} == {"rejected": 7}
