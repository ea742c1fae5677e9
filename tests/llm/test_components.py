"""Components of link tables against a plain search."""

import numpy as np
import pytest

from netstream.llm import components as C


def plain(pairs):
    head = {x: x for p in pairs for x in p if p[0] != p[1]}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a != b and head[a] != head[b]:
                head[a] = head[b] = min(head[a], head[b])
                changed = True
    return head


def links_df(spark, pairs, partitions=5):
    return spark.createDataFrame(pairs, C.LINKS).repartition(partitions)


rng = np.random.default_rng(5)
SHAPES = {
    "none": [],
    "loops": [(3, 3), (7, 7)],
    "chain": [(i, i + 1) for i in range(60)],
    "leader_in_the_middle": [(500, i) for i in range(1000) if i != 500],
    "repeated": [(1, 2), (2, 1), (1, 2), (2, 2), (9, -4), (-(1 << 63), 9)],
    "random": [tuple(map(int, p)) for p in rng.integers(0, 400, (260, 2))],
}


@pytest.mark.parametrize("name", list(SHAPES))
@pytest.mark.parametrize("joined", [3, 1_000_000])
def test_components_against_plain(spark, monkeypatch, name, joined):
    monkeypatch.setattr(C, "JOINED", joined)
    pairs = SHAPES[name]
    got = [(r.id, r.component) for r in C.components(links_df(spark, pairs)).collect()]
    assert len(got) == len(set(got)) and dict(got) == plain(pairs)


@pytest.mark.parametrize("name", list(SHAPES))
def test_least_reachable(name):
    pairs = SHAPES[name]
    a, b = np.array(pairs, np.int64).reshape(-1, 2).T
    ids, least = C.least_reachable(a, b)
    found = {x: y for x, y in plain(pairs).items() if x != y}
    assert dict(zip(ids.tolist(), least.tolist())) == found


def test_known_components_need_no_round(spark, monkeypatch):
    """Links that already lead to the heads are written once; a large group whose
    members were compared with one leader takes one round."""
    written = []
    monkeypatch.setattr(C, "cut_lineage", lambda df, name, f=C.cut_lineage: written.append(name) or f(df, name=name))
    C.components(links_df(spark, [(i, i % 3) for i in range(3, 300)]))
    assert written == ["links"]
    written.clear()
    C.components(links_df(spark, SHAPES["leader_in_the_middle"]))
    assert len(written) <= 3
