"""Distinct ids of documents, by sorting or by a mask."""

import numpy as np
import pytest

from netstream.llm import packing as P


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_distinct_ids(monkeypatch, kind):
    monkeypatch.setattr(P, "SORTED_IDS", 100)
    distinct, rng = P._Distinct(3_000), np.random.default_rng(1)
    for n in (0, 1, 2, 100, 101, 5_000, 3):
        doc = rng.integers(0, 3_000, n).astype(kind)
        got = distinct(doc)
        assert got.dtype == np.int64 and got.tolist() == sorted(set(doc.tolist()))


def test_short_documents_cost_nothing_per_id():
    """Whatever the size of the vocabulary, a short document needs no mask of it."""
    distinct = P._Distinct(1 << 50)
    assert distinct(np.array([7, 1, 7, 65_535], "<u2")).tolist() == [1, 7, 65_535]
