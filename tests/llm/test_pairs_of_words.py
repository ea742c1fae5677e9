"""The pairs of all words in the language model."""

import numpy as np
import pytest
from corpus_fixtures import documents  # noqa: F401

from netstream.llm import language_model as L
from netstream.llm.common import keyed_texts

WORDS = [f"w{i}" for i in range(60)]


def _scores(docs, symbols, table_words):
    model, rare = L.fit(keyed_texts(docs.where("doc_id < 100")), symbols=symbols, table_words=table_words)
    return {r.doc_id: r for r in L.score(docs.where("doc_id >= 100"), model, rare).collect()}


@pytest.mark.parametrize("table_words", [8, 1000])
def test_rare_words_know_what_follows_them(documents, table_words):
    """Each word is always followed by the same next one; beyond the symbols, too, its
    order is told from another, whether the words are in the list or not."""
    rng = np.random.default_rng(3)
    train = [(i, " ".join(WORDS[(s + j) % 60] for j in range(20))) for i, s in enumerate(rng.integers(0, 60, 60))]
    chain, mixed = WORDS[5:55], list(rng.permutation(WORDS[5:55]))
    out = _scores(documents([*train, (100, " ".join(chain)), (101, " ".join(mixed)), (102, " ".join(chain))]), 5, table_words)
    assert out[100].score > out[101].score + 20
    assert out[100].base_score == pytest.approx(out[101].base_score) and out[100].n_known == out[101].n_known == 51
    assert out[102].score == out[100].score


def test_predictions_after_a_word_sum_to_one():
    """Tokens that are not learned ask for the probability of each word once."""
    rng = np.random.default_rng(4)
    base = rng.dirichlet(np.ones(40))
    contexts, words = rng.integers(1, 4, 500).astype(np.uint64), rng.choice(40, 500, p=base)
    ask = np.repeat(np.arange(1, 5, dtype=np.uint64), 40)  # the last context was never seen
    context, word = np.append(contexts, ask), np.append(words, np.tile(np.arange(40), 4))
    learned = np.append(np.ones(500, np.uint8), np.zeros(160, np.uint8))
    p, place, at, total = L.seated(context, word.astype(np.uint64), base[word], learned, 4, 4)
    assert np.allclose(p[500:].reshape(4, 40).sum(1), 1) and np.allclose(p[620:], base)
    assert total.tolist() == [*np.bincount(contexts.astype(int))[1:], 0] and (place[at] == context).all()


def test_pairs_that_occur_once_have_one_table():
    word = np.arange(10, dtype=np.uint64)
    p, *_ = L.seated(np.full(10, 7, np.uint64), word, np.full(10, 0.01), np.ones(10, np.uint8), 2, 2)
    assert np.allclose(p, (1 - L.DISCOUNT + (L.STRENGTH + L.DISCOUNT * 10) * 0.01) / (L.STRENGTH + 10))
