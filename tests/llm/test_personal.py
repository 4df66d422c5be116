"""The field's marginals against enumeration, and the bounds of its training."""

import itertools

import numpy as np
import pytest

from demandtide.llm import personal


def _exact(score, links, pair):
    """Marginals from all labellings."""
    v, k = personal.potentials(pair), score.shape[1]
    weight = {}
    for labels in itertools.product(range(k), repeat=len(score)):
        weight[labels] = np.exp(sum(score[i, y] for i, y in enumerate(labels)) + sum(v[kind, labels[a], labels[b]] for a, b, kind in links))
    total = sum(weight.values())
    out = np.zeros_like(score)
    for labels, w in weight.items():
        for i, y in enumerate(labels):
            out[i, y] += w / total
    return out


@pytest.mark.parametrize("links, close", [([], 1e-9), ([(0, 1, 0), (1, 2, 0), (2, 3, 0)], 1e-3), ([(0, 3, 1), (1, 3, 2), (2, 3, 1)], 1e-3), ([(0, 1, 0), (1, 2, 0), (2, 3, 0), (0, 3, 1)], 0.12)])
def test_marginals_against_all_labellings(links, close):
    """Exact on chains and trees, near on a chain closed by a skip edge."""
    rng = np.random.default_rng(1)
    for _ in range(5):
        score = rng.normal(size=(4, len(personal.LABELS)))
        pair = np.concatenate([rng.normal(size=len(personal.LABELS) ** 2) * 0.5, np.full(len(personal.LABELS), 1.5), np.full(len(personal.LABELS), 0.7)])
        got, want = personal.beliefs(score, links, pair), _exact(score, links, pair)
        np.testing.assert_allclose(got.sum(1), 1)
        assert np.abs(got - want).max() < close
        if close > 0.01:
            assert (got.argmax(1) == want.argmax(1)).mean() >= 0.75


def test_short_numbers_share_a_potential():
    text = "call 555-1234 now, or 5551234 later, room 12 and 12, id 20240105"
    keys = {text[s:e].strip(): personal.skip_keys(text, s, e) for s, e, _ in personal.mentions(text, [])}
    assert keys["555-1234"] == keys["5551234"] == ("s5551234", "")
    assert personal.skip_keys("12", 0, 2) == ("", "")


def test_training_is_bounded_by_mentions(spark):
    docs = spark.createDataFrame([(i, " ".join(f"+49 30 {1000000 + k}" for k in range(300))) for i in range(5)], "id long, text string")
    rows = personal._training(docs, 3, 40)
    assert len(rows) == 3 and all(len(x) == len(y) == 40 and all(max(e[:2]) < 40 for e in links) for x, y, links in rows)
