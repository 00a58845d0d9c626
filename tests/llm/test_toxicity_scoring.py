"""The exact cosines of the examples that a text may be near to."""

import numpy as np
from surfrank.llm import toxicity


def test_toxicity_scores_again_by_common_terms_only():
    rng = np.random.default_rng(8)
    vectors = []
    for k in range(300):  # ten terms that many examples have, and many that few have
        at = np.sort(np.concatenate([rng.choice(10, 5, replace=False), 10 + rng.choice(2000, 40, replace=False)]))
        w = rng.random(len(at)) + 0.5
        vectors.append((at, w / np.sqrt(w @ w)))
    index = toxicity.Index(2010, list(range(300)), [k % 2 for k in range(300)], vectors)
    got, dense = list(index.nearest_of(vectors, 9, list(range(300)))), index.weights.T
    assert len(index.query) == len(index.blocks[0]) == 10
    for i, (at, w) in enumerate(vectors):
        s = np.round(dense[:, at] @ w, 12)
        s[i] = 0
        best = np.lexsort((np.arange(300), -s))[:9]
        assert got[i][0].tolist() == best.tolist() and np.allclose(got[i][1], s[best], rtol=0, atol=2e-12)
    assert toxicity._evidence(index, got[:2] + [(np.zeros(0, dtype=np.int64), np.zeros(0))]).to_pylist() == [
        *([{"doc_id": int(i), "toxic": int(i % 2), "cosine": float(c)} for i, c in zip(*near)] for near in got[:2]), []
    ]
