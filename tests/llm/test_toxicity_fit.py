"""op7 and the pipeline: the fit on the driver holds a bounded part of the features at a time."""

import tracemalloc

import numpy as np
import pytest

from fieldstats.llm import toxicity


def _sample(n, each):
    rng = np.random.default_rng(7)
    y = np.stack([np.arange(n) % 3 == 0, np.arange(n) % 2 == 0], axis=1).astype(np.int64)
    rows = []
    for a, b in y:
        own = [rng.integers(0, toxicity.HASHED, each), rng.integers(0, 40, 5 * a), rng.integers(50, 90, 5 * b)]
        rows.append(np.unique(np.concatenate(own)).astype(np.int32))
    return rows, y


def test_fit_does_not_spread_out_all_features_at_once():
    rows, y = _sample(4000, 600)
    tracemalloc.start()
    model = toxicity.Linear(rows, np.zeros((len(rows), 0)), y[:, 1], rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.keep) and peak < 70e6, f"{peak / 1e6:.0f} MB for {sum(map(len, rows))} features"


@pytest.mark.parametrize("part", (1, 100, 5000))
def test_models_are_the_same_for_any_part(part, monkeypatch):
    rows, y = _sample(300, 20)
    rows[5] = np.empty(0, dtype=np.int32)
    folds = np.arange(len(rows)) % toxicity.FOLDS
    models = toxicity.chain_of(rows, y, folds)
    want = toxicity.chained(models, rows)
    monkeypatch.setattr(toxicity, "PART", part)
    again = toxicity.chain_of(rows, y, folds)
    assert len(models[1].keep) and all(np.array_equal(a.keep, b.keep) and np.array_equal(a.weight, b.weight) for a, b in zip(models, again))
    assert np.array_equal(toxicity.chained(again, rows), want)
