"""Recall of planted near pairs where the variance lies in few of many dimensions."""

import numpy as np
import pytest

from millrace.llm import vectors


@pytest.mark.parametrize("dim, axes", [(384, 16), (768, 12), (384, 384)])
def test_near_pairs_meet_in_a_cell(dim, axes):
    dice = np.random.default_rng(axes)
    scale = np.full(dim, 0.02 if axes < dim else 1.0)
    scale[:axes] = 1.0
    first = vectors.unit(dice.normal(size=(6000, dim)) * scale)
    step = vectors.unit(dice.normal(size=(6000, dim)) * scale)
    step = vectors.unit(step - (step * first).sum(axis=1, keepdims=True) * first)
    cosine = dice.uniform(0.93, 0.96, 6000)[:, None]
    second = cosine * first + np.sqrt(1 - cosine**2) * step
    sample = np.concatenate([first, second])[:: max(1, 12_000 * dim // 2_000_000)]
    centres = vectors.spherical_kmeans(sample, 46, 8, 11)
    reach = vectors.reaches(sample, centres, 0.93, vectors.Cells().deviations)
    (home_a, cells_a), (home_b, cells_b) = vectors.visits(first, centres, reach), vectors.visits(second, centres, reach)
    met = [a in cells_j or b in cells_i for a, b, cells_i, cells_j in zip(home_a, home_b, cells_a, cells_b)]
    assert np.mean(met) >= 0.99
    old = 2 * np.sqrt(0.14 / dim) * np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    (home_a, cells_a), (home_b, cells_b) = vectors.visits(first, centres, old), vectors.visits(second, centres, old)
    missed = 1 - np.mean([a in cells_j or b in cells_i for a, b, cells_i, cells_j in zip(home_a, home_b, cells_a, cells_b)])
    print(dim, axes, "met", np.mean(met), "by dimension alone missed", missed)
    assert (missed > 0.02) == (axes < dim)
