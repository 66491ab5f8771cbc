"""Principal components without a covariance matrix."""

import numpy as np
import pytest

from resonara.operators import project as P


def frame(spark, matrix):
    return spark.createDataFrame([(n, [float(v) for v in row]) for n, row in enumerate(matrix)], "item_id long, embedding array<double>").repartition(4)


def test_equals_the_covariance_form(spark):
    rng = np.random.default_rng(3)
    df = frame(spark, rng.normal(size=(200, 64)) * 1.3 ** -np.arange(64) + 5)
    one, other = P.fit_pca(df, 4), P.fit_pca_wide(df, 4)
    assert np.allclose(one.mean, other.mean) and np.allclose(one.explained, other.explained, atol=1e-8)
    assert np.allclose(one.components, other.components, atol=1e-4)


def test_wider_than_a_covariance_matrix_may_be(spark):
    rng = np.random.default_rng(5)
    hidden = rng.normal(size=(3, 20_000))
    rows = rng.normal(size=(60, 3)) * [30, 10, 3] @ hidden + rng.normal(size=(60, 20_000)) * 0.01
    df = frame(spark, rows)
    with pytest.raises(ValueError):
        P.fit_pca(df, 2)
    model = P.fit_pca_wide(df, 2)
    centred = rows - rows.mean(axis=0)
    _, sizes, directions = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs((model.components * directions[:2]).sum(axis=1)), 1, atol=1e-6)
    assert np.allclose(model.explained, (sizes ** 2 / (sizes ** 2).sum())[:2], atol=1e-6)


def test_few_rows_and_dimensions(spark):
    model = P.fit_pca_wide(frame(spark, [[1.0, 2.0], [1.0, 2.0]]), 2)
    assert model.components.shape == (2, 2) and list(model.explained) == [0, 0]
    with pytest.raises(ValueError):
        P.fit_pca_wide(frame(spark, [[1.0]]).limit(0), 1)
