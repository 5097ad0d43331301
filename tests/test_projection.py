import numpy as np

from supplyloom.operators.projection import embedding_projection, leading_axes, power_projection


def test_projection_is_pca_of_an_exact_sample(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(60, 5)) * [5, 3, 1, 0.5, 0.1]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, x array<double>")
    rows = embedding_projection(frame, 0.5, seed=1).orderBy("id").collect()
    assert len(rows) == 30
    sample = data[[r.id for r in rows]]
    _, vectors = np.linalg.eigh(np.cov(sample.T))
    got = np.array([[r.x, r.y] for r in rows])
    for axis, vector in enumerate((vectors[:, -1], vectors[:, -2])):
        want = sample @ vector
        assert np.allclose(np.abs(got[:, axis]), np.abs(want), atol=1e-8)


def test_power_projection(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(60, 5)) * [5, 3, 1, 0.5, 0.1] + 7
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, x array<double>")
    rows = power_projection(frame, 5, 0.5, seed=1, steps=200).orderBy("id").collect()
    sample = data[[r.id for r in rows]]
    _, vectors = np.linalg.eigh(np.cov(sample.T))
    for name, vector in (("x", vectors[:, -1]), ("y", vectors[:, -2])):
        vector = vector * np.sign(vector[np.abs(vector).argmax()])
        assert np.allclose([r[name] for r in rows], sample @ vector, atol=1e-6)
    assert all(np.isfinite(a).all() for a in leading_axes(np.zeros((3, 3))))
    assert power_projection(frame.limit(0), 5).count() == 0
