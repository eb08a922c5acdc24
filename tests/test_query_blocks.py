"""Query sets of more than one block, by brute force."""

import numpy as np

from kalendria.operators import knn


def test_best_neighbour_takes_more_queries_than_one_block(spark):
    m = np.random.default_rng(3).normal(size=(5000, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "event_id long, vec array<double>")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    cos = unit @ unit.T
    np.fill_diagonal(cos, -np.inf)
    got = {r["query_id"]: r["neighbour_id"] for r in knn.best_neighbour(df, df).collect()}
    assert got == dict(enumerate(cos.argmax(axis=1).tolist()))
