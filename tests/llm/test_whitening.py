"""Whitening against the same computed from whole matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import shared, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, x binary, n long, id long"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(k, v, 1, b"x", 5, 7) for k, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def expected(vectors, counted=True):
    x = np.array([[int(np.floor(64 * c)) + 1000000 for c in v] for v in vectors], object)
    if not counted:
        x = np.array(sorted({tuple(row) for row in x}), object)
    n, sums = len(x), x.sum(0)
    centred = np.array([[float(n * a - s) / n for a, s in zip(r, sums, strict=True)] for r in x])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    return n, sums, values[order], directions[:, order]


@pytest.mark.parametrize("counted", [True, False])
def test_whiten(spark, counted, monkeypatch):
    monkeypatch.setattr(shared, "HOT_ROWS", 50)
    maker = np.random.default_rng(3)
    mix = maker.normal(size=(6, 6))
    vectors = [[float(c) for c in row @ mix] for row in maker.normal(size=(120, 6))]
    vectors += [vectors[0]] * 100 + [[c + 1e-9 for c in vectors[1]]]
    bad = [None, [None] * 6, [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [float("inf")] * 6]
    ids = [*range(len(vectors) - 2), None, None]
    table = frame(spark, vectors + bad, ids + [900 + i for i in range(5)])
    got = whitening.whiten(table, components=4, counted=counted).collect()
    assert len(got) == len(vectors) and sum(r.id is None for r in got) == 2
    n, sums, values, directions = expected(vectors, counted)
    by_id = {r.id: r for r in got}
    for key in range(len(vectors) - 2):
        row = by_id[key]
        x = [int(np.floor(64 * c)) + 1000000 for c in vectors[key]]
        assert row.n == n
        assert int(row.deviation) == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        centred = np.array([float(n * a - s) / n for a, s in zip(x, sums, strict=True)])
        want = centred @ directions[:, :4] / np.sqrt(values[:4])
        assert np.allclose(np.abs(row.whitened), np.abs(want), rtol=1e-7, atol=1e-9)
        assert np.allclose(row.explained, values[:4] / values.sum(), rtol=1e-9)
        assert row.identity_error < 1e-9
    first = {tuple(by_id[k].whitened) for k in (0, 121, 130)}
    assert len(first) == 1


def test_whiten_edges(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [None, [float("nan")]])).collect() == []
    single = whitening.whiten(frame(spark, [[1.0, 2.0]])).collect()
    assert [(r.id, r.n, int(r.deviation), r.whitened, r.identity_error) for r in single] == [
        (0, 1, 0, [], None)
    ]
    # Two lengths, a constant dimension, an empty vector, and entries off any scale.
    table = frame(spark, [[0.0, 5.0], [1.0, 5.0], [3.0], [5.0], [], [1e300, -1e300]])
    found = {r.id: r for r in whitening.whiten(table).collect()}
    assert [found[i].n for i in range(6)] == [3, 3, 2, 2, None, 3]
    assert [abs(round(found[i].whitened[0], 9)) for i in (2, 3)] == [1, 1]
    assert found[4].whitened == [] and found[4].explained == []
    far = [[64 * 0, 320], [64, 320], [2**53, -(2**53)]]
    sums = [sum(c) + 3 * 10**6 for c in zip(*far, strict=True)]
    with_origin = [[c + 10**6 for c in v] for v in far]
    for key, x in ((0, with_origin[0]), (1, with_origin[1]), (5, with_origin[2])):
        assert int(found[key].deviation) == sum(
            (3 * a - s) ** 2 for a, s in zip(x, sums, strict=True)
        )


def test_query(spark, tmp_path):
    from ebbtide.llm.queries import op13_embedding_whitening

    maker = np.random.default_rng(5)
    vectors = maker.normal(size=(90, 40)).tolist()
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op13_embedding_whitening(spark, str(tmp_path))
    assert got.columns[:4] == ["vec_id", "component", "n", "deviation"]
    assert got.count() == 90 * 32
    spread = got.groupBy("component").agg(F.avg(F.col("whitened") ** 2).alias("v")).collect()
    assert all(abs(r.v - 1) < 1e-9 for r in spread)
    assert got.where("identity_error > 1e-9 OR n <> 90").count() == 0
