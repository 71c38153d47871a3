"""Vector links against all pairs."""

import compare
import duckdb
import helpers
import numpy as np
import pandas as pd
import pytest
from conftest import MEDIUM

from eventmill.llm import vectors
from eventmill.llm.oracle import ORACLES
from eventmill.llm.queries import QUERIES


def clustered(n=700, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for i in range(0, n - 3, 4):  # close pairs, at and around the threshold
        x[i + 1] = x[i] + rng.standard_normal(dim) * rng.choice([0.02, 0.2, 0.3]) * 1.0
    x[n - 1] = x[0] * 2
    return x


def plain(x, cosine):
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = y @ y.T >= cosine
    np.fill_diagonal(near, False)
    return near


def table(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame(pd.DataFrame({"vec_id": list(ids), "embedding": [list(map(float, v)) for v in x]}), "vec_id long, embedding array<double>")


@pytest.mark.parametrize("cell, block", [(128, 512), (8, 5)])
def test_all_links(spark, monkeypatch, cell, block):
    """Also with small cells, and with cells cut into blocks."""
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    x = clustered()
    near = plain(x, vectors.COSINE)
    got = {r.vec_id: r for r in vectors.near_vectors(table(spark, x)).collect()}
    found = sum(r.n_links for r in got.values())
    assert near.sum() * 0.97 <= found <= near.sum()
    assert all(r.n_links <= near[i].sum() for i, r in got.items())
    if found == near.sum():
        smallest = helpers.components(range(len(x)), lambda a, b: near[a, b])
        assert {i: r.component_id for i, r in got.items()} == smallest
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_dense_group(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rng = np.random.default_rng(1)
    x = np.vstack([rng.standard_normal(16) + rng.standard_normal((300, 16)) * 1e-3, rng.standard_normal((50, 16))])
    near = plain(x, vectors.COSINE)
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(table(spark, x)).collect()}
    assert got == {i: int(near[i].sum()) for i in range(len(x))}


def test_awkward_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
            (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1e300, 1e290]), (None, [1.0, 0.0]), (11, [-1.0, -0.0])]
    docs = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, id int, cells string")
    got = helpers.by_id((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(docs).collect())
    assert got == helpers.by_id([(None, 0, None), (1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8),
                                 (9, 0, 9), (10, 3, 1), (11, 0, 11)])
    assert vectors.near_vectors(docs.limit(0)).collect() == []


def test_sql(spark):
    name = "op8_near_vectors"
    assert compare.spark_rows(QUERIES[name](spark, MEDIUM)) == compare.sql_rows(compare.connection(MEDIUM), ORACLES[name])


def test_sql_on_links(spark, tmp_path):
    """The SQL against a table with links, which the small tables lack."""
    near = plain(clustered(60), vectors.COSINE)
    table(spark, clustered(60)).coalesce(1).write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{next((tmp_path / 'e').glob('*.parquet'))}'")
    rows = {r[3]: r for r in compare.sql_rows(con, ORACLES["op8_near_vectors"])[1]}
    assert {i: r[2] for i, r in rows.items()} == {i: int(near[i].sum()) for i in range(60)} and near.any()
    assert {i: r[0] for i, r in rows.items()} == helpers.components(range(60), lambda a, b: near[a, b])


def test_calibration():
    """Enough collisions for pairs at the threshold, and more tables for more cuts."""
    rng = np.random.default_rng(0)
    apart = rng.standard_normal((4000, vectors.PROJECTIONS)) * np.sqrt(0.1)
    reached = (np.abs(apart) <= vectors.WIDTH * np.sqrt(0.1)).sum(axis=1) >= vectors.needed_collisions()
    assert reached.mean() > 0.995
    assert [vectors.tables_for(c) for c in (0, 5)] == [1, 6] and vectors.tables_for(10) > vectors.tables_for(8)
