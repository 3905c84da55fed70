import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelflow import operators as O
from labelflow.operators import vectors as V

TEXTS = ["red fox runs", "Red red RED", "", "blue sky, blue sea", None, "fox and sky"]


def embed_by_hand(texts, dim):
    counts = np.zeros((len(texts), dim))
    for i, text in enumerate(texts):
        for w in re.findall(r"\w+", (text or "").lower()):
            counts[i, int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim] += 1
    weights = np.log((len(texts) + 1.0) / ((counts > 0).sum(axis=0) + 1.0)) * (counts.sum(axis=0) > 0)
    x = counts * weights
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def test_embed_text(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3)
    rows = O.embed_text(df, "text", 16).orderBy("id").collect()
    assert np.allclose([r["vector"] for r in rows], embed_by_hand(TEXTS, 16), atol=1e-6)


def test_clusters_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(0)
    rows = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))]
    # a third of the rows are one point
    rows += [(1000 + i, [1.0] + [0.0] * 7) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, vector array<double>")
    got = []
    for n in (1, 4, 7):
        out = O.cluster_vectors(df.repartition(n), "id", "vector", 5, iterations=6)
        got.append([tuple(r) for r in out.select("id", "cluster_id").orderBy("id").collect()])
    assert got[0] == got[1] == got[2]
    assert len({c for _, c in got[0]}) == 5
    assert len({c for i, c in got[0] if i >= 1000}) == 1


def test_cluster_edge_cases(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, None)], "id int, vector array<double>")
    assert {r["id"]: r["cluster_id"] for r in O.cluster_vectors(df, "id", "vector", 3).collect()} == {0: 0, 1: -1}
    empty = O.cluster_vectors(df.filter("id > 5"), "id", "vector", 3)
    assert empty.count() == 0
    assert O.cluster_vectors(df.filter("vector IS NULL"), "id", "vector", 2).first()["cluster_id"] == -1


def test_cluster_ml(spark):
    df = spark.createDataFrame([(i, [float(i % 2), float(1 - i % 2)]) for i in range(10)], "id int, vector array<double>")
    out = O.cluster_ml(df, "vector", 2)
    assert out.groupBy("cluster_id").agg(F.count("*")).count() == 2
    x, df = points(spark, seed=5)
    own = {r["id"]: r["cluster_id"] for r in O.cluster_ml(df, "vector", 6).collect()}
    groups = {c: x[[i for i in range(400) if own[i] == c]] for c in set(own.values())}
    middle = {c: g.mean(axis=0) for c, g in groups.items()}
    for i, c in own.items():  # every row is with the nearest mean
        assert c == min(middle, key=lambda m: ((x[i] - middle[m]) ** 2).sum())


def points(spark, n=400, k=6, dim=5, seed=1, zero=0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(k, dim)) * 4
    x = middle[rng.integers(0, k, n)] + 0.3 * rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(n + i, None) for i in range(zero)], "id bigint, vector array<double>")


def cost(x, centres):
    return ((x[:, None, :] * V.UNIT - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_seeds_lie_in_the_clumps_and_do_not_depend_on_partitions(spark):
    x, df = points(spark, zero=3)
    seeds = O.seed_parallel(df, "id", "vector", 6)
    assert seeds.shape == (6, 5) and np.array_equal(seeds, O.seed_parallel(df.repartition(7), "id", "vector", 6))
    random_start = V._seed_centres(df.filter("vector IS NOT NULL"), "id", "vector", 6, 42)
    assert cost(x, seeds) < cost(x, random_start)
    same = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(50)] + [(99, [0.0, 1.0])], "id bigint, vector array<double>")
    assert len(O.seed_parallel(same, "id", "vector", 6)) == 2
    assert len(O.seed_parallel(df.limit(0), "id", "vector", 6)) == 0


@pytest.mark.parametrize("start", ["hash", "parallel"])
def test_clusters_at_rest(spark, start, monkeypatch):
    x, df = points(spark, zero=2)
    found = O.fit_clusters(df, "id", "vector", 6, start=start)
    assert found.converged and found.rounds < 100
    fixed = np.rint(x * V.UNIT)
    own = ((fixed[:, None, :] - found.centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    got = {r["id"]: r["cluster_id"] for r in found.rows.collect()}
    assert [got[i] for i in range(400)] == own.tolist() and got[400] == -1
    for c in range(6):  # at rest: every centre is the mean of its rows
        assert np.array_equal(found.centres[c], np.floor(fixed[own == c].mean(axis=0) + 0.5))
    monkeypatch.setattr(V, "GUESS_FROM", 2)  # rows near their guess are skipped: same centres
    again = O.fit_centres(df, "id", "vector", 6, start=start)
    assert np.array_equal(again.points, found.centres) and again.rounds == found.rounds


def test_given_centres_and_empty_clusters(spark):
    x, df = points(spark, k=3)
    far = np.rint(np.array([x[0], -x[0] * 50, -x[0] * 60]) * V.UNIT)  # no row is nearest to the last two
    found = O.fit_clusters(df, "id", "vector", 3, start=far)
    assert found.converged and len(set(r["cluster_id"] for r in found.rows.collect())) == 3
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id bigint, vector array<double>")
    assert O.fit_centres(two, "id", "vector", 3, start=np.eye(3, 2) * V.UNIT).converged  # fewer rows than centres
    stopped = O.fit_centres(df, "id", "vector", 3, iterations=1)
    assert not stopped.converged and stopped.rounds == 1
