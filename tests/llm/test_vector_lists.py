from __future__ import annotations

import numpy as np
import pytest

from turnstile.llm import vector_lists as vl
from turnstile.llm.queries import QUERIES


def brute(rows, queries, k):
    """(query_id, rank, vec_id, score) of plain (id, vector) rows."""
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], dtype=np.float64)
    found = []
    for query, vector in queries:
        gap = points - np.asarray(vector, dtype=np.float64)
        distance = np.sqrt((gap * gap).sum(axis=1))
        own = ids == query
        order = [i for i in np.lexsort((ids, distance)) if not own[i]][:k]
        found += [(query, rank, int(ids[i]), float(distance[i])) for rank, i in enumerate(order, 1)]
    return found


def recall(found, true):
    return len({(r[0], r[2]) for r in found} & {(t[0], t[2]) for t in true}) / len(true)


def as_frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>").repartition(5)


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_the_query_finds_nearly_all_neighbours(spark, folder):
    folder = f"/root/testdata/{folder}"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    true = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    df = QUERIES["op12_balanced_lists"](spark, folder)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    found = [tuple(r) for r in df.collect()]
    assert recall(found, true) >= 0.95
    exact = {(t[0], t[2]): t[3] for t in brute(rows, [r for r in rows if r[0] % 100 == 0], len(rows))}
    assert all(r[3] == exact[r[0], r[2]] for r in found)
    for query in {r[0] for r in found}:
        mine = sorted(r[1:] for r in found if r[0] == query)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)


def test_clusters_are_found_by_reading_few_lists(spark):
    dice = np.random.default_rng(3)
    centres = dice.normal(size=(40, 16)) * 20
    rows = [(i, centres[i % 40] + dice.normal(size=16)) for i in range(8000)]
    df = as_frame(spark, rows)
    used = vl.usable(df)
    queries = used.where("vec_id % 100 = 0")
    true = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert recall([tuple(r) for r in vl.nearest(used, queries, 10).collect()], true) >= 0.95
    model, dims = vl.model_of(used)
    index = vl.posted(vl.folded(used, 10), model, dims)
    readers = vl.reading(queries, model, dims, vl.measured_ratio(index, model, dims, 10))
    assert 35 <= len(model.centroids) <= 45  # distinct vectors are estimated
    assert readers.selectExpr("avg(size(lists))").first()[0] < 12
    assert index.selectExpr("sum(size(ids))").first()[0] == len(rows)


def test_a_third_of_all_rows_is_one_vector(spark, monkeypatch):
    monkeypatch.setattr(vl, "PART_ROWS", 50)
    monkeypatch.setattr(vl, "PER_LIST", 100)
    dice = np.random.default_rng(4)
    same = dice.normal(size=8)
    rows = [(i, same if i % 3 == 0 else dice.normal(size=8)) for i in range(3000)]
    used = vl.usable(as_frame(spark, rows))
    true = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    found = [tuple(r) for r in vl.nearest(used, used.where("vec_id % 100 = 0"), 10).collect()]
    assert recall(found, true) >= 0.95
    # Of copies the smallest ids come, without the query's own.
    copies = {r[0]: [] for r in found if r[0] % 3 == 0}
    for r in sorted(found):
        if r[0] in copies:
            copies[r[0]].append(r[2:])
    assert all(near == [(i, 0.0) for i in range(0, 33, 3) if i != query][:10] for query, near in copies.items())
    assert vl.folded(used, 10).count() == 2001


def test_rows_that_take_no_part_and_repeated_rows(spark):
    from pyspark.sql import functions as F

    good = [(i, [float(i), 1.0]) for i in range(0, 700, 7)]
    bad = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (6, []), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(good + good[:30] + bad, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("vector", "query", "list", "part", "ids", "lists")})
    used = vl.usable(df)
    found = sorted(tuple(r) for r in vl.nearest(used, used.where("vec_id % 100 = 0"), 10).collect())
    assert found == sorted(brute(good, [r for r in good if r[0] % 100 == 0], 10))


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (5, [1e200, 0.0])]
    used = vl.usable(as_frame(spark, rows))
    found = sorted(tuple(r) for r in vl.nearest(used, used.where("vec_id % 100 = 0"), 10).collect())
    assert [r[:3] for r in found] == [(0, 1, 100), (0, 2, 5), (100, 1, 0), (100, 2, 5)]
    one = vl.usable(as_frame(spark, rows[:1]))
    assert vl.nearest(one, one, 10).collect() == []
    none = vl.usable(as_frame(spark, rows).limit(0))
    empty = vl.nearest(none, none, 10)
    assert empty.collect() == [] and empty.columns == ["query_id", "rank", "vec_id", "score"]


def test_the_walk_finds_the_nearest_centroids():
    dice = np.random.default_rng(6)
    centroids = dice.normal(size=(600, 12))
    model = vl.Model(centroids, vl.linked(centroids, dice), 1.0)
    points = dice.normal(size=(300, 12))
    ids, distances = vl.nearest_centroids(points, model, 10)
    true = np.argsort(vl.squared(points, centroids), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, true, strict=True)]) > 0.97
    assert (np.diff(distances, axis=1) >= 0).all()
    every = vl.lists_within(points[:5], model, 1e9)
    assert [sorted(e) for e in every] == [list(range(600))] * 5


def test_lists_are_balanced():
    dice = np.random.default_rng(7)
    points = np.concatenate([dice.normal(size=(3000, 4)), dice.normal(size=(1000, 4)) * 0.01])
    assert len(vl.halved(points, 37, dice)) == 37
    model = vl.fitted(points, 40)
    sizes = np.bincount([r[0] for r in vl.replicas(points, model)], minlength=40)
    assert sizes.max() < 5 * sizes.mean()
