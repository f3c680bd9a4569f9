"""Exact top-k search by cells against scoring every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagfold.operators import topk


def _frame(spark, vecs, name="id", ids=None):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in zip(ids or range(len(vecs)), vecs)]
    return spark.createDataFrame(rows, f"{name} long, vec array<double>")


def _best(scores, k):
    """[(id, score)] of the k best of {id: score}, rounded, ties by id."""
    return sorted(((d, round(s, 6) + 0.0) for d, s in scores.items()), key=lambda x: (-x[1], x[0]))[:k]


def _vectors(kind):
    rng = np.random.default_rng(7)
    if kind == "plane":  # three numbers per item, norms over three orders of magnitude
        return rng.normal(size=(700, 3)) * np.exp(rng.uniform(-3, 4, size=(700, 1)))
    if kind == "copies":  # a third are one vector, zeros and opposite directions
        x = rng.normal(size=(300, 5))
        x[:100] = x[0]
        x[100:110] = 0
        x[110:140] = -x[0] * rng.uniform(0.1, 3, size=(30, 1))
        return np.round(x, 2)
    return rng.normal(size=(6, 4))  # fewer than k


@pytest.mark.parametrize("kind", ["plane", "copies", "few"])
def test_similar_items(spark, kind):
    x = _vectors(kind)
    got = topk.similar_items(_frame(spark, [*x, None]), 10, pivots=12, block=37, group=50).collect()
    n = np.linalg.norm(x, axis=1)
    for i in range(len(x)):
        want = _best({j: float(x[i] @ x[j] / (n[i] * n[j] + 1)) for j in range(len(x)) if j != i}, 10)
        mine = sorted((r.rank, r.other, r.score) for r in got if r.id == i)
        assert [(o, s) for _, o, s in mine] == want, i
        assert [r for r, _, _ in mine] == list(range(1, len(want) + 1))


@pytest.mark.parametrize("kind", ["plane", "copies", "few"])
def test_top_items(spark, kind):
    items, users = _vectors(kind), np.random.default_rng(3).normal(size=(90, _vectors(kind).shape[1]))
    users[:30] = users[0]
    users[30] = 0
    got = topk.top_items(_frame(spark, [*users, None], "q"), _frame(spark, items), 10, pivots=8, block=41, group=20).collect()
    for i, u in enumerate(users):
        want = _best({j: float(u @ v) for j, v in enumerate(items)}, 10)
        assert [(r.id, r.score) for r in sorted((r for r in got if r.q == i), key=lambda r: r.rank)] == want, i


def test_few_pairs_are_scored(spark):
    x = np.random.default_rng(1).normal(size=(3000, 3)) * 5
    index = topk.CellIndex(_frame(spark, x), 10)
    found = index.search(_frame(spark, x[:300], "q"), "damped")
    assert found.count() == 3000
    assert index.pairs_scored() < 0.25 * 300 * 3000


def test_no_cross_join_and_empty_tables(spark):
    empty = _frame(spark, [])
    assert topk.similar_items(empty).count() == 0
    assert topk.top_items(_frame(spark, [], "q"), _frame(spark, [[1.0, 2.0]])).count() == 0
    assert topk.top_items(_frame(spark, [[1.0, 2.0]], "q"), empty).count() == 0
    df = topk.similar_items(_frame(spark, _vectors("plane")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_ids_of_any_type(spark):
    items = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 1.0])], "id string, vec array<double>")
    got = {(r.id, r.rank, r.other) for r in topk.similar_items(items.withColumn("vec", F.col("vec")), 1).collect()}
    assert got == {("a", 1, "b"), ("b", 1, "a"), ("c", 1, "a")}


def test_second_pass_returns_only_what_reaches_the_threshold(spark):
    # at random in many dimensions every cell is visited, but few items matter
    x = np.random.default_rng(5).normal(size=(600, 32))
    index = topk.CellIndex(_frame(spark, x), 10)
    queries = _frame(spark, x, "q")
    open_q = index._scored(index._visits(queries, "damped", True), "damped")
    least = open_q.groupBy("q").agg(F.sort_array(F.collect_list("score"), False)[9].alias("least"))
    again = index._visits(queries.join(least, "q"), "damped", False)
    got = index._scored(again, "damped").join(least, "q")
    assert got.count() > 0
    assert not got.where("score < least").count()
