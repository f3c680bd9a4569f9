"""Components against union-find, and the shuffles that they and the join take."""

import random

import pytest

from tagfold.llm import graph, jaccard


def _roots(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def _frame(llm, edges):
    return llm.createDataFrame(edges, "a long, b long")


def _cases():
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(40)]
    shuffled = rng.sample(range(-200, 200), 120)
    return {
        "path": path, "path of odd order": list(zip(shuffled, shuffled[1:])), "copies": path[:5] * 3 + [(b, a) for a, b in path[:9]],
        "stars": [(1000 * s + 999, 1000 * s + i) for s in range(4) for i in range(1, 30)] + [(7, 1007)],
        "ring": [(i, (i + 1) % 17) for i in range(17)], "loops": [(3, 3), (4, 5)], "none": [],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(170)],
    }


@pytest.fixture()
def shuffles(monkeypatch):
    """Hash shuffles of the tables that are written, by name."""
    seen = []
    for module in (graph, jaccard):
        def counted(df, name, real=module.written):
            plan = df._jdf.queryExecution().executedPlan().toString()
            seen.extend([name] * plan.count("Exchange hashpartitioning"))
            return real(df, name)
        monkeypatch.setattr(module, "written", counted)
    return seen


@pytest.mark.parametrize("name", _cases())
def test_components_are_those_of_union_find(llm, name):
    edges = _cases()[name]
    got = [tuple(r) for r in graph.components(_frame(llm, edges)).collect()]
    assert sorted(got) == sorted(_roots([e for e in edges if e[0] != e[1]]).items())


@pytest.mark.parametrize("cut", [0, 1, 60, 170])
def test_components_go_on_from_earlier_ones(llm, cut):
    edges = [e for e in _cases()["random"] if e[0] != e[1]]
    first = graph.written(graph.components(_frame(llm, edges[:cut])), "test_roots")
    got = [tuple(r) for r in graph.components(_frame(llm, edges[cut:]), first).collect()]
    assert sorted(got) == sorted(_roots(edges).items())


def test_linked_stars_take_few_shuffles(llm, shuffles):
    graph.components(_frame(llm, _cases()["stars"])).collect()
    assert len(shuffles) <= 3, shuffles


def test_the_join_takes_few_shuffles(llm, documents, shuffles):
    jaccard.joined(documents, 4, 100).collect()
    assert len(shuffles) <= 30, shuffles
