"""Iterated joins: components, entities over several keys, labelled trees."""

import random

import pytest
from pyspark.sql import functions as F

from grafloom.operators import entities, graph, hierarchy


def plain_components(pairs):
    label = {}
    for a, b in pairs:
        label.setdefault(a, a), label.setdefault(b, b)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        u, v = root(a), root(b)
        label[max(u, v)] = min(u, v)
    return {x: root(x) for x in label}


def test_components(spark):
    r = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(400, 400), (7, 3), (3, 7)]
    found = {x["node"]: x["root"] for x in graph.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert found == {k: v for k, v in plain_components(pairs).items() if k != v}
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


def plain_entities(keys, guards):
    nodes = {n for n, _, _ in keys}
    guard = {n: min(g for m, g in guards if m == n and g is not None) for n in nodes if any(m == n and g is not None for m, g in guards)}
    linked = lambda chosen: [(a, b) for a, k, x in chosen for b, l, y in chosen if (k, x) == (l, y) and x]  # noqa: E731, E741
    block = plain_components(linked([k for k in keys if k[0] not in guard])) | {}
    out = {}
    for n in nodes - set(guard):
        mine = {m for m in nodes - set(guard) if block.get(m, m) == block.get(n, n)}
        met = {guard[b] for a, b in linked(keys) if a in mine and b in guard}
        out[n] = (next(iter(met)) if len(met) == 1 else None, len(met) > 1)
    out |= {n: (g, False) for n, g in guard.items()}
    pairs = [(a, b) for a, b in linked(keys) if out[a][0] == out[b][0]]
    root = plain_components(pairs)
    return sorted((n, root.get(n, n), *out[n]) for n in nodes)


def test_entities_over_several_keys(spark):
    keys = [(1, "doi", "x"), (2, "doi", "x"), (2, "title", "t"), (3, "title", "t"), (4, "title", "x"), (5, "doi", None), (6, "doi", "")]
    found = sorted(tuple(r) for r in entities.resolve(spark.createDataFrame(keys, "node int, kind string, key string")).select("node", "entity").collect())
    assert found == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 6)]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_two_taxa_stay_apart(spark, seed):
    r = random.Random(seed)
    keys = [(r.randrange(60), r.choice(["a", "b", "c"]), r.choice([f"v{r.randrange(30)}", None])) for _ in range(110)]
    keys += [(200 + i, "hot", "common") for i in range(40)]  # a key of a third of the nodes
    guards = [(n, r.choice(["t1", "t2", None])) for n in range(0, 60, 3)] + [(205, "t1")]
    k, g = spark.createDataFrame(keys, "node int, kind string, key string"), spark.createDataFrame(guards, "node int, guard string")
    found = sorted(tuple(x) for x in entities.resolve(k, g).select("node", "entity", "guard", "contested").collect())
    assert found == plain_entities(keys, guards)
    assert max(len({x[2] for x in found if x[1] == e and x[2]}) for e in {x[1] for x in found}) == 1
    assert sorted(tuple(x) for x in entities.resolve(k.orderBy(F.rand(5)), g).select("node", "entity", "guard", "contested").collect()) == found


def walk(edges):
    children, parent = {}, {}
    for c, p in edges:
        children.setdefault(p, []).append(c)
        parent[c] = p
    nodes, out, n = {x for e in edges for x in e}, {}, 0
    stack = [(x, 0) for x in sorted(nodes - set(parent), reverse=True)]
    order = []
    while stack:
        x, depth = stack.pop()
        order.append((x, depth))
        stack += [(c, depth + 1) for c in sorted(children.get(x, []), reverse=True)]
    size = {}
    for x, _ in reversed(order):
        size[x] = 1 + sum(size[c] for c in children.get(x, []))
    for n, (x, depth) in enumerate(order):
        out[x] = (n, n + size[x] - 1, depth)
    return out


@pytest.mark.parametrize("rows_a_task", [1_000_000, 20])
def test_intervals_in_rounds_by_the_logarithm_of_the_depth(spark, monkeypatch, rows_a_task):
    r = random.Random(3)
    edges = [(i, i - 1) for i in range(1, 64)] + [(1000 + i, 5) for i in range(200)]  # a chain of 63 edges, a hot parent
    edges += [(2000 + i, 2000 + r.randrange(i)) for i in range(1, 80)] + [(3001, 3000), (3001, 3000)]
    rounds, real = [], hierarchy._doubled
    monkeypatch.setattr(hierarchy, "_doubled", lambda *a, **k: rounds.append(1) or real(*a, **k))
    labels = hierarchy.intervals(spark.createDataFrame(edges, "child int, parent int"), rows_a_task)
    assert {x["node"]: (x["pre"], x["last"], x["depth"]) for x in labels.collect()} == walk(list(dict.fromkeys(edges)))
    assert len(rounds) == 6  # 2^6 steps
    pairs = [(63, 0), (63, 64), (10, 10), (5, 1000), (1000, 5), (1000, 6), (2079, 2000), (3001, 0)]
    want = [True, None, True, False, True, False, True, False]
    tests = hierarchy.ancestor_tests(labels, spark.createDataFrame(pairs, "node int, ancestor int"))
    assert {(x["node"], x["ancestor"]): x["verdict"] for x in tests.collect()} == dict(zip(pairs, want, strict=True))
    assert hierarchy.subtree(labels, 5).count() == 59 + 200 and hierarchy.subtree(labels, 77777).count() == 0


def test_trees_that_are_none(spark):
    frame = lambda rows: spark.createDataFrame(rows, "child int, parent int")
    with pytest.raises(ValueError, match="several parents"):
        hierarchy.intervals(frame([(1, 2), (1, 3)]))
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.intervals(frame([(1, 2), (2, 3), (3, 1)]))
    assert hierarchy.intervals(frame([])).collect() == []
    assert sorted(tuple(x) for x in hierarchy.intervals(frame([(1, 1), (None, 4), (5, None)])).collect()) == [(1, 0, 0, 0)]


def test_nearest_marks(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)], "child int, parent int")
    marks = spark.createDataFrame([(3, True, False), (20, True, None), (50, None, True), (99, True, True)], "node int, a boolean, b boolean")
    found = {x["node"]: tuple(x)[1:] for x in hierarchy.nearest(edges, marks, ["a", "b"]).collect()}
    assert found[0] == (3, 3, 50, 50) and found[3] == (3, 0, 50, 47) and found[4] == (20, 16, 50, 46) and found[21] == (None, None, 50, 29) and found[99] == (99, 0, 99, 0)
    with pytest.raises(RuntimeError, match="longer than 49"):
        hierarchy.nearest(edges, marks, ["a"], 49)


def test_lineage_with_several_parents(spark):
    edges = spark.createDataFrame([("s", "g1"), ("s", "x"), ("x", "f"), ("g1", "f")], "child string, parent string")
    ranks = spark.createDataFrame([("g1", "genus"), ("f", "family")], "node string, rank string")
    assert tuple(graph.lineage(edges, spark.createDataFrame([("s",)], "node string"), ranks).first()) == ("s", "g1", "f")
