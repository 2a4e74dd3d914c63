import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from grafloom.llm import hard_negatives


def brute(rows, anchor, positives=5, negatives=10, window=(30, 90, 100)):
    ok = {}
    for i, label, x in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(256 * c) for c in x]
        if i not in ok or (label, v) < ok[i]:
            ok[i] = (label, v)
    out = []
    for a, (label, v) in ok.items():
        if not anchor(a):
            continue
        score = sorted((-sum(p * q for p, q in zip(v, w, strict=False)), i) for i, (_, w) in ok.items() if i != a)
        for ps, p in [(-s, i) for s, i in score if ok[i][0] == label][:positives]:
            fits = [(i, -s) for s, i in score if ok[i][0] != label and window[0] * ps <= -window[2] * s <= window[1] * ps]
            out += [(a, p, n + 1, i, ps, s) for n, (i, s) in enumerate(fits[:negatives])]
    return sorted(out)


def random_rows(n, dims, seed, tight=0.0):
    r = np.random.default_rng(seed)
    centre = r.normal(0, 0.2, (4, dims))
    return [(i, int(r.integers(4)), [float(x) for x in np.float32(centre[r.integers(4)] * tight + r.normal(0, 0.12, dims))]) for i in range(n)]


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], "vec_id long, label int, embedding array<float>, v string, block int").repartition(7)
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **more).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize(("dims", "tight"), [(16, 0.0), (7, 1.0)])
def test_matches_brute_force(spark, dims, tight):
    rows = random_rows(700, dims, dims, tight)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert mined(spark, rows) == want


def test_answers_do_not_depend_on_the_codebooks_or_the_passes(spark, monkeypatch):
    rows = random_rows(300, 8, 1)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 4)
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", 32)
    assert mined(spark, rows, most_fitted=3, most_broadcast=8) == brute(rows, lambda i: i % 10 == 0)


def test_ties_copies_and_repeats(spark):
    r = random.Random(2)
    same = [0.25, 0.5, -0.125, 0.75]
    rows = [(i, i % 3, same) for i in range(0, 240)]  # a hot vector: scores tie, ids decide
    rows += [(i, i % 3, [r.uniform(-1, 1) for _ in range(4)]) for i in range(240, 400)]
    rows += [(i, 1, [x * 0.5 for x in same]) for i in range(400, 460)]
    rows += [(10, 2, same), (10, 0, [1.0, 1.0, 1.0, 1.0]), (250, 0, [0.0, 0.0, 0.0, 0.0])]  # repeated ids
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_nulls_infinities_short_and_empty_vectors(spark):
    rows = random_rows(60, 4, 3)
    rows += [(100, None, [1.0] * 4), (101, 1, None), (102, 1, [1.0, None, 1.0, 1.0]), (103, 1, [1.0, float("nan"), 0.0, 0.0]), (104, 1, [float("inf"), 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4), (105, 1, [0.5]), (110, 1, []), (106, 2, [0.3, 0.3])]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0, 2.0])]) == []  # no anchor
    assert mined(spark, [(10, 1, [1.0, 2.0])]) == []  # no positive
    assert mined(spark, [(10, 1, []), (20, 1, []), (21, 2, [])]) == brute([(10, 1, []), (20, 1, []), (21, 2, [])], lambda i: i % 10 == 0)
    with pytest.raises(ValueError, match="below"):
        mined(spark, [(10, 1, [1e9, 2.0])])
