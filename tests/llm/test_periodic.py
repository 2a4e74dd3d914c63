import random
import re

import pytest

from grafloom.llm import periodic


def brute(text, min_length=24, min_exponent=3):
    """Every stretch by its definition: maximal for its smallest period."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, runs = len(w), set()
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q):
                run = w[i : j + q]
                smallest = next(p for p in range(1, q + 1) if all(run[k] == run[k + p] for k in range(len(run) - p)))
                if smallest == q:
                    runs.add((i, j + q - i, q))
            i = max(j, i + 1)
    drop = {k for s, length, q in runs for k in range(s + q, s + length)}
    return sorted(runs, key=lambda x: (x[0], x[2])), " ".join(x for k, x in enumerate(w) if k not in drop)


def corpus():
    r = random.Random(5)
    word = lambda: r.choice("abcdefgh")
    texts = [None, "", " \t\n", "one", "a " * 23, "a " * 24, "a " * 25, "x " + "a b " * 12 + "y", "a b c d e f g h " * 3, "a b c d e f g h i " * 2 + "a b c d e f g h", "É é " * 20, "a\x0bb\x0cc\x1cd " * 30]
    for _ in range(60):
        parts = []
        for _ in range(r.randint(1, 4)):
            parts += [word() for _ in range(r.randint(0, 30))]
            unit = [word() for _ in range(r.randint(1, 12))]
            k = r.randint(10, 70)
            parts += (unit * k)[:k]
        texts.append(" ".join(parts))
    texts += [" ".join(r.choice("ab") for _ in range(300)) for _ in range(10)]  # overlapping runs
    texts.append(("a " * 9 + "b ") * 8 + ("a " * 9 + "b ") * 3)
    return texts


@pytest.mark.parametrize(("most_compared", "min_length", "min_exponent"), [(1 << 28, 24, 3), (500, 24, 3), (1 << 28, 5, 2)])
def test_matches_brute_force(spark, most_compared, min_length, min_exponent):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, runs string, rid int")
    found = {r["doc_id"]: r for r in periodic.find(df, min_length=min_length, min_exponent=min_exponent, most_compared=most_compared).collect()}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        runs, collapsed = brute(t, min_length, min_exponent)
        assert [tuple(x) for x in found[i]["runs"]] == runs, t
        assert found[i]["collapsed"] == collapsed


def test_long_texts_nulls_and_repeats(spark):
    words = " ".join(f"w{i}" for i in range(30_000))
    text = words + " " + "x y z " * 200 + words
    df = spark.createDataFrame([(1, text), (1, text), (None, "a " * 30)], "doc_id long, text string")
    found = periodic.find(df, most_compared=1 << 22).collect()
    assert sorted((str(r["doc_id"]), [tuple(x) for x in r["runs"]]) for r in found) == [("1", [(30_000, 600, 3)])] * 2 + [("None", [(0, 30, 1)])]
    assert found[0]["collapsed"] == found[1]["collapsed"] or found[0]["doc_id"] != found[1]["doc_id"]


def test_one_word_over_and_over(spark):
    # every lag up to a third has a stretch, of which one is a run
    df = spark.createDataFrame([(1, "la " * 9000)], "doc_id long, text string")
    r = periodic.find(df).first()
    assert [tuple(x) for x in r["runs"]] == [(0, 9000, 1)] and r["collapsed"] == "la"


def test_empty_table_and_least_exponent(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.find(empty).collect() == []
    with pytest.raises(ValueError, match="min_exponent"):
        periodic.find(empty, min_exponent=1)
