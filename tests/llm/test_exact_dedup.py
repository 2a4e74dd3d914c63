import hashlib
import random

import pytest

from grafloom.llm import exact_dedup


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(lowered(t), []).append(d)
    out = []
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        digest = hashlib.sha256(t.encode()).hexdigest()
        out += [(d, keep, len(ids), digest) for d in ids]
    return sorted(out, key=str), {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}


def corpus():
    r = random.Random(3)
    base = "".join(r.choice("abcdé ") for _ in range(3000))
    rows = [(i, base[:n]) for i, n in enumerate([0, 1, 7, 8, 9, 63, 64, 65, 100, 575, 576, 577, 2000, 3000])]
    rows += [(100 + i, base[:n].upper() if n != 65 else base[:n]) for i, n in enumerate([1, 8, 64, 576, 3000])]
    rows += [(200 + i, base[:-1] + c) for i, c in enumerate("xyXYz")]  # differ in the last byte only
    rows += [(300 + i, "copy " * 40) for i in range(60)]  # a third of all rows
    rows += [(400, None), (401, ""), (402, None), (None, None), (None, "only null ids"), (None, "Only null ids"), (500, "É"), (501, "é"), (502, " é"), (503, "é ")]
    return rows + [(600, "twice"), (600, "twice"), (600, "another"), (700, "long " * 60_000), (701, "LONG " * 60_000), (702, "long " * 60_000 + "x")]


@pytest.mark.parametrize(("width", "most_broadcast"), [(8, 0), (64, 500_000)])
def test_matches_brute_force(spark, width, most_broadcast):
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1, "clash", True) for d, t in rows], "doc_id long, text string, rid int, keep_id string, done boolean").repartition(5)
    found = exact_dedup.group(df, width=width, most_broadcast=most_broadcast).collect()
    want, stays = brute(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=str) == want
    kept = [(r["text_sha256"], r["doc_id"]) for r in found if r["kept"]]
    assert sorted(kept, key=str) == sorted(((hashlib.sha256(t.encode()).hexdigest(), d) for t, d in stays.items()), key=str)


def test_rounds_follow_the_logarithm_of_the_longest_shared_text(spark, monkeypatch):
    rounds, real = [], exact_dedup._written
    monkeypatch.setattr(exact_dedup, "_written", lambda rows, name: rounds.append(name) or real(rows, name))
    exact_dedup.group(spark.createDataFrame([(1, "ab" * 50_000), (2, "ab" * 50_000), (3, "c")], "doc_id long, text string"))
    assert len(rounds) == 5  # 64, 512, 4096, 32768 and 262144 bytes


def test_empty_and_deduplicate(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.group(empty).collect() == []
    df = spark.createDataFrame([("a", "X"), ("b", "x"), ("c", "y")], "id string, body string")
    assert sorted(r["id"] for r in exact_dedup.deduplicate(df, "id", "body").collect()) == ["b", "c"]
