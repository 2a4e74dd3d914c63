import random

import numpy as np
import xxhash
from pyspark.sql import Row

from grafloom.llm import simhash


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def brute_components(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 4:
                    label[i] = label[j] = min(label[i], label[j])
    out = {}
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.setdefault(d, []).append((f"{prints[i]:016x}", min(ids) if ids else None))
    return {d: sorted(x, key=str) for d, x in out.items()}


def corpus():
    r = random.Random(4)
    vocabulary = [f"wörd{i}" for i in range(300)]
    rows = []
    for i in range(25):
        words = [r.choice(vocabulary) for _ in range(r.choice([3, 60, 200]))]
        rows.append((10 * i, " ".join(words)))
        for j in range(r.randint(0, 4)):
            near = list(words)
            near[r.randrange(len(near))] = "other"
            rows.append((10 * i + j + 1, " \n".join(near).upper() if j == 2 else " ".join(near)))
    return [*rows, (1000, ""), (1001, None), (1002, " \t\n"), (1003, "one"), (1003, "one"), (None, "one"), (1004, rows[0][1]), (1005, "x " * 40_000)]


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([Row(doc_id=d, text=t, fp=1, component_id="clash") for d, t in rows], "doc_id long, text string, fp int, component_id string")
    found = {}
    for r in simhash.near_duplicates(df).collect():
        found.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    assert {d: sorted(x, key=str) for d, x in found.items()} == brute_components(rows)


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('abc d')").first()[0] == np.uint64(xxhash.xxh64_intdigest(b"abc d", 42)).astype(np.int64)


def test_dense_classes_lose_no_link(spark):
    r = random.Random(9)
    base, prints = r.getrandbits(64), set()
    for _ in range(300):
        x = base
        for _ in range(r.randint(0, 7)):
            x ^= 1 << r.randrange(64)
        prints.add(x)
    prints |= {r.getrandbits(64) for _ in range(200)}
    prints = [int(np.uint64(x).astype(np.int64)) for x in prints]
    label = {x: x for x in prints}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                u, v = root(a), root(b)
                label[max(u, v)] = min(u, v)
    found = {x["fp"]: x["root"] for x in simhash.classes(spark.createDataFrame([(x,) for x in prints], "fp long")).collect()}
    assert found == {x: root(x) for x in prints}


def test_empty_and_deduplicate(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    rows = [(1, "a b c d e"), (2, "A b c d e"), (3, "z y x w v u"), (3, "z y x w v u"), (None, "a b c d e"), (None, "q r s t u v w"), (None, "q r s t u v w"), (4, "unlike all the others here")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, root string")
    assert sorted((str(r["doc_id"]), r["text"], r["root"]) for r in simhash.deduplicate(df).collect()) == [("1", "a b c d e", "clash"), ("3", "z y x w v u", "clash"), ("4", "unlike all the others here", "clash"), ("None", "q r s t u v w", "clash")]
    assert simhash.deduplicate(empty).collect() == []


def test_deduplicate_judges_rows_by_their_text(spark):
    """An id that repeats with different texts stays with each; clashing names and map columns pass."""
    a, b, c = "one two three four five six", "red green blue black white grey", "north south east west up down"
    rows = [(1, a), (2, b), (2, a), (3, c), (3, b), (4, c), (5, "x"), (5, "x"), (None, None), (None, ""), (None, "y z")]
    df = spark.createDataFrame([(i, t, 1, 2, {"k": "v"}) for i, t in rows], "doc_id long, text string, id int, __id int, fp map<string,string>")
    got = simhash.deduplicate(df)
    assert got.columns == df.columns
    found = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert sorted(found, key=str) == sorted([(1, a), (2, b), (3, c), (5, "x"), (None, ""), (None, "y z")], key=str) or sorted(found, key=str) == sorted([(1, a), (2, b), (3, c), (5, "x"), (None, None), (None, "y z")], key=str)
    assert len(found) == 6
