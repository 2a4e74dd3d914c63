"""The whole pipeline against plain loops over single documents, stage after stage, each on what the one before kept."""

import binascii
import struct

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from test_models import plain_posteriors
from test_simhash import brute_fingerprint
from test_small_operators import brute_contained

from grafloom.llm import langid, mixing, queries

DATA = "/root/testdata/sf0.001"


def spark_hash(i, seed):
    """Spark's xxhash64 of a long and an int."""
    first = xxhash.xxh64_intdigest(struct.pack("<q", i), 42)
    return int(np.uint64(xxhash.xxh64_intdigest(struct.pack("<i", seed), first)).astype(np.int64))


def brute_mixture(rows, model, weights):
    n, p = zip(*[plain_posteriors(t, model) for _, t in rows], strict=True)
    grid = np.diff(np.c_[np.zeros(len(rows)), np.round(np.cumsum(p, axis=1) * mixing.GRID)], axis=1) / mixing.GRID
    t, held = np.array(n, float), np.array(n, float) @ grid
    want = np.array([weights[d] for d in model.domains])
    want = want / want.sum()
    budget = held[want.argmax()] / want.max()
    # the strongly convex least squares over single documents by projected gradients with constant momentum, to the end
    slack = mixing.PULL * held / budget
    length, momentum = 1 + 1 / mixing.PULL, 1 - 2 / (1 + (1 + 1 / mixing.PULL) ** 0.5)
    rate = ahead = np.ones(len(rows))
    for _ in range(200_000):
        was, rate = rate, np.clip(ahead - (ahead - 1 + grid @ (((ahead * t) @ grid / budget - want) / slack)) / length, 0, mixing.MOST_THINNED)
        ahead = rate + momentum * (rate - was)
    return [(i, x) for (i, x), r in zip(rows, rate, strict=True) if int(r) + ((spark_hash(i, 11) % (1 << 30)) / (1 << 30) < round(r, 9) - int(r)) > 0]


def test_whole_pipeline_against_plain_loops(spark):
    tables = {n: spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "benchmark", "labels")}
    docs = tables["documents"]
    with pytest.warns(UserWarning, match="no rates meet"):  # a few dozen labels tell too little of domains
        found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DATA).collect()}
    left = {r["doc_id"]: r["text"] for r in docs.collect()}

    model = langid.train(docs.where(~langid.held_out()))
    judged = {i: model.predict(t) for i, t in left.items()}
    left = {i: t for i, t in left.items() if judged[i][0] != "und" and judged[i][1] >= corpus_pipeline.LEAST_SCORE}

    ids = sorted(left)
    prints, root = {i: brute_fingerprint(left[i]) for i in ids}, {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    left = {i: t for i, t in left.items() if root[i] == i}

    gone = {d for d, *_ in brute_contained(sorted(left.items()), [(r["item_id"], r["text"]) for r in tables["benchmark"].collect()])}
    left = {i: t for i, t in left.items() if i not in gone}

    rows = docs.where(docs["doc_id"].isin(*left))
    kept = brute_mixture(sorted(left.items()), mixing.train(rows, mixing.label_domains(tables["labels"])), queries.TARGET_WEIGHTS)
    assert sorted(found) == sorted(i for i, _ in kept) and 20 < len(kept) <= len(left) < docs.count()

    size = lambda t: len(t.encode()) + 16
    whole, before, slots = sum(size(t) for _, t in kept), 0, {}
    for i, t in sorted(kept):
        shard = min(39, (2 * before + size(t)) * 40 // (2 * whole))
        want = (size(t), binascii.crc32(t.encode()), shard, slots.get(shard, 0))
        assert (found[i]["size"], found[i]["text_crc32"], found[i]["shard"], found[i]["slot"]) == want
        slots[shard] = slots.get(shard, 0) + 1
        before += size(t)
