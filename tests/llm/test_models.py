"""Learned parts against plain loops: regularised leader, posteriors, rates; and their samples."""

import math
import random
import re
import warnings

import numpy as np
import pytest

from grafloom.llm import langid, mixing, quality_rules


def plain_ftrl(examples, epochs, alpha, beta, l1, l2, seed):
    """Weights by the textbook's per-coordinate update, in dictionaries."""
    languages = sorted({e[0] for e in examples})
    df = {}
    for _, buckets, _ in examples:
        for b in buckets:
            df[b] = df.get(b, 0) + 1
    order = np.random.default_rng(seed).permutation(len(examples))
    z, n = {}, {}

    def weight(key):
        v = z.get(key, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((beta + math.sqrt(n.get(key, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for j, i in enumerate(order):
            if j % 5 == 0:
                continue
            lang, buckets, counts = examples[i]
            v = {int(b): math.log1p(c) * (math.log((1 + len(examples)) / (1 + df[b])) + 1) for b, c in zip(buckets, counts, strict=True)}
            norm = math.sqrt(sum(x * x for x in v.values()))
            v = {b: x / norm for b, x in v.items()} | {"bias": 0.1}
            w = {(b, k): weight((b, k)) for b in v for k in languages}
            score = {k: sum(x * w[b, k] for b, x in v.items()) for k in languages}
            top = max(score.values())
            total = sum(math.exp(s - top) for s in score.values())
            for k in languages:
                p = math.exp(score[k] - top) / total - (k == lang)
                for b, x in v.items():
                    g, key = x * p, (b, k)
                    z[key] = z.get(key, 0.0) + g - (math.sqrt(n.get(key, 0.0) + g * g) - math.sqrt(n.get(key, 0.0))) / alpha * w[key]
                    n[key] = n.get(key, 0.0) + g * g
    return languages, weight, df


def test_leader_is_the_textbook_one():
    r = random.Random(3)
    words = {"aa": ["the", "of", "and", "that"], "bb": ["der", "die", "und", "für"], "cc": ["le", "que", "des", "été"]}
    examples = [(lang, *langid.ngram_counts(" ".join(r.choice(words[lang]) for _ in range(r.randint(2, 9))))) for lang in words for _ in range(15)]
    setting = {"epochs": 3, "alpha": 2.0, "beta": 1.0, "l1": 0.1, "l2": 0.01, "seed": 7}
    model = langid.fit(examples, **setting)
    languages, weight, df = plain_ftrl(examples, **setting)
    assert model.languages == languages
    for k, lang in enumerate(languages):
        assert abs(model.bias[k] - 0.1 * weight(("bias", lang))) < 1e-5
        assert max(abs(model.weights[b, k] - weight((b, lang))) for b in df) < 1e-5
    assert (model.weights[list(df)] == 0).mean() > 0.05 and (model.weights != 0).sum() <= 3 * len(df)  # sparse


def test_language_sample_is_bounded(spark, monkeypatch):
    rows = [(7, "the same text again and again", "en")] * 5000 + [(i, f"this is text number {i}", "en") for i in range(3000)] + [(i, f"das ist der Text Nummer {i}", "de") for i in range(3000, 3400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(langid, "fit", lambda examples: seen.append(examples))
    langid.train(df, per_language=100)
    langid.train(df, per_language=100, most_rows=60)
    assert [sum(e[0] == lang for e in x) for x in seen for lang in ("de", "en")] == [100, 100, 30, 30]
    langid.train(df, per_language=100, most_ngrams=2000)
    for lang in ("de", "en"):
        sizes = [len(e[1]) for e in seen[2] if e[0] == lang]
        assert sum(sizes) >= 1000 > sum(sizes) - max(sizes)  # rows are whole: fewer of them
    whole = {tuple(langid.ngram_counts(t)[0].tolist()) for _, t, _ in rows}
    assert all(tuple(e[1].tolist()) in whole for e in seen[2])


def test_labels_of_absent_documents_do_not_count(spark):
    """Samples are taken from the labels of documents that are there, and an id of many rows is one example."""
    text = lambda i: ("idiot### &&& " if i % 3 == 0 else "calm kind words ") * 20 + f"n{i}"
    docs = spark.createDataFrame([(i, text(i)) for i in range(600)] + [(3, text(3))] * 3000, "doc_id long, text string")
    labels = spark.range(300_000).selectExpr("id + 1000000 as doc_id", "1 as quality").union(spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(600)], "doc_id long, quality int"))
    rules = quality_rules.train(docs, labels, most_labelled=600)
    assert rules and rules == quality_rules.train(docs.distinct(), labels, most_labelled=600)
    domains = labels.selectExpr("doc_id", "if(quality = 0, 'low', 'clean') as domain")
    model = mixing.train(docs, domains, most_labelled=600)
    assert model.domains == ["clean", "low"] and model.words and model.reliability["low"]["low"] > 0.95 and model.reliability["clean"]["clean"] > 0.95


def plain_posteriors(text, model):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(" " if c in mixing.PUNCTUATION else c.lower() if "A" <= c <= "Z" else c for c in t))
    n, ratio = len(w), lambda a: math.floor(math.log2(16 * a / max(len(w), 1) + 1))
    bins = {"b_symbols": ratio(sum(t.count(c) for c in mixing.SYMBOLS)), "b_upper": ratio(sum("A" <= c <= "Z" for c in t)), "b_distinct": math.floor(8 * len(set(w)) / max(n, 1) * max(0.25, math.log10(n + 1) / 4))}
    z = list(model.prior)
    for weights in [model.words[x] for x in set(w) & set(model.words)] + [model.bins[b].get(v, [0.0] * len(z)) for b, v in bins.items() if b in model.bins]:
        z = [a + b for a, b in zip(z, weights, strict=True)]
    e = [math.exp(x - max(z)) for x in z]
    return n, [x / sum(e) for x in e]


def test_mixing_against_plain_loops(spark):
    """Posteriors row by row, and rates against projected gradients over single documents."""
    data = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), mixing.label_domains(spark.read.parquet(f"{data}/labels.parquet"))
    weights = {"clean": 0.7, "low": 0.16, "toxic": 0.14}
    model = mixing.train(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = mixing.mix(docs, labels, weights).toPandas()
    for r in rows.itertuples():
        n, p = plain_posteriors(texts[r.doc_id], model)
        assert r.n_tokens == n and max(abs(getattr(r, f"p_{d}") - x) for d, x in zip(model.domains, p, strict=True)) < 1.01 / mixing.GRID
    t, p = rows.n_tokens.to_numpy(float), rows[[f"p_{d}" for d in model.domains]].to_numpy()
    held, rate = t @ p, np.ones(len(t))
    want = np.array([weights[d] for d in model.domains])
    want = want * held[0] / want[0]  # the domain of the largest weight stays as it is
    loss = lambda r: ((r * t @ p - want) ** 2 / held).sum() / want.sum()
    for _ in range(4000):
        rate = np.maximum(0, rate - p @ ((rate * t @ p - want) / held))
    assert loss(rate) < 1e-7 and loss(rows.rate.to_numpy()) < 1e-6 and np.abs(rows.rate * t @ p - want).max() <= 2.1e-4 * want.sum()


def test_posteriors_hold_on_held_out_labels(spark):
    """Labelled documents that the classifier wasn't fitted on: mean posteriors by true domain, and by bins of confidence."""
    data = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), mixing.label_domains(spark.read.parquet(f"{data}/labels.parquet"))
    model = mixing.train(docs, labels)
    print(model.reliability)
    assert all(model.reliability[d][d] > 0.8 for d in model.domains)
    half = labels.where("doc_id % 2 = 0")
    model = mixing.train(docs, half)
    known = mixing.posteriors(docs.join(labels.where("doc_id % 2 = 1"), "doc_id", "left_semi"), model).join(labels, labels["doc_id"] == mixing.F.col("id")).toPandas()
    p = np.array(known.posterior.tolist()) / mixing.GRID
    y = np.array([model.domains.index(d) for d in known.domain])
    for k in range(len(model.domains)):
        assert p[y == k, k].mean() > 0.7  # half the labels teach fewer words
        assert abs(p[:, k].sum() / (y == k).sum() - 1) < 0.15  # as many as there are


def test_targets_out_of_reach(spark):
    """Two domains that each document has halves of can't be set apart: a warning, or an error if strict."""
    judged = spark.createDataFrame([(100, [128, 128]), (50, [128, 128])], "n_tokens long, posterior array<int>")
    with pytest.warns(UserWarning, match="no rates meet"):
        rate, fit = mixing.fit_rates(judged, ["a", "b"], {"a": 3, "b": 1}, budget=100)
    assert not fit.met and abs(fit.shares["a"] - 0.5) < 1e-9 and all(abs(r["r"] - 1 / 1.5) < 0.02 for r in judged.withColumn("r", rate).collect())
    with pytest.raises(ValueError, match="no rates meet"):
        mixing.fit_rates(judged, ["a", "b"], {"a": 3, "b": 1}, budget=100, strict=True)


@pytest.mark.parametrize(("rows", "weights", "budget"), [
    ([(1000, [131, 125]), (1000, [125, 131])], {"a": 0.508, "b": 0.492}, 2000),
    ([(1000, [250, 6]), (10, [200, 56]), (3, [120, 136]), (1, [0, 256])], {"a": 0.3, "b": 0.7}, 1000),
    ([(500, [256, 0, 0]), (90, [128, 64, 64]), (70, [100, 100, 56]), (50, [90, 83, 83])], {"a": 0.5, "b": 0.3, "c": 0.2}, None),
])
def test_targets_that_are_hard_to_reach_are_met(spark, rows, weights, budget):
    """Flat directions, rates far above 1, and cut rates: the fit ends at the optimum, with no warning."""
    judged, domains = spark.createDataFrame(rows, "n_tokens long, posterior array<int>"), sorted(weights)
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message="no rates")
        rate, fit = mixing.fit_rates(judged, domains, weights, budget)
    got = np.array([r["r"] for r in judged.withColumn("r", rate).orderBy(mixing.F.desc("n_tokens")).collect()])
    t, p = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows]) / mixing.GRID
    reached = (got * t) @ p
    assert fit.met and (got >= 0).all() and np.abs(reached / reached.sum() - [weights[d] for d in domains]).max() < 2e-4
    assert abs(fit.largest_rate - got.max()) < 1e-9 and fit.steps < 100


def test_rates_can_be_bounded(spark):
    rows = [(1000, [256, 0]), (10, [0, 256])]
    judged = spark.createDataFrame(rows, "n_tokens long, posterior array<int>")
    _, free = mixing.fit_rates(judged, ["a", "b"], {"a": 1, "b": 1}, budget=1000)
    assert free.met and abs(free.largest_rate - 50) < 0.01
    with pytest.warns(UserWarning, match="no rates meet"):
        rate, fit = mixing.fit_rates(judged, ["a", "b"], {"a": 1, "b": 1}, budget=1000, most_rate=4)
    assert not fit.met and fit.largest_rate <= 4 and max(r["r"] for r in judged.withColumn("r", rate).collect()) <= 4


def test_very_long_texts(spark):
    """A text of two million words is read whole by language ID and mixing: only its end says what it is."""
    long = "lorem " * 2_000_000 + "### idiot " * 2_000_000
    docs = spark.createDataFrame([(1, long), (2, "calm words")], "doc_id long, text string")
    model = langid.fit([("la", *langid.ngram_counts("lorem lorem")), ("en", *langid.ngram_counts("idiot idiot the")), ("la", *langid.ngram_counts("lorem")), ("en", *langid.ngram_counts("the idiot"))] * 5)
    found = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    buckets, counts = langid.ngram_counts(long)
    assert found[1]["lang_pred"] == model.predict(long)[0] and counts.sum() == 3 * len(long) - 3
    mixer = mixing.Classifier(["clean", "toxic"], [0.0, 0.0], {"idiot": [-3.0, 3.0]}, {})
    got = {r["id"]: (r["n_tokens"], r["posterior"]) for r in mixing.posteriors(docs, mixer).collect()}
    assert got == {1: (4_000_000, [1, 255]), 2: (2, [128, 128])}
