import random
import re

import numpy as np

from grafloom.llm import html_extract, mixing, quality_rules, queries
from grafloom.llm.text_stats import with_stats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_stats(text):
    t = text or ""
    w = WORD.findall(t)
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {j for found in at.values() if len(found) > 1 for i in found for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def texts():
    r = random.Random(1)
    words = ["a", "bb", "Cc", "ü😀", "#x", "|", "<b>"]
    out = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\ny\nx\n\nx", "\x0b\x0c\r\t", "a\u00a0b \u2028c"]
    return out + ["".join(r.choice(words) + r.choice([" ", "  ", "\n", "\t"]) for _ in range(r.choice([5, 40, 300]))) for _ in range(60)] + ["w " * 30_000]


def test_stats_match_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "i int, t string")
    for r in with_stats(df, "t").collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_stats(r["t"]), repr(r["t"])[:80]


def test_rules_are_learned_and_judged(spark):
    rng = np.random.default_rng(0)
    x = {k: rng.random(900) for k in quality_rules.FEATURES}
    bad = (x["upper_share"] > 0.7) & (x["chars_per_word"] <= 0.5) | (x["repeat_share"] > 0.9)
    rules = quality_rules.learn(x, bad)
    found = np.any([quality_rules.covers(r, x) for r in rules], axis=0)
    assert (found & bad).sum() >= 0.9 * bad.sum() and (found & ~bad).sum() <= 0.02 * (~bad).sum()
    assert quality_rules.learn(x, np.zeros(900, dtype=bool)) == []


def test_quality_query(spark):
    out = queries.op6_quality_rules(spark, "/root/testdata/sf0.01")
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in out.collect():
        n, chars, symbols, lines, repeats = brute_stats(docs[r["doc_id"]])
        failed = n < 50 or 100 * repeats > 50 * n
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (n, chars, symbols, lines, repeats, failed)
        assert not (failed and r["kept"])


def test_judge_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (None, "x " * 60, 1), (2, "", 1), (2, "", 1)], "doc_id long, text string, n_words int")
    rule = (quality_rules.Condition("chars_per_word", False, 3.0),)
    assert sorted((str(r["doc_id"]), r["base_failed"], r["rule"]) for r in quality_rules.judge(df, [rule]).collect()) == [("1", True, 1), ("2", True, 1), ("2", True, 1), ("None", True, 1)]
    assert quality_rules.judge(df.limit(0), []).collect() == []
    assert quality_rules.train(df, spark.createDataFrame([], "doc_id long, quality int")) == []


def test_mixing_meets_targets(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    weights = {"clean": 0.9, "low": 0.06, "toxic": 0.04}
    out = mixing.mix(docs, mixing.label_domains(labels), weights)
    rows = out.toPandas()
    assert len(rows) == docs.count() and (rows.rate >= 0).all()
    totals = np.array([(rows.rate * rows.n_tokens * rows[f"p_{d}"]).sum() for d in weights])
    assert np.abs(totals / totals.sum() - [*weights.values()]).max() < 0.01
    assert abs((rows.copies * rows.n_tokens).sum() / (rows.rate * rows.n_tokens).sum() - 1) < 0.05
    known = rows.merge(labels.toPandas(), on="doc_id")
    assert known[known.toxic == 1].p_toxic.mean() > 3 * known[known.toxic == 0].p_toxic.mean()


def test_rates_solve_the_least_squares(spark):
    judged = spark.createDataFrame([(100, [256, 0]), (50, [128, 128]), (30, [0, 256])], "n_tokens long, posterior array<int>")
    rate, fit = mixing.fit_rates(judged, ["a", "b"], {"a": 1, "b": 1}, budget=120)
    got = judged.withColumn("r", rate).collect()
    a = sum(r["r"] * r["n_tokens"] * r["posterior"][0] / 256 for r in got)
    assert abs(a - 60) < 0.2 and abs(fit.shares["a"] - 0.5) < 0.002 and all(r["r"] >= 0 for r in got)


def test_mixing_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (None, "", 1), (2, "idiot word", 1), (2, "idiot word", 1)], "doc_id long, text string, rate int")
    empty = spark.createDataFrame([], "doc_id long, domain string")
    assert [r["rate"] for r in mixing.mix(df, empty, {"a": 1}).collect()] == [1.0] * 4
    labelled = spark.createDataFrame([(1, "a"), (2, "b"), (None, "a"), (3, None), (2, "a")], "doc_id long, domain string")
    out = mixing.mix(df, labelled, {"a": 1, "b": 1}).collect()
    assert len(out) == 4 and all(r["copies"] >= 0 for r in out)
    assert mixing.mix(df.limit(0), labelled, {"a": 1}).collect() == []


def test_blocks():
    page = "<html><head><title>T &amp; t</title><script>var a='<p>no</p>'</script></head><body><p>One <b>bold</b><br>two&nbsp;&lt;x&gt;<p>Three<li>a<li>b</ul><!-- c --><textarea>no</textarea><div id=x class='ad big'>1 < 2</div><p title=\"a>b\">q"
    found = html_extract.blocks(page)
    assert [b.text for b in found] == ["T & t", "One bold two <x>", "Three", "a", "b", "1 < 2", "q"]
    assert found[5].path[-4:] == ("div", ".x", ".ad", ".big")
    assert html_extract.blocks(None) == html_extract.blocks("") == html_extract.blocks("<p> </p>") == []
    assert [b.text for b in html_extract.blocks("<" * 2000 + "<p 'unclosed>x</p>y")]


def test_labeller_on_made_up_pages():
    model, maker = html_extract.trained(), html_extract.Maker(77)
    made = [maker.example() for _ in range(150)]
    right = sum(int((model.label([b])[0] > 0.5).tolist() == (y > 0.5).tolist()) for b, y in made)
    assert right >= 0.95 * len(made)


def test_extract(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = {r["page_id"]: r for r in html_extract.extract(df.withColumnRenamed("x", "y")).collect()}
    for r in df.collect():
        inside = re.search(r"<article>(.*?)(</article>|<footer>)", r["html"], re.S)[1]
        parts = [" ".join(html_extract.html.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        want = "\n\n".join(p for p in parts if p)
        assert out[r["page_id"]]["text"] == want and out[r["page_id"]]["n_chars"] == len(want)
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x"), (3, "u", "<article>" + "<p>Long text here.</p>" * 5000, "x")], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html_extract.extract(odd).collect()}
    assert got[1]["text"] == got[None]["text"] == "" and got[1]["n_chars"] == 0 and got[3]["text"].count("Long") == 5000
    assert html_extract.extract(odd.limit(0)).collect() == []
