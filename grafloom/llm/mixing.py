"""Mixing to target weights with soft membership.

A labelled table teaches a classifier, a multinomial logistic regression on telling words and binned
statistics, calibrated by a temperature on labelled rows that it wasn't fitted on; its weights become an
expression that gives every document posteriors over the domains. Nonnegative rates are then fitted by projected gradients on the squared
relative gaps between expected and wanted domain tokens, with a slight pull to a rate of 1 that makes the rates
unique. Preconditioned by its tokens, a document's gradient depends on its posteriors only, so documents are summed by
posterior profile first, and the rates of every step are 1 less a combination of the posteriors, cut to the allowed range. A step turns the
gradient by the domains' Gram matrix over the rates that aren't cut, damped as far as the objective asks for, and
costs two aggregations over the profiles; steps end when the projected gradient is zero. A document's rate
follows from the last step's few coefficients inside its own row: nothing is joined, broadcast or gathered by document.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grafloom.llm.common import ascii_lower, bare, fresh, materialise, words

#: Labelled documents that the classifier is fitted on, at most: those of the smallest id hashes.
MOST_LABELLED = 8000
#: Words with the most information on the domains that it knows, and least documents of each.
MOST_WORDS, LEAST_DOCS = 256, 8
#: And least information of a word, in nats over the labelled documents: more than chance gives any of 100,000 words.
LEAST_WORTH = 12
#: A word must be so many times likelier in some domain's documents: common words only tell languages and lengths apart.
LEAST_LIFT = 3
#: Every so many-th labelled document is kept from the fit, for the temperature and for `Classifier.reliability`.
HELD_OUT = 5
#: Steps of the regression, and its penalty on squared weights.
FIT_STEPS, PENALTY = 400, 3e-4
#: Posteriors are multiples of one part in so many.
GRID = 256
#: Pull of the rates to 1, and the projected gradient at which their fit ends, in parts of the budget; and the part of the budget by which
#: expected tokens may miss before the targets count as out of reach.
PULL, FLAT, GAP = 1e-7, 1e-8, 2e-4
#: Parts of the Gram matrix of all rates that are added to that of the rates that aren't cut, each tried for a step, all in one
#: aggregation. With the whole of it a step always gains, as no direction is curved more.
DAMPINGS = (0.0, 1e-8, 1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 0.1, 0.3, 1.0)
#: Largest rate where documents are only thinned: one that stays counts once, so larger rates would pay with others' loss for what isn't there.
MOST_THINNED = 2.0
SYMBOLS = "#*$%&|<>!"
PUNCTUATION = ".,;:?" + SYMBOLS
BINS = ("b_symbols", "b_upper", "b_distinct")


@dataclass
class Classifier:
    """Weights of the domains' scores: of none, of a word that is there, of a statistic's bin; lists run over the domains.

    `reliability` gives, for labelled documents that were not learned from, the mean posteriors by true domain.
    """

    domains: list[str]
    prior: list[float]
    words: dict[str, list[float]]
    bins: dict[str, dict[int, list[float]]]
    reliability: dict[str, dict[str, float]] = field(default_factory=dict)


def _bins() -> dict[str, Column]:
    """Statistics in a few bins each, from ratios, so that they hold for any length of text."""
    ratio = lambda a, b: F.floor(F.log2(16 * a / F.greatest(b, F.lit(1)) + 1)).cast("int")
    return {
        "b_symbols": ratio(F.col("__n_symbols"), F.col("n_tokens")),
        "b_upper": ratio(F.col("__n_upper"), F.col("n_tokens")),
        "b_distinct": F.floor(8 * F.col("__n_distinct") / F.greatest("n_tokens", F.lit(1)) * F.greatest(F.lit(0.25), F.log10(F.col("n_tokens") + 1) / 4)).cast("int"),
    }


def _features(df: DataFrame, vocabulary: list[str] | None) -> DataFrame:
    """df(id, text, ...) with n_tokens (words), the binned statistics and __known: its words, or those of the vocabulary."""
    text = F.coalesce("text", F.lit(""))
    df = df.withColumn("__w", words(ascii_lower(F.translate(text, PUNCTUATION, " " * len(PUNCTUATION)))))
    length = F.length(text)
    df = df.withColumns({"n_tokens": F.size("__w").cast("long"), "__n_symbols": length - F.length(F.translate(text, SYMBOLS, "")), "__n_upper": length - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")), "__d": F.array_distinct("__w")}).drop("__w")
    df = df.withColumns({"__n_distinct": F.size("__d"), "__known": F.col("__d") if vocabulary is None else F.array_intersect("__d", F.array(*map(F.lit, vocabulary)).cast("array<string>"))}).drop("__d")
    return df.withColumns(_bins()).drop("__n_symbols", "__n_upper", "__n_distinct")


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def regression(x: np.ndarray, y: np.ndarray, k: int, steps: int = FIT_STEPS, penalty: float = PENALTY) -> np.ndarray:
    """Weights (features + 1, k) of least penalised cross-entropy by accelerated gradients; the last row, the bias, has no penalty."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = ahead = np.zeros((x.shape[1], k))
    shrink = np.r_[np.full(x.shape[1] - 1, penalty), 0][:, None]
    rate = 1 / (0.5 * float(np.linalg.norm(x.T @ x / len(x), 2)) + penalty)
    want = np.eye(k)[y]
    for n in range(steps):
        g = x.T @ (softmax(x @ ahead) - want) / len(x) + shrink * ahead
        w, before = ahead - rate * g, w
        ahead = w + n / (n + 3) * (w - before)
    return w


def train(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", most_labelled: int = MOST_LABELLED) -> Classifier:
    """Fits on labelled ids that are in `docs`, with a non-null domain; an id of two domains counts as the smaller, an id of several rows as one of them. At most 64 domains."""
    y = bare(labelled, id_col, domain_col).toDF("id", "y").where("id is not null and y is not null").groupBy("id").agg(F.min("y").alias("y"))
    rows = bare(docs, id_col, text_col).toDF("id", "text")
    y = materialise(y.join(rows.select("id"), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(most_labelled), "labels")
    known = [*BINS, "__known"]
    found = _features(rows.join(F.broadcast(y), "id"), None).groupBy("id", "y").agg(F.min(F.struct(*known)).alias("x"))
    found = materialise(found.select("id", "y", "x.*"), "labelled")
    sizes = dict(found.groupBy("y").count().limit(65).collect())
    domains = sorted(sizes)
    if len(domains) > 64:
        raise ValueError("more than 64 domains")
    if len(domains) < 2:
        return Classifier(domains, [0.0] * len(domains), {}, {}, {d: {d: 1.0} for d in domains})

    # words by how far their share in some domain is from their share in all, in nats a document
    total = sum(sizes.values())
    per = found.select("y", F.explode("__known").alias("w")).groupBy("w", "y").count()
    n = {d: F.coalesce(F.sum(F.when(F.col("y") == d, F.col("count"))), F.lit(0)) for d in domains}
    worth = F.lit(0.0)
    for i, d in enumerate(domains):
        share = F.col(f"n{i}") / sizes[d]
        worth += F.col(f"n{i}") * F.log((share + 1e-9) / (F.col("n") / total + 1e-9))
    per = per.groupBy("w").agg(F.sum("count").alias("n"), *[n[d].alias(f"n{i}") for i, d in enumerate(domains)]).where(F.col("n") >= LEAST_DOCS)
    lift = F.greatest(*[F.col(f"n{i}") / F.col("n") / (sizes[d] / total) for i, d in enumerate(domains)])
    chosen = [r["w"] for r in per.withColumn("worth", worth).where(lift >= LEAST_LIFT).where(F.col("worth") > LEAST_WORTH).orderBy(F.desc("worth"), "w").limit(MOST_WORDS).select("w").collect()]

    there = F.array_intersect("__known", F.array(*map(F.lit, chosen)).cast("array<string>")).alias("w")
    examples = found.select("id", "y", *BINS, there).orderBy(F.xxhash64("id"), "id").collect()  # at most most_labelled
    places = {("w", w): i for i, w in enumerate(chosen)}
    for b in BINS:
        for value in sorted({r[b] for r in examples}):
            places[b, value] = len(places)
    x, t = np.zeros((len(examples), len(places))), np.array([domains.index(r["y"]) for r in examples])
    for i, r in enumerate(examples):
        x[i, [places["w", w] for w in r["w"]] + [places[b, r[b]] for b in BINS]] = 1
    held = np.arange(len(t)) % HELD_OUT == HELD_OUT - 1
    w = regression(x[~held], t[~held], len(domains))
    z = np.hstack([x, np.ones((len(x), 1))])[held] @ w
    loss = lambda c: -np.log(np.maximum(softmax(z / c)[np.arange(len(z)), t[held]], 1e-12)).sum()
    w = w / (float(min(np.geomspace(0.2, 5, 80), key=loss)) if held.any() else 1.0)
    p = softmax(np.hstack([x, np.ones((len(x), 1))])[held] @ w) if held.any() else np.zeros((0, len(domains)))
    seen = {d: p[t[held] == i].mean(axis=0) for i, d in enumerate(domains) if (t[held] == i).any()}
    return Classifier(
        domains, w[-1].tolist(), {v: w[at].tolist() for (b, v), at in places.items() if b == "w"},
        {b: {v: w[at].tolist() for (c, v), at in places.items() if c == b} for b in BINS},
        {d: dict(zip(domains, map(float, m), strict=True)) for d, m in seen.items()},
    )


def _summed(places: str, values: Column) -> Column:
    return F.aggregate(places, F.lit(0.0), lambda a, x: a + F.get(values, x))


def posteriors(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, `n_tokens`, `posterior`): an array over the domains of whole parts in GRID that sum to GRID."""
    rows = _features(bare(docs, id_col, text_col).toDF("id", "text"), sorted(model.words)).drop("text")
    k = range(len(model.domains))
    doubles = lambda xs: F.array(*[F.lit(float(x)) for x in xs]).cast("array<double>")
    score = [F.lit(p) for p in model.prior]
    for b, by in model.bins.items():
        for i in k:
            value = F.lit(0.0)
            for key, shares in by.items():
                value = F.when(F.col(b) == key, F.lit(shares[i])).otherwise(value)
            score[i] = score[i] + value
    names, table = F.array(*map(F.lit, sorted(model.words))).cast("array<string>"), [doubles(model.words[w][i] for w in sorted(model.words)) for i in k]
    rows = rows.withColumn("__at", F.transform("__known", lambda w: F.array_position(names, w).cast("int") - 1))
    rows = rows.withColumns({f"__z{i}": score[i] + _summed("__at", table[i]) for i in k})
    top = F.greatest(*[F.col(f"__z{i}") for i in k], *[F.lit(float("-inf"))] * 2)
    rows = rows.withColumns({f"__e{i}": F.exp(F.col(f"__z{i}") - top) for i in k})
    whole = sum((F.col(f"__e{i}") for i in k), F.lit(0.0))
    # rounding the running sums keeps the parts whole, nonnegative and of the right sum
    run = [F.lit(0)] + [F.round(sum((F.col(f"__e{j}") for j in range(i + 1)), F.lit(0.0)) / whole * GRID).cast("int") for i in k]
    return rows.select("id", "n_tokens", F.array(*[run[i + 1] - run[i] for i in k]).cast("array<int>").alias("posterior"))


@dataclass
class Fit:
    """The rates' coefficients by domain, the domains' expected shares of tokens, the largest rate, whether the targets are met, and the steps taken."""

    coefficients: list[float]
    shares: dict[str, float]
    largest_rate: float = 1.0
    met: bool = True
    steps: int = 0
    most_rate: float | None = None


def _rate(coefficients: Sequence[float], most_rate: float | None = None) -> Column:
    """A row's rate: 1 less its posteriors' combination, at least 0 and at most most_rate."""
    at = F.lit(1.0) - sum((float(c) * F.get("posterior", i) / GRID for i, c in enumerate(coefficients)), F.lit(0.0))
    at = F.greatest(F.lit(0.0), at)
    return at if most_rate is None else F.least(F.lit(float(most_rate)), at)


def fit_rates(judged: DataFrame, domains: list[str], weights: Mapping[str, float], budget: float | None = None, strict: bool = False, most_rate: float | None = None) -> tuple[Column, Fit]:
    """The rate of a row of `judged` (n_tokens, posterior) as an expression, and what it reaches.

    Expected tokens of domain d are to be weights[d] of the budget; weights are scaled to sum to 1. The
    budget is in tokens; if not given, it takes the domain of the largest weight just as it is, so that
    its documents stay and the others are thinned, or repeated where they are scarce. Domains that have
    no tokens are left out. No tokens at all: rates of 1. Of all rates that meet the targets those nearest to 1 are
    found; `most_rate`, 1 at least, bounds them. A zero projected gradient with targets missed means that no rates reach them, which is
    warned of (`strict`: raises ValueError); a fit that doesn't come to one raises RuntimeError.
    """
    k = len(domains)
    p = lambda i: F.get("posterior", i) / GRID
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0)).cast("double")
    profiles = materialise(judged.groupBy("posterior").agg(F.sum("n_tokens").alias("t")), "profiles")
    held = np.array([*profiles.select(*[total(F.col("t") * p(i)).alias(str(i)) for i in range(k)]).first()]) if k else np.zeros(0)
    scale = sum(weights.get(d, 0.0) for d, m in zip(domains, held, strict=True) if m > 0)
    if not scale:
        return F.lit(1.0), Fit([], {})
    share = np.array([weights.get(d, 0.0) / scale if m > 0 else 0.0 for d, m in zip(domains, held, strict=True)])
    largest = max(range(k), key=lambda i: (share[i], -i))
    budget = budget or held[largest] / share[largest]
    # in parts of the budget; gaps count relative to what a domain holds
    slack = PULL * np.where(held > 0, held / budget, 1.0)
    t = F.col("t") / float(budget)

    def tried(many: np.ndarray) -> list[tuple[float, np.ndarray]]:
        """For each set of coefficients the objective's dual value and its gradient: the projected gradient of the least squares."""
        columns = []
        for c in many:
            r = _rate(c, most_rate)
            columns += [total(t * (r - 1) * (r - 1)), *[total(t * r * p(i)) for i in range(k)]]
        found = np.array([*profiles.select(*[c.alias(str(i)) for i, c in enumerate(columns)]).first()]).reshape(len(many), k + 1)
        return [(row[0] / 2 + c @ (row[1:] - share) - (slack * c * c).sum() / 2, row[1:] - share - slack * c) for c, row in zip(many, found, strict=True)]

    def gram(which: Column) -> np.ndarray:
        pairs, out = [(i, j) for i in range(k) for j in range(i + 1)], np.zeros((k, k))
        sums = profiles.select(*[total(F.when(which, t * p(i) * p(j))).alias(f"{i}_{j}") for i, j in pairs]).first()
        for (i, j), x in zip(pairs, sums, strict=True):
            out[i, j] = out[j, i] = x
        return out

    c, steps, whole = np.zeros(k), 0, gram(F.lit(True))
    value, slope = tried(c[None])[0]
    while (steep := np.abs(slope).max()) > FLAT:
        rate = _rate(c, most_rate)
        own = gram((rate > 0) if most_rate is None else (rate > 0) & (rate < float(most_rate)))
        points = np.array([c + np.linalg.solve(own + damped * whole + np.diag(slack), slope) for damped in DAMPINGS])
        noise = 1e-13 * (1 + abs(value))
        better = [(v, g, x) for (v, g), x in zip(tried(points), points, strict=True) if v > value + noise or (v > value - noise and np.abs(g).max() < steep / 2)]
        if not better or steps == 1000:
            raise RuntimeError(f"the rates' fit stopped at a projected gradient of {steep}")
        value, slope, c = max(better, key=lambda x: (x[0], -np.abs(x[1]).max()))
        steps += 1
    rate = _rate(c, most_rate)
    sums = np.array([*profiles.select(*[total(t * rate * p(i)).alias(str(i)) for i in range(k)], F.coalesce(F.max(rate), F.lit(1.0)).alias("most")).first()])
    met = bool(np.abs(sums[:k] - share).max() <= GAP)
    fit = Fit(c.tolist(), {d: float(x / max(sums[:k].sum(), 1e-12)) for d, x in zip(domains, sums[:k], strict=True)}, float(sums[k]), met, steps, most_rate)
    if not met:
        said = f"no rates meet the targets; the nearest give shares of {fit.shares}, wanted {dict(zip(domains, share.tolist(), strict=True))}, and {sums[:k].sum():.6f} of the budget"
        if strict:
            raise ValueError(said)
        warnings.warn(said, stacklevel=2)
    return rate, fit


def _whole_copies(seed: int, *key: str) -> Column:
    """The rate's whole part, and one more where the key's hash falls below the rest."""
    part = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor("rate") + (part < F.col("rate") - F.floor("rate")).cast("int")).cast("long")


def mix(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", budget: float | None = None, seed: int = 11, strict: bool = False, most_rate: float | None = None) -> DataFrame:
    """The rows of `mixed`, without what their rates reach."""
    return mixed(docs, labelled, weights, id_col, text_col, domain_col, budget, seed, strict, most_rate)[0]


def mixed(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", budget: float | None = None, seed: int = 11, strict: bool = False, most_rate: float | None = None) -> tuple[DataFrame, Fit]:
    """One row per input row: the id, `n_tokens`, `p_<domain>` for each domain, `rate` and `copies`; and the shares and the largest rate that are reached.

    `copies` is the rate's whole part, and one more where the id's hash falls below the rest. Null or
    wordless texts have no tokens and their domains' prior; texts of any length are read whole. Repeated rows are judged
    alike and null ids are returned; an empty document table gives no rows; without labelled rows every rate is 1. Targets
    that no rates reach are met as nearly as can be, with a warning that gives the shares, or raise ValueError if
    `strict`. Further columns are not looked at.
    """
    model = train(docs, labelled, id_col, text_col, domain_col)
    judged = materialise(posteriors(docs, model, id_col, text_col), "posteriors")
    rate, fit = fit_rates(judged, model.domains, weights, budget, strict, most_rate)
    rows = judged.withColumn("rate", F.round(rate, 9))
    domains = [(F.get("posterior", i) / GRID).alias(f"p_{d}") for i, d in enumerate(model.domains)]
    return rows.select(F.col("id").alias(id_col), "n_tokens", *domains, "rate", _whole_copies(seed, "id").alias("copies")), fit


def thin(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", seed: int = 11, most_rate: float | None = MOST_THINNED) -> DataFrame:
    """The input's rows and columns without those of no copy by `mix` with rates of `most_rate` at most. Rows are judged by their own text; a null id is made up for by the text's digest, so that such rows are thinned one by one. An empty table gives no rows."""
    model = train(docs, labelled, id_col, text_col, domain_col)
    key, gone, gone_digest, own = fresh(docs, "key", "gone", "digest", "own")
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    digest = F.when(id_.isNull(), F.sha2(F.coalesce(text, F.lit("")), 256))
    keyed = docs.select(F.struct(id_.alias("id"), digest.alias("digest"), F.xxhash64(text).alias("own")).alias(key), text)
    judged = materialise(posteriors(keyed, model, key, text_col), "posteriors")
    rate, _ = fit_rates(judged, model.domains, weights, most_rate=most_rate)
    # hashes pass over nulls: an id's is the same as in mix
    none = judged.withColumn("rate", F.round(rate, 9)).where(_whole_copies(seed, "id.id", "id.digest") == 0)
    none = none.select(F.col("id.id").alias(gone), F.col("id.digest").alias(gone_digest), F.col("id.own").alias(own)).distinct()
    return docs.join(none, id_.eqNullSafe(F.col(gone)) & digest.eqNullSafe(F.col(gone_digest)) & (F.xxhash64(text) == F.col(own)), "left_anti")


def label_domains(labels: DataFrame) -> DataFrame:
    """The table `labels` as (doc_id, domain): toxic, else low or clean by quality; rows with a null are left out."""
    rows = bare(labels, "doc_id", "quality", "toxic").where("quality is not null and toxic is not null")
    return rows.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("clean").alias("domain"))
