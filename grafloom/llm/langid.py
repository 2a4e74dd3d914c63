"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader (FTRL-proximal) under elastic-net penalties, then
calibrated by a temperature. The model is fitted on a bounded sample of labelled rows, turned to
sparse counts on the executors; predictions read every text whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grafloom.llm.common import bare, fresh, materialise

LOG_BUCKETS = 15
ORDERS = (1, 2, 3)
#: Odd multipliers that mix code points into n-gram hashes.
MIX, SPREAD = 0x9E3779B1, 0x85EBCA6B
#: Labelled rows that a model is fitted on: at most of each language, and of all; and the most languages.
SAMPLE_PER_LANGUAGE, MOST_ROWS, MOST_LANGUAGES = 600, 6000, 256
#: The sample's rows are whole; it has as many as have so many different n-grams in all, 8 bytes each (200 MB) in the driver. Languages share them alike.
MOST_NGRAMS = 25_000_000
#: Characters whose n-grams are counted at once.
CHUNK = 1 << 20
CANDIDATE = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the whole lower-cased text's character 1- to 3-grams, hashed."""
    low, n = text.lower(), max(ORDERS) - 1
    total = np.zeros(1 << LOG_BUCKETS, dtype=np.int64)
    for at in range(0, len(low), CHUNK):
        points = np.frombuffer(low[max(0, at - n) : at + CHUNK].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        fresh = min(at, n)  # the points before the chunk only begin n-grams
        h = np.zeros(len(points), dtype=np.uint32)
        for order in range(1, max(ORDERS) + 1):
            h = h[: len(points) - order + 1] * np.uint32(MIX) + points[order - 1 :] + np.uint32(order)
            ends = h[max(0, fresh - order + 1) :]
            total += np.bincount((ends * np.uint32(SPREAD)) >> np.uint32(32 - LOG_BUCKETS), minlength=1 << LOG_BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.idf[buckets]
        return v / max(float(np.sqrt(v @ v)), 1e-12)

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(buckets, counts) @ self.weights[buckets] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        p = softmax(self.logits(*ngram_counts(text)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def has_letter(text: str) -> bool:
    """Whether any character is a letter of any script; signs such as superscript digits aren't."""
    return any(c.isalpha() for m in CANDIDATE.finditer(text) for c in m.group())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit(examples: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = 4, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.002, l2: float = 0.01, seed: int = 7) -> Model:
    """Fits on (language, buckets, counts); each fifth example is kept back for the temperature."""
    languages = sorted({e[0] for e in examples})
    size, k = 1 << LOG_BUCKETS, len(languages)
    seen = np.zeros(size)
    for _, buckets, _ in examples:
        seen[buckets] += 1
    model = Model(languages, np.log((1 + len(examples)) / (1 + seen)) + 1, np.zeros((size, k)), np.zeros(k))
    if k < 2:
        return model
    at = {x: i for i, x in enumerate(languages)}
    order = np.random.default_rng(seed).permutation(len(examples))
    kept, train = order[::5], [i for j, i in enumerate(order) if j % 5]
    vectors = {i: (at[examples[i][0]], examples[i][1], model.vector(*examples[i][1:]).astype(np.float32)) for i in order}
    z, n = np.zeros((size + 1, k)), np.zeros((size + 1, k))  # the last row is the bias

    def solved(rows) -> np.ndarray:
        """The regularised leader's weights: soft threshold by l1, shrunk by l2 and the learning rate."""
        zr = z[rows]
        return np.where(np.abs(zr) <= l1, 0.0, -(zr - np.sign(zr) * l1) / ((beta + np.sqrt(n[rows])) / alpha + l2))

    for _ in range(epochs):
        for i in train:
            y, buckets, v = vectors[i]
            rows, x = np.append(buckets, size), np.append(v, 0.1)
            w = solved(rows)
            p = softmax(x @ w)
            p[y] -= 1
            g = np.outer(x, p)
            z[rows] += g - (np.sqrt(n[rows] + g * g) - np.sqrt(n[rows])) / alpha * w
            n[rows] += g * g
    w = solved(np.arange(size + 1))
    model.weights, model.bias = w[:-1], 0.1 * w[-1]

    logits = [(vectors[i][0], vectors[i][2] @ model.weights[vectors[i][1]] + model.bias) for i in kept]
    loss = lambda t: -sum(np.log(max(softmax(z / t)[y], 1e-12)) for y, z in logits)
    model.temperature = float(min(np.geomspace(0.05, 10, 60), key=loss)) if logits else 1.0
    return model


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found = [ngram_counts(t) for t in b["text"]]
        yield pd.DataFrame({"lang": b["lang"], "h": b["h"], "buckets": [x.astype(np.int32) for x, _ in found], "counts": [np.minimum(x, np.iinfo(np.int32).max).astype(np.int32) for _, x in found]})


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE, most_languages: int = MOST_LANGUAGES, most_rows: int = MOST_ROWS, most_ngrams: int = MOST_NGRAMS) -> Model:
    """A model of the rows' non-null languages, from at most `per_language` rows of each and `most_rows` in all, chosen by a hash of id and text.

    A language's rows, which are learned from whole, end where they have its share of `most_ngrams` different n-grams.

    Rows with a null or letterless text, language or id are not learned from; rows of an equal id, language and text
    are one. More than `most_languages` different languages raise ValueError.
    """
    rows = bare(docs, id_col, text_col, lang_col).toDF("id", "text", "lang").where("id is not null and text is not null and lang is not null").where(F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("h", F.xxhash64(F.col("id").cast("string"), "text", F.lit("langid")))
    # counted in bounded memory; the estimate only sets the chance by which rows enter the sample
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(most_languages + 1).collect()
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not sizes:
        return fit([])
    per_language = max(1, min(per_language, most_rows // len(sizes)))
    # of 2^30 equally likely hashes those below the language's share, a third more than wanted
    bound = {r["lang"]: min(1 << 30, ((1 << 30) * per_language * 4) // (3 * max(1, r["n"])) + 1) for r in sizes}
    share = F.map_from_arrays(F.array(*map(F.lit, bound)), F.array(*[F.lit(x) for x in bound.values()]))
    chosen = rows.where(F.pmod("h", F.lit(1 << 30)) < share[F.col("lang")]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h"))
    chosen = materialise(chosen.withColumn("n", rank).where(F.col("n") <= per_language).select("lang", "h", "text"), "languages")
    counted = materialise(chosen.mapInPandas(_counted, "lang string, h long, buckets array<int>, counts array<int>"), "ngrams")
    before = F.sum(F.size("buckets")).over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h")) - F.size("buckets")
    found = counted.withColumn("before", before).where(F.col("before") < most_ngrams // len(sizes)).select("lang", "buckets", "counts").collect()
    examples = sorted(((r["lang"], np.array(r["buckets"], dtype=np.int32), np.array(r["counts"], dtype=np.int32)) for r in found), key=lambda e: (e[0], len(e[1]), e[1].tolist(), e[2].tolist()))
    return fit(examples)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The input's rows and columns with `lang_pred` and `score` (0 to 1, calibrated) at the end.

    Null or letterless text, or a model of no language, gives `und` and 0. Columns of the input with those two names
    are replaced. Texts of any length are read whole. Repeated rows are judged alike; an empty table gives no rows.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)  # at most 2^15 buckets by MOST_LANGUAGES weights

    @F.pandas_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
    def judge(text: pd.Series) -> pd.DataFrame:
        m = broadcast.value
        return pd.DataFrame([m.predict(t) for t in text], columns=["lang", "score"])

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    (judged,) = fresh(docs, "judged")
    return docs.select(*kept, judge(F.col(f"`{text_col}`")).alias(judged)).select(*kept, F.col(judged)["lang"].alias("lang_pred"), F.col(judged)["score"].alias("score"))


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: CRC-32 of the id as text leaves 2 when divided by 4. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))
