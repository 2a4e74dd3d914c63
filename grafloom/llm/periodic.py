"""Periodic runs of words: stretches that repeat themselves at least MIN_EXPONENT times.

All-lag scan: a document's word numbers are compared, as arrays, with their own shift by every lag up to
n / MIN_EXPONENT, many lags in one numpy operation, and true stretches are measured. A stretch of lag q that is
long enough is a run of period q, unless a run whose period divides q covers it. A document whose lags are too many for one task is
spread over several by ranges of lags; what they find is put together by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grafloom.llm.common import bare, materialise, words

MIN_LENGTH, MIN_EXPONENT = 24, 3
#: Comparisons of words by one task for one document; documents that may need more are spread over ranges of lags.
MOST_COMPARED = 1 << 28
#: Comparisons in one numpy operation.
BLOCK = 1 << 21
#: Partitions that ranges of lags are dealt to, at most.
MOST_PARTITIONS = 20_000


def numbered(found: list[bytes]) -> np.ndarray:
    """Words as numbers: equal words have equal ones."""
    seen: dict[bytes, int] = {}
    ids = [seen.setdefault(w, len(seen)) for w in found]
    return np.array(ids, dtype=np.int16 if len(seen) < 1 << 15 else np.int32)


def stretches(ids: np.ndarray, low: int, high: int, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, lag) of every longest stretch that repeats itself after `lag` words, for lags from low to high, if long enough for a run."""
    n, out = len(ids), []
    if n < min_length or low > high:
        return out
    shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate([ids, np.full(high, -1, dtype=ids.dtype)]), n)
    step = max(1, BLOCK // n)
    for first in range(low, high + 1, step):
        lags = np.arange(first, min(first + step, high + 1))
        least = np.maximum(np.maximum(min_length - lags, (min_exponent - 1) * lags), 1)
        same = shifted[first : first + len(lags)] == ids
        # 15 equal words in a row fill a byte of the packed rows
        promising = (np.packbits(same, axis=1) == 255).any(axis=1) if least.min() >= 15 else same.any(axis=1)
        for row in np.flatnonzero(promising):
            edges = np.flatnonzero(np.diff(same[row].view(np.int8), prepend=0, append=0))
            begin, size = edges[::2], edges[1::2] - edges[::2]
            long_enough = size >= least[row]
            q = int(lags[row])
            out += [(int(s), int(k) + q, q) for s, k in zip(begin[long_enough], size[long_enough], strict=True)]
    return out


def primitive(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The stretches whose lag is their smallest period, by start and period."""
    out: list[tuple[int, int, int]] = []
    kept = np.zeros((3, max(16, len(found))), dtype=np.int64)
    for start, length, q in sorted(found, key=lambda x: x[2]):
        s, e, p = kept[:, : len(out)]
        if not ((q % np.maximum(p, 1) == 0) & (s <= start) & (e >= start + length)).any():
            kept[:, len(out)] = start, start + length, q
            out.append((start, length, q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def collapse(found: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words, joined by spaces, without those that a run repeats: what follows its first period."""
    drop = np.zeros(len(found), dtype=bool)
    for start, length, q in runs:
        drop[start + q : start + length] = True
    return b" ".join(w for w, gone in zip(found, drop.tolist(), strict=True) if not gone).decode()


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _triples(runs: list[tuple[int, int, int]]) -> list[int]:
    return [x for run in runs for x in run]


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    return (x.as_py() for x in batch.column("text"))


def _finished(min_length: int, min_exponent: int):
    def do(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, left = [], []
            given = batch.column("found").to_pylist() if "found" in batch.schema.names else None
            for i, text in enumerate(_texts(batch)):
                found = _split(text)
                if given is None:
                    at = stretches(numbered(found), 1, len(found) // min_exponent, min_length, min_exponent)
                else:
                    flat = given[i] or []
                    at = list(zip(flat[::3], flat[1::3], flat[2::3], strict=True))
                own = primitive(at)
                runs.append(_triples(own))
                left.append(collapse(found, own))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(runs, pa.list_(pa.int64())), pa.array(left, pa.string())], names=["id", "runs", "collapsed"])

    return do


def _ranges(min_length: int, min_exponent: int):
    def do(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = batch.column("low").to_pylist(), batch.column("high").to_pylist()
            found = [_triples(stretches(numbered(_split(text)), a, b, min_length, min_exponent)) for text, a, b in zip(_texts(batch), low, high, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(found, pa.list_(pa.int64()))], names=["rid", "found"])

    return do


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, most_compared: int = MOST_COMPARED) -> DataFrame:
    """One row per input row: the id, `runs` (array of start, length, period, by start and period) and `collapsed`.

    A run is a stretch of words with smallest period q and at least max(min_length, min_exponent * q) words, which no
    neighbouring word extends with that period; min_exponent is 2 at least. `collapsed` is the words joined by single spaces, without those
    after the first period of any run. Null, empty and wordless texts have no runs and an empty `collapsed`; texts
    of any length are scanned whole; runs may overlap; repeated rows and null ids are returned as they are; an empty
    table gives no rows; further columns are not looked at.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 at least")
    rows = bare(docs, id_col, text_col).toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, runs array<bigint>, collapsed string"
    # words are at most half the characters, and comparisons the words squared over min_exponent
    long = int(2 * (min_exponent * most_compared) ** 0.5)
    is_long = F.coalesce(F.length("text") > long, F.lit(False))
    out = rows.where(~is_long).mapInArrow(_finished(min_length, min_exponent), schema)
    spread = materialise(rows.where(is_long).withColumn("rid", F.monotonically_increasing_id()), "long-texts")
    if not spread.isEmpty():
        lags = spread.select("rid", "text", F.size(words(F.col("text"))).alias("n")).where(F.col("n") >= min_exponent)
        step = F.greatest(F.lit(1), F.lit(most_compared) / F.col("n")).cast("int")
        last = (F.col("n") / min_exponent).cast("int")
        lags = lags.select("rid", "text", last.alias("last"), step.alias("step"), F.explode(F.sequence(F.lit(1), last, step)).alias("low"))
        lags = lags.select("rid", "text", "low", F.least(F.col("low") + F.col("step") - 1, "last").alias("high"))
        n = min(MOST_PARTITIONS, max(1, lags.select("rid").count()))
        found = lags.repartition(n, "rid", "low").mapInArrow(_ranges(min_length, min_exponent), "rid bigint, found array<bigint>")
        found = found.where(F.size("found") > 0).groupBy("rid").agg(F.flatten(F.collect_list("found")).alias("found"))  # fewer than the document's words
        out = out.unionByName(spread.join(materialise(found, "stretches"), "rid", "left").select("id", "text", "found").mapInArrow(_finished(min_length, min_exponent), schema))
    at = lambda i, k: F.get("runs", i * 3 + k)
    runs = F.transform(F.sequence(F.lit(0), (F.size("runs") / 3).cast("int") - 1), lambda i: F.struct(at(i, 0).alias("start"), at(i, 1).alias("length"), at(i, 2).alias("period")))
    runs = F.when(F.size("runs") > 0, runs).otherwise(F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>"))
    return out.select(F.col("id").alias(id_col), runs.alias("runs"), "collapsed")
