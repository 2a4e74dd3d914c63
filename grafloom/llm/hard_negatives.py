"""Hard negatives by product quantisation with residual norms.

Vectors are whole numbers. Codebooks of whole-number centroids, fitted on a bounded sample, turn every row into one byte a
subspace, kept with the exact norm of what the code misses. For an anchor a table of its inner products with all
centroids gives the score of any code by look-ups; by Cauchy-Schwarz the true score is within the anchor's norm times the residual's
norm of that. Rows whose bounds can't reach an answer are passed over; the others' true scores are reckoned from the
whole numbers, so that answers are exact for any codebook.

Rows are packed into blocks, and each block meets the blocks of anchors, which are broadcast in groups of a bounded
size. A task returns its best few rows for an anchor and a window, and a window function picks the best of all tasks.
Of rows with equal label and vector only the first few ids can ever be returned, and only they are packed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grafloom.llm.common import bare, materialise

#: Dimensions of a subspace, centroids of each, and rows that they are fitted on at most: those of the smallest id hashes.
DIMS, CENTROIDS, MOST_FITTED, FIT_STEPS = 2, 256, 4096, 6
#: Anchors in a block, rows in a block, and anchors that are broadcast at once.
ANCHOR_BLOCK, ROW_BLOCK, MOST_BROADCAST = 256, 4096, 1 << 16
#: Largest component, so that scores fit 64 bits.
MOST = 1 << 23


def codebooks(sample: np.ndarray, dims: int = DIMS, centroids: int = CENTROIDS, steps: int = FIT_STEPS) -> np.ndarray:
    """(subspaces, centroids, dims) whole-number centroids by k-means, for a sample whose width is a multiple of dims."""
    out = []
    for part in np.split(sample.astype(np.float64), sample.shape[1] // dims, axis=1):
        places = np.linspace(0, len(part) - 1, centroids).astype(int)
        c = part[np.lexsort(part.T[::-1])][places]
        for _ in range(steps):
            near = _nearest(part, c)
            n = np.bincount(near, minlength=centroids)
            for d in range(dims):
                c[n > 0, d] = np.bincount(near, part[:, d], centroids)[n > 0] / n[n > 0]
        out.append(np.rint(c))
    return np.array(out).astype(np.int64)


def _nearest(part: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(axis=1) - 2 * part @ c.T, axis=1)


def encode(v: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A byte a subspace, and the residuals' norms rounded up."""
    m, _, dims = books.shape
    codes = np.empty((len(v), m), dtype=np.uint8)
    left = np.zeros(len(v))
    for i in range(m):
        part = v[:, i * dims : (i + 1) * dims]
        codes[:, i] = _nearest(part.astype(np.float64), books[i].astype(np.float64))
        r = (part - books[i][codes[:, i]]).astype(np.float64)
        left += (r * r).sum(axis=1)
    return codes, _norm(left)


def _norm(squares: np.ndarray) -> np.ndarray:
    """Square roots, never too small."""
    return np.sqrt(squares) * (1 + 1e-12)


def _kth(x: np.ndarray, k: int) -> int | None:
    """The k-th largest, if there are so many."""
    return int(np.partition(x, len(x) - k)[len(x) - k]) if len(x) >= k else None


def _packer(books: np.ndarray | None, width: int, size: int, extra: list[str]):
    """Packs rows (id, label, v, ...) into rows of `size` at most; with codebooks also codes and residual norms."""

    def do(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), size):
                f = frame.iloc[at : at + size]
                v = np.zeros((len(f), width), dtype=np.int64)
                for i, x in enumerate(f["v"]):
                    v[i, : len(x)] = x
                row = {"n": len(f), "ids": f["id"].to_numpy(np.int64).tobytes(), "labels": f["label"].to_numpy(np.int64).tobytes(), "vectors": v.astype(np.int32).tobytes()}
                if books is not None:
                    codes, norms = encode(v, books)
                    row |= {"codes": codes.T.tobytes(), "norms": norms.tobytes()}
                for name in extra:
                    row[name] = np.array(f[name].tolist(), dtype=np.int64).tobytes()
                yield pd.DataFrame([row])

    return do


def _scorer(books: np.ndarray, width: int, positives: int, negatives: int, window: tuple[int, int, int] | None):
    """(anchor, nth, id, score) of a task's best rows: without a window of the anchor's label, else of other labels, in each positive's window."""
    m, _, dims = books.shape

    def tables(a: np.ndarray) -> np.ndarray:
        return np.einsum("amd,mkd->mak", a.reshape(len(a), m, dims), books)

    def looked_up(table: np.ndarray, rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), codes.shape[1]), dtype=np.int64)
        for i in range(m):
            out += table[i][rows][:, codes[i]]
        return out

    def do(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[tuple] = []
        size, last, table = 0, None, None

        def best(parts: list[tuple]) -> pd.DataFrame:
            found = pd.DataFrame({c: np.concatenate([p[i] for p in parts]) if parts else np.array([], dtype=np.int64) for i, c in enumerate(("anchor", "nth", "id", "score"))})
            return found.sort_values(["anchor", "nth", "score", "id"], ascending=[True, True, False, True]).groupby(["anchor", "nth"]).head(negatives if window else positives)

        def add(anchor: int, nth: int, ids: np.ndarray, scores: np.ndarray) -> None:
            nonlocal size
            parts.append((np.full(len(ids), anchor), np.full(len(ids), nth), ids, scores))
            size += len(ids)

        for frame in frames:
            for r in frame.itertuples(index=False):
                ids, labels = np.frombuffer(r.ids, np.int64), np.frombuffer(r.labels, np.int64)
                v = np.frombuffer(r.vectors, np.int32).reshape(r.n, width)
                codes, norms = np.frombuffer(r.codes, np.uint8).reshape(m, r.n), np.frombuffer(r.norms)
                a_ids, a_labels = np.frombuffer(r.a_ids, np.int64), np.frombuffer(r.a_labels, np.int64)
                a = np.frombuffer(r.a_vectors, np.int32).reshape(r.a_n, width).astype(np.int64)
                if last != r.block:
                    table, last = tables(a), r.block
                a_norms = _norm((a.astype(np.float64) ** 2).sum(axis=1))
                exact = lambda i, at: v[at].astype(np.int64) @ a[i]  # noqa: B023, E731
                if window is None:
                    for label in np.intersect1d(labels, a_labels):
                        mine, there = np.flatnonzero(a_labels == label), np.flatnonzero(labels == label)
                        score = looked_up(table, mine, codes[:, there])
                        slack = np.ceil(a_norms[mine, None] * norms[None, there]).astype(np.int64)
                        for i, s, e in zip(mine, score, slack, strict=True):
                            other = ids[there] != a_ids[i]
                            at = np.flatnonzero(other & (s + e >= t)) if (t := _kth((s - e)[other], positives)) is not None else np.flatnonzero(other)
                            add(a_ids[i], 0, ids[there][at], exact(i, there[at]))
                else:
                    wanted = np.frombuffer(r.a_wanted, np.int64).reshape(r.a_n, positives)
                    counts = np.frombuffer(r.a_count, np.int64)
                    low, high, whole = window
                    score = looked_up(table, np.arange(r.a_n), codes)
                    slack = np.ceil(a_norms[:, None] * norms[None, :]).astype(np.int64)
                    for i in range(r.a_n):
                        own = wanted[i, : counts[i]]
                        bounds = [(-(-low * int(p) // whole), high * int(p) // whole) for p in own]
                        if not bounds:
                            continue
                        least, most = score[i] - slack[i], score[i] + slack[i]
                        at = np.flatnonzero((labels != a_labels[i]) & (most >= min(b[0] for b in bounds)) & (least <= max(b[1] for b in bounds)))
                        least, most = least[at], most[at]
                        for nth, (lo, hi) in enumerate(bounds):
                            may = (most >= lo) & (least <= hi)
                            if (t := _kth(least[(least >= lo) & (most <= hi)], negatives)) is not None:
                                may &= most >= t
                            s = exact(i, at[may])
                            inside = (s >= lo) & (s <= hi)
                            add(a_ids[i], nth, ids[at[may]][inside], s[inside])
                if size > 1_000_000:
                    merged = best(parts)
                    parts[:] = [tuple(merged[c].to_numpy() for c in merged.columns)]
                    size = 0
        yield best(parts)

    return do


def _scored(blocks: DataFrame, anchors: DataFrame, most_broadcast: int, *how) -> DataFrame:
    """Each block of rows with each block of anchors, which are broadcast in groups of a bounded size."""
    at_once, n = max(1, most_broadcast // ANCHOR_BLOCK), anchors.count()
    out = None
    for first in range(0, n, at_once):
        last = min(first + at_once, n) - 1
        some = anchors.where(F.col("block").between(first, last))
        pairs = blocks.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(last)))).join(F.broadcast(some), "block")
        found = pairs.mapInPandas(_scorer(*how), "anchor long, nth long, id long, score long")
        out = found if out is None else out.unionByName(found)
    return out


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of each anchor and window, numbered from 1; Spark cuts to k within each task before the exchange."""
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = 5, negatives: int = 10, window: tuple[int, int, int] = (30, 90, 100), scale: float = 256.0, most_fitted: int = MOST_FITTED, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`) for every row where is_anchor (of the id column) holds.

    Components become floor(scale * x), scores are their inner products; higher ones come first, ties by smaller id. The
    positives are the first rows of the anchor's label, but for itself; the negatives of a positive are
    the first rows of other labels whose score, times the window's third number, is between its first and second times the
    positive's score. Rows with a null id, label, vector or component, or a component that isn't finite, take no
    part; of rows that repeat an id that of the smallest label and vector does. Missing components of
    shorter vectors count as 0. A positive without negatives gives no rows, an empty table none. Ids and labels are
    whole numbers; a component of 2^23 or more after scaling raises. Further columns are not looked at.
    """
    spark = rows.sparkSession
    low, high, whole = window
    if not 0 <= low <= high or whole <= 0:
        raise ValueError("the window's numbers must be 0 <= low <= high and a positive whole")
    x = bare(rows, id_col, label_col, vector_col).toDF("id", "label", "x").where("id is not null and label is not null and x is not null")
    x = x.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("x").cast("array<double>").alias("x"))
    x = x.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    floor = F.transform("x", lambda c: F.floor(c * scale))
    x = x.select("id", "label", floor.alias("v"), F.col("id").alias(id_col)).withColumn("is_anchor", is_anchor).drop(id_col) if id_col != "id" else x.select("id", "label", floor.alias("v")).withColumn("is_anchor", is_anchor)
    x = materialise(x, "vectors")
    if not (again := materialise(x.groupBy("id").count().where("count > 1").select("id"), "repeated")).isEmpty():
        one = x.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "v", "is_anchor")).alias("r")).select("id", "r.*")
        x = materialise(x.join(again, "id", "left_anti").unionByName(one), "vectors")

    stats = x.agg(F.max(F.size("v")).alias("width"), F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("most")).first()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if stats["width"] is None:
        return empty
    if (stats["most"] or 0) >= MOST:
        raise ValueError(f"components must be below {MOST} after scaling")
    width = max(1, -(-stats["width"] // DIMS)) * DIMS
    sample = np.zeros((most_fitted, width), dtype=np.int64)
    drawn = x.orderBy(F.xxhash64("id"), "id").limit(most_fitted).select("v").collect()  # bounded by most_fitted
    for i, r in enumerate(drawn):
        sample[i, : len(r["v"])] = r["v"]
    books = codebooks(sample[: len(drawn)])

    copies = Window.partitionBy("label", "v").orderBy("id")
    packed = "n int, ids binary, labels binary, vectors binary"
    able = x.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= max(negatives, positives + 1)).select("id", "label", "v")
    blocks = materialise(able.mapInPandas(_packer(books, width, ROW_BLOCK, []), f"{packed}, codes binary, norms binary"), "blocks")

    def numbered_blocks(anchors: DataFrame, extra: list[str]) -> DataFrame:
        made = materialise(anchors.mapInPandas(_packer(None, width, ANCHOR_BLOCK, extra), ", ".join([packed, *[f"{e} binary" for e in extra]])).withColumn("at", F.monotonically_increasing_id()), "anchors")
        # blocks are numbered without gaps by a table of the few numbers of blocks in each partition
        per = made.groupBy(F.shiftright("at", 33).alias("p")).count()
        before = per.withColumn("before", F.sum("count").over(Window.orderBy("p")) - F.col("count")).select("p", "before")
        made = made.withColumn("p", F.shiftright("at", 33)).join(F.broadcast(before), "p")
        made = made.withColumn("block", (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).cast("int"))
        return materialise(made.select("block", *[F.col(c).alias(f"a_{c}") for c in ("n", "ids", "labels", "vectors", *extra)]), "anchors")

    anchors = materialise(x.where("is_anchor").select("id", "label", "v"), "queries")
    if anchors.isEmpty():
        return empty
    found = _scored(blocks, numbered_blocks(anchors, []), most_broadcast, books, width, positives, negatives, None)
    pairs = materialise(_first(found, positives).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), (F.col("rank") - 1).alias("nth")), "positives")
    own = pairs.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "positive_score"))).alias("p"))  # at most `positives` an anchor
    filled = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(F.get("p", i)["positive_score"], F.lit(0)))
    queries = anchors.join(own, F.col("id") == F.col("anchor")).select("id", "label", "v", filled.alias("wanted"), F.size("p").alias("count"))
    if queries.isEmpty():
        return empty
    found = _scored(blocks, numbered_blocks(queries, ["wanted", "count"]), most_broadcast, books, width, positives, negatives, window)
    best = _first(found, negatives).select("anchor", "nth", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(pairs, ["anchor", "nth"]).select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
