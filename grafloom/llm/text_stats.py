"""Statistics of whole texts as DataFrame expressions; used by quality rules and mixing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grafloom.llm.common import UPPER, words

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def with_stats(df: DataFrame, text: str) -> DataFrame:
    """df with `n_words`, `word_chars`, `n_symbols`, `n_upper`, `n_lines`, `n_dup_lines` and `n_repeat_words` (long) of its column `text`.

    Words are runs of characters other than space and U+0009 to U+000D. Null text has none of anything.
    A repeated word lies in a window of three words whose like occurs elsewhere in the text; windows
    are compared by 64-bit hashes, and sorted with their places only in texts where some are equal.
    """
    t, w, h, s = F.col(text), F.col("__w"), F.col("__h"), F.col("__s")
    df = df.withColumn("__w", words(F.coalesce(t, F.lit(""))))
    lines = F.filter(F.split(F.coalesce(t, F.lit("")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    whole = F.length(F.coalesce(t, F.lit("")))
    df = df.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": _without(F.coalesce(t, F.lit("")), SPACE).cast("long"),
            "n_symbols": (whole - _without(F.coalesce(t, F.lit("")), SYMBOLS)).cast("long"),
            "n_upper": (whole - _without(F.coalesce(t, F.lit("")), UPPER)).cast("long"),
            "__l": lines,
            "__h": F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))),
        }
    ).drop("__w")
    df = df.withColumns({"n_lines": F.size("__l").cast("long"), "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"), "__s": F.when(F.size(F.array_distinct(h)) < F.size(h), F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i")))))}).drop("__l", "__h")
    same = lambda e, j: ((j > 0) & (F.get(s, j - 1)["x"] == e["x"])) | F.coalesce(F.get(s, j + 1)["x"] == e["x"], F.lit(False))
    df = df.withColumn("__p", F.sort_array(F.transform(F.filter(s, same), lambda e: e["i"]))).drop("__s")
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate("__p", start, lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__p")
