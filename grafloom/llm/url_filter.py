"""URL filters: pattern rules indexed by their rarest literal token.

A rule is `host/path` text in which `*` stands for any characters. It fits the host and all its
subdomains, and every path that starts with its path. A rule's whole tokens (between `/` and `.`)
must occur among the tokens of any URL it fits, so it is filed under the one that is rarest in the
URLs at hand; a URL's tokens fetch candidate rules, and only those run their regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grafloom.llm.common import ascii_lower, bare

#: Characters of rules that one process holds; more are judged in blocks, a pass over the URLs each.
BLOCK_CHARS = 16_000_000
#: Tokens of rules that are sent to all executors to be counted.
MOST_BROADCAST = 100_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: str

    @property
    def regex(self) -> str:
        """Each piece between `*` at its first place after the one before: as the end is open, a fit has this one too, so no piece is tried again and time is linear."""
        first, *others = map(re.escape, self.pattern.split("*"))
        pieces = [first if self.pattern.startswith("*") else r"(?:[^/]*?\.)??" + first, *(".*?" + x for x in others)]
        if "/" not in self.pattern:
            pieces[-1] += r"(?=/|\Z)"
        return "".join(f"(?>{x})" for x in pieces)

    @property
    def tokens(self) -> list[str]:
        """Tokens that every fitting URL has whole: those not cut by `*` or by the open end of a path."""
        pieces = re.split(r"([/.])", self.pattern)
        ended = pieces[:-1] if "/" in self.pattern else pieces
        return [x for x in ended if x not in ("", "/", ".") and "*" not in x]


#: The contract's rules, and the method's own for URLs that none of them fits.
RULES = (Rule("block", "com/en/"), Rule("allow", "example.com/en/7"), Rule("allow", "net/de/"), Rule("block", "example.net/de/8"), Rule("block", "org/es/"))
OWN_RULES = (Rule("block", "*/ads/"), Rule("block", "*/adserver/"), Rule("block", "*/banners/"), Rule("block", "*/login/"), Rule("block", "*/wp-admin/"))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; then up to `?`, `#` or the end. Null or no `://`: both empty."""
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


class RuleIndex:
    def __init__(self, rules: Iterable[Rule], frequency: dict[str, int]):
        self.by: dict[str, list[Rule]] = {}
        self.compiled: dict[Rule, re.Pattern] = {}
        for rule in rules:
            token = min(rule.tokens, key=lambda t: (frequency.get(t, 0), t), default="")  # "": every URL's candidate
            self.by.setdefault(token, []).append(rule)

    def __getstate__(self) -> dict:
        return {"by": self.by, "compiled": {}}

    def _fits(self, rule: Rule, key: str) -> bool:
        """Whether the rule fits; its pattern is compiled when it is first a candidate in this process."""
        regex = self.compiled.get(rule)
        if regex is None:
            regex = self.compiled[rule] = re.compile(rule.regex, re.DOTALL)
        return regex.match(key) is not None

    def longest(self, host: str, path: str) -> Rule | None:
        """The longest fitting rule; of equally long ones an allowing rule, then the last in order of verdict and pattern."""
        key, best = host + path, None
        for token in {"", *re.split(r"[/.]", key)}:
            for rule in self.by.get(token, ()):
                if (best is None or self._rank(rule) > self._rank(best)) and self._fits(rule, key):
                    best = rule
        return best

    @staticmethod
    def _rank(rule: Rule) -> tuple:
        """The order in which `judge` also compares the findings of different blocks."""
        return len(rule.pattern), rule.verdict == "allow", rule.verdict, rule.pattern


def _blocks(rules: Iterable[Rule]) -> list[list[Rule]]:
    blocks, size = [[]], 0
    for r in rules:
        if size > BLOCK_CHARS:
            blocks.append([])
            size = 0
        blocks[-1].append(r)
        size += len(r.pattern)
    return blocks


FOUND = T.StructType([T.StructField(n, T.StringType()) for n in ("rule", "verdict", "own_rule", "own_verdict")])


def _runner(shared):
    """A function of host and path that gives the longest rule and its verdict, and the longest of the method's own."""

    @F.pandas_udf(FOUND)
    def run(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        given, own = shared.value
        found = [(given.longest(h, p), own.longest(h, p)) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame([(a and a.pattern, a and a.verdict, b and b.pattern, b and b.verdict) for a, b in found], columns=FOUND.names, dtype=object)

    return run


def judge(pages: DataFrame, rules: Iterable[Rule] = RULES, own_rules: Iterable[Rule] = OWN_RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: the id, `host`, `path`, `rule` (of `rules`, or null) and `verdict`.

    A null URL, or one without `://`, has an empty host and path and fits no rule that names a host.
    URLs that no rule fits get the verdict of the longest of `own_rules` that fits, else `default`. Of equally
    long rules an allowing one wins, then the last by verdict and pattern, however the rules are cut into blocks.
    URLs of any length are judged whole. Repeated rows are all returned, an empty table gives no rows, further
    columns are not looked at.
    """
    rules, own_rules = list(rules), list(own_rules)
    rows = bare(pages, id_col, url_col).toDF("id", "__url")
    host, path = split_url(F.col("__url"))
    rows = rows.select("id", host.alias("host"), path.alias("path"))
    wanted = sorted({t for r in [*rules, *own_rules] for t in r.tokens})
    known = pages.sparkSession.createDataFrame([(t,) for t in wanted], "t string")
    seen = rows.select(F.explode(F.split(F.concat("host", "path"), r"[/.]")).alias("t"))
    if len(wanted) <= MOST_BROADCAST:
        seen = seen.join(F.broadcast(known), "t", "left_semi").groupBy("t").count()
    else:  # counted before they meet the rules' tokens, so that a frequent one is a few rows
        seen = seen.groupBy("t").count().join(known, "t", "left_semi")
    frequency = dict(seen.collect())  # at most the rules' tokens

    blocks = [(b, []) for b in _blocks(rules)] + [([], b) for b in _blocks(own_rules)]
    for n, (given, own) in enumerate(blocks):
        shared = pages.sparkSession.sparkContext.broadcast((RuleIndex(given, frequency), RuleIndex(own, frequency)))
        rows = rows.withColumn(f"__{n}", _runner(shared)("host", "path"))
    results = [F.col(f"__{n}") for n in range(len(blocks))]
    rank = lambda p, v: F.when(p.isNotNull(), F.struct(F.length(p).alias("n"), (v == "allow").alias("a"), v.alias("v"), p.alias("p")))
    best = F.greatest(*[rank(r["rule"], r["verdict"]) for r in results], F.lit(None).cast("struct<n:int,a:boolean,v:string,p:string>"))
    mine = F.greatest(*[rank(r["own_rule"], r["own_verdict"]) for r in results], F.lit(None).cast("struct<n:int,a:boolean,v:string,p:string>"))
    return rows.select(F.col("id").alias(id_col), "host", "path", best["p"].alias("rule"), F.coalesce(best["v"], mine["v"], F.lit(default)).alias("verdict"))
