"""Allow and block lists for URLs: a trie over reversed host labels, and at each host a trie over path segments.

A rule is (host, path). It fits its host and every subdomain when the URL's path starts with the rule's path. Of the
rules that fit, the one with the most host labels wins, then the one with the longest path; of two equal rules with
different verdicts, block wins. URLs that no rule fits get the default verdict.

Defined results: a null URL, or one without ``://``, has an empty host and path and gets the default; repeated rows are
judged one by one; empty tables give empty tables; other columns are ignored, whatever their names. Only A-Z of a host are
lower-cased. The trie of up to ``MOST_RULES`` rules is broadcast; a longer list is shuffled instead, and each URL meets it
on its host's suffixes and on those prefixes of its path that are as long as a rule of that host.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, ready

#: Entries of a broadcast rule list at most (some 100 MB as a trie).
MOST_RULES = 100_000

_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @classmethod
    def of(cls, text: str, allow: bool) -> Rule:
        """From ``host/path``; the path starts at the first slash, and may be missing."""
        cut = text.find("/")
        cut = len(text) if cut < 0 else cut
        return cls(text[:cut].translate(_LOWER), text[cut:], allow)

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def verdict(self) -> str:
        return "allow" if self.allow else "block"


@dataclass
class _Segments:
    """A node of a path trie. ends: rules whose path ends inside the next segment, by the part they have of it."""

    below: dict[str, _Segments] = field(default_factory=dict)
    ends: dict[str, Rule] = field(default_factory=dict)

    def add(self, rule: Rule) -> None:
        node = self
        *whole, last = rule.path.split("/")
        for s in whole:
            node = node.below.setdefault(s, _Segments())
        held = node.ends.get(last)
        if held is None or (held.allow and not rule.allow):
            node.ends[last] = rule

    def longest(self, segments: list[str]) -> Rule | None:
        best, node = None, self
        for i, s in enumerate(segments):
            if node.ends:
                for n in sorted({len(k) for k in node.ends if len(k) <= len(s)}, reverse=True):
                    if (hit := node.ends.get(s[:n])) is not None:
                        best = hit
                        break
            if i + 1 == len(segments) or (node := node.below.get(s)) is None:
                break
        return best


@dataclass
class _Labels:
    below: dict[str, _Labels] = field(default_factory=dict)
    paths: _Segments | None = None


class UrlTrie:
    def __init__(self, rules: list[Rule], default: str = "allow") -> None:
        self.root, self.default = _Labels(), default
        for r in rules:
            node = self.root
            for label in reversed(r.host.split(".")):
                node = node.below.setdefault(label, _Labels())
            node.paths = node.paths or _Segments()
            node.paths.add(r)

    def find(self, host: str, path: str) -> Rule | None:
        node, fit, segments = self.root, None, path.split("/")
        for label in reversed(host.split(".")):
            if (node := node.below.get(label)) is None:
                break
            if node.paths is not None and (hit := node.paths.longest(segments)) is not None:
                fit = hit
        return fit


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host runs from the first ``://`` to ``/``, ``?``, ``#`` or the end, the path on to ``?`` or ``#``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    for mark in "#?":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def url_verdicts(df: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) of every row; rule is null where none fits."""
    spark = df.sparkSession
    if len(rules) > MOST_RULES:
        lines = [(r.host, r.path, r.allow) for r in rules]
        return joined_verdicts(df, spark.createDataFrame(lines, "host string, path string, allow boolean"), key, url, default)
    ready(spark)
    trie = spark.sparkContext.broadcast(UrlTrie(rules, default))
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        t = trie.value
        for b in batches:
            parts = [split_url(u) for u in b.column(1).to_pylist()]
            hits = [t.find(*p) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([h for h, _ in parts], pa.string()),
                    pa.array([p for _, p in parts], pa.string()),
                    pa.array([h and h.text for h in hits], pa.string()),
                    pa.array([h.verdict if h else t.default for h in hits], pa.string()),
                ],
                [key, "host", "path", "rule", "verdict"],
            )

    return df.select(key, url).mapInArrow(lean(run), f"`{key}` {kind}, host string, path string, rule string, verdict string")


def _parts_of(url: Column) -> tuple[Column, Column]:
    """`split_url` as columns."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.regexp_extract(F.substr(url, at + 3), "^[^?#]*", 0)).otherwise("")
    host = F.regexp_extract(rest, "^[^/]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.substr(rest, F.length(host) + 1)


def joined_verdicts(df: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """`url_verdicts` for rules (host, path, allow) of any number, host in lower case: joins on equal hosts and paths."""
    host, path = _parts_of(F.col("u"))
    urls = df.select(F.col(url).alias("u")).distinct().select("u", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = urls.select("u", F.col("path").alias("own"), F.explode(tails).alias("host"))
    one = rules.groupBy("host", "path").agg(F.min("allow").alias("allow"))  # block wins
    sizes = one.groupBy("host").agg(F.collect_set(F.length("path")).alias("sizes"))  # no more than the longest path has letters
    near = each.join(sizes, "host").select("u", "host", "own", F.explode("sizes").alias("n")).filter("n <= length(own)")
    met = near.withColumn("path", F.substr("own", F.lit(1), F.col("n"))).join(one, ["host", "path"])
    order = F.struct(F.size(F.split("host", r"\.")), F.length("path"))
    best = met.groupBy("u").agg(F.max_by(F.struct(F.concat("host", "path").alias("rule"), "allow"), order).alias("b"))
    judged = urls.join(best, "u", "left").select(F.col("u").alias("judged_url"), "host", "path", "b")
    out = df.select(F.col(key).alias("key"), F.col(url).alias("u")).join(judged, F.col("u").eqNullSafe(F.col("judged_url")))
    verdict = F.when(F.col("b.allow"), "allow").when(~F.col("b.allow"), "block").otherwise(default)
    return out.select(F.col("key").alias(key), "host", "path", F.col("b.rule").alias("rule"), verdict.alias("verdict"))
