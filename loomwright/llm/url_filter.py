"""Allow and block rules on URLs: a trie over reversed host labels, and below a host over path segments.

A rule is (verdict, host, path). It fits its host and all subdomains, if the URL's path starts with the
rule's path. Of the rules that fit, the longest wins: the one with most host labels, among those the one
with the longest path; of two equal rules the block entry wins. No rule: the default verdict.

A host is what lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
the path goes on up to ``?``, ``#`` or the end. Null, and URLs without ``://``, have empty hosts and paths.
Ports and user names count as part of the host, so a rule fits only a host that ends with its labels.
The trie is broadcast; its number of rules is checked against ``MAX_RULES``. Repeated rows are judged
each, very long URLs as a whole. Columns beside id and URL are ignored. An empty table gives an empty result; no rules give the default for all.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package

#: About 300 bytes each in a worker.
MAX_RULES = 2_000_000
Rule = tuple[str, str, str]
RULES: list[Rule] = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class UrlTrie:
    """Nodes are dicts: label -> node; under ``None`` the trie of that host's path rules, whose leaves
    (under ``None`` again) are the unfinished last segments with their rules, longest first."""

    def __init__(self, rules: list[Rule]) -> None:
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(None, {})
            if ends.get(rest, ("", ""))[0] != "block":
                ends[rest] = (verdict, host + path)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule) of the longest rule that fits."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                best = self._path(node[None], path) or best
        return best

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        best = None
        for segment in path.split("/"):
            if None in node:
                fit = max((r for r in node[None] if segment.startswith(r)), key=len, default=None)
                best = best if fit is None else node[None][fit]
            node = node.get(segment)
            if node is None:
                break
        return best


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(df: DataFrame, rules: list[Rule], id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """One row for each row of ``df``: id, host, path, the rule that decided (or null), and the verdict."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(UrlTrie(rules))

    def run(batches):
        find = lru_cache(100_000)(shared.value.find)
        for batch in batches:
            found = [find(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            rule = pa.array([f and f[1] for f in found], pa.string())
            verdict = pa.array([f[0] if f else default for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], ["page_id", "host", "path", "rule", "verdict"])

    parts = df.select(F.col(id_column).cast("long").alias("page_id"), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path"))
    return parts.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT p.host, p.path, r.verdict, r.rhost || r.rpath AS rule,
         row_number() OVER (PARTITION BY p.host, p.path ORDER BY length(r.rhost) - length(replace(r.rhost, '.', '')) DESC, length(r.rpath) DESC, r.verdict DESC) AS k
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules r
    ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path AND f.k = 1
"""
