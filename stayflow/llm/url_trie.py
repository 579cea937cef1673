"""Operator 6: URL allow / block lists as a broadcast trie over reversed host labels and path segments.

The trie is built from the rule list (its size is that of the list, which the caller states) and shipped to the
tasks once as a broadcast value of checked size. Walking a URL costs one step per host label and path segment,
however many rules there are. A rule fits its host and every subdomain, if the URL's path starts with the rule's
path. Among fitting rules the deepest host wins, then the longest path; of two equal entries the later one holds.

Null, empty and scheme-less URLs have an empty host and path, fit no rule and get the default verdict; repeated rows
are judged alike, one output row per input row; an empty table gives an empty result; columns other than the key and
the URL are not read, so clashing names do no harm.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

MAX_BROADCAST_BYTES = 256 << 20


class Rule(NamedTuple):
    verdict: str  # "allow" or "block"
    host: str
    path: str  # begins with "/"

    @property
    def name(self) -> str:
        return self.host + self.path


class Node:
    """Host labels lead down; at a host, ``paths`` starts the trie of path segments. An entry at a path node holds
    what the following segment must start with (empty for a rule path that ends in a slash)."""

    __slots__ = ("labels", "paths", "segments", "entries")

    def __init__(self):
        self.labels: dict[str, Node] = {}
        self.paths: Node | None = None
        self.segments: dict[str, Node] = {}
        self.entries: list[tuple[str, Rule]] = []


def build_trie(rules: Sequence[Rule]) -> Node:
    root = Node()
    for rule in rules:
        if rule.verdict not in ("allow", "block") or not rule.path.startswith("/"):
            raise ValueError(f"not a rule: {rule}")
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.labels.setdefault(label, Node())
        node.paths = node = node.paths or Node()
        *segments, rest = rule.path[1:].split("/")
        for segment in segments:
            node = node.segments.setdefault(segment, Node())
        node.entries = [e for e in node.entries if e[0] != rest] + [(rest, rule)]
        node.entries.sort(key=lambda e: -len(e[0]))
    return root


def find(trie: Node, host: str, path: str) -> Rule | None:
    best, node = None, trie
    segments = path[1:].split("/") if path.startswith("/") else None
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        if node.paths is not None and segments is not None:
            best = _longest_path(node.paths, segments) or best
    return best


def _longest_path(node: Node, segments: list[str]) -> Rule | None:
    best = None
    for k, segment in enumerate(segments):
        tail = "/".join(segments[k:])
        best = next((rule for start, rule in node.entries if tail.startswith(start)), best)
        node = node.segments.get(segment) if k + 1 < len(segments) else None
        if node is None:
            break
    return best


_PARTS = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_UPPER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    m = _PARTS.search(url) if url else None
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


def url_filter(df: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per input row: key, host, path, rule (null if none fits), verdict."""
    spark: SparkSession = df.sparkSession
    blob = pickle.dumps(build_trie(rules))
    if len(blob) > MAX_BROADCAST_BYTES:
        raise ValueError(f"the rule trie has {len(blob)} bytes, above the broadcast bound of {MAX_BROADCAST_BYTES}")
    shipped = spark.sparkContext.broadcast(blob)
    kind = df.schema[key].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = pickle.loads(shipped.value)
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [find(trie, h, p) for h, p in parts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()),
                pa.array([r.name if r else None for r in found], pa.string()),
                pa.array([r.verdict if r else default for r in found], pa.string()),
            ], names=[key, "host", "path", "rule", "verdict"])

    return df.select(key, url).mapInArrow(judge, f"{key} {kind}, host string, path string, rule string, verdict string")


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)


# Independent form: every rule is tested on every URL with string comparisons, then the longest fitting one is taken.
OP6_SQL = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
hp AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1), '^[^?#]*', 0) AS path
  FROM parts),
rules(verdict, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (
  SELECT page_id, host, path,
         (SELECT max(struct_pack(n := length(rhost), m := length(rpath), rule := rhost || rpath, verdict := verdict)) FROM rules
          WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS b
  FROM hp)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM best
"""
