"""URL filters by a sort-merge range join.

A rule is (action, host, path): it fits its host and all subdomains of it where the url's path
starts with the rule's path. Hosts are keyed by their labels in reverse, so that a host and all its
subdomains are one interval of the sorted keys, and intervals of rules are nested or apart. Rules
and the different (host, path) of the urls are sorted together by that key and path and dealt out by
ranges. One sweep over a range keeps a stack of the hosts with rules that are open at the key; each
holds its rules' paths sorted, every path with the next shorter one that it starts with, so that the
longest that fits is found from the place of the url's path among them. A range starts with the
rules that are open at its first key: of each range only that key's ancestors are looked up.

A host of many urls is spread over ranges by path, and repeated urls are judged once.

Results for odd input: a null url, or one without ``://``, has an empty host and path, fits no
rule and gets the default verdict; repeated urls each get their row; rules given twice count once
(a ``block`` wins over an ``allow`` of the same host and path); rules without action or host don't
count. Other columns come along; those named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, shuffle_partitions, table

#: Rules of the registered query: action, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


class OpenHost:
    """The rules of one host; paths come in sorted order."""

    def __init__(self, labels: list[str]):
        self.labels, self.size, self.name = labels, len(labels), ".".join(reversed(labels))
        self.paths: list[str] = []
        self.actions: list[str] = []
        self.shorter: list[int] = []

    def add(self, path: str, action: str) -> None:
        if self.paths and self.paths[-1] == path:
            return
        self.shorter.append(self.find(path))
        self.paths.append(path)
        self.actions.append(action)

    def find(self, path: str) -> int:
        """The longest of the paths that path starts with, or -1."""
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.shorter[i]
        return i


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, labels, path, action, host) come sorted by part, labels, rules first, path."""
    stack: list[OpenHost] = []
    at, labels = None, None
    for batch in batches:
        out = []
        for part, key, path, action, host in zip(*(c.to_pylist() for c in batch.columns)):
            if part != at:
                at, labels, stack = part, None, []
            if key != labels:
                labels = key
                while stack and stack[-1].labels != key[: stack[-1].size]:
                    stack.pop()
            if action is not None:
                if not stack or stack[-1].labels != key:
                    stack.append(OpenHost(key))
                stack[-1].add(path, action)
                continue
            best, size = None, -1
            for x in stack:
                i = x.find(path)
                if i >= 0 and len(x.name) + len(x.paths[i]) >= size:
                    best, size = (x.name + x.paths[i], x.actions[i]), len(x.name) + len(x.paths[i])
            if best:
                out.append((host, path, *best))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)], ["host", "path", "rule", "action"])


def matches(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule and action of the pairs (host, path) that some rule fits; no pair twice."""
    parts = shuffle_partitions(pairs.sparkSession)
    rules = (
        rules.where("action is not null and host is not null and host <> ''")
        .groupBy(F.translate("host", UPPER, LOWER).alias("name"), F.coalesce("path", F.lit("")).alias("path"))
        .agg(F.max("action").alias("action"))
        .select(reversed_labels(F.col("name")).alias("labels"), "path", "action", F.lit(None).cast("string").alias("host"))
    )
    urls = pairs.where("host <> ''").select(reversed_labels(F.col("host")).alias("labels"), "path", F.lit(None).cast("string").alias("action"), "host")
    ranges = rules.unionByName(urls).repartitionByRange(parts, "labels", "path").select(F.spark_partition_id().alias("part"), "labels", "path", "action", "host")
    ranges = saved(ranges, "ranges")
    # rules of earlier ranges that are open where a range begins
    first = ranges.groupBy("part").agg(F.min("labels").alias("first"))
    above = first.select("part", F.explode(F.transform(F.sequence(F.lit(1), F.size("first")), lambda n: F.slice("first", 1, n))).alias("labels"))
    carried = rules.join(above, "labels").select("part", "labels", "path", "action", "host")
    rows = ranges.unionByName(carried).repartitionById(parts, F.col("part"))
    rows = rows.sortWithinPartitions("part", "labels", F.col("action").isNull(), "path")
    return rows.mapInArrow(_sweep, "host string, path string, rule string, action string")


def judge(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """All rows and columns of urls, with host, path, rule ("host/path" or null) and verdict.

    The longest rule is the one of most characters, of equally long ones the deeper host's.
    """
    url = urls[url_col]
    urls = urls.drop("host", "path", "rule", "verdict").withColumns({"host": url_host(url), "path": url_path(url)})
    best = matches(urls.groupBy("host", "path").agg(F.lit(1).alias("one")).drop("one"), rules)
    best = best.select("host", "path", F.struct("rule", "action").alias("best"))
    names = [c for c in urls.columns if c not in ("host", "path")]
    out = urls.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), "host", "path").join(best, ["host", "path"], "left")
    return out.select(*(F.col("row")[c].alias(c) for c in names), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules_frame(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


SQL = """
WITH p AS (
  SELECT page_id,
    CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
      ELSE translate(regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
    CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
      ELSE regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*([^?#]*)', 1) END AS path
  FROM pages),
r(action, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT DISTINCT host, path FROM p),
b AS (SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
        arg_max(action, length(rhost || rpath)) AS action
      FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN b ON p.host = b.host AND p.path = b.path
"""
