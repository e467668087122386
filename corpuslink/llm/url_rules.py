"""Rules on hosts and paths, joined to urls by one sorted sweep.

A host is written with its labels reversed, each followed by a full stop (``net.example.``). All
subdomains of a rule's host then form one interval of keys, and intervals nest. Urls are sorted by
key over range partitions; a rule goes to every partition its interval touches (found among the
partitions' first and last keys, two per partition). Within a partition the rows come in order of
key, rules before urls, and a stack holds the rules whose intervals are open. Per open host the
longest fitting path is looked up; the longest rule of all wins (host and path together, then the
host). Many urls with one host, or one url repeated, spread over partitions like any other rows.

Host: what stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there to ``?``, ``#`` or the end. A null url, or one without ``://``, has
both empty and fits no rule. Repeated rows are judged alike. Columns other than the id and the url
are not read. Without rules every url gets the default verdict; no urls give no rows.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslink.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _after(key: str) -> str:
    """A bound above every key that begins with ``key``: full stops end all of them."""
    return key[:-1] + "/"


_ROW = "part int, key string, kind int, path string, id bigint, host string, rule string, verdict string"


class OpenRules:
    """The stack of rules whose intervals hold the current key."""

    def __init__(self):
        self.frames: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def advance(self, key: str) -> None:
        while self.frames and not key.startswith(self.frames[-1][0]):
            self.frames.pop()

    def open(self, key: str, path: str, rule: str, verdict: str) -> None:
        self.advance(key)
        if not self.frames or self.frames[-1][0] != key:
            self.frames.append((key, {}, []))
        _, paths, lengths = self.frames[-1]
        paths.setdefault(path, (rule, verdict))
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def judge(self, key: str, path: str) -> tuple[str, str] | None:
        self.advance(key)
        best, size = None, (-1, -1)
        for host, paths, lengths in self.frames:
            for n in lengths:
                if n <= len(path) and (found := paths.get(path[:n])) is not None:
                    if (len(host) + n, len(host)) > size:
                        best, size = found, (len(host) + n, len(host))
                    break
        return best


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``id``, ``host``, ``path``, ``rule`` (host and path, or null), ``verdict``.

    ``urls``: ``id``, ``url``. ``rules``: ``host``, ``path``, ``verdict``; of equal rules the
    smallest verdict counts."""
    host, path = url_parts(F.col("url"))
    keyed = urls.select("id", host.alias("host"), path.alias("path")).withColumn("key", host_key(F.col("host")))
    sorted_urls = cut_lineage(
        keyed.repartitionByRange("key", "path", "id").withColumn("part", F.spark_partition_id())
    )
    # Two keys for each partition.
    bounds = sorted_urls.groupBy("part").agg(F.min("key"), F.max("key")).orderBy("part").collect()
    parts, lows, highs = ([b[i] for b in bounds] for i in range(3))

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                first, last = bisect_left(highs, r["key"]), bisect_right(lows, _after(r["key"]))
                rows += [r | {"part": p} for p in parts[first:last]]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(batch.schema) + [("part", pa.int32())]))

    rule_rows = (
        rules.where("host is not null and verdict is not null")
        .select(
            F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
        )
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
        .withColumn("key", host_key(F.col("host")))
        .withColumn("rule", F.concat("host", "path"))
        .mapInArrow(touched, "host string, path string, verdict string, key string, rule string, part int")
        .select("part", "key", F.lit(0).alias("kind"), "path", F.lit(None).cast("long").alias("id"), "host", "rule", "verdict")
    )
    url_rows = sorted_urls.select(
        "part", "key", F.lit(1).alias("kind"), "path", F.col("id").cast("long").alias("id"), "host",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
    )
    rows = rule_rows.union(url_rows).repartition("part").sortWithinPartitions("part", "key", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, at = OpenRules(), None
        for batch in batches:
            out = []
            columns = (batch[c].to_pylist() for c in ("part", "key", "kind", "path", "id", "host", "rule", "verdict"))
            for part, key, kind, path, id_, host, rule, verdict in zip(*columns):
                if part != at:
                    stack, at = OpenRules(), part
                if kind == 0:
                    stack.open(key, path, rule, verdict)
                else:
                    found = stack.judge(key, path)
                    out.append((id_, host, path, *(found or (None, default))))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "host", "path", "rule", "verdict"]
            )

    return rows.mapInArrow(sweep, "id bigint, host string, path string, rule string, verdict string")
