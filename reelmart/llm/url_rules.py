"""URL filters by a sort-merge range join and a sweep over nested rules.

A host is written label by label from the right, each label closed by ``\\x01``:
all subdomains of a rule's host then lie in one interval of keys, and the
intervals of nested hosts nest. Urls and rule intervals are dealt to ranges of
the key by sampled splitters (a rule goes to every range that it overlaps) and
sorted; one pass over a range keeps the rules that are open on a stack. The
key of a url ends with its path and page id, so that a host with a third of all
pages is dealt over many ranges; rows of one key share all ranges that begin
with it.

A rule fits if its host is the url's host or a parent of it and the url's path
starts with the rule's path. The longest rule (characters of host and path)
wins; of equally long ones ``block``, then the longer host. Without a rule the verdict is
``default``.

Defined cases: a null url, or one without ``://``, has an empty host and path
and no rule; a null page_id stays null; repeated rows each give a row; rules of
the same host and path count once, ``block`` first; very long urls and characters
of any plane are taken whole; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import bounds_of, runs

#: rules of the registered query: verdict, host, path
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: keys sampled for the splitters
SAMPLE = 4096
SEED = 29
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """(host, path) of a url; both empty if it is null or has no ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    start = F.locate("://", u)
    rest = F.when(start > 0, F.substring(u, start + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def reversed_host(host: Column) -> Column:
    labels = F.reverse(F.split(host, "\\."))
    return F.when(host == "", "").otherwise(
        F.concat(F.concat_ws("\x01", labels), F.lit("\x01")))


def parts_of(marks: list[str], key: Column, upto: bool) -> Column:
    """How many splitters are before a key (``upto``: at or before it), by two
    short searches: the block of splitters, then the place in it."""
    if not marks:
        return F.lit(0)
    wide = max(1, math.isqrt(len(marks)))
    blocks = [marks[i:i + wide] for i in range(0, len(marks), wide)]
    passed = (lambda m: m <= key) if upto else (lambda m: m < key)
    heads = F.size(F.filter(F.array(*[F.lit(b[0]) for b in blocks]), passed))
    block = F.get(F.array(*[F.array(*[F.lit(m) for m in b]) for b in blocks]), heads - 1)
    return F.when(heads == 0, 0).otherwise((heads - 1) * wide + F.size(F.filter(block, passed)))


def sweep(default: str):
    """The pass over ranges sorted by (part, key, kind)."""

    def one(frame: pd.DataFrame, stack: list) -> pd.DataFrame | None:
        """A run of rows with one part and one reversed host; ``stack`` is kept."""
        host_key = frame["host_key"].iloc[0]
        opened = frame[frame["kind"] == 0]
        while stack and not host_key.startswith(stack[-1][0]):
            stack.pop()
        if len(opened):
            stack.append((host_key, sorted(zip(opened["path"], opened["rule"], opened["verdict"]))))
        urls = frame[frame["kind"] == 1]
        if not len(urls):
            return None
        fits = sorted(((len(rule), verdict == "block", len(rule) - len(path), path, rule, verdict)
                       for _, rules in stack for path, rule, verdict in rules))
        rule = np.full(len(urls), None, object)
        verdict = np.full(len(urls), default, object)
        paths = urls["path"]
        for _, _, _, prefix, text, say in fits:  # the longest is written last
            hit = paths.str.startswith(prefix).to_numpy(bool)
            rule[hit], verdict[hit] = text, say
        return pd.DataFrame({"page_id": urls["page_id"], "host": urls["host"],
                             "path": paths, "rule": rule, "verdict": verdict})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack, part = [], None
        for frame in runs(frames, ["part", "host_key"]):
            cuts, out = bounds_of(frame, ["part", "host_key"]), []
            for a, b in zip(cuts[:-1], cuts[1:]):
                rows = frame.iloc[a:b]
                if rows["part"].iloc[0] != part:
                    stack, part = [], rows["part"].iloc[0]
                got = one(rows, stack)
                if got is not None:
                    out.append(got)
            if out:
                yield pd.concat(out)

    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    ``rules``: (verdict, host, path), hosts in lower case.
    """
    spark = pages.sparkSession
    host, path = url_parts()
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("host_key", reversed_host(F.col("host")))
    place = F.concat("host_key", F.lit("\x02"), "path", F.lit("\x02"),
                     F.lpad(F.coalesce(F.col("page_id").cast("string"), F.lit("")), 20, "0"))
    urls = urls.withColumn("key", place)
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # about SAMPLE rows come to the driver; equal rows are drawn one by one, so a
    # key of many rows stands at several splitters and its rows share those ranges
    share = SAMPLE / max(1, pages.count())
    drawn = sorted(r["key"] for r in urls.where(F.rand(SEED) < share).select("key").collect())
    marks = [drawn[i * len(drawn) // parts] for i in range(1, parts)] if drawn else []
    low_part, high_part = (parts_of(marks, F.col("key"), upto) for upto in (False, True))
    part = low_part + F.floor(F.rand(SEED + 1) * (high_part - low_part + 1)).cast("int")
    urls = urls.select(part.alias("part"), "key", F.lit(1).alias("kind"),
                       "host_key", "host", "path", "page_id",
                       F.lit(None).cast("string").alias("rule"),
                       F.lit(None).cast("string").alias("verdict"))
    kinds = dict(pages.dtypes)["page_id"]
    once = rules.where("host <> ''").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    low = reversed_host(F.col("host"))
    # its subdomains' keys begin with ``low``; the next sign after its last one ends them
    end = F.concat(F.expr("substring(low, 1, length(low) - 1)"), F.lit("\x02"))
    opened = once.withColumn("low", low).withColumn("end", end).select(
        F.explode(F.sequence(parts_of(marks, F.col("low"), False),
                             parts_of(marks, F.col("end"), True))).alias("part"),
        low.alias("key"), F.lit(0).alias("kind"), low.alias("host_key"), "host", "path",
        F.lit(None).cast(kinds).alias("page_id"), F.concat("host", "path").alias("rule"), "verdict")
    events = (urls.unionByName(opened).repartition(parts, "part")
              .sortWithinPartitions("part", "key", "kind").drop("key"))
    return events.mapInPandas(sweep(default), schema=(
        f"page_id {kinds}, host string, path string, rule string, verdict string"))


def rules_frame(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")
