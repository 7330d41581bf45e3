"""Allow and block rules for URLs by a sort-merge range join.

The labels of a host, reversed and each ended by a dot, are its key: a rule's host and all its subdomains are the keys with its
key as prefix, an interval. Distinct hosts (so that a host with a third of all pages is one) and rules are dealt to ranges of
keys and sorted; one sweep over each range keeps the stack of rules whose interval is open. A rule that spans several ranges
begins in each of them. Ranges are cut at a sample of the hosts, which changes only their sizes.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.shared import written

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PER_RANGE = 20  # sampled hosts for each range border
DEFAULT = "allow"  # the verdict where no rule fits
RULE = "struct<rule:string,path:string,verdict:string>"


def with_parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """``df`` with host and path: both empty for a null url and one without ``://``."""
    url = F.coalesce(df[url_col], F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return df.withColumns({"host": F.translate(host, CAPITALS, CAPITALS.lower()), "path": path})


def host_key(host: str):
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _dealt(borders):
    """Rows with the range they fall into; a rule in each range that its interval touches."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = borders.value
        for batch in found:
            ranges, rows = [], []
            for i, (key, rule) in enumerate(zip(batch["key"].to_pylist(), batch["rule"].to_pylist(), strict=True)):
                first = last = bisect_right(cuts, key.encode())
                if rule is not None:
                    last = bisect_right(cuts, key.encode()[:-1] + b"/")
                for r in range(first, last + 1):
                    ranges.append(r)
                    rows.append(i)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int64()), *taken.columns], ["range", *batch.schema.names])

    return batches


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, stack = None, []
    for batch in batches:
        hosts, rules = [], []
        columns = (batch[c].to_pylist() for c in ("range", "key", "host", "rule", "path", "verdict"))
        for part, key, host, rule, path, verdict in zip(*columns, strict=True):
            if part != now:
                now, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, {"rule": rule, "path": path, "verdict": verdict}))
            elif stack:
                hosts.append(host)
                rules.append(sorted((r for _, r in stack), key=lambda r: (-len(r["rule"]), r["rule"])))
        kind = pa.list_(pa.struct([(n, pa.string()) for n in ("rule", "path", "verdict")]))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(rules, kind)], ["host", "rules"])


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules) of each host that a rule covers: these rules, the longest first. ``hosts`` has distinct, non-empty hosts."""
    session = hosts.sparkSession
    parts = int(session.conf.get("spark.sql.shuffle.partitions"))
    keyed = written(hosts.select(host_key("host").alias("key"), "host"), "hosts")
    every = max(1, keyed.count() // (PER_RANGE * parts))
    sample = sorted(r.key.encode() for r in keyed.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("key").collect())
    borders = session.sparkContext.broadcast(sample[PER_RANGE::PER_RANGE])
    nothing = [F.lit(None).cast("string").alias(n) for n in ("rule", "path", "verdict")]
    rows = keyed.select("key", "host", *nothing).union(
        rules.select(host_key("host"), F.lit(None).cast("string"), "rule", "path", "verdict")
    )
    schema = "range long, key string, host string, rule string, path string, verdict string"
    dealt = rows.mapInArrow(_dealt(borders), schema).repartition(parts, "range")
    # Rules come before the hosts of the same key.
    ordered = dealt.sortWithinPartitions("range", "key", F.col("rule").isNull(), "rule")
    return ordered.mapInArrow(_sweep, f"host string, rules array<{RULE}>")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row, null ids and repeated rows included.

    ``rules`` has (rule, host, path, verdict); a rule fits its host and the hosts below it where the url's path begins with
    the rule's. The longest rule that fits decides; where none does the rule is null and the verdict ``allow``. Null urls and
    urls without ``://`` fit no rule. No rules or no pages are no error.
    """
    given = with_parts(pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url")))
    hosts = given.where("host <> ''").select("host").distinct()
    covered = written(host_rules(hosts, rules), "host_rules")
    found = given.join(covered, "host", "left").withColumn("fits", F.expr("get(filter(rules, r -> startswith(path, r.path)), 0)"))
    verdict = F.coalesce(F.col("fits.verdict"), F.lit(DEFAULT))
    return found.select("page_id", "host", "path", F.col("fits.rule").alias("rule"), verdict.alias("verdict"))


def rule_table(session, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, host, path, verdict) from pairs of verdict and rule, a rule being a host and, from the first slash on, a path."""
    rows = [(rule, rule.partition("/")[0].lower(), "/" + rule.partition("/")[2], verdict) for verdict, rule in rules]
    return session.createDataFrame(rows, "rule string, host string, path string, verdict string")
