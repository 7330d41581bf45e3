"""Web archive records: canonical URLs, and revisit records resolved to the response they repeat.

A revisit (the server said "not modified") has headers but no body. It stands for the latest earlier full response with the
same canonical URL, if their validators agree: the entity tags when the revisit has one, else the dates of last change, else
the payload digests. Its headers are those of the response, with what a not-modified answer may change taken from the revisit.

The as-of join is one pass over sorted records, without pairs. A URL with very many captures is cut into spans of time: the
last response of each span is found by partial aggregation and handed on to the later spans, and only the records of a URL
within a span are sorted together. Spans end at quantiles of the time of all records, so that records far from all others
make no span longer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.llm.arrays import let

SPAN_ROWS = 50_000
SIDE = 64  # quantiles are looked up in a list of lists, each of this length at most
# What a not-modified answer may send anew (RFC 9110, 15.4.5), in lower case. All other headers describe the stored body.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
# Query parameters that only track where a visitor came from.
TRACKING = r"(?i)^(utm_[^=]*|ref|fbclid|gclid|sessionid|phpsessid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, no scheme, user or fragment, no slash at the end of the path,
    parameters sorted and without tracking ones. Null for null; a text without ``://`` is its own canonical form."""
    rest = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)
    kept = F.sort_array(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    whole = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(url.contains("://"), whole).otherwise(url)


def _tag(tag: str) -> str:
    """Entity tags compare weakly."""
    return f"regexp_replace({tag}, '^W/', '')"


def _span(rows: DataFrame) -> Column:
    """Number of the stretch of time that a record lies in, growing with time; a stretch has about ``SPAN_ROWS`` records, however
    unevenly they lie. Its ends are quantiles, at most ``SIDE`` squared of them; between those it is cut evenly. Records without
    time lie in the first one."""
    low, high, n = rows.agg(F.min("time"), F.max("time"), F.count("*")).first()
    side = min(SIDE, math.ceil(math.sqrt(n / SPAN_ROWS)))
    if low is None or side <= 1:
        return F.lit(0)
    shares = [i / side**2 for i in range(1, side**2)]
    ends = [low, *rows.agg(F.percentile_approx("time", shares, 10 * SIDE**2)).first()[0]]
    lists = [ends[i : i + side] for i in range(0, len(ends), side)]
    pieces = math.ceil(n / (side**2 * SPAN_ROWS))
    time, first = f"coalesce(time, {low}L)", _numbers(ends[::side])
    found = let(f"size(filter({first}, c -> c <= {time})) - 1", "i", f"i * {side} + size(filter(array({', '.join(map(_numbers, lists))})[i], c -> c <= {time})) - 1")
    if pieces > 1:
        ends = [*ends, high + 1]
        reach = f"greatest(1, (ends[b + 1] - double(ends[b])) / {pieces})"
        piece = f"least({pieces - 1}, bigint(floor((double({time}) - ends[b]) / {reach})))"
        found = let(found, "b", let(_numbers(ends, "D"), "ends", f"b * {pieces} + {piece}"))
    return F.expr(found).cast("long")


def _numbers(values: list[int], kind: str = "L") -> str:
    return f"array({', '.join(f'{v}{kind}' for v in values)})"


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(record_id, url_key, type, source_id, status, headers) of every record.

    ``records``: record_id, url, time (long), type (``response`` or ``revisit``), digest, headers (map of strings, names in
    lower case). Earlier is a smaller (time, record_id); records without time are earlier than all. The status of a response
    is ``full``, its source itself; of a revisit ``resolved``, with source and merged headers, or ``changed`` (the validators
    differ or there are none to compare) or ``missing`` (no earlier response), both without source and with its own headers.
    Records without URL or with another type are ``missing``. Repeated rows are each resolved; no rows give no rows.
    """
    rows = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), F.col("time"), "type", "digest", "headers")
    rows = rows.withColumn("span", _span(rows))
    rows = rows.withColumn("time", F.coalesce("time", F.lit(-(2**63))))
    answer = F.struct("record_id", "digest", "headers")
    full = F.when(F.col("type") == "response", answer)

    responses = rows.where("type = 'response' and url_key is not null")
    last = responses.groupBy("url_key", "span").agg(F.max_by(answer, F.struct("time", "record_id")).alias("last"))
    # Every span of a URL that has records, with the last response of the spans before.
    spans = rows.where("url_key is not null").select("url_key", "span").distinct().join(last, ["url_key", "span"], "left")
    before = Window.partitionBy("url_key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("url_key", "span", F.last("last", True).over(before).alias("carried"))
    found = rows.join(spans, ["url_key", "span"], "left")
    within = Window.partitionBy("url_key", "span").orderBy("time", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = F.when(F.col("url_key").isNotNull(), F.last(full, True).over(within.partitionBy("url_key", "span", _null_part())))
    found = found.withColumn("source", F.coalesce(near, F.col("carried")))

    same = f"""case when headers['etag'] is not null then {_tag("headers['etag']")} <=> {_tag("source.headers['etag']")}
        when headers['last-modified'] is not null then headers['last-modified'] <=> source.headers['last-modified']
        else coalesce(digest = source.digest, false) end"""
    found = found.withColumn(
        "status",
        F.expr(f"""case when type = 'response' then 'full' when type = 'revisit' and source is not null
            then if({same}, 'resolved', 'changed') else 'missing' end"""),
    )
    names = ", ".join(f"'{p}'" for p in PERMITTED)
    fresh = f"map_filter(coalesce(headers, map()), (k, v) -> k in ({names}))"
    stored = f"map_filter(coalesce(source.headers, map()), (k, v) -> not map_contains_key({fresh}, k))"
    return found.select(
        "record_id",
        "url_key",
        "type",
        F.expr("case status when 'full' then record_id when 'resolved' then source.record_id end").alias("source_id"),
        "status",
        F.expr(f"if(status = 'resolved', map_concat({stored}, {fresh}), headers)").alias("headers"),
    )


def _null_part() -> Column:
    """Records without URL have no neighbours: they are dealt out instead of meeting in one window."""
    return F.when(F.col("url_key").isNull(), F.pmod(F.xxhash64("record_id"), F.lit(4096)))
