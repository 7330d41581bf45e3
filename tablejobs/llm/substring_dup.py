"""Passages that occur more than once, by a sparse suffix array.

Only the suffixes that begin at minimisers are kept: in every window of ``PASSAGE`` words the smallest hash of its runs of
``GRAM`` words names one place, and equal passages name the same place wherever they stand. Suffixes are brought in the order
of the hash of their first ``GRAM`` words, where equal beginnings are neighbours. Neighbours are compared and extended: each
kept suffix stands for the passages that name it, which reach from some words left of it to some right. Where that whole
stretch occurs again, all of it is repeated. Where only neighbours with another stretch exist, the match ends somewhere inside,
and its passages are compared one by one. So a word is repeated exactly if it lies in a run of ``PASSAGE`` words that occurs
at another place, in another row or the same one. Words are runs without ASCII white space, A-Z in lower case.

No group is gathered: stretches and passages are counted by hash, with partial sums before each shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm import text as T
from tablejobs.llm.shared import written

PASSAGE = 50
GRAM = 16


def _passages(value: str | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, hash of each passage, hash of each run of ``GRAM`` words."""
    data = T.lowered(value)
    words = T.word_hashes(data, *T.word_places(data, T.NOT_SPACE))
    if len(words) < PASSAGE:
        return len(words), np.zeros(0, T.U64), np.zeros(0, T.U64)
    return len(words), T.ngram_hashes(words, PASSAGE), T.ngram_hashes(words, GRAM)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row its number of words and, as lists, its kept suffixes: hash of the beginning, hash of the whole stretch,
    first passage and number of passages that name it."""
    for batch in batches:
        counts, parts = [], [[], [], [], []]
        for value in batch["text"]:
            n, passages, grams = _passages(value.as_py())
            counts.append(n)
            if not len(passages):
                for p in parts:
                    p.append([])
                continue
            span = PASSAGE - GRAM + 1
            places = np.arange(len(passages)) + sliding_window_view(grams, span).argmin(axis=1)
            first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
            last = np.r_[first[1:], len(places)] - 1
            at = places[first]
            shape = ((at - first) * PASSAGE + (last - first)).astype(T.U64)
            stretch = T.mix(passages[first] + T.mix(passages[last] + T.mix(shape + T.U64(1))))
            for p, column in zip(parts, (grams[at].view(np.int64), stretch.view(np.int64), first, last - first + 1), strict=True):
                p.append(column.astype(np.int64))
        arrays = [pa.array(p, pa.list_(pa.int64())) for p in parts]
        columns = [batch["doc_id"], batch["text_key"], pa.array(counts, pa.int64()), *arrays]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_words", "begin", "stretch", "first", "n"])


def _single_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and place of each passage asked for; ``weight`` is how often it is known to occur through its stretch."""
    for batch in batches:
        keys, hashes, places, weights = [], [], [], []
        for key, value, wanted in zip(batch["text_key"], batch["text"], batch["wanted"], strict=True):
            _, passages, _ = _passages(value.as_py())
            for w in wanted.as_py():
                at = np.arange(w["first"], w["first"] + w["n"])
                keys += [key.as_py()] * len(at)
                hashes.append(passages[at].view(np.int64))
                places.append(at)
                weights += [w["weight"]] * len(at)
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hashes, places)]
        columns = [pa.array(keys, pa.string()), *(pa.array(x, pa.int64()) for x in flat), pa.array(weights, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["text_key", "passage", "place", "weight"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each text put together where they touch."""
    for batch in batches:
        found = []
        for spans in batch["spans"]:
            out: list[list[int]] = []
            for s in sorted((x["first"], x["last"]) for x in spans.as_py()):
                if out and s[0] <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], s[1])
                else:
                    out.append(list(s))
            found.append([{"first": a, "last": b} for a, b in out])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch["text_key"], pa.array(found, kind)], ["text_key", "spans"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_repeated, spans, repeated) of every row: number of words, of repeated words, and the runs of
    repeated words as array of (first, last), counted from 0, last exclusive. Null, empty and short texts have none. Repeated
    rows are copies of each other, so texts of ``PASSAGE`` words or more are wholly repeated in them."""
    given = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    given = given.withColumn("text_key", F.md5(F.coalesce("text", F.lit(""))))
    lists = ", ".join(f"{n} array<long>" for n in ("begin", "stretch", "first", "n"))
    kind = given.schema["doc_id"].dataType.simpleString()
    rows = written(given.mapInArrow(_suffixes, f"doc_id {kind}, text_key string, n_words long, {lists}"), "suffixes")
    kept = rows.select("text_key", F.explode(F.arrays_zip("begin", "stretch", "first", "n")).alias("s")).select("text_key", "s.*")

    counts = kept.groupBy("begin", "stretch").agg(F.count("*").alias("times"), F.min(F.struct("text_key", "first", "n")).alias("one"))
    counts = written(counts, "stretches")
    shared = counts.groupBy("begin").agg(F.count("*").alias("kinds")).where("kinds > 1").select("begin")
    again = counts.where("times > 1").select("begin", "stretch")
    whole = kept.join(again, ["begin", "stretch"], "left_semi")
    whole = whole.selectExpr("text_key", "first", f"first + n - 1 + {PASSAGE} as last")

    # One of each stretch whose beginning has neighbours with other stretches: its passages are compared one by one.
    unsure = counts.join(shared, "begin", "left_semi").selectExpr("one.*", "least(times, 2) as weight")
    wanted = unsure.groupBy("text_key").agg(F.collect_list(F.struct("first", "n", "weight")).alias("wanted"))
    texts = given.select("text_key", "text").join(wanted, "text_key").dropDuplicates(["text_key"])
    singles = texts.mapInArrow(_single_passages, "text_key string, passage long, place long, weight long")
    singles = written(singles, "passages")
    twice = singles.groupBy("passage").agg(F.sum("weight").alias("times")).where("times > 1").select("passage")
    parts = singles.where("weight = 1").join(twice, "passage", "left_semi")
    parts = parts.selectExpr("text_key", "place as first", f"place + {PASSAGE} as last")

    spans = whole.union(parts).distinct().groupBy("text_key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    spans = spans.mapInArrow(_merge, "text_key string, spans array<struct<first:long,last:long>>")
    found = rows.select("doc_id", "text_key", "n_words").join(spans, "text_key", "left")
    found = found.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<first:long,last:long>>")))
    n = F.expr("aggregate(spans, 0L, (a, s) -> a + s.last - s.first)")
    return found.select("doc_id", "n_words", n.alias("n_repeated"), "spans", (n > 0).alias("repeated"))
