"""Removed windows against brute force, in packed buckets and cut into windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from tablejobs.llm import queries, window_dup

SIZE = window_dup.WINDOW


def brute(docs):
    words = [(d, (t or "").encode().split()) for d, t in docs]
    least = {}
    for d, w in words:
        for i in range(len(w) - SIZE + 1 if d is not None else 0):
            g = tuple(w[i : i + SIZE])
            least[g] = min(least.get(g, d), d)
    found = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - SIZE + 1 if d is not None else 0):
            if least[tuple(w[i : i + SIZE])] < d:
                gone |= set(range(i, i + SIZE))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        found.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def odd_docs():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "Ä,", "漢字", "W1", "\u0085x", "a b"]

    def some(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    line = some(30)
    docs = [(None, None), (1, ""), (2, " \t\r\n\x0b\x0c "), (3, "w1 " * 12), (4, "w1\t" * 13), (5, "w1\n" * 40), (5, "w1 " * 40), (0, "same " * 14)]
    docs += [(100 + i, " ".join(some(rng.randint(0, 20)) + line[rng.randint(0, 9) : rng.randint(20, 30)] + some(rng.randint(0, 30)))) for i in range(120)]
    docs += [(300 + i, "  ".join(line)) for i in range(8)] + [(299, "\n".join(line)), (299, "\n".join(line)), (None, " ".join(line))]
    docs += [(400, " ".join(some(400))), (9, " ".join(line * 20 + some(300)))]
    rng.shuffle(docs)
    return docs


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(6).selectExpr("*", "1 as key", "'x' as first", "2 as kept")


@pytest.mark.parametrize("chunk,room", [(4_000_000, 8_000_000), (300, 2_000), (900, 40), (4_000, 1)])
def test_same_as_brute_force(spark, monkeypatch, chunk, room):
    """With small chunks texts are cut into pieces; with little room in a bucket all or some are hot."""
    docs = odd_docs()
    monkeypatch.setattr(window_dup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(window_dup, "RANGE_BYTES", room)
    cloudpickle.register_pickle_by_value(window_dup)  # tasks see these numbers too
    try:
        assert result(window_dup.digests(frame(spark, docs))) == brute(docs)
    finally:
        cloudpickle.unregister_pickle_by_value(window_dup)


def test_all_hashes_equal(monkeypatch):
    """Windows that share a hash are told apart by their words."""
    docs = [d for d in odd_docs() if d[0] is not None and (d[1] or "").split()]
    rows = [(d, i, 0, len(window_dup._normal(t.encode())), window_dup._normal(t.encode())) for i, (d, t) in enumerate(docs)]

    def bucket():
        chunk = window_dup._Chunk(rows, 1)
        batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in docs], "key": list(range(len(docs))), "text": [t for _, t in docs]})
        packed = next(window_dup._pack(1, np.zeros(0, np.int64))(iter([batch])))
        assert len(packed) == 1 and len(chunk.first)
        found = window_dup._repeated(pa.Table.from_batches([packed])).to_pylist()
        return sorted((r["doc_id"], r["key"], j) for r in found for a, b in zip(r["first"], r["last"]) for j in range(a, b))

    expected = bucket()
    grams = window_dup.T.ngram_hashes
    monkeypatch.setattr(window_dup.T, "ngram_hashes", lambda w, n: grams(w, n) % np.uint64(3))
    assert expected and bucket() == expected


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert result(queries.op13_substring_dedup(spark, "/root/testdata/sf0.01")) == brute(docs)


def test_no_rows(spark):
    assert window_dup.digests(frame(spark, odd_docs()).limit(0)).count() == 0
