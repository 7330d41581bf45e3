"""Language-model scores with stupid backoff, computed by joins.

The corpus is its own training text, each document left out of the counts it is scored with. Equal texts travel once for each
task that reads them, with their number, and are dealt to blocks by their hash. Each block sends its distinct n-grams of all
orders with their counts, packed by range of the hash. The count table of a range is their sum; joined to them it answers each
block with the counts that all other blocks have of these n-grams, in the order they were sent, so that hashes travel one way
only. The logarithms are then summed by text, block by block, and joined to the documents. A frequent n-gram is one entry for
each block, not for each document, and the number of ranges grows with the corpus, so that a range stays small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm import text as T

ORDER = 3
BACKOFF = 0.4
BLOCK_BYTES = 4_000_000  # of text in a block, on average; what a task holds at a time
PART_GRAMS = 1_000_000  # n-grams of the corpus, repeats included, for each range of hashes
FLUSH_GRAMS = 200_000  # passed on together
SPARE_BITS = 30  # an n-gram shares its hash with another of the corpus with a chance below 2 ** -SPARE_BITS


def _words(value: str | None) -> np.ndarray:
    data = T.lowered(value)
    return T.word_hashes(data, *T.word_places(data, T.NOT_SPACE))


def _grams(words: np.ndarray, order: int, bits: int) -> list[np.ndarray]:
    """Hashes of the n-grams of each order up to ``order``, empty where the text is shorter."""
    drop = T.U64(64 - bits)
    return [T.ngram_hashes(words, k) >> drop if len(words) >= k else np.zeros(0, T.U64) for k in range(1, order + 1)]


def _own_counts(hashes: np.ndarray) -> np.ndarray:
    """For each place, how often its hash occurs in the array."""
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return counts[inverse]


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte: the high bytes of small numbers are equal and take no room."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(value: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel()


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [T.lowered(value.as_py()) for value in batch["text"]]
        words = sum(len(T.word_places(data, T.NOT_SPACE)[0]) for data in texts)
        yield pa.RecordBatch.from_arrays([pa.array([words], pa.int64()), pa.array([sum(map(len, texts))], pa.int64())], ["words", "bytes"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [hashlib.md5(T.lowered(value.as_py())).digest() for value in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(keys, pa.binary())], ["doc_id", "key"])


def _distinct(blocks: int):
    """(block, key, text, copies): each text of the task once, further copies as a number without text."""

    def rows(keys: list[bytes], texts: list[str | None], copies: list[int]) -> pa.RecordBatch:
        dealt = [int.from_bytes(key[:8], "little") % blocks for key in keys]
        columns = [pa.array(dealt, pa.int64()), pa.array(keys, pa.binary()), pa.array(texts, pa.string()), pa.array(copies, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["block", "key", "text", "copies"])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more: dict[bytes, int] = {}
        for batch in found:
            keys, texts = [], []
            for value in batch["text"]:
                data = T.lowered(value.as_py())
                key = hashlib.md5(data).digest()
                if key in more:
                    more[key] += 1
                else:
                    more[key] = 0
                    keys.append(key)
                    texts.append(data.decode("utf-8", "surrogatepass"))
            yield rows(keys, texts, [1] * len(keys))
        more = {key: n for key, n in more.items() if n}
        yield rows(list(more), [None] * len(more), list(more.values()))

    return batches


def _block_grams(texts: list[str], copies: list[int], order: int, bits: int):
    """Hashes of each text by order, the distinct ones, the place of each among them, and how often the block has them."""
    grams = [_grams(_words(value), order, bits) for value in texts]
    lengths = [sum(map(len, doc)) for doc in grams]
    every, place = np.unique(np.concatenate([g for doc in grams for g in doc]), return_inverse=True)
    counts = np.bincount(place, weights=np.repeat(copies, lengths), minlength=len(every)).astype(np.int64)
    return grams, every, place, counts


def _block_counts(order: int, bits: int, parts: int):
    """(part, block, grams, counts) of each block: its distinct n-grams in the order of their hashes, cut into ``parts`` ranges."""
    width = T.U64(min((1 << bits) // parts + 1, (1 << 64) - 1))

    def counted(block: int, texts: list[str], copies: list[int]) -> Iterator[pa.RecordBatch]:
        _, grams, _, counts = _block_grams(texts, copies, order, bits)
        part = (grams // width).astype(np.int64)
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(grams) else np.zeros(1, np.int64)
        spans = list(zip(edges[:-1], edges[1:], strict=True))
        lot = max(1, FLUSH_GRAMS * len(spans) // max(1, len(grams)))
        for at in range(0, len(spans), lot):
            some = spans[at : at + lot]
            columns = [
                pa.array([part[i] for i, _ in some], pa.int64()),
                pa.array([block] * len(some), pa.int64()),
                pa.array([_packed(np.r_[grams[i], np.diff(grams[i:j])]) for i, j in some], pa.binary()),
                pa.array([_packed(counts[i:j]) for i, j in some], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "block", "grams", "counts"])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, texts, copies = None, [], []
        for batch in found:
            for block, text, n in zip(*(batch[c].to_pylist() for c in ("block", "text", "copies")), strict=True):
                if block != now and texts:
                    yield from counted(now, texts, copies)
                    texts, copies = [], []
                now = block
                texts.append(text)
                copies.append(n)
        if texts:
            yield from counted(now, texts, copies)

    return batches


def _others(found: pa.Table) -> pa.Table:
    """The count table of one range of hashes, joined to the blocks' n-grams: how often all other blocks have each of them."""
    grams = [np.cumsum(_unpacked(value), dtype=np.uint64) for value in found["grams"].to_pylist()]
    own = np.concatenate([_unpacked(value) for value in found["counts"].to_pylist()]).astype(np.int64)
    _, place = np.unique(np.concatenate(grams), return_inverse=True)
    others = np.bincount(place, weights=own).astype(np.int64)[place] - own
    pieces = np.split(others, np.cumsum([len(g) for g in grams])[:-1])
    return pa.Table.from_arrays([found["part"], found["block"], pa.array(map(_packed, pieces), pa.binary())], ["part", "block", "others"])


def _log_score(words: int, totals: list[np.ndarray], own: list[np.ndarray], corpus: int) -> float:
    """Sum over the words of one document; ``totals`` and ``own`` are the counts of its n-grams, by order."""
    score, open_places = 0.0, np.arange(words)
    for k in range(len(totals), 0, -1):
        # The k-gram that ends at place j is number j - k + 1; places before k - 1 begin at a lower order.
        at = open_places[open_places >= k - 1]
        others = totals[k - 1][at - k + 1] - own[k - 1][at - k + 1]
        backed = np.minimum(at + 1, len(totals)) - k
        if k > 1:
            seen = others > 0
            before = at[seen] - k + 1
            chance = others[seen] / (totals[k - 2][before] - own[k - 2][before])
            open_places = np.concatenate([open_places[open_places < k - 1], at[~seen]])
            backed = backed[seen]
        else:
            chance = np.maximum(others, 0.5) / max(corpus, 1)
        score += float(np.log(chance).sum() + backed.sum() * np.log(BACKOFF))
    return score


def _block_scores(order: int, bits: int, corpus: int):
    def scored(texts: pa.Table, answers: pa.Table) -> pa.Table:
        grams, _, place, totals = _block_grams(texts["text"].to_pylist(), texts["copies"].to_pylist(), order, bits)
        if len(totals):  # the answers of all ranges, one after the other, are in the order of the block's n-grams
            answers = answers.sort_by("part")
            totals = totals + np.concatenate([_unpacked(value) for value in answers["others"].to_pylist()]).astype(np.int64)
        pieces = iter(np.split(totals[place], np.cumsum([len(g) for doc in grams for g in doc])[:-1]))
        counts, sums = [], []
        for doc in grams:
            counts.append(len(doc[0]))
            sums.append(_log_score(len(doc[0]), [next(pieces) for _ in doc], [_own_counts(g) for g in doc], corpus))
        columns = [texts["key"], pa.array(counts, pa.int64()), pa.array(sums, pa.float64())]
        return pa.Table.from_arrays(columns, ["key", "n_words", "log_score"])

    return scored


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every row. A word that no other document has counts as if seen half a
    time. Null, empty and blank texts have no words, the sum 0 and a null mean. Repeated rows are documents of their own: each
    is in the counts of the other. One document alone is scored by the factor and the half count throughout."""
    given = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    size = given.select("text").mapInArrow(_sizes, "words long, bytes long").agg(F.sum("words"), F.sum("bytes")).first()
    corpus, blocks = size[0] or 0, (size[1] or 0) // block_bytes + 1
    bits = min(64, (corpus * order).bit_length() + SPARE_BITS)
    parts = corpus * order // PART_GRAMS + 1
    # The texts are shuffled once: both uses below read the same exchange.
    dealt = given.select("text").mapInArrow(_distinct(blocks), "block long, key binary, text string, copies long")
    dealt = dealt.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block")
    texts = dealt.groupBy("block", "key").agg(F.first("text", True).alias("text"), F.sum("copies").alias("copies"))
    grams = texts.sortWithinPartitions("block").mapInArrow(
        _block_counts(order, bits, parts), "part long, block long, grams binary, counts binary"
    )
    answers = grams.groupBy("part").applyInArrow(_others, "part long, block long, others binary")
    sums = texts.groupBy("block").cogroup(answers.groupBy("block"))
    sums = sums.applyInArrow(_block_scores(order, bits, corpus), "key binary, n_words long, log_score double")
    kind = given.schema["doc_id"].dataType.simpleString()
    rows = given.mapInArrow(_keyed, f"doc_id {kind}, key binary").join(sums, "key")
    return rows.select("doc_id", "n_words", "log_score", F.expr("log_score / nullif(n_words, 0)").alias("mean_log_score"))
