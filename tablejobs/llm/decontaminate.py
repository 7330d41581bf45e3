"""Passages of benchmark items in training text: a broadcast hash set of test n-grams, scanned, verified, cut out.

Words are runs of ASCII letters and digits and of any characters beyond ASCII, in lower case. The windows of an item are its
runs of ``WINDOW`` words, or all its words if it has fewer. Their hashes are broadcast, ``SLICE`` windows at most at a time
(about 120 bytes each); a larger benchmark is scanned for in several passes over a written table, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from tablejobs.llm import text as T
from tablejobs.llm.arrays import replaced
from tablejobs.llm.shared import written

WINDOW = 10
SLICE = 400_000
HITS = S.ArrayType(
    S.StructType([S.StructField(n, S.IntegerType()) for n in ("first", "last", "start", "end")])
)
_HITS = pa.list_(pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")]))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[tuple[str | None, int, bytes]] = []
        for item, value in zip(batch["item_id"], batch["text"], strict=True):
            data = T.lowered(value.as_py())
            words = [data[a:b] for a, b in zip(*T.word_places(data, T.ALPHANUMERIC), strict=True)]
            n = min(WINDOW, len(words))
            if n:
                found += [(item.as_py(), n, b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]
        columns = list(zip(*found, strict=True)) or [[]] * 3
        kinds = [pa.string(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item_id", "n", "words"])


def windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, n, words), distinct; items without words have none. Items without id are one item, whose id is null."""
    given = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return given.mapInArrow(_windows, "item_id string, n int, words binary").distinct()


class _Index:
    """Windows of one slice: by number of words, their sorted hashes, and by hash the words and items."""

    def __init__(self, rows: list[tuple[str | None, int, bytes]]):
        self.items: dict[int, list[tuple[bytes, str | None]]] = {}
        hashes: dict[int, set[int]] = {}
        for item, n, words in rows:
            own = T.word_hashes(words, *T.word_places(words, T.ALPHANUMERIC))
            h = int(T.ngram_hashes(own, n)[0])
            hashes.setdefault(n, set()).add(h)
            self.items.setdefault(h, []).append((words, item))
        self.hashes = {n: np.array(sorted(found), T.U64) for n, found in hashes.items()}

    def scan(self, value: str | None) -> tuple[int, list[tuple[int, int, int, int]], set[str | None]]:
        """Number of words, disjoint runs of hit words (first and last word, start and end in code points), items found."""
        data = T.lowered(value)
        starts, ends = T.word_places(data, T.ALPHANUMERIC)
        words = T.word_hashes(data, starts, ends)
        change = np.zeros(len(words) + 1, np.int64)
        items: set[str | None] = set()
        for n, known in self.hashes.items():
            if len(words) < n:
                continue
            grams = T.ngram_hashes(words, n)
            at = np.searchsorted(known, grams)
            at[at == len(known)] = 0
            for i in np.flatnonzero(known[at] == grams):
                text = b" ".join(data[a:b] for a, b in zip(starts[i : i + n], ends[i : i + n], strict=True))
                same = [item for own, item in self.items[int(grams[i])] if own == text]
                if same:
                    items.update(same)
                    change[i] += 1
                    change[i + n] -= 1
        if not items:
            return len(words), [], items
        edges = np.flatnonzero(np.diff(np.r_[0, (np.cumsum(change[:-1]) > 0).astype(np.int8), 0]))
        first, last = edges[::2], edges[1::2] - 1
        points = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # code points up to and with each byte
        start, end = points[starts[first]] - 1, points[ends[last] - 1]
        return len(words), [tuple(map(int, x)) for x in zip(first, last, start, end, strict=True)], items


def _merged(one: list[dict], two: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    found: list[list[int]] = []
    for run in sorted([tuple(x.values()) for x in one] + two):
        if found and run[0] <= found[-1][1] + 1:
            if run[1] > found[-1][1]:
                found[-1][1::2] = run[1], run[3]
        else:
            found.append(list(run))
    return [tuple(x) for x in found]


def _scanner(index, text_col: str, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = index.value
        for batch in found:
            counts, runs, items = [], [], []
            again = names[0] in batch.schema.names
            for i, value in enumerate(batch[text_col]):
                n, hit, own = tool.scan(value.as_py())
                if again:
                    hit = _merged(batch[names[1]][i].as_py(), hit)
                    own |= set(batch[names[2]][i].as_py())
                counts.append(n)
                runs.append([dict(zip(("first", "last", "start", "end"), x, strict=True)) for x in hit])
                items.append(sorted(own - {None}) + [None] * (None in own))
            kept = [c for c in batch.schema.names if c not in names]
            new = [pa.array(counts, pa.int64()), pa.array(runs, _HITS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *new], [*kept, *names])

    return batches


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of the table has."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", slice_rows: int = SLICE) -> tuple[DataFrame, list[str]]:
    """All rows and columns of ``docs`` with three more, whose names are returned too: number of words, hit runs (first and
    last word, start and end in code points, end exclusive), sorted items found, a null last for those without id. Null and empty texts have no words; an empty
    benchmark hits nothing; repeated rows are judged one by one."""
    session = docs.sparkSession
    names = free_names(docs, "n_words", "hits", "items")
    known = written(windows(benchmark), "windows")
    slices = max(1, -(-known.count() // slice_rows))
    schema = S.StructType(
        docs.schema.fields
        + [S.StructField(names[0], S.LongType()), S.StructField(names[1], HITS), S.StructField(names[2], S.ArrayType(S.StringType()))]
    )
    for k in range(slices):
        rows = known.where(F.expr(f"pmod(xxhash64(item_id, words), {slices}) = {k}")).collect()  # at most a slice
        index = session.sparkContext.broadcast(_Index([(r.item_id, r.n, bytes(r.words)) for r in rows]))
        docs = docs.mapInArrow(_scanner(index, text_col, names), schema)
        if k + 1 < slices:
            docs = written(docs, "scanned")  # one slice in memory at a time
    return docs, names


def n_hit(hits: str) -> str:
    return f"aggregate({hits}, 0L, (n, h) -> n + h.last - h.first + 1)"


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row. Items without id count as
    one in ``n_items`` and are not in the digest."""
    given = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    found, (words, hits, items) = mark(given, benchmark)
    found = found.select("doc_id", F.col(words).alias("n_words"), F.expr(n_hit(hits)).alias("n_hit"), F.col(items).alias("items"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", drop_share: float = 0.5) -> DataFrame:
    """``docs`` without what the benchmark holds: rows with more than ``drop_share`` of their words hit are dropped, in the
    others the hit runs are cut out of the text. Other columns and clean rows stay as they are."""
    columns = docs.columns
    found, (words, hits, _) = mark(docs, benchmark, text_col)
    found = found.where(f"`{hits}` is null or {n_hit(f'`{hits}`')} <= {drop_share} * `{words}`")
    text = f"`{text_col}`"
    cut = replaced(text, f"`{hits}`", "''")
    return found.withColumn(text_col, F.expr(f"if(size(`{hits}`) > 0, {cut}, {text})")).select(*[f"`{c}`" for c in columns])
