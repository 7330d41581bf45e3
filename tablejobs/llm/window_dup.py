"""Words that an earlier document has already said: windows of ``WINDOW`` words that also start in a document of smaller id.

Super-k-mer partitioning: the smallest hash of the runs of ``GRAM`` words in a window is its minimiser, and consecutive windows
that share one are a super-k-mer. It travels as one packed string, its words joined by blanks, to the bucket of its minimiser,
where equal windows meet whatever surrounds them. A bucket sorts its windows by hash, compares the words of neighbours, and so
knows exactly in which documents a window starts; it sends back the places whose window also starts in a smaller document.

A task packs the strings of about ``CHUNK_BYTES`` of text together, bucket by bucket. A first pass adds up what each bucket
will hold. A bucket beyond ``HOT`` times its share (one minimiser in very many documents) is not gathered: its super-k-mers are
cut into windows, one row each, whose smallest ids are found by a partial aggregate and joined back. Both ways give the same
rows. Of equal texts in a chunk one travels; copies of a whole text are found by its md5.

Words are runs without ASCII white space, as they are. A null text has none. Rows without id neither remove words nor lose any.
Rows with the same id are not copies of each other. Texts longer than a chunk are cut into pieces that overlap by a window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm import text as T
from tablejobs.llm.shared import written

WINDOW = 13
GRAM = 5
CHUNK_BYTES = 4_000_000  # of text packed together; what a task holds at a time
RANGE_BYTES = 8_000_000  # of packed strings meant for a bucket
RANGES_PER_TASK = 8
SUM_BYTES = 1_000_000  # hashed at a time
SPREAD = 4  # packed strings take up to about this many times the bytes of the texts
HOT = 2  # a bucket with more than HOT * RANGE_BYTES is cut into windows
BROADCAST_BYTES = 32_000_000  # of spans that go to all executors; more are joined by shuffle
ALL = 2**31 - 1  # end of a span that takes the whole text

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers = {base: np.ones(1, T.U64) for base in (_BASE, _INVERSE)}
_BLANK = bytes(0x20 if 0x09 <= i <= 0x0D else i for i in range(256))


def _normal(value: bytes | None) -> bytes:
    """The words of a text, joined by single blanks."""
    text = (value or b"").translate(_BLANK).strip(b" ")
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        grown = np.full(n + n // 4, base, T.U64)
        grown[0] = 1
        _powers[base] = np.multiply.accumulate(grown)
    return _powers[base][:n]


def _places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of texts separated by line feeds, and the number of the text it is in."""
    ends = np.flatnonzero((data == 0x20) | (data == 0x0A))
    owner = np.zeros(len(ends) + 1, np.int64)
    np.cumsum(data[ends] == 0x0A, out=owner[1:])
    return np.r_[0, ends + 1], np.r_[ends, len(data)], owner


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from a running sum over some bytes at a time."""
    own = np.zeros(len(starts), T.U64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + SUM_BYTES)))
        part, begin, end = data[base : ends[last - 1]], starts[first:last] - base, ends[first:last] - base
        sums = np.zeros(len(part) + 1, T.U64)
        np.cumsum(T._BYTE[part] * _power(_BASE, len(part)), out=sums[1:])
        own[first:last] = (sums[end] - sums[begin]) * _power(_INVERSE, len(part) + 1)[begin]
        first = last
    return T.mix(own + (ends - starts).astype(T.U64) * T._PLACE[0])


def _smallest(h: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` values the place of its first smallest one."""
    best, width = np.arange(len(h)), 1
    while width < span:
        step = min(width, span - width)
        left, right = best[:-step], best[step:]
        best = np.where(h[left] <= h[right], left, right)
        width += step
    return best


class _Chunk:
    """Texts packed together, and their super-k-mers."""

    def __init__(self, rows: list[tuple[int, int, int, int, bytes]], ranges: int):
        docs, keys, firsts, cores, texts = zip(*rows, strict=True)
        self.bytes = b"\n".join(texts)
        data = np.frombuffer(self.bytes, np.uint8)
        starts, ends, owner = _places(data)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        first_word = np.searchsorted(starts, begins)
        n = len(starts) - WINDOW + 1
        if n <= 0:
            n, place, own = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            grams = T.ngram_hashes(_hashes(data, starts, ends), GRAM)
            place = _smallest(grams, WINDOW - GRAM + 1)
            core = starts[:n] - begins[owner[:n]] < np.asarray(cores)[owner[:n]]
            own = np.flatnonzero((owner[:n] == owner[WINDOW - 1 :]) & core)
        new = np.ones(len(own), bool)
        new[1:] = (place[own[1:]] != place[own[:-1]]) | (np.diff(own) != 1)
        self.first = own[new]
        self.n = np.diff(np.r_[np.flatnonzero(new), len(own)])
        self.starts, self.ends = starts, ends
        row = owner[self.first]
        self.docs, self.keys = np.asarray(docs, np.int64)[row], np.asarray(keys, np.int64)[row]
        self.at = np.asarray(firsts, np.int64)[row] + self.first - first_word[row]
        self.range = (T.mix(grams[place[self.first]]) % T.U64(ranges)).astype(np.int64) if n else np.zeros(0, np.int64)
        self.begin, self.end = starts[self.first], ends[self.first + self.n + WINDOW - 2]


def _pieces(text: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(words before, bytes whose windows are its own, piece) of a normal text."""
    at = words = 0
    while at < len(text):
        cut = text.find(b" ", at + CHUNK_BYTES)
        cut = end = len(text) if cut < 0 else cut + 1
        for _ in range(WINDOW - 1 if cut < len(text) else 0):
            blank = text.find(b" ", end)
            end = len(text) if blank < 0 else blank + 1
        yield words, cut - at, text[at:end].rstrip(b" ")
        words += text.count(b" ", at, cut)
        at = cut


def _chunks(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[_Chunk]:
    held: list[tuple[int, int, int, int, bytes]] = []
    size, seen = 0, {}
    for batch in batches:
        texts = batch["text"].cast(pa.binary())
        for doc, key, value in zip(batch["doc_id"].to_pylist(), batch["key"].to_pylist(), texts, strict=True):
            raw = value.as_py()
            text = _normal(raw)
            if not text:
                continue
            if len(text) <= CHUNK_BYTES:
                if raw in seen:  # the copy with the smaller id stands for both
                    i = seen[raw]
                    if doc < held[i][0]:
                        held[i] = (doc, key, *held[i][2:])
                    continue
                seen[raw] = len(held)
            for words, core, piece in _pieces(text):
                held.append((doc, key, words, core, piece))
                size += len(piece)
                if size >= CHUNK_BYTES:
                    yield _Chunk(held, ranges)
                    held, size, seen = [], 0, {}
    if held:
        yield _Chunk(held, ranges)


def _packed(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(np.diff(values, prepend=0).astype(np.int64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(value: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64).ravel())


Batches = Iterator[pa.RecordBatch]


def _sizes(ranges: int) -> Callable[[Batches], Batches]:
    """(range, bytes) of the packed strings of the task."""

    def sizes(batches: Batches) -> Batches:
        total = np.zeros(ranges, np.int64)
        for chunk in _chunks(batches, ranges):
            total += np.bincount(chunk.range, weights=chunk.end - chunk.begin, minlength=ranges).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["range", "bytes"])

    return sizes


PACKED = "range long, strings binary, docs binary, keys binary, places binary"


def _pack(ranges: int, hot: np.ndarray) -> Callable[[Batches], Batches]:
    """The super-k-mers of each chunk, packed by bucket; none of the hot ones."""

    def pack(batches: Batches) -> Batches:
        for chunk in _chunks(batches, ranges):
            order = np.argsort(chunk.range, kind="stable")
            order = order[~np.isin(chunk.range[order], hot)]
            dealt = chunk.range[order]
            cuts = np.r_[np.flatnonzero(np.diff(dealt, prepend=-1)), len(dealt)]
            begin, end = chunk.begin[order].tolist(), chunk.end[order].tolist()
            docs, keys, at = chunk.docs[order], chunk.keys[order], chunk.at[order]
            tool = zstandard.ZstdCompressor(level=3)
            columns: list[list] = [[], [], [], [], []]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                text = b"\n".join([chunk.bytes[begin[i] : end[i]] for i in range(a, b)])
                row = (int(dealt[a]), tool.compress(text), _packed(docs[a:b]), _packed(keys[a:b]), _packed(at[a:b]))
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            arrays = [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])]
            yield pa.RecordBatch.from_arrays(arrays, ["range", "strings", "docs", "keys", "places"])

    return pack


def _cut(ranges: int, hot: np.ndarray) -> Callable[[Batches], Batches]:
    """(words, doc_id, key, place) of each window of the super-k-mers of hot buckets."""

    def cut(batches: Batches) -> Batches:
        for chunk in _chunks(batches, ranges):
            for part in np.array_split(own := np.flatnonzero(np.isin(chunk.range, hot)), len(own) // 20_000 + 1):
                of = np.repeat(part, chunk.n[part])
                step = np.arange(len(of)) - np.repeat(np.cumsum(chunk.n[part]) - chunk.n[part], chunk.n[part])
                first = chunk.first[of] + step
                begin, end = chunk.starts[first].tolist(), chunk.ends[first + WINDOW - 1].tolist()
                words = pa.array([chunk.bytes[a:b] for a, b in zip(begin, end, strict=True)], pa.binary())
                columns = [words, pa.array(chunk.docs[of]), pa.array(chunk.keys[of]), pa.array(chunk.at[of] + step)]
                yield pa.RecordBatch.from_arrays(columns, ["words", "doc_id", "key", "place"])

    return cut


SPANS = "doc_id long, key long, first array<long>, last array<long>"


def _spans(docs: np.ndarray, keys: np.ndarray, places: np.ndarray) -> pa.Table:
    """Places of windows put together to runs of words, a row for each document."""
    order = np.lexsort((places, keys, docs))
    docs, keys, places = docs[order], keys[order], places[order]
    same = (np.diff(docs, prepend=0) == 0) & (np.diff(keys, prepend=0) == 0)
    same[:1] = False
    fresh = ~(same & (np.diff(places, prepend=0) == 0))
    docs, keys, places, same = docs[fresh], keys[fresh], places[fresh], same[fresh]
    starts = ~(same & (np.diff(places, prepend=0) == 1))
    at = np.flatnonzero(starts)
    first, last = places[at], places[np.r_[at[1:], len(places)] - 1] + WINDOW if len(at) else places
    row = np.flatnonzero(~same[at])
    offsets = pa.array(np.r_[row, len(at)], pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (first, last)]
    return pa.Table.from_arrays([pa.array(docs[at][row]), pa.array(keys[at][row]), *lists], ["doc_id", "key", "first", "last"])


def _alike(text: bytes, begin: np.ndarray, end: np.ndarray, left: np.ndarray, right: np.ndarray) -> bool:
    places = zip(*(x.tolist() for x in (begin[left], end[left], begin[right], end[right])), strict=True)
    return all(text[a:b] == text[c:d] for a, b, c, d in places)


def _repeated(table: pa.Table) -> pa.Table:
    """A bucket: its windows sorted, equal neighbours compared, and the places whose window starts in a smaller document."""
    tool = zstandard.ZstdDecompressor()
    text = b"\n".join(tool.decompress(x.as_py()) for x in table["strings"])
    docs, keys, places = (np.concatenate([_unpacked(x.as_py()) for x in table[c]]) for c in ("docs", "keys", "places"))
    data = np.frombuffer(text, np.uint8)
    starts, ends, owner = _places(data)
    hashes = T.ngram_hashes(_hashes(data, starts, ends), WINDOW)
    own = np.flatnonzero(owner[: len(hashes)] == owner[WINDOW - 1 :])
    hashes, of = hashes[own], owner[own]
    begin, end, doc = starts[own], ends[own + WINDOW - 1], docs[of]
    place = places[of] + own - np.searchsorted(owner, np.arange(len(docs)))[of]

    order = np.argsort(hashes, kind="stable")
    same = np.diff(hashes[order]) == 0
    pairs = np.flatnonzero(same)
    if not all(_alike(text, begin, end, order[p], order[p + 1]) for p in np.array_split(pairs, len(pairs) // 50_000 + 1)):
        # Different windows share a hash: sort the words themselves.
        windows = [text[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        order = np.array(sorted(range(len(windows)), key=windows.__getitem__), np.int64)
        same = np.array([windows[a] == windows[b] for a, b in zip(order[:-1], order[1:], strict=True)], bool)
    group = np.cumsum(np.r_[True, ~same]) - 1
    least = np.minimum.reduceat(doc[order], np.flatnonzero(np.r_[True, ~same]))
    hit = order[doc[order] > least[group]]
    return _spans(doc[hit], keys[of[hit]], place[hit])


def _merge(batches: Batches) -> Batches:
    """Runs of each document, in order, put together where they touch."""
    for batch in batches:
        lists: list[list] = [[], []]
        for a, b in zip(batch["first"].to_pylist(), batch["last"].to_pylist(), strict=True):
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            order = np.argsort(a, kind="stable")
            a, reach = a[order], np.maximum.accumulate(b[order])
            new = np.r_[True, a[1:] > reach[:-1]]
            lists[0].append(a[new])
            lists[1].append(reach[np.r_[np.flatnonzero(new)[1:], len(a)] - 1])
        columns = [batch["doc_id"], batch["key"], *(pa.array(x, pa.list_(pa.int64())) for x in lists)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "first", "last"])


def _removed(batches: Batches) -> Batches:
    """Each text without the words of its spans."""
    for batch in batches:
        counts, gone, kept = [], [], []
        for value, a, b in zip(batch["text"].cast(pa.binary()), batch["first"], batch["last"], strict=True):
            text = _normal(value.as_py())
            n = text.count(b" ") + 1 if text else 0
            counts.append(n)
            spans = [(x, min(y, n)) for x, y in zip(a.as_py() or [], b.as_py() or [], strict=True) if n >= WINDOW]
            gone.append(sum(y - x for x, y in spans))
            if spans:
                blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
                starts, ends = np.r_[0, blanks + 1], np.r_[blanks, len(text)]
                edges = [0, *(x for s in spans for x in s), n]
                text = b" ".join(text[starts[x] : ends[y - 1]] for x, y in zip(edges[::2], edges[1::2], strict=True) if x < y)
            kept.append(text.decode("utf-8", "surrogatepass"))
        columns = [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])


def _keyed(given: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``given`` with a key that tells apart the texts of one id, and (doc_id, key, copy, bytes) of its rows with an id. The
    key takes room in each super-k-mer; it is 0 where no id has two texts."""
    copy = F.md5(F.coalesce("text", F.lit("")))
    ids = given.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("key"), copy.alias("copy"), F.octet_length("text").alias("bytes"))
    ids = written(ids, "window_ids")
    if ids.groupBy("doc_id").agg(F.min("copy").alias("a"), F.max("copy").alias("b")).where("a <> b").isEmpty():
        return given.withColumn("key", F.lit(0).cast("long")), ids.withColumn("key", F.lit(0).cast("long"))
    return given.withColumn("key", F.xxhash64("text")), ids


def spans(given: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, key, first, last): runs of words to be removed from ``given`` (doc_id, key, text), a row for each text that has
    any. A run that ends at ``ALL`` takes the whole text if it has a window."""
    rows = given.where("doc_id is not null")
    firsts = ids.groupBy("copy").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    whole = ids.join(firsts.where("least < most"), "copy").where("doc_id > least")
    whole = whole.selectExpr("doc_id", "key", "array(0L) as first", f"array({ALL}L) as last").dropDuplicates(["doc_id", "key"])

    total = ids.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(1, -(-SPREAD * total // RANGE_BYTES))
    sizes = rows.mapInArrow(_sizes(ranges), "range long, bytes long").groupBy("range").agg(F.sum("bytes").alias("bytes"))
    # At most a share of 1 / HOT of all buckets can be beyond HOT times what there is for each.
    hot = np.array([r["range"] for r in sizes.where(F.col("bytes") > HOT * RANGE_BYTES).collect()], np.int64)
    packed = rows.mapInArrow(_pack(ranges, hot), PACKED)
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), ranges // RANGES_PER_TASK)
    found = packed.repartition(parts, "range").groupBy("range").applyInArrow(_repeated, SPANS).unionByName(whole)
    if len(hot):
        windows = rows.mapInArrow(_cut(ranges, hot), "words binary, doc_id long, key long, place long")
        least = windows.groupBy("words").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
        least = written(least, "window_least")  # so that the join has two plain sides, whose hot windows can be split
        hit = windows.join(least, "words").where("doc_id > least")
        found = found.unionByName(hit.selectExpr("doc_id", "key", "array(place) as first", f"array(place + {WINDOW}) as last"))
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("first", "last")]
    return written(found.groupBy("doc_id", "key").agg(*lists).mapInArrow(_merge, SPANS), "window_spans")


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: its words, those removed, and the others joined by blanks."""
    given = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    given, ids = _keyed(given)
    found = spans(given, ids)
    size = found.agg(F.sum(F.size("first") * 16 + 64)).first()[0] or 0
    found = F.broadcast(found) if size <= BROADCAST_BYTES else found
    joined = given.join(found, ["doc_id", "key"], "left").select("doc_id", "text", "first", "last")
    return joined.mapInArrow(_removed, "doc_id long, n_words long, n_removed long, kept string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    found = remove_repeated(docs, id_col, text_col)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
