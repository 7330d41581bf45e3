"""Near-duplicate documents: an inverted join over the coordinates of MinHash signatures, confirmed on the full sets.

1. Every text becomes its set of shingles and a signature of ``COORDINATES`` minima. Texts with the same words form a class;
   all later steps work on one member of each.
2. Documents are posted under each coordinate-value pair. Two that agree in ``MATCHES`` coordinates must share one of their
   ``COORDINATES - MATCHES + 1`` rarest values (prefix); values that only one class has can't collide (skipped), and the most
   frequent ``MATCHES - 1`` are not merged at all.
3. Posting lists are merged through hubs: each list names its most connected document, and all who share a hub form a
   family. Any two that share a posting share its family, and a family is linear in its members, not quadratic.
4. Families are compared in blocks of ``BLOCK`` members, the hub being in each. Only links that join groups are returned. A
   pair is retained when it agrees in ``MATCHES`` coordinates, then confirmed on both full sets.
5. Where a family has several blocks, members outside the hub's component are compared with the other blocks, as far as the
   distances to the hub allow a link (the Jaccard distance is a metric).

A pair at the threshold misses ``MATCHES`` of ``COORDINATES`` with a probability below 1e-5, falling fast above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm import text as T
from tablejobs.llm.components import components
from tablejobs.llm.shared import join_ids, written

SHINGLE = 5
SIMILARITY = 75  # per cent
COORDINATES = 48
MATCHES = 22
BLOCK = 256
BROADCAST_TEXTS = 1_000_000  # classes whose (id, key, class) is sent to every task: 100 bytes each; beyond it the join shuffles

_random = np.random.RandomState(7)
_TIMES = _random.randint(1, 2**63 - 1, COORDINATES).astype(T.U64) * T.U64(2) + T.U64(1)
_PLUS = _random.randint(1, 2**63 - 1, COORDINATES).astype(T.U64)
_COORDINATE = np.arange(COORDINATES, dtype=T.U64) * T.U64(0x9E3779B97F4A7C15)


def shingles(data: bytes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; of all words if there are fewer."""
    starts, ends = T.word_places(data, T.NOT_SPACE)
    return np.unique(T.ngram_hashes(T.word_hashes(data, starts, ends), SHINGLE))


def signature(found: np.ndarray) -> np.ndarray:
    """The minimum under each of the hash functions, mixed with the number of its coordinate."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, T.U64)
    for at in range(0, len(found), 4096):
        low = np.minimum(low, (found[None, at : at + 4096] * _TIMES[:, None] + _PLUS[:, None]).min(axis=1))
    return T.mix(low ^ _COORDINATE)


def words_key(data: bytes) -> bytes | None:
    words = data.split()  # ASCII white space: the six bytes that separate words
    return hashlib.md5(b" ".join(words)).digest() if words else None


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.small_batches(batches, "text"):
        keys, sizes, signatures = [], [], []
        for value in batch["text"]:
            data = T.lowered(value.as_py())
            keys.append(words_key(data))
            found = shingles(data)
            sizes.append(len(found))
            signatures.append(signature(found).view(np.int64) if len(found) else None)
        columns = [batch["doc_id"], pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "words_key", "n_shingles", "signature"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.small_batches(batches, "text"):
        classes, found = [], []
        for value, key, own in zip(batch["text"], batch["words_key"], batch["class"], strict=True):
            data = T.lowered(value.as_py())
            if words_key(data) == key.as_py():  # a repeated id may belong to another text
                classes.append(own.as_py())
                found.append(shingles(data).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(found, pa.binary())], ["class", "shingles"])


class _Group:
    """Members of a block: their sets, and which pairs are linked."""

    def __init__(self, classes: list[int], sets: list[bytes]):
        own = dict(zip(classes, sets, strict=True))  # a class that came twice is one
        self.classes = list(own)
        self.sets = [np.frombuffer(s, np.uint64) for s in own.values()]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.place = {c: i for i, c in enumerate(self.classes)}

    def shared(self) -> np.ndarray:
        """Shingles that each two members share."""
        n = len(self.sets)
        total = np.zeros((n, n), np.int64)
        values, owner = np.concatenate(self.sets), np.repeat(np.arange(n), self.sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        new = np.r_[True, values[1:] != values[:-1]]
        column = np.cumsum(new) - 1
        keep = np.bincount(column)[column] > 1
        column, owner = column[keep], owner[keep]
        if len(column):
            column = np.cumsum(np.r_[False, column[1:] != column[:-1]])
            for at in range(0, int(column[-1]) + 1, 4096):
                first, last = np.searchsorted(column, (at, at + 4096))
                part = np.zeros((n, 4096), np.float32)
                part[owner[first:last], column[first:last] - at] = 1
                total += (part @ part.T).astype(np.int64)
        np.fill_diagonal(total, self.sizes)
        return total

    def links(self, shared: np.ndarray) -> np.ndarray:
        """Pairs that agree in enough coordinates and are confirmed on the full sets."""
        signatures = np.stack([signature(s) for s in self.sets])
        agree = np.zeros(shared.shape, np.int16)
        for c in range(COORDINATES):
            agree += signatures[:, None, c] == signatures[None, :, c]
        union = self.sizes[:, None] + self.sizes[None, :] - shared
        return (agree >= MATCHES) & (100 * shared >= SIMILARITY * union)


def _spanning(classes: list[int], linked: np.ndarray) -> list[tuple[int, int]]:
    """Fewest links that leave the same groups connected."""
    root = list(range(len(classes)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        a, b = top(int(i)), top(int(j))
        if a != b:
            root[b] = a
            found.append((classes[i], classes[j]))
    return found


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Rows that follow each other with the same keys, as columns; the rows must be sorted by them."""
    run: dict[str, list] = {}
    last = None
    for batch in batches:
        columns = {name: batch[name].to_pylist() for name in batch.schema.names}
        for i, key in enumerate(zip(*(columns[k] for k in keys), strict=True)):
            if key != last:
                if run:
                    yield run
                run, last = {name: [] for name in columns}, key
            for name, values in columns.items():
                run[name].append(values[i])
    if run:
        yield run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each block; for families of several blocks also each member's distance to the hub."""
    found: list[tuple] = []
    for run in _runs(batches, ["family", "block"]):
        hub, blocks = run["family"][0], run["blocks"][0]
        group = _Group(run["class"], run["shingles"])
        if len(group.classes) < 2:
            continue
        shared = group.shared()
        found += [(hub, a, b, None) for a, b in _spanning(group.classes, group.links(shared))]
        if blocks > 1:
            h = group.place[hub]
            far = 1 - shared[h] / (group.sizes + group.sizes[h] - shared[h])
            found += [(hub, c, None, float(d)) for c, d in zip(group.classes, far, strict=True)]
        if len(found) > 20_000:
            yield _links(found)
            found = []
    yield _links(found)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the two sides of each pair of blocks, where components differ and the distances to the hub allow it."""
    found: list[tuple] = []
    for run in _runs(batches, ["family", "one", "two", "kind"]):
        group = _Group(run["class"], run["shingles"])
        if len(group.classes) < 2:
            continue
        at = {c: i for i, c in enumerate(run["class"])}
        rows = [at[c] for c in group.classes]
        component = np.array(run["component"])[rows]
        far = np.array(run["far"])[rows]
        allowed = component[:, None] != component[None, :]
        allowed &= np.abs(far[:, None] - far[None, :]) <= 1 - SIMILARITY / 100 + 1e-9
        if allowed.any():
            linked = group.links(group.shared()) & allowed
            found += [(run["family"][0], a, b, None) for a, b in _spanning(group.classes, linked)]
    yield _links(found)


def _links(found: list[tuple]) -> pa.RecordBatch:
    kinds = {"family": pa.int64(), "a": pa.int64(), "b": pa.int64(), "far": pa.float64()}
    columns = list(zip(*found, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))


LINKS = "family long, a long, b long, far double"


def families(classes: DataFrame) -> DataFrame:
    """(family, class) of every class that may have a partner, its hub being the family."""
    posted = classes.select("class", F.explode("signature").alias("value"))
    counts = posted.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    common = posted.join(counts, "value").groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("common"), F.sum("df").alias("popularity")
    )
    # The values that nobody else has fill the prefix first; what is left of it are the rarest of the others.
    prefix = F.expr(f"slice(common, 1, size(common) - {MATCHES - 1})")
    listed = common.where(F.size("common") >= MATCHES).select("class", "popularity", F.explode(prefix).alias("p"))
    listed = listed.select("class", "popularity", F.col("p.value").alias("value"))
    hubs = listed.groupBy("value").agg(F.max(F.struct("popularity", "class"))["class"].alias("family"), F.count("*").alias("n"))
    return listed.join(hubs.where("n > 1"), "value").select("family", "class").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Null, empty and blank texts have no shingles, are linked with nothing and kept. Repeated rows are exact copies of each
    other: each gets a row here, with the same values. Null ids never become a component's id, unless it has no other; a row
    is kept when its id is the component's, null counting as equal to null. An empty table gives an empty result.
    """
    given = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    base = given.mapInArrow(_sketch, f"doc_id {kind}, words_key binary, n_shingles long, signature array<long>")
    base = written(base, "sketches")
    classes = base.where("words_key is not null").groupBy("words_key")
    classes = classes.agg(F.min("doc_id").alias("first_doc"), F.first("signature").alias("signature"))
    classes = written(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    members = written(families(classes), "families")

    wanted = classes.join(members.select("class").distinct(), "class", "left_semi").select("first_doc", "words_key", "class")
    wanted = written(wanted, "wanted")
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_TEXTS else wanted
    texts = given.join(side, given["doc_id"].eqNullSafe(side["first_doc"])).select("text", "words_key", "class")
    sets = written(texts.mapInArrow(_sets, "class long, shingles binary"), "sets")

    sized = members.join(members.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "family")
    dealt = sized.where("class <> family").withColumn("block", F.expr("pmod(xxhash64(class), blocks)"))
    hubs = sized.where("class = family").withColumn("block", F.expr("explode(sequence(0, blocks - 1))"))
    blocks = written(dealt.unionByName(hubs), "blocks")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = blocks.join(sets, "class").repartition(parts, "family", "block").sortWithinPartitions("family", "block")
    links = written(rows.mapInArrow(_compare, LINKS), "links")
    labels = components(links.where("b is not null"))

    far = links.where("b is null").groupBy("family", F.col("a").alias("class")).agg(F.min("far").alias("far"))
    placed = far.join(labels.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.withColumn("component", F.coalesce("component", "class"))
    centre = placed.where("class = family").select("family", F.col("component").alias("centre"))
    placed = placed.join(centre, "family").withColumn("open", F.expr("component <> centre"))
    sizes = placed.groupBy("family").agg(
        F.ceil(F.sum(F.col("open").cast("long")) / BLOCK).alias("n_open"), F.ceil(F.sum((~F.col("open")).cast("long")) / BLOCK).alias("n_done")
    )
    placed = placed.join(sizes.where("n_open > 0"), "family")
    placed = written(placed.withColumn("at", F.expr("pmod(xxhash64(class, 1), if(open, n_open, n_done))")), "open")
    if not placed.isEmpty():
        last = "family", "class", "component", "far"
        mine, done = placed.where("open"), placed.where("not open")
        jobs = [
            mine.selectExpr(*last, "at as one", "explode(sequence(0, n_done - 1)) as two", "0 as kind"),
            done.selectExpr(*last, "explode(sequence(0, n_open - 1)) as one", "at as two", "0 as kind"),
            mine.selectExpr(*last, "at as one", "explode(sequence(at, n_open - 1)) as two", "1 as kind"),
            mine.where("at > 0").selectExpr(*last, "explode(sequence(0, at - 1)) as one", "at as two", "1 as kind"),
        ]
        rows = jobs[0].union(jobs[1]).union(jobs[2]).union(jobs[3]).join(sets, "class")
        rows = rows.repartition(parts, "family", "one", "two", "kind").sortWithinPartitions("family", "one", "two", "kind")
        more = written(rows.mapInArrow(_across, LINKS), "links")
        labels = components(links.where("b is not null").unionByName(more))

    owners = classes.select("class", "words_key", "first_doc").join(labels.withColumnRenamed("node", "class"), "class", "left")
    smallest = owners.where("component is not null").groupBy("component").agg(F.min("first_doc").alias("smallest"))
    owners = owners.join(smallest, "component", "left").select("words_key", F.coalesce("smallest", "first_doc").alias("component_id"))
    result = base.select("doc_id", "words_key", "n_shingles").join(owners, "words_key", "left")
    component = F.expr("if(words_key is null, doc_id, component_id)")
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which one document of each group of near-duplicates stays: the one with the
    smallest id. Of rows with the same id one stays if it has words; documents without words stay, and rows without an id."""
    found = written(near_duplicates(docs, id_col, text_col), "near")
    repeated = found.where("kept and n_shingles > 0 and doc_id is not null").groupBy("doc_id").count().where("count > 1")
    gone = found.where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    stay = join_ids(docs, gone, id_col, "left_anti")
    twice = repeated.select(F.col("doc_id").alias(id_col))
    return join_ids(stay, twice, id_col, "left_anti").unionByName(join_ids(stay, twice, id_col, "left_semi").dropDuplicates([id_col]))
