"""Merkle manifest of a table: a digest for each row, for each group and for all, with a proof for each row.

Rows are leaves in the order of their id, group by group. Every ``FANOUT`` consecutive nodes become one, until one is left for
each group; the groups' nodes, in the order of the groups, become one in the same way. A proof lists, level by level, what
stands before and after a node among its siblings; whoever has a row and its proof can recompute the root.

Places come from range partitions and the counts before each, so no group is numbered in one task. Blocks of
``FANOUT ** BLOCK_LEVELS`` consecutive rows then climb by windows: a node lives on the row of its first leaf, so that at level k
its siblings are the rows at multiples of ``FANOUT ** k`` before and behind it. Lag and lead columns at these fixed offsets,
masked by the node's slot and by the length of its run, are the siblings, and the rows of first children hash the parents. All
levels of a block need one shuffle and one sort. The block's last digest is a leaf of the next round, so that rounds are few
(1,000 million rows: three). On the way down each row's steps are joined with those of its block.

Null groups are a group of their own, before the others; groups are ordered by their UTF-8 bytes. Rows of the same id are
ordered by digest, null ids come first; equal rows are leaves of their own. Texts of any length are hashed where they are read
and never moved. An empty table gives an empty manifest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.llm.shared import written

FANOUT = 2
BLOCK_LEVELS = 10
STEPS = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex of the SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its length in bytes, a colon and itself, or a dash for null."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def fold(start: Column, steps: str = "steps") -> Column:
    """The root that a leaf and its steps lead to."""
    return F.aggregate(steps, start, lambda h, s: digest(s["before"], h, s["after"]))


def proof(steps: str = "steps") -> Column:
    """Digest of all siblings of a row, from its own level up, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _placed(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` with their ``place`` among those of their ``group_key``, from 0, and the ``size`` of the group."""
    rows = rows.withColumn("spread", F.monotonically_increasing_id())  # cuts through equal rows
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, "group_key", *by, "spread").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "merkle_ranges")
    counts = ranged.groupBy("group_key", "part").agg(F.count("*").alias("n"))
    group = Window.partitionBy("group_key")
    before = F.sum("n").over(group.orderBy("part")) - F.col("n")  # a row for each range of the group
    counts = counts.select("group_key", "part", before.alias("first"), F.sum("n").over(group).alias("size"))
    number = F.row_number().over(Window.partitionBy("group_key", "part").orderBy(*by, "spread"))
    numbered = ranged.withColumn("number", number).join(counts, ["group_key", "part"])
    return numbered.withColumn("place", F.col("first") + F.col("number") - 1).drop("first", "number", "part", "spread")


def _climb(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` with the steps of each inside its block, and on the block's first row the digest of the block (``top``)."""
    place, size = F.col("place"), F.col("size")
    window = Window.partitionBy("group_key", "block").orderBy("place")
    nodes = nodes.withColumn("block", F.floor(place / fanout**levels)).withColumn("top", F.col("digest"))
    for k in range(levels):
        unit = fanout**k
        index, count = F.floor(place / unit), F.floor((size + (unit - 1)) / unit)
        slot = index % fanout
        run = F.least(F.lit(fanout), count - index + slot)
        own = (place % unit == 0) & (count > 1)  # a node of this level stands here, and it is not the only one
        before = [F.when(own & (slot >= j), F.lag("top", j * unit).over(window)) for j in range(fanout - 1, 0, -1)]
        after = [F.when(own & (slot + j < run), F.lead("top", j * unit).over(window)) for j in range(1, fanout)]
        step = F.struct(F.concat_ws("", *before).alias("before"), F.concat_ws("", *after).alias("after"))
        nodes = nodes.withColumn(f"step{k}", F.when(own, step))
        parent = digest(F.col("top"), F.col(f"step{k}.after"))
        nodes = nodes.withColumn("top", F.when(own & (slot == 0), parent).when(~own & (place % (unit * fanout) == 0), F.col("top")))
    # A node's step holds for all leaves below it: the last one that stands at the leaf or before it.
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = [F.when(size > fanout**k, F.last(f"step{k}", ignorenulls=True).over(so_far)) for k in range(levels)]
    steps = F.array_compact(F.array(*filled)).cast(STEPS)
    return nodes.withColumn("steps", steps).drop(*[f"step{k}" for k in range(levels)])


def _tree(nodes: DataFrame, fanout: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the rounds, from the leaves up, and (group_key, digest) of each group."""
    rounds = []
    while True:
        rounds.append(written(_climb(nodes, fanout, levels), "merkle_nodes"))
        unit = fanout**levels
        above = rounds[-1].where(F.col("place") % unit == 0)
        above = above.select("group_key", F.col("block").alias("place"), F.ceil(F.col("size") / unit).alias("size"), F.col("top").alias("digest"))
        if above.where("size > 1").isEmpty():
            return rounds, above.select("group_key", "digest")
        nodes = above


def _descended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest round with each row's steps up to the root; ``above`` has (group_key, upper, …) of each group."""
    found = rounds[-1].join(above, "group_key")
    rest = [c for c in above.columns if c not in ("group_key", "upper")]
    for i in range(len(rounds) - 1, -1, -1):
        found = found.withColumn("steps", F.concat("steps", "upper")).drop("upper")
        if i:
            upper = found.select("group_key", F.col("place").alias("block"), F.col("steps").alias("upper"), *rest)
            found = rounds[i - 1].join(upper, ["group_key", "block"])
    return found


def manifest(
    docs: DataFrame,
    fields: Sequence[str],
    id_col: str,
    group_col: str,
    shown: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
    levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """(id, group, leaf, shown_leaf, subroot, root, steps) of every row.

    The leaf is the digest of ``fields``. ``shown`` gives columns as they are presented for verification; ``shown_leaf`` is
    the digest with them in place of the originals. ``steps`` lead from the leaf to the root (see ``fold``)."""
    shown = shown or {}
    key = F.coalesce(F.concat(F.lit("="), docs[group_col].cast("string")), F.lit(""))
    rows = docs.select(
        docs[id_col].alias("id"),
        docs[group_col].alias("group"),
        key.alias("group_key"),
        leaf([docs[f] for f in fields]).alias("digest"),
        (leaf([shown.get(f, docs[f]) for f in fields]) if shown else F.lit(None).cast("string")).alias("other"),
    )
    rounds, subroots = _tree(_placed(rows, "id", "digest"), fanout, levels)
    subroots = written(subroots, "merkle_subroots")
    named = subroots.select(F.lit("").alias("group_key"), F.col("group_key").alias("name"), F.col("digest").alias("subroot"), "digest")
    over, root = _tree(_placed(named, "name"), fanout, levels)
    root = root.select("group_key", F.array().cast(STEPS).alias("upper"), F.col("digest").alias("root"))
    groups = _descended(over, root).select(F.col("name").alias("group_key"), "subroot", "root", F.col("steps").alias("upper"))
    found = _descended(rounds, groups)
    other = F.coalesce("other", "digest").alias("shown_leaf")
    return found.select("id", "group", F.col("digest").alias("leaf"), other, "subroot", "root", "steps")


def verify(rows: DataFrame) -> DataFrame:
    """The rows of a manifest with ``proof_sha256``, ``folded_root`` (from the leaf as shown) and ``verified``."""
    rows = rows.withColumns({"proof_sha256": proof(), "folded_root": fold(F.col("shown_leaf"))})
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
