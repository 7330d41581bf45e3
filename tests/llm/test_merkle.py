"""The manifest against a plain tree in Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablejobs.llm import merkle, queries

FIELDS = ["doc_id", "lang", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves, fanout):
    """Root and, for each leaf, its (before, after) by level."""
    steps, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, place in enumerate(at):
            first = place // fanout * fanout
            steps[i].append(("".join(level[first:place]), "".join(level[place + 1 : first + fanout])))
        at = [p // fanout for p in at]
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], steps


def plain_manifest(rows, fanout):
    groups = defaultdict(list)
    for doc_id, lang, text in rows:
        groups[lang].append((doc_id is not None, doc_id or 0, plain_leaf((doc_id, lang, text)), doc_id))
    order = sorted(groups, key=lambda g: b"" if g is None else b"=" + g.encode())
    built = {g: plain_tree([r[2] for r in sorted(groups[g], key=lambda r: r[:3])], fanout) for g in order}
    root, upper = plain_tree([built[g][0] for g in order], fanout)
    found = []
    for i, g in enumerate(order):
        for row, steps in zip(sorted(groups[g], key=lambda r: r[:3]), built[g][1], strict=True):
            found.append((row[3], g, row[2], built[g][0], root, tuple(steps + upper[i])))
    return sorted(found, key=repr)


def given(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    return docs.selectExpr("*", "1 as id", "'x' as digest", "2 as place", "3 as steps", "'y' as group_key")


def sizes():
    many = [(i, f"l{i % 40}", f"text {i}") for i in range(120)]
    runs = [(i * 3, lang, "é" * (i % 5)) for lang, n in (("a", 1), ("b", 2), ("ä", 9), ("c", 64), ("", 65), (None, 130)) for i in range(n)]
    odd = [(None, "a", None), (None, "a", None), (None, None, ""), (7, "a", "x"), (7, "a", "x"), (7, "a", "y"), (2**63 - 1, "c", "long " * 40000)]
    return {"many groups": many, "all lengths": runs + odd, "one": [(5, "a", "t")]}


@pytest.mark.parametrize("fanout,levels", [(2, 2), (3, 1), (2, 10)])
@pytest.mark.parametrize("name", sizes())
def test_same_as_plain_tree(spark, name, fanout, levels):
    rows = sizes()[name]
    found = merkle.manifest(given(spark, rows), FIELDS, "doc_id", "lang", fanout=fanout, levels=levels)
    got = [(r.id, r.group, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.steps)) for r in found.collect()]
    assert sorted(got, key=repr) == plain_manifest(rows, fanout)


def test_only_rows_shown_as_they_are_verify(spark):
    rows = sizes()["all lengths"]
    found = merkle.manifest(given(spark, rows), FIELDS, "doc_id", "lang", {"text": F.expr("if(doc_id % 2 = 0, concat(text, '!'), text)")}, levels=3)
    for r in merkle.verify(found).collect():
        assert r.verified == (r.leaf == r.shown_leaf) == (r.folded_root == r.root)
        assert r.verified or r.id % 2 == 0
        assert r.proof_sha256 == sha("".join(s.before + s.after for s in r.steps))


def test_no_rows(spark):
    assert merkle.verify(merkle.manifest(given(spark, sizes()["one"]).limit(0), FIELDS, "doc_id", "lang")).count() == 0


def test_query_tampers_by_checksum(spark):
    found = queries.op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in found if not r.verified} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 7 == 0}
