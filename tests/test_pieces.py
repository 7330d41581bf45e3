"""Nested JSON in pieces, read as one text."""

import json
from pathlib import Path

from tablejobs.sources import export_json_pieces


def documents(path):
    """All documents of the files, one after another, and the number of files with text."""
    texts = [p.read_text() for p in sorted(Path(path).glob("part-*"))]
    text, found, at = "".join(texts), [], 0
    while text[at:].strip():
        at += len(text[at:]) - len(text[at:].lstrip())
        document, at = json.JSONDecoder().raw_decode(text, at)
        found.append(document)
    return found, sum(map(bool, texts))


def test_a_parent_fills_several_files(spark, tmp_path):
    parents = spark.createDataFrame([(1, "a"), (2, None), (3, 'q"}')], "id long, name string")
    hot = spark.range(20_000).selectExpr("2L as id", "id % 5000 as product", "'x' as note")
    few = spark.createDataFrame([(1, 7, None), (1, 7, None), (1, 3, "\n,"), (1, None, "z"), (9, 1, "no parent"), (None, 1, "n")], "id long, product long, note string")
    found, files = documents(export_json_pieces(parents, hot.union(few), "id", ["product", "note"], str(tmp_path / "out"), parts=4))
    assert files > 2
    assert [(d["id"], d["name"]) for d in found] == [(1, "a"), (2, None), (3, 'q"}')]
    assert found[0]["details"] == [
        {"product": None, "note": "z"}, {"product": 3, "note": "\n,"}, {"product": 7, "note": None}, {"product": 7, "note": None},
    ]
    assert [r["product"] for r in found[1]["details"]] == sorted(i % 5000 for i in range(20_000))
    assert found[2]["details"] == [{"product": None, "note": None}]


def test_no_parents(spark, tmp_path):
    parents = spark.createDataFrame([], "id long")
    lines = spark.createDataFrame([(1, 2)], "id long, product long")
    assert documents(export_json_pieces(parents, lines, "id", ["product"], str(tmp_path / "out")))[0] == []
