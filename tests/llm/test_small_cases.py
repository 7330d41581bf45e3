"""Tokens, benchmark passages, URL rules, archive records, quality rules and the pipeline on small rows."""

import hashlib
import re

from tablejobs.llm import bpe, decontaminate, quality, url_rules, warc

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " \n\t ", "<|endoftext|>Hello<|startoftext|> it's", "<|ENDOFTEXT|> ÀÉ Ως ΣΑΣ İstanbul 漢字　x 12345", "a" * 5000, "don't!!! 's'T",
    "é́ ﻿x\x1cy z ﬁ Å", "🙂🙂 ok", "x " * 300, "ß ẞ ǅ \u0085y",
]


def test_tokens_are_those_of_the_library(spark):
    from tokenizers import Tokenizer

    path = bpe.default_path()
    tool = Tokenizer.from_file(path)
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_tokens")
    encoded = bpe.encode(docs, path)
    ids = {r.doc_id: list(r.ids) for r in encoded.collect()}
    read = {r.doc_id: r.text for r in bpe.decode(encoded, path).collect()}
    sums = {r.doc_id: r for r in bpe.digests(docs, path).collect()}
    for i, text in enumerate(texts):
        expected = tool.encode(text or "", add_special_tokens=False).ids
        back = tool.decode(expected, skip_special_tokens=False)
        assert ids[i] == expected and read[i] == back, text
        assert sums[i].n_tokens == len(expected) and sums[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
        assert sums[i].ids_sha256 == hashlib.sha256(" ".join(map(str, expected)).encode()).hexdigest()
    none = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id long, text string")
    assert bpe.encode(none, path).count() == 3 and bpe.digests(none.limit(0), path).count() == 0


def hits(text, items):
    words = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    w, hit, found = words((text or "").encode().lower()), set(), set()
    for item, content in items:
        own = words((content or "").encode().lower())
        n = min(10, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(w), len(hit), sorted(found)


ITEMS = [("b", "One two, three four five six seven eight nine ten eleven twelve."), ("a", "Short é item"), ("c", None), ("d", "!!"), ("a2", "short É item")]
LEAKS = [
    None, "", "x ONE two three four five six seven eight nine ten. eleven y", "short é item", "a short é item short é item z", "one two three four five",
    "one two three four five six seven eight nine ten eleven twelve " * 3, "nothing here " * 40,
]


def test_benchmark_hits_in_one_pass_and_in_several(spark):
    docs = spark.createDataFrame(list(enumerate(LEAKS)), "doc_id long, text string").selectExpr("*", "1 as hits", "2 as Items")
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    for rows in decontaminate.report(docs, bench).collect():
        n, hit, found = hits(LEAKS[rows.doc_id], ITEMS)
        assert (rows.n_words, rows.n_hit, rows.n_items, rows.contaminated) == (n, hit, len(found), hit > 0), rows
        assert rows.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
    marks = [
        sorted((r.doc_id, [tuple(h) for h in r[names[1]]], r[names[2]]) for r in out.collect())
        for out, names in (decontaminate.mark(docs, bench, slice_rows=k) for k in (1000, 2))
    ]
    assert marks[0] == marks[1]
    left = {r.doc_id: r.text for r in decontaminate.remove(docs, bench).collect()}
    assert set(left) == {0, 1, 5, 7} | ({4} & set(left)) and left[7] == LEAKS[7] and left[0] is None
    assert decontaminate.remove(docs, bench.limit(0)).count() == len(LEAKS) and decontaminate.report(docs.limit(0), bench).count() == 0


def test_benchmark_items_without_id_are_hit_as_in_sql(spark):
    import duckdb

    from tablejobs.llm.queries import OP10_SQL

    items = [*ITEMS, (None, "no id at all"), (None, "nor this"), (None, None)]
    texts = [*LEAKS, "x no id at all y z v w", "no id at all, nor this; short é item", "clean"]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)").executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    db.execute("CREATE TABLE benchmark (item_id VARCHAR, text VARCHAR)").executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = sorted(tuple(r) for r in decontaminate.report(docs, bench).collect())
    assert found == sorted(db.execute(OP10_SQL).fetchall()) and [r[2:4] for r in found[-3:]] == [(4, 1), (9, 2), (0, 0)]
    marks = [sorted(map(str, decontaminate.mark(docs, bench, slice_rows=k)[0].collect())) for k in (1000, 2)]
    assert marks[0] == marks[1]
    assert {r.doc_id: r.text for r in decontaminate.remove(docs, bench).collect()}[8] == "x  y z v w"


def test_part_of_a_document_is_cut_out(spark):
    text = "Ünd " * 30 + "one two three four five six seven eight nine ten eleven" + " tail" * 9
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    out = decontaminate.remove(docs, spark.createDataFrame(ITEMS, "item_id string, text string")).collect()
    assert [r.text for r in out] == ["Ünd " * 30 + " tail" * 9] * 2


def test_url_rules(spark):
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "a.example.net/en/x"), ("block", "a.example.net/")]
    urls = {
        "http://x.net/": "net/", "http://X.NET/a?b": "net/", "http://net/": "net/", "http://net": None, "http://xnet/": None, "ftp://a.b.example.net/en/1": "example.net/en/",
        "http://example.net/de/": "net/", "http://www.example.com/de/x#y": "example.com/de/", "http://example.com/den": None, "no scheme.net/": None, None: None, "": None,
        "http://a.example.net/en/xy": "a.example.net/en/x", "http://b.a.example.net/q": "a.example.net/", "http://net.example.org/": None, "http://a..net/": "net/",
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").selectExpr("*", "1 as host", "2 as rules")
    found = {r.page_id: r for r in url_rules.judge(pages, url_rules.rule_table(spark, rules)).collect()}
    verdicts = {rule: verdict for verdict, rule in rules}
    for i, rule in enumerate(urls.values()):
        assert (found[i].rule, found[i].verdict) == (rule, verdicts.get(rule, "allow")), found[i]
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark, rules)).count() == 0
    twice = url_rules.judge(pages.union(pages), url_rules.rule_table(spark, rules).limit(0))
    assert twice.count() == 2 * len(urls) and twice.where("rule is not null").count() == 0


def test_revisits(spark, monkeypatch):
    monkeypatch.setattr(warc, "SPAN_ROWS", 2)  # several spans for one URL
    a, b = "http://www.A.org:80/x/?b=1&utm_source=q&a=2#f", "https://a.org/x?a=2&b=1"
    full, gone = {"etag": '"1"', "content-type": "text/html", "server": "s"}, {"etag": 'W/"1"', "date": "now", "server": "t"}
    rows = [
        (1, a, 10, "response", "d1", full), (2, b, 20, "revisit", "d1", gone), (3, a, 5, "revisit", "d1", gone), (4, a, 30, "response", "d2", {"etag": '"2"'}),
        (5, b, 40, "revisit", "d1", gone), (6, b, 41, "revisit", "d2", {}), (7, b, 42, "revisit", None, None), (8, None, 1, "revisit", "d1", gone), (9, a, None, "response", "d1", full), (2, b, 20, "revisit", "d1", gone),
    ]
    kind = "record_id long, url string, time long, type string, digest string, headers map<string,string>"
    out = warc.resolve_revisits(spark.createDataFrame(rows, kind)).collect()
    found = {r.record_id: (r.status, r.source_id) for r in out}
    assert len(out) == 10 and {r.url_key for r in out} == {"a.org/x?a=2&b=1", None}
    assert found == {
        1: ("full", 1), 2: ("resolved", 1), 3: ("resolved", 9), 4: ("full", 4), 5: ("changed", None), 6: ("resolved", 4), 7: ("changed", None), 8: ("missing", None), 9: ("full", 9),
    }
    merged = next(r.headers for r in out if r.record_id == 2)
    assert merged == {"etag": 'W/"1"', "date": "now", "content-type": "text/html", "server": "s"}
    assert warc.resolve_revisits(spark.createDataFrame([], kind)).count() == 0


def test_spans_of_time_hold_few_records_however_they_lie(spark, monkeypatch):
    monkeypatch.setattr(warc, "SPAN_ROWS", 20)
    times = [0, None, -(2**63), 2**63 - 1, *range(10**9, 10**9 + 2000), *[10**9 + 5] * 30]
    for side in (64, 3):  # all ends are quantiles; or evenly cut between them
        monkeypatch.setattr(warc, "SIDE", side)
        rows = spark.createDataFrame([(t,) for t in times], "time long").repartition(3)
        found = rows.select("time", warc._span(rows).alias("span")).collect()
        ordered = [r.span for r in sorted(found, key=lambda r: -(2**63) if r.time is None else r.time)]
        assert ordered == sorted(ordered) and ordered[0] >= 0
        sizes = [ordered.count(s) for s in set(ordered)]
        assert len(sizes) > 80 and max(sizes) <= (80 if side == 64 else 300)
    records = [(i, f"http://a.org/{i % 2}", t, "response" if i % 3 else "revisit", "d", None) for i, t in enumerate(times)]
    kind = "record_id long, url string, time long, type string, digest string, headers map<string,string>"
    found = {r.record_id: r.source_id for r in warc.resolve_revisits(spark.createDataFrame(records, kind)).collect()}
    last = {}
    for i, url, t, what, _, _ in sorted(records, key=lambda r: (-(2**63) if r[2] is None else r[2], r[0])):
        assert found[i] == (i if what == "response" else last.get(url)), i
        if what == "response":
            last[url] = i


def test_quality_measures_and_verdicts(spark):
    texts = [None, "", "a b c a b c", "one\none\none\n\n two", "w " * 60, " ".join(f"v{i}" for i in range(60)), "x#y " * 30 + " ".join(f"v{i}" for i in range(60))]
    texts += [" ".join(f"q{i % 40}" for i in range(100)), " ".join(f"UP{i}QRSTUV" for i in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as words", "2 as n_words")
    for r in quality.report(docs).collect():
        w = (texts[r.doc_id] or "").encode().split()
        lines = [x for x in (texts[r.doc_id] or "").split("\n") if x.strip()]
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        again = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (len(w), len(again), len(lines) - len(set(lines))), r
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and not (r.kept and r.base_failed)
    assert [r.doc_id for r in quality.keep(docs).collect()] == [5]
    assert quality.keep(docs).columns == docs.columns and quality.keep(docs.limit(0)).count() == 0


def test_quality_order_and_cascade(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(4).selectExpr("*", "1 as text_", "2 as words_", "3 as lines")
    found = quality.estimates(quality.sample(docs, rows=10**6))
    kept = {r.doc_id for r in quality.report(docs).where("kept").collect()}
    assert {r.doc_id for r in quality.keep(docs).collect()} == kept
    assert found["few_words"][1] == quality.report(docs).where("n_words < 50").count() and all(cost > 0 for cost, _ in found.values())
    assert 0 < quality.sample(docs, rows=50).count() < 100 and quality.sample(docs.limit(0)).count() == 0
    assert quality.ranked(found)[-1] == "repeated_windows"
    alike = {"a": (1000.0, 3), "b": (1200.0, 3), "c": (1000.0, 30), "d": (90000.0, 30), "e": (0.0, 0)}
    assert quality.ranked(alike) == ["e", "c", "a", "b", "d"]
    # No rule changes a verdict by its place.
    for names in (list(quality.RULES), list(quality.RULES)[::-1]):
        sql = quality.cascade(names, "text", "words", "lines")
        given = docs.selectExpr("doc_id", "text", f"{quality.word_list('text')} as words", f"{quality.line_list('text')} as lines")
        assert {r.doc_id for r in given.where(sql).collect()} == kept


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = out.collect()
    assert 0 < len(rows) < len(docs) and {r.doc_id for r in rows} <= set(docs)
    assert len(corpus_pipeline.STAGES) == 5 and all(len(r.ids) > 0 for r in rows)
