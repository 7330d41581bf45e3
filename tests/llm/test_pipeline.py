"""The whole pipeline against a chain of plain Python stages: a stage that drops, keeps or changes a row too many fails."""

import hashlib
import random
import re
from itertools import groupby
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import test_near_dup
import test_pii

from tablejobs.llm import bpe, pii, quality

BENCH = "In which year did the seventh harbour master of the old town close the northern gate for the last time?"


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(quality.BLANK)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    letters, twice = sum(map(len, words)), len(lines) - len(set(lines))
    symbols, capitals = (len(re.findall(p, text or "")) for p in (f"[{re.escape(quality.SYMBOLS)}]", "[A-Z]"))
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words) or 5 * symbols > len(words) or (twice >= 5 and 2 * twice > len(lines))
    return not (failed or letters > 25 * len(words) or 10 * capitals > 4 * letters)


def plain_cut(text, items):
    """The text without benchmark windows, or None if they are more than half of its words."""
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").finditer
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    places = [(m[0], m.start(), m.end()) for m in find(text.translate(lower))]
    words, hit = [p[0] for p in places], set()
    for item in items:
        own = [m[0] for m in find((item or "").translate(lower))]
        n = min(10, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        hit |= {j for i in range(len(words) - n + 1) if n and tuple(words[i : i + n]) in grams for j in range(i, i + n)}
    if 2 * len(hit) > len(words):
        return None
    for _, run in groupby(sorted(hit, reverse=True), key=lambda j, c=iter(range(10**9)): j + next(c)):
        run = list(run)
        text = text[: places[run[-1]][1]] + text[places[run[0]][2] :]
    return text


def spans_of(text, pattern, valid, rank, kind):
    found, at = [], 0
    for m in re.finditer(pattern, text):
        before = re.search(r"(\S+\s+\S+)\s*$", text[at : m.start()][-80:])
        at = m.end()
        if valid(m[0]):
            context = re.sub(r"\s+", " ", before[1]).lower() if before else ""
            found.append(SimpleNamespace(start=m.start(), rank=rank, end=m.end(), kind=kind, value=m[0], context=context))
    return found


def plain_mask(texts):
    checks = {}
    for kind, pattern in (("email", test_pii.EMAIL), ("ip", test_pii.IP), ("card", test_pii.CARD), ("phone", test_pii.PHONE)):
        checks[kind] = pattern, lambda x, kind=kind: f"{kind}:0:{len(x)}" in test_pii.brute(x)
    rows = []
    for text in texts:
        base = [s for rank, (kind, (p, ok)) in enumerate(checks.items()) for s in spans_of(text, p, ok, rank, kind)]
        free = [s for s in spans_of(text, pii.WORD, bool, 4, "") + spans_of(text, pii.GROUPS, lambda x: len(x) >= pii.LEAST, 4, "")
                if not any(s.start < b.end and b.start < s.end for b in base)]
        others = {}
        for s in sorted(free, key=lambda s: (s.start, s.end)):
            others.setdefault(s.start, s).end = s.end
        rows.append(SimpleNamespace(base=base, others=list(others.values())))
    known = dict(test_pii.plain_patterns(rows, texts))
    masked = []
    for text, row in zip(texts, rows, strict=True):
        every = [(s.start, s.rank, s.end, s.kind) for s in row.base]
        every += [(s.start, pii.KINDS.index(known[s.context]), s.end, known[s.context]) for s in row.others if s.context in known]
        out, at = "", 0
        for start, _, end, kind in sorted(every):
            if start >= at:
                out += text[at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        masked.append(out + text[at:])
    return masked


def chain(texts, items):
    from tokenizers import Tokenizer

    texts = {i: t for i, t in texts.items() if plain_quality(t)}
    kept = {i for i, (_, first) in test_near_dup.brute(texts).items() if i == first}
    texts = {i: cut for i, t in texts.items() if i in kept and (cut := plain_cut(t, items)) is not None}
    masked = dict(zip(texts, plain_mask(list(texts.values())), strict=True))
    tool, found = Tokenizer.from_file(bpe.default_path()), {}
    for i, text in masked.items():
        ids = tool.encode(text, add_special_tokens=False).ids
        back = tool.decode(ids, skip_special_tokens=False)
        found[i] = ids, hashlib.sha256(back.encode()).hexdigest()
    return found, masked


def corpus():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefgilmnoprstuvé", k=rng.randint(3, 9))) for _ in range(3000)]

    def prose(n=80):
        words = rng.choices(vocabulary, k=n)
        return " ".join(w + "." if i % 12 == 11 else w for i, w in enumerate(words))

    texts = [prose(rng.randint(50, 160)) for _ in range(25)]
    texts += [None, "", " \n ", prose(49), prose(50), "a b c " * 40, "# " * 30 + prose(60), "\n".join(["same line of words"] * 20 + [prose(60)])]
    texts += [prose(60).upper(), "x" * 3000 + " " + prose(60), texts[3], texts[3], texts[4] + " tail", prose(40) + " " + texts[5]]
    texts += [prose() + " " + BENCH + " " + prose(), BENCH.upper() + " " + prose(70), " ".join([BENCH, prose(8), BENCH, prose(9), BENCH])]
    texts += [f"{prose(30)} {BENCH} {prose(5)} Short Item here {prose(40)}"]
    texts += [f"{prose(60)} call my line +442079460{i:03d} now {prose(12)}" for i in range(9)]
    texts += [f"{prose(60)} call my line {x} now {prose(12)}" for x in ("020-7946-0911", "(162) 555-6820", "short1")]
    texts += [f"{prose(50)} write to us{i}@example.org or 10.0.0.{i}, card 4041894974608795 {prose(10)}" for i in range(3)]
    texts += [f"{prose(60)} room 123456 is free {prose(12)}", prose(20_000)]
    return dict(enumerate(texts)), [BENCH, "short item here", None, "!!"]


def tables(folder, texts, items):
    ids = pa.array(list(texts), pa.int64())
    columns = {"doc_id": ids, "text": list(texts.values()), "lang": ["en"] * len(ids), "source": ["web"] * len(ids), "n_chars": ids}
    pq.write_table(pa.table(columns | {"text_key": ids, "hits": ids, "words": ids}), f"{folder}/documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array(range(len(items)), pa.int64()), "text": pa.array(items, pa.string())}), f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_is_the_chain_of_plain_stages(spark, tmp_path):
    import corpus_pipeline

    texts, items = corpus()
    expected, masked = chain(texts, items)
    whole = " ".join(masked.values())
    assert len(expected) > 30 and "020-7946-0911" not in whole and "[EMAIL]" in whole and "room 123456" in whole and BENCH[3:40] not in whole
    out = corpus_pipeline.run(spark, tables(tmp_path, texts, items))
    rows = out.collect()
    found = {r.doc_id: (list(r.ids), r.decoded_sha256) for r in rows}
    assert out.columns == ["doc_id", "ids", "decoded_sha256"] and len(rows) == len(found)
    assert set(found) == set(expected)
    assert [i for i in found if found[i] != expected[i]] == []


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    import corpus_pipeline

    folder = tables(tmp_path, {}, [])
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 0
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
