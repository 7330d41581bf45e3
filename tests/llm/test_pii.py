import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from tablejobs.llm import pii

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def brute(text):
    text, found = text or "", []
    for rank, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in pattern.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]


def check(result, texts):
    rows = result.collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), texts[r.doc_id]
        for kind in ("email", "ip", "card", "phone"):
            assert r[f"n_{kind}"] == sum(b.startswith(kind + ":") for b in base)
        assert set(base) <= set(r.spans.split(",")) | ({""} if not base else set())


TRICKY = [
    None, "", " ", "a@b.c_d@e.f", "x@@y.z a.b@c", "a@b.c.d.e@f.g", "..@a-b.c-", "1.2.3.4.5.6.7.8", "256.1.1.1 1.256.1.1 0001.02.3.255",
    "4041894974608795", "4041 8949-7460 8795", "4041  894974608795", "40418949746087951234567890", "+1 (988) 555-2485.", "+12345", "+1((((((", "+1 2+3 456 789 012 345",
    "\x01+1 (988) 555-2485\x01 é\U0001F600 a@b.cd", "5" * 3000, "a." * 2000 + "@", "a@" + "b." * 3000, "1.1.1.1" * 50, "9" * 12 + " " + "0" * 12,
    "user%40+x@ex-ample.co.uk, +44 20 7946 0958; 10.0.0.1", "a@b@c.d@e.f",
]


def test_base_spans_of_tricky_texts(spark):
    texts = dict(enumerate(TRICKY))
    check(pii.report(spark.createDataFrame(list(texts.items()), "doc_id long, text string")), texts)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(pii.report(docs), {r.doc_id: r.text for r in docs.collect()})


@pytest.fixture(scope="module")
def accounts(spark):
    """Seeds behind 'my line' and 'card nr.'; identifiers of no known form behind the same words; noise elsewhere."""
    rows = [(i, f"call my line +4420794609{i:02d} now") for i in range(6)]
    rows += [(10, "call my line 020-7946-0911 now"), (11, "in the 020-7946-0912 end"), (12, "it is in the +442079460999 end")]
    rows += [(20 + i, f"in the end {i} it is in the middle") for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_patterns_find_unseen_identifiers(accounts):
    spans = {r.doc_id: r.spans for r in pii.report(accounts).collect()}
    assert spans[0] == "phone:13:26"
    assert spans[10] == "phone:13:26"
    assert spans[11] == "" and all(spans[i] == "" for i in range(20, 40))


def generations(spark, contexts):
    """Nine seeds behind the first context; behind each context what the one before has found, thrice, and three new ones."""
    rows = [f"call {contexts[0]} +442079460{i:03d} now" for i in range(9)]
    for k, words in enumerate(contexts):
        rows += [f"call {words} 020-7946-{k:02d}{i}x now" for i in range(3)]
        rows += [f"call {words} 020-7946-{k - 1:02d}{i}x now" for i in range(3) for _ in range(3) if k]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_patterns_of_later_generations_find_identifiers(spark):
    docs = generations(spark, ["my line", "ring office", "fax desk"])
    assert all(r.spans.startswith("phone:") for r in pii.report(docs).collect())
    left = {r.text for r in pii.mask(docs).collect()}
    assert left == {"call my line [PHONE] now", "call ring office [PHONE] now", "call fax desk [PHONE] now"}


def test_rounds_go_on_until_nothing_is_new(spark):
    docs = generations(spark, [f"{x}-line number" for x in "abcdefg"])
    assert {r.doc_id for r in pii.report(docs).where("spans = ''").collect()} == set()


@pytest.mark.parametrize(
    "value",
    ["(162) 555-6820", "555 123 4567", "1 (988) 555-2485", "123456 789012", "020-7946-0911 12", "12.34.56 7", "(020)79460911", "(20) (30) 40",
     "eyJ" + "aB3_" * 40 + ".x-9", "9" * 200, "1 2 3 " * 2000 + "4"],
)
def test_grouped_and_long_identifiers_are_found(spark, value):
    rows = [(i, f"call my line +442079460{i:03d} now") for i in range(9)] + [(10, f"call my line {value} now")]
    found = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[10] == f"phone:13:{13 + len(value)}"


def test_groups_end_before_words_and_spread_trust(spark):
    rows = [f"call my line +442079460{i:03d} now" for i in range(30)] + [f"call my line (162) 555-682{i} now" for i in range(3)]
    rows += [f"ring office (162) 555-682{i}. Then" for i in range(3)] + ["ring office 162 555-6829 now", "call my line 555 12345, 678", "call my line 555 123 456-abc"]
    rows += ["call my line 123"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert [found[i] for i in range(33, 40)] == ["phone:12:26"] * 3 + ["phone:12:24", "phone:13:22", "phone:13:20", ""]


def test_mask_keeps_columns_and_clean_rows(spark, accounts):
    docs = accounts.selectExpr("doc_id", "text", "text as text_key", "1 as masked_text", "null as nothing")
    out = pii.mask(docs)
    assert out.columns == docs.columns
    found = {r.doc_id: r for r in out.collect()}
    assert found[0].text == "call my line [PHONE] now" and found[10].text == "call my line [PHONE] now"
    assert found[20].text == "in the end 0 it is in the middle" and found[0].text_key.startswith("call my line +44")


def test_empty_null_and_repeated_rows(spark):
    rows = [(None, "a@b.cd"), (1, None), (1, None), (2, ""), (3, "x a@b.cd"), (3, "x a@b.cd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id is None, r.doc_id, r.spans) for r in pii.report(docs).collect())
    assert found == [(False, 1, ""), (False, 1, ""), (False, 2, ""), (False, 3, "email:2:8"), (False, 3, "email:2:8"), (True, None, "email:0:6")]
    assert sorted(str(r.text) for r in pii.mask(docs).collect()) == ["", "None", "None", "[EMAIL]", "x [EMAIL]", "x [EMAIL]"]
    assert pii.report(docs.limit(0)).count() == 0 and pii.mask(docs.limit(0)).count() == 0


def plain_patterns(found, texts):
    """The scoring of the graph in plain Python: (context, kind) above the threshold, from the spans of each row."""
    times, seeds = Counter(), {}
    for r in found:
        for s in r.base + r.others:
            value = s.value if len(s.value) <= 64 else hashlib.sha256(s.value.encode()).hexdigest()
            if s.context:
                times[s.context, value] += 1
                if s.kind:
                    seeds[s.context, value] = min(seeds.get((s.context, value), 9), s.rank)
    values = defaultdict(set)
    for c, v in times:
        values[c].add(v)
    wide = {c for c in values if len(values[c]) >= pii.SUPPORT}
    occurs = Counter()
    for t in texts:
        words = (t or "").lower().split()
        occurs.update(" ".join(words[i : i + 2]) for i in range(len(words) - 2))
    total = {c: max(occurs[c], sum(times[c, v] for v in values[c])) for c in wide}
    trusted = {}
    for (c, v), rank in seeds.items():
        if c in wide:
            trusted[v] = min(trusted.get(v, 9), rank)
    while True:
        scored = {}
        for c in wide:
            known = [v for v in values[c] if v in trusted]
            if len(known) >= pii.SUPPORT:
                ranks = Counter(trusted[v] for v in known)
                scored[c] = (sum(times[c, v] for v in known) / total[c], min(ranks, key=lambda k: (-ranks[k], k)))
        doubt, best = {}, {}
        for c, (score, of) in scored.items():
            for v in values[c]:
                doubt[v] = doubt.get(v, 0) + math.log(max(1 - score, 1e-9))
                best[v] = max(best.get(v, (-1, "", 0)), (score, c, of))
        new = {v: best[v][2] for v in doubt if 1 - math.exp(doubt[v]) >= pii.TRUST and v not in trusted}
        if not new:
            return {(c, pii.KINDS[of]) for c, (score, of) in scored.items() if score >= pii.TRUST}
        trusted |= new


def mixed(seed):
    """Contexts of all grades of trust, with seeds, identifiers of their own and shared ones, and plain words behind them."""
    rng = random.Random(seed)
    contexts = {f"{a} {b}": rng.random() for a in ("call", "write", "id", "ring") for b in ("us:", "nr", "at")}
    rows = []
    for i in range(600):
        words = []
        for _ in range(rng.randint(1, 4)):
            c = rng.choice(list(contexts))
            seed_of = rng.choice([f"+4420794{rng.randint(10000, 10040)}", f"u{rng.randint(0, 40)}@ex.com", f"10.0.0.{rng.randint(0, 40)}"])
            other = rng.choice([f"ab-{rng.randint(100, 180)}x", f"555 0{rng.randint(10, 60)} 99"])
            p = rng.random()
            words.append(f"So {c} {seed_of if p < contexts[c] else other if p < (1 + contexts[c]) / 1.7 else 'nobody there'} then")
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_patterns_are_those_of_plain_scoring(spark, seed):
    rows = mixed(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = pii.scan(docs, "text", "doc_id").persist()
    expected = plain_patterns(found.collect(), [t for _, t in rows])
    assert expected and {tuple(r) for r in pii.patterns(found, docs, "text").collect()} == expected
    known = dict(expected)
    spans = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    for r in found.collect():
        every = [(s.start, s.rank, f"{s.kind}:{s.start}:{s.end}") for s in r.base]
        every += [(s.start, pii.KINDS.index(known[s.context]), f"{known[s.context]}:{s.start}:{s.end}") for s in r.others if s.context in known]
        assert spans[r.doc_id] == ",".join(x[2] for x in sorted(every))


def test_very_long_texts_take_time_in_proportion(spark):
    def text(n):
        return " ".join(f"mail user{i}@example{i % 7}.org or ask {1234567 + i} now" for i in range(n))

    def seconds(n):
        docs = spark.createDataFrame([(1, text(n))], "doc_id long, text string")
        start = time.perf_counter()
        row = pii.report(docs).collect()[0]
        masked = pii.mask(docs).collect()[0].text
        assert row.n_email == n and masked.count("[EMAIL]") == n and masked.endswith(f"ask {1234566 + n} now")
        return time.perf_counter() - start

    seconds(100)
    short, long = seconds(3_000), seconds(30_000)
    assert long < 20 * max(short, 2.0)
