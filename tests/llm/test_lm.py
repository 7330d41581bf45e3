import math
from collections import Counter

from tablejobs.llm import lm

TEXTS = {1: "a b c a b d", 2: "a b c a b c e", 3: "", 4: None, 5: "x", 6: "a b c a b d", 7: "The the  THE\ta", 8: "b c"}


def brute(texts, order=3):
    words = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    counts = {i: [Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) for k in range(order + 1)] for i, w in words.items()}
    total = [sum((counts[i][k] for i in texts), Counter()) for k in range(order + 1)]
    n = sum(map(len, words.values()))
    found = {}
    for i, w in words.items():
        score = 0.0
        for j in range(len(w)):
            level = min(j + 1, order)
            for k in range(level, 0, -1):
                gram = tuple(w[j - k + 1 : j + 1])
                others = total[k][gram] - counts[i][k][gram]
                if k == 1:
                    score += math.log(max(others, 0.5) / n) + (level - 1) * math.log(0.4)
                elif others > 0:
                    context = total[k - 1][gram[:-1]] - counts[i][k - 1][gram[:-1]]
                    score += math.log(others / context) + (level - k) * math.log(0.4)
                    break
        found[i] = (len(w), score)
    return found


def same(result, texts, order=3):
    expected = brute(texts, order)
    rows = result.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n, score = expected[r.doc_id]
        assert r.n_words == n and abs(r.log_score - score) < 1e-6 * max(1, abs(score)), r
        assert (r.mean_log_score is None) == (n == 0)


def test_small_texts(spark):
    same(lm.scores(spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")), TEXTS)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same(lm.scores(docs), {r.doc_id: r.text for r in docs.collect()})


def test_many_blocks_give_what_one_gives(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").selectExpr("*", "1 as block", "2 as n_words")
    same(lm.scores(docs.coalesce(1), block_bytes=1), TEXTS)
    same(lm.scores(docs.coalesce(1), order=2, block_bytes=20), TEXTS, 2)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same(lm.scores(docs, block_bytes=20_000), {r.doc_id: r.text for r in docs.collect()})


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    rows = lm.scores(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]
    assert len({round(r.log_score, 9) for r in rows}) == 1
    assert lm.scores(docs.limit(0)).count() == 0
