from collections import Counter

from tablejobs.llm import substring_dup

SIZE = substring_dup.PASSAGE


def brute(texts):
    words = [(t or "").encode().lower().split() for t in texts]
    seen = Counter(tuple(w[i : i + SIZE]) for w in words for i in range(len(w) - SIZE + 1))
    found = []
    for w in words:
        hit = [False] * len(w)
        for i in range(len(w) - SIZE + 1):
            if seen[tuple(w[i : i + SIZE])] > 1:
                hit[i : i + SIZE] = [True] * SIZE
        found.append((len(w), hit))
    return found


def same(rows, texts):
    for i, (n, hit) in enumerate(brute(texts)):
        spans = {j for s in rows[i].spans for j in range(s["first"], s["last"])}
        assert rows[i].n_words == n and rows[i].n_repeated == sum(hit) and rows[i].repeated == any(hit), i
        assert spans == {j for j, h in enumerate(hit) if h}, i


def words(tag, n):
    return " ".join(f"{tag}{i * 7919 % 1000}" for i in range(n))


def test_passages_of_all_lengths_and_places(spark):
    texts = [None, "", "one two", words("a", 49), words("a", 49)]
    for n in (49, 50, 51, 60, 84, 85, 120, 300):
        shared = words(f"s{n}_", n)
        texts += [f"{words(f'p{n}_', n % 37)} {shared} {words(f'q{n}_', 40)}", f"{shared} {words(f'r{n}_', 3)}", f"{words(f't{n}_', 90)} {shared}"]
    texts += [f"{words('x', 70)} {words('y', 20)} {words('x', 70)}", "same " * 200, "SAME " * 120]
    base = words("base", 200).split()
    texts += [" ".join(base[:k] + ["new"] + base[k:]) for k in (0, 30, 49, 50, 100, 151, 190)]  # ends of matches inside a stretch
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    same({r.doc_id: r for r in substring_dup.repeated_passages(docs).collect()}, texts)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").select("text").collect()
    texts = [r.text for r in docs]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    same({r.doc_id: r for r in substring_dup.repeated_passages(table).collect()}, texts)


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(None, words("a", 60)), (1, words("a", 60)), (1, words("a", 60)), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as text_key", "1 as n_words")
    found = substring_dup.repeated_passages(docs).collect()
    assert sorted(r.n_repeated for r in found) == [0, 60, 60, 60]
    assert substring_dup.repeated_passages(docs.limit(0)).count() == 0
