import random

from tablejobs.llm import near_dup


def brute(texts):
    words = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def same(rows, texts):
    expected = brute(texts)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.n_shingles, r.component_id) == expected[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)


def edited(words, n, pick):
    out = list(words)
    for _ in range(n):
        out[pick.randrange(len(out))] = f"e{pick.randrange(10**6)}"
    return out


def texts_with_groups():
    pick = random.Random(3)
    found = [None, "", "  \n", "one two", "ONE  two", "one two three"]
    for size in (6, 40, 150):
        base = [f"w{pick.randrange(500)}" for _ in range(size)]
        found += [" ".join(edited(base, n % 5, pick)) for n in range(25)]
    found += ["x " * 30, "x " * 60]
    return dict(enumerate(found))


def test_small_groups(spark):
    texts = texts_with_groups()
    same(near_dup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect(), texts)


def test_one_large_group_in_blocks(spark, monkeypatch):
    """Copies with more and more edits: members outside the hub's component have to be compared across blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    pick = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = {i: " ".join(edited(base, n, pick)) for i, n in enumerate(pick.choices(range(9), k=150))}
    rows = near_dup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert len({r.component_id for r in rows}) > 10
    same(rows, texts)


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, None), (3, None), (9, "other words are in this one here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept", "2 as class", "null as nothing")
    found = sorted(((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()), key=str)
    assert found == [(False, 3, 3, True)] * 2 + [(False, 7, 7, True)] * 2 + [(False, 9, 9, True), (True, None, 7, False)]
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "3", "7", "9", "None"]
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0 and near_dup.drop_near_duplicates(docs.limit(0)).count() == 0
