import math
import zlib

import numpy as np

from tablejobs.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").toPandas()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found["doc_id"]]).all()
    assert found["score"].between(0, 1).all() and (found["predicted"] == (found["score"] >= 0.7)).all()
    unseen = found[found["held_out"]]
    toxic, clean = unseen[unseen["toxic"] == 1], unseen[unseen["toxic"] == 0]
    assert toxic["predicted"].mean() > 0.6 and clean["predicted"].mean() < 0.01


def test_labels_of_held_out_rows_are_never_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    blind = labels.withColumn("toxic", __import__("pyspark.sql.functions", fromlist=["F"]).when(~toxicity.held_out("doc_id"), labels["toxic"]))
    one, two = (sorted(map(tuple, toxicity.train(docs, x).collect())) for x in (labels, blind))
    assert one and one == two


def test_no_labels_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "a b"), (2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (2, None), (9, 1)], "doc_id long, toxic int")
    weights = toxicity.train(docs, labels)
    assert weights.count() == 0
    rows = toxicity.score(docs, weights).collect()
    assert len(rows) == 4 and all(r.score == 0.5 and r.predicted == 0 for r in rows)
    assert toxicity.score(docs.limit(0), weights).count() == 0


def test_a_repeated_id_teaches_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    learnt = labels.where(~toxicity.held_out("doc_id")).where("toxic = 1").first().doc_id
    again = docs.where(f"doc_id = {learnt}").selectExpr("doc_id", "text", "explode(sequence(1, 50)) as k").drop("k")
    one, two = (sorted(map(tuple, toxicity.train(x, labels).collect())) for x in (docs, docs.union(again)))
    assert one and one == two


def plain_ftrl(rows, labels):
    """FTRL-proximal with a dictionary for each sum, one coordinate after another."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= toxicity.L1:
            return 0.0
        return -(z[i] - math.copysign(toxicity.L1, z[i])) * toxicity.RATE / (toxicity.SMOOTH + math.sqrt(n[i]))

    for _ in range(toxicity.EPOCHS):
        for places, label in zip(rows, labels):
            old = {i: weight(i) for i in places}
            slope = (1 / (1 + math.exp(-sum(old.values()))) - label) * (toxicity.TOXIC_WEIGHT if label else 1)
            for i in places:
                before, now = math.sqrt(n.get(i, 0.0)), math.sqrt(n.get(i, 0.0) + slope * slope)
                n[i] = n.get(i, 0.0) + slope * slope
                z[i] = z.get(i, 0.0) + slope - (now - before) / toxicity.RATE * old[i]
    return {i: weight(i) for i in n if weight(i)}


def test_weights_equal_plain_ftrl():
    bad, good = "you awful stupid person go away", "the weather report for the coast is mild"
    texts = [f"{bad if k % 3 == 0 else good} number {k % 7}" for k in range(90)]
    labels = [int(k % 3 == 0) for k in range(90)]
    places, weights = toxicity.fit(texts, labels)
    expected = plain_ftrl([toxicity.features(t).tolist() for t in texts], labels)
    assert len(expected) > 5 and set(places.tolist()) == set(expected)
    assert np.allclose(weights, [expected[i] for i in places.tolist()], atol=1e-3)


def test_the_sample_is_bounded_and_does_not_depend_on_partitions(spark):
    docs = spark.range(600).selectExpr("id as doc_id", "concat('word', id % 5, ' and word', id % 7) as text")
    labels = spark.range(600).selectExpr("id as doc_id", "cast(id % 5 = 0 as int) as toxic")
    one, two = (sorted(map(tuple, toxicity.train(docs, x, 100).collect())) for x in (labels.repartition(1), labels.repartition(13)))
    assert one and one == two
    assert one != sorted(map(tuple, toxicity.train(docs, labels).collect()))
