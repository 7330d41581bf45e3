"""Toxicity scores: FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Learning takes at most ``TRAIN_ROWS`` labelled rows, one for each of the ids with the smallest hashes, dealt to ``SHARDS`` tasks; the
weights of the shards are averaged. Each coordinate has its own rate, and the L1 term leaves few weights: at most one for each
of the ``2 ** BITS`` places (8 bytes each, 128 MB), in practice some thousands, which are broadcast. Scoring is one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm import text as T
from tablejobs.llm.shared import join_ids, written
from tablejobs.operators import hash_sample

TRAIN_ROWS = 16_000
SHARDS = 1  # tasks that learn; each sees an equal part of the sample
BITS = 24
EPOCHS = 5
RATE, SMOOTH, L1 = 2.0, 1.0, 4.0
TOXIC_WEIGHT = 2  # how much a toxic row counts
THRESHOLD = 0.7


def features(text: str | None) -> np.ndarray:
    """Distinct places of a text's words, neighbouring pairs and pairs with a word between; place 0, the bias, comes first."""
    data = T.lowered(text)
    words = T.word_hashes(data, *T.word_places(data, T.ALPHANUMERIC))
    parts = [words, T.skip_hashes(words, 0), T.skip_hashes(words, 1) + T.U64(1)]
    return np.unique(np.r_[T.U64(0), np.concatenate(parts) >> T.U64(64 - BITS)]).astype(np.int64)


def fit(texts: list[str | None], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights that are not zero. Rows are taken in the order given, ``EPOCHS`` times."""
    z, n = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        near = np.abs(z[at]) <= L1
        return np.where(near, 0, -(z[at] - np.sign(z[at]) * L1) * RATE / (SMOOTH + np.sqrt(n[at])))

    rows = [features(t) for t in texts]
    for _ in range(EPOCHS):
        for at, label in zip(rows, labels, strict=True):
            w = weights(at)
            slope = (_sigmoid(w.sum()) - label) * (TOXIC_WEIGHT if label else 1)
            before = np.sqrt(n[at])
            n[at] += slope * slope
            z[at] += slope - (np.sqrt(n[at]) - before) / RATE * w
    used = np.flatnonzero(n)
    w = weights(used)
    return used[w != 0], w[w != 0]


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def held_out(id_col: str):
    """Rows that are never learnt from: crc32 of the id as text leaves 1 when divided by 3. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(place, weight) learnt from the labelled rows that are not held out. ``labels`` has (doc_id, toxic); rows without id,
    label or document teach nothing, an id with several texts teaches from one of them, and without any the result is empty."""
    usable = labels.where("doc_id is not null and toxic is not null").where(~held_out("doc_id"))
    by_id = written(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic_ids")
    # Counts of hash classes tell which ids come in question, so no task sees train_rows of every partition.
    chosen = written(hash_sample(by_id, "doc_id", train_rows), "toxic_labels")
    texts = join_ids(docs.select("doc_id", "text"), chosen.select("doc_id"), "doc_id", "left_semi")
    # A repeated id teaches once, so that the bound is one of rows: from the text with the smallest hash.
    texts = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS)))

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        # In a fixed order, whatever order the shuffle brought them in.
        frame = frame.assign(order=pd.util.hash_pandas_object(frame["doc_id"], index=False)).sort_values(["order", "doc_id"])
        places, weights = fit(frame["text"].tolist(), frame["toxic"].tolist())
        return pd.DataFrame({"place": places, "weight": weights.astype("float64")})

    fits = rows.groupBy("shard").applyInPandas(one, "place long, weight double")
    return fits.groupBy("place").agg((F.sum("weight") / SHARDS).alias("weight"))


def score(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, repeated rows and null ids included. Null and empty texts get the
    score of the bias alone."""
    known = weights.orderBy("place").toPandas()  # at most 2 ** BITS rows
    model = docs.sparkSession.sparkContext.broadcast((known["place"].to_numpy(np.int64), known["weight"].to_numpy(np.float64)))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weight = model.value
        for batch in found:
            scores = []
            for value in batch["text"]:
                at = features(value.as_py())
                i = np.searchsorted(places, at)
                i[i == len(places)] = 0
                scores.append(_sigmoid(weight[i[places[i] == at]].sum()) if len(places) else 0.5)
            columns = [batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score"])

    given = docs.select(docs[id_col].alias("doc_id"), held_out(id_col).alias("held_out"), docs[text_col].alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    found = given.mapInArrow(batches, f"doc_id {kind}, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
