"""Regression by gradient descent with a constant learn rate, which MLlib does not offer.

The weights are a table with a row for each category of each column, so a column may have any number of categories: a step joins
the rows with it, adds up the slopes by category and writes the next table. What comes to the driver is the loss and the weights of
the numeric columns; only where the categories of every column are few enough to be broadcast, by their counted bytes, the table
goes from step to step without being written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.models.tables import WEIGHTS_SCHEMA
from tablejobs.models.training import ROWS_PER_TASK
from tablejobs.sources import materialize

LOSS = -1  # in place of a column
BROADCAST_BYTES = 16_000_000  # of the categories of a column, counted; larger tables are joined by shuffle
ROW_BYTES = 64  # of a category in a hash table, besides its text


@dataclass
class DescentModel:
    """Weights on the scale of the input columns; numbers missing in a row count as the training mean."""

    loss: str
    intercept: float
    numbers: dict[str, float]
    means: dict[str, float]
    categorical: list[str]
    categories: DataFrame | None  # (processed_input, category, weight); none without categorical columns
    small: list[bool]  # whether the categories of each column can be broadcast
    history: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Input columns and the prediction (for log loss: the share of class 1); unseen categories weigh nothing."""
        total: Column = F.lit(self.intercept)
        for column, weight in self.numbers.items():
            total = total + F.lit(weight) * F.coalesce(F.col(column).cast("double"), F.lit(self.means[column]))
        joined = df
        for i, column in enumerate(self.categorical):
            table = self.categories.filter(F.col("processed_input") == column)
            table = table.select(F.col("category").alias(f"__c{i}"), F.col("weight").alias(f"__w{i}"))
            known = F.coalesce(F.col(column).cast("string"), F.lit("")) == F.col(f"__c{i}")  # as in the fit
            joined = joined.join(F.broadcast(table) if self.small[i] else table, known, "left")
            total = total + F.coalesce(F.col(f"__w{i}"), F.lit(0.0))
        result = total if self.loss == "squared" else 1 / (1 + F.exp(-total))
        return joined.select(*df.columns, result.alias(name))

    def weights_table(self, spark: SparkSession) -> DataFrame:
        """One row per input, with an array of its categories; ``categories`` has them as rows."""
        rows = [(c, w, []) for c, w in self.numbers.items()]
        found = spark.createDataFrame([*rows, ("__INTERCEPT__", self.intercept, [])], WEIGHTS_SCHEMA)
        if not self.categorical:
            return found
        listed = F.sort_array(F.collect_list(F.struct("category", "weight"))).alias("category_weights")
        arrays = self.categories.groupBy("processed_input").agg(listed)
        return found.unionByName(arrays.select("processed_input", F.lit(None).cast("double").alias("weight"), "category_weights"))


def fit_descent(
    df: DataFrame,
    label: str,
    categorical: Sequence[str] = (),
    numeric: Sequence[str] = (),
    loss: str = "squared",
    learn_rate: float = 0.05,
    max_iter: int = 10,
    l1: float = 0.0,
    l2: float = 0.0,
    min_rel_progress: float = 0.01,
    weight: str | None = None,
) -> DescentModel:
    """Constant-rate descent on the mean loss with an L1 shrink step, stopped early when the loss hardly falls.

    Equal feature rows are merged first: their number and the sums of the label are all that either loss needs, so with
    categorical features the steps run over the combinations, not over the rows. One step is one aggregate, joined with the
    weights. Rows without label teach nothing. A loss that rises is an error: the learn rate is too large for these columns.
    """
    df = df.filter(F.col(label).isNotNull())
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    stats = df.agg(
        F.sum(w).alias("n"),
        (F.sum(w * F.col(label)) / F.sum(w)).alias("mean"),
        *[F.avg(c).alias(f"m_{c}") for c in numeric],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in numeric],
    ).first()
    means = {c: stats[f"m_{c}"] or 0.0 for c in numeric}
    spread = {c: stats[f"s_{c}"] or 1.0 for c in numeric}
    scaled = [F.coalesce((F.col(c) - means[c]) / spread[c], F.lit(0.0)).alias(c) for c in numeric]
    merged = (
        df.select(
            *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in categorical],
            *scaled,
            F.col(label).cast("double").alias("__y"),
            w.alias("__w"),
        )
        .groupBy(*categorical, *numeric)
        .agg(
            F.sum("__w").alias("n"),
            F.sum(F.col("__w") * F.col("__y")).alias("sy"),
            F.sum(F.col("__w") * F.col("__y") * F.col("__y")).alias("syy"),
        )
    )
    columns, width = list(categorical), len(categorical)
    rows = merged.select(
        *[F.col(c).alias(f"__c{i}") for i, c in enumerate(columns)],
        F.array(*[F.col(c) for c in numeric]).cast("array<double>").alias("x"),
        "n", "sy", "syy",
    )
    rows = rows.persist()
    few = rows.coalesce(rows.count() // ROWS_PER_TASK + 1)  # steps over few rows need few tasks
    try:
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"__c{i}").alias("category")) for i in range(width)]))
        slots = df.sparkSession.createDataFrame([(i, "") for i in [LOSS, *range(width, width + len(numeric) + 1)]], "column int, category string")
        if width:
            slots = slots.unionByName(few.select(cells.alias("c")).select("c.*").distinct())
        params = materialize(slots.select("column", "category", F.lit(0.0).alias("weight"), F.lit(None).cast("double").alias("slope")), "descent")
        sizes = params.groupBy("column").agg(F.sum(F.octet_length("category") + ROW_BYTES).alias("b")).collect()
        bytes_of = {r["column"]: r["b"] for r in sizes}  # a row for each column
        small = [bytes_of.get(i, 0) <= BROADCAST_BYTES for i in range(width)]
        numbers = [0.0] * len(numeric) + [stats["mean"] if loss == "squared" else 0.0]
        history: list[float] = []
        rates = (learn_rate, l1, l2, stats["n"])
        for _ in range(max_iter if stats["n"] else 0):
            after = _step(few, params, numbers, small, loss, rates)
            if all(small):  # what is broadcast in each step anyway: no table between steps
                after = df.sparkSession.createDataFrame(after.collect(), params.schema)
            else:
                after = materialize(after, "descent")
            found = {r["column"]: r for r in after.filter((F.col("column") >= width) | (F.col("column") == LOSS)).collect()}
            history.append((found[LOSS]["slope"] or 0.0) / stats["n"])
            if len(history) > 1 and not history[-1] <= history[-2] * (1 + 1e-9) + 1e-12:
                raise ValueError(f"the loss rises from {history[-2]} to {history[-1]}: the learn rate is too large")
            if len(history) > 1 and history[-2] - history[-1] < min_rel_progress * abs(history[-2]):
                break
            params = after
            numbers = [found[width + j]["weight"] for j in range(len(numeric) + 1)]
    finally:
        rows.unpersist()
    weights = {c: numbers[j] / spread[c] for j, c in enumerate(numeric)}
    shift = sum(weights[c] * means[c] for c in numeric)
    names = F.array(*[F.lit(c) for c in columns])
    listed = params.filter(F.col("column").between(0, width - 1)).select(F.get(names, F.col("column")).alias("processed_input"), "category", "weight") if width else None
    return DescentModel(loss, (numbers[-1] or 0.0) - shift, weights, means, columns, listed, small, history)


def _step(rows: DataFrame, params: DataFrame, numbers: list[float], small: list[bool], loss: str, rates: tuple[float, float, float, float]) -> DataFrame:
    """The next weights, and the loss at these ones (as the slope of LOSS).

    The numeric weights go in as one text, so that every step runs the same compiled plan.
    """
    learn_rate, l1, l2, total = rates
    width, last = len(small), len(small) + len(numbers) - 1
    joined = rows
    for i, few in enumerate(small):
        table = params.filter(F.col("column") == i).select(F.col("category").alias(f"__c{i}"), F.col("weight").alias(f"__w{i}"))
        joined = joined.join(F.broadcast(table) if few else table, f"__c{i}")
    current = F.split(F.lit(",".join(map(repr, numbers))), ",").cast("array<double>")
    z = F.aggregate(F.zip_with("x", current, lambda x, w: F.coalesce(x, F.lit(1.0)) * w), F.lit(0.0), lambda a, b: a + b)
    for i in range(width):
        z = z + F.col(f"__w{i}")
    n, sy, syy, at = F.col("n"), F.col("sy"), F.col("syy"), F.col("z")
    if loss == "squared":
        residual, value = n * at - sy, (n * at * at - 2 * at * sy + syy) / 2
    else:
        residual = n / (1 + F.exp(-at)) - sy
        value = n * (F.greatest(at, F.lit(0.0)) + F.log1p(F.exp(-F.abs(at)))) - at * sy

    def part(column: int, category: Column, amount: Column, weight: Column | None = None) -> Column:
        given = F.lit(None).cast("double") if weight is None else weight
        return F.struct(F.lit(column).alias("column"), category.alias("category"), amount.alias("amount"), given.alias("weight"))

    none = F.lit("")
    parts = [part(i, F.col(f"__c{i}"), F.col("r"), F.col(f"__w{i}")) for i in range(width)]
    parts += [part(width + j, none, F.col("r") * F.get("x", F.lit(j))) for j in range(len(numbers) - 1)]
    parts += [part(last, none, F.col("r")), part(LOSS, none, F.col("l"))]
    scored = joined.withColumn("z", z).withColumns({"r": residual, "l": value})
    spread = scored.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
    known = spread.groupBy("column", "category").agg(F.sum("amount").alias("slope"), F.max("weight").alias("weight"))  # equal in a group
    slope = F.col("slope") / total
    weight = F.when(F.col("column") >= width, F.get(current, F.col("column") - width)).otherwise(F.col("weight"))
    moved = weight - learn_rate * (slope + l2 * weight)
    shrunk = F.signum(moved) * F.greatest(F.abs(moved) - learn_rate * l1, F.lit(0.0))
    after = F.when(F.col("column") == LOSS, weight).when(F.col("column") == last, weight - learn_rate * slope).otherwise(shrunk)
    return known.select("column", "category", after.alias("weight"), "slope")
