"""How far fitted weights are from the optimum: the subgradient of the penalised loss at each of them, from one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.models.tables import category_weights, weights_table
from tablejobs.sources import materialize

INTERCEPT = "__INTERCEPT__"
ONE_PASS_FEATURES = 4096  # up to here MLlib solves least squares from one pass
UNSEEN = "__unseen"  # the place of nulls, as in the weights table


def _weight_rows(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(processed_input, category, weight) of every weight; a number and the intercept have no category."""
    found = weights_table(df.sparkSession, model)
    numbers = found.filter(F.col("weight").isNotNull())
    return category_weights(found).unionByName(numbers.select("processed_input", F.lit(None).cast("string").alias("category"), "weight"))


def residuals(
    model: PipelineModel,
    rows: DataFrame,
    label: str,
    categorical: Sequence[str] = (),
    numeric: Sequence[str] = (),
    loss: str = "squared",
    l1: float = 0.0,
    l2: float = 0.0,
    standardize: bool = True,
    weight: Column | None = None,
) -> DataFrame:
    """(processed_input, category, n, weight, slope, residual) of the intercept and of each weight that a row speaks of.

    ``rows`` are the rows of the fit, the other parameters those it was given. ``n`` counts the rows behind a weight, ``slope``
    is the derivative of the mean loss by it, ``residual`` the smallest absolute subgradient of loss and penalties. All are 0
    at the optimum and nowhere else, because the problem is convex; a weight of 0 is right where its slope is not above the L1
    penalty. A standardised penalty takes each weight times the deviation of its column. MLlib brings the label of a squared
    loss to a deviation of 1, which leaves ``l2`` divided by that deviation. Rows without label count nowhere, nulls among
    categories have a place of their own, missing numbers are the mean. Without rows the result is empty.

    Sums by category are partial before the shuffle, and the result has the size of the model.
    """
    if loss not in ("squared", "log"):
        raise ValueError(f"unknown loss {loss}")
    scored = model.transform(rows.filter(F.col(label).isNotNull()))
    given = F.lit(1.0) if weight is None else weight.cast("double")
    y = F.col(label).cast("double")
    guess = F.col("prediction") if loss == "squared" else vector_to_array("probability")[1]

    def place(column: str, category: Column, x: Column) -> Column:
        return F.struct(F.lit(column).alias("processed_input"), category.alias("category"), x.alias("x"))

    none, one = F.lit(None).cast("string"), F.lit(1.0)
    places = [place(INTERCEPT, none, one)]
    places += [place(c, F.coalesce(F.col(c).cast("string"), F.lit(UNSEEN)), one) for c in categorical]
    places += [place(c, none, F.col(f"{c}_filled")) for c in numeric]
    spread = scored.select(given.alias("w"), y.alias("y"), guess.alias("guess"), F.explode(F.array(*places)).alias("p"))
    w, x, y = F.col("w"), F.col("p.x"), F.col("y")
    sums = spread.groupBy("p.processed_input", "p.category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(w * (F.col("guess") - y) * x).alias("r"),
        F.sum(w * x).alias("wx"),
        F.sum(w * x * x).alias("wxx"),
        F.sum(w * w).alias("ww"),
        F.sum(w * y).alias("wy"),
        F.sum(w * y * y).alias("wyy"),
    )
    sums = materialize(sums, "residuals")
    whole = sums.filter(F.col("processed_input") == INTERCEPT).first()  # x is 1 there: sums over all rows
    total, free, label_dev = 0.0, 0.0, 1.0
    if whole:
        total = whole["wx"]
        # Deviations as the solver takes them: of all rows in the one-pass solver, of a sample in the others.
        one_pass = loss == "squared" and model.stages[-1].coefficients.size <= ONE_PASS_FEATURES
        free = total if one_pass or not total else total - whole["ww"] / total
        if loss == "squared" and free > 0:
            label_dev = (max(whole["wyy"] - whole["wy"] ** 2 / total, 0.0) / free) ** 0.5 or 1.0
    variance = F.greatest(F.col("wxx") - F.col("wx") * F.col("wx") / total, F.lit(0.0)) / free if free > 0 else F.lit(0.0)
    at, slope = F.col("weight"), F.col("r") / (total or 1.0)
    lasso, ridge = (l1 * F.sqrt(variance), l2 * variance) if standardize else (F.lit(l1), F.lit(l2))
    pull = slope + ridge / label_dev * at
    residual = F.when(F.col("processed_input") == INTERCEPT, F.abs(slope))
    residual = residual.when(at == 0, F.greatest(F.abs(slope) - lasso, F.lit(0.0))).otherwise(F.abs(pull + lasso * F.signum(at)))
    weights = _weight_rows(model, rows).select(F.col("processed_input").alias("__input"), F.col("category").alias("__category"), "weight")
    same = (F.col("processed_input") == F.col("__input")) & F.col("category").eqNullSafe(F.col("__category"))
    return sums.join(weights, same).select("processed_input", "category", "n", "weight", slope.alias("slope"), residual.alias("residual"))
