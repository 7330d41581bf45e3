"""Feature transforms, models and their evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.functions import bucketize, day_type, feature_cross
from tablejobs.models import clustering, metrics, tables, training
from tablejobs.models.boosting import BoostedTrees, fit_boosted
from tablejobs.models.descent import fit_descent
from tablejobs.models.features import HOUR_SPLITS, TripFeatures, trip_columns
from tablejobs.models.optimality import residuals
from tablejobs.operators import hash_sample, hash_split
from tablejobs.plans import hires as hire_plan
from tablejobs.plans import scoring, segmentation
from tablejobs.queries import roles
from tablejobs.queries.baskets import CLASSES_SQL, user_classes
from tablejobs.queries.registry import query
from tablejobs.queries.repurchase import Inputs
from tablejobs.queries.roles import roles_sql
from tablejobs.sources import materialize


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    return hire_plan.after_date(roles.hires(spark, sf), roles.HIRE_DAY)


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    return hire_plan.with_station(_recent(spark, sf), roles.stations(spark, sf))


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.trip_rows(_placed(spark, sf), roles.LONG_TRIP)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- splits, transforms -------------------------------------------------------------------------------------------------


@query(
    "train_eval_split",
    roles_sql("SELECT hire_id, substr(md5(concat(hire_id, 'split')), 1, 15) < '333333333333340' AS is_eval FROM hires"),
)
def train_eval_split(spark: SparkSession, sf: str) -> DataFrame:
    return hash_split(roles.hires(spark, sf).select("hire_id"), "hire_id", 0.2, "split")


@query(
    "feature_transform",
    roles_sql("""
    SELECT hire_id, duration, start_station_name AS station, CAST(dayofweek(start_date) + 1 AS VARCHAR) AS dayofweek,
           CAST(hour(start_date) AS VARCHAR) AS hourofday FROM hires
    """),
)
def feature_transform(spark: SparkSession, sf: str) -> DataFrame:
    names = list(trip_columns("transform"))
    return TripFeatures("transform").transform(roles.hires(spark, sf)).select("hire_id", "duration", *names)


_HOUR_BIN = "CASE WHEN h < 5 THEN 0 WHEN h < 10 THEN 1 WHEN h < 17 THEN 2 ELSE 3 END"


@query("bucketize_hour", roles_sql(f"SELECT hire_id, {_HOUR_BIN} AS hourofday FROM (SELECT hire_id, hour(start_date) AS h FROM hires)"))
def bucketize_hour(spark: SparkSession, sf: str) -> DataFrame:
    return roles.hires(spark, sf).select("hire_id", bucketize(F.hour("start_date"), HOUR_SPLITS).alias("hourofday"))


@query(
    "feature_cross",
    roles_sql(f"""
    SELECT dayhr, count(*) AS n FROM (
      SELECT CASE WHEN dayofweek(start_date) BETWEEN 1 AND 5 THEN 'weekday' ELSE 'weekend' END || '_' || {_HOUR_BIN} AS dayhr
      FROM (SELECT start_date, hour(start_date) AS h FROM hires)) GROUP BY dayhr
    """),
)
def cross_counts(spark: SparkSession, sf: str) -> DataFrame:
    crossed = feature_cross(day_type("start_date"), bucketize(F.hour("start_date"), HOUR_SPLITS))
    return roles.hires(spark, sf).select(crossed.alias("dayhr")).groupBy("dayhr").agg(F.count(F.lit(1)).alias("n"))


# --- evaluation of fixed predictions ------------------------------------------------------------------------------------


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    """Hires with a prediction from fixed weights: a constant, a slope per hour and a weight per day type."""
    day = F.when(day_type("start_date") == "weekend", 5.5).otherwise(-1.25)
    fixed = F.lit(40.0) + F.lit(0.5) * F.hour("start_date") + day
    return roles.hires(spark, sf).select("hire_id", "duration", fixed.alias("prediction"))


_PREDICTED = """
, predicted AS (
  SELECT hire_id, duration, 40e0 + 0.5e0 * hour(start_date)
         + CASE WHEN dayofweek(start_date) BETWEEN 1 AND 5 THEN -1.25e0 ELSE 5.5e0 END AS prediction FROM hires)
"""


@query("predict_score", roles_sql(f"{_PREDICTED} SELECT * FROM predicted"))
def predict_score(spark: SparkSession, sf: str) -> DataFrame:
    return _predicted(spark, sf)


@query(
    "evaluate_regression",
    roles_sql(f"""{_PREDICTED}
    SELECT round(avg(abs(duration - prediction)), 6) AS mean_absolute_error,
           round(median(abs(duration - prediction)), 6) AS median_absolute_error,
           round(avg((duration - prediction) ** 2), 6) AS mean_squared_error,
           round(1 - avg((duration - prediction) ** 2) / var_pop(duration), 6) AS r2_score
    FROM predicted
    """),
)
def evaluate_regression(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.evaluate_regression(_predicted(spark, sf), "duration", "prediction"))


def _minute_score() -> Column:
    return (F.hour("start_date") * 60 + F.minute("start_date") + F.lit(0.5)) / F.lit(1440.0)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    label = (F.col("duration") > roles.LONG_TRIP).cast("int").alias("label")
    return roles.hires(spark, sf).select("hire_id", label, _minute_score().alias("score"))


_SCORED = """
, scored AS (
  SELECT hire_id, CASE WHEN duration > 100 THEN 1 ELSE 0 END AS label,
         (hour(start_date) * 60 + minute(start_date) + 0.5e0) / 1440e0 AS score FROM hires)
"""


@query(
    "evaluate_classification",
    roles_sql(f"""{_SCORED}
    , cm AS (SELECT count(*) FILTER (label = 1 AND score >= 0.236e0) AS tp, count(*) FILTER (label = 0 AND score >= 0.236e0) AS fp,
                    count(*) FILTER (label = 1 AND score < 0.236e0) AS fn, count(*) AS n,
                    avg(-ln(CASE WHEN label = 1 THEN score ELSE 1 - score END)) AS log_loss FROM scored),
    by_score AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM scored GROUP BY score),
    below AS (SELECT *, sum(q) OVER (ORDER BY score) - q AS q_below FROM by_score)
    SELECT round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
           round((n - fp - fn) / n, 6) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 6) AS f1_score,
           round(log_loss, 6) AS log_loss,
           round((SELECT sum(p * (q_below + q / 2)) / (sum(p) * sum(q)) FROM below), 6) AS roc_auc
    FROM cm
    """),
)
def evaluate_classification(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.evaluate_classification(_scored(spark, sf), "label", "score", 0.236))


@query(
    "confusion_matrix",
    roles_sql(f"""{_SCORED}
    SELECT label AS expected_label, count(*) FILTER (score < 0.236e0) AS predicted_0,
           count(*) FILTER (score >= 0.236e0) AS predicted_1 FROM scored GROUP BY label
    """),
)
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(_scored(spark, sf), "label", "score", 0.236)


@query(
    "roc_curve",
    roles_sql(f"""{_SCORED}
    , binned AS (SELECT CAST(floor(score * 100) AS BIGINT) AS bin, count(*) FILTER (label = 1) AS p,
                        count(*) FILTER (label = 0) AS n FROM scored GROUP BY 1),
    summed AS (SELECT bin, CAST(sum(p) OVER (ORDER BY bin DESC) AS BIGINT) AS tp, CAST(sum(n) OVER (ORDER BY bin DESC) AS BIGINT) AS fp,
                      CAST(sum(p) OVER () AS BIGINT) AS pos, CAST(sum(n) OVER () AS BIGINT) AS neg FROM binned)
    SELECT bin / 100 AS threshold, tp / pos AS recall, fp / neg AS false_positive_rate, tp AS true_positives,
           fp AS false_positives, neg - fp AS true_negatives, pos - tp AS false_negatives FROM summed
    """),
)
def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.roc_curve(_scored(spark, sf), "label", "score")


@query(
    "roc_curve_every_score",
    roles_sql(f"""{_SCORED}
    , counted AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM scored GROUP BY score),
    summed AS (SELECT score, CAST(sum(p) OVER (ORDER BY score DESC) AS BIGINT) AS tp, CAST(sum(n) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
                      CAST(sum(p) OVER () AS BIGINT) AS pos, CAST(sum(n) OVER () AS BIGINT) AS neg FROM counted)
    SELECT score AS threshold, tp / pos AS recall, fp / neg AS false_positive_rate, tp AS true_positives,
           fp AS false_positives, neg - fp AS true_negatives, pos - tp AS false_negatives FROM summed
    """),
)
def roc_curve_every_score(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.roc_curve(_scored(spark, sf), "label", "score", bins=None)


@query(
    "class_weights",
    roles_sql("SELECT cible, count(*) AS n, sum(CASE WHEN cible = 1 THEN 0.75e0 ELSE 0.25e0 END) AS weight FROM target GROUP BY cible"),
)
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    weighted = Inputs(spark, sf).target.withColumn("w", training.class_weight("cible", {1: 0.75, 0: 0.25}))
    return weighted.groupBy("cible").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("weight"))


# --- clusters -----------------------------------------------------------------------------------------------------------


def _classes(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(user_classes(spark, sf), "users_classes")


CENTROIDS = [[1.0] * 5, [2.0, 3.0, 2.0, 3.0, 2.0], [4.0] * 5]


def _distance_sql(point: list[float]) -> str:
    return "sqrt(" + " + ".join(f"({m} - {x}e0) ** 2" for m, x in zip(roles.MEASURES, point)) + ")"


_ASSIGNED = f"""
, classes AS ({CLASSES_SQL}),
distances AS (SELECT *, {', '.join(f'{_distance_sql(c)} AS d{i + 1}' for i, c in enumerate(CENTROIDS))} FROM classes),
assigned AS (
  SELECT * EXCLUDE (d1, d2, d3), CASE WHEN d1 <= d2 AND d1 <= d3 THEN 1 WHEN d2 <= d3 THEN 2 ELSE 3 END AS centroid_id,
         least(d1, d2, d3) AS distance FROM distances)
"""


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.assign_clusters(user_classes(spark, sf), roles.MEASURES, CENTROIDS)


@query("kmeans_assign", roles_sql(f"{_ASSIGNED} SELECT user_id, centroid_id, round(distance, 6) AS distance FROM assigned"))
def kmeans_assign(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_assigned(spark, sf).select("user_id", "centroid_id", "distance"))


def _gap(a: list[float], b: list[float]) -> float:
    return sum((x - y) ** 2 for x, y in zip(a, b)) ** 0.5


@query(
    "davies_bouldin",
    roles_sql(f"""{_ASSIGNED}
    , s AS (SELECT avg(distance) FILTER (centroid_id = 1) AS s1, avg(distance) FILTER (centroid_id = 2) AS s2,
                   avg(distance) FILTER (centroid_id = 3) AS s3, avg(distance ** 2) AS msd FROM assigned)
    SELECT round((greatest((s1 + s2) / {_gap(CENTROIDS[0], CENTROIDS[1])}e0, (s1 + s3) / {_gap(CENTROIDS[0], CENTROIDS[2])}e0)
                + greatest((s1 + s2) / {_gap(CENTROIDS[0], CENTROIDS[1])}e0, (s2 + s3) / {_gap(CENTROIDS[1], CENTROIDS[2])}e0)
                + greatest((s1 + s3) / {_gap(CENTROIDS[0], CENTROIDS[2])}e0, (s2 + s3) / {_gap(CENTROIDS[1], CENTROIDS[2])}e0)) / 3, 6)
             AS davies_bouldin_index, round(msd, 6) AS mean_squared_distance FROM s
    """),
)
def davies_bouldin(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.davies_bouldin(_assigned(spark, sf), CENTROIDS))


@query(
    "segment_profile",
    roles_sql(f"{_ASSIGNED} SELECT centroid_id, {', '.join(f'avg({m}) AS {m}' for m in roles.MEASURES)} FROM assigned GROUP BY centroid_id"),
)
def segment_profile(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.segment_profile(_assigned(spark, sf), roles.MEASURES)


@query(
    "standardize",
    roles_sql(
        "SELECT user_id, "
        + ", ".join(f"round(({m} - avg({m}) OVER ()) / stddev_samp({m}) OVER (), 6) AS {m}" for m in roles.MEASURES)
        + f" FROM ({CLASSES_SQL})"
    ),
)
def standardize(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.standardize(_classes(spark, sf), roles.MEASURES))


def _sample(spark: SparkSession, sf: str) -> DataFrame:
    return hash_sample(_classes(spark, sf), "user_id", segmentation.SAMPLE, "0")


@query("kmeans_fit_select")
def kmeans_fit_select(spark: SparkSession, sf: str) -> DataFrame:
    """One row per k tried, the kept one marked."""
    best, tried = clustering.select_segments(_sample(spark, sf), roles.MEASURES)
    rows = [(len(s.centroids), s.davies_bouldin_index, s is best) for s in tried]
    return spark.createDataFrame(rows, "num_clusters int, davies_bouldin_index double, chosen boolean")


@query("kmeans_default")
def kmeans_default(spark: SparkSession, sf: str) -> DataFrame:
    """No k given: the selection decides. Sizes of the segments on the sample."""
    sample = _sample(spark, sf)
    best, _ = clustering.select_segments(sample, roles.MEASURES)
    return best.assign(sample).groupBy("centroid_id").agg(F.count(F.lit(1)).alias("n"))


@query("segmentation_run")
def segmentation_run(spark: SparkSession, sf: str) -> DataFrame:
    _, assigned = segmentation.segmentation(_classes(spark, sf), roles.MEASURES)
    return segmentation.profile(assigned, roles.MEASURES)


# --- duration models ----------------------------------------------------------------------------------------------------


@query(
    "linreg_fit",
    roles_sql("SELECT round(regr_slope(duration, hour(start_date)), 6) AS slope, round(regr_intercept(duration, hour(start_date)), 6) AS intercept FROM hires"),
)
def linreg_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Duration on the hour alone, where SQL knows the answer; ``trip_duration_model`` fits all columns."""
    rows = roles.hires(spark, sf).select("duration", F.hour("start_date").alias("hour"))
    final = training.fit(rows, "duration", training.linear(), numeric=["hour"]).stages[-1]
    return _rounded(spark.createDataFrame([(float(final.coefficients[0]), final.intercept)], "slope double, intercept double"))


def _duration_split(spark: SparkSession, sf: str, fraction: float) -> DataFrame:
    return hash_split(_placed(spark, sf), "hire_id", fraction, "duration")


def _duration_model(spark: SparkSession, sf: str, version: str, estimator, fraction: float):
    split = _duration_split(spark, sf, fraction)
    model = training.fit(
        split.filter(~F.col("is_eval")),
        "duration",
        estimator,
        categorical=list(trip_columns(version)),
        prepare=TripFeatures(version),
    )
    return model, training.predict(model, split.filter("is_eval"))


@query("linreg_elastic")
def linreg_elastic(spark: SparkSession, sf: str) -> DataFrame:
    _, held_out = _duration_model(spark, sf, "plain", training.linear(0.1, 0.1), 0.2)
    return metrics.evaluate_regression(held_out, "duration", "prediction")


def _descent(spark: SparkSession, sf: str, version: str, fraction: float, l1: float, l2: float):
    """Held-out hires with the prediction of a descent model, and the model."""
    split = TripFeatures(version).transform(_duration_split(spark, sf, fraction))
    model = fit_descent(
        split.filter(~F.col("is_eval")), "duration", categorical=list(trip_columns(version)), l1=l1, l2=l2
    )
    return model, model.transform(split.filter("is_eval"))


@query("linreg_gd")
def linreg_gd(spark: SparkSession, sf: str) -> DataFrame:
    _, held_out = _descent(spark, sf, "plain", 0.2, 0.1, 0.1)
    return metrics.evaluate_regression(held_out, "duration", "prediction")


@query("model_weights")
def model_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Category weights that the penalty has left, per input."""
    model, _ = _descent(spark, sf, "plain", 0.2, 0.1, 0.1)
    kept = model.categories.filter(F.col("weight") != 0)
    return kept.groupBy("processed_input").agg(F.count(F.lit(1)).alias("n"))



def _unrolled_sql(steps: int) -> str:
    """Weights after some steps of descent, each step as SQL of its own."""
    shrink = "sign({m}) * greatest(abs({m}) - 0.005e0, 0)"
    parts = [
        """, x AS (
          SELECT duration AS y, start_station_name AS station, CASE WHEN dayofweek(start_date) BETWEEN 1 AND 5 THEN 'weekday' ELSE 'weekend' END AS day,
                 (hour(start_date) - avg(hour(start_date)) OVER ()) / stddev_pop(hour(start_date)) OVER () AS h FROM hires),
        station0 AS (SELECT DISTINCT station, 0e0 AS w FROM x), day0 AS (SELECT DISTINCT day, 0e0 AS w FROM x),
        p0 AS (SELECT 0e0 AS hw, avg(y) AS b, count(*) AS n FROM x)"""
    ]
    for k in range(steps):
        parts.append(f"""r{k} AS (
          SELECT x.*, n, p.b + p.hw * h + s.w + d.w - y AS r FROM x JOIN station{k} s USING (station) JOIN day{k} d USING (day) CROSS JOIN p{k} p)""")
        for c in ("station", "day"):
            moved = "w - 0.05e0 * (slope + 0.1e0 * w)"
            parts.append(f"""{c}{k + 1} AS (SELECT {c}, {shrink.format(m=f'({moved})')} AS w
              FROM (SELECT t.{c}, any_value(t.w) AS w, sum(r) / any_value(n) AS slope FROM r{k} JOIN {c}{k} t USING ({c}) GROUP BY t.{c}))""")
        moved = "(hw - 0.05e0 * (slope + 0.1e0 * hw))"
        parts.append(f"""p{k + 1} AS (SELECT {shrink.format(m=moved)} AS hw, b - 0.05e0 * mean AS b, n
          FROM (SELECT any_value(hw) AS hw, any_value(b) AS b, any_value(p.n) AS n, sum(r * h) / any_value(p.n) AS slope, sum(r) / any_value(p.n) AS mean FROM r{k} CROSS JOIN p{k} p))""")
    last = f"""
    SELECT 'station' AS processed_input, station AS category, round(w, 6) AS weight FROM station{steps}
    UNION ALL SELECT 'day', day, round(w, 6) FROM day{steps}
    UNION ALL SELECT 'hour', NULL, round(hw / (SELECT stddev_pop(hour(start_date)) FROM hires), 6) FROM p{steps}
    UNION ALL SELECT '__INTERCEPT__', NULL, round(b - hw * (SELECT avg(hour(start_date)) / stddev_pop(hour(start_date)) FROM hires), 6) FROM p{steps}"""
    return ", ".join(parts) + last


@query("linreg_gd_steps", roles_sql(_unrolled_sql(4)))
def linreg_gd_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Every weight after four steps: station and day type as categories, the hour as a number."""
    rows = roles.hires(spark, sf).select(
        "duration", F.col("start_station_name").alias("station"), day_type("start_date").alias("day"), F.hour("start_date").alias("hour")
    )
    model = fit_descent(rows, "duration", ["station", "day"], ["hour"], max_iter=4, l1=0.1, l2=0.1, min_rel_progress=0.0)
    plain = model.weights_table(spark).filter("weight is not null").select("processed_input", F.lit(None).cast("string").alias("category"), "weight")
    return _rounded(model.categories.unionByName(plain))


@query("trip_duration_model")
def trip_duration_model(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out errors of the four feature versions and of the plain least-squares model."""
    _, least_squares = _duration_model(spark, sf, "plain", training.linear(), 0.2)
    runs = {"least_squares": least_squares}
    for version, fraction in (("plain", 0.2), ("transform", 0.2), ("bucketized", 0.5), ("geo", 0.5)):
        runs[version] = _descent(spark, sf, version, fraction, 0.05, 0.05)[1]
    rows = [
        metrics.evaluate_regression(held_out, "duration", "prediction").select(F.lit(name).alias("version"), "*")
        for name, held_out in runs.items()
    ]
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result


# --- trip type models ---------------------------------------------------------------------------------------------------


@query("logreg_fit")
def logreg_fit(spark: SparkSession, sf: str) -> DataFrame:
    estimator = training.logistic(0.001, 0.001, 20, standardize=False)
    _, held_out = scoring.fit_trip_type(_trips(spark, sf), estimator, count_rows=True)
    return metrics.evaluate_classification(held_out, "is_long", "score", 0.127)


@query("boosted_trees_fit")
def boosted_trees_fit(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth of the training share decides when to stop; a child weighs 50 at least."""
    rows = TripFeatures("geo").transform(hash_split(_trips(spark, sf), "hire_id", 0.1, "stop", "stops"))
    split = hash_split(rows, "hire_id", 0.9, "trip")
    model = fit_boosted(
        split.filter(~F.col("is_eval")), "is_long", "hire_id", categorical=list(trip_columns("geo")),
        max_depth=5, subsample=0.5, min_child_weight=50.0, stops="stops",
    )
    return metrics.evaluate_classification(model.transform(split.filter("is_eval")), "is_long", "score", 0.127)


def _small_tree(spark: SparkSession, sf: str) -> BoostedTrees:
    """One tree of depth two for long hires, from hour, weekday and station name, penalised and with a least child weight."""
    day, label = F.dayofweek("start_date").alias("weekday"), (F.col("duration") > roles.LONG_TRIP).cast("int").alias("is_long")
    rows = roles.hires(spark, sf).select("hire_id", F.hour("start_date").alias("hour"), day, F.col("start_station_name").alias("station"), label)
    options = {"max_iter": 1, "max_depth": 2, "l1": 0.05, "l2": 0.125, "min_child_weight": 5.0}
    return fit_boosted(rows, "is_long", "hire_id", ["hour", "weekday"], ["station"], **options)


def _level_sql(node: str, rows: str) -> str:
    """SQL of the best cut of each node of ``rows`` (node, y, hour, weekday, station)."""
    shrunk = "pow(greatest(abs({g}) - 0.05e0, 0), 2) / ({h} + 0.125e0)"
    gain = f"{shrunk.format(g='gl', h='hl')} + {shrunk.format(g='g - gl', h='h - hl')} - {shrunk.format(g='g', h='h')}"
    up = "OVER (PARTITION BY node, f ORDER BY cut)"
    return f"""
    {node}_long AS (
      SELECT node, y, 0 AS f, 'hour' AS feature, CAST(hour AS DOUBLE) AS cut, CAST(NULL AS VARCHAR) AS category FROM {rows}
      UNION ALL SELECT node, y, 1, 'weekday', weekday, NULL FROM {rows} UNION ALL SELECT node, y, 2, 'station', NULL, station FROM {rows}),
    {node}_sums AS (SELECT node, f, feature, cut, category, sum(0.5e0 - y) AS g, 0.25e0 * count(*) AS h, count(*) AS n FROM {node}_long GROUP BY ALL),
    {node}_in AS (
      SELECT node, f, feature, cut, category, CASE WHEN f < 2 THEN sum(g) {up} ELSE g END AS gl, CASE WHEN f < 2 THEN sum(h) {up} ELSE h END AS hl,
             sum(g) OVER (PARTITION BY node, f) AS g, sum(h) OVER (PARTITION BY node, f) AS h, sum(n) OVER (PARTITION BY node, f) AS n FROM {node}_sums),
    {node} AS (
      SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, cut, category) AS rk
      FROM (SELECT *, {gain} AS gain FROM {node}_in WHERE hl >= 5 AND h - hl >= 5) WHERE gain > 1e-9)
    """


_IN_LEFT = "CASE b.feature WHEN 'hour' THEN hour <= b.cut WHEN 'weekday' THEN weekday <= b.cut ELSE station = b.category END"
_TREE_SQL = f"""
, deep0 AS (
  SELECT 1 AS node, CASE WHEN duration > 100 THEN 1 ELSE 0 END AS y, hour(start_date) AS hour, dayofweek(start_date) + 1 AS weekday,
         start_station_name AS station FROM hires),
{_level_sql("cuts0", "deep0")},
deep1 AS (SELECT 2 * d.node + CASE WHEN {_IN_LEFT} THEN 0 ELSE 1 END AS node, y, hour, weekday, station FROM deep0 d JOIN cuts0 b ON b.node = d.node AND b.rk = 1),
{_level_sql("cuts1", "deep1")},
deep2 AS (SELECT 2 * d.node + CASE WHEN {_IN_LEFT} THEN 0 ELSE 1 END AS node, y, hour, weekday, station FROM deep1 d JOIN cuts1 b ON b.node = d.node AND b.rk = 1),
every AS (SELECT * FROM deep0 UNION ALL SELECT * FROM deep1 UNION ALL SELECT * FROM deep2),
sums AS (SELECT node, sum(0.5e0 - y) AS g, 0.25e0 * count(*) AS h, count(*) AS n FROM every GROUP BY node),
best AS (SELECT * FROM cuts0 WHERE rk = 1 UNION ALL SELECT * FROM cuts1 WHERE rk = 1),
tree AS (
  SELECT 0 AS round, 0 AS tree, CAST(s.node AS INTEGER) AS node, b.feature, b.cut, b.category,
         CASE WHEN b.feature IS NOT NULL THEN false END AS missing_left, b.gain, s.h AS cover, s.n AS rows,
         CASE WHEN b.feature IS NULL THEN -0.1e0 * sign(s.g) * greatest(abs(s.g) - 0.05e0, 0) / (s.h + 0.125e0) END AS value
  FROM sums s LEFT JOIN best b ON b.node = s.node)
"""


@query("boosted_tree_splits", roles_sql(f"{_TREE_SQL} SELECT * REPLACE (round(gain, 6) AS gain, round(cover, 6) AS cover, round(value, 6) AS value) FROM tree"))
def boosted_tree_splits(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_small_tree(spark, sf).splits_table(spark))


@query(
    "boosted_tree_importance",
    roles_sql(f"""{_TREE_SQL}
    SELECT f.feature, count(t.feature) AS importance_weight, round(coalesce(avg(t.gain), 0), 6) AS importance_gain,
           round(coalesce(avg(t.cover), 0), 6) AS importance_cover
    FROM (VALUES ('hour'), ('weekday'), ('station')) f(feature) LEFT JOIN tree t ON t.feature = f.feature GROUP BY f.feature
    """),
)
def boosted_tree_importance(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_small_tree(spark, sf).importance_table(spark))


@query("forest_fit")
def forest_fit(spark: SparkSession, sf: str) -> DataFrame:
    held_out = scoring.forest_trip_type(_trips(spark, sf))
    return metrics.evaluate_classification(held_out, "is_long", "score", 0.127)


@query("trip_type_model")
def trip_type_model(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out metrics of the weakly and the strongly penalised classifier and of the two tree models."""
    trips = _trips(spark, sf)
    stopped = hash_split(trips, "hire_id", 0.1, "stop", "stops")
    runs = {
        "logistic": scoring.fit_trip_type(trips, training.logistic(0.001, 0.001, 20, standardize=False), count_rows=True)[1],
        "logistic_penalised": scoring.fit_trip_type(trips, training.logistic(0.01, 0.01, 20, standardize=False), count_rows=True)[1],
        "boosted": scoring.boosted_trip_type(stopped, "stops"),
        "forest": scoring.forest_trip_type(trips),
    }
    result = None
    for name, held_out in runs.items():
        row = metrics.evaluate_classification(held_out, "is_long", "score", 0.127).select(F.lit(name).alias("model"), "*")
        result = row if result is None else result.unionByName(row)
    return result


# --- how good the fits are ----------------------------------------------------------------------------------------------

RESIDUAL = 1e-3  # a fit whose subgradients are all below this is at its optimum
UNEQUAL = {1: 0.8, 0: 0.2}

_PLACES_SQL = """
SELECT 'station' AS processed_input, start_station_name AS category, count(*) AS n, true AS optimal FROM hires GROUP BY ALL
UNION ALL SELECT 'dayofweek', CASE WHEN dayofweek(start_date) BETWEEN 1 AND 5 THEN 'weekday' ELSE 'weekend' END, count(*), true FROM hires GROUP BY ALL
UNION ALL SELECT 'hourofday', lpad(CAST(hour(start_date) AS VARCHAR), 2, '0'), count(*), true FROM hires GROUP BY ALL
UNION ALL SELECT '__INTERCEPT__', NULL, count(*), true FROM hires HAVING count(*) > 0
"""


def _plain_hires(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    labelled = roles.hires(spark, sf).withColumn("is_long", (F.col("duration") > roles.LONG_TRIP).cast("int"))
    return materialize(TripFeatures("plain").transform(labelled), "plain_hires"), list(trip_columns("plain"))


def _verdicts(found: DataFrame) -> DataFrame:
    return found.select("processed_input", "category", "n", (F.col("residual") < RESIDUAL).alias("optimal"))


@query("linreg_elastic_optimality", roles_sql(_PLACES_SQL))
def linreg_elastic_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each weight of the elastic net over all hires is where its penalised loss is least."""
    rows, categorical = _plain_hires(spark, sf)
    model = training.fit(rows, "duration", training.linear(0.1, 0.1), categorical=categorical)
    return _verdicts(residuals(model, rows, "duration", categorical, l1=0.1, l2=0.1))


@query("logreg_optimality", roles_sql(_PLACES_SQL))
def logreg_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """The same for the classifier of long hires, which is fitted on merged rows and examined on all."""
    rows, categorical = _plain_hires(spark, sf)
    model = training.fit(rows, "is_long", training.logistic(0.001, 0.001, 100, standardize=False), categorical=categorical, count_rows=True)
    return _verdicts(residuals(model, rows, "is_long", categorical, loss="log", l1=0.001, l2=0.001, standardize=False))


@query("logreg_class_weights_optimality", roles_sql(_PLACES_SQL))
def logreg_class_weights_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """The same for the lasso with long hires weighing four times the others."""
    rows, categorical = _plain_hires(spark, sf)
    weight = training.class_weight("is_long", UNEQUAL)
    model = training.fit(rows, "is_long", training.logistic(l1=0.01), categorical=categorical, weight=weight)
    return _verdicts(residuals(model, rows, "is_long", categorical, loss="log", l1=0.01, weight=weight))


@query(
    "logreg_class_weight_shares",
    roles_sql("""
    SELECT CAST(dayofweek(start_date) + 1 AS VARCHAR) AS weekday, round(0.8e0 * sum(y) / (0.8e0 * sum(y) + 0.2e0 * sum(1 - y)), 3) AS share
    FROM (SELECT start_date, CASE WHEN duration > 100 THEN 1 ELSE 0 END AS y FROM hires) GROUP BY ALL
    """),
)
def logreg_class_weight_shares(spark: SparkSession, sf: str) -> DataFrame:
    """With one category and no penalty the scores are the weighted shares of class 1, which SQL knows."""
    rows, _ = _plain_hires(spark, sf)
    rows = rows.select("is_long", F.dayofweek("start_date").cast("string").alias("weekday"))
    estimator = training.logistic(max_iter=200).setTol(1e-10)
    model = training.fit(rows, "is_long", estimator, categorical=["weekday"], weight=training.class_weight("is_long", UNEQUAL), count_rows=True)
    return _rounded(training.score(model, rows.select("weekday").distinct(), "share"), 3)


# --- repurchase models --------------------------------------------------------------------------------------------------


def _ratios(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table, written once: every fit and evaluation below reads it again."""
    return materialize(Inputs(spark, sf).ratios, "features")


@query("logreg_class_weights")
def logreg_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    estimator = training.logistic(l1=0.01, max_iter=30)
    _, scored = scoring.fit_repurchase(_ratios(spark, sf), estimator, weights={1: 0.5, 0: 0.5})
    return metrics.confusion_matrix(scored, "cible", "score", 0.236)


@query("feature_importance")
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Number of splits, mean gain and mean cover of every input of the repurchase trees."""
    return _repurchase_trees(_ratios(spark, sf)).importance_table(spark)


def _repurchase_trees(table: DataFrame) -> BoostedTrees:
    """Trees with both penalties over the training share, a tenth of which decides when to stop."""
    split = hash_split(hash_split(table, "user_id", 0.75, "repurchase"), "user_id", 0.1, "stop", "stops")
    numeric = scoring.feature_columns(table, "user_id", "cible")
    train = split.filter(~F.col("is_eval"))
    return fit_boosted(train, "cible", "user_id", numeric, max_depth=6, subsample=0.5, l1=1.0, l2=1.0, stops="stops")


@query("scoring_run")
def scoring_run(spark: SparkSession, sf: str) -> DataFrame:
    """Four repurchase models: metrics, confusion matrix and ROC points over all users and over the held-out share, and what
    each model learnt (no part): a row per input, of weights or, for the trees, of importance. A tenth of the training share
    decides when the trees stop."""
    table = _ratios(spark, sf)
    split = hash_split(table, "user_id", 0.75, "repurchase")
    numeric = scoring.feature_columns(table, "user_id", "cible")
    balance = {1: 0.5, 0: 0.5}
    weighted = split.filter(~F.col("is_eval")).withColumn("class_weight", training.class_weight("cible", balance))
    constant_rate = fit_descent(
        weighted, "cible", numeric=numeric, loss="log", learn_rate=0.3, max_iter=30, l1=0.01, weight="class_weight"
    )
    logistic, logistic_scored = scoring.fit_repurchase(table, training.logistic())
    lasso, lasso_scored = scoring.fit_repurchase(table, training.logistic(l1=0.01, max_iter=30), weights=balance)
    boosted = _repurchase_trees(table)
    importance = boosted.importance_table(spark)
    importance = importance.unpivot("feature", importance.columns[1:], "item", "value")
    runs = {
        "logistic": (logistic_scored, 0.236, tables.weights_table(spark, logistic)),
        "logistic_penalised": (lasso_scored, 0.236, tables.weights_table(spark, lasso)),
        "constant_rate": (constant_rate.transform(split, "score"), 0.236, constant_rate.weights_table(spark)),
        "boosted": (boosted.transform(split), 0.5, importance),
    }
    result = None
    for name, (scored, threshold, learnt) in runs.items():
        kept = materialize(scored.select("user_id", "cible", "is_eval", "score"), f"scored_{name}")
        item, at, value = (F.col("item"), "feature", "value") if name == "boosted" else (F.lit("weight"), "processed_input", "weight")
        learnt = learnt.select(item.alias("item"), F.col(at).alias("at"), F.col(value).cast("double").alias("value"))
        shares = [("all", scoring.report(kept, "cible", threshold))]
        shares += [("held_out", scoring.report(kept.filter("is_eval"), "cible", threshold)), (None, learnt)]
        for part, found in shares:
            found = found.select(F.lit(name).alias("model"), F.lit(part).cast("string").alias("part"), "*")
            result = found if result is None else result.unionByName(found)
    return result
