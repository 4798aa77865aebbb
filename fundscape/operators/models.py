"""Models of a score, steered and judged by rows they were not fitted on."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.constants import METRICS
from fundscape.operators.explain import training_frame
from fundscape.operators.ranks import with_rank
from fundscape.session import stored


@dataclass
class Fit:
    """A fitted model: its predictions of all rows (key, is_test, label, prediction; stored), the trees it
    may have and those kept, and the weight of each feature."""

    label: str
    predictions: DataFrame
    trees: int
    kept: int
    importance: dict[str, float]


def boosted_fit(
    df: DataFrame,
    features: Sequence[str] = METRICS,
    label: str = "Score",
    key: str = "country",
    frac: float = 0.2,
    seed: int = 42,
    trees: int = 100,
    depth: int = 4,
    step: float = 0.3,
    tolerance: float = 0.01,
) -> Fit:
    """Boosted trees of a score. After each tree the error on the hold-out rows is measured; the
    fit stops when a tree lowers it by less than ``tolerance`` (of the error, or of 0.01 of the
    label's variance, if that is more) and keeps the trees up to the least error.

    The label is brought to mean 0 and variance 1 over the training rows, so that the tolerance means the
    same for every label. Rows with a NULL feature or label take no part. Without hold-out rows, as in very
    small tables, nothing can stop the fit; without training rows it raises ``ValueError``."""
    frame = stored(training_frame(df, features, label, key, frac).dropna(subset=[*features, label]), "training")
    known = frame.agg(
        F.count_if(~F.col("is_test")), F.count_if("is_test"),
        F.avg(F.when(~F.col("is_test"), F.col(label))), F.stddev_pop(F.when(~F.col("is_test"), F.col(label))),
    ).first()
    n_train, n_test, mean, spread = known
    if not n_train:
        raise ValueError(f"no training rows with {label} and all of {list(features)}")
    spread = spread or 1.0
    vectors = VectorAssembler(inputCols=list(features), outputCol="_v").transform(frame)
    vectors = vectors.withColumn("_y", (F.col(label) - mean) / spread)
    model = GBTRegressor(
        featuresCol="_v", labelCol="_y", predictionCol="_p", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed,
        validationTol=tolerance, **({"validationIndicatorCol": "is_test"} if n_test else {}),
    )
    fitted = model.fit(vectors.select("_v", "_y", "is_test"))
    predicted = fitted.transform(vectors).select(key, "is_test", F.col(label).alias("label"), (F.col("_p") * spread + mean).alias("prediction"))
    weights = dict(zip(features, (float(w) for w in fitted.featureImportances.toArray()), strict=True))
    return Fit(label, stored(predicted, "predictions"), trees, fitted.getNumTrees, weights)


def fit_errors(predictions: DataFrame) -> DataFrame:
    """One row: rows and root mean square errors of both parts, and the error on the hold-out rows of
    always guessing the training mean."""
    test, off = F.col("is_test"), F.col("label") - F.col("prediction")
    mean = predictions.filter("NOT is_test").agg(F.avg("label")).scalar()
    guess = F.col("label") - mean
    return predictions.agg(
        F.count_if(~test).alias("n_train"), F.count_if(test).alias("n_test"),
        F.sqrt(F.avg(F.when(~test, off * off))).alias("train_error"), F.sqrt(F.avg(F.when(test, off * off))).alias("holdout_error"),
        F.sqrt(F.avg(F.when(test, guess * guess))).alias("mean_error"),
    )


def fit_report(df: DataFrame, labels: Sequence[str] = ("Score", "Weighted_Score"), **options) -> DataFrame:
    """One row per label: label, trees, kept, and the errors of its boosted fit."""
    reports = []
    for label in labels:
        fit = boosted_fit(df, label=label, **options)
        errors = fit_errors(fit.predictions)
        reports.append(errors.select(F.lit(label).alias("label"), F.lit(fit.trees).alias("trees"), F.lit(fit.kept).alias("kept"), *errors.columns))
    out = reports[0]
    for more in reports[1:]:
        out = out.unionByName(more)
    return out


def permuted_features(df: DataFrame, features: Sequence[str], key: str, seed: int = 42) -> DataFrame:
    """(key, feature, value): for each row and feature the value of another row.

    A feature's rows are put in an order of their own, by MD5 of key, feature and seed, and
    each takes the value of the next, the last that of the first: a permutation that
    leaves no row its value and depends on neither partitioning nor execution order. Ranks
    of all features come from one sort over range partitions. ``key`` must tell rows apart."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    long = df.select(key, F.inline(cells))
    long = long.withColumn("_mark", F.md5(F.concat_ws("|", F.col(key).cast("string"), "feature", F.lit(str(seed)))))
    n = df.count()
    ranked = with_rank(long, ["feature", "_mark", key], "_rank").withColumn("_rank", F.col("_rank") % F.lit(max(n, 1)))
    ranked = stored(ranked, "permuted")
    givers = ranked.select("feature", ((F.col("_rank") + n - 1) % F.lit(max(n, 1))).alias("_rank"), "value")
    return ranked.select(key, "feature", "_rank").join(givers, ["feature", "_rank"]).select(key, "feature", "value")


def permutation_importance(
    df: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    features: Sequence[str] = METRICS,
    label: str = "Score",
    key: str = "country",
    seed: int = 42,
    test: str = "is_test",
) -> DataFrame:
    """(feature, base_error, permuted_error, importance): by how much the mean square error on the
    hold-out rows grows when a feature's values are dealt among them anew.

    ``predict`` adds a column ``prediction`` to a table with the features. Rows with a NULL feature or
    label take no part. Each feature gets its own copy of the hold-out rows, all in one plan;
    rows meet their permuted values in joins by rank and by key."""
    rows = stored(df.filter(test).dropna(subset=[*features, label]).select(key, label, *features), "holdout")
    off = F.col(label) - F.col("prediction")
    base = predict(rows).agg(F.avg(off * off).alias("base_error")).scalar()
    values = permuted_features(rows, features, key, seed).withColumnRenamed("value", "_value")
    changed = rows.join(values, key)
    changed = changed.withColumns({f: F.when(F.col("feature") == f, F.col("_value")).otherwise(F.col(f).cast("double")) for f in features})
    errors = predict(changed.drop("_value")).groupBy("feature").agg(F.avg(off * off).alias("permuted_error"))
    with_base = errors.withColumn("base_error", base)
    return with_base.select("feature", "base_error", "permuted_error", (F.col("permuted_error") - F.col("base_error")).alias("importance"))
