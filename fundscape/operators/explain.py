"""Which features drive a score, and a map of the feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.constants import METRICS
from fundscape.functions import uniform


def holdout_split(
    df: DataFrame, key: str = "country", frac: float = 0.2, seed: int = 42, out: str = "is_test"
) -> DataFrame:
    """Mark about ``frac`` of the rows as test rows by a hash of the key, whatever the
    partitioning."""
    return df.withColumn(out, uniform([F.col(key)], seed, "holdout") < F.lit(frac))


def training_frame(
    df: DataFrame, features: Sequence[str] = METRICS, label: str = "Score", key: str = "country", frac: float = 0.2
) -> DataFrame:
    """What a model of the score is fitted and tested on: key, features, label, is_test."""
    return holdout_split(df, key, frac).select(key, *features, label, "is_test")


def feature_importance(
    df: DataFrame,
    features: Sequence[str] = METRICS,
    label: str = "Score",
    key: str = "country",
    seed: int = 0,
    frac: float = 0.2,
    trees: int = 100,
    drop_incomplete: bool = False,
) -> DataFrame:
    """Importance of each feature for a score, from a forest fitted on the training
    rows: ``(feature, importance)``, non-negative with sum 1.

    A training row with a NULL feature or score is an error that names the column, unless
    the caller allows such rows to be left out with ``drop_incomplete``."""
    train = training_frame(df, features, label, key, frac).filter("NOT is_test")
    if drop_incomplete:
        train = train.dropna(subset=[*features, label])
    else:
        gaps = train.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in [*features, label]]).first().asDict()
        if missing := sorted(c for c, n in gaps.items() if n):
            raise ValueError(f"NULL values in {missing}; fill them or pass drop_incomplete=True")
    vectors = VectorAssembler(inputCols=list(features), outputCol="_v").transform(train).select("_v", F.col(label).cast("double").alias("_y"))
    forest = RandomForestRegressor(
        featuresCol="_v", labelCol="_y", numTrees=trees, seed=seed, featureSubsetStrategy="all"
    )
    weights = forest.fit(vectors).featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(features, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def embedding_2d(
    df: DataFrame, features: Sequence[str] = METRICS, x: str = "x_2d", y: str = "y_2d"
) -> DataFrame:
    """Two coordinates per row: the first two principal components of the standardised
    features, each turned so that its largest loading is positive.

    Every row stays. A row with a NULL feature has NULL coordinates, and a feature that is
    NULL in every row is left out of the map; without any whole row all coordinates are NULL."""
    counts = df.agg(*[F.count(f"`{f}`").alias(f) for f in features]).first().asDict()
    used = [f for f in features if counts[f]]
    whole = F.lit(bool(used))
    for f in used:
        whole = whole & F.col(f"`{f}`").isNotNull()
    rest = df.filter(~whole).withColumns({x: F.lit(None).cast("double"), y: F.lit(None).cast("double")})
    vectors = VectorAssembler(inputCols=used or list(features), outputCol="_v").transform(df.filter(whole))
    if not used or vectors.isEmpty():
        return rest
    scaler = StandardScaler(inputCol="_v", outputCol="_z", withMean=True, withStd=True).fit(vectors)
    scaled = scaler.transform(vectors)
    axes = min(2, len(used))
    model = PCA(k=axes, inputCol="_z", outputCol="_p").fit(scaled)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(axes)]
    points = model.transform(scaled).withColumn("_a", vector_to_array("_p"))
    second = F.col("_a")[1] * signs[1] if axes == 2 else F.lit(0.0)
    placed = points.withColumns({x: F.col("_a")[0] * signs[0], y: second}).drop("_v", "_z", "_p", "_a")
    return placed.unionByName(rest)
