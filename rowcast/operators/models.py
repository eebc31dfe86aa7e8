"""Model sweeps: capacity and regularization, scored on both splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hidden layers of the capacity sweep, and the penalty weight.
CAPACITIES = {
    "tiny": [16],
    "small": [16, 16],
    "medium": [64, 64, 64],
    "large": [512, 512, 512, 512],
}
PENALTY = 0.001
# Fixed value: probabilities are kept above this before taking logarithms.
SMALLEST = 1e-15

RESULT = (
    "model string, parameters bigint, split string, rows bigint, log_loss double, accuracy double"
)


def holdout(df: DataFrame, key: str, share: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """Validation and training rows, see ``held_out``; all rows are used."""
    held = held_out(key, share)
    return df.filter(held), df.filter(~held)


def held_out(key: str, share: float = 0.1) -> Column:
    """Whether a row is for validation, by the leading digits of ``md5(key)``; a NULL key is."""
    spot = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 4), 16, 10).cast("int")
    return F.coalesce(spot, F.lit(0)) < int(share * 65_536)


def score(predicted: DataFrame) -> DataFrame:
    """Cross-entropy and accuracy per ``split`` of a scored table, in one pass."""
    chosen = F.get(vector_to_array("probability"), F.col("label").cast("int"))
    return predicted.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(-F.log(F.greatest(chosen, F.lit(SMALLEST)))).alias("log_loss"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
    )


def _sweep(train: DataFrame, validation: DataFrame, fits) -> DataFrame:
    """Fit each model on the cached training rows and score it on both splits."""
    rows = train.withColumn("split", F.lit("train")).unionByName(
        validation.withColumn("split", F.lit("validation"))
    )
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    results = []
    try:
        for name, estimator in fits:
            model = estimator.fit(rows.filter(F.col("split") == "train"))
            weights = model.weights if hasattr(model, "weights") else model.coefficients
            # Two rows per model, whatever the table size.
            results += [
                (name, len(weights), row.split, row["rows"], row.log_loss, row.accuracy)
                for row in score(model.transform(rows)).collect()
            ]
    finally:
        rows.unpersist()
    return train.sparkSession.createDataFrame(results, RESULT)


def capacity_sweep(
    train: DataFrame,
    validation: DataFrame,
    features: int,
    sizes: Sequence[str] = ("tiny", "small", "medium", "large"),
    iterations: int = 50,
    classes: int = 2,
    seed: int = 1,
) -> DataFrame:
    """Cross-entropy and accuracy of networks of rising size.

    Input columns: ``features`` vector, ``label`` from 0.
    """
    fits = (
        (
            name,
            MultilayerPerceptronClassifier(
                layers=[features, *CAPACITIES[name], classes], maxIter=iterations, seed=seed
            ),
        )
        for name in sizes
    )
    return _sweep(train, validation, fits)


def regularization_sweep(
    train: DataFrame, validation: DataFrame, penalty: float = PENALTY, iterations: int = 50
) -> DataFrame:
    """The same scores for no, squared (L2) and absolute (L1) weight penalties."""
    settings = {"none": (0.0, 0.0), "l2": (penalty, 0.0), "l1": (penalty, 1.0)}
    fits = (
        (
            name,
            LogisticRegression(
                regParam=weight, elasticNetParam=mix, maxIter=iterations, family="binomial"
            ),
        )
        for name, (weight, mix) in settings.items()
    )
    return _sweep(train, validation, fits)
